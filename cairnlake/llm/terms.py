"""How often every distinct term occurs and in how many records, by vertical bitmaps.

Method: records are numbered within blocks; each term of a block keeps the numbers of its records as a compressed bitmap
(a sorted array of 16-bit numbers while short, packed bits beyond) beside a counter of occurrences. Bitmaps of one field,
term and block are merged by union; blocks hold different records, so a term's records are the sum of the cardinalities.

Defined results: a term is a value without outer white space, with single spaces inside, lower-cased; null and blank
values are none; null and empty lists give none; whole-row repeats count once, but repeats within a list count as
occurrences; a record is a distinct non-null key, however many rows it has; very long terms are terms like any other;
empty inputs give an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.lineage import cut_lineage
from cairnlake.skew import HOT_ROWS, broadcast_if_small, hot_keys, with_parts

#: Records of a block: a number fits 16 bits.
BLOCK = 1 << 16
#: Postings after which a task gives out the bitmaps it holds, so that its memory is bounded.
MOST_POSTINGS = 1 << 20
#: Numbers up to which an array is smaller than packed bits.
ARRAY = 4096


def term(c: Column) -> Column:
    """A value as a term; null where it is blank."""
    return F.nullif(F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " "))), F.lit(""))


def postings(df: DataFrame, key: str, fields: dict[str, Column], hot_rows: int = HOT_ROWS) -> DataFrame:
    """key, field, term, n: the terms of each record in each field, partitioned by key; ``fields`` gives arrays of values.

    Rows are shuffled once, by their record, and repeats leave within it; a term that a record holds several times may come
    in several rows, whose ``n`` add up. Records of very many rows are counted first (combined before that shuffle), so that
    no task gathers them.
    """
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), *[F.transform(c, term).alias(f) for f, c in fields.items()])

    def cells(field: str) -> Column:
        return F.transform(F.coalesce(field, F.array().cast("array<string>")), lambda t: F.struct(F.lit(field).alias("field"), t.alias("term")))

    said = F.inline(F.concat(*map(cells, fields)))
    hot = hot_keys(df.where(F.col(key).isNotNull()).select(F.col(key).alias("key")), ["key"], hot_rows)
    if hot is None:
        return rows.repartition("key").distinct().select("key", said).where("term is not null").withColumn("n", F.lit(1).cast("long"))
    marked_ = with_parts(rows, hot, ["key"])
    few = marked_.where("parts is null").drop("parts").distinct().select("key", said).where("term is not null").withColumn("n", F.lit(1).cast("long"))
    many = marked_.where("parts is not null").drop("parts").distinct().select("key", said).where("term is not null")
    return few.unionByName(many.groupBy("key", "field", "term").agg(F.count(F.lit(1)).alias("n"))).repartition("key")


def pack(numbers: np.ndarray) -> bytes:
    """Sorted distinct 16-bit numbers as a compressed bitmap."""
    if len(numbers) <= ARRAY:
        return b"\0" + numbers.astype("<u2").tobytes()
    bits = np.zeros(BLOCK, np.uint8)
    bits[numbers] = 1
    return b"\1" + np.packbits(bits).tobytes()


def unpack(bitmap: bytes) -> np.ndarray:
    """The numbers of a compressed bitmap."""
    if bitmap[0] == 0:
        return np.frombuffer(bitmap, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8, offset=1)))


def union(a: bytes, b: bytes) -> bytes:
    """Of two bitmaps of one block."""
    return pack(np.union1d(unpack(a), unpack(b)))


def cardinality(bitmap: bytes) -> int:
    """How many numbers a bitmap holds."""
    return (len(bitmap) - 1) // 2 if bitmap[0] == 0 else int(np.bitwise_count(np.frombuffer(bitmap, np.uint8, offset=1)).sum())


INDEX = "field string, term string, block long, records binary, n long"
_NAMES = ["field", "term", "block", "records", "n"]


def _bitmaps(block: int, ids: np.ndarray, table: pa.Table) -> pa.RecordBatch:
    """The bitmaps and counters of some postings of one block; a null term stands for any term of its field."""
    field, word = (table.column(c).combine_chunks().dictionary_encode() for c in ("field", "term"))
    f, w, n = np.asarray(field.indices).astype(np.int64), np.asarray(word.indices), np.asarray(table.column("n"))
    words = len(word.dictionary) + 1
    code = np.concatenate([f * words + w, f * words + words - 1])
    both = np.concatenate([ids, ids])
    order = np.lexsort((both, code))
    both, code = both[order], code[order]
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    heads = code[starts]
    distinct = np.r_[True, (code[1:] != code[:-1]) | (both[1:] != both[:-1])]
    kept = both[distinct]
    cuts = np.r_[np.cumsum(distinct)[starts] - 1, len(kept)]
    maps = pa.array([pack(kept[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())
    at = heads % words
    terms = word.dictionary.take(pa.array(at, mask=at == words - 1))
    total = np.add.reduceat(np.concatenate([n, n])[order], starts)
    return pa.record_batch([field.dictionary.take(pa.array(heads // words)), terms, pa.array(np.full(len(heads), block)), maps, pa.array(total)], _NAMES)


def index_blocks(batches: Iterator[pa.RecordBatch], part: int, records: int = BLOCK, most: int = MOST_POSTINGS) -> Iterator[pa.RecordBatch]:
    """Bitmaps of one partition's postings, which come record by record.

    Records are numbered as they come; ``records`` of them are a block. After ``most`` postings what is held goes out, so a
    block may come in several parts, whose bitmaps are to be united.
    """
    last, number, size, at_block = None, -1, 0, 0
    held: list[tuple[np.ndarray, pa.RecordBatch]] = []

    def out() -> Iterator[pa.RecordBatch]:
        if held:
            yield _bitmaps(part * (1 << 31) + at_block, np.concatenate([h[0] for h in held]), pa.Table.from_batches([h[1] for h in held]))

    for b in batches:
        at, n = 0, b.num_rows
        if not n:
            continue
        keys = b.column("key").dictionary_encode()
        own = np.asarray(keys.indices)
        ids = number + np.cumsum(np.r_[keys.dictionary[own[0]].as_py() != last, own[1:] != own[:-1]])
        number, last = int(ids[-1]), keys.dictionary[own[-1]].as_py()
        while at < n:
            if ids[at] // records != at_block or size >= most:
                yield from out()
                held, size, at_block = [], 0, int(ids[at] // records)
            end = min(int(np.searchsorted(ids, (at_block + 1) * records)), at + most - size)
            held.append((ids[at:end] - at_block * records, b.slice(at, end - at).select(["field", "term", "n"])))
            size, at = size + end - at, end
    yield from out()


def vertical_index(posted: DataFrame) -> DataFrame:
    """INDEX rows: a bitmap and a counter per field, term and block, perhaps in parts; a null term stands for any term.

    ``posted`` has all rows of a record in one partition, as ``postings`` gives them.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from index_blocks(batches, TaskContext.get().partitionId())

    return posted.sortWithinPartitions("key").mapInArrow(build, INDEX)


def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """field, term, block, records, n of INDEX rows that come in that order: the parts of a bitmap united, their counters added."""
    left: pa.Table | None = None
    for b in chain(batches, [None]):
        if b is not None:
            left = pa.Table.from_batches([b]) if left is None else pa.concat_tables([left, pa.Table.from_batches([b])])
        if left is None or not left.num_rows:
            continue
        table = left.combine_chunks()
        f, t, k = (np.asarray(table.column(c).combine_chunks().dictionary_encode(null_encoding="encode").indices) for c in ("field", "term", "block"))
        starts = np.flatnonzero(np.r_[True, (f[1:] != f[:-1]) | (t[1:] != t[:-1]) | (k[1:] != k[:-1])])
        ends = np.r_[starts[1:], table.num_rows]
        if b is not None:  # the last bitmap may have parts to come
            left = table.slice(int(starts[-1]))
            starts, ends = starts[:-1], ends[:-1]
        if not len(starts):
            continue
        one = table.take(pa.array(starts))
        maps = table.column("records")
        n = np.add.reduceat(np.asarray(table.column("n"))[: ends[-1]], starts)
        several = np.flatnonzero(ends - starts > 1)
        if len(several):
            own = one.column("records").to_pylist()
            for i in several:
                own[i] = reduce(union, (maps[j].as_py() for j in range(starts[i], ends[i])))
            one = one.set_column(3, "records", pa.array(own, pa.binary()))
        yield from one.set_column(4, "n", pa.array(n)).combine_chunks().to_batches()


def merged(index: DataFrame) -> DataFrame:
    """INDEX with the parts of every bitmap united."""
    return index.repartition("field", "term", "block").sortWithinPartitions("field", "term", "block").mapInArrow(united, INDEX)


def term_counts(index: DataFrame) -> DataFrame:
    """field, term, occurrences, records; a null term stands for any.

    Bitmaps are united by block; a term's records are the cardinalities of its bitmaps over all blocks, which hold
    different records.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in united(batches):
            yield pa.record_batch([b.column("field"), b.column("term"), pa.array([cardinality(m) for m in b.column("records").to_pylist()], pa.int64()), b.column("n")], ["field", "term", "docs", "n"])

    parts = index.repartition("field", "term", "block").sortWithinPartitions("field", "term", "block")
    sizes = parts.mapInArrow(counted, "field string, term string, docs long, n long")
    return sizes.groupBy("field", "term").agg(F.sum("n").alias("occurrences"), F.sum("docs").alias("records"))


def marked(counts: DataFrame, rare_below: int = 3, common_above: float = 0.25) -> DataFrame:
    """field, term, occurrences, records, mark: rare, common or null.

    The number of records with any term is one row per field.
    """
    counts = cut_lineage(counts)
    any_term = counts.where("term is null").select("field", F.col("records").alias("of"))
    said = counts.where("term is not null").join(broadcast_if_small(any_term)[0], "field")
    mark = F.when(F.col("records") < rare_below, F.lit("rare")).when(F.col("records") > F.col("of") * F.lit(common_above), F.lit("common"))
    return said.select("field", "term", "occurrences", "records", mark.alias("mark"))
