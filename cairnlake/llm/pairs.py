"""Items that appear together, by a blocked Gram matrix.

Method: baskets are rows of a binary sparse matrix. Each block of records adds its transpose-product: items frequent in
the block as a dense product, the others through their few entries; sums of blocks are added up by pair, and counts are
normalised by what the items' own counts lead to expect.

Defined results: repeats of an item in a basket count once; null items and null baskets take no part; a basket of one item
has no pairs but counts as a basket; pairs are ordered by code points; empty inputs give an empty result; other columns
play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.lineage import cut_lineage
from cairnlake.skew import broadcast_if_small, salted_join

#: Records of a block.
ROWS = 8_192
#: Most items of a block that enter its dense product.
DENSE = 512
#: Entries of sparse products, and of sums, that a task holds at once.
CHUNK = 1 << 20


def _expand(left: np.ndarray, right: np.ndarray, first: np.ndarray, count: np.ndarray) -> Iterator[np.ndarray]:
    """Codes of left[i] with right[first[i]] and the count[i] - 1 entries after it, in chunks."""
    at = 0
    total = np.cumsum(count)
    while at < len(left):
        start = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, start + CHUNK)))
        c = count[at:end]
        if len(c) == 1 and c[0] > CHUNK:  # one entry of a huge basket
            for k in range(0, int(c[0]), CHUNK):
                r = right[first[at] + k : first[at] + min(k + CHUNK, int(c[0]))]
                yield np.stack([np.full(len(r), left[at]), r])
        else:
            shift = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            yield np.stack([np.repeat(left[at:end], c), right[np.repeat(first[at:end], c) + shift]])
        at = end


def block_gram(rows: np.ndarray, items: np.ndarray) -> Iterator[np.ndarray]:
    """The upper triangle of the transpose-product of a block: arrays of (item a, item b, count), a < b, in parts.

    rows: the record of each entry, ascending; items: its item; entries are distinct.
    """
    names, local, df = np.unique(items, return_inverse=True, return_counts=True)
    n_rows = int(rows[-1]) + 1 if len(rows) else 0
    head = np.argsort(-df, kind="stable")[:DENSE]
    head = head[df[head] >= max(2, n_rows // 32)]
    place = np.full(len(names), -1)
    place[head] = np.arange(len(head))
    dense = place[local] >= 0
    if len(head) > 1:
        x = np.zeros((n_rows, len(head)), np.float32)
        x[rows[dense], place[local[dense]]] = 1
        g = x.T @ x  # counts up to 2^24 are exact
        i, j = np.nonzero(np.triu(g, 1))
        yield np.stack([names[head[i]], names[head[j]], g[i, j].astype(np.int64)])
    m = len(names)

    def counted(pairs: np.ndarray) -> np.ndarray:
        code, n = np.unique(np.minimum(pairs[0], pairs[1]) * m + np.maximum(pairs[0], pairs[1]), return_counts=True)
        return np.stack([names[code // m], names[code % m], n])

    tail_rows, tail = rows[~dense], local[~dense]
    head_rows, heads = rows[dense], local[dense]
    first = np.searchsorted(head_rows, tail_rows)
    yield from map(counted, _expand(tail, heads, first, np.searchsorted(head_rows, tail_rows, "right") - first))
    after = np.arange(1, len(tail) + 1)
    yield from map(counted, _expand(tail, tail, after, np.searchsorted(tail_rows, tail_rows, "right") - after))


def pair_counts(entries: DataFrame) -> DataFrame:
    """item_a, item_b, n: in how many records (``key``) two items (numbers ``item``) occur together."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def summed() -> np.ndarray:
            a, b, n = np.concatenate(held, axis=1)
            order = np.lexsort((b, a))
            a, b, n = a[order], b[order], n[order]
            starts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            return np.stack([a[starts], b[starts], np.add.reduceat(n, starts)])

        def out(s: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c.astype(np.int64)) for c in s], ["item_a", "item_b", "n"])

        def block(rows: list[np.ndarray], items: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            for part in block_gram(np.concatenate(rows), np.concatenate(items)):
                if part.shape[1]:
                    held.append(np.stack([np.minimum(part[0], part[1]), np.maximum(part[0], part[1]), part[2]]))
                    size += part.shape[1]
                if size > CHUNK:
                    held = [summed()]
                    size = held[0].shape[1]
                    if size > CHUNK // 2:
                        yield out(held[0])
                        held, size = [], 0

        rows: list[np.ndarray] = []
        items: list[np.ndarray] = []
        number, last = -1, None
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column("key").dictionary_encode()
            own = np.asarray(keys.indices)
            ids = number + np.cumsum(np.r_[keys.dictionary[own[0]].as_py() != last, own[1:] != own[:-1]])
            number, last = int(ids[-1]), keys.dictionary[own[-1]].as_py()
            held_items = np.asarray(b.column("item"))
            if number >= ROWS:  # close the block before the record that is still open
                whole = int(np.searchsorted(ids, number))
                rows.append(ids[:whole])
                items.append(held_items[:whole])
                yield from block(rows, items)
                rows, items, number = [ids[whole:] - number], [held_items[whole:]], 0
            else:
                rows.append(ids)
                items.append(held_items)
        if rows and sum(map(len, rows)):
            yield from block(rows, items)
        if size:
            yield out(summed())

    parts = entries.select("key", "item").repartition("key").sortWithinPartitions("key").mapInArrow(gram, "item_a long, item_b long, n long")
    return parts.groupBy("item_a", "item_b").agg(F.sum("n").alias("n"))


def item_pairs(baskets: DataFrame, least: int = 1) -> DataFrame:
    """item_a, item_b (text, item_a < item_b), together, count_a, count_b, baskets, lift of every pair in ``least`` baskets or more.

    baskets: key, item (text). Items in fewer than ``least`` baskets cannot be in such a pair and are left out before the
    product. Items are numbered; the dictionary is broadcast only if it measures small, else joined with hot items split.
    """
    rows = baskets.select("key", "item").where("key is not null and item is not null").distinct()
    total = rows.select("key").distinct().count()
    items = rows.groupBy("item").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") >= least)
    items = cut_lineage(items.withColumn("number", F.monotonically_increasing_id()))
    dictionary, small = broadcast_if_small(items)
    numbered = rows.join(dictionary, "item") if small else salted_join(rows, dictionary, ["item"], "inner", F.col("key"))
    counts = pair_counts(numbered.select("key", F.col("number").alias("item"))).where(F.col("n") >= least)
    counts = counts if small else cut_lineage(counts)
    for p, other in (("a", "b"), ("b", "a")):
        named = dictionary.select(F.col("number").alias(f"item_{p}"), F.col("item").alias(f"name_{p}"), F.col("count").alias(f"n_{p}"))
        counts = counts.join(named, f"item_{p}") if small else salted_join(counts, named, [f"item_{p}"], "inner", F.col(f"item_{other}"))
    first = F.col("name_a") < F.col("name_b")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    out = counts.select(
        pick("name_a", "name_b").alias("item_a"), pick("name_b", "name_a").alias("item_b"), F.col("n").alias("together"),
        pick("n_a", "n_b").alias("count_a"), pick("n_b", "n_a").alias("count_b"), F.lit(total).cast("long").alias("baskets"),
    )
    return out.withColumn("lift", F.col("together") * F.col("baskets") / (F.col("count_a").cast("double") * F.col("count_b")))


def notable(pairs: DataFrame, least: int = 5, times: int = 4) -> DataFrame:
    """Pairs in ``least`` baskets or more and at least ``times`` as often as chance leads to expect."""
    return pairs.where((F.col("together") >= least) & (F.col("together") * F.col("baskets") >= times * F.col("count_a") * F.col("count_b")))
