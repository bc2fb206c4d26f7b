"""Term counts and item pairs against brute force."""

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairnlake.llm.pairs import block_gram, item_pairs, notable
from cairnlake.llm.terms import cardinality, index_blocks, marked, merged, pack, postings, term_counts, union, united, unpack, vertical_index

records = st.lists(st.dictionaries(st.tuples(st.sampled_from("fg"), st.sampled_from("abcde")), st.integers(1, 3), max_size=6), max_size=12)


@settings(max_examples=80, deadline=None)
@given(records, st.integers(1, 4), st.integers(1, 5), st.integers(1, 7))
def test_blocks_of_any_size_give_the_same_counts(rows, block, most, batch):
    flat = [(f"k{i:03}", f, t, n) for i, r in enumerate(rows) for (f, t), n in r.items()]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("key", "field", "term", "n"), x)) for x in flat[i : i + batch]]) for i in range(0, len(flat), batch)]
    docs, n, parts = Counter(), Counter(), 0
    laid = sorted((r for b in index_blocks(iter(batches), 3, block + 1, most) for r in b.to_pylist()), key=lambda r: (r["field"], r["term"] or "", r["block"]))
    laid = [pa.RecordBatch.from_pylist(laid[i : i + batch], pa.schema([("field", pa.string()), ("term", pa.string()), ("block", pa.int64()), ("records", pa.binary()), ("n", pa.int64())])) for i in range(0, len(laid), batch)]
    for b in united(iter(laid)):
        for r in b.to_pylist():
            docs[r["field"], r["term"]] += cardinality(r["records"])
            n[r["field"], r["term"]] += r["n"]
            parts += 1
    assert parts <= len({(f, t) for _, f, t, _ in flat} | {(f, None) for _, f, _, _ in flat}) * (len(rows) // (block + 1) + 1)
    want, total = Counter(), Counter()
    for _, f, t, k in flat:
        want[f, t] += 1
        total[f, t] += k
        total[f, None] += k
    for r in rows:
        for f in {f for f, _ in r}:
            want[f, None] += 1
    assert {k: v for k, v in docs.items() if v} == dict(want)
    assert n == total


@given(st.sets(st.integers(0, 65535), max_size=50), st.sets(st.integers(0, 65535), max_size=50))
def test_bitmaps(a, b):
    x, y = (np.array(sorted(s), np.int64) for s in (a, b))
    assert unpack(union(pack(x), pack(y))).tolist() == sorted(a | b)


def test_long_bitmaps():
    x = np.arange(0, 65536, 7)
    assert len(pack(x)) == 8193 and cardinality(pack(x)) == len(x) and (unpack(pack(x)) == x).all()


def frame(spark):
    rows = [("b1", [" Heat ", "heat", "Open  Data", None, ""], "X"), ("b1", [" Heat ", "heat", "Open  Data", None, ""], "X"), ("b2", ["HEAT"], None), ("b3", None, "  "), ("b4", [], "x"), (None, ["heat"], "x"), ("b5", ["z" * 70000], "y")]
    return spark.createDataFrame(rows, "key string, words array<string>, term string").withColumn("n", F.lit(7))


@pytest.mark.parametrize("hot_rows", [1, 500_000])
def test_terms_of_dirty_rows(spark, hot_rows):
    got = term_counts(vertical_index(postings(frame(spark), "key", {"words": F.col("words"), "kind": F.array("term")}, hot_rows)))
    rows = {(r.field, r.term): (r.occurrences, r.records) for r in got.collect()}
    assert rows == {("words", "heat"): (3, 2), ("words", "open data"): (1, 1), ("words", "z" * 70000): (1, 1), ("words", None): (5, 3), ("kind", "x"): (2, 2), ("kind", "y"): (1, 1), ("kind", None): (3, 3)}
    marks = {(r.field, r.term): r.mark for r in marked(got).collect()}
    assert marks["words", "heat"] == "rare" and marks["kind", "x"] == "rare"
    assert {r.mark for r in marked(got, rare_below=1).where("term = 'heat'").collect()} == {"common"}


def test_counts_are_read_from_the_bitmaps(spark):
    """A record more in a bitmap is a record more in the count, and parts of one block that overlap count once."""
    index = vertical_index(postings(frame(spark), "key", {"words": F.col("words")})).collect()
    schema = "field string, term string, block long, records binary, n long"
    twice = spark.createDataFrame([tuple(r) for r in index] * 2, schema)
    assert {r.term: r.records for r in term_counts(twice).collect()}["heat"] == 2 and merged(twice).count() == len(index)
    more = [(r.field, r.term, r.block, union(bytes(r.records), pack(np.array([60_000]))) if r.term == "heat" else r.records, r.n) for r in index]
    got = {r.term: r.records for r in term_counts(spark.createDataFrame(more, schema)).collect()}
    assert got["heat"] == 2 + sum(r.term == "heat" for r in index)


def test_no_terms(spark):
    assert marked(term_counts(vertical_index(postings(frame(spark).limit(0), "key", {"words": F.col("words")})))).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), max_size=12), min_size=1, max_size=40))
def test_gram_counts_pairs(baskets):
    rows = np.array([i for i, b in enumerate(baskets) for _ in b], np.int64)
    items = np.array([x for b in baskets for x in sorted(b)], np.int64)
    got = Counter()
    for a, b, n in (t for part in block_gram(rows, items) for t in part.T.tolist()):
        got[min(a, b), max(a, b)] += n
    assert got == Counter(p for b in baskets for p in combinations(sorted(b), 2))


def test_pairs_of_baskets(spark):
    baskets = [(f"k{i}", x) for i in range(8) for x in "ab"] + [(f"m{i}", x) for i in range(40) for x in "cd"[: 1 + i % 2]] + [("k0", "a"), ("k0", None), (None, "a"), ("solo", "é")]
    df = spark.createDataFrame(baskets, "key string, item string").withColumn("count", F.lit(1))
    rows = {(r.item_a, r.item_b): r for r in item_pairs(df).collect()}
    assert set(rows) == {("a", "b"), ("c", "d")}
    ab = rows["a", "b"]
    assert (ab.together, ab.count_a, ab.count_b, ab.baskets) == (8, 8, 8, 49) and abs(ab.lift - 49 / 8) < 1e-9
    assert [(r.item_a, r.item_b) for r in notable(item_pairs(df, least=5)).collect()] == [("a", "b")]
    assert item_pairs(df.limit(0)).count() == 0
