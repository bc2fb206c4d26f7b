"""Orphan references: every state, the cascade, dirty rows."""

from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairnlake.operators.orphans import Catalog, cascade_rounds, direct_orphans, orphan_cascade

REF = "ref_table string, ref_key string, record_id string, ref_field string, target string, ref_id string, period string, as_of timestamp_ntz"
T1, T2 = dt(2024, 1, 1), dt(2024, 2, 1)


def catalog(spark, refs, existing, removed=(), children=()):
    return Catalog(
        spark.createDataFrame(refs, REF).withColumn("state", F.lit("clash")).withColumn("count", F.lit(1)),
        spark.createDataFrame(existing, "target string, ref_id string, created_at timestamp_ntz"),
        spark.createDataFrame(list(removed), "target string, ref_id string"),
        spark.createDataFrame(list(children), "child_table string, child_id string, child_key string, child_period string, parent_table string, parent_id string"),
    )


def ref(key, of, when=T1, target="a", period="2024-01"):
    return ("m", key, key, "f", target, of, period, when)


@pytest.fixture(scope="module")
def mixed(spark):
    refs = [ref("1", "here"), ref("2", "gone"), ref("3", "deleted"), ref("4", "later"), ref("5", "later", None), ref("6", None), ref("2", "gone"), ref("7", "here", target="b"), ref("8", "x" * 50_000, None, period=None), ref("9", "untimed")]
    existing = [("a", "here", T1), ("a", "here", T2), ("a", "later", T2), ("a", None, T1), (None, "gone", T1), ("a", "untimed", None)]
    removed = [("a", "deleted"), ("a", "deleted"), ("a", "here"), (None, None)]
    children = [("r", "r1", "k1", "2024-03", "m", "2"), ("r", "r1", "k1", "2024-03", "m", "2"), ("s", "s1", "s1", None, "r", "r1"), ("r", "r2", "k2", "p", "m", "4"), ("m", "2", "2", "p", "s", "s1"), ("r", None, None, None, "m", "2")]
    return catalog(spark, refs, existing, removed, children)


def test_states(mixed):
    got = {(r.ref_key, r.state) for r in direct_orphans(mixed).collect()}
    assert got == {("2", "missing"), ("3", "deleted"), ("4", "late"), ("7", "missing"), ("8", "missing")}


def test_cascade(mixed):
    rows = orphan_cascade(mixed).collect()
    assert len([r for r in rows if r.how == "direct"]) == 5
    # late references aren't inherited from, and a cycle ends
    assert [(r.ref_table, r.ref_key, r.ref_field, r.ref_id, r.period, r.round) for r in rows if r.how == "inherited"] == [("r", "k1", "m", "2", "2024-03", 1), ("s", "s1", "r", "r1", None, 2)]


def test_hot_keys_give_the_same(mixed):
    a, b = ({(r.ref_key, r.state) for r in direct_orphans(mixed, hot).collect()} for hot in (None, 1))
    assert a == b


def test_chain(spark):
    chain = [("t", f"n{i + 1}", f"n{i + 1}", "p", "t", f"n{i}") for i in range(9)]
    c = catalog(spark, [("t", "n0", "n0", "f", "a", "nowhere", "p", T1)], [], [], chain)
    assert sorted(r.round for r in orphan_cascade(c).collect()) == list(range(10))


def test_empty(spark):
    assert orphan_cascade(catalog(spark, [], [])).count() == 0


def test_chains_of_any_length(spark):
    """Seventy generations are found in few rounds, with the state they hang on."""
    children = [("r", str(i), str(i), "p", "m" if i == 1 else "r", "2" if i == 1 else str(i - 1)) for i in range(1, 71)]
    c = catalog(spark, [ref("2", "gone")], [], [("a", "gone")], children)
    rounds = [r.collect() for r in cascade_rounds(c)]
    assert len(rounds) <= 9 and sorted(r.round for rows in rounds for r in rows) == list(range(71))
    assert {r.state for rows in rounds for r in rows} == {"deleted"}


def test_the_nearest_state_is_inherited(spark):
    children = [("r", "x", "x", "p", "m", "1"), ("r", "x", "x", "p", "m", "2"), ("s", "y", "y", "p", "r", "x"), ("s", "y", "y", "p", "m", "2")]
    c = catalog(spark, [ref("1", "gone"), ref("2", "lost")], [], [("a", "gone")], children)
    rows = {(r.ref_key, r.ref_id, r.state, r.round) for r in orphan_cascade(c).where("how = 'inherited'").collect()}
    assert rows == {("x", "1", "deleted", 1), ("x", "2", "missing", 1), ("y", "2", "missing", 1)}
