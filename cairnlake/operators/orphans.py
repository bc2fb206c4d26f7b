"""References to records that do not exist, and the records that hang on them.

Method: a fixpoint cascade. Round zero meets every reference with what it names and gives the direct orphans. Each further
round takes the children, by foreign key, of what is known to be an orphan (a semi-join that carries the parent's state
and distance) and leaves those known already, until a round finds none. What is found so is inherited. Between rounds the
foreign keys are joined with themselves, so they reach twice as far each time, and a chain of any length is followed in as
many rounds as its length has binary digits.

Defined results: null and blank references are none; whole-row repeats give one row; a null time is never late and has
a null period; an inherited orphan has the state of the nearest orphans it hangs on, deleted before missing where they
differ; empty inputs give an empty result; other columns of the inputs, of whatever name, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.lineage import cut_lineage
from cairnlake.skew import salted_join

REFERENCE = ["ref_table", "ref_key", "record_id", "ref_field", "target", "ref_id", "period", "as_of"]
CASE = ["ref_table", "ref_key", "ref_field", "ref_id", "state", "period"]


@dataclass(frozen=True)
class Catalog:
    """What the cascade works on.

    references: REFERENCE columns; ``target`` names the kind of record meant, ``record_id`` the referring record's id.
    existing: target, ref_id, created_at of every record that may be meant.
    removed: target, ref_id of every deletion on record.
    children: child_table, child_id, parent_table, parent_id, child_period of every foreign key.
    """

    references: DataFrame
    existing: DataFrame
    removed: DataFrame
    children: DataFrame


def direct_orphans(c: Catalog, hot_rows: int | None = None) -> DataFrame:
    """Round zero: references that name nothing (missing), something deleted, or something that came later (late)."""
    known = (
        c.existing.select("target", "ref_id", "created_at", F.lit(1).alias("here"), F.lit(0).alias("gone"))
        .unionByName(c.removed.select("target", "ref_id", F.lit(None).cast("timestamp_ntz").alias("created_at"), F.lit(0).alias("here"), F.lit(1).alias("gone")))
        .where(F.col("ref_id").isNotNull())
        .groupBy("target", "ref_id")
        .agg(F.min("created_at").alias("first_seen"), F.max("here").alias("here"), F.max("gone").alias("gone"))
    )
    asked = c.references.select(*REFERENCE).where(F.col("ref_id").isNotNull()).distinct()
    more = {} if hot_rows is None else {"rows": hot_rows}
    met = salted_join(asked, known, ["target", "ref_id"], "left", F.col("ref_key"), counted=c.references.where(F.col("ref_id").isNotNull()), **more)
    state = (
        F.when(F.coalesce("here", F.lit(0)) == 0, F.when(F.col("gone") == 1, F.lit("deleted")).otherwise(F.lit("missing")))
        .when(F.col("first_seen") > F.col("as_of"), F.lit("late"))
    )
    return met.withColumn("state", state).where(F.col("state").isNotNull())


def _reached(orphans: DataFrame, hops: DataFrame) -> DataFrame:
    """table, id, state, round of the records that ``hops`` (child, parent, length) lead from to a known orphan, each once."""
    front = orphans.select(F.col("table").alias("parent_table"), F.col("id").alias("parent_id"), "state", "round")
    step = hops.join(front, ["parent_table", "parent_id"]).select(F.col("child_table").alias("table"), F.col("child_id").alias("id"), "state", (F.col("round") + F.col("length")).alias("round"))
    fresh = step.join(orphans.select("table", "id"), ["table", "id"], "left_anti")
    return fresh.groupBy("table", "id").agg(F.min(F.struct("round", "state")).alias("least")).select("table", "id", "least.state", "least.round")


def _twice(hops: DataFrame) -> DataFrame:
    """Foreign keys that reach twice as far."""
    on = hops.select(F.col("child_table").alias("parent_table"), F.col("child_id").alias("parent_id"), F.col("parent_table").alias("far_table"), F.col("parent_id").alias("far_id"))
    far = hops.join(on, ["parent_table", "parent_id"]).select("child_table", "child_id", F.col("far_table").alias("parent_table"), F.col("far_id").alias("parent_id"), (F.col("length") * 2).alias("length"))
    return far.distinct()


def cascade_rounds(c: Catalog, hot_rows: int | None = None) -> Iterator[DataFrame]:
    """The rounds of the fixpoint, each computed when it is asked for: CASE columns, record_id, how and round.

    The first are the direct orphans. Only missing and deleted references make a record an orphan that its children inherit
    from; a late one was met in the end.
    """
    direct = cut_lineage(direct_orphans(c, hot_rows).select(*CASE, "record_id").distinct().withColumns({"how": F.lit("direct"), "round": F.lit(0)}))
    yield direct
    edges = cut_lineage(c.children.where(F.col("child_id").isNotNull() & F.col("parent_id").isNotNull()).distinct())
    seeds = direct.where("state <> 'late' and record_id is not null")
    orphans = cut_lineage(seeds.groupBy(F.col("ref_table").alias("table"), F.col("record_id").alias("id")).agg(F.min("state").alias("state"), F.lit(0).alias("round")))
    hops = edges.select("child_table", "child_id", "parent_table", "parent_id", F.lit(1).alias("length")).distinct()
    parents = lambda df: df.select(F.col("table").alias("parent_table"), F.col("id").alias("parent_id"), "state", (F.col("round") + 1).alias("round"))
    while True:
        fresh = cut_lineage(_reached(orphans, hops))
        if fresh.isEmpty():
            return
        orphans = cut_lineage(orphans.unionByName(fresh))
        # the foreign keys by which they hang on what is one step nearer
        led = edges.join(parents(orphans), ["parent_table", "parent_id"]).join(fresh.select(F.col("table").alias("child_table"), F.col("id").alias("child_id"), "round"), ["child_table", "child_id", "round"])
        yield led.select(
            F.col("child_table").alias("ref_table"), F.col("child_key").alias("ref_key"), F.col("parent_table").alias("ref_field"), F.col("parent_id").alias("ref_id"),
            "state", F.col("child_period").alias("period"), F.col("child_id").alias("record_id"), F.lit("inherited").alias("how"), "round",
        )
        hops = cut_lineage(_twice(hops))


def orphan_cascade(c: Catalog, hot_rows: int | None = None) -> DataFrame:
    """All rounds of the cascade.

    Inherited rows carry the foreign key that led to them: ref_field is ``parent_table``, ref_id the parent's id.
    """
    return reduce(DataFrame.unionByName, cascade_rounds(c, hot_rows))
