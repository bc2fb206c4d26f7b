"""Problem 2 on the catalog tables: features near other features, and the boundaries that contain them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.lineage import cut_lineage
from cairnlake.operators.proximity import containing, neighbours, one_per_place, places
from cairnlake.sources.tables import table

METRES = 30.0


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of features at most 30 m apart, and the boundaries around each feature."""
    points = places(table(spark, d, "joined"), "feature_id", "geom")
    near = neighbours(points, METRES).distinct().select(F.lit("near").alias("relation"), "id_a", "id_b")
    inside = containing(points, table(spark, d, "boundaries"), "boundary_id", "geom")
    return near.unionByName(inside.select(F.lit("inside").alias("relation"), F.col("region").alias("id_a"), F.col("id").alias("id_b")))


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many features lie inside each boundary that holds any."""
    points = places(table(spark, d, "joined"), "feature_id", "geom")
    inside = containing(points, table(spark, d, "boundaries"), "boundary_id", "geom")
    return inside.groupBy(F.col("region").alias("boundary_id")).agg(F.countDistinct("id").alias("features"))


def p2_places(spark: SparkSession, d: str) -> DataFrame:
    """The same neighbours without the pairs of copies: features of exactly one place (``copy``: the least of them, another)
    and pairs of places at most 30 m apart (``near``), each by its least feature."""
    points = places(table(spark, d, "joined"), "feature_id", "geom")
    copies = cut_lineage(one_per_place(points))
    alone = points.join(copies.where("id = place").select("id"), "id", "left_semi")
    near = neighbours(alone, METRES).distinct().select(F.lit("near").alias("relation"), "id_a", "id_b")
    return near.unionByName(copies.where("id <> place").select(F.lit("copy").alias("relation"), F.col("place").alias("id_a"), F.col("id").alias("id_b")))


QUERIES = {"p2_found": p2_found, "p2_counts": p2_counts, "p2_places": p2_places}
SQL: dict[str, str] = {}
