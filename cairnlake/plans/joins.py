"""Key joins, extents, types and reprojection on the relational tables; places are made of keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions import geometry as g
from cairnlake.functions.names import bounds_size, crs
from cairnlake.functions.text import strip
from cairnlake.operators.keyjoin import join_stats, key_join
from cairnlake.sources.files import union_files
from cairnlake.sources.tables import table

X, Y = "{k} % 360 - 180", "{k} % 181 - 90"


def placed(df: DataFrame, key: str) -> DataFrame:
    """With a point made of a whole-number key."""
    x, y = (F.expr(e.format(k=f"`{key}`")).cast("double") for e in (X, Y))
    return df.withColumn("geom", g.point(x, y))


def _flat(df: DataFrame) -> DataFrame:
    """The point's coordinates in place of the geometry."""
    return df.withColumn("b", g.box("geom")).select(*[c for c in df.columns if c != "geom"], F.col("b.minx").alias("x"), F.col("b.miny").alias("y"))


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value")


def _join(how: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _flat(key_join(_events(spark, d), placed(table(spark, d, "customer"), "c_custkey"), "user_id", "c_custkey", how))

    run.__doc__ = f"Events with the place of their customer: {how} join."
    return run


def join_stats_orders(spark: SparkSession, d: str) -> DataFrame:
    """What is recorded of orders joined with their customers' places."""
    return join_stats(key_join(table(spark, d, "orders"), placed(table(spark, d, "customer"), "c_custkey"), "o_custkey", "c_custkey", "left"))


def join_stats_empty(spark: SparkSession, d: str) -> DataFrame:
    """The same of a join that finds nothing."""
    none = placed(table(spark, d, "customer"), "c_custkey").withColumn("k", F.lit("-"))
    return join_stats(key_join(table(spark, d, "region"), none, "r_regionkey", "k", "inner"))


def join_text_cast(spark: SparkSession, d: str) -> DataFrame:
    """Keys with leading zeros don't match numbers."""
    padded = placed(table(spark, d, "customer"), "c_custkey").withColumn("k", F.lpad(F.col("c_custkey").cast("string"), 6, "0"))
    return key_join(_events(spark, d), padded, "user_id", "k", "inner").agg(F.count(F.lit(1)).alias("n"))


def join_duplicate_and_null_keys(spark: SparkSession, d: str) -> DataFrame:
    """Repeated keys multiply, null keys match nothing; a hot key is split."""
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.nullif("l_linenumber", F.lit(3)).alias("k"))
    twice = table(spark, d, "region").withColumn("k", F.col("r_regionkey")).unionByName(table(spark, d, "region").withColumn("k", F.nullif("r_regionkey", F.lit(1))))
    out = key_join(items, placed(twice, "r_regionkey"), "k", "k", "left", hot=True)
    return out.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count("geom").alias("with_geometry"))


def join_key_clean(spark: SparkSession, d: str) -> DataFrame:
    """Keys of joined features, stripped, with how many features hold each."""
    return table(spark, d, "joined").select("feature_id", strip(F.col("sa1_code21")).alias("key")).where("key is not null").groupBy("key").agg(F.countDistinct("feature_id").alias("features"))


def joined_types(spark: SparkSession, d: str) -> DataFrame:
    """Geometry types of joined features in any dialect."""
    return table(spark, d, "joined").groupBy(g.geometry_type(F.col("geom")).alias("geometry_type")).agg(F.count(F.lit(1)).alias("n"))


def joined_extents(spark: SparkSession, d: str) -> DataFrame:
    """Extent and overall type of each dataset of joined features."""
    boxed = table(spark, d, "joined").select("dataset_id", "geom", g.box("geom").alias("b"))
    out = boxed.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("row_count"), g.extent(F.col("b")).alias("bounds"), g.overall_type(F.col("geom")).alias("geometry_type"))
    return out.select("dataset_id", "row_count", "bounds.*", "geometry_type")


def bounds_area(spark: SparkSession, d: str) -> DataFrame:
    """Width, height and area of assets' bounds by kind."""
    sized = table(spark, d, "assets").where("bounds is not null").select("asset_id", "kind", "bounds").distinct().withColumn("s", bounds_size(F.col("bounds")))
    return sized.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), *[F.round(F.sum(f"s.{k}"), 3).alias(k) for k in ("width", "height", "area")], F.count_if("s.valid").alias("valid"))


def crs_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Coordinate systems of assets in one spelling."""
    return table(spark, d, "assets").groupBy(crs(F.col("crs")).alias("crs")).agg(F.count(F.lit(1)).alias("n"))


def mercator(spark: SparkSession, d: str) -> DataFrame:
    """Customers' places in metres and back."""
    there = placed(table(spark, d, "customer").withColumn("k", F.col("c_custkey") % 170 + 5), "k").select("c_custkey", g.transform(F.col("geom"), "EPSG:4326", "EPSG:3857").alias("m"))
    back = there.select("c_custkey", g.box("m").alias("a"), g.box(g.transform(F.col("m"), "EPSG:3857")).alias("b"))
    return back.select("c_custkey", *[(F.round(c, n) + 0.0).alias(k) for k, c, n in (("x", "a.minx", 3), ("y", "a.miny", 3), ("lon", "b.minx", 6), ("lat", "b.miny", 6))])  # + 0.0: no negative zero


def boundaries_simplified(spark: SparkSession, d: str) -> DataFrame:
    """Boundaries within a hundredth of a degree: their type, whether they got no larger and whether their extents lie within
    that of the extents before."""
    rows = table(spark, d, "boundaries").select("boundary_id", "geom", g.simplify(F.col("geom"), 0.01).alias("less"))
    rows = rows.withColumns({"before": g.box("geom"), "after": g.box("less")})
    near = reduce(lambda a, b: a & b, [F.abs(F.col(f"before.{k}") - F.col(f"after.{k}")) <= 0.01 for k in ("minx", "miny", "maxx", "maxy")])
    return rows.select("boundary_id", (g.geometry_type(F.col("less")) == g.geometry_type(F.col("geom"))).alias("same_type"), (F.length("less") <= F.length("geom")).alias("no_larger"), near.alias("near"))


def schema_union(spark: SparkSession, d: str) -> DataFrame:
    """Two files of one schema with their columns in another order, as one table."""
    a = placed(table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")), "k")
    b = placed(table(spark, d, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), "k")
    return _flat(union_files([a, b]))


_XY = ", c_custkey % 360 - 180 AS cx, c_custkey % 181 - 90 AS cy"
_J = f"SELECT event_id, user_id, event_type, value, cx::DOUBLE AS x, cy::DOUBLE AS y FROM events {{how}} JOIN (SELECT * {_XY} FROM customer) ON user_id::VARCHAR = c_custkey::VARCHAR"
_HOW = {"left": "LEFT", "inner": "INNER", "right": "RIGHT", "outer": "FULL"}

QUERIES = {f"join_{h}": _join(h) for h in _HOW} | {
    f.__name__: f for f in (join_stats_orders, join_stats_empty, join_text_cast, join_duplicate_and_null_keys, join_key_clean, joined_types, joined_extents, bounds_area, crs_normalized, mercator, boundaries_simplified, schema_union)
}
SQL = {f"join_{h}": _J.format(how=s) for h, s in _HOW.items()} | {
    "boundaries_simplified": "SELECT boundary_id, true AS same_type, true AS no_larger, true AS near FROM boundaries",
    "join_stats_orders": f"SELECT count(*) AS row_count, min(cx)::DOUBLE AS minx, min(cy)::DOUBLE AS miny, max(cx)::DOUBLE AS maxx, max(cy)::DOUBLE AS maxy, 'POINT' AS geometry_type FROM orders LEFT JOIN (SELECT * {_XY} FROM customer) ON o_custkey::VARCHAR = c_custkey::VARCHAR",
    "join_stats_empty": "SELECT 0::BIGINT AS row_count, NULL::DOUBLE AS minx, NULL::DOUBLE AS miny, NULL::DOUBLE AS maxx, NULL::DOUBLE AS maxy, 'UNKNOWN' AS geometry_type",
    "join_text_cast": "SELECT count(*) AS n FROM events JOIN customer ON user_id::VARCHAR = lpad(c_custkey::VARCHAR, 6, '0')",
    "join_duplicate_and_null_keys": "WITH t AS (SELECT nullif(l_linenumber, 3) AS k FROM lineitem), s AS (SELECT r_regionkey AS k FROM region UNION ALL SELECT nullif(r_regionkey, 1) FROM region) SELECT t.k AS k, count(*) AS n, count(s.k) AS with_geometry FROM t LEFT JOIN s ON t.k::VARCHAR = s.k::VARCHAR GROUP BY t.k",
    "join_key_clean": "SELECT trim(sa1_code21, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) AS key, count(DISTINCT feature_id) AS features FROM joined WHERE sa1_code21 IS NOT NULL GROUP BY 1",
    "joined_types": """WITH h AS (SELECT hex(geom) AS h FROM joined), c AS (SELECT CASE WHEN h IS NULL OR length(h) < 10 THEN NULL WHEN left(h, 2) = '01' THEN substr(h, 9, 2) || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) WHEN left(h, 2) = '00' THEN substr(h, 3, 8) END AS w FROM h),
t AS (SELECT (('0x' || w)::UBIGINT & 536870911) % 1000 AS t FROM c)
SELECT CASE t WHEN 1 THEN 'POINT' WHEN 2 THEN 'LINESTRING' WHEN 3 THEN 'POLYGON' WHEN 4 THEN 'MULTIPOINT' WHEN 5 THEN 'MULTILINESTRING' WHEN 6 THEN 'MULTIPOLYGON' WHEN 7 THEN 'GEOMETRYCOLLECTION' END AS geometry_type, count(*) AS n FROM t GROUP BY 1""",
    "bounds_area": """WITH b AS (SELECT DISTINCT asset_id, kind, bounds FROM assets WHERE bounds IS NOT NULL), s AS (SELECT kind, bounds.maxx - bounds.minx AS w, bounds.maxy - bounds.miny AS h FROM b)
SELECT kind, count(*) AS n, round(sum(w), 3) AS width, round(sum(h), 3) AS height, round(sum(w * h), 3) AS area, count(*) FILTER (w >= 0 AND h >= 0) AS valid FROM s GROUP BY kind""",
    "crs_normalized": r"SELECT CASE WHEN regexp_full_match(trim(crs), '(?i)EPSG:[0-9]{4,6}') THEN upper(trim(crs)) END AS crs, count(*) AS n FROM assets GROUP BY 1",
    "mercator": "WITH c AS (SELECT c_custkey, (c_custkey % 170 + 5) AS k FROM customer), p AS (SELECT c_custkey, (k % 360 - 180)::DOUBLE AS lon, (k % 181 - 90)::DOUBLE AS lat FROM c) SELECT c_custkey, round(radians(lon) * 6378137.0, 3) + 0.0 AS x, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0, 3) + 0.0 AS y, round(lon, 6) + 0.0 AS lon, round(lat, 6) + 0.0 AS lat FROM p",
    "schema_union": "SELECT k, name, balance, (k % 360 - 180)::DOUBLE AS x, (k % 181 - 90)::DOUBLE AS y FROM (SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance FROM customer UNION ALL BY NAME SELECT s_acctbal AS balance, s_suppkey AS k, s_name AS name FROM supplier)",
}
