"""The join of tabular rows with the geometry of spatial features by key, and what is recorded of its result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.functions.geometry import box, extent, overall_type
from cairnlake.functions.names import identifier
from cairnlake.skew import HOT_ROWS, hot_keys, salted_join

#: Join types and what Spark calls them.
HOW = {"left": "left", "inner": "inner", "right": "right", "outer": "full"}
GEOM = "geom"


def key_join(tabular: DataFrame, spatial: DataFrame, left_key: str, right_key: str | None = None, how: str = "left", geom: str = GEOM, hot: bool = False, rows: int = HOT_ROWS) -> DataFrame:
    """All columns of the tabular rows and the geometry of the features whose key is the same as text.

    Null keys match nothing; repeated keys multiply; features without a row (right, outer) have null tabular columns; "01"
    isn't 1. With ``hot``, keys that hold more than ``rows`` tabular rows are split over tasks, whatever the join. Only the key
    and the geometry of the spatial side are read; Spark broadcasts it where it measures small.
    """
    right_key = right_key or left_key
    if how not in HOW:
        raise ValueError(f"how must be one of {', '.join(HOW)}")
    identifier(left_key, "left_key"), identifier(right_key, "right_key")
    for side, df, key in (("tabular", tabular, left_key), ("spatial", spatial, right_key)):
        if key not in df.columns:
            raise ValueError(f"no column {key!r} in the {side} dataset")
    if geom in tabular.columns:
        raise ValueError(f"the tabular dataset has a column {geom!r} already")
    t = tabular.withColumn("__key", tabular[left_key].cast("string"))
    s = spatial.select(spatial[right_key].cast("string").alias("__key"), spatial[geom].alias(geom, metadata={"geometry": True}))
    full = hot_keys(t, ["__key"], rows) if hot else None
    if full is None:
        return t.join(s, t["__key"] == s["__key"], HOW[how]).select(*[t[c] for c in tabular.columns], s[geom])
    plain = [c for c, kind in tabular.dtypes if "map<" not in kind]  # maps have no hash
    spread = F.struct(*[t[c] for c in plain]) if plain else F.monotonically_increasing_id()
    met = salted_join(t, s, ["__key"], "left" if how in ("left", "outer") else "inner", spread, hot=full).select(*tabular.columns, geom)
    if how in ("left", "inner"):
        return met
    # features without a row: their keys are met with the rows' distinct keys, each once however many rows hold it
    alone = s.join(t.select("__key").distinct(), "__key", "left_anti")
    return met.unionByName(alone.select(geom), allowMissingColumns=True)


def join_stats(joined: DataFrame, geom: str = GEOM) -> DataFrame:
    """One row: rows, extent and geometry type, in one pass."""
    boxed = joined.select(F.col(geom).alias("g")).withColumn("b", box("g"))
    one = boxed.agg(F.count(F.lit(1)).alias("row_count"), extent(F.col("b")).alias("bounds"), overall_type(F.col("g")).alias("geometry_type"))
    return one.select("row_count", "bounds.*", "geometry_type")
