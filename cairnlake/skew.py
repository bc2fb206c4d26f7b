"""Joins that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.lineage import cut_lineage

#: Rows of a key that one task takes; keys with more are split into as many parts as that needs.
HOT_ROWS = 500_000
#: Parts over which rows without a key, which match nothing, are spread.
NULL_PARTS = 256
#: Most bytes of text and keys that a table may hold to be sent to every executor.
BROADCAST_BYTES = 32 << 20


def hot_keys(df: DataFrame, keys: list[str], rows: int = HOT_ROWS) -> DataFrame | None:
    """``keys`` and ``parts`` of every key with more than ``rows`` rows, or None where there are none.

    Counts are combined before the shuffle. There are at most as many such keys as ``rows`` goes into the number of rows.
    """
    counted = df.groupBy(*keys).count().where(F.col("count") > rows)
    counted = counted.where(" and ".join(f"`{k}` is not null" for k in keys))
    found = cut_lineage(counted.select(*keys, F.ceil(F.col("count") / rows).cast("int").alias("parts")))
    return None if found.isEmpty() else found


def with_parts(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the parts of its key as ``hot`` has them, null where the key isn't hot."""
    sent, _ = broadcast_if_small(hot)
    return df.join(sent, keys, "left")


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, spread: Column, rows: int = HOT_ROWS, counted: DataFrame | None = None, hot: DataFrame | None = None) -> DataFrame:
    """Equi-join of ``left`` with ``right``; rows of a hot left key go to several parts by ``spread``.

    A key's parts are in proportion to its rows. The right side's rows of those keys (few: it is meant to be nearly unique
    per key) are repeated per part; left rows without a key match nothing and are spread too. The result is that of the
    plain join; ``how`` is inner, left, left_semi or left_anti. Keys are counted in ``counted`` where that is cheaper to read
    than ``left``; ``hot`` gives the hot keys where they are known.
    """
    hot = hot_keys(left if counted is None else counted, keys, rows) if hot is None else hot
    if hot is None:
        return left.join(right, keys, how)
    name, parts = "__salt", "__parts"
    hot = hot.withColumnRenamed("parts", parts)
    some = F.lit(False)
    for k in keys:
        some = some | left[k].isNull()
    h = F.xxhash64(spread)
    a = with_parts(left.withColumns({name: h, "__null": some}), hot, keys)
    salt = F.when(F.col(parts).isNotNull(), F.pmod(name, parts)).when(F.col("__null"), F.pmod(name, F.lit(NULL_PARTS))).otherwise(F.lit(0))
    a = a.withColumn(name, salt.cast("int")).drop(parts, "__null")
    b = with_parts(right, hot, keys).withColumn(name, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(parts), F.lit(1)) - 1))).drop(parts)
    return a.join(b, [*keys, name], how).drop(name)


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df`` marked for broadcast if its measured size is within the bound, else as it is; ``df`` should be written already.

    Measured as the bytes of its text columns and 16 bytes for each other column of a row.
    """
    text = [c for c, t in df.dtypes if t in ("string", "binary")]
    row = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in text), F.lit(16 * len(df.columns)).cast("long"))
    size = df.agg(F.sum(row)).first()[0] or 0
    return (F.broadcast(df), True) if size <= most else (df, False)
