"""The parquet tables that the registered queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory, with its own schema; columns are pruned by whoever reads it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
