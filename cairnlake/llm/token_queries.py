"""Problem 6 on the documents: token ids of the whole corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairnlake.llm.bpe import token_ids
from cairnlake.sources.tables import table


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return token_ids(table(spark, d, "documents"), ["doc_id"], "text")


QUERIES = {"p6_ids": p6_ids}
SQL: dict[str, str] = {}
