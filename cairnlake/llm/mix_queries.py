"""Problem 7 on the documents: a mix of sources by tokens of a public tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.lineage import cut_lineage
from cairnlake.llm.bpe import token_counts
from cairnlake.llm.mixing import mixed, shares
from cairnlake.skew import broadcast_if_small
from cairnlake.sources.tables import table


def _sized(spark: SparkSession, d: str) -> DataFrame:
    """Documents of known sources with their tokens; the topic is the family of datasets that a document is about."""
    known, _ = broadcast_if_small(table(spark, d, "mix_targets").select(F.lower(F.trim("source")).alias("source")))
    documents = table(spark, d, "documents").withColumn("source", F.lower(F.trim("source"))).join(known, "source", "left_semi")
    plain = documents.select(
        "doc_id", "source", F.regexp_extract(F.lower(F.trim("lang")), "^[a-z]+", 0).alias("lang"),
        F.regexp_extract("dataset_id", "^([a-z0-9]+_[a-z0-9]+)_", 1).alias("topic"), "text",
    )
    return token_counts(plain, ["doc_id", "source", "lang", "topic"], "text").distinct()


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    """How often each document is used."""
    return mixed(_sized(spark, d), table(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares that the mix reaches, by source."""
    sized, targets = cut_lineage(_sized(spark, d)), table(spark, d, "mix_targets")
    return shares(mixed(sized, targets), sized, targets)


QUERIES = {"p7_mix": p7_mix, "p7_shares": p7_shares}
SQL: dict[str, str] = {}
