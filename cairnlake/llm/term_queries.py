"""Problems 3 and 4 on the manifests: terms and pairs of keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.llm.pairs import item_pairs, notable
from cairnlake.llm.terms import marked, postings, term_counts, vertical_index
from cairnlake.sources.tables import table


def _postings(spark: SparkSession, d: str, *fields: str) -> DataFrame:
    columns = {"keywords": F.col("metadata.keywords"), "intent": F.array("intent"), "license": F.array("metadata.license")}
    return postings(table(spark, d, "manifests"), "batch_id", {f: columns[f] for f in fields})


def p3_terms(spark: SparkSession, d: str) -> DataFrame:
    """Every term with its occurrences, its manifests and its mark."""
    out = marked(term_counts(vertical_index(_postings(spark, d, "keywords", "intent", "license"))))
    return out.select("field", "term", "occurrences", F.col("records").alias("manifests"), "mark")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Terms that are too rare or too common."""
    return p3_terms(spark, d).where("mark is not null").select("field", "term", "mark")


def _baskets(spark: SparkSession, d: str) -> DataFrame:
    return _postings(spark, d, "keywords").select("key", F.col("term").alias("item"))


def p4_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of keywords, how often they occur together and how much more often than chance."""
    out = item_pairs(_baskets(spark, d))
    return out.select(F.col("item_a").alias("keyword_a"), F.col("item_b").alias("keyword_b"), "together", F.col("count_a").alias("manifests_a"), F.col("count_b").alias("manifests_b"), F.round("lift", 6).alias("lift"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The notable pairs."""
    return notable(item_pairs(_baskets(spark, d), least=5)).select(F.col("item_a").alias("keyword_a"), F.col("item_b").alias("keyword_b"))


_TERMS = r"""
WITH one AS (SELECT DISTINCT batch_id, metadata.keywords AS keywords, intent, metadata.license AS license FROM manifests WHERE batch_id IS NOT NULL),
said AS (
  SELECT batch_id, 'keywords' AS field, unnest(keywords) AS value FROM one
  UNION ALL SELECT batch_id, 'intent', intent FROM one UNION ALL SELECT batch_id, 'license', license FROM one
), terms AS (
  SELECT batch_id, field, lower(trim(regexp_replace(value, '\s+', ' ', 'g'))) AS term FROM said WHERE trim(regexp_replace(value, '\s+', ' ', 'g')) <> ''
)
"""
_MARKED = _TERMS + """, n AS (SELECT field, count(DISTINCT batch_id) AS n FROM terms GROUP BY field),
c AS (SELECT field, term, count(*) AS occurrences, count(DISTINCT batch_id) AS manifests FROM terms GROUP BY field, term),
m AS (SELECT field, term, occurrences, manifests, CASE WHEN manifests < 3 THEN 'rare' WHEN manifests > 0.25 * n THEN 'common' END AS mark FROM c JOIN n USING (field))
"""
_PAIRS = _TERMS + """, b AS (SELECT DISTINCT batch_id, term FROM terms WHERE field = 'keywords'),
k AS (SELECT term, count(*) AS n FROM b GROUP BY term), t AS (SELECT count(DISTINCT batch_id) AS n FROM b),
p AS (
  SELECT x.term AS keyword_a, y.term AS keyword_b, count(*) AS together FROM b x JOIN b y ON x.batch_id = y.batch_id AND x.term < y.term GROUP BY ALL
), q AS (
  SELECT keyword_a, keyword_b, together, ka.n AS manifests_a, kb.n AS manifests_b, t.n AS n
  FROM p JOIN k ka ON ka.term = keyword_a JOIN k kb ON kb.term = keyword_b CROSS JOIN t
)
"""

QUERIES = {"p3_found": p3_found, "p3_terms": p3_terms, "p4_found": p4_found, "p4_pairs": p4_pairs}
SQL = {
    "p3_found": _MARKED + "SELECT field, term, mark FROM m WHERE mark IS NOT NULL",
    "p3_terms": _MARKED + "SELECT * FROM m",
    "p4_found": _PAIRS + "SELECT keyword_a, keyword_b FROM q WHERE together >= 5 AND together * n >= 4 * manifests_a * manifests_b",
    "p4_pairs": _PAIRS + "SELECT keyword_a, keyword_b, together, manifests_a, manifests_b, round(together * n / (manifests_a::DOUBLE * manifests_b), 6) AS lift FROM q",
}
