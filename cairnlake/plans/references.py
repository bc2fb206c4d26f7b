"""Problem 1 on the catalog tables: references that name nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions.text import reference
from cairnlake.operators.orphans import CASE, Catalog, cascade_rounds, orphan_cascade
from cairnlake.sources.tables import table


def month(c: str) -> F.Column:
    return F.date_format(c, "yyyy-MM")


def catalog(spark: SparkSession, d: str) -> Catalog:
    """References, what they may name, deletions and foreign keys of manifests, runs and assets."""
    manifests, runs, assets, logs = (table(spark, d, t) for t in ("manifests", "runs", "assets", "activity_logs"))
    join = F.col("metadata.join_config")
    kinds = ("spatial", "tabular")
    pairs = [F.struct(F.lit(f"{k}_dataset_id").alias("ref_field"), F.lit(f"dataset:{k}").alias("target"), reference(join[f"{k}_dataset_id"]).alias("ref_id")) for k in kinds]
    of_manifests = manifests.where(join.isNotNull()).select(
        F.lit("manifests").alias("ref_table"), F.col("batch_id").alias("ref_key"), F.col("batch_id").alias("record_id"),
        F.inline(F.array(*pairs)), month("ingested_at").alias("period"), F.col("ingested_at").alias("as_of"),
    )
    of_runs = runs.select(
        F.lit("runs").alias("ref_table"), F.col("dagster_run_id").alias("ref_key"), F.col("run_id").alias("record_id"),
        F.lit("asset_ids").alias("ref_field"), F.lit("asset").alias("target"), F.explode(F.transform("asset_ids", reference)).alias("ref_id"),
        month("started_at").alias("period"), F.col("completed_at").alias("as_of"),
    )
    def named(kind, dataset, asset, when):
        """A record may be meant as itself and, by kind, as its dataset."""
        of = F.array(F.struct(F.lit("asset").alias("target"), reference(asset).alias("ref_id")), F.struct(F.concat(F.lit("dataset:"), kind).alias("target"), reference(dataset).alias("ref_id")))
        return [F.inline(F.filter(of, lambda x: x["target"].isNotNull() & x["ref_id"].isNotNull())), *when]

    existing = assets.select(*named(F.when(F.col("kind").isin(*kinds), F.col("kind")), F.col("dataset_id"), F.col("asset_id"), [F.col("created_at")]))
    gone = logs.where((F.col("action") == "delete_file") & (F.col("resource_type") == "asset"))
    kind = F.try_element_at("details", F.lit("kind"))
    removed = gone.select(*named(F.when(kind.isin(*kinds), kind), F.try_element_at("details", F.lit("dataset_id")), F.col("resource_id"), []))
    children = runs.select(
        F.lit("runs").alias("child_table"), F.col("run_id").alias("child_id"), F.col("dagster_run_id").alias("child_key"), month("started_at").alias("child_period"),
        F.lit("manifests").alias("parent_table"), F.col("batch_id").alias("parent_id"),
    ).unionByName(
        assets.select(
            F.lit("assets").alias("child_table"), F.col("asset_id").alias("child_id"), F.col("asset_id").alias("child_key"), month("created_at").alias("child_period"),
            F.lit("runs").alias("parent_table"), F.col("run_id").alias("parent_id"),
        )
    )
    return Catalog(of_manifests.unionByName(of_runs), existing, removed, children)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every reference that names nothing: the first round of the cascade."""
    return next(cascade_rounds(catalog(spark, d))).select(*CASE).distinct()


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans by table, field, state and month, direct and inherited."""
    return orphan_cascade(catalog(spark, d)).groupBy("ref_table", "ref_field", "state", "how", "period").agg(F.count(F.lit(1)).alias("cases"), F.countDistinct("ref_key").alias("records"))


_WS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160)"
_DIRECT = f"""
WITH refs AS (
  SELECT 'manifests' AS ref_table, batch_id AS ref_key, batch_id AS record_id, f.field AS ref_field, f.target AS target,
         nullif(lower(trim(f.id, {_WS})), '') AS ref_id, strftime(ingested_at, '%Y-%m') AS period, ingested_at AS as_of
  FROM (SELECT batch_id, ingested_at, unnest([
          {{'field': 'spatial_dataset_id', 'target': 'dataset:spatial', 'id': metadata.join_config.spatial_dataset_id}},
          {{'field': 'tabular_dataset_id', 'target': 'dataset:tabular', 'id': metadata.join_config.tabular_dataset_id}}]) AS f
        FROM manifests WHERE metadata.join_config IS NOT NULL)
  UNION ALL
  SELECT 'runs', dagster_run_id, run_id, 'asset_ids', 'asset', nullif(lower(trim(id, {_WS})), ''), strftime(started_at, '%Y-%m'), completed_at
  FROM (SELECT dagster_run_id, run_id, started_at, completed_at, unnest(asset_ids) AS id FROM runs)
), here AS (
  SELECT target, id, min(created_at) AS first_seen FROM (
    SELECT 'asset' AS target, lower(trim(asset_id, {_WS})) AS id, created_at FROM assets
    UNION ALL SELECT 'dataset:' || kind, lower(trim(dataset_id, {_WS})), created_at FROM assets WHERE kind IN ('spatial', 'tabular'))
  GROUP BY target, id
), gone AS (
  SELECT DISTINCT target, id FROM (
    SELECT 'asset' AS target, lower(trim(resource_id, {_WS})) AS id FROM activity_logs WHERE action = 'delete_file' AND resource_type = 'asset'
    UNION ALL SELECT 'dataset:' || details['kind'], lower(trim(details['dataset_id'], {_WS})) FROM activity_logs WHERE action = 'delete_file' AND resource_type = 'asset')
), direct AS (
  SELECT DISTINCT ref_table, ref_key, ref_field, ref_id, record_id, period,
         CASE WHEN here.id IS NULL THEN CASE WHEN gone.id IS NULL THEN 'missing' ELSE 'deleted' END WHEN first_seen > as_of THEN 'late' END AS state
  FROM refs LEFT JOIN here ON here.target = refs.target AND here.id = refs.ref_id
            LEFT JOIN gone ON gone.target = refs.target AND gone.id = refs.ref_id
  WHERE ref_id IS NOT NULL
)
"""

QUERIES = {"p1_found": p1_found, "p1_report": p1_report}
SQL = {
    "p1_found": _DIRECT + "SELECT DISTINCT ref_table, ref_key, ref_field, ref_id, state, period FROM direct WHERE state IS NOT NULL",
    "p1_report": _DIRECT
    + """, seed AS (SELECT ref_table, record_id, min(state) AS state FROM direct WHERE state IN ('missing', 'deleted') GROUP BY ALL),
run_seed AS (SELECT record_id AS run_id, state FROM seed WHERE ref_table = 'runs'),
runs1 AS (
  SELECT DISTINCT run_id, dagster_run_id, batch_id, strftime(started_at, '%Y-%m') AS period, state FROM runs
  JOIN (SELECT record_id, state FROM seed WHERE ref_table = 'manifests') ON record_id = batch_id WHERE run_id NOT IN (SELECT run_id FROM run_seed)
), run_state AS (
  SELECT run_id, state, 0 AS far FROM run_seed UNION ALL SELECT run_id, min(state), 1 FROM runs1 GROUP BY run_id
), assets0 AS (
  SELECT DISTINCT asset_id, run_id, strftime(created_at, '%Y-%m') AS period, state, far FROM assets JOIN run_state USING (run_id)
), assets1 AS (SELECT * FROM assets0 QUALIFY far = min(far) OVER (PARTITION BY asset_id)), every AS (
  SELECT ref_table, ref_key, ref_field, ref_id, state, period, 'direct' AS how FROM (SELECT DISTINCT ref_table, ref_key, ref_field, ref_id, record_id, state, period FROM direct WHERE state IS NOT NULL)
  UNION ALL SELECT 'runs', dagster_run_id, 'manifests', batch_id, state, period, 'inherited' FROM runs1
  UNION ALL SELECT 'assets', asset_id, 'runs', run_id, state, period, 'inherited' FROM assets1
)
SELECT ref_table, ref_field, state, how, period, count(*) AS cases, count(DISTINCT ref_key) AS records FROM every GROUP BY ALL""",
}
