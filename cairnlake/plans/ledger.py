"""Queries on the catalog tables: lists, versions, lineage, search, rules, audit, routing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions import names
from cairnlake.lineage import shared_dir
from cairnlake.operators import catalog as c
from cairnlake.operators import manifests as m
from cairnlake.sources.tables import table
from cairnlake.streaming.manifests import windowed_activity


def _assets(spark, d):
    return table(spark, d, "assets").drop("header_mapping")


def _one(spark, d, name, *keys):
    return table(spark, d, name).dropDuplicates(list(keys))


def list_assets(spark: SparkSession, d: str) -> DataFrame:
    """The newest spatial assets, a page of fifty."""
    return c.list_assets(table(spark, d, "assets"), "spatial")


def list_manifests(spark: SparkSession, d: str) -> DataFrame:
    """The newest manifests that failed, a page of fifty."""
    return c.list_manifests(table(spark, d, "manifests"), "failure")


def list_runs(spark: SparkSession, d: str) -> DataFrame:
    """The newest runs, a page of twenty-five."""
    return c.list_runs(table(spark, d, "runs")).select("run_id", "batch_id", "job_name", "status", "started_at")


def activity_page(spark: SparkSession, d: str) -> DataFrame:
    """The second page of downloads."""
    return c.list_activity(table(spark, d, "activity_logs"), 50, 50, action="download_asset", resource_type="asset").select("log_id", "logged_at", "username", "resource_id")


def latest_versions(spark: SparkSession, d: str) -> DataFrame:
    """The last version of every dataset."""
    return c.latest(table(spark, d, "assets").select("dataset_id", "version", "asset_id", "kind", "created_at").distinct())


def next_versions(spark: SparkSession, d: str) -> DataFrame:
    """The number that every dataset's next version takes."""
    return c.next_versions(table(spark, d, "assets"))


def all_versions(spark: SparkSession, d: str) -> DataFrame:
    """Versions of the dataset that has most."""
    assets = table(spark, d, "assets").select("dataset_id", "version", "s3_key", "created_at", "content_hash").distinct()
    most = assets.groupBy("dataset_id").count().orderBy(F.desc("count"), "dataset_id").limit(1)
    return assets.join(F.broadcast(most), "dataset_id").select("version", "s3_key", "created_at", "content_hash")  # one row


def next_reruns(spark: SparkSession, d: str) -> DataFrame:
    """The number of every batch's next run."""
    return c.next_reruns(table(spark, d, "manifests"))


def repeated_contents(spark: SparkSession, d: str) -> DataFrame:
    """Contents that more than one asset holds."""
    out = table(spark, d, "assets").select("asset_id", names.content_hash(F.col("content_hash")).alias("content_hash")).distinct().groupBy("content_hash").agg(F.count(F.lit(1)).alias("assets"))
    return out.where("assets > 1")


def _edges(spark, d):
    return c.lineage_edges(table(spark, d, "assets"), table(spark, d, "runs"), table(spark, d, "manifests"))


def lineage(spark: SparkSession, d: str) -> DataFrame:
    """Edges from assets to those joined of them."""
    return _edges(spark, d)


def _plain(spark, d):
    return table(spark, d, "assets").select("asset_id", "dataset_id", "version", "kind", "metadata.title").distinct()


def lineage_parents(spark: SparkSession, d: str) -> DataFrame:
    """Every joined asset with what it came from."""
    return c.parents(_edges(spark, d), _plain(spark, d)).drop("transformation")


def lineage_children(spark: SparkSession, d: str) -> DataFrame:
    """Every asset with what was made from it."""
    return c.children(_edges(spark, d), _plain(spark, d)).drop("transformation")


def lineage_graph(spark: SparkSession, d: str) -> DataFrame:
    """Nodes around all joined assets."""
    assets = table(spark, d, "assets").select("asset_id", "dataset_id", "version", "kind", F.struct("metadata.title").alias("metadata")).distinct()
    return c.lineage_graph(_edges(spark, d), assets, assets.where("kind = 'joined'"))[0]


def keyword_search(spark: SparkSession, d: str) -> DataFrame:
    """Assets about heat or shade, not drafts: the best twenty."""
    return c.search_assets(_one(spark, d, "assets", "asset_id"), "heat shade -draft").select("asset_id", "score")


def phrase_search(spark: SparkSession, d: str) -> DataFrame:
    """Tabular assets about land titles: the best twenty."""
    return c.search_assets(_one(spark, d, "assets", "asset_id"), '"land title" easement', "tabular").select("asset_id", "score")


def asset_faults(spark: SparkSession, d: str) -> DataFrame:
    """Assets that break a rule of their kind."""
    return c.asset_faults(table(spark, d, "assets"))


def manifest_faults(spark: SparkSession, d: str) -> DataFrame:
    """Rules that manifests break, and how many break each."""
    rows = table(spark, d, "manifests").select("batch_id", F.struct("batch_id", "uploader", "intent", "files", "metadata").alias("m"))
    return rows.select("batch_id", F.explode(m.faults(F.col("m"))).alias("fault")).groupBy("fault").agg(F.countDistinct("batch_id").alias("manifests"))


def run_requests(spark: SparkSession, d: str) -> DataFrame:
    """What runs are asked for, by lane."""
    rows = table(spark, d, "manifests").select(F.struct("batch_id", "uploader", "intent", "files", "metadata").alias("manifest"), F.concat(F.lit("manifests/"), "batch_id", F.lit(".json")).alias("manifest_key"))
    return m.run_requests(rows).select("run_key", "lane", "partition_key", F.col("tags")["source"].alias("source"), F.col("tags")["manifest_archive_key"].alias("archive_key"))


def audit_first(spark: SparkSession, d: str) -> DataFrame:
    """The first entry of every action on a resource."""
    logs = table(spark, d, "activity_logs").select("log_id", "logged_at", "username", "action", "resource_type", "resource_id").distinct()
    return c.first_of(logs, "action", "resource_type", "resource_id")


def run_states(spark: SparkSession, d: str) -> DataFrame:
    """Current state of runs by the events logged of them."""
    logs = table(spark, d, "activity_logs").where("resource_type = 'run'").select("log_id", F.col("resource_id").alias("run"), F.regexp_replace(F.regexp_replace("action", "^run_", ""), "started", "running").alias("status"), F.col("logged_at").alias("at"), F.lit(None).cast("string").alias("error_message")).distinct()
    return c.current_state(logs, "run").drop("error_message")


def linked_assets(spark: SparkSession, d: str) -> DataFrame:
    """Runs with all assets that name them added to their list; how many that makes."""
    runs = table(spark, d, "runs").select("run_id", "asset_ids").dropDuplicates(["run_id"])
    return c.link_assets(runs, table(spark, d, "assets").select("run_id", "asset_id")).select("run_id", F.size("asset_ids").alias("assets"))


def activity_hours(spark: SparkSession, d: str) -> DataFrame:
    """Entries per hour and action."""
    out = windowed_activity(table(spark, d, "activity_logs").select("log_id", "logged_at", "action").distinct())
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "action", "entries")


def activity_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same hours from a stream of the log: entries that come again within a day count once, and an hour comes out when
    it can't change any more, a day after its end. Written to the shared folder and read back."""
    base = f"{shared_dir(spark)}/stream_{uuid.uuid4().hex}"
    logs = spark.readStream.schema(table(spark, d, "activity_logs").schema).parquet(d + "/activity_logs.parque[t]")
    once = logs.select("log_id", F.col("logged_at").cast("timestamp").alias("logged_at"), "action").withWatermark("logged_at", "1 day").dropDuplicatesWithinWatermark(["log_id"])
    query = windowed_activity(once).writeStream.outputMode("append").format("parquet").option("checkpointLocation", base + "/checkpoint").option("path", base + "/out").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(base + "/out").select(F.col("start").cast("timestamp_ntz").alias("start"), "action", "entries")


def file_paths(spark: SparkSession, d: str) -> DataFrame:
    """Files of manifests: bucket, folder depth, format and content type by extension."""
    paths = table(spark, d, "manifests").select(F.explode("files.path").alias("path")).distinct()
    both = paths.withColumn("b", names.bucket_and_key(names.object_path(F.col("path"))))
    return both.select("path", F.col("b.bucket").alias("bucket"), F.col("b.key").alias("key"), names.virtual_path(F.col("path")).alias("virtual_path"), names.file_format(F.col("path")).alias("format"), names.content_type(F.col("path")).alias("content_type"))


def run_schemas(spark: SparkSession, d: str) -> DataFrame:
    """Scratch names of runs, and the runs read back from them."""
    there = table(spark, d, "runs").select("dagster_run_id").distinct().withColumn("schema_name", names.schema_of_run(F.col("dagster_run_id")))
    return there.withColumn("run_again", names.run_of_schema(F.col("schema_name")))


def clean_keywords(spark: SparkSession, d: str) -> DataFrame:
    """Keywords of manifests, stripped, each once and in order."""
    rows = table(spark, d, "manifests").select("batch_id", F.array_join(names.keywords(F.col("metadata.keywords")), "|").alias("keywords"))
    return rows.distinct()


def unseen_manifests(spark: SparkSession, d: str) -> DataFrame:
    """Manifests that no run has taken up."""
    return table(spark, d, "manifests").select("batch_id").distinct().join(table(spark, d, "runs").select("batch_id").distinct(), "batch_id", "left_anti")


_A = "(SELECT DISTINCT ON (asset_id) * FROM assets ORDER BY asset_id)"
_M = "(SELECT DISTINCT ON (batch_id) * FROM manifests ORDER BY batch_id)"
_EDGES = """e AS (
  SELECT x.asset_id AS target_asset_id, k.kind AS role, arg_max(p.asset_id, (p.version, p.asset_id)) AS source_asset_id
  FROM (SELECT DISTINCT asset_id, run_id FROM assets WHERE kind = 'joined') x JOIN (SELECT DISTINCT run_id, batch_id FROM runs) r USING (run_id)
  JOIN (SELECT DISTINCT ON (batch_id) batch_id, ingested_at, metadata.join_config AS j FROM manifests WHERE metadata.join_config IS NOT NULL ORDER BY batch_id) m USING (batch_id)
  CROSS JOIN (VALUES ('spatial'), ('tabular')) k(kind)
  JOIN assets p ON p.kind = k.kind AND p.dataset_id = lower(trim(CASE k.kind WHEN 'spatial' THEN j.spatial_dataset_id ELSE j.tabular_dataset_id END))
   AND coalesce((CASE k.kind WHEN 'spatial' THEN j.spatial_version ELSE j.tabular_version END) = p.version, p.created_at <= ingested_at)
  GROUP BY ALL)"""
_LANE = "CASE intent WHEN 'ingest_vector' THEN 'spatial' WHEN 'ingest_raster' THEN 'spatial' WHEN 'ingest_tabular' THEN 'tabular' WHEN 'join_datasets' THEN 'join' ELSE 'ingest' END"
_PART = "coalesce(nullif(trim(metadata.tags['dataset_id']), ''), 'dataset_' || left(sha256(batch_id), 12))"
_WORDS = r"list_filter(flatten(list_transform(coalesce(metadata.keywords, []), lambda k: string_split_regex(lower(coalesce(k, '')), '[^\p{L}\p{N}]+'))), lambda w: w <> '')"
_WHOLE = r"array_to_string(list_transform(coalesce(metadata.keywords, []), lambda k: ' ' || trim(regexp_replace(lower(coalesce(k, '')), '[^\p{L}\p{N}]+', ' ', 'g')) || ' '), chr(10))"

QUERIES = {
    f.__name__: f
    for f in (
        list_assets, list_manifests, list_runs, activity_page, latest_versions, next_versions, all_versions, next_reruns, repeated_contents, lineage, lineage_parents, lineage_children, lineage_graph,
        keyword_search, phrase_search, asset_faults, manifest_faults, run_requests, audit_first, run_states, linked_assets, activity_hours, activity_stream, file_paths, run_schemas, clean_keywords,
        unseen_manifests,
    )
}
SQL = {
    "list_assets": f"SELECT asset_id, dataset_id, version, kind, format, metadata.title AS title, created_at FROM {_A} WHERE kind = 'spatial' ORDER BY created_at DESC NULLS LAST, asset_id LIMIT 50",
    "list_manifests": f"SELECT batch_id, uploader, intent, status, coalesce(metadata.project, '') AS project, coalesce(len(files), 0) AS file_count, ingested_at, completed_at FROM {_M} WHERE status = 'failure' ORDER BY ingested_at DESC NULLS LAST, batch_id LIMIT 50",
    "list_runs": "SELECT run_id, batch_id, job_name, status, started_at FROM (SELECT DISTINCT ON (run_id) * FROM runs ORDER BY run_id) ORDER BY started_at DESC NULLS LAST, run_id LIMIT 25",
    "activity_page": "SELECT log_id, logged_at, username, resource_id FROM (SELECT DISTINCT ON (log_id) * FROM activity_logs ORDER BY log_id) WHERE action = 'download_asset' AND resource_type = 'asset' ORDER BY logged_at DESC NULLS LAST, log_id LIMIT 50 OFFSET 50",
    "latest_versions": "SELECT dataset_id, version, asset_id, kind, created_at FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY version DESC, asset_id DESC) AS r FROM (SELECT DISTINCT dataset_id, version, asset_id, kind, created_at FROM assets)) WHERE r = 1",
    "next_versions": "SELECT dataset_id, max(version) + 1 AS next_version FROM assets GROUP BY dataset_id",
    "all_versions": "WITH a AS (SELECT DISTINCT dataset_id, version, s3_key, created_at, content_hash FROM assets) SELECT version, s3_key, created_at, content_hash FROM a WHERE dataset_id = (SELECT dataset_id FROM a GROUP BY dataset_id ORDER BY count(*) DESC, dataset_id LIMIT 1)",
    "next_reruns": r"SELECT regexp_replace(batch_id, '_v\d+$', '') AS base, greatest(coalesce(max(try_cast(regexp_extract(batch_id, '_v(\d+)$', 1) AS INT)), 1), 1) + 1 AS next_run FROM manifests GROUP BY 1",
    "repeated_contents": "SELECT lower(trim(content_hash)) AS content_hash, count(DISTINCT asset_id) AS assets FROM assets GROUP BY 1 HAVING count(DISTINCT asset_id) > 1",
    "lineage": f"WITH {_EDGES} SELECT source_asset_id, target_asset_id, 'spatial_join' AS transformation, role FROM e",
    "lineage_parents": f"WITH {_EDGES} SELECT target_asset_id, a.asset_id, a.dataset_id, a.version, a.kind, a.metadata.title AS title FROM e JOIN {_A} a ON a.asset_id = e.source_asset_id",
    "lineage_children": f"WITH {_EDGES} SELECT source_asset_id, a.asset_id, a.dataset_id, a.version, a.kind, a.metadata.title AS title FROM e JOIN {_A} a ON a.asset_id = e.target_asset_id",
    "lineage_graph": f"WITH {_EDGES} SELECT asset_id AS id, dataset_id, CASE WHEN length(metadata.title) > 50 THEN left(metadata.title, 50) || '...' ELSE coalesce(metadata.title, dataset_id) END AS title, kind, version, kind = 'joined' AS is_root FROM {_A} WHERE kind = 'joined' OR asset_id IN (SELECT source_asset_id FROM e)",
    "keyword_search": f"SELECT asset_id, list_contains(w, 'heat')::INT + list_contains(w, 'shade')::INT AS score FROM (SELECT asset_id, {_WORDS} AS w FROM {_A}) WHERE (list_contains(w, 'heat') OR list_contains(w, 'shade')) AND NOT list_contains(w, 'draft') ORDER BY score DESC, asset_id LIMIT 20",
    "phrase_search": f"SELECT asset_id, list_contains(w, 'easement')::INT + 1 AS score FROM (SELECT asset_id, kind, {_WORDS} AS w, {_WHOLE} AS t FROM {_A}) WHERE kind = 'tabular' AND contains(t, ' land title ') ORDER BY score DESC, asset_id LIMIT 20",
    "asset_faults": """SELECT DISTINCT asset_id, fault FROM (
 SELECT asset_id, unnest([CASE WHEN kind NOT IN ('spatial', 'tabular', 'joined') OR kind IS NULL THEN 'kind is unknown' END, CASE WHEN kind = 'tabular' AND crs IS NOT NULL THEN 'a tabular asset has a crs' END,
  CASE WHEN kind = 'tabular' AND bounds IS NOT NULL THEN 'a tabular asset has bounds' END, CASE WHEN kind IN ('spatial', 'joined') AND crs IS NULL THEN 'a spatial asset has no crs' END,
  CASE WHEN kind IN ('spatial', 'joined') AND metadata.geometry_type IS NULL THEN 'a spatial asset has no geometry type' END, CASE WHEN metadata.column_schema IS NULL THEN 'there is no column schema' END,
  CASE WHEN coalesce(version, 0) < 1 THEN 'the version is below 1' END, CASE WHEN bounds.minx > bounds.maxx OR bounds.miny > bounds.maxy THEN 'bounds are reversed' END]) AS fault FROM assets) WHERE fault IS NOT NULL""",
    "manifest_faults": r"""WITH m AS (SELECT *, coalesce(len(files), 0) AS n, metadata.join_config AS j, list_transform(files, lambda f: regexp_replace(trim(f.path), '^s3://', '')) AS p FROM manifests)
SELECT fault, count(DISTINCT batch_id) AS manifests FROM (SELECT batch_id, unnest([
  CASE WHEN uploader IS NULL THEN 'missing uploader' END, CASE WHEN intent IS NULL THEN 'missing intent' END, CASE WHEN files IS NULL THEN 'missing files' END, CASE WHEN metadata IS NULL THEN 'missing metadata' END,
  CASE WHEN metadata IS NOT NULL AND metadata.title IS NULL THEN 'missing metadata.title' END, CASE WHEN metadata IS NOT NULL AND metadata.description IS NULL THEN 'missing metadata.description' END,
  CASE WHEN metadata IS NOT NULL AND metadata.source IS NULL THEN 'missing metadata.source' END, CASE WHEN metadata IS NOT NULL AND metadata.license IS NULL THEN 'missing metadata.license' END,
  CASE WHEN metadata IS NOT NULL AND metadata.attribution IS NULL THEN 'missing metadata.attribution' END,
  CASE WHEN len(list_filter(files, lambda f: coalesce(f.type NOT IN ('raster', 'vector', 'tabular'), true))) > 0 THEN 'unknown file type' END,
  CASE WHEN len(list_filter(p, lambda x: x IS NULL OR NOT regexp_matches(x, '^[a-z0-9][a-z0-9.-]{1,61}[a-z0-9]/.'))) > 0 THEN 'invalid path' END,
  CASE WHEN len(list_filter(files, lambda f: f.format IS NULL)) > 0 THEN 'missing file format' END, CASE WHEN len(list_distinct(p)) < len(p) THEN 'duplicate paths' END,
  CASE WHEN intent = 'ingest_tabular' AND len(list_filter(files, lambda f: f.type IN ('vector', 'raster'))) > 0 THEN 'non-tabular file in ingest_tabular' END,
  CASE WHEN intent = 'join_datasets' AND n > 0 THEN 'files in join_datasets' END, CASE WHEN intent = 'join_datasets' AND j IS NULL THEN 'no join_config in join_datasets' END,
  CASE WHEN intent NOT IN ('join_datasets', 'ingest_tabular') AND len(list_filter(files, lambda f: f.type = 'tabular')) > 0 THEN 'tabular file in another intent' END,
  CASE WHEN intent <> 'join_datasets' AND n = 0 THEN 'no files' END, CASE WHEN coalesce(least(j.spatial_version, j.tabular_version), 1) < 1 THEN 'version below 1' END,
  CASE WHEN j IS NOT NULL AND j.how NOT IN ('left', 'inner', 'right', 'outer') THEN 'unknown join type' END,
  CASE WHEN j IS NOT NULL AND j.spatial_dataset_id IS NULL THEN 'missing join_config.spatial_dataset_id' END, CASE WHEN j IS NOT NULL AND j.tabular_dataset_id IS NULL THEN 'missing join_config.tabular_dataset_id' END,
  CASE WHEN j IS NOT NULL AND j.left_key IS NULL THEN 'missing join_config.left_key' END]) AS fault FROM m) WHERE fault IS NOT NULL GROUP BY fault""",
    "run_requests": f"""SELECT DISTINCT ON (run_key) run_key, lane, partition_key, source, archive_key FROM (SELECT CASE WHEN lane = 'ingest' THEN 'ingest:' || batch_id ELSE lane || '_asset:' || batch_id || ':' || part END AS run_key, lane, CASE WHEN lane <> 'ingest' THEN part END AS partition_key, source, 'archive/manifests/' || batch_id || '.json' AS archive_key
 FROM (SELECT batch_id, {_LANE} AS lane, {_PART} AS part, coalesce(nullif(metadata.tags['ingestion_source'], ''), nullif(metadata.tags['source'], ''), 'unknown') AS source FROM manifests))""",
    "audit_first": "SELECT log_id, logged_at, username, action, resource_type, resource_id FROM (SELECT *, row_number() OVER (PARTITION BY action, resource_type, resource_id ORDER BY logged_at, log_id) AS r FROM (SELECT DISTINCT log_id, logged_at, username, action, resource_type, resource_id FROM activity_logs)) WHERE r = 1",
    "run_states": "WITH e AS (SELECT DISTINCT log_id, resource_id AS run, replace(replace(action, 'run_', ''), 'started', 'running') AS status, logged_at AS t FROM activity_logs WHERE resource_type = 'run') SELECT run, arg_max(status, (t, status)) AS status, max(t) AS updated_at, max(t) FILTER (status IN ('success', 'failure', 'canceled')) AS completed_at FROM e GROUP BY run",
    "linked_assets": "WITH r AS (SELECT DISTINCT ON (run_id) run_id, asset_ids FROM runs ORDER BY run_id), a AS (SELECT run_id, list(DISTINCT asset_id) AS more FROM assets GROUP BY run_id) SELECT run_id, len(list_distinct(list_concat(coalesce(asset_ids, []), coalesce(more, [])))) + (len(list_filter(coalesce(asset_ids, []), lambda x: x IS NULL)) > 0)::INT AS assets FROM r LEFT JOIN a USING (run_id)",
    "activity_hours": "SELECT date_trunc('hour', logged_at) AS start, action, count(*) AS entries FROM (SELECT DISTINCT log_id, logged_at, action FROM activity_logs) GROUP BY ALL",
    "activity_stream": "WITH o AS (SELECT DISTINCT log_id, logged_at, action FROM activity_logs) SELECT date_trunc('hour', logged_at) AS start, action, count(*) AS entries FROM o WHERE date_trunc('hour', logged_at) + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(logged_at)) FROM o) - INTERVAL 1 DAY GROUP BY ALL",
    "file_paths": r"""SELECT path, CASE WHEN ok THEN regexp_extract(bare, '^([^/]+)/', 1) END AS bucket, CASE WHEN ok THEN regexp_replace(bare, '^[^/]+/', '') END AS key, regexp_replace(path, '^s3://', '/vsis3/') AS virtual_path,
 CASE ext WHEN 'geojson' THEN 'GeoJSON' WHEN 'json' THEN 'GeoJSON' WHEN 'shp' THEN 'SHP' WHEN 'gpkg' THEN 'GPKG' WHEN 'tif' THEN 'GTiff' WHEN 'tiff' THEN 'GTiff' WHEN 'csv' THEN 'CSV' WHEN 'parquet' THEN 'Parquet' ELSE 'GeoJSON' END AS format,
 CASE ext WHEN 'parquet' THEN 'application/vnd.apache.parquet' WHEN 'tif' THEN 'image/tiff' WHEN 'tiff' THEN 'image/tiff' WHEN 'json' THEN 'application/json' WHEN 'geojson' THEN 'application/geo+json' WHEN 'gpkg' THEN 'application/geopackage+sqlite3' ELSE 'application/octet-stream' END AS content_type
FROM (SELECT *, regexp_matches(bare, '^[a-z0-9][a-z0-9.-]{1,61}[a-z0-9]/.') AS ok FROM (SELECT DISTINCT path, regexp_replace(trim(path), '^s3://', '') AS bare, regexp_extract(lower(path), '\.([^./]*)$', 1) AS ext FROM (SELECT unnest(files).path AS path FROM manifests)))""",
    "run_schemas": "SELECT DISTINCT dagster_run_id, 'proc_' || replace(dagster_run_id, '-', '_') AS schema_name, dagster_run_id AS run_again FROM runs",
    "clean_keywords": r"""WITH k AS (SELECT batch_id, list_filter(list_transform(metadata.keywords, lambda k: trim(k, ' ' || chr(9) || chr(10) || chr(13) || chr(160))), lambda k: k <> '') AS ks FROM manifests)
SELECT DISTINCT batch_id, array_to_string(list_filter(ks, lambda x, i: list_position(ks, x) = i), '|') AS keywords FROM k""",
    "unseen_manifests": "SELECT DISTINCT batch_id FROM manifests WHERE batch_id NOT IN (SELECT batch_id FROM runs WHERE batch_id IS NOT NULL)",
}
