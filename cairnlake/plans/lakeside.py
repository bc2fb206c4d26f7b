"""Queries that go by way of files: written to the shared folder, read, ingested and looked at again."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions import headers
from cairnlake.functions.geometry import box
from cairnlake.functions.types import canonical
from cairnlake.lineage import shared_dir
from cairnlake.operators import catalog as c
from cairnlake.operators import manifests as m
from cairnlake.operators.drift import records_of
from cairnlake.plans import ledger
from cairnlake.plans.pipelines import Lake, ingest_tabular, ingest_vector, join_datasets
from cairnlake.sinks import lake as sink
from cairnlake.sources import files
from cairnlake.sources.tables import table
from cairnlake.streaming.manifests import manifest_stream, run_events

META = {"title": "t", "description": "", "keywords": ["k"], "source": "s", "license": "l", "attribution": ""}


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/files_{uuid.uuid4().hex}"


def _customers_csv(spark: SparkSession, d: str, base: str) -> str:
    """All customers under untidy headers; NA among the numbers of nation 3 and the texts of one segment."""
    nation, segment = F.col("c_nationkey").cast("string"), F.col("c_mktsegment")
    rows = table(spark, d, "customer").select(
        F.concat(F.lit(" "), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("Customer Key"), F.col("c_acctbal").alias("Balance (AUD)"),
        F.when(segment == "BUILDING", F.lit("NA")).otherwise(segment).alias("2nd Segment"), F.when(nation == "3", F.lit("NA")).otherwise(nation).alias("Nation"),
    )
    rows.write.option("header", True).csv(f"{base}/customers")
    return f"{base}/customers"


def _suppliers_geojson(spark: SparkSession, d: str, base: str) -> str:
    """All suppliers as lines of features."""
    rows = table(spark, d, "supplier").withColumns({"x": F.expr("cast(s_suppkey % 360 - 180 as double)"), "y": F.expr("cast(s_suppkey % 181 - 90 as double)")})
    properties = F.struct(F.col("s_suppkey").alias("id"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("Code"), F.col("s_acctbal").alias("balance"), (F.col("s_nationkey") == 3).alias("third"))
    geometry = F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates"))
    rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry"))).alias("value")).write.text(f"{base}/suppliers")
    return f"{base}/suppliers"


def csv_rows(spark: SparkSession, d: str) -> DataFrame:
    """A CSV file under normalized names and inferred types, its key as text."""
    return files.read_csv(spark, _customers_csv(spark, d, _folder(spark)), "Customer Key")[0]


def geojson_rows(spark: SparkSession, d: str) -> DataFrame:
    """Lines of GeoJSON features with the types that the JSON says."""
    df = files.read_geojson(spark, _suppliers_geojson(spark, d, _folder(spark)))
    return df.withColumn("b", box("geom")).select("id", F.col("Code").alias("code"), "balance", "third", F.col("b.minx").alias("x"), F.col("b.miny").alias("y"))


def _ingested(spark: SparkSession, d: str) -> tuple[Lake, list[dict]]:
    base = _folder(spark)
    lake = Lake(spark, f"{base}/lake")
    tags = lambda name: {**META, "tags": {"dataset_id": name}}
    config = {"spatial_dataset_id": "suppliers", "tabular_dataset_id": "customers", "left_key": "customer_key", "right_key": "Code", "how": "left"}
    first = ingest_tabular(lake, {"intent": "ingest_tabular", "files": [{"path": _customers_csv(spark, d, base), "format": "CSV"}], "metadata": {**tags("customers"), "join_config": {**config, "left_key": "Customer Key"}}}, "r1")
    shapes = {"intent": "ingest_vector", "files": [{"path": _suppliers_geojson(spark, d, base), "format": "GeoJSON"}], "metadata": tags("suppliers")}
    second, third = ingest_vector(lake, shapes, "r2"), ingest_vector(lake, shapes, "r3")
    last = join_datasets(lake, {"intent": "join_datasets", "files": [], "metadata": {**tags("both"), "join_config": config}}, "r4")
    return lake, [first, second, third, last]


def ingested_assets(spark: SparkSession, d: str) -> DataFrame:
    """What the catalog says of a table, two versions of features, and their join."""
    lake, _ = _ingested(spark, d)
    return lake.assets.select("dataset_id", "version", "kind", "format", "crs", "s3_key", "run_id", F.col("metadata.geometry_type").alias("geometry_type"), "bounds.*", F.length("content_hash").alias("hash_length"))


def ingested_columns(spark: SparkSession, d: str) -> DataFrame:
    """The recorded columns of those assets."""
    lake, _ = _ingested(spark, d)
    return lake.assets.select("dataset_id", "version", F.explode("metadata.column_schema").alias("name", "c")).select("dataset_id", "version", "name", "c.title", "c.type_name")


def ingested_lineage(spark: SparkSession, d: str) -> DataFrame:
    """What their join was made of."""
    lake, _ = _ingested(spark, d)
    a = lake.assets.select(F.col("asset_id").alias("source_asset_id"), "dataset_id", "version")
    return lake.lineage.join(a, "source_asset_id").select("dataset_id", "version", "transformation", F.col("parameters")["role"].alias("role"), F.col("parameters")["how"].alias("how"))


def joined_version(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the joined version as they lie in the lake."""
    _, written = _ingested(spark, d)
    back = spark.read.parquet(written[-1]["path"]).withColumn("b", box("geom"))
    return back.select("customer_key", "balance_aud", "nation", F.col("b.minx").alias("x"), F.col("b.miny").alias("y"))


def footers(spark: SparkSession, d: str) -> DataFrame:
    """The geo footer of boundaries written as GeoParquet, what is wrong with it and with that of plain Parquet."""
    base = _folder(spark)
    boundaries = table(spark, d, "boundaries")
    sink.with_footer(boundaries, f"{base}/geo", sink.geo_metadata(kind="POLYGON"))
    boundaries.write.parquet(f"{base}/plain")
    rows = []
    for k in ("geo", "plain"):
        said = sink.footer_of(f"{base}/{k}")
        column = (said or {}).get("columns", {}).get("geom", {})
        rows.append((k, (said or {}).get("version"), (said or {}).get("primary_column"), column.get("encoding"), ",".join(column.get("geometry_types", [])), "; ".join(sink.footer_faults(said, boundaries.columns)), spark.read.parquet(f"{base}/{k}").count()))
    return spark.createDataFrame(rows, "kind string, version string, primary_column string, encoding string, types string, faults string, rows long")


def fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Whether tables have the same fingerprint after they were written anew in another order and layout, and without a row."""
    base, rows = _folder(spark), []
    for name in ("nation", "customer", "boundaries"):
        df = table(spark, d, name)
        df.repartition(3).select(*reversed(df.columns)).write.parquet(f"{base}/{name}")
        a, b, less = (sink.fingerprint(x).first() for x in (df, spark.read.parquet(f"{base}/{name}"), df.orderBy(df.columns[0]).offset(1)))
        rows.append((name, a["rows"], a.fingerprint == b.fingerprint, a.fingerprint == less.fingerprint))
    return spark.createDataFrame(rows, "table_name string, rows long, same boolean, same_without_one boolean")


def versions_at_once(spark: SparkSession, d: str) -> DataFrame:
    """Versions of one dataset by four writers at the same time, and the rows of each as they are read back."""
    base, region = _folder(spark), table(spark, d, "region")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda _: sink.write_version(region, base, "regions"), range(4)))
    return spark.createDataFrame([(g["version"], g["s3_key"], spark.read.parquet(g["path"]).count()) for g in got], "version int, s3_key string, rows long")


def new_assets(spark: SparkSession, d: str) -> DataFrame:
    """Assets whose key isn't among those of first versions: an insert if absent."""
    assets = table(spark, d, "assets").select("s3_key", "dataset_id", "version")
    return c.absent(assets, assets.where("version = 1"), "s3_key")


def faulty_assets(spark: SparkSession, d: str) -> DataFrame:
    """The rules that assets break once some lost their system, type, schema or version, or had their bounds turned round."""
    a = table(spark, d, "assets").withColumn("n", F.expr("ascii(substring(asset_id, 24, 1)) % 6"))
    b, meta = F.col("bounds"), F.col("metadata")
    turned = F.struct(b["maxx"].alias("minx"), b["miny"].alias("miny"), b["minx"].alias("maxx"), b["maxy"].alias("maxy"))
    worse = a.withColumns({
        "crs": F.when(F.col("n") == 0, None).when((F.col("n") == 1) & (F.col("kind") == "tabular"), F.lit("EPSG:4326")).otherwise(F.col("crs")), "bounds": F.when(F.col("n") == 1, turned).otherwise(b),
        "metadata": F.when(F.col("n") == 2, meta.withField("geometry_type", F.lit(None).cast("string"))).when(F.col("n") == 3, meta.withField("column_schema", F.when(F.lit(False), meta["column_schema"]))).otherwise(meta),
        "version": F.when(F.col("n") == 4, F.lit(0)).otherwise(F.col("version")), "kind": F.when(F.col("n") == 5, F.lit("raster")).otherwise(F.col("kind")),
    })
    return c.asset_faults(worse)


def file_headers(spark: SparkSession, d: str) -> DataFrame:
    """The headers of every separated raw file and the column names made of them."""
    named = table(spark, d, "raw_files").select("file_id", "payload", F.lower(F.trim("format")).alias("alias")).where("payload is not null").distinct().join(table(spark, d, "format_names"), "alias", "left").where("canonical is null or canonical not in ('JSON', 'JSONL')")

    def made(batches):
        for b in batches:
            rows = []
            for f, payload, canonical_ in zip(*(b.column(k).to_pylist() for k in ("file_id", "payload", "canonical"))):
                first = next(iter(records_of(payload, canonical_)), [])
                labels = [label for label, _ in first]
                rows += [(f, i, h, n) for i, (h, n) in enumerate(zip(labels, headers.normalize(labels)[1]))]
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.string(), pa.string()))], ["file_id", "place", "header", "name"])

    return named.select("file_id", "payload", "canonical").mapInArrow(made, "file_id long, place int, header string, name string")


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "assets", "manifests", "runs", "activity_logs", "joined", "boundaries", "raw_files", "format_names", "mix_targets")


def table_types(spark: SparkSession, d: str) -> DataFrame:
    """The canonical type of every column of every table."""
    rows = [(t, f.name, canonical(f.dataType)) for t in TABLES for f in table(spark, d, t).schema.fields]
    return spark.createDataFrame(rows, "table_name string, name string, type_name string")


def epoch_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs as an orchestrator reports them (tags, epoch seconds) as rows of the catalog."""
    said = table(spark, d, "runs").select("run_id", "batch_id", "started_at", "completed_at").distinct()
    tags = F.array(F.struct(F.lit("batch_id").alias("key"), F.col("batch_id").alias("value")), F.struct(F.lit("operator").alias("key"), F.lit("x").alias("value")))
    reported = said.select("run_id", tags.alias("tags"), *[(F.unix_micros(F.col(a).cast("timestamp")) / 1_000_000).alias(b) for a, b in (("started_at", "start_time"), ("completed_at", "end_time"))])
    return c.run_rows(reported).select("run_id", "batch_id", *[F.col(k).cast("timestamp_ntz").alias(k) for k in ("started_at", "completed_at")])


def epoch_events(spark: SparkSession, d: str) -> DataFrame:
    """Events with times in epoch milliseconds as timestamps."""
    said = table(spark, d, "activity_logs").select("log_id", "action", F.unix_millis(F.col("logged_at").cast("timestamp")).alias("timestamp")).distinct()
    return c.event_rows(said).select("log_id", "action", F.col("at").cast("timestamp_ntz").alias("at"))


def unknown_keys(spark: SparkSession, d: str) -> DataFrame:
    """Manifests as JSON, those that failed with a key too many and those under way with a nested tag: what the rules say of it."""
    rows = table(spark, d, "manifests").select("batch_id", "uploader", "intent", "files", "metadata", "status")
    raw = F.to_json(F.struct("batch_id", "uploader", "intent", "files", "metadata"))
    raw = F.when(F.col("status") == "failure", F.regexp_replace(raw, r"^\{", '{"surplus": 1, ')).when(F.col("status") == "running", F.regexp_replace(raw, r"^\{", '{"more": {"a": 1}, ')).otherwise(raw)
    read = m.parse(rows.select("batch_id", raw.alias("raw")), "raw")
    said = read.select("batch_id", F.explode(m.faults(F.col("manifest"), F.col("keys"))).alias("fault"))
    return said.where("fault like 'unknown key%'").groupBy("fault").agg(F.countDistinct("batch_id").alias("manifests"))


def streamed_requests(spark: SparkSession, d: str) -> DataFrame:
    """Manifests in a folder, taken up by a stream: what runs are asked for, and those put aside."""
    base = _folder(spark)
    rows = table(spark, d, "manifests").select("batch_id", F.to_json(F.struct("batch_id", "uploader", "intent", "files", "metadata")).alias("value")).groupBy("batch_id").agg(F.min("value").alias("value"))
    rows.select("value").write.text(f"{base}/in")
    # the writer names files .txt; files of manifests, one a line, are .jsonl
    fs, p = sink._fs(spark, f"{base}/in")
    for s in fs.listStatus(p):  # one file a task
        name = s.getPath().getName()
        if name.endswith(".txt"):
            fs.rename(s.getPath(), sink._fs(spark, f"{base}/in/{name[:-4]}.jsonl")[1])
    manifest_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", lines=True).awaitTermination()
    asked = spark.read.parquet(f"{base}/out/requests").select("run_key", "lane", F.lit(False).alias("put_aside"))
    dead = spark.read.parquet(f"{base}/out/dead_letters").select(F.get_json_object("raw", "$.batch_id").alias("run_key"), F.lit(None).cast("string").alias("lane"), F.lit(True).alias("put_aside"))
    return asked.unionByName(dead)


def logged_runs(spark: SparkSession, d: str) -> DataFrame:
    """The starts and ends of runs as events: what is logged of them and their states, by action."""
    base = _folder(spark)
    runs = table(spark, d, "runs").where("run_id is not null").groupBy("run_id").agg(*[F.max(k).alias(k) for k in ("batch_id", "status", "started_at", "completed_at")])
    tags = F.when(F.col("batch_id").isNotNull(), F.create_map(F.lit("batch_id"), F.col("batch_id")))
    event = lambda what, at: runs.select("run_id", F.lit("ingest_job").alias("job_name"), what.alias("event"), F.coalesce(tags, F.create_map().cast("map<string,string>")).alias("tags"), F.lit("").alias("error_message"), F.col(at).alias("at"))
    events = event(F.lit("STARTED"), "started_at").unionByName(event(F.upper("status"), "completed_at").where("event <> 'RUNNING'"))
    for _ in range(2):  # a batch that comes again adds nothing
        run_events(events, f"{base}/out")
    return spark.read.parquet(f"{base}/out/activity").groupBy("action").agg(F.count(F.lit(1)).alias("entries"), F.countDistinct("resource_id").alias("runs"))


_PLACE = "(s_suppkey % 360 - 180)::DOUBLE AS x, (s_suppkey % 181 - 90)::DOUBLE AS y"
_KEYED = f"SELECT lpad(c_custkey::VARCHAR, 8, '0') AS customer_key, c_acctbal AS balance_aud, CASE WHEN c_nationkey <> 3 THEN c_nationkey::BIGINT END AS nation, x, y FROM customer LEFT JOIN (SELECT s_suppkey, {_PLACE} FROM supplier) ON s_suppkey = c_custkey"
_TYPE = "CASE WHEN column_type LIKE 'STRUCT%[]' OR column_type LIKE '%[]' THEN 'ARRAY' WHEN column_type LIKE 'STRUCT%' THEN 'STRUCT' WHEN column_type LIKE 'MAP%' THEN 'MAP' WHEN column_type = 'VARCHAR' THEN 'STRING' WHEN column_type IN ('BIGINT', 'INTEGER') THEN 'INTEGER' WHEN column_type IN ('DOUBLE', 'FLOAT') THEN 'FLOAT' WHEN column_type = 'BLOB' THEN 'BINARY' ELSE column_type END"
_COLUMNS = [
    ("customers", 1, "customer_key", "Customer Key", "STRING"), ("customers", 1, "balance_aud", "Balance (AUD)", "FLOAT"), ("customers", 1, "_2nd_segment", "2nd Segment", "STRING"), ("customers", 1, "nation", "Nation", "INTEGER"),
    *[("suppliers", v, n, n, t) for v in (1, 2) for n, t in (("id", "INTEGER"), ("Code", "STRING"), ("balance", "FLOAT"), ("third", "BOOLEAN"), ("geom", "GEOMETRY"))],
    ("both", 1, "customer_key", "customer_key", "STRING"), ("both", 1, "balance_aud", "balance_aud", "FLOAT"), ("both", 1, "_2nd_segment", "_2nd_segment", "STRING"), ("both", 1, "nation", "nation", "INTEGER"), ("both", 1, "geom", "geom", "GEOMETRY"),
]
_CLEAN = r"trim(regexp_replace(regexp_replace(lower(trim(header)), '[^a-z0-9]', '_', 'g'), '_+', '_', 'g'), '_')"

QUERIES = {
    f.__name__: f
    for f in (csv_rows, geojson_rows, ingested_assets, ingested_columns, ingested_lineage, joined_version, footers, fingerprints, versions_at_once, new_assets, faulty_assets, file_headers, table_types, epoch_runs, epoch_events, unknown_keys, streamed_requests, logged_runs)
}
SQL = {
    "csv_rows": "SELECT lpad(c_custkey::VARCHAR, 8, '0') AS customer_key, c_acctbal AS balance_aud, CASE c_mktsegment WHEN 'BUILDING' THEN 'NA' ELSE c_mktsegment END AS _2nd_segment, CASE WHEN c_nationkey <> 3 THEN c_nationkey::BIGINT END AS nation FROM customer",
    "geojson_rows": f"SELECT s_suppkey AS id, lpad(s_suppkey::VARCHAR, 8, '0') AS code, s_acctbal AS balance, s_nationkey = 3 AS third, {_PLACE} FROM supplier",
    "ingested_assets": f"""WITH j AS ({_KEYED}), s AS (SELECT {_PLACE} FROM supplier)
SELECT 'customers' AS dataset_id, 1 AS version, 'tabular' AS kind, 'parquet' AS format, NULL AS crs, 'customers/v1/data.parquet' AS s3_key, 'r1' AS run_id, NULL AS geometry_type, NULL::DOUBLE AS minx, NULL::DOUBLE AS miny, NULL::DOUBLE AS maxx, NULL::DOUBLE AS maxy, 71 AS hash_length
UNION ALL SELECT 'suppliers', v, 'spatial', 'geoparquet', 'EPSG:4326', 'suppliers/v' || v || '/data.parquet', 'r' || (v + 1), 'POINT', min(x), min(y), max(x), max(y), 71 FROM s, (VALUES (1), (2)) t(v) GROUP BY v
UNION ALL SELECT 'both', 1, 'joined', 'geoparquet', 'EPSG:4326', 'both/v1/data.parquet', 'r4', 'POINT', min(x), min(y), max(x), max(y), 71 FROM j""",
    "ingested_columns": "SELECT * FROM (VALUES " + ", ".join(map(str, _COLUMNS)) + ") t(dataset_id, version, name, title, type_name)",
    "ingested_lineage": "SELECT * FROM (VALUES ('suppliers', 2, 'spatial_join', 'spatial', 'left'), ('customers', 1, 'spatial_join', 'tabular', 'left')) t(dataset_id, version, transformation, role, how)",
    "joined_version": _KEYED,
    "footers": "SELECT 'geo' AS kind, '1.0.0' AS version, 'geom' AS primary_column, 'WKB' AS encoding, 'Polygon' AS types, '' AS faults, count(*) AS rows FROM boundaries UNION ALL SELECT 'plain', NULL, NULL, NULL, '', 'no geo metadata', count(*) FROM boundaries",
    "fingerprints": "SELECT 'nation' AS table_name, count(*) AS rows, true AS same, false AS same_without_one FROM nation UNION ALL SELECT 'customer', count(*), true, false FROM customer UNION ALL SELECT 'boundaries', count(*), true, false FROM boundaries",
    "versions_at_once": "SELECT v::INT AS version, 'regions/v' || v || '/data.parquet' AS s3_key, (SELECT count(*) FROM region) AS rows FROM range(1, 5) t(v)",
    "new_assets": "SELECT DISTINCT s3_key, dataset_id, version FROM assets WHERE s3_key NOT IN (SELECT s3_key FROM assets WHERE version = 1)",
    "faulty_assets": """WITH a AS (SELECT asset_id, n, CASE n WHEN 5 THEN 'raster' ELSE kind END AS kind, kind AS was, CASE WHEN n = 0 THEN NULL WHEN n = 1 AND kind = 'tabular' THEN 'EPSG:4326' ELSE crs END AS crs,
  CASE n WHEN 1 THEN {'minx': bounds.maxx, 'miny': bounds.miny, 'maxx': bounds.minx, 'maxy': bounds.maxy} ELSE bounds END AS b, bounds IS NULL AND n <> 1 AS none,
  CASE n WHEN 2 THEN NULL ELSE metadata.geometry_type END AS g, n = 3 OR metadata.column_schema IS NULL AS bare, CASE n WHEN 4 THEN 0 ELSE version END AS version
  FROM (SELECT *, ascii(substring(asset_id, 24, 1)) % 6 AS n FROM assets))
SELECT DISTINCT asset_id, fault FROM (SELECT asset_id, unnest([CASE WHEN kind NOT IN ('spatial', 'tabular', 'joined') OR kind IS NULL THEN 'kind is unknown' END, CASE WHEN kind = 'tabular' AND crs IS NOT NULL THEN 'a tabular asset has a crs' END,
  CASE WHEN kind = 'tabular' AND NOT none THEN 'a tabular asset has bounds' END, CASE WHEN kind IN ('spatial', 'joined') AND crs IS NULL THEN 'a spatial asset has no crs' END,
  CASE WHEN kind IN ('spatial', 'joined') AND g IS NULL THEN 'a spatial asset has no geometry type' END, CASE WHEN bare THEN 'there is no column schema' END,
  CASE WHEN version < 1 THEN 'the version is below 1' END, CASE WHEN b.minx > b.maxx OR b.miny > b.maxy THEN 'bounds are reversed' END]) AS fault FROM a) WHERE fault IS NOT NULL""",
    "file_headers": rf"""WITH f AS (SELECT DISTINCT file_id, canonical, list_filter(string_split_regex(payload, '\r\n|\n|\r'), lambda x: trim(x) <> '') AS lines FROM raw_files LEFT JOIN format_names ON alias = lower(trim(format)) WHERE payload IS NOT NULL),
h AS (SELECT file_id, lines[1] AS top, CASE WHEN contains(top, chr(9)) THEN chr(9) WHEN contains(top, ';') THEN ';' WHEN contains(top, '|') THEN '|' ELSE ',' END AS s FROM f WHERE coalesce(canonical, '') NOT IN ('JSON', 'JSONL') AND len(lines) > 1),
p AS (SELECT file_id, generate_subscripts(string_split(top, s), 1) - 1 AS place, trim(unnest(string_split(top, s))) AS header FROM h),
n AS (SELECT *, CASE WHEN {_CLEAN} = '' THEN 'col_' || place WHEN {_CLEAN}[1] BETWEEN '0' AND '9' THEN '_' || {_CLEAN} ELSE {_CLEAN} END AS base FROM p),
k AS (SELECT *, row_number() OVER (PARTITION BY file_id, base ORDER BY place) - 1 AS again FROM n)
SELECT file_id, place::INT AS place, header, base || CASE WHEN again > 0 THEN '_' || again ELSE '' END AS name FROM k""",
    "table_types": " UNION ALL ".join(f"SELECT '{t}' AS table_name, column_name AS name, {_TYPE} AS type_name FROM (DESCRIBE {t})" for t in TABLES),
    "epoch_runs": "SELECT DISTINCT run_id, batch_id, started_at, completed_at FROM runs",
    "epoch_events": "SELECT DISTINCT log_id, action, date_trunc('millisecond', logged_at) AS at FROM activity_logs",
    "unknown_keys": "SELECT 'unknown key' AS fault, count(DISTINCT batch_id) AS manifests FROM manifests WHERE status IN ('failure', 'running') HAVING count(*) > 0",
    "streamed_requests": f"""WITH bad AS ({ledger.SQL["manifest_faults"].replace("SELECT fault, count(DISTINCT batch_id) AS manifests FROM (", "SELECT DISTINCT batch_id FROM (").replace(" GROUP BY fault", "")})
SELECT run_key, lane, false AS put_aside FROM ({ledger.SQL["run_requests"]}) WHERE regexp_replace(archive_key, '^archive/manifests/|[.]json$', '', 'g') NOT IN (SELECT batch_id FROM bad)
UNION ALL SELECT batch_id, NULL, true FROM bad""",
    "logged_runs": """WITH r AS (SELECT run_id, max(batch_id) AS batch_id, max(status) AS status FROM runs WHERE run_id IS NOT NULL GROUP BY run_id)
SELECT 'run_started' AS action, count(*) AS entries, count(*) AS runs FROM r UNION ALL SELECT 'run_' || status, count(*), count(*) FROM r WHERE status <> 'running' AND batch_id IS NOT NULL GROUP BY status""",
}
