"""Manifests as a stream: found, checked, routed, and put aside, each once; and the events of runs.

The file source's checkpoint takes the place of a list of keys already seen. Batches may be repeated after a failure, so
what is written is keyed: run requests by run key, audit entries by action and resource. A manifest that is invalid goes to
the dead letters and never stops the stream. Files move to the archive once their batch is written.

A file is one manifest (.json), or holds many, one a line (.jsonl): where manifests land by the million a file each would take
more time and disk than all else. A manifest of a line is called by its file and the hash of the line.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cairnlake.operators.catalog import absent, first_of
from cairnlake.operators.manifests import faults, parse, run_requests
from cairnlake.sinks.lake import _fs, append, move

CURSOR_KEYS = 500
#: Fixed values.
TRACKED_JOBS = ("spatial_asset_job", "tabular_asset_job", "join_asset_job", "ingest_job")
ENDS = {"SUCCESS": ("run_success", "success"), "FAILURE": ("run_failure", "failure"), "CANCELED": ("run_canceled", "canceled")}


def _there(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def append_new(df: DataFrame, path: str, *keys: str) -> None:
    """Append the rows whose key isn't in the table yet."""
    spark = df.sparkSession
    append(absent(df, spark.read.parquet(path), *keys) if _there(spark, path) else df.dropDuplicates(list(keys)), path)


def route_batch(batch: DataFrame, out: str, archive: str | None = None, lanes: set[str] | None = None, lines: bool = False) -> None:
    """One batch of (manifest_key, raw): requests of valid manifests, dead letters of the others, then the archive.

    ``lanes`` limits what is asked for; manifests of other lanes stay where they are. Files of ``lines`` are whole in a batch.
    """
    spark = batch.sparkSession
    rows = parse(batch, "raw").withColumn("faults", faults(F.col("manifest"), F.col("keys"))).persist()
    try:
        requests = run_requests(rows.where(F.size("faults") == 0))
        requests = requests if lanes is None else requests.where(F.col("lane").isin(*lanes))
        dead = rows.where(F.size("faults") > 0).select("manifest_key", "raw", "faults")
        append_new(requests.withColumn("requested_at", F.current_timestamp()), f"{out}/requests", "run_key")
        append_new(dead, f"{out}/dead_letters", "manifest_key")
        if archive:
            done = requests.select(F.col("tags")["manifest_key"].alias("manifest_key")).unionByName(dead.select("manifest_key"))
            done = rows.select(F.substring_index("manifest_key", "#", 1).alias("manifest_key")) if lines else done
            for r in done.distinct().toLocalIterator():  # a manifest is one small file
                move(spark, r.manifest_key, f"{archive}/{r.manifest_key.rsplit('/', 1)[1]}")
    finally:
        rows.unpersist()


def manifest_stream(spark: SparkSession, landing: str, out: str, checkpoint: str, archive: str | None = None, lanes: set[str] | None = None, files_per_batch: int = 1_000, once: bool = True, lines: bool = False) -> StreamingQuery:
    """Watch a folder of manifests; ``once`` takes what is there and stops. With ``lines`` they are those of .jsonl files, one a
    line (blank ones aside; one that a file repeats counts once), else .json files."""
    if lines and lanes and archive:
        raise ValueError("a file of lines can't be in the archive and stay where it is")
    source = (
        spark.readStream.format("text").option("wholetext", not lines).option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl" if lines else "*.json")
        .option("maxFilesPerTrigger", files_per_batch).schema("value string").load(landing)
    )
    file = F.col("_metadata.file_path")
    rows = source.select((F.concat(file, F.lit("#"), F.sha2("value", 256)) if lines else file).alias("manifest_key"), F.col("value").alias("raw"))
    rows = rows.where(F.trim("raw") != "") if lines else rows
    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, _: route_batch(b, out, archive, lanes, lines))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def run_events(batch: DataFrame, out: str) -> None:
    """One batch of (run_id, job_name, event, tags, error_message, at): status events and audit entries.

    Other jobs are left out; without a batch id a start is still logged, an end isn't.
    """
    known = batch.where(F.col("job_name").isin(*TRACKED_JOBS)).withColumn("batch_id", F.try_element_at("tags", F.lit("batch_id")))
    table = F.create_map(*[F.lit(x) for k, v in ({"STARTED": ("run_started", "running")} | ENDS).items() for x in (k, "|".join(v))])
    said = known.withColumn("__to", F.split(F.try_element_at(table, F.col("event")), "\\|")).where("__to is not null and (event = 'STARTED' or batch_id is not null)")
    details = F.map_filter(F.create_map(*[x for k, c in {
        "job_name": F.col("job_name"), "batch_id": F.col("batch_id"), "operator": F.try_element_at("tags", F.lit("operator")),
        "source": F.try_element_at("tags", F.lit("source")), "error_message": F.nullif("error_message", F.lit("")),
    }.items() for x in (F.lit(k), c)]), lambda _, v: v.isNotNull())
    audit = said.select(F.col("at").alias("logged_at"), F.coalesce(F.try_element_at("tags", F.lit("operator")), F.lit("system")).alias("username"), F.col("__to")[0].alias("action"), F.lit("run").alias("resource_type"), F.col("run_id").alias("resource_id"), details.alias("details"))
    status = said.where("batch_id is not null").select("run_id", "batch_id", F.col("__to")[1].alias("status"), "error_message", "at")
    append_new(first_of(audit, "action", "resource_type", "resource_id", tie="username"), f"{out}/activity", "action", "resource_type", "resource_id")
    append_new(status, f"{out}/status", "run_id", "status")


def event_stream(spark: SparkSession, events: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Follow a stream of run events."""
    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda b, _: run_events(b, out)).trigger(availableNow=True).start()


def windowed_activity(logs: DataFrame, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Entries per window and action; works on a stream too, where entries later than ``late`` are left out (unless the stream
    has a watermark on ``logged_at``, a timestamp, already)."""
    timed = logs
    if logs.schema["logged_at"].dataType.typeName() != "timestamp":
        timed = logs.withColumn("logged_at", F.col("logged_at").cast("timestamp"))
        timed = timed.withWatermark("logged_at", late) if logs.isStreaming else timed
    return timed.groupBy(F.window("logged_at", window).alias("w"), "action").agg(F.count(F.lit(1)).alias("entries")).select("w.start", "w.end", "action", "entries")


# --- cursors of readers that have no checkpoint ------------------------------------------------------------------


def read_cursor(text: str | None) -> list[str]:
    """Keys of a cursor: JSON of version 1, or an old comma-separated list; without blanks and repeats."""
    if not text or not text.strip():
        return []
    try:
        said = json.loads(text)
        keys = said.get("processed_keys", []) if isinstance(said, dict) else []
    except ValueError:
        keys = text.split(",")
    return list(dict.fromkeys(k.strip() for k in keys if isinstance(k, str) and k.strip()))


def merge_keys(old: list[str], new: list[str], move_repeats: bool = True) -> list[str]:
    """Old keys, then new ones; a repeated key moves to the end, or keeps its place."""
    if not move_repeats:
        return list(dict.fromkeys([*old, *new]))
    return list(reversed(dict.fromkeys(reversed([*old, *new]))))


def write_cursor(keys: list[str], most: int = CURSOR_KEYS) -> str:
    """The last ``most`` keys as JSON of version 1."""
    return json.dumps({"v": 1, "processed_keys": keys[-most:], "max_keys": most})


def unseen(listed: DataFrame, seen: DataFrame, key: str = "manifest_key") -> DataFrame:
    """Listed objects that aren't among those seen."""
    return listed.join(seen.select(key).distinct(), key, "left_anti")
