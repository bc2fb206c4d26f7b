"""Manifests: their form, their rules, where they go and what a run is asked to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.functions.names import dataset_of, object_path, source_of, testing

FILE = "path string, type string, format string"
JOIN = "spatial_dataset_id string, spatial_version int, tabular_dataset_id string, tabular_version int, left_key string, right_key string, how string"
METADATA = f"title string, description string, keywords array<string>, source string, license string, attribution string, project string, tags map<string,string>, join_config struct<{', '.join(f.replace(' ', ':') for f in JOIN.split(', '))}>"


def _struct(ddl: str) -> str:
    out, depth, name = [], 0, ""
    for part in ddl.split(", "):
        name = f"{name}, {part}" if depth else part
        depth = name.count("<") - name.count(">")
        if not depth:
            key, kind = name.split(" ", 1)
            out.append(f"{key}:{kind}")
            name = ""
    return "struct<" + ",".join(out) + ">"


SCHEMA = f"batch_id string, uploader string, intent string, files array<{_struct(FILE)}>, metadata {_struct(METADATA)}"
#: Fixed values.
REQUIRED = ("batch_id", "uploader", "intent", "files", "metadata")
REQUIRED_METADATA = ("title", "description", "source", "license", "attribution")
FILE_TYPES = ("raster", "vector", "tabular")
HOWS = ("left", "inner", "right", "outer")
ROUTES = {"ingest_vector": "spatial", "ingest_raster": "spatial", "ingest_tabular": "tabular", "join_datasets": "join"}
PREFIX = {"spatial": "spatial_asset", "tabular": "tabular_asset", "join": "join_asset", "ingest": "ingest"}


def parse(df: DataFrame, text: str) -> DataFrame:
    """A column of manifest JSON as columns: ``raw``, ``manifest`` (null where it isn't JSON) and ``keys`` of its levels."""
    raw = F.col(text)
    good = F.try_parse_json(raw).isNotNull()
    keys = F.struct(
        F.json_object_keys(F.when(good, raw)).alias("top"), F.json_object_keys(F.get_json_object(raw, "$.metadata")).alias("metadata"),
        F.json_object_keys(F.get_json_object(raw, "$.metadata.join_config")).alias("join_config"),
        F.transform(F.from_json(F.get_json_object(raw, "$.files"), "array<string>"), lambda f: F.json_object_keys(f)).alias("files"),
        F.map_filter(F.from_json(F.get_json_object(raw, "$.metadata.tags"), "map<string,string>"), lambda _, v: v.rlike(r"(?s)^\s*[\[{]")).alias("nested_tags"),
    )
    return df.withColumns({"manifest": F.when(good, F.from_json(raw, SCHEMA)), "keys": keys})


def _names(ddl: str) -> list[str]:
    return [x.split(":")[0] for x in _struct(ddl)[7:-1].replace("<", ",").split(",") if ":" in x]


def faults(m: Column, keys: Column | None = None) -> Column:
    """What is wrong with a manifest, as an array of texts; empty where nothing is."""
    files, meta, join, intent = m["files"], m["metadata"], m["metadata"]["join_config"], m["intent"]
    n = F.coalesce(F.size(files), F.lit(0))
    any_file = lambda test: F.coalesce(F.exists(files, test), F.lit(False))
    tabular = any_file(lambda f: f["type"] == "tabular")
    other = any_file(lambda f: f["type"].isin("vector", "raster"))
    paths = F.transform(files, lambda f: object_path(f["path"]))
    joins, tables = intent == "join_datasets", intent == "ingest_tabular"
    rules: dict[str, Column] = {"not a manifest": m.isNull()}
    rules |= {f"missing {k}": m.isNotNull() & m[k].isNull() for k in REQUIRED}
    rules |= {f"missing metadata.{k}": meta.isNotNull() & meta[k].isNull() for k in REQUIRED_METADATA}
    rules |= {
        "unknown file type": any_file(lambda f: ~F.coalesce(f["type"].isin(*FILE_TYPES), F.lit(False))),
        "invalid path": F.coalesce(F.exists(paths, lambda p: p.isNull()), F.lit(False)),
        "missing file format": any_file(lambda f: f["format"].isNull()),
        "duplicate paths": F.size(F.array_distinct(paths)) < F.size(paths),
        "non-tabular file in ingest_tabular": tables & other,
        "files in join_datasets": joins & (n > 0),
        "no join_config in join_datasets": joins & join.isNull(),
        "tabular file in another intent": ~joins & ~tables & tabular,
        "no files": ~joins & m.isNotNull() & (n == 0),
        "version below 1": F.coalesce(F.least(join["spatial_version"], join["tabular_version"]), F.lit(1)) < 1,
        "unknown join type": join.isNotNull() & join["how"].isNotNull() & ~join["how"].isin(*HOWS),
    }
    rules |= {f"missing join_config.{k}": join.isNotNull() & join[k].isNull() for k in ("spatial_dataset_id", "tabular_dataset_id", "left_key")}
    if keys is not None:
        extra = lambda have, known: F.size(F.array_except(have, F.array(*map(F.lit, known)))) > 0
        known_meta = ["title", "description", "keywords", "source", "license", "attribution", "project", "tags", "join_config"]
        rules |= {
            "unknown key": extra(keys["top"], REQUIRED), "unknown key in metadata": extra(keys["metadata"], known_meta),
            "unknown key in join_config": extra(keys["join_config"], _names(JOIN)), "unknown key in files": F.exists(keys["files"], lambda k: extra(k, ("path", "type", "format"))),
            "nested tag": F.size(keys["nested_tags"]) > 0,
        }
    said = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules.items()])
    return F.filter(said, lambda f: f.isNotNull())


def json_schema(kind: str | None = None) -> dict:
    """The form of a manifest as a JSON Schema (draft 2020-12), for forms and other programs; ``kind`` is a hint for them.

    It says what a schema can: keys, types, what is required and what values are known. The rules across fields are ``faults``.
    """
    if kind not in (None, "spatial", "tabular", "joined"):
        raise ValueError(f"unknown kind of asset {kind!r}")
    text, whole = {"type": "string"}, {"type": ["integer", "null"], "minimum": 1}

    def record(properties: dict, required: tuple[str, ...]) -> dict:
        return {"type": "object", "properties": properties, "required": list(required), "additionalProperties": False}

    join = record({k: {"enum": [*HOWS, None]} if k == "how" else whole if k.endswith("version") else text for k in _names(JOIN)}, ("spatial_dataset_id", "tabular_dataset_id", "left_key"))
    tags = {"type": "object", "additionalProperties": {"type": ["string", "number", "boolean", "null"]}}
    meta = {k: text for k in (*REQUIRED_METADATA, "project")} | {"keywords": {"type": "array", "items": text}, "tags": tags, "join_config": {"anyOf": [join, {"type": "null"}]}}
    file = record({"path": {"type": "string", "pattern": r"^(s3://)?[a-z0-9][a-z0-9.-]{1,61}[a-z0-9]/."}, "type": {"enum": list(FILE_TYPES)}, "format": text}, ("path", "type", "format"))
    out = record({"batch_id": text, "uploader": text, "intent": text, "files": {"type": "array", "items": file}, "metadata": record(meta, REQUIRED_METADATA)}, REQUIRED)
    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": "manifest", **out} | ({"x-asset-type": kind} if kind else {})


def route(intent: Column) -> Column:
    """spatial, tabular or join for intents with a pipeline of their own, ingest for all others."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ROUTES.items() for x in kv]), intent), F.lit("ingest"))


def enabled_lanes(text: str | None) -> set[str]:
    """Lanes that a comma-separated setting enables: unknown ones are ignored, none means ingest."""
    return {w.strip().lower() for w in (text or "").split(",")} & {"ingest"} or {"ingest"}


def partition(m: Column) -> Column:
    """The dataset that a manifest is about: its tag, else one made from its batch, the same for every reader."""
    return F.coalesce(dataset_of(m["metadata"]["tags"]), F.concat(F.lit("dataset_"), F.substring(F.sha2(m["batch_id"], 256), 1, 12)))


def run_requests(df: DataFrame, key: str = "manifest_key") -> DataFrame:
    """run_key, lane, partition_key, tags of every valid manifest (``manifest``, ``key``), each run key once."""
    m, lane = F.col("manifest"), route(F.col("manifest.intent"))
    tags = F.map_filter(
        F.create_map(*[x for k, v in {
            "batch_id": m["batch_id"], "uploader": m["uploader"], "intent": m["intent"], "manifest_key": F.col(key), "lane": lane, "operator": m["uploader"],
            "manifest_archive_key": F.concat(F.lit("archive/"), F.col(key)), "source": source_of(m["metadata"]["tags"]), "testing": testing(m["metadata"]["tags"]),
            "partition_key": F.when(lane != "ingest", partition(m)),
        }.items() for x in (F.lit(k), v)]),
        lambda _, v: v.isNotNull(),
    )
    prefix = F.element_at(F.create_map(*[F.lit(x) for kv in PREFIX.items() for x in kv]), lane)
    run_key = F.when(lane == "ingest", F.concat_ws(":", prefix, m["batch_id"])).otherwise(F.concat_ws(":", prefix, m["batch_id"], partition(m)))
    out = df.select(run_key.alias("run_key"), lane.alias("lane"), F.when(lane != "ingest", partition(m)).alias("partition_key"), tags.alias("tags"), m.alias("manifest"))
    return out.dropDuplicates(["run_key"])


def form_to_manifest(df: DataFrame) -> DataFrame:
    """Fields of a form (text columns) as they go into a manifest: empty is null, keywords by commas, versions as numbers, how left unless said."""
    blank = {c: F.nullif(F.trim(c), F.lit("")) for c in df.columns}
    out = df.select(*[v.alias(c) for c, v in blank.items()])
    for c in ("spatial_version", "tabular_version"):
        if c in out.columns:
            out = out.withColumn(c, F.col(c).try_cast("int"))
    if "keywords" in out.columns:
        out = out.withColumn("keywords", F.filter(F.transform(F.split("keywords", ","), lambda k: F.trim(k)), lambda k: k != ""))
    if "how" in out.columns:
        out = out.withColumn("how", F.coalesce("how", F.lit("left")))
    if "right_key" in out.columns:
        out = out.withColumn("right_key", F.coalesce("right_key", "left_key"))
    return out
