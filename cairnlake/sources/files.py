"""Files as tables: CSV, GeoJSON, GeoParquet, manifests, listings; several vector files as one."""

from __future__ import annotations

import json
from functools import reduce

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnlake.functions import headers
from cairnlake.functions.geometry import from_geojson, geometry_type
from cairnlake.functions.text import strip
from cairnlake.functions.types import six_words
from cairnlake.operators.manifests import parse


#: What is no value in a column of numbers, dates, times or booleans.
NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null")
_KINDS = (
    ("bigint", r"[+-]?[0-9]+"), ("boolean", r"(?i)true|false"), ("date", r"\d{4}-\d{2}-\d{2}"),
    ("timestamp_ntz", r"\d{4}-\d{2}-\d{2}[ T]\d{2}(:\d{2}){1,2}(\.\d+)?"), ("timestamp", r"\d{4}-\d{2}-\d{2}[ T]\d{2}(:\d{2}){1,2}(\.\d+)?(Z|[+-]\d{2}(:?\d{2})?)"),
    ("double", r"(?i)[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([e][+-]?[0-9]+)?|[+-]?inf(inity)?"),
)


def infer(text: DataFrame, keep: set[str] = frozenset()) -> DataFrame:
    """Text columns as the first type that all their values have, in one pass: whole numbers, booleans, dates, times, numbers,
    else text. NULLS are null in all but text columns, where they stay as they are written; columns without values and those
    to ``keep`` are text."""
    cell = {c: F.trim(F.col(f"`{c}`")) for c in text.columns}
    there = {c: cell[c].isNotNull() & ~cell[c].isin(*NULLS) for c in cell}
    fits = lambda c, kind, pattern: cell[c].rlike(f"^({pattern})$") & cell[c].try_cast(kind).isNotNull()
    asked = [c for c in text.columns if c not in keep]
    if not asked:
        return text
    said = text.agg(*[F.struct(*[F.bool_and(F.when(there[c], fits(c, k, p))).alias(k) for k, p in _KINDS]).alias(str(i)) for i, c in enumerate(asked)]).first()
    kinds = {c: next((k for k, _ in _KINDS if said[i][k]), "string") for i, c in enumerate(asked)}
    empty = {c for i, c in enumerate(asked) if said[i]["bigint"] is None}
    return text.select(*[
        F.col(f"`{c}`") if c in keep else F.lit(None).cast("string").alias(c) if c in empty
        else F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if kinds[c] == "string" else F.when(there[c], cell[c].try_cast(kinds[c])).alias(c)
        for c in text.columns
    ])


def read_csv(spark: SparkSession, path: str, join_key: str | None = None, **options) -> tuple[DataFrame, dict[str, str]]:
    """A comma-separated file with header under normalized names, and the mapping of headers to names.

    Types are inferred over all rows (``infer``). The join key, named as in the header or normalized, is read as text (so
    leading zeros stay) and stripped; ValueError where there is none of that name, or where a row has more or fewer cells
    than the header. Repeated headers get names of their own.
    """
    how = {"mode": "PERMISSIVE", "multiLine": True, "escape": '"', "enforceSchema": False, "inferSchema": False} | options
    top = spark.read.options(**how | {"header": False}).csv(path).first()
    if top is None:
        raise ValueError(f"{path} is empty")
    mapping, names = headers.normalize([h or "" for h in top])
    key = None
    if join_key is not None:
        key = mapping.get(join_key, join_key)
        if key not in names:
            raise ValueError(f"no column {join_key!r} in the file")
    bad = "__bad"
    fields = T.StructType([T.StructField(n, T.StringType()) for n in [*names, bad]])
    rows = spark.read.options(**how | {"header": True, "columnNameOfCorruptRecord": bad, "enforceSchema": True}).schema(fields).csv(path)
    # a test for null would be pushed into the scan, where the column isn't filled yet
    if odd := rows.where(F.coalesce(F.length(bad), F.lit(-1)) >= 0).select(*names, bad).limit(1).collect():
        raise ValueError(f"the header and the rows don't fit together: {odd[0][bad][:100]}")
    typed = infer(rows.drop(bad), {key} - {None})
    return (typed.withColumn(key, strip(F.col(key))) if key else typed), mapping


def clean_key(df: DataFrame, key: str) -> DataFrame:
    """The join key as stripped text, in its place."""
    return df.withColumn(key, strip(F.col(key).cast("string")))


_FEATURE = "type string, properties string, geometry string"


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of GeoJSON collections (whole files) or of lines of features: properties as typed columns, ``geom`` as WKB last.

    Property types are inferred over all features. Files are read whole: a collection is one JSON value. ValueError where
    a collection doesn't parse, or a line or member is no feature.
    """
    text = spark.read.text(path, wholetext=True)
    collection = F.from_json("value", "type string, features array<string>")
    is_whole = F.coalesce(collection["type"], F.lit("")) == "FeatureCollection"
    whole = text.where(is_whole).select(F.explode(F.coalesce(collection["features"], F.array(F.lit("")))).alias("feature"))
    lines = text.where(~is_whole).select(F.explode(F.split("value", "\n")).alias("feature")).where(F.col("feature").rlike(r"\S"))
    features = whole.unionByName(lines)
    if odd := features.where(F.coalesce(F.from_json("feature", _FEATURE)["type"], F.lit("")) != "Feature").count():
        raise ValueError(f"{odd} parts of {path} are no GeoJSON features")
    rows = features.select(F.from_json("feature", _FEATURE).alias("f")).select("f.properties", "f.geometry")
    # the type of every property, widened over all features, by what the JSON says: whole numbers, numbers, booleans, else text
    p = F.from_json("properties", "map<string,variant>")
    cells = rows.select(F.posexplode(p)).select("pos", "key", F.schema_of_variant("value").alias("said")).where("said <> 'VOID'")
    kind = F.when(F.col("said") == "BIGINT", 1).when(F.col("said").rlike(r"^DECIMAL\(\d+,0\)$"), 2).when(F.col("said").rlike("^(DECIMAL|DOUBLE|FLOAT)"), 3).when(F.col("said") == "BOOLEAN", 4).otherwise(5)
    seen = cells.groupBy("key").agg(F.min("pos").alias("pos"), F.collect_set(kind).alias("kinds")).collect()  # a row per property
    named = {1: "bigint", 2: "decimal(38,0)", 3: "double", 4: "boolean", 5: "string"}
    types = {r.key: named[max(r.kinds) if set(r.kinds) <= {1, 2, 3} or len(r.kinds) == 1 else 5] for r in sorted(seen, key=lambda r: (r.pos, r.key))}
    out = rows.select(p.alias("p"), from_geojson("geometry").alias("geom"))
    return out.select(*[F.try_variant_get(F.try_element_at("p", F.lit(n)), "$", t).alias(n) for n, t in types.items()], F.col("geom").alias("geom", metadata={"geometry": True}))


def vector_schema(df: DataFrame, geom: str = "geom") -> dict:
    """fields (name to one of six words) and geometry_type of a vector table; ValueError unless it has one geometry column."""
    if geom not in df.columns:
        raise ValueError(f"no geometry column {geom!r}")
    marked = [f.name for f in df.schema.fields if f.metadata.get("geometry") and f.name != geom]
    if marked:
        raise ValueError(f"more than one geometry column: {', '.join([geom, *marked])}")
    kinds = [r[0] for r in df.select(geometry_type(F.col(geom)).alias("t")).where("t is not null").distinct().collect()]  # seven at most
    words = {"bigint": "integer", "int": "integer", "smallint": "integer", "tinyint": "integer", "double": "real", "float": "real", "boolean": "integer", "timestamp_ntz": "datetime"}
    fields = {f.name: words.get(f.dataType.simpleString(), six_words(f.dataType.simpleString())) for f in df.schema.fields if f.name != geom}
    return {"fields": fields, "geometry_type": kinds[0] if len(kinds) == 1 else "GEOMETRY" if kinds else "UNKNOWN"}


def ogr_schema(text: str) -> dict:
    """The same of a vector driver's JSON description: one layer with one geometry field, or ValueError."""
    layers = json.loads(text).get("layers", [])
    if len(layers) != 1:
        raise ValueError(f"{len(layers)} layers instead of one")
    shapes = layers[0].get("geometryFields", [])
    if len(shapes) != 1:
        raise ValueError(f"{len(shapes)} geometry fields instead of one")
    return {"fields": {f["name"]: six_words(f["type"]) for f in layers[0].get("fields", [])}, "geometry_type": shapes[0].get("type", "").replace(" ", "")}


def incompatibilities(schemas: list[dict]) -> list[str]:
    """How the second and later files differ from the first: fields that only one has, types that differ, geometry types."""
    out = []
    for n, s in enumerate(schemas[1:], 2):
        a, b = schemas[0]["fields"], s["fields"]
        if odd := sorted(a.keys() ^ b.keys()):
            out.append(f"file {n}: fields only on one side: {', '.join(odd)}")
        out += [f"file {n}: {k} is {b[k]} instead of {a[k]}" for k in sorted(a.keys() & b.keys()) if a[k] != b[k]]
        if s["geometry_type"] != schemas[0]["geometry_type"]:
            out.append(f"file {n}: {s['geometry_type']} instead of {schemas[0]['geometry_type']}")
    return out


def union_files(frames: list[DataFrame], check: bool = True) -> DataFrame:
    """All rows of several vector tables, by name; ValueError with every difference where they don't fit."""
    if check and len(frames) > 1 and (wrong := incompatibilities([vector_schema(f) for f in frames])):
        raise ValueError("; ".join(wrong))
    return reduce(DataFrame.unionByName, frames)


def geo_footer(path: str, fs: pa.fs.FileSystem | None = None) -> dict | None:
    """The geo metadata in a Parquet file's footer."""
    raw = (pq.read_schema(path, filesystem=fs).metadata or {}).get(b"geo")
    try:
        return None if raw is None else json.loads(raw)
    except ValueError:
        return None


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """manifest_key, raw, manifest, keys of every .json file under a folder."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return parse(files.select(F.col("_metadata.file_path").alias("manifest_key"), F.col("value").alias("raw")), "raw")


def list_objects(spark: SparkSession, root: str, prefix: str = "", archive: bool = False) -> DataFrame:
    """key, size, last_modified, is_dir of what lies directly under a prefix; the archive only when asked for."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    at = jvm.org.apache.hadoop.fs.Path(f"{root}/{prefix}".rstrip("/"))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    top = fs.makeQualified(base).toString().rstrip("/") + "/"
    rows = []
    if fs.exists(at):
        for s in fs.listStatus(at):
            key = s.getPath().toString()[len(top) :] + ("/" if s.isDirectory() else "")
            if archive or not key.startswith("archive/"):
                rows.append((key, int(s.getLen()), int(s.getModificationTime()), bool(s.isDirectory())))
    frame = spark.createDataFrame(rows, "key string, size long, ms long, is_dir boolean")
    return frame.select("key", "size", F.timestamp_millis("ms").alias("last_modified"), "is_dir").orderBy("key")


def object_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))
