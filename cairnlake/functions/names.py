"""Names, paths and ids as column functions; what isn't valid gives null."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairnlake.functions.text import strip

#: File formats and content types by extension.
FORMATS = {"geojson": "GeoJSON", "json": "GeoJSON", "shp": "SHP", "gpkg": "GPKG", "tif": "GTiff", "tiff": "GTiff", "csv": "CSV", "parquet": "Parquet"}
CONTENT_TYPES = {
    "parquet": "application/vnd.apache.parquet", "tif": "image/tiff", "tiff": "image/tiff", "json": "application/json",
    "geojson": "application/geo+json", "gpkg": "application/geopackage+sqlite3",
}
#: What tags say for yes and no.
YES, NO = ("1", "true", "yes", "y", "on"), ("0", "false", "no", "n", "off")
WKT_STARTS = ("PROJCS[", "GEOGCS[", "COMPD_CS[", "GEOCCS[")


def _lookup(table: dict[str, str], key: Column, default: str) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def object_path(c: Column) -> Column:
    """s3://bucket/key of a path with or without scheme: bucket of 3 to 63 lower-case letters, digits, dots and hyphens, key not empty."""
    bare = F.regexp_replace(strip(c), r"^s3://", "")
    good = bare.rlike(r"(?s)^[a-z0-9][a-z0-9.-]{1,61}[a-z0-9]/.+")
    return F.when(good, F.concat(F.lit("s3://"), bare))


def bucket_and_key(c: Column) -> Column:
    """struct(bucket, key) of an s3:// path, null for any other."""
    good = c.rlike(r"(?s)^s3://[^/]+/.+")
    return F.when(good, F.struct(F.regexp_extract(c, r"^s3://([^/]+)/", 1).alias("bucket"), F.regexp_replace(c, r"^s3://[^/]+/", "").alias("key")))


def object_key(c: Column) -> Column:
    """The key of an s3:// path; other text as it is."""
    return F.regexp_replace(c, r"^s3://[^/]+/", "")


def virtual_path(c: Column) -> Column:
    """An s3:// path as the virtual file path of vector drivers; other text as it is."""
    return F.regexp_replace(c, r"^s3://", "/vsis3/")


def lake_key(c: Column) -> Column:
    """A stripped key without slash at either end."""
    s = strip(c)
    return F.when((s != "") & ~s.startswith("/") & ~s.endswith("/"), s)


def content_hash(c: Column) -> Column:
    """sha256:<64 hex digits>, stripped and lower-cased."""
    s = F.lower(strip(c))
    return F.when(s.rlike("^sha256:[a-f0-9]{64}$"), s)


def crs(c: Column) -> Column:
    """EPSG code in upper case, WKT with balanced brackets, or a PROJ string."""
    s = strip(c)
    wkt = s.rlike("^(PROJCS|GEOGCS|COMPD_CS|GEOCCS)\\[") & s.endswith("]") & (F.regexp_count(s, F.lit(r"\[")) == F.regexp_count(s, F.lit(r"\]")))
    proj = s.startswith("+proj=") & F.substring(s, 7, 1_000_000).contains("=")
    return F.when(s.rlike(r"(?i)^EPSG:\d{4,6}$"), F.upper(s)).when(wkt | proj, s)


_UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def schema_of_run(c: Column) -> Column:
    """proc_<run id with underscores> of a UUID."""
    return F.when(c.rlike(_UUID), F.concat(F.lit("proc_"), F.replace(c, F.lit("-"), F.lit("_"))))


def run_of_schema(c: Column) -> Column:
    """The UUID in a scratch schema's name."""
    run = F.replace(F.regexp_replace(c, "^proc_", ""), F.lit("_"), F.lit("-"))
    return F.when(c.startswith("proc_") & run.rlike(_UUID), run)


def file_format(path: Column) -> Column:
    """By extension; GeoJSON where unknown."""
    return _lookup(FORMATS, F.regexp_extract(F.lower(path), r"\.([^.]*)$", 1), "GeoJSON")


def content_type(path: Column) -> Column:
    """By extension."""
    return _lookup(CONTENT_TYPES, F.regexp_extract(F.lower(path), r"\.([^./]*)$", 1), "application/octet-stream")


def new_id(prefix: str) -> Column:
    """<prefix>_<12 hex digits>, drawn anew for every row."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 12))


def batch_base(c: Column) -> Column:
    """A batch id without the suffix of reruns."""
    return F.regexp_replace(c, r"_v\d+$", "")


def batch_rerun(c: Column, n: Column) -> Column:
    """The id of the n-th run of a batch."""
    return F.concat(batch_base(c), F.lit("_v"), n.cast("string"))


def rerun_number(c: Column) -> Column:
    """The number in a rerun's id, 1 for the first run."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(c, r"_v(\d{1,9})$", 1), F.lit("")), F.lit("999999999")).cast("int"), F.lit(1))


def dataset_of(tags: Column) -> Column:
    """The dataset id that tags name, stripped; null where there is none."""
    return F.nullif(strip(F.try_element_at(tags, F.lit("dataset_id"))), F.lit(""))


def source_of(tags: Column) -> Column:
    """ingestion_source, else source, else unknown; empty text is none."""
    return F.coalesce(*[F.nullif(F.try_element_at(tags, F.lit(k)), F.lit("")) for k in ("ingestion_source", "source")], F.lit("unknown"))


def testing(tags: Column) -> Column:
    """true or false as a tag says it in words or numbers, else null."""
    said = F.lower(strip(F.try_element_at(tags, F.lit("testing"))))
    number = said.rlike(r"^-?[0-9]+(\.[0-9]+)?$")
    return F.when(said.isin(*YES), "true").when(said.isin(*NO), "false").when(number, F.when(said.rlike(r"^-?0+(\.0+)?$"), "false").otherwise("true"))


def keywords(c: Column) -> Column:
    """Stripped, without blanks, each once where it first stands."""
    return F.array_distinct(F.filter(F.transform(c, strip), lambda k: k.isNotNull() & (k != "")))


def short_title(c: Column, longest: int = 50) -> Column:
    return F.when(F.length(c) > longest, F.concat(F.substring(c, 1, longest), F.lit("..."))).otherwise(c)


def endpoint(c: Column) -> Column:
    """struct(host, https) of an object store's endpoint with or without scheme."""
    s = strip(c)
    return F.struct(F.regexp_replace(F.regexp_replace(s, r"(?i)^https?://", ""), "/+$", "").alias("host"), s.rlike("(?i)^https://").alias("https"))


def database_of(c: Column) -> Column:
    """The database a connection string names."""
    return F.nullif(F.regexp_extract(c, r"^[a-z0-9+]+://[^/]+/([^?]*)", 1), F.lit(""))


def first_forwarded(c: Column) -> Column:
    """The first address of a forwarding header."""
    return F.nullif(strip(F.split(c, ",").getItem(0)), F.lit(""))


def folder_name(c: Column) -> Column:
    return F.when(c.rlike("^[a-zA-Z0-9_-]+$"), c)


def identifier(name: str, label: str = "identifier") -> str:
    """A name that is a plain identifier, or ValueError."""
    if not re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"{label} isn't an identifier: {name!r}")
    return name


def bounds_size(b: Column) -> Column:
    """struct(width, height, area, valid) of bounds."""
    w, h = b["maxx"] - b["minx"], b["maxy"] - b["miny"]
    return F.struct(w.alias("width"), h.alias("height"), (w * h).alias("area"), ((w >= 0) & (h >= 0)).alias("valid"))


def bounds_of_box(c: Column) -> Column:
    """Bounds written as BOX(minx miny, maxx maxy); null for other text."""
    n = r"\s*(-?[0-9.]+(?:[eE][+-]?[0-9]+)?)\s*"
    form = rf"^BOX\s*\({n}\s{n},{n}\s{n}\)$"
    return F.when(c.rlike(form), F.struct(*[F.regexp_extract(c, form, i + 1).try_cast("double").alias(k) for i, k in enumerate(("minx", "miny", "maxx", "maxy"))]))
