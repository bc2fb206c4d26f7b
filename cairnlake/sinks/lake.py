"""Versions of datasets in the lake: written once, never changed, with a GeoParquet footer and a content hash.

A version is the folder {dataset}/v{n}/data.parquet. Its number is claimed by making the file {dataset}/.claims/v{n}, which
only one writer can; the version is written beside its place and renamed there by the one who has the number. A writer that
dies leaves a gap in the numbers and no version.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions.geometry import NAMES
from cairnlake.sources.files import geo_footer


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def geo_metadata(geom: str = "geom", kind: str = "UNKNOWN", crs: str | None = None) -> dict:
    """The geo footer of a table with one geometry column in longitude and latitude."""
    title = {n: n.title() for n in NAMES.values()} | {"LINESTRING": "LineString", "MULTIPOINT": "MultiPoint", "MULTILINESTRING": "MultiLineString", "MULTIPOLYGON": "MultiPolygon", "GEOMETRYCOLLECTION": "GeometryCollection"}
    return {"version": "1.0.0", "primary_column": geom, "columns": {geom: {"encoding": "WKB", "geometry_types": [title[kind]] if kind in title else [], "crs": crs}}}


def footer_faults(geo: dict | None, columns: list[str]) -> list[str]:
    """What is missing in a geo footer."""
    if geo is None:
        return ["no geo metadata"]
    out = [f"no {k}" for k in sorted({"version", "primary_column", "columns"} - geo.keys())]
    if not out:
        first = geo["primary_column"]
        out += [f"{first} isn't a column"] * (first not in columns) + [f"{first} isn't described"] * (first not in geo["columns"])
    return out


def with_footer(df: DataFrame, path: str, geo: dict) -> None:
    """Write ``df`` as Parquet files whose footers hold the geo metadata, each task its own, batch by batch."""
    schema = df.limit(0).toArrow().schema
    meta = {b"geo": json.dumps(geo).encode()}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = None
        name = f"part-{uuid.uuid4().hex}.parquet"
        rows = 0
        fs, base = pa.fs.FileSystem.from_uri(path)
        for b in batches:
            if sink is None:
                sink = pq.ParquetWriter(fs.open_output_stream(f"{base}/.{name}"), schema.with_metadata(meta))
            sink.write_batch(b.cast(schema) if b.schema != schema else b)
            rows += b.num_rows
        if sink is not None:
            sink.close()
            sink.file_handle.close() if sink.file_handle else None
            fs.move(f"{base}/.{name}", f"{base}/{name}")  # a task that dies leaves a hidden file only
        yield pa.record_batch([pa.array([name] if rows else [], pa.string()), pa.array([rows] if rows else [], pa.int64())], ["name", "rows"])

    fs, base = pa.fs.FileSystem.from_uri(path)
    fs.create_dir(base, recursive=True)
    kept = {r.name for r in df.mapInArrow(write, "name string, rows long").collect()}  # a row per task
    if not kept:
        with fs.open_output_stream(f"{base}/part-empty.parquet") as out:
            pq.write_table(schema.with_metadata(meta).empty_table(), out)
        return
    for f in fs.get_file_info(pa.fs.FileSelector(base)):  # of tasks that ran twice one copy counts
        if f.base_name not in kept:
            fs.delete_file(f.path)


def content_hash(spark: SparkSession, path: str) -> str:
    """sha256:<hex> over the bytes of the data file, or over the hashes of several in order of name; each is read in pieces
    where it is hashed."""
    fs, base = pa.fs.FileSystem.from_uri(path)
    names = sorted(f.base_name for f in fs.get_file_info(pa.fs.FileSelector(base)) if f.base_name.endswith(".parquet"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, root = pa.fs.FileSystem.from_uri(path)
        for b in batches:
            out = []
            for n in b.column("name").to_pylist():
                h = hashlib.sha256()
                with own.open_input_stream(f"{root}/{n}") as stream:
                    while block := stream.read(8 << 20):
                        h.update(block)
                out.append(h.hexdigest())
            yield pa.record_batch([b.column("name"), pa.array(out, pa.string())], ["name", "h"])

    files = spark.createDataFrame([(n,) for n in names], "name string").repartition(max(1, min(len(names), spark.sparkContext.defaultParallelism)))
    each = [r.h for r in sorted(files.mapInArrow(hashed, "name string, h string").collect(), key=lambda r: r.name)]  # a row per file
    return "sha256:" + (each[0] if len(each) == 1 else hashlib.sha256("".join(each).encode()).hexdigest())


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: a hash of the rows whatever their order, file layout and writer, and how many there are."""
    cells = F.to_json(F.struct(*[F.hex(c).alias(c) if t == "binary" else F.col(c) for c, t in sorted(df.dtypes)]), {"ignoreNullFields": "false"})
    h = df.select(F.sha2(cells, 256).alias("h"))
    half = lambda at: F.sum(F.conv(F.substring("h", at, 15), 16, 10).cast("decimal(38,0)"))
    return h.agg(F.count(F.lit(1)).alias("rows"), half(1).alias("a"), half(16).alias("b")).select("rows", F.sha2(F.concat_ws("|", "rows", "a", "b"), 256).alias("fingerprint"))


def make_once(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False where it is there already. Of several writers at once exactly one gets True.

    On a local disk the system's exclusive open decides, elsewhere the file system's create without overwriting (HDFS) or
    conditional put (object stores that offer it).
    """
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getUri().getScheme() == "file":
        try:
            os.close(os.open(p.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    try:
        fs.createFile(p).overwrite(False).opt("fs.option.create.conditional.overwrite", True).build().close()
    except Exception as e:
        if fs.exists(p):
            return False
        raise e
    return True


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    fs, p = _fs(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return [int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()]


def claim_version(spark: SparkSession, lake: str, dataset: str) -> int:
    """The next version number of a dataset, which no other writer has or gets."""
    home = f"{lake}/{dataset}"
    n = max([*_numbers(spark, home), *_numbers(spark, f"{home}/.claims")], default=0)
    while True:
        n += 1
        if make_once(spark, f"{home}/.claims/v{n}"):
            return n


def write_version(df: DataFrame, lake: str, dataset: str, geo: dict | None = None, files: int | None = None) -> dict:
    """Write the next version of a dataset: {dataset_id, version, s3_key, content_hash, path}."""
    spark = df.sparkSession
    dataset = dataset.strip()
    staging = f"{lake}/.staging/{uuid.uuid4().hex}"
    out = df.coalesce(files) if files else df
    with_footer(out, staging, geo) if geo else out.write.parquet(staging)
    n = claim_version(spark, lake, dataset)
    key = f"{dataset}/v{n}/data.parquet"
    fs, home = _fs(spark, f"{lake}/{dataset}/v{n}")
    fs.mkdirs(home)
    if not fs.rename(_fs(spark, staging)[1], _fs(spark, f"{lake}/{key}")[1]):
        raise RuntimeError(f"{key} couldn't be put in its place")
    return {"dataset_id": dataset, "version": n, "s3_key": key, "content_hash": content_hash(spark, f"{lake}/{key}"), "path": f"{lake}/{key}"}


def put_if_absent(df: DataFrame, path: str) -> None:
    """Write where nothing is; FileExistsError-like failure where something is."""
    df.write.mode("errorifexists").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows to a catalog table."""
    df.write.mode("append").parquet(path)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file into another folder; False where it is gone already, so repeating does no harm."""
    fs, a = _fs(spark, source)
    _, b = _fs(spark, target)
    if not fs.exists(a):
        return False
    fs.mkdirs(b.getParent())
    return bool(fs.rename(a, b))


PROTECTED = ("archive/", "manifests/")


def _landing(root: str, key: str) -> str:
    """A place under the landing zone; ValueError for what lies outside or is protected."""
    key = key.strip("/")
    if not key or any(part in ("", ".", "..") for part in key.split("/")):
        raise ValueError(f"no key: {key!r}")
    if f"{key}/".startswith(PROTECTED):
        raise ValueError(f"{key} is protected")
    return f"{root}/{key}"


def put_file(spark: SparkSession, root: str, key: str, content: bytes, overwrite: bool = False) -> bool:
    """Upload a file; False where one is there already."""
    fs, p = _fs(spark, _landing(root, key))
    if fs.exists(p) and not overwrite:
        return False
    out = fs.create(p, overwrite)
    out.write(bytearray(content))
    out.close()
    return True


def get_file(spark: SparkSession, root: str, key: str) -> bytes:
    """Download a file; FileNotFoundError where there is none."""
    rows = spark.read.format("binaryFile").load(f"{root}/{key}").select("content").take(1) if _fs(spark, f"{root}/{key}")[0].exists(_fs(spark, f"{root}/{key}")[1]) else []
    if not rows:
        raise FileNotFoundError(key)
    return bytes(rows[0].content)


def create_folder(spark: SparkSession, root: str, folder: str) -> bool:
    """Make a folder; False where it is there already."""
    fs, p = _fs(spark, _landing(root, folder))
    return not fs.exists(p) and bool(fs.mkdirs(p))


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a file, wherever it is; False where there is none."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and not fs.getFileStatus(p).isDirectory() and fs.delete(p, False))


def delete_file(spark: SparkSession, root: str, key: str) -> bool:
    """Remove a file that isn't protected; False where there is none."""
    return remove(spark, _landing(root, key))


def delete_folder(spark: SparkSession, root: str, folder: str) -> bool:
    """Remove an empty folder that isn't protected."""
    fs, p = _fs(spark, _landing(root, folder))
    return bool(fs.exists(p) and not len(fs.listStatus(p)) and fs.delete(p, False))


def footer_of(path: str) -> dict | None:
    """The geo footer of a dataset's first file."""
    fs, base = pa.fs.FileSystem.from_uri(path)
    files = sorted(f.path for f in fs.get_file_info(pa.fs.FileSelector(base)) if f.path.endswith(".parquet"))
    return geo_footer(files[0], fs) if files else None
