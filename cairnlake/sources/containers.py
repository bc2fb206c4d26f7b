"""Vector containers and rasters: GeoPackage, Shapefile and GeoTIFF, read file by file on the executors.

Each file is one row of Spark's binary source and is parsed in memory in the task that read it; no local copies are made.
Schemas come from the first file; several files go through ``files.union_files`` like any other vector files.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnlake.functions.geometry import NAMES, wkb_of
from cairnlake.functions.wkb import LINESTRING, MULTILINESTRING, MULTIPOINT, MULTIPOLYGON, POINT, POLYGON

Rows = list[tuple]
#: Spark types by the declared type's start in a GeoPackage, and by the letter of a dBASE field.
SQLITE = (("BOOLEAN", "boolean"), ("TINYINT", "int"), ("SMALLINT", "int"), ("MEDIUMINT", "int"), ("INT", "bigint"), ("FLOAT", "double"), ("DOUBLE", "double"), ("REAL", "double"), ("BLOB", "binary"), ("DATETIME", "string"), ("DATE", "string"), ("TEXT", "string"))
DBASE = {"C": "string", "D": "string", "L": "boolean", "F": "double", "N": "double", "I": "bigint"}


def _schema(columns: list[tuple[str, str]]) -> T.StructType:
    fields = [T.StructField(n, T._parse_datatype_string(k)) for n, k in columns]
    return T.StructType([*fields, T.StructField("geom", T.BinaryType(), True, {"geometry": True})])


def _read(spark: SparkSession, path: str, pattern: str, describe: Callable[[bytes], list], parse: Callable[[bytes], Rows]) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    first = files.agg(F.min("path")).first()[0]  # without the contents
    if first is None:
        raise ValueError(f"no {pattern} under {path}")
    columns = describe(bytes(spark.read.format("binaryFile").load(first).select("content").first().content))
    schema = _schema(columns)
    names = schema.names
    arrow = [pa.int32() if k == "int" else pa.int64() if k == "bigint" else pa.float64() if k == "double" else pa.bool_() if k == "boolean" else pa.binary() if k == "binary" else pa.string() for _, k in ((f.name, f.dataType.simpleString()) for f in schema.fields)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in (x.as_py() for x in b.column("content")):
                if describe(content) != columns:
                    raise ValueError(f"files of different columns under {path}")
                got = parse(content)
                for at in range(0, len(got), 10_000):
                    part = list(zip(*got[at : at + 10_000]))
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(part, arrow)], names)

    out = files.select("content").mapInArrow(rows, schema)
    return out.select(*names[:-1], F.col("geom").alias("geom", metadata={"geometry": True}))


# --- GeoPackage ---------------------------------------------------------------------------------------------------


def _open(data: bytes) -> sqlite3.Connection:
    con = sqlite3.connect(":memory:")
    con.deserialize(data)
    return con


def gpkg_wkb(blob: bytes | None) -> bytes | None:
    """The WKB in a GeoPackage geometry; None where it is empty or no geometry."""
    if not blob or blob[:2] != b"GP" or blob[3] & 0x10:
        return None
    return bytes(blob[8 + (0, 32, 48, 48, 64, 0, 0, 0)[blob[3] >> 1 & 7] :])


def _layer(con: sqlite3.Connection) -> tuple[str, str, list[tuple[str, str]]]:
    layers = con.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY 1").fetchall()
    if len(layers) != 1:
        raise ValueError(f"{len(layers)} layers instead of one")
    table, geom = layers[0]
    quoted = table.replace('"', '""')
    columns = [(n, next((s for k, s in SQLITE if kind.upper().startswith(k)), "string")) for _, n, kind, *_ in con.execute(f'PRAGMA table_info("{quoted}")') if n != geom]
    return table, geom, columns


def _gpkg_rows(data: bytes) -> Rows:
    con = _open(data)
    try:
        table, geom, columns = _layer(con)
        quote = lambda n: '"' + n.replace('"', '""') + '"'
        got = con.execute(f"SELECT {', '.join(map(quote, [*[n for n, _ in columns], geom]))} FROM {quote(table)}")
        to = [{"boolean": lambda v: v if v is None else bool(v), "double": lambda v: v if v is None else float(v), "string": lambda v: v if v is None else str(v)}.get(k, lambda v: v) for _, k in columns]
        return [(*[f(v) for f, v in zip(to, r)], gpkg_wkb(r[-1])) for r in got]
    finally:
        con.close()


def _gpkg_columns(data: bytes) -> list[tuple[str, str]]:
    con = _open(data)
    try:
        return _layer(con)[2]
    finally:
        con.close()


def read_gpkg(spark: SparkSession, path: str) -> DataFrame:
    """The one layer of GeoPackage files: its columns, and ``geom`` as WKB last."""
    return _read(spark, path, "*.gpkg", _gpkg_columns, _gpkg_rows)


# --- Shapefile ----------------------------------------------------------------------------------------------------


def _ring_area(r: np.ndarray) -> float:
    return float((r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1]).sum() / 2)


def _multi(kind: int, parts: list[bytes]) -> bytes:
    return struct.pack("<BII", 1, kind, len(parts)) + b"".join(parts)


def _inside(p: np.ndarray, ring: np.ndarray) -> bool:
    a, b = ring[:-1], ring[1:]
    spans = (a[:, 1] > p[1]) != (b[:, 1] > p[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        x = a[:, 0] + (p[1] - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])
    return bool((spans & (p[0] < x)).sum() % 2)


def shape_wkb(record: bytes) -> bytes | None:
    """WKB of a shape's content; outer rings run clockwise, and holes go to the ring around them. None for null shapes."""
    (kind,) = struct.unpack_from("<i", record)
    base = kind % 10
    if base == 1:
        return wkb_of(POINT, [np.array([struct.unpack_from("<2d", record, 4)])])
    if base == 8:
        (n,) = struct.unpack_from("<i", record, 36)
        return _multi(MULTIPOINT, [wkb_of(POINT, [p[None]]) for p in np.frombuffer(record, "<f8", 2 * n, 40).reshape(n, 2)])
    if base not in (3, 5):
        return None
    n_parts, n = struct.unpack_from("<2i", record, 36)
    starts = [*struct.unpack_from(f"<{n_parts}i", record, 44), n]
    points = np.frombuffer(record, "<f8", 2 * n, 44 + 4 * n_parts).reshape(n, 2)
    parts = [points[a:b] for a, b in zip(starts, starts[1:])]
    if base == 3:
        return wkb_of(LINESTRING, parts) if len(parts) == 1 else _multi(MULTILINESTRING, [wkb_of(LINESTRING, [p]) for p in parts])
    outer = [[r] for r in parts if _ring_area(r) <= 0] or [[r] for r in parts[:1]]
    known = {id(o[0]) for o in outer}
    for hole in (r for r in parts if id(r) not in known):
        next((o for o in outer if _inside(hole[0], o[0])), outer[0]).append(hole)
    return wkb_of(POLYGON, outer[0]) if len(outer) == 1 else _multi(MULTIPOLYGON, [wkb_of(POLYGON, o) for o in outer])


def shapes(data: bytes) -> list[bytes | None]:
    """WKB of every record of a .shp file."""
    out, at = [], 100
    while at + 8 <= len(data):
        (words,) = struct.unpack_from(">i", data, at + 4)
        out.append(shape_wkb(data[at + 8 : at + 8 + 2 * words]))
        at += 8 + 2 * words
    return out


def dbase(data: bytes) -> tuple[list[tuple[str, str]], Rows]:
    """Columns and rows of a .dbf file; deleted rows come out too, as shapes are matched by place."""
    n, head, size = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 0x0D:
        name = data[at : at + 11].split(b"\0")[0].decode("latin-1")
        kind, width, digits = chr(data[at + 11]), data[at + 16], data[at + 17]
        fields.append((name, "bigint" if kind == "N" and not digits and width < 19 else DBASE.get(kind, "string"), width))
        at += 32
    rows = []
    for i in range(n):
        at, row = head + i * size + 1, []
        for _, kind, width in fields:
            text = data[at : at + width].decode("utf-8", "replace").strip().strip("\0")
            at += width
            try:
                row.append(None if text in ("", "?") or set(text) == {"*"} else int(text) if kind == "bigint" else float(text) if kind == "double" else text in "YyTt" if kind == "boolean" else text)
            except ValueError:
                row.append(None)
        rows.append(tuple(row))
    return [(f[0], f[1]) for f in fields], rows


def read_shapefile(spark: SparkSession, path: str) -> DataFrame:
    """Zipped Shapefiles (.shp and .dbf in one archive): columns of the table, and ``geom`` as WKB last."""
    return _read(spark, path, "*.zip", lambda d: dbase(_member(d, ".dbf"))[0], lambda d: [(*r, g) for r, g in zip(dbase(_member(d, ".dbf"))[1], shapes(_member(d, ".shp")))])


def _member(data: bytes, suffix: str) -> bytes:
    import io
    import zipfile

    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = [n for n in z.namelist() if n.lower().endswith(suffix)]
        if len(names) != 1:
            raise ValueError(f"{len(names)} {suffix} files instead of one")
        return z.read(names[0])


# --- GeoTIFF ------------------------------------------------------------------------------------------------------


def raster_info(data: bytes) -> dict | None:
    """width, height, bands, bits and corners of a TIFF by its first directory; None where it isn't one."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        return None
    (at,) = struct.unpack_from(order + "I", data, 4)
    (n,) = struct.unpack_from(order + "H", data, at)
    size = {1: "B", 2: "s", 3: "H", 4: "I", 11: "f", 12: "d"}
    tags = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        if kind in size and kind != 2:
            form = f"{order}{count}{size[kind]}"
            place = at + 10 + 12 * i
            place = place if struct.calcsize(form) <= 4 else struct.unpack_from(order + "I", data, place)[0]
            tags[tag] = struct.unpack_from(form, data, place)
    width, height = tags[256][0], tags[257][0]
    out = {"width": width, "height": height, "bands": tags.get(277, (1,))[0], "bits": tags.get(258, (1,))[0], "bounds": None}
    if 33550 in tags and 33922 in tags:
        (sx, sy), (i, j, _, x, y) = tags[33550][:2], tags[33922][:5]
        minx, maxy = x - i * sx, y + j * sy
        out["bounds"] = (minx, maxy - height * sy, minx + width * sx, maxy)
    return out


def read_raster_info(spark: SparkSession, path: str) -> DataFrame:
    """path, width, height, bands, bits, bounds of every .tif under a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{tif,tiff}").load(path).select("path", "content")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            infos = [raster_info(c.as_py()) or dict.fromkeys(("width", "height", "bands", "bits", "bounds")) for c in b.column("content")]
            box = [None if i["bounds"] is None else dict(zip(("minx", "miny", "maxx", "maxy"), i["bounds"])) for i in infos]
            columns = [pa.array([i[k] for i in infos], pa.int32()) for k in ("width", "height", "bands", "bits")]
            yield pa.record_batch([b.column("path"), *columns, pa.array(box, pa.struct([(k, pa.float64()) for k in ("minx", "miny", "maxx", "maxy")]))], ["path", "width", "height", "bands", "bits", "bounds"])

    return files.mapInArrow(rows, "path string, width int, height int, bands int, bits int, bounds struct<minx:double,miny:double,maxx:double,maxy:double>")


def self_test(spark: SparkSession) -> dict[str, bool]:
    """Whether what the readers and geometry functions need is there and works on the executors."""
    from cairnlake.functions.geometry import box, from_geojson, geometry_type

    row = spark.createDataFrame([('{"type": "Point", "coordinates": [1, 2]}',)], "g string").withColumn("w", from_geojson("g")).select(geometry_type(F.col("w")).alias("t"), box("w").alias("b")).first()
    return {"geometry types": row.t in NAMES.values(), "extents": tuple(row.b) == (1, 2, 1, 2), "geopackage": hasattr(sqlite3.Connection, "deserialize")}
