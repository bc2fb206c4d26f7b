"""GeoPackage, Shapefile, GeoTIFF, and small catalog helpers."""

import io
import sqlite3
import struct
import zipfile

import numpy as np
import pytest

from cairnlake.functions.geometry import wkb_of
from cairnlake.functions.wkb import POINT, polygons
from cairnlake.operators import catalog as c
from cairnlake.sources import containers as s
from cairnlake.sources.files import union_files, vector_schema

CLOCKWISE = np.array([[0, 0], [0, 4], [4, 4], [4, 0], [0, 0]], float)
HOLE = np.array([[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]], float)


def gpkg(path, rows):
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    con.execute("INSERT INTO gpkg_geometry_columns VALUES ('places', 'shape')")
    con.execute("CREATE TABLE places (fid INTEGER PRIMARY KEY, name TEXT(20), score DOUBLE, open BOOLEAN, shape POINT)")
    for fid, name, score, is_open, p in rows:
        blob = None if p is None else b"GP\0\x01" + struct.pack("<i", 4326) + wkb_of(POINT, [np.array([p], float)])
        con.execute("INSERT INTO places VALUES (?, ?, ?, ?, ?)", (fid, name, score, is_open, blob))
    con.commit()
    con.close()


def test_gpkg(spark, tmp_path):
    gpkg(tmp_path / "a.gpkg", [(1, "x", 1, 1, (3, 4)), (2, None, None, None, None)])
    gpkg(tmp_path / "b.gpkg", [(3, "z", 2.5, 0, (5, 6))])
    df = s.read_gpkg(spark, str(tmp_path))
    assert df.dtypes == [("fid", "bigint"), ("name", "string"), ("score", "double"), ("open", "boolean"), ("geom", "binary")]
    assert [tuple(r)[:4] for r in df.orderBy("fid").collect()] == [(1, "x", 1.0, True), (2, None, None, None), (3, "z", 2.5, False)]
    assert vector_schema(df) == {"fields": {"fid": "integer", "name": "string", "score": "real", "open": "integer"}, "geometry_type": "POINT"}
    assert union_files([df, df]).count() == 6
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError):
        s.read_gpkg(spark, str(tmp_path / "none"))


def shp(records):
    body = b"".join(struct.pack(">ii", i + 1, len(r) // 2) + r for i, r in enumerate(records))
    return struct.pack(">i", 9994) + bytes(20) + struct.pack(">i", (100 + len(body)) // 2) + bytes(72) + body


def ring_record(rings):
    starts = np.cumsum([0, *map(len, rings)])
    return struct.pack("<i4d2i", 5, 0, 0, 4, 4, len(rings), starts[-1]) + struct.pack(f"<{len(rings)}i", *starts[:-1]) + np.vstack(rings).astype("<f8").tobytes()


def test_shapefile(spark, tmp_path):
    fields = [("KEY", "C", 5, 0), ("N", "N", 6, 0), ("V", "N", 8, 2), ("OK", "L", 1, 0)]
    head = b"\x03" + bytes(3) + struct.pack("<IHH", 3, 32 + 32 * len(fields) + 1, 1 + sum(f[2] for f in fields)) + bytes(20)
    head += b"".join(n.encode().ljust(11, b"\0") + k.encode() + bytes(4) + bytes([w, d]) + bytes(14) for n, k, w, d in fields) + b"\r"
    shapes = [ring_record([CLOCKWISE, HOLE]), struct.pack("<i", 0), ring_record([CLOCKWISE, HOLE, CLOCKWISE + 10])]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("p/x.shp", shp(shapes))
        z.writestr("p/x.dbf", head + b" A    " + b"    12" + b"    1.50" + b"T" + b" B    " + b"      " + b"        " + b"?" + b" C    " + b"    -3" + b"********" + b"F")
    (tmp_path / "x.zip").write_bytes(buffer.getvalue())
    df = s.read_shapefile(spark, str(tmp_path))
    got = df.collect()
    assert [tuple(r)[:4] for r in got] == [("A", 12, 1.5, True), ("B", None, None, None), ("C", -3, None, False)]
    assert [len(r) for r in polygons(got[0].geom)] == [2] and got[1].geom is None and [len(r) for r in polygons(got[2].geom)] == [2, 1]
    line = struct.pack("<i4d2i", 3, 0, 0, 1, 1, 1, 2) + struct.pack("<i", 0) + np.array([[0, 0], [1, 1]], "<f8").tobytes()
    assert s.shape_wkb(line)[1] == 2 and s.shape_wkb(struct.pack("<i2d", 1, 5, 6)) == wkb_of(POINT, [np.array([[5.0, 6.0]])])


def test_raster(spark, tmp_path):
    tags = [(256, 3, 1, struct.pack("<HH", 30, 0)), (257, 3, 1, struct.pack("<HH", 20, 0)), (258, 3, 1, struct.pack("<HH", 8, 0)), (277, 3, 1, struct.pack("<HH", 3, 0)), (33550, 12, 3, struct.pack("<I", 200)), (33922, 12, 6, struct.pack("<I", 300))]
    data = bytearray(400)
    data[:8] = b"II*\0" + struct.pack("<I", 8)
    data[8:10] = struct.pack("<H", len(tags))
    for i, (tag, kind, n, value) in enumerate(tags):
        data[10 + 12 * i : 22 + 12 * i] = struct.pack("<HHI", tag, kind, n) + value
    data[200:224] = struct.pack("<3d", 0.5, 0.25, 0)
    data[300:348] = struct.pack("<6d", 0, 0, 0, 100, 50, 0)
    (tmp_path / "a.tif").write_bytes(data)
    (tmp_path / "b.tif").write_bytes(b"nothing")
    rows = s.read_raster_info(spark, str(tmp_path)).orderBy("path").collect()
    assert tuple(rows[0])[1:5] == (30, 20, 3, 8) and tuple(rows[0].bounds) == (100, 45, 115, 50) and rows[1].width is None


def test_self(spark):
    assert all(s.self_test(spark).values())


def test_small_helpers(spark):
    runs = spark.createDataFrame([("r", [("batch_id", "b")], 0.0, None), ("q", None, 1.5, 2.0)], "run_id string, tags array<struct<key:string,value:string>>, start_time double, end_time double")
    assert {r.run_id: (r.batch_id, r.started_at is not None, r.completed_at is not None) for r in c.run_rows(runs).collect()} == {"r": ("b", True, False), "q": (None, True, True)}
    assert c.event_rows(spark.createDataFrame([("1500",)], "timestamp string")).first().at.microsecond == 500_000
    versions = spark.createDataFrame([(3,), (1,), (2,)], "version int")
    assert [r.version for r in c.pending(versions, versions.where("version = 1")).collect()] == [2, 3]
    keys = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "key string, seq long")
    assert [r.key for r in c.last_keys(keys, most=1).collect()] == ["a"]


def test_vector_files_go_to_the_reader_of_their_format(spark, tmp_path):
    from cairnlake.plans.pipelines import Lake, ingest_vector

    lake = Lake(spark, str(tmp_path / "lake"))
    gpkg(tmp_path / "a.gpkg", [(1, "x", 1, 1, (3, 4)), (2, "y", 2, 0, (5, 6))])
    gpkg(tmp_path / "none.gpkg", [])
    point = struct.pack("<i2d", 1, 7, 8)
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("s.shp", shp([point]))
        z.writestr("s.dbf", b"\x03" + bytes(3) + struct.pack("<IHH", 1, 65, 3) + bytes(20) + b"K".ljust(11, b"\0") + b"C" + bytes(4) + bytes([2, 0]) + bytes(14) + b"\r" + b" ab")
    feature = '{"type": "Feature", "properties": {"a": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}'
    texts = {"good": feature + "\n\n" + feature + "\n", "cut": feature + "\n" + feature[:40], "collection": '{"type": "FeatureCollection", "features": [' + feature + ", {", "empty": '{"type": "FeatureCollection", "features": []}'}
    for name, text in texts.items():
        (tmp_path / f"{name}.geojson").write_text(text)

    def run(name, **more):
        return ingest_vector(lake, {"intent": "ingest_vector", "files": [{"path": str(tmp_path / name), **more}], "metadata": {"title": "t", "description": "d", "keywords": ["k"], "source": "s", "license": "l", "attribution": "a", "tags": {"dataset_id": "d"}}}, "r")

    assert [run("a.gpkg")["row_count"], run("a.gpkg", format="GPKG")["row_count"], run("s.zip", format="ESRI Shapefile")["row_count"], run("good.geojson", format="GeoJSON")["row_count"]] == [2, 2, 1, 2]
    for name, more in (("none.gpkg", {}), ("a.gpkg", {"format": "KML"}), ("a.gpkg", {"format": "GeoJSON"}), ("a.kml", {}), ("cut.geojson", {}), ("collection.geojson", {}), ("empty.geojson", {})):
        with pytest.raises(ValueError):
            run(name, **more)
    assert lake.assets.count() == 4
