"""Geometry functions and the key join."""

import json
import math
import struct
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairnlake.functions import geometry as g
from cairnlake.functions.wkb import POINT, POLYGON, decode_points, encode_points, polygons, walk
from cairnlake.operators.keyjoin import join_stats, key_join

SQUARE = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
FAR = [[5, 5], [6, 5], [6, 6], [5, 6], [5, 5]]


def poly(ring):
    return g.wkb_of_geojson({"type": "Polygon", "coordinates": [ring]})


@pytest.fixture(scope="module")
def sides(spark):
    tabular = spark.createDataFrame([("A", 1), ("B", 2)], "parcel_id string, value int")
    spatial = spark.createDataFrame([("A", poly(SQUARE), 9), ("C", poly(FAR), 8)], "parcel_id string, geom binary, value int")
    return tabular, spatial


@pytest.mark.parametrize("how, rows, box", [("left", 2, (0, 0, 2, 2)), ("inner", 1, (0, 0, 2, 2)), ("right", 2, (0, 0, 6, 6)), ("outer", 3, (0, 0, 6, 6))])
def test_join_types(sides, how, rows, box):
    out = key_join(*sides, "parcel_id", how=how)
    assert out.columns == ["parcel_id", "value", "geom"]
    assert tuple(join_stats(out).first()) == (rows, *box, "POLYGON")


def test_keys_are_text(spark, sides):
    t = spark.createDataFrame([("01",), ("1",), (None,), ("1",)], "k string")
    s = spark.createDataFrame([(1, None), (None, None), (1, None)], "k int, geom binary")
    assert key_join(t, s, "k", how="inner").count() == 4 and key_join(t, s, "k").count() == 6
    assert key_join(t, s, "k", hot=True).count() == 6
    assert tuple(join_stats(key_join(t.limit(0), s, "k")).first()) == (0, None, None, None, None, "UNKNOWN")


def test_refusals(spark, sides):
    t, s = sides
    for args in (("nope",), ("parcel_id", "nope"), ("parcel id",), ("parcel_id", "parcel_id", "cross")):
        with pytest.raises(ValueError):
            key_join(t, s, *args)
    with pytest.raises(ValueError):
        key_join(t.withColumn("geom", F.lit(1)), s, "parcel_id")


coordinate = st.floats(-180, 180, allow_nan=False)


@given(st.lists(st.tuples(coordinate, coordinate), max_size=20))
def test_points_round_trip(points):
    import pyarrow as pa

    x, y = (np.array([p[i] for p in points], float) for i in (0, 1))
    lon, lat = decode_points(pa.array([*encode_points(x, y).to_pylist(), None, b"", b"\x01\x01"], pa.binary()))
    assert (lon[: len(x)] == x).all() and (lat[: len(y)] == y).all() and np.isnan(lon[len(x) :]).all()


def test_dialects():
    import pyarrow as pa

    forms = [
        struct.pack("<BIdd", 1, 1, 3, 4), struct.pack(">BIdd", 0, 1, 3, 4), struct.pack("<BIIdd", 1, 0x20000001, 4326, 3, 4), struct.pack("<BIddd", 1, 1001, 3, 4, 5),
        struct.pack("<BIddd", 1, 0x80000001, 3, 4, 5), struct.pack(">BIIdddd", 0, 0xE0000001, 1, 3, 4, 5, 6), struct.pack("<BIdddd", 1, 3001, 3, 4, 5, 6),
    ]
    bad = [struct.pack("<BIddd", 1, 1001, 3, 4, 5)[:-1], struct.pack("<BI", 1, 1), poly(SQUARE), b"\x02" + forms[0][1:]]
    lon, lat = decode_points(pa.array(forms + bad, pa.binary()).slice(0))
    assert lon[:7].tolist() == [3.0] * 7 and lat[:7].tolist() == [4.0] * 7 and np.isnan(lon[7:]).all()
    sliced, _ = decode_points(pa.array(forms, pa.binary()).slice(2, 3))
    assert sliced.tolist() == [3.0] * 3


def test_type_and_box(spark):
    kinds = {"POINT": {"type": "Point", "coordinates": [1, 2]}, "LINESTRING": {"type": "LineString", "coordinates": [[0, 0], [3, 1]]}, "POLYGON": {"type": "Polygon", "coordinates": [SQUARE]}, "MULTIPOLYGON": {"type": "MultiPolygon", "coordinates": [[SQUARE], [FAR]]}, "GEOMETRYCOLLECTION": {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [7, 8]}]}}
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in kinds.items()] + [(None, None), (None, "nonsense"), (None, "{}")], "k string, j string").withColumn("w", g.from_geojson("j"))
    rows = df.select("k", g.geometry_type(F.col("w")).alias("t"), g.box("w").alias("b")).collect()
    assert all(r.k == r.t for r in rows) and tuple(rows[3].b) == (0, 0, 6, 6) and tuple(rows[4].b) == (7, 8, 7, 8)
    assert df.agg(g.overall_type(F.col("w"))).first()[0] == "GEOMETRY"
    big = spark.createDataFrame([(struct.pack(">BIdd", 0, 1, 3, 4),), (b"\x01",), (struct.pack("<BI", 1, 99),)], "w binary")
    assert [r[0] for r in big.select(g.geometry_type(F.col("w"))).collect()] == ["POINT", None, None]


def test_systems():
    p = np.array([[151.2, -33.9], [115.8, -31.9]])
    assert np.allclose(g.to_degrees(g.to_mercator(p), 3857), p, atol=1e-9)
    # the zone's central meridian, and a place whose grid coordinates are known: 0 degrees north of the equator
    assert np.allclose(g.to_degrees(np.array([[500_000.0, 10_000_000.0]]), 32756), [[153, 0]], atol=1e-9)
    # quarter meridian of WGS 84 times the scale factor
    assert np.allclose(g.to_degrees(np.array([[500_000.0, 10_001_965.729 * 0.9996]]), 32631), [[3, 90]], atol=1e-6)
    with pytest.raises(ValueError):
        g.transform(F.lit(None), "EPSG:9999")
    with pytest.raises(ValueError):
        g.epsg("+proj=utm")


def test_transform_column(spark):
    df = spark.createDataFrame([(poly(SQUARE),), (None,), (b"\x01",)], "geom binary")
    back = df.select(g.transform(g.transform(F.col("geom"), "EPSG:4326", "EPSG:3857"), "EPSG:3857").alias("b")).collect()
    assert np.allclose(polygons(back[0].b)[0][0], SQUARE, atol=1e-9) and back[1].b is None and back[2].b is None


def test_simplify(spark):
    t = np.linspace(0, 2 * math.pi, 400)
    circle = np.stack([np.cos(t), np.sin(t)], 1)
    circle[-1] = circle[0]
    (out,) = g.simplified(POLYGON, [circle], 0.01)
    assert 4 <= len(out) < 60 and (out[0] == out[-1]).all() and not g._crosses(out)
    assert len(g.simplified(POLYGON, [circle], 100)[0]) >= 4
    assert (g.simplified(POINT, [circle[:1]], 1)[0] == circle[:1]).all()
    ring = g.wkb_of(POLYGON, [circle])
    rows = spark.createDataFrame([(ring,), (None,)], "geom binary").select(g.simplify(F.col("geom"), 0.01).alias("s")).collect()
    assert len(list(walk(rows[0].s))[0][1][0]) == len(out) and rows[1].s is None


def test_rings_stay_apart():
    """A hole that hugs its shell: simplified alone the two would cross, together they don't."""
    t = np.linspace(0, 2 * math.pi, 200)
    shell = np.stack([np.cos(t), np.sin(t)], 1)
    shell[-1] = shell[0]
    hole = shell[::-1] * 0.99
    alone = [g.simplified(POLYGON, [r], 0.05)[0] for r in (shell, hole)]
    both = g.simplified(POLYGON, [shell, hole], 0.05)
    assert g._crosses(*alone) and not g._crosses(*both) and sum(map(len, both)) < 400


@pytest.mark.parametrize("seed", range(30))
def test_crossings(seed):
    """Against all pairs of segments."""
    rnd = np.random.default_rng(seed)
    lines = [np.cumsum(rnd.normal(size=(int(rnd.integers(2, 9)), 2)), axis=0) + rnd.normal(size=2) * 4 for _ in range(2)]
    if seed % 3 == 0:
        lines[0] = np.vstack([lines[0], lines[0][:1]])

    def meet(p, q, r, s):
        o = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        return o(p, q, r) * o(p, q, s) <= 0 and o(r, s, p) * o(r, s, q) <= 0

    segments = [(i, k, p[k], p[k + 1]) for i, p in enumerate(lines) for k in range(len(p) - 1)]
    closed = [(p[0] == p[-1]).all() for p in lines]
    beside = lambda a, b: a[0] == b[0] and (abs(a[1] - b[1]) == 1 or (closed[a[0]] and abs(a[1] - b[1]) == len(lines[a[0]]) - 2))
    want = any(meet(*a[2:], *b[2:]) for x, a in enumerate(segments) for b in segments[x + 1 :] if not beside(a, b))
    assert g._crosses(*lines) == want


@pytest.mark.parametrize("how", ["left", "inner", "right", "outer"])
def test_hot_keys_give_the_same_join(spark, how):
    """Keys split over tasks, whatever the join: null keys, repeated keys, maps among the columns, features without a row."""
    rows = [(i, None if i % 7 == 0 else str(i % 5), {"a": str(i)}) for i in range(60)]
    tabular = spark.createDataFrame(rows, "id int, k string, m map<string,string>")
    spatial = spark.createDataFrame([("1", b"a"), ("1", b"b"), ("3", b"c"), ("9", b"d"), ("9", b"d"), (None, b"e"), ("4", None)], "key string, geom binary")
    plain, hot, none = (
        Counter((r.id, r.k, str(r.m), r.geom) for r in key_join(t, spatial, "k", "key", how, hot=h, rows=2).collect()) for t, h in ((tabular, False), (tabular, True), (tabular.where("k is null"), True))
    )
    assert plain == hot and sum(plain.values()) > 20
    assert sum(none.values()) == {"left": 9, "inner": 0, "right": 7, "outer": 16}[how]
