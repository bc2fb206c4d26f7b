"""Neighbours and regions against brute force."""

import math
import random
import struct
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairnlake.functions.geometry import wkb_of, wkb_of_geojson
from cairnlake.functions.wkb import POLYGON
from cairnlake.operators import proximity
from cairnlake.operators.proximity import EARTH_M, _at, containing, neighbours, one_per_place, places, polygon_slabs, tile_slabs

METRES = 30.0


def frame(spark, points):
    rows = [(i, struct.pack("<BIdd", 1, 1, x, y)) for i, (x, y) in enumerate(points)]
    return spark.createDataFrame([*rows, *rows[:3], (None, rows[0][1]), (10**6, None), (10**6, b""), (10**6, rows[0][1][:-1]), (10**6, struct.pack("<BIdd", 1, 1, 181, 0)), (10**6, struct.pack("<BIdd", 1, 1, math.nan, 0))], "id long, geom binary").withColumns({"cell": F.lit(1), "lon": F.lit("x")})


def apart(p, q):
    (x1, y1), (x2, y2) = (np.radians(a) for a in (p, q))
    a = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
    return 2 * EARTH_M * math.asin(math.sqrt(a))


def points():
    rnd = random.Random(3)
    step = math.degrees(METRES / EARTH_M)
    out = []
    for lon, lat in ((151.0, -33.9), (180.0, 10.0), (-180.0, 10.0), (0.0, 89.9999), (90.0, -90.0), (10.0, 0.0), (25.0, 71.0)):
        for _ in range(60):
            x = lon + rnd.uniform(-4, 4) * step / max(math.cos(math.radians(lat)), 0.02)
            out.append(((x + 180) % 360 - 180, max(-90, min(90, lat + rnd.uniform(-4, 4) * step))))
    return out + [out[0], (180.0, 10.0), (-180.0, 10.0), (0.0, 90.0), (77.0, 90.0)]


@pytest.mark.parametrize("dense", [4000, 5])
def test_neighbours(spark, dense):
    p = points()
    rows = [(r.id_a, r.id_b) for r in neighbours(places(frame(spark, p), "id", "geom"), METRES, dense).collect()]
    want = {(i, j) for i in range(len(p)) for j in range(i + 1, len(p)) if apart(p[i], p[j]) <= METRES}
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 500


@pytest.mark.parametrize("metres", [2_000, 700_000, 6_000_000])
def test_neighbours_far_apart(spark, metres):
    rnd = random.Random(metres)
    p = [(rnd.uniform(-180, 180), math.degrees(math.asin(rnd.uniform(-1, 1)))) for _ in range(120)] + [(rnd.uniform(10, 10.1), rnd.uniform(60, 60.1)) for _ in range(60)] + [(0.0, 90.0), (5.0, -90.0)]
    rows = [(r.id_a, r.id_b) for r in neighbours(places(frame(spark, p), "id", "geom"), metres).collect()]
    want = {(i, j) for i in range(len(p)) for j in range(i + 1, len(p)) if apart(p[i], p[j]) <= metres}
    assert len(rows) == len(set(rows)) and set(rows) == want and len(want) > 50


def inside(rings, x, y):
    odd = False
    for r in rings:
        for (x0, y0), (x1, y1) in zip(r[:-1], r[1:]):
            if (y0 > y) != (y1 > y) and x0 + (y - y0) * (x1 - x0) / (y1 - y0) < x:
                odd = not odd
    return odd


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(-5, 5)), min_size=3, max_size=12), st.lists(st.tuples(st.floats(-6, 6), st.floats(-6, 6)), min_size=1, max_size=20))
def test_slabs_of_any_ring(ring, places_):
    """Even rings that cross themselves are cut into slabs in which edges keep their order."""
    ring = np.array([*ring, ring[0]], float)
    slabs = list(polygon_slabs([ring]))
    for y0, y1, e in slabs:
        for y in (y0 + 0.25 * (y1 - y0), y0 + 0.75 * (y1 - y0)):
            assert (np.diff(_at(e, y)) >= -1e-9).all()
    for x, y in places_:
        if min([abs(x - v) for y0, y1, e in slabs if y0 <= y < y1 for v in _at(e, y)], default=1) < 1e-9:
            continue
        hits = [sum(_at(e, y) < x) % 2 for y0, y1, e in slabs if y0 <= y < y1]
        assert (hits == [1]) == inside([ring], x, y)


@pytest.mark.parametrize("sent", [True, False])
def test_regions(spark, monkeypatch, sent):
    """By slabs that are sent to every executor and by a shuffle by tile."""
    if not sent:
        monkeypatch.setattr(proximity, "BROADCAST_BYTES", 0)
    hole = [[0.5, 0.5], [1.5, 0.5], [1.5, 1.5], [0.5, 1.5], [0.5, 0.5]]
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    shapes = {1: {"type": "Polygon", "coordinates": [square, hole]}, 2: {"type": "MultiPolygon", "coordinates": [[square], [[[5, 5], [7, 5], [6, 8], [5, 5]]]]}, 3: {"type": "Polygon", "coordinates": [[[-1, -1], [3, -1], [1, 3.7], [-1, -1]]]}}
    rows = [(k, wkb_of_geojson(s)) for k, s in shapes.items()] + [(4, None), (5, b"\x01\x02"), (6, wkb_of(POLYGON, [np.zeros((4, 2))])), (None, wkb_of_geojson(shapes[1])), (7, wkb_of_geojson({"type": "Point", "coordinates": [1, 1]}))]
    regions = spark.createDataFrame([*rows, rows[0]], "region_id long, geom binary").withColumn("region", F.lit(0))
    rnd = random.Random(1)
    p = [(rnd.uniform(-2, 8), rnd.uniform(-2, 9)) for _ in range(400)] + [(1.0, 1.0), (-0.0, 0.25)]
    got = [(r.region, r.id) for r in containing(places(frame(spark, p), "id", "geom"), regions, "region_id", "geom").collect()]
    parts = {1: [[square, hole]], 2: [[square], [[[5, 5], [7, 5], [6, 8], [5, 5]]]], 3: [shapes[3]["coordinates"]]}
    want = {(k, i) for k, ps in parts.items() for i, q in enumerate(p) if any(inside(r, *q) for r in ps)}
    assert len(got) == len(set(got)) and set(got) == want


def star(n, x, y, size, seed=4, rough=0.7):
    """A simple ring of n corners around a place."""
    rnd = np.random.default_rng(seed)
    turn = np.sort(rnd.uniform(0, 2 * math.pi, n))
    far = size * rnd.uniform(1 - rough, 1, n)
    ring = np.stack([x + far * np.cos(turn), y + far * np.sin(turn)], axis=1)
    return np.vstack([ring, ring[:1]])


STAIRS = np.array([(-2, -2), (2.2, -2), (2.2, 0.3), (1, 0.3), (1, 0.6), (0.5, 0.6), (0.5, 2.1), (-2, 2.1), (-2, -2)], float)


@pytest.mark.parametrize("tile", [0.25, 1.0, 0.07])
@pytest.mark.parametrize("rings", [[star(300, 0.1, 0.2, 2.0), star(40, 0.1, 0.2, 0.5, 5)[::-1]], [STAIRS, STAIRS * 0.5]])
def test_tiles_hold_only_edges_near_them(tile, rings):
    """Over many tiles, some wholly inside, with a hole, with level edges: every point finds what brute force says."""
    rows: dict = {}
    for tx, ty, every in tile_slabs(rings, tile):
        assert (tx, ty) not in rows
        rows[tx, ty] = every
    assert sum(len(e) for every in rows.values() for *_, e in every) < 60_000
    rnd = random.Random(2)
    for _ in range(3000):
        x, y = rnd.uniform(-2.2, 2.4), rnd.uniform(-2.2, 2.4)
        got = [odd + int((_at(e, y) < x).sum()) for y0, y1, odd, e in rows.get((math.floor(x / tile), math.floor(y / tile)), []) if y0 <= y < y1]
        assert len(got) <= 1 and (sum(got) % 2 == 1) == inside(rings, x, y)


def test_a_region_of_many_corners(spark):
    """A hundred thousand corners, many slabs in a tile, rows of a few slabs each; under a minute."""
    ring = star(100_000, 5, 5, 1.5, rough=0.002)
    began = time.time()
    regions = spark.createDataFrame([(1, wkb_of(POLYGON, [ring]))], "k long, geom binary")
    rnd = random.Random(6)
    p = [(rnd.uniform(3.4, 6.6), rnd.uniform(3.4, 6.6)) for _ in range(300)]
    got = {r.id for r in containing(places(frame(spark, p), "id", "geom"), regions, "k", "geom").collect()}
    assert time.time() - began < 60
    x0, y0, x1, y1 = np.hstack([ring[:-1], ring[1:]]).T

    def within(x, y):
        up = (y0 > y) != (y1 > y)
        return (x0[up] + (y - y0[up]) * (x1[up] - x0[up]) / (y1[up] - y0[up]) < x).sum() % 2 == 1

    assert got == {i for i, q in enumerate(p) if within(*q)}


def test_a_crowded_cell_is_split_by_its_points(spark):
    """Many points at two places 20 m apart: as many blocks as they need, and every pair once."""
    step = math.degrees(20 / EARTH_M)
    p = [(10.0, 50.0)] * 150 + [(10.0, 50.0 + step)] * 90 + [(10.0, 50.0 + 4 * step)] * 30
    rows = [(r.id_a, r.id_b) for r in neighbours(places(frame(spark, p), "id", "geom"), METRES, dense=8).collect()]
    assert len(rows) == len(set(rows)) == 240 * 239 // 2 + 30 * 29 // 2
    same = {r.id: r.place for r in one_per_place(places(frame(spark, p), "id", "geom")).collect()}
    assert same == {i: 0 if i < 150 else 150 if i < 240 else 240 for i in range(270)}


def test_empty(spark):
    none = places(frame(spark, [(0.0, 0.0)]).limit(0), "id", "geom")
    regions = spark.createDataFrame([], "k long, geom binary")
    assert neighbours(none, METRES).count() == 0 and containing(none, regions, "k", "geom").count() == 0
