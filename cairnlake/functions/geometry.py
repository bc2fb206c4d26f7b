"""Geometry in WKB columns: type, extent, building, reprojection, simplification.

Type names are read with built-in byte functions; what needs coordinates runs over whole Arrow batches. Geometry stays
WKB in binary columns named geom. Empty, null and unreadable geometries have a null extent and type.
"""

from __future__ import annotations

import json
import math
import struct
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnlake.functions.wkb import COLLECTION, LINESTRING, MULTILINESTRING, MULTIPOINT, MULTIPOLYGON, POINT, POLYGON, _Reader, decode_points, encode_points, walk

#: Names of type codes.
NAMES = {POINT: "POINT", LINESTRING: "LINESTRING", POLYGON: "POLYGON", MULTIPOINT: "MULTIPOINT", MULTILINESTRING: "MULTILINESTRING", MULTIPOLYGON: "MULTIPOLYGON", COLLECTION: "GEOMETRYCOLLECTION"}
BOX = T.StructType([T.StructField(k, T.DoubleType()) for k in ("minx", "miny", "maxx", "maxy")])


def type_code(geom: Column) -> Column:
    """The type code, 1 to 7, whatever the byte order and the dialect."""
    word = lambda *at: F.concat(*[F.substring(geom, i, 1) for i in at])
    order = F.hex(F.substring(geom, 1, 1))
    code = F.conv(F.hex(F.when(order == "01", word(5, 4, 3, 2)).when(order == "00", word(2, 3, 4, 5))), 16, 10).cast("long")
    return F.when(F.length(geom) >= 5, (code.bitwiseAND(F.lit(0x1FFFFFFF)) % 1000).cast("int"))


def geometry_type(geom: Column) -> Column:
    """POINT, POLYGON and so on; null for codes that are none."""
    table = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    return F.try_element_at(table, type_code(geom))


def overall_type(geom: Column) -> Column:
    """Aggregate: the one type of all geometries, GEOMETRY where they differ, UNKNOWN where there are none."""
    kinds = F.collect_set(geometry_type(geom))  # seven at most
    return F.when(F.size(kinds) == 0, "UNKNOWN").when(F.size(kinds) == 1, kinds[0]).otherwise("GEOMETRY")


def _box(wkb: bytes | None) -> tuple | None:
    if not wkb:
        return None
    try:
        parts = [a for _, arrays in walk(wkb) for a in arrays if len(a)]
    except (struct.error, ValueError):
        return None
    points = np.vstack(parts) if parts else np.empty((0, 2))
    points = points[np.isfinite(points).all(axis=1)]
    return (*points.min(axis=0), *points.max(axis=0)) if len(points) else None


@F.arrow_udf(BOX)
def box(geom: pa.Array) -> pa.Array:
    """minx, miny, maxx, maxy of each geometry: points all at once, others one by one."""
    lon, lat = decode_points(geom)
    sides = np.stack([lon, lat, lon, lat])
    sides[:, ~np.isfinite(lon + lat)] = np.nan
    for i in np.flatnonzero(np.isnan(sides[0]) & np.asarray(geom.is_valid())):
        sides[:, i] = _box(geom[i].as_py()) or np.nan
    nothing = pa.array(np.isnan(sides[0]))
    return pa.StructArray.from_arrays([pa.array(c, mask=np.isnan(c)) for c in sides], ["minx", "miny", "maxx", "maxy"], mask=nothing)


def extent(b: Column) -> Column:
    """Aggregate: the box around boxes; null where there are none."""
    sides = [F.min(b["minx"]).alias("minx"), F.min(b["miny"]).alias("miny"), F.max(b["maxx"]).alias("maxx"), F.max(b["maxy"]).alias("maxy")]
    return F.when(F.count(b["minx"]) > 0, F.struct(*sides))


def z_order(geom: Column) -> Column:
    """The place of a geometry's middle along a curve through all longitudes and latitudes, near for what lies together."""
    b = box(geom)

    def spread(x: Column, least: float, size: float) -> Column:
        n = F.least(F.greatest(F.floor((x - least) / size * (1 << 31)), F.lit(0)), F.lit((1 << 31) - 1)).cast("long")
        n = F.when(x.isNotNull(), n)  # least and greatest pass nulls over
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            n = n.bitwiseOR(F.shiftleft(n, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return n

    x, y = spread((b["minx"] + b["maxx"]) / 2, -180.0, 360.0), spread((b["miny"] + b["maxy"]) / 2, -90.0, 180.0)
    return x.bitwiseOR(F.shiftleft(y, 1))


@F.arrow_udf(T.BinaryType())
def point(x: pa.Array, y: pa.Array) -> pa.Array:
    """WKB points of coordinates; null where either is null."""
    both = np.asarray(x.is_valid()) & np.asarray(y.is_valid())
    x, y = (np.asarray(c.cast(pa.float64()).fill_null(0.0)) for c in (x, y))
    return pc.if_else(pa.array(both), encode_points(x, y), pa.scalar(None, pa.large_binary())).cast(pa.binary())


def _head(kind: int) -> bytes:
    return struct.pack("<BI", 1, kind)


def _line(a: np.ndarray) -> bytes:
    return struct.pack("<I", len(a)) + np.ascontiguousarray(a, "<f8").tobytes()


def wkb_of(kind: int, arrays: list[np.ndarray]) -> bytes:
    """WKB of a simple geometry."""
    if kind == POINT:
        return _head(kind) + np.ascontiguousarray(arrays[0][0], "<f8").tobytes()
    if kind == LINESTRING:
        return _head(kind) + _line(arrays[0])
    return _head(kind) + struct.pack("<I", len(arrays)) + b"".join(map(_line, arrays))


def wkb_of_geojson(g: dict | None) -> bytes | None:
    """WKB of a GeoJSON geometry; None where it isn't one."""
    if not g:
        return None
    flat = lambda c: np.array([p[:2] for p in c], float).reshape(-1, 2)
    kind, c = g.get("type"), g.get("coordinates")
    try:
        if kind == "Point":
            return wkb_of(POINT, [flat([c])]) if c else wkb_of(POINT, [np.full((1, 2), np.nan)])
        if kind == "LineString":
            return wkb_of(LINESTRING, [flat(c)])
        if kind == "Polygon":
            return wkb_of(POLYGON, [flat(r) for r in c])
        many = {"MultiPoint": (MULTIPOINT, lambda p: wkb_of(POINT, [flat([p])])), "MultiLineString": (MULTILINESTRING, lambda p: wkb_of(LINESTRING, [flat(p)])), "MultiPolygon": (MULTIPOLYGON, lambda p: wkb_of(POLYGON, [flat(r) for r in p]))}
        if kind in many:
            code, one = many[kind]
            return _head(code) + struct.pack("<I", len(c)) + b"".join(map(one, c))
        if kind == "GeometryCollection":
            parts = [wkb_of_geojson(x) for x in g.get("geometries", [])]
            return None if None in parts else _head(COLLECTION) + struct.pack("<I", len(parts)) + b"".join(parts)
    except (TypeError, ValueError, IndexError, KeyError):
        return None
    return None


@F.pandas_udf(T.BinaryType())
def from_geojson(text: pd.Series) -> pd.Series:
    """WKB of GeoJSON geometries as text."""

    def one(t: str | None) -> bytes | None:
        try:
            return wkb_of_geojson(json.loads(t)) if t else None
        except ValueError:
            return None

    return text.map(one, na_action=None).astype(object)


Change = Callable[[int, list[np.ndarray]], list[np.ndarray]]


def mapped(wkb: bytes | None, change: Change) -> bytes | None:
    """A geometry as plain little-endian WKB with the coordinate arrays of each of its parts (a polygon's rings together)
    changed; None where it cannot be read."""
    if not wkb:
        return None
    try:
        return _mapped(_Reader(wkb), change)
    except (struct.error, ValueError):
        return None


def _mapped(r: _Reader, change: Change) -> bytes:
    end, kind, axes = r.head()
    if kind == POINT:
        return wkb_of(kind, change(kind, [r.points(end, axes, 1)]))
    if kind == LINESTRING:
        return wkb_of(kind, change(kind, [r.points(end, axes, r.take(end + "I")[0])]))
    (n,) = r.take(end + "I")
    if kind == POLYGON:
        return wkb_of(kind, change(kind, [r.points(end, axes, r.take(end + "I")[0]) for _ in range(n)]))
    if kind not in NAMES:
        raise struct.error("no geometry")
    return _head(kind) + struct.pack("<I", n) + b"".join(_mapped(r, change) for _ in range(n))


def _each(column: pa.Array, change: Change, points: Callable[[np.ndarray], np.ndarray] | None = None) -> pa.Array:
    """``mapped`` over a column; points, where told how, all at once."""
    out = np.empty(len(column), object)
    rest = np.arange(len(column))
    if points is not None:
        lon, lat = decode_points(column)
        flat = np.flatnonzero(np.isfinite(lon + lat))
        if len(flat):
            done = points(np.stack([lon[flat], lat[flat]], axis=1))
            out[flat] = encode_points(done[:, 0].copy(), done[:, 1].copy()).to_numpy(zero_copy_only=False)
            rest = np.setdiff1d(rest, flat, assume_unique=True)
    for i in rest:
        out[i] = mapped(column[int(i)].as_py(), change)
    return pa.array(out, pa.binary())


# --- coordinate systems -------------------------------------------------------------------------------------------

#: Systems of degrees that agree with EPSG:4326 within what a null transformation states (about a metre).
DEGREES = (4326, 4283, 7844, 4269, 4258)
_A, _F = 6378137.0, 1 / 298.257223563


def _utm(code: int) -> tuple[float, float] | None:
    """Central meridian and false northing of a Krüger zone: 326zz and 327zz (WGS 84), 283zz (GDA94), 78zz (GDA2020)."""
    for base, low, high, south in ((32600, 1, 60, False), (32700, 1, 60, True), (28300, 46, 59, True), (7800, 46, 59, True)):
        if low <= code - base <= high:
            return -183 + 6 * (code - base), 10_000_000.0 if south else 0.0
    return None


def _krueger_inverse(x: np.ndarray, y: np.ndarray, meridian: float, northing: float) -> tuple[np.ndarray, np.ndarray]:
    n = _F / (2 - _F)
    a = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3, n**2 / 48 + n**3 / 15, 17 / 480 * n**3)
    delta = (2 * n - 2 / 3 * n**2 - 2 * n**3, 7 / 3 * n**2 - 8 / 5 * n**3, 56 / 15 * n**3)
    xi, eta = (y - northing) / (0.9996 * a), (x - 500_000) / (0.9996 * a)
    p, q = xi.copy(), eta.copy()
    for j, b in enumerate(beta, 1):
        p -= b * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
        q -= b * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
    chi = np.arcsin(np.sin(p) / np.cosh(q))
    lat = chi + sum(d * np.sin(2 * j * chi) for j, d in enumerate(delta, 1))
    return meridian + np.degrees(np.arctan2(np.sinh(q), np.cos(p))), np.degrees(lat)


def to_degrees(points: np.ndarray, code: int) -> np.ndarray:
    """Longitude and latitude of coordinates in a known system; ValueError for any other."""
    if code in DEGREES:
        return points
    x, y = points[:, 0], points[:, 1]
    if code == 3857:
        return np.stack([np.degrees(x / _A), np.degrees(2 * np.arctan(np.exp(y / _A)) - math.pi / 2)], axis=1)
    if zone := _utm(code):
        return np.stack(_krueger_inverse(x, y, *zone), axis=1)
    raise ValueError(f"no transformation from EPSG:{code}")


def to_mercator(points: np.ndarray) -> np.ndarray:
    """Web Mercator metres of degrees."""
    return np.stack([np.radians(points[:, 0]) * _A, np.log(np.tan(math.pi / 4 + np.radians(points[:, 1]) / 2)) * _A], axis=1)


def epsg(code: str) -> int:
    """The number of an EPSG code; ValueError for other systems, which aren't guessed."""
    if not code.upper().startswith("EPSG:"):
        raise ValueError(f"no transformation from {code}")
    return int(code[5:])


def transform(geom: Column, source: str, target: str = "EPSG:4326") -> Column:
    """Geometry of one system in another: to EPSG:4326 from the systems of ``to_degrees``, on to EPSG:3857 from those."""
    a, b = epsg(source), epsg(target)
    if b not in (*DEGREES, 3857):
        raise ValueError(f"no transformation to {target}")
    to_degrees(np.zeros((1, 2)), a)
    if a == b or (a in DEGREES and b in DEGREES):
        return geom

    @F.arrow_udf(T.BinaryType())
    def changed(g: pa.Array) -> pa.Array:
        def moved(p: np.ndarray) -> np.ndarray:
            p = to_degrees(p, a)
            return to_mercator(p) if b == 3857 else p

        return _each(g, lambda _, arrays: [moved(p) for p in arrays], moved)

    return changed(geom)


# --- simplification -----------------------------------------------------------------------------------------------


def _kept(p: np.ndarray, tolerance: float, least: int) -> np.ndarray:
    """Douglas-Peucker: which points stay, with the farthest kept until there are at least ``least``."""
    keep = np.zeros(len(p), bool)
    keep[[0, -1]] = True
    stack, spare = [(0, len(p) - 1)], []
    while stack:
        i, j = stack.pop()
        if j - i < 2:
            continue
        d = p[j] - p[i]
        inner = p[i + 1 : j] - p[i]
        size = d @ d
        along = np.clip(inner @ d / size, 0, 1) if size > 0 else np.zeros(len(inner))
        off = np.hypot(*(inner - along[:, None] * d).T)
        k = i + 1 + int(off.argmax())
        if off.max() > tolerance:
            keep[k] = True
            stack += [(i, k), (k, j)]
        else:
            spare.append((off.max(), k, i, j))
    while keep.sum() < least and spare:
        _, k, i, j = spare.pop(max(range(len(spare)), key=lambda s: spare[s][0]))
        keep[k] = True
        for a, b in ((i, k), (k, j)):
            if b - a > 1:
                spare.append((0.0, (a + b) // 2, a, b))
    return keep


def _crosses(*lines: np.ndarray) -> bool:
    """Whether segments of the lines meet that aren't neighbours in one line.

    Segments are met with those whose extents overlap theirs, found along the axis over which they spread further.
    """
    of = np.concatenate([np.full(max(len(p) - 1, 0), i) for i, p in enumerate(lines)])
    if len(of) < 2:
        return False
    a, b = (np.concatenate([p[k : len(p) - 1 + k] for p in lines if len(p) > 1]) for k in (0, 1))
    place = np.concatenate([np.arange(len(p) - 1) for p in lines if len(p) > 1])
    last = np.array([len(p) - 2 if len(p) > 1 and (p[0] == p[-1]).all() else -1 for p in lines])
    low, high = np.minimum(a, b), np.maximum(a, b)
    axis = int(np.ptp(low[:, 1]) > np.ptp(low[:, 0]))
    order = np.argsort(low[:, axis], kind="stable")
    a, b, of, place, low, high = (v[order] for v in (a, b, of, place, low, high))
    ends = np.searchsorted(low[:, axis], high[:, axis], "right")
    start, n = 0, np.maximum(ends - np.arange(1, len(of) + 1), 0)
    total = np.cumsum(n)

    def side(o: np.ndarray, e: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (e[:, 0] - o[:, 0]) * (q[:, 1] - o[:, 1]) - (e[:, 1] - o[:, 1]) * (q[:, 0] - o[:, 0])

    while start < len(of):  # in portions, so that memory is bounded
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + 1_000_000, "right")))
        i = np.repeat(np.arange(start, end), n[start:end])
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n[start:end]) - n[start:end], n[start:end])
        near = (low[i, 1 - axis] <= high[j, 1 - axis]) & (low[j, 1 - axis] <= high[i, 1 - axis])
        apart = np.abs(place[i] - place[j])
        beside = (of[i] == of[j]) & ((apart == 1) | (apart == last[of[i]]))
        i, j = i[near & ~beside], j[near & ~beside]
        if ((side(a[i], b[i], a[j]) * side(a[i], b[i], b[j]) <= 0) & (side(a[j], b[j], a[i]) * side(a[j], b[j], b[i]) <= 0)).any():
            return True
        start = end
    return False


def simplified(kind: int, arrays: list[np.ndarray], tolerance: float) -> list[np.ndarray]:
    """Lines and rings with fewer points: rings keep four at least, and the tolerance is halved until nothing crosses, in a
    ring or between the rings of a polygon."""
    if kind == POINT or tolerance <= 0:
        return arrays
    was = None
    for _ in range(8):
        out = [p[_kept(p, tolerance, 4 if kind == POLYGON else 2)] if len(p) > 2 else p for p in arrays]
        if not _crosses(*out):
            return out
        was = _crosses(*arrays) if was is None else was
        if was:  # not simple to begin with
            return out
        tolerance /= 2
    return arrays


def simplify(geom: Column, tolerance: float) -> Column:
    """Lines and rings within ``tolerance`` of what they were, without losing rings or making them cross themselves or each
    other."""

    @F.arrow_udf(T.BinaryType())
    def changed(g: pa.Array) -> pa.Array:
        return _each(g, lambda kind, arrays: simplified(kind, arrays, tolerance), lambda p: p)

    return changed(geom)


def with_geometry(df: DataFrame, geom: str, value: Column) -> DataFrame:
    """All other columns in order, the changed geometry last."""
    return df.select(*[c for c in df.columns if c != geom], value.alias(geom, metadata={"geometry": True}))
