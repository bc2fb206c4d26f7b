"""Points near other points, and the regions that contain them.

Regions: a trapezoidal decomposition. The heights of a polygon's vertices (and of crossings of its edges) cut it into
slabs; inside a slab no two edges cross, so they have an order from left to right, and a point lies inside if the number
of edges left of it is odd. Slabs are cut at the tiles of a grid and hold only the edges near their tile; points meet the
slabs of their tile, and binary search finds the slab of their height and the place among its edges.

Neighbours: a grid with cells of twice the distance. A point is at home in one cell and visits the cells within reach
of it that have a greater number, so every pair meets once. Crowded cells are cut into blocks, as many as their points
need, and every two blocks meet in a task of their own.

Defined results: only points with finite coordinates within ±180 and ±90 take part; null ids take no part; repeated rows
count once; copies of a place with other ids are at distance 0; a region is closed below and open above, so points on a
shared edge of neighbouring regions lie in one of them; regions that cannot be read contain nothing; empty inputs give
an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import atan, degrees, sin

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.functions.wkb import decode_points, polygons
from cairnlake.lineage import cut_lineage
from cairnlake.skew import BROADCAST_BYTES, hot_keys, salted_join, with_parts

EARTH_M = 6_371_008.8
#: Side of the tiles over which slabs are spread, in degrees.
TILE = 0.25
#: Points of a block; a cell with more is split into as many blocks as that needs.
DENSE = 32_768
#: Most slabs of a row.
SLABS = 256


def places(df: DataFrame, key: str, geom: str) -> DataFrame:
    """key, lon, lat of every valid point, each once; written to the shared folder, as it is read several times."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lon, lat = decode_points(b.column(1))
            keep = pa.array((np.abs(lon) <= 180) & (np.abs(lat) <= 90))
            yield pa.record_batch([b.column(0).filter(keep), pa.array(lon).filter(keep), pa.array(lat).filter(keep)], ["id", "lon", "lat"])

    kind = df.schema[key].dataType.simpleString()
    points = df.where(df[key].isNotNull() & df[geom].isNotNull()).select(df[key].alias("id"), df[geom].alias("geom"))
    return cut_lineage(points.mapInArrow(decoded, f"id {kind}, lon double, lat double").distinct())


def _reach(reach: Column, lat: Column) -> Column:
    """Degrees of longitude that a distance of ``reach`` radians can span from a latitude; all of them at a pole."""
    c, s = F.cos(F.radians(lat)), F.sin(reach)
    return F.when(c <= s, F.lit(360.0)).otherwise(F.degrees(F.asin(F.least(s / F.greatest(c, s), F.lit(1.0)))))


def neighbours(points: DataFrame, metres: float, dense: int = DENSE) -> DataFrame:
    """Pairs of ids (id_a < id_b) of ``places`` at most ``metres`` apart on the sphere."""
    reach = metres / EARTH_M * (1 + 1e-9)
    side = degrees(2 * reach)
    bands = int(180 // side) + 1

    def band(lat: Column) -> Column:
        return F.least(F.greatest(F.floor((lat + 90) / side), F.lit(0)), F.lit(bands - 1))

    def cells_in(b: Column) -> Column:
        """Cells of a band: as many as keep each at least twice the reach wide, wherever in the band."""
        edge = F.greatest(F.abs(b * side - 90), F.abs((b + 1) * side - 90))
        return F.greatest(F.floor(360 / (2 * _reach(F.lit(reach), edge))), F.lit(1))

    def cell(b: Column, lon: Column) -> Column:
        n = cells_in(b)
        return b * F.lit(1 << 31) + F.pmod(F.floor((lon + 180) / 360 * n), n)

    own = band(F.col("lat"))
    axes = ("x", "y", "z")
    home = points.withColumn("cell", cell(own, F.col("lon")))
    # a reach of half a cell's side touches at most two bands and, away from the poles, at most three cells in each
    step = F.lit(degrees(reach))
    sides = (0, 1)
    staged = home.withColumnRenamed("cell", "own").withColumns({"turn": _reach(F.lit(reach), F.col("lat")), "band0": band(F.col("lat") - step), "band1": band(F.col("lat") + step)})
    staged = staged.withColumns({f"n{k}": cells_in(F.col(f"band{k}")) for k in sides})
    ends = {f"{name}{k}": F.floor((F.col("lon") + sign * F.col("turn") + 180) / 360 * F.col(f"n{k}")) for k in sides for name, sign in (("first", -1), ("last", 1))}
    staged = staged.withColumns(ends).withColumns({f"last{k}": F.least(f"last{k}", F.col(f"first{k}") + F.col(f"n{k}") - 1) for k in sides})

    def numbered(k: int, j: Column) -> Column:
        return F.col(f"band{k}") * F.lit(1 << 31) + F.pmod(j, F.col(f"n{k}"))

    def all_of(k: int) -> Column:
        return F.transform(F.sequence(f"first{k}", f"last{k}"), lambda j: numbered(k, j))

    def guests(df: DataFrame, visits: Column) -> DataFrame:
        """Rows of the visits to cells of greater number.

        The lambda keeps this projection out of the fused stage, whose one method would be too long for the JVM to compile;
        outer, as the optimizer would else filter on the array's size and compute it twice.
        """
        laid = df.withColumn("visits", F.filter(F.array_distinct(visits), lambda c: c > F.col("own")))
        return laid.select("id", "lon", "lat", F.explode_outer("visits").alias("cell")).where("cell is not null")

    few = F.array(*[numbered(k, j) for k in sides for j in (F.col(f"first{k}"), F.least(F.col(f"first{k}") + 1, F.col(f"last{k}")), F.col(f"last{k}"))])
    every = F.concat(*[all_of(k) for k in sides])
    # up to here a reach spans at most 1.4 times the width of a cell of either band
    few_up_to = min(85.0, degrees(atan(0.3 / (2 * reach))) - 2 * side)
    polar = F.abs("lat") > few_up_to
    guest = guests(staged.where(~polar), few).unionByName(guests(staged.where(polar), every))
    full = hot_keys(home, ["cell"], dense)
    far = (2 * sin(metres / EARTH_M / 2)) ** 2

    def chord(axis: str, p: str) -> Column:
        lat, lon = F.radians(f"lat_{p}"), F.radians(f"lon_{p}")
        return {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}[axis]

    def shaped(df: DataFrame, p: str, i: Column | None = None, j: Column | None = None) -> DataFrame:
        named = df.select("cell", *([i.alias("i"), j.alias("j")] if i is not None else []), *[F.col(c).alias(f"{c}_{p}") for c in ("id", "lon", "lat")])
        return named.select("cell", *(["i", "j"] if i is not None else []), f"id_{p}", *[chord(k, p).alias(f"{k}_{p}") for k in axes])

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        close = sum(((F.col(f"{k}_a") - F.col(f"{k}_b")) * (F.col(f"{k}_a") - F.col(f"{k}_b")) for k in axes), F.lit(0.0)) <= F.lit(far)
        return left.join(right, [c for c in ("cell", "i", "j") if c in left.columns]).where(close)

    def pairs(df: DataFrame) -> DataFrame:
        return df.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))

    if full is None:
        a = shaped(home, "a")
        return met(a, shaped(home, "b")).where("id_a < id_b").select("id_a", "id_b").unionByName(pairs(met(a, shaped(guest, "b")).where("id_a <> id_b")))
    # crowded cells: blocks of at most about ``dense`` points, and every two blocks of a cell are one task's work
    visits = cut_lineage(with_parts(guest, full, ["cell"]).where("parts is not null").groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / dense).cast("int").alias("guests")))
    full = cut_lineage(full.join(visits, "cell", "left").select("cell", "parts", F.coalesce("guests", F.lit(1)).alias("guests")))
    one = {"parts": F.coalesce("parts", F.lit(1)), "guests": F.coalesce("guests", F.lit(1))}
    home, guest = (with_parts(df, full, ["cell"]).withColumns(one) for df in (home, guest))
    home = home.withColumn("block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    guest = guest.withColumn("block", F.pmod(F.xxhash64("id"), F.col("guests")).cast("int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = shaped(home.withColumn("other", F.explode(F.sequence("block", F.col("parts") - 1))), "a", F.col("block"), F.col("other"))
    b = shaped(home.withColumn("other", F.explode(F.sequence(F.lit(0), "block"))), "b", F.col("other"), F.col("block"))
    within = met(a, b).where("i < j or id_a < id_b")
    across = met(shaped(home.withColumn("other", each("guests")), "a", F.col("block"), F.col("other")), shaped(guest.withColumn("other", each("parts")), "b", F.col("other"), F.col("block")))
    return pairs(within.unionByName(across.where("id_a <> id_b")))


def one_per_place(points: DataFrame) -> DataFrame:
    """id, place: each point of ``places`` with the least id among the points of exactly its coordinates."""
    least = points.groupBy("lon", "lat").agg(F.min("id").alias("place"))
    return salted_join(points, least, ["lon", "lat"], "inner", F.col("id")).select("id", "place")


def _at(edges: np.ndarray, y: float) -> np.ndarray:
    return edges[:, 0] + (y - edges[:, 1]) * (edges[:, 2] - edges[:, 0]) / (edges[:, 3] - edges[:, 1])


def _segments(rings: list[np.ndarray]) -> np.ndarray:
    """All edges (x0, y0, x1, y1) of a polygon's rings, closed where they are not."""
    parts = [np.empty((0, 4))]
    for r in rings:
        if len(r) >= 3 and np.isfinite(r).all():
            r = r if (r[0] == r[-1]).all() else np.vstack([r, r[:1]])
            parts.append(np.hstack([r[:-1], r[1:]]))
    return np.vstack(parts)


def _swept(edges: np.ndarray, y_from: float, y_to: float, more: np.ndarray | tuple = ()) -> Iterator[tuple[float, float, np.ndarray]]:
    """Slabs between two heights, cut at ``more`` too, and which of the edges (none level) run through each from left to right."""
    low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    heights = np.unique(np.clip(np.concatenate([low, high, more, [y_from, y_to]]), y_from, y_to))
    starts = np.argsort(low, kind="stable")
    begun = np.searchsorted(low[starts], heights, "right")
    active, k = np.empty(0, int), 0
    for i, (y0, y1) in enumerate(zip(heights[:-1], heights[1:])):
        active = np.concatenate([active[high[active] > y0], starts[k : begun[i]]])
        active = active[high[active] > y0] if begun[i] > k else active
        k = begun[i]
        yield from _ordered(edges, active, y0, y1)


def _ordered(edges: np.ndarray, own: np.ndarray, y0: float, y1: float) -> Iterator[tuple[float, float, np.ndarray]]:
    """The slab as it is, or cut where edges of a polygon that isn't simple cross."""
    todo = [(y0, y1)]
    while todo:
        y0, y1 = todo.pop()
        if len(own) > 1:
            a, b = _at(edges[own], y0), _at(edges[own], y1)
            order = np.argsort(a + b, kind="stable")
            own, a, b = own[order], a[order], b[order]
            over_a, over_b = a[:-1] - a[1:], b[:-1] - b[1:]
            slack = 1e-12 * np.maximum(1, np.abs(a[1:]))
            crossing = (over_a > slack) | (over_b > slack)
            if crossing.any():
                part = over_a[crossing] / (over_a[crossing] - over_b[crossing])
                cuts = np.unique(y0 + part[(part > 1e-9) & (part < 1 - 1e-9)] * (y1 - y0))
                cuts = cuts[(cuts > y0) & (cuts < y1)]
                if len(cuts):
                    ends = [y0, *cuts.tolist(), y1]
                    todo += list(zip(ends[:-1], ends[1:]))[::-1]
                    continue
        yield y0, y1, own


def polygon_slabs(rings: list[np.ndarray]) -> Iterator[tuple[float, float, np.ndarray]]:
    """Slabs of one polygon: lower and upper height, edges (x0, y0, x1, y1) from left to right."""
    edges = _segments(rings)
    edges = edges[edges[:, 1] != edges[:, 3]]
    if len(edges):
        for y0, y1, own in _swept(edges, edges[:, [1, 3]].min(), edges[:, [1, 3]].max()):
            if len(own):
                yield y0, y1, edges[own]


def _spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the whole numbers first[i] to last[i]: the i of each, and the number."""
    n = np.maximum(last - first + 1, 0)
    of = np.repeat(np.arange(len(n)), n)
    return of, first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)


def tile_slabs(rings: list[np.ndarray], tile: float) -> Iterator[tuple[int, int, list[tuple[float, float, bool, np.ndarray]]]]:
    """tx, ty and the slabs of one polygon in that tile, upwards without gaps: heights, whether the polygon holds the
    tile's left side but for the slab's own edges, and the edges that come near the tile, from left to right.

    Edges far from a tile are not repeated in it: what lies left of them is told once a slab, by how many edges cross the
    tile's left side above it. So a polygon's rows grow with its edges and with the tiles inside it, not with their product.
    """
    every = _segments(rings)
    level = every[:, 1] == every[:, 3]
    if level.all():
        return
    low, high = np.minimum(every[:, 1], every[:, 3]), np.maximum(every[:, 1], every[:, 3])
    of, ty = _spans(np.floor(low / tile).astype(int), np.floor(high / tile).astype(int))
    ya, yb = np.maximum(low[of], ty * tile), np.minimum(high[of], (ty + 1) * tile)
    of, ty, ya, yb = (v[(yb > ya) | level[of]] for v in (of, ty, ya, yb))
    with np.errstate(divide="ignore", invalid="ignore"):
        x = np.where(level[of], every[of][:, [0, 2]].T, np.stack([_at(every[of], ya), _at(every[of], yb)]))
    x = np.sort(x, axis=0)
    near, tx = _spans(np.floor(x[0] / tile - 1e-7).astype(int), np.floor(x[1] / tile + 1e-7).astype(int))
    of, ty = of[near], ty[near]
    # where edges cross the left sides of columns
    left, right = np.minimum(every[:, 0], every[:, 2]), np.maximum(every[:, 0], every[:, 2])
    e, c = _spans(np.floor(left / tile).astype(int), np.floor(right / tile).astype(int))
    side = c * tile
    e, c, side = (v[(left[e] < side) & (side <= right[e])] for v in (e, c, side))
    at = every[e, 1] + (side - every[e, 0]) * (every[e, 3] - every[e, 1]) / (every[e, 2] - every[e, 0])
    order = np.lexsort((at, c))
    c, at = c[order], at[order]

    def holds(column: int, y: float) -> bool:
        a, b = np.searchsorted(c, (column, column + 1))
        return bool((b - a - np.searchsorted(at[a:b], y, "right")) % 2)

    order = np.lexsort((tx, ty))
    of, ty, tx = of[order], ty[order], tx[order]
    starts = np.flatnonzero(np.r_[True, (ty[1:] != ty[:-1]) | (tx[1:] != tx[:-1])])
    for a, b in zip(starts, np.r_[starts[1:], len(of)]):
        here, column, row = of[a:b], int(tx[a]), int(ty[a])
        own = every[here[~level[here]]]
        out: list[tuple[float, float, bool, np.ndarray]] = []
        # level edges are no slab's, but what lies left changes at their heights
        for y0, y1, some in _swept(own, row * tile, (row + 1) * tile, low[here[level[here]]]):
            mid = (y0 + y1) / 2
            odd = holds(column, mid) ^ bool((_at(own[some], mid) < column * tile).sum() % 2)
            if out and not len(some) and not len(out[-1][3]) and out[-1][2] == odd:
                out[-1] = (out[-1][0], y1, odd, own[some])
            else:
                out.append((y0, y1, odd, own[some]))
        yield column, row, out
    # tiles without edges, wholly inside
    used = set(zip(tx.tolist(), ty.tolist()))
    for row in range(int(ty.min()), int(ty.max()) + 1):
        for column in range(int(tx.min()), int(tx.max()) + 1):
            if (column, row) not in used and holds(column, (row + 0.5) * tile):
                yield column, row, [(row * tile, (row + 1) * tile, True, np.empty((0, 4)))]


_SLABS = ("tx", "ty", "region", "y0", "y1", "heights", "firsts", "odds", "xa", "ya", "xb", "yb")


def slabs(regions: DataFrame, key: str, geom: str, tile: float = TILE, most: int = SLABS) -> DataFrame:
    """Rows of at most ``most`` slabs of a region's polygon in a tile: tx, ty, region, y0 and y1 (from the first slab to the
    last), heights of the slabs, where each slab's edges begin (firsts), odds, and the edges' coordinates."""
    kind = regions.schema[key].dataType.simpleString()

    def rows(region: object, wkb: bytes) -> Iterator[tuple]:
        for rings in polygons(wkb):
            for tx, ty, every in tile_slabs(rings, tile):
                for k in range(0, len(every), most):
                    y0, y1, odd, edges = zip(*every[k : k + most])
                    if any(odd) or any(map(len, edges)):
                        flat = np.concatenate(edges)
                        yield (tx, ty, region, float(y0[0]), float(y1[-1]), [*map(float, y0)], np.cumsum([0, *map(len, edges)]).tolist(), [*map(int, odd)], *[flat[:, i] for i in range(4)])

    def decomposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers = pa.list_(pa.float64())
            types = [pa.int32(), pa.int32(), b.schema.field(0).type, pa.float64(), pa.float64(), numbers, pa.list_(pa.int32()), pa.list_(pa.int32()), *[numbers] * 4]
            held, size = [], 0
            for region, wkb in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for row in rows(region, wkb):
                    held.append(row)
                    size += 8 + len(row[8])
                    if size >= 200_000:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], _SLABS)
                        held, size = [], 0
            if held:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], _SLABS)

    shape = f"tx int, ty int, region {kind}, y0 double, y1 double, heights array<double>, firsts array<int>, odds array<int>, xa array<double>, ya array<double>, xb array<double>, yb array<double>"
    return regions.where(regions[key].isNotNull() & regions[geom].isNotNull()).select(regions[key], regions[geom]).mapInArrow(decomposed, shape)


def _first(lo: Column, hi: Column, passed: Callable[[Column], Column]) -> Column:
    """The first of the places lo to hi - 1 that is not passed, or hi: a binary search in as many steps as that needs."""

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        open_, on = s["lo"] < s["hi"], passed(mid)
        return F.struct(F.when(open_ & on, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(open_ & ~on, mid).otherwise(s["hi"]).alias("hi"))

    start = F.struct(lo.alias("lo"), hi.alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.ceil(F.log2(hi - lo + 1)).cast("int"), F.lit(1))), start, halve, lambda s: s["lo"])


def left_of(lon: Column, lat: Column) -> Column:
    """How many edges of a point's slab lie left of it: its slab by its height, then its place among the slab's edges."""
    slab = _first(F.lit(0), F.size("heights"), lambda i: F.get("heights", i) <= lat) - 1

    def x(i: Column) -> Column:
        x0, y0, x1, y1 = (F.get(c, i) for c in ("xa", "ya", "xb", "yb"))
        return x0 + (lat - y0) * (x1 - x0) / (y1 - y0)

    def count(s: Column) -> Column:
        a, b = F.get("firsts", s), F.get("firsts", s + 1)
        return F.get("odds", s) + F.when(a < b, _first(a, b, lambda i: F.coalesce(x(i) < lon, F.lit(False))) - a).otherwise(F.lit(0))

    return F.element_at(F.transform(F.array(slab), count), 1)


def containing(points: DataFrame, regions: DataFrame, key: str, geom: str, tile: float = TILE) -> DataFrame:
    """region, id of every point inside a region.

    The slabs are broadcast where they measure small; else both sides are shuffled by tile, and the points of crowded tiles
    are split.
    """
    at = {"tx": F.floor(F.col("lon") / tile).cast("int"), "ty": F.floor(F.col("lat") / tile).cast("int")}
    cut = cut_lineage(slabs(regions, key, geom, tile))
    # an edge is five numbers at most and a slab three, a row the others
    size = cut.agg(F.sum(40 * F.size("xa") + 24 * F.size("heights") + 64)).first()[0] or 0
    placed = points.withColumns(at)
    met = placed.join(F.broadcast(cut), ["tx", "ty"]) if size <= BROADCAST_BYTES else salted_join(placed, cut, ["tx", "ty"], "inner", F.col("id"))
    inside = met.where("lat >= y0 and lat < y1").where(left_of(F.col("lon"), F.col("lat")) % 2 == 1)
    return inside.select("region", "id").distinct()
