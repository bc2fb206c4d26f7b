"""Geometry in WKB: points and rings out of any of its dialects, by numpy over whole Arrow batches."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Flags of the extended dialect.
Z_FLAG, M_FLAG, SRID_FLAG = 0x80000000, 0x40000000, 0x20000000
POINT, LINESTRING, POLYGON, MULTIPOINT, MULTILINESTRING, MULTIPOLYGON, COLLECTION = range(1, 8)


def _words(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The n bytes at each of the places."""
    return data[at[:, None] + np.arange(n)]


def decode_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Longitude and latitude of every WKB point of a binary column; NaN for all else.

    Little or big endian; plain, extended (flags, SRID) and ISO (1001, 2001, 3001) type codes. What is null, empty, cut
    off, of another type or without coordinates gives NaN.
    """
    column = column.cast(pa.large_binary())
    n = len(column)
    lon, lat = np.full(n, np.nan), np.full(n, np.nan)
    buffers = column.buffers()
    if n == 0 or buffers[2] is None:
        return lon, lat
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8)
    size = np.diff(offsets)
    rows = np.flatnonzero((size >= 21) & np.asarray(column.is_valid()))
    if not len(rows):
        return lon, lat
    at, size = offsets[:-1][rows], size[rows]
    order = data[at]
    raw = np.ascontiguousarray(_words(data, at + 1, 4))
    code = np.where(order == 1, raw.view("<u4").ravel(), raw.view(">u4").ravel()).astype(np.int64)
    plain = code & 0x1FFFFFFF
    thousands = plain // 1000
    axes = 2 + ((code & Z_FLAG) != 0) + ((code & M_FLAG) != 0) + np.array([0, 1, 1, 2])[np.minimum(thousands, 3)]
    start = 5 + 4 * ((code & SRID_FLAG) != 0)
    good = (order <= 1) & (plain % 1000 == POINT) & (thousands <= 3) & (size >= start + 8 * axes)
    rows, at, start, order = rows[good], at[good], start[good], order[good]
    for shift, out in ((0, lon), (8, lat)):
        raw = np.ascontiguousarray(_words(data, at + start + shift, 8))
        out[rows] = np.where(order == 1, raw.view("<f8").ravel(), raw.view(">f8").ravel())
    return lon, lat


def encode_points(x: np.ndarray, y: np.ndarray) -> pa.Array:
    """Little-endian WKB points, in one buffer."""
    out = np.zeros((len(x), 21), np.uint8)
    out[:, 0] = 1
    out[:, 1] = POINT
    out[:, 5:13] = np.ascontiguousarray(x, "<f8").view(np.uint8).reshape(-1, 8)
    out[:, 13:21] = np.ascontiguousarray(y, "<f8").view(np.uint8).reshape(-1, 8)
    offsets = np.arange(0, 21 * len(x) + 1, 21, dtype=np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


class _Reader:
    """Reads one geometry from its start; struct.error where it is cut off."""

    def __init__(self, wkb: bytes) -> None:
        self.wkb, self.at = bytes(wkb), 0

    def take(self, form: str) -> tuple:
        got = struct.unpack_from(form, self.wkb, self.at)
        self.at += struct.calcsize(form)
        return got

    def head(self) -> tuple[str, int, int]:
        (order,) = self.take("B")
        end = "<" if order == 1 else ">"
        (code,) = self.take(end + "I")
        if code & SRID_FLAG:
            self.take(end + "I")
        plain = code & 0x1FFFFFFF
        axes = 2 + bool(code & Z_FLAG) + bool(code & M_FLAG) + (0, 1, 1, 2)[min(plain // 1000, 3)]
        return end, plain % 1000, axes

    def points(self, end: str, axes: int, n: int) -> np.ndarray:
        size = 8 * axes * n
        if self.at + size > len(self.wkb):
            raise struct.error("cut off")
        got = np.frombuffer(self.wkb, end + "f8", axes * n, self.at).reshape(n, axes)[:, :2].astype(float)
        self.at += size
        return got


def walk(wkb: bytes) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The simple parts of a geometry: type code and coordinate arrays (rings of a polygon, else one array)."""
    yield from _walk(_Reader(wkb))


def _walk(r: _Reader) -> Iterator[tuple[int, list[np.ndarray]]]:
    end, kind, axes = r.head()
    if kind == POINT:
        yield kind, [r.points(end, axes, 1)]
    elif kind == LINESTRING:
        (n,) = r.take(end + "I")
        yield kind, [r.points(end, axes, n)]
    elif kind == POLYGON:
        (n,) = r.take(end + "I")
        yield kind, [r.points(end, axes, r.take(end + "I")[0]) for _ in range(n)]
    elif kind in (MULTIPOINT, MULTILINESTRING, MULTIPOLYGON, COLLECTION):
        (n,) = r.take(end + "I")
        for _ in range(n):
            yield from _walk(r)
    else:
        raise struct.error(f"type code {kind}")


def polygons(wkb: bytes | None) -> list[list[np.ndarray]]:
    """The rings of each polygon in a geometry; none where it cannot be read."""
    if not wkb:
        return []
    try:
        return [rings for kind, rings in walk(wkb) if kind == POLYGON]
    except (struct.error, ValueError, IndexError):
        return []
