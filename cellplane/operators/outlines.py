"""Shapes of shapes: hulls, rotated rectangles and axes, simplified and clipped outlines, cleaned parts, faces of line work.

The kernels work on numpy arrays of points, one shape or one tile at a time; `mapped` and `by_tile` run them over DataFrames of shapes in Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
RINGS = pa.list_(pa.list_(POINT))
DDL = "array<array<struct<x:double,y:double>>>"
#: So few points are looked at one by one.
FEW = 64


def cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[..., 0] * b[..., 1] - a[..., 1] * b[..., 0]


def signed_area(ring: np.ndarray) -> float:
    return float(cross(ring, np.roll(ring, -1, axis=0)).sum() / 2)


def _hull_of_few(pts: list[tuple[float, float]]) -> list[tuple[float, float]]:
    if len(pts) < 3:
        return pts

    def half(seq):
        out: list[tuple[float, float]] = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-1][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-1][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return half(pts) + half(pts[::-1])


def convex_hull(points: np.ndarray) -> np.ndarray:
    """Corners of the hull, counter-clockwise from the lowest left one; fewer than three if the points lie on a line."""
    if len(points) <= FEW:
        return np.array(_hull_of_few(sorted(set(map(tuple, points.tolist()))))).reshape(-1, 2)
    pts = np.unique(points, axis=0)
    if len(pts) < 3:
        return pts

    def half(seq):
        out: list[np.ndarray] = []
        for p in seq:
            while len(out) > 1 and cross(out[-1] - out[-2], p - out[-1]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(pts) + half(pts[::-1]))


def rotated_rectangle(points: np.ndarray) -> np.ndarray:
    """The rectangle of least area around the points: one of its sides lies on a side of the hull."""
    hull = convex_hull(points)
    if len(hull) < 3:
        return hull
    best, found = np.inf, hull
    for edge in np.roll(hull, -1, axis=0) - hull:
        u = edge / np.hypot(*edge)
        v = np.array([-u[1], u[0]])
        a, b = hull @ u, hull @ v
        size = np.ptp(a) * np.ptp(b)
        if size < best - 1e-9:
            best = size
            found = np.array([a.min() * u + b.min() * v, a.max() * u + b.min() * v, a.max() * u + b.max() * v, a.min() * u + b.max() * v])
    return found


def long_axis(points: np.ndarray, least: float = 500.0) -> np.ndarray | None:
    """The middle line along the longer side of the rotated rectangle, if it is long enough."""
    r = rotated_rectangle(points)
    if len(r) < 4:
        axis = r if len(r) == 2 else None
    else:
        axis = (r + np.roll(r, -1, axis=0))[[1, 3]] / 2 if np.hypot(*(r[1] - r[0])) >= np.hypot(*(r[2] - r[1])) else (r + np.roll(r, -1, axis=0))[[0, 2]] / 2
    return axis if axis is not None and np.hypot(*(axis[1] - axis[0])) >= least else None


def merged_lines(lines: list[np.ndarray]) -> list[np.ndarray]:
    """Lines joined where just two of them end at a point; other ends stay."""
    parts = [p for p in lines if len(p) > 1]
    while True:
        ends: dict[tuple[float, float], list[int]] = {}
        for i, p in enumerate(parts):
            for q in (p[0], p[-1]):
                ends.setdefault(tuple(q), []).append(i)
        pair = next((v for _, v in sorted(ends.items()) if len(v) == 2 and v[0] != v[1]), None)
        if pair is None:
            return parts
        a, b = parts[pair[0]], parts[pair[1]]
        if tuple(a[0]) in (tuple(b[0]), tuple(b[-1])) and tuple(a[-1]) not in (tuple(b[0]), tuple(b[-1])):
            a = a[::-1]
        if tuple(a[-1]) != tuple(b[0]):
            b = b[::-1]
        parts = [p for i, p in enumerate(parts) if i not in pair] + [np.concatenate([a, b[1:]])]


def _kept_of_few(points: list[list[float]], tolerance: float) -> list[bool]:
    """What `kept` says, point by point: for a few points that is sooner done than in arrays."""
    keep = [False] * len(points)
    keep[0] = keep[-1] = True
    stack = [(0, len(points) - 1)]
    while stack:
        a, b = stack.pop()
        (x, y), (u, v) = points[a], points[b]
        cx, cy = u - x, v - y
        size = math.hypot(cx, cy)
        most, at = -1.0, 0
        for i in range(a + 1, b):
            px, py = points[i][0] - x, points[i][1] - y
            far = abs(cx * py - cy * px) / size if size else math.hypot(px, py)
            if far > most:
                most, at = far, i
        if at and most > tolerance:
            keep[at] = True
            stack += [(a, at), (at, b)]
    return keep


def kept(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points stay by Douglas and Peucker: the ends, and every point farther than the tolerance from the chord that would replace it."""
    if len(points) <= FEW:
        return np.array(_kept_of_few(points.tolist(), tolerance), dtype=bool)
    keep = np.zeros(len(points), dtype=bool)
    keep[[0, -1]] = True
    stack = [(0, len(points) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        chord, rest = points[b] - points[a], points[a + 1 : b] - points[a]
        size = np.hypot(*chord)
        far = np.abs(cross(chord, rest)) / size if size else np.hypot(rest[:, 0], rest[:, 1])
        i = int(np.argmax(far))
        if far[i] > tolerance:
            keep[a + 1 + i] = True
            stack += [(a, a + 1 + i), (a + 1 + i, b)]
    return keep


def simplified(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas and Peucker."""
    return points[kept(points, tolerance)]


def simplified_ring(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """A ring simplified between its first point and the one farthest from it; kept as it is where fewer than three points would be left."""
    far = int(np.argmax(np.hypot(*(ring - ring[0]).T)))
    out = np.concatenate([simplified(ring[: far + 1], tolerance)[:-1], simplified(np.concatenate([ring[far:], ring[:1]]), tolerance)[:-1]])
    return out if len(out) > 2 and signed_area(out) else ring


def clipped(ring: np.ndarray, minx: float, miny: float, maxx: float, maxy: float) -> np.ndarray:
    """The part of a ring inside a box, cut side by side (Sutherland and Hodgman)."""
    for axis, limit, sign in ((0, minx, 1), (0, maxx, -1), (1, miny, 1), (1, maxy, -1)):
        if not len(ring):
            return ring
        depth = sign * (ring[:, axis] - limit)
        nxt, nxt_depth = np.roll(ring, -1, axis=0), np.roll(depth, -1)
        out = []
        for p, q, d, e in zip(ring, nxt, depth, nxt_depth, strict=True):
            if d >= 0:
                out.append(p)
            if (d > 0 > e) or (d < 0 < e):
                out.append(p + (q - p) * d / (d - e))
        ring = np.array(out).reshape(-1, 2)
    return ring


def open_ring(ring: np.ndarray) -> np.ndarray:
    """Without the closing point and without points that repeat the one before."""
    if len(ring) > 1 and (ring[0] == ring[-1]).all():
        ring = ring[:-1]
    return ring[np.concatenate([[True], (ring[1:] != ring[:-1]).any(axis=1)])] if len(ring) else ring


def cleaned(rings: list[np.ndarray], least_area: float = 0.0) -> list[list[np.ndarray]]:
    """Polygon parts of rings, each an outer ring and its holes: nesting by the even-odd rule, small or degenerate parts dropped."""
    rings = [r for r in map(open_ring, rings) if len(r) > 2 and abs(signed_area(r)) > 0]
    inside = lambda p, r: ((r[:, 1] > p[1]) != (np.roll(r, -1, 0)[:, 1] > p[1])) & (p[0] < r[:, 0] + (p[1] - r[:, 1]) * (np.roll(r, -1, 0)[:, 0] - r[:, 0]) / np.where(np.roll(r, -1, 0)[:, 1] == r[:, 1], 1, np.roll(r, -1, 0)[:, 1] - r[:, 1]))
    size = [abs(signed_area(r)) for r in rings]
    around = [[j for j in range(len(rings)) if size[j] > size[i] and inside(rings[i][0], rings[j]).sum() % 2] for i in range(len(rings))]
    parts = {i: [rings[i]] for i in range(len(rings)) if len(around[i]) % 2 == 0}
    for i in range(len(rings)):
        if len(around[i]) % 2:
            owner = min((j for j in around[i] if j in parts), key=lambda j: size[j], default=None)
            if owner is not None:
                parts[owner].append(rings[i])
    return [p for p in parts.values() if abs(signed_area(p[0])) - sum(abs(signed_area(h)) for h in p[1:]) > least_area]


def path_rings(steps: list[tuple[tuple[float, float], tuple[float, float]]], gap: float = 1e-3) -> list[np.ndarray]:
    """Segments in drawing order to rings: one that does not begin where the last ended starts a new ring."""
    out: list[list[tuple[float, float]]] = []
    for a, b in steps:
        if not out or np.hypot(out[-1][-1][0] - a[0], out[-1][-1][1] - a[1]) > gap:
            out.append([a])
        out[-1].append(b)
    return [np.array(r) for r in out if len(r) > 2]


def affine_fit(pixels: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The 2 x 3 matrix that takes pixels to places with least squares."""
    known = np.column_stack([pixels, np.ones(len(pixels))])
    return np.linalg.lstsq(known, places, rcond=None)[0].T


def noded(segments: np.ndarray, digits: int = 6) -> np.ndarray:
    """Segments (n, 2, 2) cut at each other's crossings and touches, each piece once. All pairs of one tile are compared."""
    p, d = segments[:, 0], segments[:, 1] - segments[:, 0]
    pieces = set()
    for i in range(len(segments)):
        near = (segments[:, :, 0].min(1) <= segments[i, :, 0].max()) & (segments[:, :, 0].max(1) >= segments[i, :, 0].min()) & (segments[:, :, 1].min(1) <= segments[i, :, 1].max()) & (segments[:, :, 1].max(1) >= segments[i, :, 1].min())
        j = np.flatnonzero(near)
        den = cross(d[i], d[j])
        w = p[j] - p[i]
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = cross(w, d[j]) / den, cross(w, d[i]) / den
        hit = (den != 0) & (t >= -1e-12) & (t <= 1 + 1e-12) & (u >= -1e-12) & (u <= 1 + 1e-12)
        cuts = [0.0, 1.0, *t[hit].tolist()]
        same = (den == 0) & (np.abs(cross(w, d[i])) < 1e-9)
        size = d[i] @ d[i]
        if size:
            cuts += [x for q in (p[j][same], p[j][same] + d[j][same]) for x in ((q - p[i]) @ d[i] / size).tolist() if 0 < x < 1]
        at = np.round(p[i] + np.unique(np.clip(cuts, 0, 1))[:, None] * d[i], digits)
        for a, b in zip(map(tuple, at[:-1].tolist()), map(tuple, at[1:].tolist()), strict=True):
            if a != b:
                pieces.add((min(a, b), max(a, b)))
    return np.array(sorted(pieces)).reshape(-1, 2, 2)


def faces(segments: np.ndarray) -> list[np.ndarray]:
    """Bounded faces of line work, as counter-clockwise rings: pieces that lead nowhere go, then every half-edge turns as far right as it can."""
    pieces = noded(segments)
    nodes: dict[tuple[float, float], set] = {}
    for a, b in pieces.tolist():
        nodes.setdefault(tuple(a), set()).add(tuple(b))
        nodes.setdefault(tuple(b), set()).add(tuple(a))
    loose = [n for n, near in nodes.items() if len(near) == 1]
    while loose:
        n = loose.pop()
        for m in nodes.pop(n, ()):
            nodes[m].discard(n)
            if len(nodes[m]) == 1:
                loose.append(m)
    around = {n: sorted(near, key=lambda m, n=n: np.arctan2(m[1] - n[1], m[0] - n[0])) for n, near in nodes.items() if near}
    left = {(a, b) for a, near in around.items() for b in near}
    out = []
    for start in sorted(left):
        if start not in left:
            continue
        (a, b), ring = start, []
        while True:
            left.discard((a, b))
            ring.append(a)
            near = around[b]
            a, b = b, near[near.index(a) - 1]  # the next one clockwise from where it came
            if (a, b) == start:
                break
        ring = np.array(ring)
        if signed_area(ring) > 0:
            out.append(ring)
    return out


def as_rings(rings: list[np.ndarray]) -> list[list[dict[str, float]]]:
    return [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]


def mapped(shapes: DataFrame, kernel: Callable[[list[np.ndarray]], list[np.ndarray]]) -> DataFrame:
    """(id, rings) with the rings that the kernel makes of a shape's."""
    schema = pa.schema([("id", pa.int64()), ("rings", RINGS)])

    def run(batches):
        for b in batches:
            made = [as_rings(kernel([np.array([(p["x"], p["y"]) for p in r]).reshape(-1, 2) for r in rings or []])) for rings in b.column("rings").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id").cast(pa.int64()), pa.array(made, RINGS)], schema=schema)

    return shapes.select("id", "rings").mapInArrow(run, f"id long, rings {DDL}")


def tiled(lines: DataFrame, side: float, halo: float, key: Callable[[Column, Column], Column]) -> DataFrame:
    """(tile, rings): the line work (rings) of each row, in every tile that its bounds widened by the halo meet. key: a tile's number by column and row."""
    points = F.flatten("rings")
    tiles = lambda axis: F.sequence(F.floor((F.array_min(points[axis]) - halo) / side), F.floor((F.array_max(points[axis]) + halo) / side))
    rows = lines.select("rings", F.explode(tiles("x")).alias("tx"), tiles("y").alias("ty")).select("rings", "tx", F.explode("ty").alias("ty"))
    return rows.select(key(F.col("tx"), F.col("ty")).cast("long").alias("tile"), "rings").filter("tile is not null")


def polygonised(lines: DataFrame, inside: Callable[[int], tuple[float, float, float, float]] | None = None) -> DataFrame:
    """(tile, face, rings) of the line work (tile, rings) of each tile. inside: the box of a tile that faces are clipped to."""
    schema = pa.schema([("tile", pa.int64()), ("face", pa.int32()), ("rings", RINGS)])

    def run(t: pa.Table) -> pa.Table:
        paths = [np.array([(p["x"], p["y"]) for p in r]) for rings in t.column("rings").to_pylist() for r in rings or [] if len(r) > 1]
        found = faces(np.concatenate([np.stack([r[:-1], r[1:]], axis=1) for r in paths])) if paths else []
        tile = t.column("tile")[0].as_py()
        if inside is not None:
            found = [r for r in (open_ring(clipped(f, *inside(tile))) for f in found) if len(r) > 2 and signed_area(r) > 1e-9]
        return pa.table([pa.array([tile] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), pa.array([as_rings([f]) for f in found], RINGS)], schema=schema)

    return lines.select("tile", "rings").groupBy("tile").applyInArrow(run, f"tile long, face int, rings {DDL}")
