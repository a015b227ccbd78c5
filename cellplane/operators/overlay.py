"""Planar overlay of polygons by winding numbers, tile by tile: unions, intersections, repairs, and line work cut at its crossings.

Polygons are taken apart into directed edges with the inside on their left. An edge goes to every tile that its box meets; what lies left of a tile counts only by the
winding numbers at the tile's corner, which are sums over edges and need no polygon whole. In a tile, edges are cut where they meet, and a
piece is part of the outline if a rule on the winding numbers says that exactly one of its sides is inside. Crowded tiles are quartered until few
edges are left. Areas and lengths of the outcome are plain sums over its pieces; `rings.stitched` joins them into rings.

Tile lines are laid off all corners, so no outline runs along them, and where an edge crosses one is computed from the edge alone, alike in
both tiles. Corners and crossings are rounded to `DIGITS` digits of a metre, and points nearer than `NEAR` metres are one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellplane.operators import spatial
from cellplane.operators.components import least_labels
from cellplane.operators.grouped import coordinates, firsts, sizes, worked
from cellplane.scratch import materialise

NEAR, DIGITS, FEW, DEEP = 1e-6, 7, 48, 16
#: Share of a tile's side by which tile lines are moved off the origin, and further tries.
SHIFTS = (0.31830988618379067, 0.36787944117144233, 0.5641895835477563, 0.7071067811865476)
PIECES = "{by} {kind}, x0 double, y0 double, x1 double, y1 double, dx double, dy double"


def _open_rings(rings: str) -> Column:
    """Rings of three points or more, without the point that closes them."""
    return F.filter(F.transform(rings, lambda r: F.when(F.get(r, 0) == F.get(r, F.size(r) - 1), F.slice(r, 1, F.size(r) - 1)).otherwise(r)), lambda r: F.size(r) > 2)


def _depths(rings: Column) -> Column:
    """For each open ring how many others are around it."""
    deep = lambda r, i: F.size(F.filter(F.transform(rings, lambda s, j: (i != j) & spatial.inside(F.get(r, 0)["x"], F.get(r, 0)["y"], F.array(s))), lambda hit: hit))
    return F.when(F.size(rings) > 1, F.transform(rings, deep)).otherwise(F.transform(rings, lambda r: F.lit(0)))


def _turned(ring: Column, depth: Column) -> Column:
    """A ring counter-clockwise at even depth, else clockwise."""
    return F.when((spatial.ring_area2(ring) > 0) == (depth % 2 == 1), F.reverse(ring)).otherwise(ring)


def polygon_edges(shapes: DataFrame, by: str | list[str], layer: int = 0) -> DataFrame:
    """(by, layer, x0, y0, x1, y1) of shapes (by, rings): rings at even depth counter-clockwise, those at odd depth clockwise. Rows without rings have none."""
    by = [by] if isinstance(by, str) else by
    shapes = spatial.dealt(shapes.select(*by, "rings"))
    own = shapes.select(*by, _open_rings("rings").alias("rings"))
    own = own.withColumn("depth", _depths(F.col("rings"))).select(*by, "depth", F.posexplode("rings").alias("nth", "ring"))
    own = own.select(*by, _turned(F.col("ring"), F.get("depth", F.col("nth"))).alias("ring"))
    own = own.select(*by, "ring", F.posexplode("ring").alias("at", "p")).select(*by, "p", F.get("ring", (F.col("at") + 1) % F.size("ring")).alias("q"))
    return _edges(own, by, layer)


def line_edges(lines: DataFrame, by: str | list[str]) -> DataFrame:
    """(by, layer, x0, y0, x1, y1) of each step of the lines (by, rings)."""
    by = [by] if isinstance(by, str) else by
    own = lines.select(*by, F.explode("rings").alias("ring")).select(*by, "ring", F.posexplode("ring").alias("at", "p"))
    return _edges(own.select(*by, "p", F.get("ring", F.col("at") + 1).alias("q")), by, 0)


def _edges(own: DataFrame, by: list[str], layer: int) -> DataFrame:
    own = own.filter("q is not null and (p.x <> q.x or p.y <> q.y)")
    return own.select(*by, F.lit(layer).alias("layer"), F.col("p.x").alias("x0"), F.col("p.y").alias("y0"), F.col("q.x").alias("x1"), F.col("q.y").alias("y1"))


def _cross(e: np.ndarray, line: float, axis: int) -> np.ndarray:
    """The other coordinate where edges meet the line axis = line; an edge and the same the other way round meet it at the same number."""
    e = np.where((e[:, axis] > e[:, 2 + axis])[:, None], e[:, [2, 3, 0, 1]], e)
    return e[:, 1 - axis] + (line - e[:, axis]) * (e[:, 3 - axis] - e[:, 1 - axis]) / (e[:, 2 + axis] - e[:, axis])


def _clip(e: np.ndarray, box: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges that pass through their boxes (a row for each edge): which, and the ends of their part in it."""
    d = e[:, 2:] - e[:, :2]
    t0, t1 = np.zeros(len(e)), np.ones(len(e))
    p, q, ok = e[:, :2].copy(), e[:, 2:].copy(), np.ones(len(e), dtype=bool)
    for axis in (0, 1):
        flat = d[:, axis] == 0
        ok &= ~flat | ((e[:, axis] > box[:, axis]) & (e[:, axis] < box[:, 2 + axis]))
        for lower, line in ((True, box[:, axis]), (False, box[:, 2 + axis])):
            with np.errstate(divide="ignore", invalid="ignore"):
                t, other = (line - e[:, axis]) / d[:, axis], _cross(e, line, axis)
            enters = ~flat & ((d[:, axis] > 0) == lower)
            later, sooner = enters & (t > t0), ~flat & ~enters & (t < t1)
            for on, end, at in ((later, p, t0), (sooner, q, t1)):
                end[on, axis], end[on, 1 - axis], at[on] = line[on], other[on], t[on]
    keep = np.flatnonzero(ok & (t0 < t1))
    return keep, p[keep], q[keep]


def _pairs(first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j), j being one of many[i] numbers from first[i]."""
    i = np.repeat(np.arange(len(many)), many)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)


def _split(p: np.ndarray, q: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments in the order of their leaves, cut at each other in a leaf: number of the segment, and ends, of each piece in its direction."""
    n, d = len(p), q - p
    size = np.hypot(d[:, 0], d[:, 1])
    start = np.searchsorted(leaf, leaf)
    j, i = _pairs(start, np.arange(n) - start)
    lo, hi = np.minimum(p, q) - NEAR, np.maximum(p, q) + NEAR
    near = (lo[i, 0] <= hi[j, 0]) & (lo[j, 0] <= hi[i, 0]) & (lo[i, 1] <= hi[j, 1]) & (lo[j, 1] <= hi[i, 1])
    i, j = i[near], j[near]
    den = d[i, 0] * d[j, 1] - d[i, 1] * d[j, 0]
    r = p[j] - p[i]
    off = np.abs(r[:, 0] * d[i, 1] - r[:, 1] * d[i, 0]) / size[i]
    flat = np.abs(den) <= 1e-12 * size[i] * size[j]
    of, at = [np.arange(n), np.arange(n)], [p, q]
    a, b = i[~flat], j[~flat]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (r[~flat, 0] * d[b, 1] - r[~flat, 1] * d[b, 0]) / den[~flat]
        u = (r[~flat, 0] * d[a, 1] - r[~flat, 1] * d[a, 0]) / den[~flat]
    et, eu = NEAR / size[a], NEAR / size[b]
    met = (t >= -et) & (t <= 1 + et) & (u >= -eu) & (u <= 1 + eu)
    a, b, t, u, et, eu = (x[met] for x in (a, b, t, u, et, eu))
    x = np.round(p[a] + t[:, None] * d[a], DIGITS)
    for near_, point in ((np.abs(t) <= et, p[a]), (np.abs(1 - t) <= et, q[a]), (np.abs(u) <= eu, p[b]), (np.abs(1 - u) <= eu, q[b])):
        x[near_] = point[near_]
    of += [a, b]
    at += [x, x]
    same = flat & (off <= NEAR)
    for a, b in ((i[same], j[same]), (j[same], i[same])):
        of += [a, a]
        at += [p[b], q[b]]
    of, at = np.concatenate(of), np.concatenate(at)
    along = ((at - p[of]) * d[of]).sum(axis=1) / size[of] ** 2
    along[:n], along[n : 2 * n] = 0, 1  # the ends themselves
    inside = (along >= 0) & (along <= 1)
    of, at, along = of[inside], at[inside], along[inside]
    order = np.lexsort((along, of))
    of, at = of[order], at[order]
    step = (of[1:] == of[:-1]) & (np.abs(at[1:] - at[:-1]) > NEAR / 8).any(axis=1)
    return of[:-1][step], at[:-1][step], at[1:][step]


def _forward(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, 0] < b[:, 0]) | ((a[:, 0] == b[:, 0]) & (a[:, 1] < b[:, 1]))


class _Leaves(NamedTuple):
    """Boxes with few edges, a row each: box, winding numbers just above and left of the lower left corner by layer, and the group it is of. Segments: parts of edges
    in a leaf, all that coincide being one; net is what crossing one from right to left adds. Left: edges that pass a leaf's left side, sums at one height."""

    box: np.ndarray
    corner: np.ndarray
    group: np.ndarray
    leaf: np.ndarray
    p: np.ndarray
    q: np.ndarray
    way: np.ndarray
    net: np.ndarray
    left_leaf: np.ndarray
    left_at: np.ndarray
    left_up: np.ndarray


def _sums(values: np.ndarray, group: np.ndarray, layer: np.ndarray, n: int, layers: int) -> np.ndarray:
    return np.bincount(group * layers + layer, weights=values, minlength=n * layers).astype(np.int64).reshape(n, layers)


def _gathered(e, layer, leaf, keep, p, q, left, at, up, box, corner, group, chosen) -> _Leaves:
    """The chosen boxes as leaves."""
    number = np.cumsum(chosen) - 1
    mine = chosen[leaf[keep]]
    keep, p, q = keep[mine], p[mine], q[mine]
    forward = _forward(p, q)
    ends = np.where(forward[:, None], np.hstack([p, q]), np.hstack([q, p]))
    first, seg = firsts(np.column_stack([number[leaf[keep]], ends]))
    sign, layers = np.where(forward, 1, -1), corner.shape[1]
    net = _sums(sign, seg, layer[keep], len(first), layers)
    way = (e[keep[first], 2:] - e[keep[first], :2]) * sign[first][:, None]
    mine = chosen[leaf[left]]
    left, at, up = left[mine], at[mine], up[mine]
    one, spot = firsts(np.column_stack([number[leaf[left]], at]))
    steps = _sums(up, spot, layer[left], len(one), layers)
    return _Leaves(box[chosen], corner[chosen], group[chosen], number[leaf[keep[first]]], ends[first, :2], ends[first, 2:], way, net, number[leaf[left[one]]], at[one], steps)


def _settled(rule: Callable, corner: np.ndarray, most: np.ndarray) -> bool:
    """Whether the rule says the same of all winding numbers that so many edges of each layer can make of a corner's."""
    if np.prod(2.0 * most + 1) > 250_000:
        return False
    all_ = np.stack([w.ravel() for w in np.meshgrid(*[np.arange(c - m, c + m + 1) for c, m in zip(corner, most, strict=True)], indexing="ij")])
    said = rule(all_)
    return bool(said.all() or not said.any())


def _quartered(e: np.ndarray, layer: np.ndarray, leaf: np.ndarray, box: np.ndarray, corner: np.ndarray, rule: Callable | None, bare: list | None = None) -> Iterator[_Leaves]:
    """Leaves of boxes with their edges (leaf: number of an edge's box), all boxes of a depth at once. Boxes where the rule holds throughout or nowhere, and those without
    edges, have none; bare gets the latter (boxes, corners, groups)."""
    group = np.arange(len(box))
    layers = corner.shape[1]
    for depth in range(DEEP + 1):
        keep, p, q = _clip(e, box[leaf])
        x0, y0, y1 = box[leaf, 0], box[leaf, 1], box[leaf, 3]
        left = np.flatnonzero((e[:, 0] < x0) != (e[:, 2] < x0))
        at = _cross(e[left], x0[left], 0)
        mine = (at >= y0[left]) & (at < y1[left])
        left, at = left[mine], at[mine]
        up = np.where(e[left, 2] > e[left, 0], 1, -1)  # what crossing an edge upwards adds
        many = np.bincount(leaf[keep], minlength=len(box))
        if bare is not None:
            bare.append((box[many == 0], corner[many == 0], group[many == 0]))
        crowded = many > FEW
        if rule is not None and crowded.any():
            most = _sums(np.ones(len(keep)), leaf[keep], layer[keep], len(box), layers) + _sums(np.ones(len(left)), leaf[left], layer[left], len(box), layers)
            for k in np.flatnonzero(crowded):
                if _settled(rule, corner[k], most[k]):
                    many[k], crowded[k] = 0, False
        if depth == DEEP:
            crowded[:] = False
        elif crowded.any():  # only what differs counts
            mine = crowded[leaf[keep]]
            forward = _forward(p[mine], q[mine])
            ends = np.where(forward[:, None], np.hstack([p[mine], q[mine]]), np.hstack([q[mine], p[mine]]))
            first, _ = firsts(np.column_stack([leaf[keep[mine]], ends]))
            crowded &= np.bincount(leaf[keep[mine][first]], minlength=len(box)) > FEW
        done = (many > 0) & ~crowded
        if done.any():
            yield _gathered(e, layer, leaf, keep, p, q, left, at, up, box, corner, group, done)
        if not crowded.any():
            return
        number = np.cumsum(crowded) - 1
        mine = crowded[leaf[left]]
        left, at, up = left[mine], at[mine], up[mine]
        mine = crowded[leaf]
        x0, y0, x1, y1 = box[crowded].T
        xm, ym = (x0 + x1) / 2, (y0 + y1) / 2
        corner, group = corner[crowded], group[crowded]
        n = len(corner)
        low = at < ym[number[leaf[left]]]
        upper = corner + _sums(up[low], number[leaf[left[low]]], layer[left[low]], n, layers)
        e, layer, leaf = e[mine], layer[mine], number[leaf[mine]]

        def along(y: np.ndarray, start: np.ndarray, e=e, layer=layer, leaf=leaf, x0=x0, xm=xm, n=n) -> np.ndarray:
            """From the left side to the middle, at height y."""
            c = np.flatnonzero((e[:, 1] <= y[leaf]) != (e[:, 3] <= y[leaf]))
            x = _cross(e[c], y[leaf[c]], 1)
            c = c[(x >= x0[leaf[c]]) & (x < xm[leaf[c]])]
            return start + _sums(np.where(e[c, 3] < e[c, 1], 1, -1), leaf[c], layer[c], n, layers)

        parts = [(x0, y0, xm, ym, corner), (xm, y0, x1, ym, along(y0, corner)), (x0, ym, xm, y1, upper), (xm, ym, x1, y1, along(ym, upper))]
        box, corner, group = np.concatenate([np.stack(part[:4], axis=1) for part in parts]), np.concatenate([part[4] for part in parts]), np.tile(group, 4)
        on = []
        for a, b, c, d, _ in parts:
            on.append(np.flatnonzero((np.minimum(e[:, 0], e[:, 2]) <= c[leaf]) & (np.maximum(e[:, 0], e[:, 2]) >= a[leaf]) & (np.minimum(e[:, 1], e[:, 3]) <= d[leaf]) & (np.maximum(e[:, 1], e[:, 3]) >= b[leaf])))
        leaf = np.concatenate([leaf[k] + i * n for i, k in enumerate(on)])
        on = np.concatenate(on)
        e, layer = e[on], layer[on]


class _Pieces(NamedTuple):
    """Pieces of segments cut at each other, going to the right, or up: ends, direction, leaf; with a rule also winding numbers left of a piece (below a level one) and on its other side."""

    ends: np.ndarray
    way: np.ndarray
    leaf: np.ndarray
    before: np.ndarray | None
    after: np.ndarray | None


def _cut(s: _Leaves, wound: bool) -> _Pieces:
    of, a, b = _split(s.p, s.q, s.leaf)
    forward = _forward(a, b)
    ends = np.where(forward[:, None], np.hstack([a, b]), np.hstack([b, a]))
    first, group = firsts(np.column_stack([s.leaf[of], np.round(ends, DIGITS)]))
    sign = np.where(forward, 1, -1)
    piece, way, leaf = ends[first], s.way[of[first]] * sign[first][:, None], s.leaf[of[first]]
    if not wound:
        return _Pieces(piece, way, leaf, None, None)
    n, layers = len(piece), s.net.shape[1]
    by_layer = lambda i, values: np.stack([np.bincount(i, weights=values[:, k], minlength=n) for k in range(layers)], axis=1).astype(np.int64)
    net = by_layer(group, s.net[of] * sign[:, None])  # what crossing a piece from right to left (upwards, if level) adds
    level, mid = piece[:, 1] == piece[:, 3], (piece[:, :2] + piece[:, 2:]) / 2
    # Winding numbers beside a piece: over the left side up to its height, then over the segments up to its place.
    start, stop = np.searchsorted(s.leaf, leaf), np.searchsorted(s.leaf, leaf, side="right")
    i, j = _pairs(start, stop - start)
    lo, hi = np.minimum(s.p[:, 1], s.q[:, 1]), np.maximum(s.p[:, 1], s.q[:, 1])
    y = mid[i, 1]
    crossed = np.where(level[i], (lo[j] < y) & (y <= hi[j]), (lo[j] <= y) & (y < hi[j])) & (np.minimum(s.p[j, 0], s.q[j, 0]) < mid[i, 0])
    i, j, y = i[crossed], j[crossed], y[crossed]
    x = s.p[j, 0] + (y - s.p[j, 1]) * (s.q[j, 0] - s.p[j, 0]) / (s.q[j, 1] - s.p[j, 1])
    own = np.isin(i * len(s.p) + j, group * len(s.p) + of)
    crossed = (x < mid[i, 0]) & ~own
    across = np.where(s.q[:, 1] > s.p[:, 1], -1, 1)[:, None] * s.net  # what passing a segment from left to right adds
    before = s.corner[leaf] + by_layer(i[crossed], across[j[crossed]])
    start, stop = np.searchsorted(s.left_leaf, leaf), np.searchsorted(s.left_leaf, leaf, side="right")
    i, j = _pairs(start, stop - start)
    walked = np.where(level[i], s.left_at[j] < mid[i, 1], s.left_at[j] <= mid[i, 1])
    before += by_layer(i[walked], s.left_up[j[walked]])
    after = before + np.where(level[:, None], net, np.where(piece[:, 3] > piece[:, 1], -1, 1)[:, None] * net)
    return _Pieces(piece, way, leaf, before, after)


def _chunks(s: _Leaves, most: int = 1_000_000) -> Iterator[_Leaves]:
    """Leaves in parts with about so many pairs of segments."""
    n = np.bincount(s.leaf, minlength=len(s.box)).astype(float)
    part = (np.cumsum(n * n) // most).astype(np.int64)
    for k in np.unique(part):
        a, b = np.searchsorted(part, k), np.searchsorted(part, k, side="right")
        g, h = slice(*np.searchsorted(s.leaf, [a, b])), slice(*np.searchsorted(s.left_leaf, [a, b]))
        yield _Leaves(s.box[a:b], s.corner[a:b], s.group[a:b], s.leaf[g] - a, s.p[g], s.q[g], s.way[g], s.net[g], s.left_leaf[h] - a, s.left_at[h], s.left_up[h])


def _outline(rule: Callable | None) -> Callable:
    """Kernel: (group, rows x0, y0, x1, y1, dx, dy) of the outcome."""

    def run(e, layer, leaf, box, corner):
        for leaves in _quartered(e, layer, leaf, box, corner, rule):
            for s in _chunks(leaves):
                c = _cut(s, rule is not None)
                if rule is None:
                    yield s.group[c.leaf], np.hstack([c.ends, c.way])
                    continue
                was, then = rule(c.before.T), rule(c.after.T)
                out = np.flatnonzero((c.before != c.after).any(axis=1) & (was != then))
                piece, way = c.ends[out], c.way[out]
                # The inside lies left of the direction: above a level piece that goes right, left of one that goes up.
                flip = np.where(piece[:, 1] == piece[:, 3], was[out], np.where(piece[:, 3] > piece[:, 1], ~was[out], was[out]))
                yield s.group[c.leaf[out]], np.hstack([np.where(flip[:, None], piece[:, [2, 3, 0, 1]], piece), way * np.where(flip, -1, 1)[:, None]])

    return run


def _areas(e, layer, leaf, box, corner):
    """Kernel: (group, rows winding number, area) of one layer. From the left side of a leaf on, each piece passed changes the number of what lies right of it."""
    bare: list = []
    parts = []
    for leaves in _quartered(e, layer, leaf, box, corner, None, bare):
        for s in _chunks(leaves):
            c = _cut(s, True)
            up = np.flatnonzero(c.ends[:, 1] != c.ends[:, 3])
            size = np.abs(c.ends[up, 3] - c.ends[up, 1]) * (s.box[c.leaf[up], 2] - (c.ends[up, 0] + c.ends[up, 2]) / 2)
            parts += [(s.group[c.leaf[up]], c.after[up, 0], size), (s.group[c.leaf[up]], c.before[up, 0], -size)]
            at = np.concatenate([s.box[:, 1], s.left_at])
            of = np.concatenate([np.arange(len(s.box)), s.left_leaf])
            w = np.concatenate([s.corner[:, 0], s.left_up[:, 0]])
            order = np.lexsort((at, of))
            at, of, w = at[order], of[order], np.cumsum(w[order])
            begin = np.searchsorted(of, np.arange(len(s.box)))
            w -= np.concatenate([[0], w[begin[1:] - 1]])[of]
            to = np.where(np.append(of[1:], -1) == of, np.append(at[1:], 0), s.box[of, 3])
            parts.append((s.group[of], w, (to - at) * (s.box[of, 2] - s.box[of, 0])))
    parts += [(g, c[:, 0], (b[:, 2] - b[:, 0]) * (b[:, 3] - b[:, 1])) for b, c, g in bare]
    group, w, size = (np.concatenate(x) for x in zip(*parts, strict=True))
    first, at = firsts(np.column_stack([group, w]))
    yield group[first], np.column_stack([w[first].astype(float), np.bincount(at, weights=size)])


def _least_nodes(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least that edges (a, b) join it to."""
    label = np.arange(n)
    while len(a):
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
        a, b = label[a], label[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return label


def _counts(e, layer, leaf, box, corner):
    """Kernel: (group, rows n, x, y, cx, cy) of all edges cut where they meet. A row without x for each tile: its pieces, less the corners inside it, and the connected
    parts that do not leave it. A row for each spot on the tile's border, in millionths of a metre, with a corner (cx, cy) of the part it is of."""
    found = [(s.group[c.leaf], c.ends) for leaves in _quartered(e, layer, leaf, box, corner, None) for s in _chunks(leaves) for c in [_cut(s, False)]]
    if not found:
        return
    group, ends = (np.concatenate(x) for x in zip(*found, strict=True))
    at = np.round(np.concatenate([ends[:, :2], ends[:, 2:]]) * 1e6)
    first, node = firsts(np.column_stack([np.tile(group, 2), at]))
    of, at, n = np.tile(group, 2)[first], at[first], len(group)
    part = _least_nodes(node[:n], node[n:], len(first))
    lines = np.round(box[of] * 1e6)
    rim = (at[:, 0] == lines[:, 0]) | (at[:, 0] == lines[:, 2]) | (at[:, 1] == lines[:, 1]) | (at[:, 1] == lines[:, 3])
    closed = part == np.arange(len(part))
    closed[part[rim]] = False
    total = np.bincount(group, minlength=len(box)) - np.bincount(of[~rim], minlength=len(box)) + np.bincount(of[closed], minlength=len(box))
    tiles = np.unique(group)
    none = np.full((len(tiles), 4), np.nan)
    yield tiles, np.column_stack([total[tiles].astype(float), none])
    yield of[rim], np.column_stack([np.zeros(rim.sum()), at[rim], at[part[rim]]])


def side_for(edges: DataFrame, per_tile: int = 2048) -> float:
    """A tile side by which a tile has about so many edges, as if they were spread evenly; at least as long as edges are on average."""
    one = edges.agg(F.count("*").alias("n"), *[F.min(F.least(f"{c}0", f"{c}1")).alias(f"lo_{c}") for c in "xy"], *[F.max(F.greatest(f"{c}0", f"{c}1")).alias(f"hi_{c}") for c in "xy"], F.avg(F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))).alias("length")).first()
    if not one.n:
        return 1.0
    wide, high = max(one.hi_x - one.lo_x, 1e-3), max(one.hi_y - one.lo_y, 1e-3)
    share = max(1.0, one.n / per_tile)
    return float(max(one.length, min((wide * high / share) ** 0.5, max(wide, high)), max(wide, high) / share) * 1.0001)


def _tiled(edges: DataFrame, by: list[str], kernel: Callable, columns: dict[str, str], layers: int, side: float | None, wound: bool, first: bool = False) -> DataFrame:
    """(by, columns) that the kernel makes of the tiles of each group's edges. wound: it needs winding numbers at corners. first: only tiles that the first layer reaches have an outcome."""
    digits = 10.0**DIGITS
    snapped = edges.select(*by, "layer", *[(F.rint(F.col(c) * digits) / digits).alias(c) for c in ("x0", "y0", "x1", "y1")])
    edges = materialise(snapped.filter("x0 <> x1 or y0 <> y1"), "edges")
    side = side or side_for(edges)
    for shares in zip(SHIFTS, SHIFTS[1:], strict=False):
        o = {"x": shares[0] * side, "y": shares[1] * side}  # unlike, so that no diagonal of corners runs through a tile's corner
        on = lambda c, o=o: F.pmod(F.col(c) - o[c[0]], F.lit(side)) == 0
        if not edges.filter(on("x0") | on("y0")).head(1):
            break
    square = lambda c, axis: F.floor((c - o[axis]) / side).cast("long")
    least, most = (lambda c: F.least(f"{c}0", f"{c}1")), (lambda c: F.greatest(f"{c}0", f"{c}1"))
    if first:
        reach = edges.filter("layer = 0").groupBy(*by).agg(*[F.min(square(least(c), c)).alias(f"__{c}a") for c in "xy"], *[F.max(square(most(c), c)).alias(f"__{c}b") for c in "xy"])
        edges = edges.join(reach, by)
    limited = lambda lo, hi, c: F.filter(F.sequence(F.greatest(lo, f"__{c}a"), F.greatest(F.least(hi, f"__{c}b"), F.greatest(lo, f"__{c}a"))), lambda k: k <= F.least(hi, F.col(f"__{c}b"))) if first else F.sequence(lo, hi)
    span = lambda c: limited(square(least(c), c), square(most(c), c), c)
    tiles = edges.withColumn("tx", F.explode(span("x"))).withColumn("ty", F.explode(span("y")))
    rows = tiles.select(*by, "tx", "ty", "layer", "x0", "y0", "x1", "y1", F.lit(None).cast("long").alias("w"))
    if wound:
        # Each crossing of the lower line of a row of tiles counts for the corners right of it, as far as the group reaches.
        line = F.col("ty") * side + o["y"]
        low = edges.withColumn("ty", F.explode(F.filter(span("y"), lambda k: (k * side + o["y"] >= least("y")) & (k * side + o["y"] < most("y")))))
        x = F.col("x0") + (line - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
        step = F.when(F.col("y1") < F.col("y0"), 1).otherwise(-1)
        at = F.greatest(square(x, "x") + 1, F.col("__xa")) if first else square(x, "x") + 1
        low = low.select(*by, "ty", "layer", at.alias("tx"), step.alias("w")).groupBy(*by, "ty", "tx", "layer").agg(F.sum("w").alias("w")).filter("w <> 0")
        reach = edges.groupBy(*by).agg((F.max("__xb") if first else F.max(square(most("x"), "x"))).alias("__last"))
        low = low.join(reach, by).filter("tx <= __last").withColumn("tx", F.explode(F.sequence("tx", "__last")))
        low = low.groupBy(*by, "tx", "ty", "layer").agg(F.sum("w").alias("w")).filter("w <> 0")
        none = F.lit(None).cast("double")
        rows = rows.unionByName(low.select(*by, "tx", "ty", "layer", none.alias("x0"), none.alias("y0"), none.alias("x1"), none.alias("y1"), "w"))
    names = [*by, "tx", "ty"]

    def solved(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What the kernel makes of whole tiles, all at once."""
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, t.num_rows)))
        col = lambda c: t.column(c).to_numpy(zero_copy_only=False)
        e, layer, w = np.stack([col(c).astype(float) for c in ("x0", "y0", "x1", "y1")], axis=1), col("layer").astype(np.int64), col("w").astype(float)
        edge = ~np.isnan(e[:, 0])
        corner = _sums(w[~edge], of[~edge], layer[~edge], len(starts), layers)
        tx, ty = col("tx")[starts], col("ty")[starts]
        box = np.stack([tx * side + o["x"], ty * side + o["y"], (tx + 1) * side + o["x"], (ty + 1) * side + o["y"]], axis=1)
        for group, found in kernel(e[edge], layer[edge], of[edge], box, corner):
            same = t.select(by).take(pa.array(starts[group])).combine_chunks()
            for a in range(0, len(group), 100_000):
                part = found[a : a + 100_000]
                own = same.slice(a, 100_000)
                yield pa.RecordBatch.from_arrays([*[pa.concat_arrays(c.chunks) if c.num_chunks != 1 else c.chunk(0) for c in own.columns], *[pa.array(part[:, i]) for i in range(len(columns))]], names=[*by, *columns])

    kinds = {f.name: f.dataType.simpleString() for f in edges.schema if f.name in by}
    schema = ", ".join([*[f"`{b}` {kinds[b]}" for b in by], *[f"{c} {k}" for c, k in columns.items()]])
    return worked(rows, names, solved, schema)


def overlay(edges: DataFrame, by: str | list[str], rule: Callable | None, layers: int = 1, side: float | None = None, first: bool = False) -> DataFrame:
    """(by, x0, y0, x1, y1, dx, dy): pieces of the outline of where the rule holds, for each group, inside on their left; (dx, dy) is the direction of the edge that
    a piece is part of. rule: winding numbers by layer to a Boolean array. Without a rule: all edges cut where they meet, each piece once. first: the rule holds only in
    shapes of the first layer, so nothing is looked at where a group has none."""
    by = [by] if isinstance(by, str) else by
    return _tiled(edges, by, _outline(rule), dict.fromkeys(("x0", "y0", "x1", "y1", "dx", "dy"), "double"), layers, side, rule is not None, first)


def face_counts(lines: DataFrame, by: str | list[str], side: float | None = None) -> DataFrame:
    """(by, faces): number of bounded faces of the line work (by, rings) of each group. Euler: faces are pieces less corners and connected parts; tiles count what lies in
    them, and parts that leave a tile are joined by their spots on its border, so no face is made."""
    by = [by] if isinstance(by, str) else by
    columns = ("n", "x", "y", "cx", "cy")
    p, q = (F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (0, 1))
    once = line_edges(lines, by).select(*by, "layer", F.least(p, q).alias("p"), F.greatest(p, q).alias("q")).distinct()  # lines that repeat add no face
    found = materialise(_tiled(_edges(once, by, 0), by, _counts, dict.fromkeys(columns, "double"), 1, side, False), "face-counts")
    inner = found.filter("isnan(x)").groupBy(*by).agg(F.sum("n").alias("n"))
    rim = found.filter("not isnan(x)")
    nodes = materialise(rim.select(*by, "x", "y").union(rim.select(*by, "cx", "cy")).distinct().withColumn("v", F.monotonically_increasing_id()), "face-nodes")
    links = rim.join(nodes.withColumnRenamed("v", "a"), [*by, "x", "y"]).join(nodes.select(*by, F.col("x").alias("cx"), F.col("y").alias("cy"), F.col("v").alias("b")), [*by, "cx", "cy"])
    label = least_labels(links.select("a", "b"), lambda df: materialise(df, "face-rounds"))
    parts = nodes.join(label, "v", "left").groupBy(*by).agg(F.countDistinct(F.coalesce("label", "v")).alias("parts"))
    spots = rim.select(*by, "x", "y").distinct().groupBy(*by).agg(F.count("*").alias("spots"))
    rows = inner.join(parts, by, "left").join(spots, by, "left")
    return rows.select(*by, (F.col("n") - F.coalesce("spots", F.lit(0)) + F.coalesce("parts", F.lit(0))).cast("long").alias("faces"))


def depths(shapes: DataFrame, by: str | list[str], side: float | None = None) -> DataFrame:
    """(by, depth, area): area that so many shapes (by, rings) of a group cover, for each such number but 0."""
    by = [by] if isinstance(by, str) else by
    found = _tiled(polygon_edges(shapes, by), by, _areas, {"depth": "double", "area": "double"}, 1, side, True)
    return found.groupBy(*by, F.col("depth").cast("long").alias("depth")).agg(F.sum("area").alias("area")).filter("depth <> 0 and area > 1e-9")


covered = lambda w: w[0] > 0  # noqa: E731  # union of polygons whose outlines run counter-clockwise
odd = lambda w: w[0] % 2 == 1  # noqa: E731  # the even-odd rule: repairs a shape that crosses itself
both = lambda w: (w[0] > 0) & (w[1] > 0)  # noqa: E731  # intersection of two layers
only_first = lambda w: (w[0] > 0) & ~(w[1] > 0)  # noqa: E731  # difference of two layers


def measures(pieces: DataFrame, by: str | list[str]) -> DataFrame:
    """(by, area, perimeter) of an outline. Areas are summed about corners of blocks of a kilometre, and blocks about the group's least, which keeps their digits; pieces are
    read once, and only blocks are shuffled."""
    by = [by] if isinstance(by, str) else by
    block = {c: F.floor(F.col(f"{c}0") / 1024.0) * 1024.0 for c in "xy"}
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    cross = (F.col("x0") - F.col("__x")) * dy - (F.col("y0") - F.col("__y")) * dx
    sums = [F.sum(cross).alias("__a"), F.sum(dx).alias("__dx"), F.sum(dy).alias("__dy"), F.sum(F.hypot(dx, dy)).alias("__p")]
    blocks = materialise(pieces.withColumns({"__x": block["x"], "__y": block["y"]}).groupBy(*by, "__x", "__y").agg(*sums), "blocks")
    at = blocks.groupBy(*by).agg(F.min("__x").alias("__ox"), F.min("__y").alias("__oy"))
    moved = F.col("__a") + (F.col("__x") - F.col("__ox")) * F.col("__dy") - (F.col("__y") - F.col("__oy")) * F.col("__dx")
    return blocks.join(at, by).groupBy(*by).agg((F.sum(moved) / 2).alias("area"), F.sum("__p").alias("perimeter"))


def _steps(rings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Edges of open rings (a list of rings for each row), and the row of each; those shorter than the last digit go."""
    ring = rings.flatten()
    xy, begin = coordinates(ring)
    many = np.diff(begin)
    after = np.arange(len(xy)) + 1
    after[begin[1:][many > 0] - 1] = begin[:-1][many > 0]
    xy = np.rint(xy * 10.0**DIGITS) / 10.0**DIGITS
    of = np.repeat(np.repeat(np.arange(len(rings)), sizes(rings)), many)
    long = (xy != xy[after]).any(axis=1)
    return np.hstack([xy, xy[after]])[long], of[long]


def each_measured(shapes: DataFrame, by: str | list[str], layers: list[str], rule: Callable) -> DataFrame:
    """(by, area, perimeter) of the outcome of the rule for each row's own shapes, one column of rings for each layer. The first layer's edges and what lies about them are looked at, so the
    rule must hold only in it. Rows are solved where they are, many at once: nothing is cut into tiles or shuffled, so a row's shapes must fit in memory. A row without an outcome does not come back."""
    by = [by] if isinstance(by, str) else by
    kernel = _outline(rule)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_steps(b.column(f"__{i}")) for i in range(len(layers))]
            e, of = found[0]
            rows, leaf = np.unique(of, return_inverse=True)
            if not len(rows):
                continue
            lo, hi = np.full((len(rows), 2), np.inf), np.full((len(rows), 2), -np.inf)
            np.minimum.at(lo, leaf, np.minimum(e[:, :2], e[:, 2:]))
            np.maximum.at(hi, leaf, np.maximum(e[:, :2], e[:, 2:]))
            wide = np.maximum(hi - lo, 1e-3).max(axis=1, keepdims=True) / 16
            box = np.hstack([lo - wide * SHIFTS[0], hi + wide * SHIFTS[1]])
            place = np.full(b.num_rows, -1)
            place[rows] = np.arange(len(rows))
            layer = np.concatenate([np.full(len(x), i) for i, (x, _) in enumerate(found)])
            e, leaf = np.concatenate([x for x, _ in found]), place[np.concatenate([x for _, x in found])]
            e, layer, leaf = e[leaf >= 0], layer[leaf >= 0], leaf[leaf >= 0]
            c = np.flatnonzero((e[:, 1] <= box[leaf, 1]) != (e[:, 3] <= box[leaf, 1]))
            c = c[_cross(e[c], box[leaf[c], 1], 1) < box[leaf[c], 0]]
            corner = _sums(np.where(e[c, 3] < e[c, 1], 1, -1), leaf[c], layer[c], len(rows), len(layers))
            area, length, any_ = (np.zeros(len(rows)) for _ in range(3))
            for group, p in kernel(e, layer, leaf, box, corner):
                d, at = p[:, 2:4] - p[:, :2], p[:, :2] - box[group, :2]
                for total, part in ((area, (at[:, 0] * d[:, 1] - at[:, 1] * d[:, 0]) / 2), (length, np.hypot(d[:, 0], d[:, 1])), (any_, None)):
                    total += np.bincount(group, weights=part, minlength=len(rows))
            got = np.flatnonzero(any_)
            yield pa.RecordBatch.from_arrays([*[b.column(k).take(pa.array(rows[got])) for k in by], pa.array(area[got]), pa.array(length[got])], names=[*by, "area", "perimeter"])

    kinds = {f.name: f.dataType.simpleString() for f in shapes.schema if f.name in by}
    none = F.array().cast("array<array<struct<x:double,y:double>>>")
    own = spatial.dealt(shapes.select(*by, *layers)).select(*by, *[_open_rings(c).alias(f"__{i}") for i, c in enumerate(layers)])
    turned = lambda c: F.zip_with(c, _depths(F.col(c)), _turned)
    own = own.select(*by, *[F.coalesce(turned(f"__{i}"), none).alias(f"__{i}") for i in range(len(layers))])
    return own.mapInArrow(run, ", ".join([*[f"`{k}` {kinds[k]}" for k in by], "area double, perimeter double"]))


def united(shapes: DataFrame, by: str | list[str], side: float | None = None) -> DataFrame:
    """Outline of the union of each group's shapes (by, rings)."""
    return overlay(polygon_edges(shapes, by), by, covered, side=side)


def repaired(shapes: DataFrame, by: str | list[str], side: float | None = None) -> DataFrame:
    """Outline of each shape (by, rings) by the even-odd rule, whatever its rings cross or repeat."""
    return overlay(polygon_edges(shapes, by), by, odd, side=side)


def combined(a: DataFrame, b: DataFrame, by: str | list[str], rule: Callable = both, side: float | None = None) -> DataFrame:
    """Outline of what two layers of shapes (by, rings) have in common, or by another rule, for each group."""
    return overlay(polygon_edges(a, by, 0).unionByName(polygon_edges(b, by, 1)), by, rule, layers=2, side=side, first=rule in (both, only_first))


def capsules(edges: DataFrame, by: str | list[str], metres: Column | float, quarter: int = 8) -> DataFrame:
    """(by, rings): all within so many metres of each edge (by, x0, y0, x1, y1, …), half circles at its ends having quarter corners to a right angle."""
    by = [by] if isinstance(by, str) else by
    r = metres if isinstance(metres, Column) else F.lit(float(metres))
    turn = F.atan2(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))

    def half(x: str, y: str, start: float) -> Column:
        at = lambda k: turn + start + k * np.pi / (2 * quarter)
        return F.transform(F.sequence(F.lit(0), F.lit(2 * quarter)), lambda k: F.struct((F.col(x) + r * F.cos(at(k))).alias("x"), (F.col(y) + r * F.sin(at(k))).alias("y")))

    return edges.select(*by, F.array(F.concat(half("x1", "y1", -np.pi / 2), half("x0", "y0", np.pi / 2))).alias("rings"))


def _rounded(rings: Column, r: Column, quarter: int) -> Column:
    """A box widened by r, its corners being arcs."""
    b = spatial.bounds(rings)

    def arc(x: str, y: str, start: float) -> Column:
        at = lambda k: start + k * np.pi / (2 * quarter)
        return F.transform(F.sequence(F.lit(0), F.lit(quarter)), lambda k: F.struct((b[x] + r * F.cos(at(k))).alias("x"), (b[y] + r * F.sin(at(k))).alias("y")))

    return F.array(F.concat(arc("maxx", "miny", -np.pi / 2), arc("maxx", "maxy", 0.0), arc("minx", "maxy", np.pi / 2), arc("minx", "miny", np.pi)))


def buffered(shapes: DataFrame, by: str | list[str], metres: Column | float, quarter: int = 8, side: float | None = None) -> DataFrame:
    """Outline of all within so many metres of each group's shapes (by, kind, rings): polygons with their inside, lines and points alone. What is widened by itself and comes
    out convex, a box or a single step, is its own outline."""
    by = [by] if isinstance(by, str) else by
    r = metres if isinstance(metres, Column) else F.lit(float(metres))
    n = F.count("*").over(Window.partitionBy(*by))
    shapes = materialise(shapes.withColumns({"__r": r, "__n": n}).select(*by, "kind", "rings", "__r", "__n"), "to-widen")
    ring, b = F.get("rings", 0), spatial.bounds(F.col("rings"))
    box = (F.col("kind") == "polygon") & spatial._is_box(F.col("rings")) & (b["maxx"] > b["minx"]) & (b["maxy"] > b["miny"])
    step = (F.col("kind") == "line") & (F.size("rings") == 1) & (F.size(ring) == 2) & (F.get(ring, 0) != F.get(ring, 1))
    lone = F.coalesce((F.col("__n") == 1) & (F.col("__r") > 0) & (box | step), F.lit(False))
    alone, shapes = shapes.filter(lone), shapes.filter(~lone)
    wide = alone.filter("kind = 'polygon'").select(*by, _rounded(F.col("rings"), F.col("__r"), quarter).alias("rings"))
    ends = [F.get(ring, i)[c].alias(f"{c}{i}") for i in (0, 1) for c in "xy"]
    wide = wide.unionByName(capsules(alone.filter("kind = 'line'").select(*by, "__r", *ends), by, F.col("__r"), quarter))
    own = wide.select(*by, F.explode(spatial.edges(F.col("rings"))).alias("e"))
    digits = 10.0**DIGITS
    own = own.select(*by, *[(F.rint(F.col(f"e.{p}.{c}") * digits) / digits).alias(f"{c}{i}") for i, p in enumerate("pq") for c in "xy"])
    own = own.filter("x0 <> x1 or y0 <> y1").withColumns({"dx": F.col("x1") - F.col("x0"), "dy": F.col("y1") - F.col("y0")})
    return own.unionByName(_widened(shapes, by, quarter, side))


def _widened(shapes: DataFrame, by: list[str], quarter: int, side: float | None) -> DataFrame:
    """The outline of shapes (by, kind, rings, __r) widened, whatever they are: shapes and capsules of their steps united."""
    areas = shapes.filter("kind = 'polygon'")
    steps = polygon_edges(areas, by).unionByName(line_edges(shapes.filter("kind = 'line'"), by))
    spots = shapes.filter("kind = 'point'").select(*by, F.explode(F.flatten("rings")).alias("p"))
    steps = steps.unionByName(spots.select(*by, F.lit(0).alias("layer"), F.col("p.x").alias("x0"), F.col("p.y").alias("y0"), F.col("p.x").alias("x1"), F.col("p.y").alias("y1")))
    steps = steps.join(shapes.select(*by, "__r").distinct(), by)
    return overlay(polygon_edges(areas, by).unionByName(polygon_edges(capsules(steps, by, F.col("__r"), quarter), by)), by, covered, side=side)
