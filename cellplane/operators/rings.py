"""Rings from directed pieces of outlines, over a distributed table: outlines of unions and of labelled cells, faces of line work.

A piece goes to the tile of its start, and to the tile of its end if that is another one. In a tile each piece finds the piece that follows it: at a corner where
several begin, the first one clockwise from where it came, so rings touch themselves but never cross. What a tile can follow on its own becomes a ring
or a chain; chains that go on in other tiles are the nodes of a much smaller table. There pointer doubling gives all chains of a ring the least of their
numbers (as many rounds as the logarithm of the longest ring's chains), and the chains of one ring are put one behind the other.

A ring is a row, so one ring must fit in memory; nothing else is gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.operators import overlay, spatial
from cellplane.operators.grouped import array, firsts, joined, lists, offsets, sizes, worked
from cellplane.scratch import materialise

#: Corners are told apart to a micrometre; halves go to even in plans (rint) as in NumPy, or the two would tell them apart unlike.
FINE = 1e6
POINTS = "array<struct<x:double,y:double>>"


def _following(end: np.ndarray, way_in: np.ndarray, start: np.ndarray, way_out: np.ndarray) -> np.ndarray:
    """For each piece that ends at a corner (a number), which of those that start there follows; -1 if none does."""
    order = np.argsort(start, kind="stable")
    first, last = (np.searchsorted(start[order], end, side=s) for s in ("left", "right"))
    many = last - first
    inn = np.repeat(np.arange(len(end)), many)
    out = order[np.arange(len(inn)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)]
    back = np.arctan2(-way_in[inn, 1], -way_in[inn, 0])
    turn = np.mod(back - np.arctan2(way_out[out, 1], way_out[out, 0]), 2 * np.pi)
    turn[turn < 1e-12] = 2 * np.pi  # straight back comes last
    pick = np.lexsort((turn, inn))
    lead = np.concatenate([[True], inn[pick][1:] != inn[pick][:-1]]) if len(inn) else np.empty(0, bool)
    found = np.full(len(end), -1, dtype=np.int64)
    found[inn[pick][lead]] = out[pick][lead]
    return found


def corners(x: np.ndarray, y: np.ndarray, dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    """A ring's corners (n, 2) from the starts and directions of its pieces: what goes straight on is no corner, ways there and back go. The least (y, x) comes first."""
    at = list(zip(np.round(x * FINE).tolist(), np.round(y * FINE).tolist(), strict=True))
    kept: list[int] = []  # pieces; one that goes back to where the piece before it began cancels that piece
    n, size = len(x), np.hypot(dx, dy)
    # The piece after i in the ring ends where piece i + 2 begins: ways there and back are pairs whose outer corners agree.
    ends = at[1:] + at[:1]
    for i in range(n):
        if kept and ends[i] == at[kept[-1]]:
            kept.pop()
        else:
            kept.append(i)
    lo, hi = 0, len(kept)
    while hi - lo > 1 and ends[kept[hi - 1]] == at[kept[hi - 1]]:
        hi -= 1
    while hi - lo > 2 and ends[kept[lo]] == at[kept[hi - 1]]:
        lo, hi = lo + 1, hi - 1
    k = np.array(kept[lo:hi], dtype=np.int64)
    if len(k) < 3:
        return np.empty((0, 2))
    before = np.roll(k, 1)
    bend = np.abs(dx[before] * dy[k] - dy[before] * dx[k]) > 1e-12 * size[before] * size[k]
    bend |= dx[before] * dx[k] + dy[before] * dy[k] < 0
    out = np.stack([x[k], y[k]], axis=1)[bend]
    return np.roll(out, -int(np.lexsort((out[:, 0], out[:, 1]))[0]), axis=0) if len(out) else out


def signed_area(p: np.ndarray) -> float:
    q = p - p[:1]
    n = np.roll(q, -1, axis=0)
    return float((q[:, 0] * n[:, 1] - n[:, 0] * q[:, 1]).sum() / 2)


def stitched(pieces: DataFrame, by: str | list[str], side: float | None = None, both_ways: bool = False) -> DataFrame:
    """(by, points, area) of the rings that pieces (by, x0, y0, x1, y1, dx, dy) form: area is positive if the ring runs counter-clockwise.

    both_ways: pieces have no direction; the rings are the faces left of each way along them (bounded faces are positive). Ways that lead nowhere
    take no part in the corners; rings without area are left out.
    """
    by = [by] if isinstance(by, str) else by
    own = pieces.select(*by, "x0", "y0", "x1", "y1", "dx", "dy")
    if both_ways:
        own = own.unionByName(own.select(*by, F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x0").alias("x1"), F.col("y0").alias("y1"), (-F.col("dx")).alias("dx"), (-F.col("dy")).alias("dy")))
    own = materialise(own.withColumn("id", F.monotonically_increasing_id()), "pieces")
    side = side or overlay.side_for(own, 8192)
    tile = lambda c: F.floor(F.rint(F.col(c) * FINE) / FINE / side).cast("long")
    places = F.array(F.struct(tile("x0").alias("x"), tile("y0").alias("y"), F.lit(True).alias("own")), F.struct(tile("x1").alias("x"), tile("y1").alias("y"), F.lit(False).alias("own")))
    placed = own.withColumn("at", F.explode(places)).filter("at.own or at.x <> floor(rint(x0 * 1e6) / 1e6 / {0}) or at.y <> floor(rint(y0 * 1e6) / 1e6 / {0})".format(repr(side)))
    kinds = {f.name: f.dataType.simpleString() for f in own.schema if f.name in by}
    keys = ", ".join(f"`{b}` {kinds[b]}" for b in by)
    # kind 0: a ring; 1: a chain from piece head to piece tail; 2: what follows piece head, which comes from another tile, is piece tail.
    fields = ["kind", "head", "tail", "x", "y", "dx", "dy"]
    schema = f"{keys}, kind int, head long, tail long, x array<double>, y array<double>, dx array<double>, dy array<double>"

    def follow(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Many tiles at once."""
        col = lambda c: t.column(c).to_numpy(zero_copy_only=False)
        x, y, dx, dy, number, mine = col("x0"), col("y0"), col("dx"), col("dy"), col("id"), col("own").astype(bool)
        n, group = len(x), np.repeat(np.arange(len(starts)), np.diff(np.append(starts, t.num_rows)))
        ex, ey = np.round(col("x1") * FINE), np.round(col("y1") * FINE)
        _, corner = firsts(np.stack([np.tile(group, 2), np.concatenate([np.round(x * FINE), ex]), np.concatenate([np.round(y * FINE), ey])], axis=1))
        start, end, way = corner[:n], corner[n:], np.stack([dx, dy], axis=1)
        ours = np.flatnonzero(mine)
        inn = np.flatnonzero((np.floor(ex / FINE / side) == col("tx")) & (np.floor(ey / FINE / side) == col("ty")))
        to = np.full(n, -1, dtype=np.int64)
        found = _following(end[inn], way[inn], start[ours], way[ours])
        to[inn] = np.where(found >= 0, ours[found], -1) if len(ours) else -1
        heads = mine.copy()
        heads[to[ours][to[ours] >= 0]] = False
        step, seen, order, many, kinds_ = to.tolist(), bytearray(n), [], [], []
        for kind, begin in ((1, np.flatnonzero(heads)), (0, ours)):
            for at in begin.tolist():
                if seen[at]:
                    continue
                before = len(order)
                while at >= 0 and not seen[at]:
                    seen[at] = 1
                    order.append(at)
                    at = step[at]
                many.append(len(order) - before)
                kinds_.append(kind)
        order, many = np.array(order, dtype=np.int64), np.array(many, dtype=np.int64)
        foreign = np.flatnonzero(~mine & (to >= 0))
        begin = offsets(many)
        head, tail = np.concatenate([order[begin[:-1]], foreign]), np.concatenate([order[begin[1:] - 1], to[foreign]])
        kind = np.concatenate([np.array(kinds_, dtype=np.int64), np.full(len(foreign), 2)])
        many = np.concatenate([many, np.zeros(len(foreign), dtype=np.int64)])
        made = [array(t.column(c)).take(pa.array(head)) for c in by]
        made += [pa.array(kind, pa.int32()), pa.array(number[head]), pa.array(number[tail]), *[lists(v[order], many) for v in (x, y, dx, dy)]]
        yield pa.RecordBatch.from_arrays(made, names=[*by, *fields])

    parts = placed.select(*by, F.col("at.x").alias("tx"), F.col("at.y").alias("ty"), F.col("at.own").alias("own"), "id", "x0", "y0", "x1", "y1", "dx", "dy")
    parts = materialise(worked(parts, [*by, "tx", "ty"], follow, schema), "chains")
    chains = parts.filter("kind = 1")
    next_ = chains.select("head", "tail").join(parts.filter("kind = 2").select(F.col("head").alias("tail"), F.col("tail").alias("next")), "tail").select(F.col("head").alias("v"), "next")
    ring = _least_on_cycle(next_)
    whole = chains.join(ring.select(F.col("v").alias("head"), "ring", "next"), "head")

    def join(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The chains of many rings, each laid one behind the other from the ring's least chain."""
        at = {h: i for i, h in enumerate(t.column("head").to_pylist())}
        to, least, order = t.column("next").to_pylist(), t.column("ring").to_pylist(), []
        many = np.diff(np.append(starts, t.num_rows))
        for first, n in zip(starts.tolist(), many.tolist(), strict=True):
            row = at[least[first]]
            for _ in range(n):
                order.append(row)
                row = at[to[row]]
        made = [array(t.column(c)).take(pa.array(starts)) for c in (*by, "ring")]
        made[-1:] = [pa.array(np.zeros(len(starts)), pa.int32()), made[-1], pa.array(np.zeros(len(starts), dtype=np.int64))]
        for c in ("x", "y", "dx", "dy"):
            laid = array(t.column(c)).take(pa.array(order, pa.int64()))
            made.append(lists(laid.flatten().to_numpy(zero_copy_only=False), np.add.reduceat(sizes(laid), starts)))
        yield pa.RecordBatch.from_arrays(made, names=[*by, *fields])

    closed = parts.filter("kind = 0").unionByName(worked(whole.select(*by, "ring", "head", "next", "x", "y", "dx", "dy"), [*by, "ring"], join, schema))

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("x", "y", "dx", "dy")]
            at = offsets(sizes(b.column("x"))).tolist()
            rows = [corners(*[c[i:j] for c in cols]) for i, j in zip(at, at[1:], strict=False)]
            area = np.array([signed_area(r) if len(r) > 2 else 0.0 for r in rows])
            keep = np.flatnonzero(np.abs(area) > 1e-9)
            points = joined([rows[i] for i in keep.tolist()])
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(pa.array(keep)) for c in by], points, pa.array(area[keep])], names=[*by, "points", "area"])

    return closed.mapInArrow(shape, f"{keys}, points {POINTS}, area double")


def _least_on_cycle(next_: DataFrame) -> DataFrame:
    """(v, next, ring): the least node of the cycle that v lies on. next_: v, next, a permutation."""
    next_ = materialise(next_, "next")
    now = next_.select("v", F.col("next").alias("p"), F.col("v").alias("m"))
    while True:
        far = now.select(F.col("v").alias("p"), F.col("p").alias("pp"), F.col("m").alias("mm"))
        now = materialise(now.join(far, "p").select("v", F.col("pp").alias("p"), F.least("m", "mm").alias("m"), (F.col("mm") < F.col("m")).alias("fell")), "ring-rounds")
        fell = now.filter("fell").head(1)
        now = now.drop("fell")
        if not fell:  # no window of twice the length holds less, so all nodes of a cycle agree
            return next_.join(now.select("v", F.col("m").alias("ring")), "v")


def nested(rings: DataFrame, by: str | list[str]) -> DataFrame:
    """(by, rings, area): polygons of rings (by, points, area), each shell with its holes behind it; a hole belongs to the smallest shell around it."""
    by = [by] if isinstance(by, str) else by
    rings = materialise(rings.withColumn("ring", F.monotonically_increasing_id()), "rings")
    shells, holes = rings.filter("area > 0"), rings.filter("area < 0")
    box = spatial.bounds(F.array("points"))
    side = shells.withColumn("b", box).agg(F.avg(F.greatest(F.col("b.maxx") - F.col("b.minx"), F.col("b.maxy") - F.col("b.miny")))).first()[0] or 1.0
    near = spatial._squares(shells.withColumn("__b", box), "__b", side)
    a, b = F.get("points", 0), F.get("points", 1)
    # A spot just inside the polygon, beside the middle of the hole's first side.
    long = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
    spot = holes.withColumns({"hx": (a["x"] + b["x"]) / 2 - (b["y"] - a["y"]) / long * 1e-5, "hy": (a["y"] + b["y"]) / 2 + (b["x"] - a["x"]) / long * 1e-5})
    spot = spot.select(*by, F.col("ring").alias("hole"), F.col("points").alias("hole_points"), F.col("area").alias("hole_area"), "hx", "hy")
    spot = spot.withColumns({"__bx": F.floor(F.col("hx") / side).cast("long"), "__by": F.floor(F.col("hy") / side).cast("long")})
    met = spot.join(near, [*by, "__bx", "__by"]).filter(spatial.inside(F.col("hx"), F.col("hy"), F.array("points")))
    first = Window.partitionBy("hole").orderBy("area", "ring")
    met = met.withColumn("r", F.row_number().over(first)).filter("r = 1").groupBy("ring").agg(F.array_sort(F.collect_list(F.struct("hole_area", "hole_points"))).alias("holes"))
    out = shells.join(met, "ring", "left")
    holes_ = F.coalesce(F.transform("holes", lambda h: h["hole_points"]), F.array().cast(f"array<{POINTS}>"))
    less = F.aggregate(F.coalesce("holes", F.array().cast(f"array<struct<hole_area:double,hole_points:{POINTS}>>")), F.lit(0.0), lambda n, h: n + h["hole_area"])
    return out.select(*by, F.concat(F.array("points"), holes_).alias("rings"), (F.col("area") + less).alias("area"))


def label_pieces(labelled: DataFrame, grid: GridSpec) -> DataFrame:
    """Outline pieces (label, x0, …) of labelled runs (row, c0, c1, label), cells of one label disjoint: sides of runs, and along each line between two
    rows the stretches where the label is on one side only. Inside on the left."""
    x, y = (lambda c: F.lit(grid.x0) + c * grid.cell_m), (lambda r: F.lit(grid.y_top) - r * grid.cell_m)
    piece = lambda xa, ya, xb, yb: [xa.cast("double").alias("x0"), ya.cast("double").alias("y0"), xb.cast("double").alias("x1"), yb.cast("double").alias("y1"), (xb - xa).cast("double").alias("dx"), (yb - ya).cast("double").alias("dy")]
    r, a, b = F.col("row"), F.col("c0"), F.col("c1") + 1
    sides = labelled.select("label", *piece(x(a), y(r), x(a), y(r + 1))).unionByName(labelled.select("label", *piece(x(b), y(r + 1), x(b), y(r))))
    ends = F.array(*[F.struct((r + k).alias("line"), at.alias("at"), F.lit(step * (1 - k)).alias("under"), F.lit(step * k).alias("over")) for k in (0, 1) for at, step in ((a, 1), (b, -1))])
    events = labelled.select("label", F.explode(ends).alias("e")).groupBy("label", F.col("e.line").alias("line"), F.col("e.at").alias("at")).agg(F.sum("e.under").alias("under"), F.sum("e.over").alias("over"))
    along = Window.partitionBy("label", "line").orderBy("at")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    found = events.select("label", "line", "at", F.lead("at").over(along).alias("to"), (F.sum("under").over(upto) > 0).alias("under"), (F.sum("over").over(upto) > 0).alias("over")).filter("under <> over")
    # over: the label lies above the line, so the line is its lower side and runs to the right.
    start, stop = F.when(F.col("over"), F.col("at")).otherwise(F.col("to")), F.when(F.col("over"), F.col("to")).otherwise(F.col("at"))
    return sides.unionByName(found.select("label", *piece(x(start), y(F.col("line")), x(stop), y(F.col("line")))))


def outlines(labelled: DataFrame, grid: GridSpec, side: float | None = None) -> DataFrame:
    """(label, points, area): the rings of each label; cells that meet in a corner only are in rings of their own."""
    return stitched(label_pieces(labelled, grid), "label", side)


def faces(lines: DataFrame, by: str | list[str], side: float | None = None) -> DataFrame:
    """(by, rings, area): bounded faces of the line work (by, rings) of each group, over all tiles at once, islands of other lines in them being holes."""
    pieces = overlay.overlay(overlay.line_edges(lines, by), by, None, side=side)
    return nested(stitched(pieces, by, side, both_ways=True), by)


def inner_spot(rings: Column, metres: float = 1e-3) -> tuple[Column, Column]:
    """A spot (x, y) inside a polygon: beside the middle of its first side, at most so far and a quarter of the side away."""
    a, b = F.get(F.get(rings, 0), 0), F.get(F.get(rings, 0), 1)
    long = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
    off = F.least(F.lit(metres), long / 4) / long
    return (a["x"] + b["x"]) / 2 - (b["y"] - a["y"]) * off, (a["y"] + b["y"]) / 2 + (b["x"] - a["x"]) * off
