"""Simplifying that keeps neighbours joined: shapes share arcs, and every arc is simplified once, for all shapes beside it.

All outlines are cut where they meet, and pieces are joined into arcs between the points where three or more end. An arc is simplified by Douglas and Peucker with
its ends fixed. What it leaves out must be free: a stretch that a chord replaces may have no corner of any outline in its convex hull but its own. Then no chord
crosses an outline or another chord, and nothing changes sides: an outline that entered a hull without a corner in it would cross the stretch too. Besides,
no two arcs may come to lie on one chord, and a closed arc keeps an area. An arc that breaks one of these rules is tried again with half the tolerance, and below a
millimetre it stays as it was; as rules look at outlines as they were, arcs do not wait for each other. The hull is wider than it need be, so an arc may keep
more corners than it must, never fewer.

Shapes may overlap, have holes and touch themselves. An arc is a row and must fit in memory; a shape's rings likewise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellplane.operators import chains, overlay, rings, spatial
from cellplane.operators.grouped import coordinates, joined, offsets
from cellplane.operators.outlines import POINT, convex_hull, signed_area
from cellplane.operators.outlines import kept as staying
from cellplane.operators.outlines import simplified as thinned
from cellplane.operators.rings import corners as turns
from cellplane.scratch import materialise

#: Cuts along a straight line are off it by less; arcs that would need a smaller tolerance stay as they were; spots that tell what is beside an arc are so far from it.
STRAIGHT, LEAST, BESIDE = 1e-5, 1e-3, 1e-3
_POINTS = pa.list_(POINT)
_SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("hull", _POINTS)]))
_FIT = f"chain long, points {rings.POINTS}, endless boolean, tolerance double, line {rings.POINTS}, flat boolean, spans array<struct<a:int,b:int,hull:{rings.POINTS}>>"


def _straightened(points: np.ndarray, endless: bool) -> np.ndarray:
    """An arc without points on straight lines, from its lesser end; an endless one from its least corner, the lesser neighbour next."""
    if endless:
        ring = points[:-1]
        d = np.roll(ring, -1, axis=0) - ring
        ring = turns(ring[:, 0], ring[:, 1], d[:, 0], d[:, 1])
        if len(ring) < 3:
            return points
        points = np.concatenate([ring, ring[:1]])
    way = points.tolist()
    if way[::-1] < way:
        points = points[::-1]
    return points if endless else thinned(points, STRAIGHT)


def _kept(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Numbers of the points of an arc that stay; a closed one is cut at its point farthest from the ends."""
    if tolerance <= 0:
        return np.arange(len(points))
    cuts = [0, len(points) - 1]
    if (points[0] == points[-1]).all():
        cuts.insert(1, int(np.argmax(np.hypot(*(points - points[0]).T))))
    keep = np.zeros(len(points), dtype=bool)
    for a, b in zip(cuts, cuts[1:], strict=False):
        keep[a : b + 1] |= staying(points[a : b + 1], tolerance)
    return np.flatnonzero(keep)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        xy, begin = coordinates(b.column("points"))
        lines, flat, ends, hulls, many = [], [], [], [], []
        for i, tolerance in enumerate(b.column("tolerance").to_pylist()):
            points = xy[begin[i] : begin[i + 1]]
            keep = _kept(points, tolerance)
            gone = [(x, y) for x, y in zip(keep[:-1].tolist(), keep[1:].tolist(), strict=True) if y - x > 1]
            line = points[keep]
            closed = (line[0] == line[-1]).all()
            flat.append(bool(gone) and bool(closed) and (len(line) < 4 or abs(signed_area(line[:-1])) < 1e-9))
            lines.append(line)
            ends += gone
            hulls += [convex_hull(points[x : y + 1]) for x, y in gone]
            many.append(len(gone))
        same = [b.column(c) for c in ("chain", "points", "endless", "tolerance")]
        at = np.array(ends, dtype=np.int64).reshape(-1, 2)
        spans = pa.StructArray.from_arrays([pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), joined(hulls).cast(_POINTS)], fields=list(_SPANS.value_type))
        spans = pa.ListArray.from_arrays(pa.array(offsets(np.array(many, dtype=np.int64)), pa.int32()), spans)
        yield pa.RecordBatch.from_arrays([*same, joined(lines), pa.array(flat, pa.bool_()), spans], names=["chain", "points", "endless", "tolerance", "line", "flat", "spans"])


def arcs(shapes: DataFrame, side: float | None = None) -> DataFrame:
    """(chain, points, endless) of the arcs of all shapes' outlines (rings), from their lesser end; chain numbers them."""
    closed = shapes.select(F.lit(1).alias("all"), F.transform(F.filter("rings", lambda r: F.size(r) > 0), lambda r: F.concat(r, F.slice(r, 1, 1))).alias("rings"))
    pieces = overlay.overlay(overlay.line_edges(closed, "all"), "all", None, side=side)
    point = lambda k: F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"))
    pieces = materialise(pieces.select(F.monotonically_increasing_id().alias("id"), F.array(point(0), point(1)).alias("points")), "arc-pieces")

    def run(batches):
        for b in batches:
            xy, begin = coordinates(b.column("points"))
            made = [_straightened(xy[i:j], e) for i, j, e in zip(begin.tolist(), begin[1:].tolist(), b.column("endless").to_pylist(), strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("chain"), joined(made), b.column("endless")], names=["chain", "points", "endless"])

    chained = chains.merged(pieces).select("chain", "points", "endless")
    return materialise(chained.mapInArrow(run, f"chain long, points {rings.POINTS}, endless boolean"), "arcs")


def _spot(p: Column) -> Column:
    return F.struct(F.rint(p["x"] * rings.FINE).cast("long").alias("x"), F.rint(p["y"] * rings.FINE).cast("long").alias("y"))


def _held(hull: Column, x: Column, y: Column) -> Column:
    """Whether a spot lies in a convex hull or on it (counter-clockwise corners; two for a straight stretch)."""
    n = F.size(hull)

    def left(i: Column) -> Column:
        p, q = F.get(hull, i), F.get(hull, (i + 1) % n)
        return (q["x"] - p["x"]) * (y - p["y"]) - (q["y"] - p["y"]) * (x - p["x"]) >= -1e-7

    return F.forall(F.sequence(F.lit(0), n - 1), left)


def _broken(fits: DataFrame, corners: DataFrame, side: float) -> DataFrame:
    """(chain) of the arcs that break a rule."""
    own = fits.select("chain", "points", F.explode("spans").alias("s")).select("chain", F.col("s.hull").alias("hull"), F.transform(F.slice("points", F.col("s.a") + 1, F.col("s.b") - F.col("s.a") + 1), _spot).alias("own"))
    own = spatial._squares(own.withColumn("__b", spatial.bounds(F.array("hull"))), "__b", side)
    inside = (F.col("x") >= F.col("__b.minx")) & (F.col("x") <= F.col("__b.maxx")) & (F.col("y") >= F.col("__b.miny")) & (F.col("y") <= F.col("__b.maxy"))
    alien = ~F.array_contains("own", F.col("spot"))
    met = own.join(corners, ["__bx", "__by"]).filter(inside & alien & _held(F.col("hull"), F.col("x"), F.col("y"))).select("chain")
    n = F.size("line")
    steps = F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.array_sort(F.array(_spot(F.get("line", i)), _spot(F.get("line", i + 1)))))
    chords = fits.select("chain", (F.size("spans") > 0).alias("able"), F.explode(steps).alias("step"))
    twice = chords.groupBy("step").agg(F.count("*").alias("n")).filter("n > 1").select("step")
    return met.union(chords.filter("able").join(twice, "step", "left_semi").select("chain")).union(fits.filter("flat").select("chain")).distinct()


def fitted(lines: DataFrame, tolerance: float) -> DataFrame:
    """(chain, points, endless, tolerance, line, …): arcs with what is left of them, line, and the tolerance that was kept."""
    fits = materialise(lines.withColumn("tolerance", F.lit(float(tolerance))).mapInArrow(_fit, _FIT), "arc-fits")
    size = fits.select(F.explode("spans.hull").alias("h")).select(spatial.bounds(F.array("h")).alias("b")).agg(F.avg(F.greatest(F.col("b.maxx") - F.col("b.minx"), F.col("b.maxy") - F.col("b.miny")))).first()[0]
    side = float(max(size or 1.0, tolerance))
    corners = lines.select(F.explode("points").alias("p")).select("p.x", "p.y", _spot(F.col("p")).alias("spot")).dropDuplicates(["spot"])
    corners = materialise(spatial.dealt(corners).withColumns({"__bx": spatial._square(F.col("x"), side), "__by": spatial._square(F.col("y"), side)}), "arc-corners")
    while True:
        broken = materialise(_broken(fits, corners, side), "arcs-broken")
        if not broken.head(1):
            return fits
        less = F.when(F.col("tolerance") >= 2 * LEAST, F.col("tolerance") / 2).otherwise(0.0)
        again = fits.join(broken, "chain", "left_semi").select("chain", "points", "endless", less.alias("tolerance")).mapInArrow(_fit, _FIT)
        fits = materialise(fits.join(broken, "chain", "left_anti").unionByName(again), "arc-fits")


def simplified(shapes: DataFrame, tolerance: float, side: float | None = None) -> DataFrame:
    """(id, rings, area) of shapes (id, rings), ids being different whole numbers: no corner that goes is farther than the tolerance from what replaces it, and what was joined, apart or
    inside before is so after. A shape in several parts comes back as several rows; shapes without area do not come back."""
    own = materialise(shapes.select("id", "rings"), "coverage")
    lines = arcs(own, side)
    fits = fitted(lines, tolerance)
    a, b = F.get("points", 0), F.get("points", 1)
    long = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
    off = F.least(F.lit(BESIDE), long / 4) / long
    spot = lambda sign: F.struct(((a["x"] + b["x"]) / 2 - sign * (b["y"] - a["y"]) * off).alias("x"), ((a["y"] + b["y"]) / 2 + sign * (b["x"] - a["x"]) * off).alias("y"), F.lit(sign).alias("sign"))
    beside = fits.select("chain", F.explode(F.array(spot(1), spot(-1))).alias("s")).select(F.struct("chain", "s.sign").alias("id"), "s.x", "s.y")
    box = own.select(spatial.bounds(F.col("rings")).alias("b")).agg(F.avg(F.greatest(F.col("b.maxx") - F.col("b.minx"), F.col("b.maxy") - F.col("b.miny")))).first()[0]
    held = spatial.covering(beside, own.select(F.col("id").alias("poly"), "rings"), float(box or 1.0))
    ways = held.groupBy("id.chain", "poly").agg(F.sum("id.sign").alias("way")).filter("way <> 0")
    line = F.when(F.col("way") > 0, F.col("line")).otherwise(F.reverse("line"))
    steps = ways.join(fits.select("chain", "line").hint("merge"), "chain").select("poly", line.alias("line"))
    steps = steps.select("poly", F.explode(F.transform(F.sequence(F.lit(0), F.size("line") - 2), lambda i: F.struct(F.get("line", i).alias("p"), F.get("line", i + 1).alias("q")))).alias("s"))
    pieces = steps.select("poly", F.col("s.p.x").alias("x0"), F.col("s.p.y").alias("y0"), F.col("s.q.x").alias("x1"), F.col("s.q.y").alias("y1"))
    pieces = pieces.withColumns({"dx": F.col("x1") - F.col("x0"), "dy": F.col("y1") - F.col("y0")})
    return rings.nested(rings.stitched(pieces, "poly"), "poly").withColumnRenamed("poly", "id")
