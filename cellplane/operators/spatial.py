"""Joins by place: points near points, points in polygons, overlapping boxes and shapes.

All are equality joins on the squares of a helper grid, followed by the exact test. Polygons are `rings`: an array of rings, each an array of
structs (x, y), closed or not; the even-odd rule says what is inside.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellplane.scratch import materialise


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df by hash of keys (in turn without keys) over as many partitions as the session has for shuffles. Tables that are small as files but long to work on would else stay in a few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _square(c: Column, side: float) -> Column:
    return F.floor(c / side).cast("long")


def _around(df: DataFrame, side: float) -> DataFrame:
    """Each row once for each of the nine squares at its point."""
    near = F.sequence(F.lit(-1), F.lit(1))
    out = df.withColumn("__dx", F.explode(near)).withColumn("__dy", F.explode(near))
    return out.withColumns({"__bx": _square(F.col("x"), side) + F.col("__dx"), "__by": _square(F.col("y"), side) + F.col("__dy")}).drop("__dx", "__dy")


def _others(right: DataFrame, radius: float) -> DataFrame:
    """(other, ox, oy) with their squares."""
    own = right.select(F.col("id").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    return own.withColumns({"__bx": _square(F.col("ox"), radius), "__by": _square(F.col("oy"), radius)})


def near_pairs(left: DataFrame, right: DataFrame, radius: float, exclusive: bool) -> DataFrame:
    """(id, x, y) of both sides: (id, other, distance) of all pairs nearer than radius (or as near, if not exclusive)."""
    left, right = dealt(_around(left.select("id", "x", "y"), radius), "__bx", "__by"), dealt(_others(right, radius), "__bx", "__by")
    d = F.hypot(F.col("x").cast("double") - F.col("ox"), F.col("y").cast("double") - F.col("oy"))
    out = left.join(right.hint("merge"), ["__bx", "__by"]).withColumn("distance", d)
    return out.filter(F.col("distance") < radius if exclusive else F.col("distance") <= radius).select("id", "other", "distance")


#: Points of a square, as a point sees it on average, above which a search begins with a smaller radius.
CROWD = 16


def halvings(points: DataFrame, radius: float) -> int:
    """How often a search radius is to be halved until squares of that side are no longer crowded."""
    n = points.groupBy(_square(F.col("x"), radius), _square(F.col("y"), radius)).agg(F.count("*").cast("double").alias("n"))
    crowd = n.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0]
    return min(20, max(0, math.ceil(math.log2(max(crowd or 0.0, 1.0) / CROWD) / 2)))


def nearest_within(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """Each left id with its nearest right id nearer than radius, else null; ties to the least id.

    Where squares are crowded the search begins with a smaller radius, which doubles for those not served: what is found within a radius is nearer
    than all beyond it.
    """
    spots = materialise(right.groupBy("x", "y").agg(F.min("id").alias("id")), "near-spots")
    halves = halvings(spots, radius)
    rest, found = left.select("id", "x", "y"), None
    for step in range(halves, -1, -1):
        best = near_pairs(rest, spots, radius / 2**step, True).groupBy("id").agg(F.min(F.struct("distance", "other")).alias("b"))
        if step:
            best = materialise(best, "near-served")
            rest = materialise(rest.join(best.hint("merge"), "id", "left_anti"), "near-rest")
        found = best if found is None else found.unionByName(best)
    return left.select("id").join(found, "id", "left").select("id", F.col("b.other").alias("nearest"), F.col("b.distance").alias("distance"))


def any_within(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """Left rows with a right point nearer than radius. A right point in the same square settles a point, as the square's diagonal is less than the radius; for the
    others it is a semi join over the squares around, and no pairs come out."""
    side = radius / math.sqrt(2) * (1 - 1e-6)
    own = left.select("id", "x", "y").withColumns({"__bx": _square(F.col("x"), side), "__by": _square(F.col("y"), side)})
    spots = right.select("id", "x", "y").groupBy("x", "y").agg(F.min("id").alias("id"))
    full = spots.select(_square(F.col("x"), side).alias("__bx"), _square(F.col("y"), side).alias("__by")).distinct()
    sure = own.join(full, ["__bx", "__by"], "left_semi").select("id")
    at = dealt(_around(own.join(full, ["__bx", "__by"], "left_anti").select("id", "x", "y"), radius), "__bx", "__by")
    other = dealt(_others(spots, radius).withColumnsRenamed({"__bx": "__ox", "__by": "__oy"}), "__ox", "__oy")
    near = F.hypot(F.col("x").cast("double") - F.col("ox"), F.col("y").cast("double") - F.col("oy")) < radius
    hit = at.join(other.hint("merge"), (F.col("__bx") == F.col("__ox")) & (F.col("__by") == F.col("__oy")) & near, "left_semi").select("id")
    return left.join(sure.unionByName(hit).distinct(), "id", "left_semi")


def pairs_within(points: DataFrame, eps: float) -> DataFrame:
    """(a, b, distance) with a < b and a distance of at most eps."""
    return near_pairs(points, points, eps, False).filter("id < other").select(F.col("id").alias("a"), F.col("other").alias("b"), "distance")


def bounds(rings: Column) -> Column:
    pts = F.flatten(rings)
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def ring_area2(ring: Column) -> Column:
    """Twice the signed area by the shoelace formula."""
    n = F.size(ring)
    step = lambda i: F.get(ring, i)["x"] * F.get(ring, (i + 1) % n)["y"] - F.get(ring, (i + 1) % n)["x"] * F.get(ring, i)["y"]
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), step), F.lit(0.0), lambda a, v: a + v.cast("double"))


def area(rings: Column) -> Column:
    """Area of the first ring less the others'."""
    each = F.transform(rings, lambda r: F.abs(ring_area2(r)) / 2)
    return F.greatest(F.lit(0.0), 2 * F.get(each, 0) - F.aggregate(each, F.lit(0.0), lambda a, v: a + v))


def length(points: Column) -> Column:
    n = F.size(points)
    step = lambda i: F.hypot(F.get(points, i + 1)["x"] - F.get(points, i)["x"], F.get(points, i + 1)["y"] - F.get(points, i)["y"])
    return F.when(n > 1, F.aggregate(F.transform(F.sequence(F.lit(0), n - 2), step), F.lit(0.0), lambda a, v: a + v)).otherwise(F.lit(0.0))


def centroid(ring: Column) -> Column:
    """Centre of gravity of a ring; the mean of its points if it has no area."""
    n, a2 = F.size(ring), ring_area2(ring)
    cross = lambda i: F.get(ring, i)["x"] * F.get(ring, (i + 1) % n)["y"] - F.get(ring, (i + 1) % n)["x"] * F.get(ring, i)["y"]
    total = lambda axis: F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), lambda i: (F.get(ring, i)[axis] + F.get(ring, (i + 1) % n)[axis]) * cross(i)), F.lit(0.0), lambda a, v: a + v)
    mean = lambda axis: F.aggregate(ring, F.lit(0.0), lambda a, p: a + p[axis]) / n
    return F.struct(F.when(a2 == 0, mean("x")).otherwise(total("x") / (3 * a2)).alias("x"), F.when(a2 == 0, mean("y")).otherwise(total("y") / (3 * a2)).alias("y"))


def inside(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd rule, edges half open."""
    def crossings(ring: Column) -> Column:
        n = F.size(ring)

        def crosses(i: Column) -> Column:
            p, q = F.get(ring, i), F.get(ring, (i + 1) % n)
            at = p["x"] + (y - p["y"]) * (q["x"] - p["x"]) / F.nullif(q["y"] - p["y"], F.lit(0.0))
            return F.when(((p["y"] > y) != (q["y"] > y)) & (x < at), 1).otherwise(0)

        return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), crosses), F.lit(0), lambda a, v: a + v)

    return F.aggregate(F.transform(rings, crossings), F.lit(0), lambda a, v: a + v) % 2 == 1


def _squares(df: DataFrame, box: str, side: float) -> DataFrame:
    """Each row once for each helper square that its box meets."""
    out = df.withColumn("__bx", F.explode(F.sequence(_square(F.col(f"{box}.minx"), side), _square(F.col(f"{box}.maxx"), side))))
    return out.withColumn("__by", F.explode(F.sequence(_square(F.col(f"{box}.miny"), side), _square(F.col(f"{box}.maxy"), side))))


def tiled(polygons: DataFrame, side: float) -> DataFrame:
    """Each polygon once for each helper square that its box meets."""
    return _squares(polygons.withColumn("__b", bounds(F.col("rings"))), "__b", side).drop("__b")


#: A box is laid on helper squares of so many parts of the side for polygons: rows grow with the parts, tests shrink.
BOX_PARTS = 8


def _is_box(rings: Column) -> Column:
    """Whether a shape is one rectangle along the axes. For those the even-odd rule is minx <= x < maxx and miny <= y < maxy."""
    ring = F.get(rings, 0)
    level = lambda i, axis: F.get(ring, i)[axis] == F.get(ring, (i + 1) % 4)[axis]
    way = lambda first, then: level(0, first) & level(1, then) & level(2, first) & level(3, then)
    four = (F.size(ring) == 4) | ((F.size(ring) == 5) & (F.get(ring, 0) == F.get(ring, 4)))
    return F.coalesce((F.size(rings) == 1) & four & (way("y", "x") | way("x", "y")), F.lit(False))


def _boxes(polygons: DataFrame, side: float, *more: str) -> DataFrame:
    """(poly, more, minx, miny, maxx, maxy, __bx, __by, full) of the polygons that are boxes, once for each helper square; full: all of the square lies in the box."""
    own = dealt(polygons, "poly").filter(_is_box(F.col("rings"))).select("poly", *more, bounds(F.col("rings")).alias("b")).select("poly", *more, "b.*")
    out = own.withColumn("__bx", F.explode(F.sequence(_square(F.col("minx"), side), _square(F.col("maxx"), side))))
    out = out.withColumn("__by", F.explode(F.sequence(_square(F.col("miny"), side), _square(F.col("maxy"), side))))
    off = side * 1e-6  # squares are told by division, which rounds
    spans = lambda lo, hi, k: (F.col(lo) <= F.col(k) * side - off) & (F.col(hi) >= (F.col(k) + 1) * side + off)
    return out.withColumn("full", spans("minx", "maxx", "__bx") & spans("miny", "maxy", "__by"))


_IN_BOX = "x >= minx and x < maxx and y >= miny and y < maxy"


def _squared(points: DataFrame, side: float) -> DataFrame:
    return points.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).withColumns({"__bx": _square(F.col("x"), side), "__by": _square(F.col("y"), side)})


def _in_rings(points: DataFrame, polygons: DataFrame, side: float) -> DataFrame:
    """(id, poly) of the polygons that are no boxes."""
    shapes = tiled(polygons.select("poly", "rings").filter(~_is_box(F.col("rings"))), side)
    return _squared(points, side).join(shapes.hint("merge"), ["__bx", "__by"]).filter(inside(F.col("x"), F.col("y"), F.col("rings"))).select("id", "poly")


def covering(points: DataFrame, polygons: DataFrame, side: float) -> DataFrame:
    """(id, poly) for each point (id, x, y) in each polygon (poly, rings); side is about a polygon's size. Boxes go by four comparisons, without their rings."""
    fine = side / BOX_PARTS
    at, boxes = dealt(_squared(points, fine), "__bx", "__by"), dealt(_boxes(polygons, fine).drop("full"), "__bx", "__by")
    return at.join(boxes.hint("merge"), ["__bx", "__by"]).filter(_IN_BOX).select("id", "poly").unionByName(_in_rings(points, polygons, side))


def holding(points: DataFrame, polygons: DataFrame, side: float) -> DataFrame:
    """(poly) of the polygons with a point inside. A square that lies in a box settles it by any point; else the first point found does. No pairs of boxes come out."""
    fine = side / BOX_PARTS
    at, boxes = _squared(points, fine), _boxes(polygons, fine)
    sure = boxes.filter("full").join(at.select("__bx", "__by").distinct(), ["__bx", "__by"], "left_semi").select("poly").distinct()
    left = dealt(boxes.filter("not full").join(sure.hint("merge"), "poly", "left_anti"), "__bx", "__by")
    other = dealt(at.select("x", "y", F.col("__bx").alias("__px"), F.col("__by").alias("__py")).distinct(), "__px", "__py")
    hit = left.join(other.hint("merge"), (F.col("__bx") == F.col("__px")) & (F.col("__by") == F.col("__py")) & F.expr(_IN_BOX), "left_semi").select("poly").distinct()
    return sure.unionByName(hit).unionByName(_in_rings(points, polygons, side).select("poly").distinct())


def smallest_cover(points: DataFrame, polygons: DataFrame, side: float) -> DataFrame:
    """The polygon of least area over each point, ties to the least poly.

    The least box that holds all of a square bounds the answer for the points there: only boxes before it are tested, however many lie over it.
    """
    fine = side / BOX_PARTS
    at = dealt(_squared(points, fine), "__bx", "__by")
    sized = polygons.select("poly", "rings", area(F.col("rings")).alias("area"))
    boxes = _boxes(sized, fine, "area").withColumn("s", F.struct("area", "poly"))
    least = boxes.filter("full").groupBy("__bx", "__by").agg(F.min("s").alias("most"))
    part = boxes.filter("not full").join(least.hint("merge"), ["__bx", "__by"], "left").filter("most is null or s < most")
    tried = at.join(dealt(part.drop("most", "full"), "__bx", "__by").hint("merge"), ["__bx", "__by"]).filter(_IN_BOX).select("id", "area", "poly")
    bound = at.join(least.hint("merge"), ["__bx", "__by"]).select("id", "most.area", "most.poly")
    rest = _in_rings(points, polygons, side).join(sized.select("poly", "area"), "poly").select("id", "area", "poly")
    best = tried.unionByName(bound).unionByName(rest).groupBy("id").agg(F.min(F.struct("area", "poly")).alias("b"))
    return best.select("id", "b.poly", "b.area")


def near_shapes(a: DataFrame, b: DataFrame, side: float) -> DataFrame:
    """(poly, other) of shapes whose boxes meet. a, b: (poly, rings). Only ids and boxes meet in the squares."""
    box = lambda df, key, name: df.select(F.col("poly").alias(key), bounds(F.col("rings")).alias(name))
    left, right = _squares(box(a, "poly", "p"), "p", side), _squares(box(b, "other", "q"), "q", side)
    meet = (F.col("p.minx") <= F.col("q.maxx")) & (F.col("q.minx") <= F.col("p.maxx")) & (F.col("p.miny") <= F.col("q.maxy")) & (F.col("q.miny") <= F.col("p.maxy"))
    return left.join(right, ["__bx", "__by"]).filter(meet).select("poly", "other").distinct()


def overlapping(a: DataFrame, b: DataFrame, side: float) -> DataFrame:
    """(poly, other) of shapes whose outlines cross or of which one holds a corner of the other. a, b: (poly, rings). The rings are fetched once for each pair of boxes that meet."""
    pairs = near_shapes(a, b, side).join(a.select("poly", "rings"), "poly").join(b.select(F.col("poly").alias("other"), F.col("rings").alias("rings2")), "other")
    first = lambda rings: F.get(F.get(rings, 0), 0)
    one, two = F.col("rings"), F.col("rings2")
    hit = inside(first(two)["x"], first(two)["y"], one) | inside(first(one)["x"], first(one)["y"], two) | F.exists(edges(one), lambda e: F.exists(edges(two), lambda f: crossing(e, f)))
    return pairs.filter(hit).select("poly", "other")


def meeting(a: DataFrame, b: DataFrame, side: float) -> DataFrame:
    """(poly) of the shapes of a that overlap one of b, both (poly, rings). Of boxes no pairs come out: a square that lies in a box settles it by any box there; else the first found does."""
    fine = side / BOX_PARTS
    left = _boxes(a, fine)
    right = _boxes(b, fine).select("minx", "miny", "maxx", "maxy", "__bx", "__by").distinct()
    sure = left.filter("full").join(right.select("__bx", "__by").distinct(), ["__bx", "__by"], "left_semi").select("poly").distinct()
    rest = dealt(left.filter("not full").join(sure.hint("merge"), "poly", "left_anti"), "__bx", "__by")
    other = dealt(right.select(*[F.col(c).alias(f"q{c}") for c in right.columns]), "q__bx", "q__by")
    met = F.expr("__bx = q__bx and __by = q__by and minx <= qmaxx and qminx <= maxx and miny <= qmaxy and qminy <= maxy")
    hit = rest.join(other.hint("merge"), met, "left_semi").select("poly")
    box = _is_box(F.col("rings"))
    pairs = overlapping(a.filter(~box), b, side).unionByName(overlapping(a.filter(box), b.filter(~box), side))
    return sure.unionByName(hit).unionByName(pairs.select("poly")).distinct()


def edges(rings: Column) -> Column:
    def of(ring: Column) -> Column:
        n = F.size(ring)
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(ring, i).alias("p"), F.get(ring, (i + 1) % n).alias("q")))

    return F.flatten(F.transform(rings, of))


def crossing(e: Column, f: Column) -> Column:
    """Whether two closed segments have a point in common."""
    turn = lambda a, b, c: F.signum((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]))
    p, q, r, s = e["p"], e["q"], f["p"], f["q"]
    o1, o2, o3, o4 = turn(p, q, r), turn(p, q, s), turn(r, s, p), turn(r, s, q)
    on = lambda a, b, c: (c["x"] >= F.least(a["x"], b["x"])) & (c["x"] <= F.greatest(a["x"], b["x"])) & (c["y"] >= F.least(a["y"], b["y"])) & (c["y"] <= F.greatest(a["y"], b["y"]))
    return ((o1 != o2) & (o3 != o4)) | ((o1 == 0) & on(p, q, r)) | ((o2 == 0) & on(p, q, s)) | ((o3 == 0) & on(r, s, p)) | ((o4 == 0) & on(r, s, q))


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1)))


def corridor(x: Column, y: Column, heading: Column, length_m: float = 5000.0, half_angle_deg: float = 15.0, arc: int = 13) -> Column:
    """A wedge: the apex and so many points of its arc."""
    from math import radians

    half = radians(half_angle_deg)
    at = lambda i: heading - half + i * (2 * half / (arc - 1))
    tip = F.array(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    rim = F.transform(F.sequence(F.lit(0), F.lit(arc - 1)), lambda i: F.struct((x + length_m * F.cos(at(i))).alias("x"), (y + length_m * F.sin(at(i))).alias("y")))
    return F.array(F.concat(tip, rim))


def bezier(points: Column, steps: int = 8) -> Column:
    """Points of a cubic curve after its start; points: its four control points."""
    def at(i: Column) -> Column:
        t = i / F.lit(float(steps))
        u = 1 - t
        mix = lambda axis: u * u * u * F.get(points, 0)[axis] + 3 * u * u * t * F.get(points, 1)[axis] + 3 * u * t * t * F.get(points, 2)[axis] + t * t * t * F.get(points, 3)[axis]
        return F.struct(mix("x").alias("x"), mix("y").alias("y"))

    return F.transform(F.sequence(F.lit(1), F.lit(steps)), at)


def affine(points: Column, m: tuple[float, float, float, float, float, float]) -> Column:
    a, b, c, d, e, f = m
    return F.transform(points, lambda p: F.struct((a * p["x"] + b * p["y"] + c).alias("x"), (d * p["x"] + e * p["y"] + f).alias("y")))
