"""Simplifying of shapes that share outlines: neighbours stay joined, and what is inside stays inside."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellplane.operators import chains, coverage, overlay, rings

SHAPES = "id long, rings array<array<struct<x:double,y:double>>>"


def test_closed_chain_keeps_its_joint(spark):
    """A loop of two lines on a point where a third line ends begins at that point; one that meets no line is endless."""
    rows = [(1, [(5.0, 5.0), (9.0, 5.0), (9.0, 9.0)]), (2, [(9.0, 9.0), (0.0, 9.0), (0.0, 0.0)]), (3, [(0.0, 0.0), (5.0, 5.0)]), (4, [(0.0, 0.0), (-5.0, 0.0)]), (5, [(20.0, 0.0), (21.0, 0.0), (21.0, 1.0)]), (6, [(21.0, 1.0), (20.0, 0.0)])]
    found = {r.chain: r for r in chains.merged(spark.createDataFrame(rows, "id long, points array<struct<x:double,y:double>>")).collect()}
    assert {k: (r.n_lines, r.endless) for k, r in found.items()} == {1: (3, False), 4: (1, False), 5: (2, True)}
    assert (found[1].points[0].x, found[1].points[0].y) == (0.0, 0.0) == (found[1].points[-1].x, found[1].points[-1].y)


@pytest.mark.parametrize("side", [None, 70.0])
def test_neighbours_stay_joined(spark, side):
    """A wavy line between two shapes, of which one touches a third along part of a side only."""
    rng = np.random.default_rng(3)
    wave = [(100.0 + float(rng.uniform(-6, 6)), float(y)) for y in np.linspace(0, 200, 41)]
    wave[0], wave[-1] = (100.0, 0.0), (100.0, 200.0)
    left, right = [(0.0, 0.0), *wave, (0.0, 200.0)], [(200.0, 0.0), (200.0, 200.0), *wave[::-1]]
    part = [(200.0, 50.0), (300.0, 50.0), (300.0, 120.0), (200.0, 120.0)]
    df = spark.createDataFrame([(1, [left]), (2, [right]), (3, [part]), (4, []), (5, None)], SHAPES)
    found = coverage.simplified(df, 8.0, side).cache()
    assert {r.id: len(r.rings[0]) for r in found.collect()} == {1: 4, 2: 4, 3: 4}
    assert {r.id: round(r.area, 6) for r in found.collect()} == {1: 20000.0, 2: 20000.0, 3: 7000.0}
    some = coverage.simplified(df, 3.0, side).cache()
    areas = {r.id: r.area for r in some.collect()}
    assert 4 < len(some.filter("id = 1").first().rings[0]) < len(left)
    whole = overlay.measures(overlay.united(some.select(F.lit(1).alias("g"), "rings"), "g"), "g").first().area
    assert abs(sum(areas.values()) - whole) < 1e-3 and abs(whole - 47000) < 1e-3 and areas[3] == 7000.0


def test_nothing_changes_sides(spark):
    """A small shape in a bay that would be cut off keeps the bay; a thin lens between two joints does not vanish; a small ring stays one."""
    bay = [(0.0, 0.0), (100.0, 0.0), (100.0, 40.0), (95.0, 50.0), (100.0, 60.0), (100.0, 100.0), (0.0, 100.0)]
    islet = [(97.0, 49.0), (99.0, 49.0), (99.0, 51.0), (97.0, 51.0)]
    lens = [(300.0, 0.0), (350.0, 5.0), (400.0, 0.0), (350.0, -5.0)]
    above = [(300.0, 0.0), (350.0, 5.0), (400.0, 0.0), (400.0, 80.0), (300.0, 80.0)]
    below = [(300.0, 0.0), (300.0, -80.0), (400.0, -80.0), (400.0, 0.0), (350.0, -5.0)]
    df = spark.createDataFrame([(1, [bay]), (2, [islet]), (3, [lens]), (4, [above]), (5, [below])], SHAPES)
    found = {r.id: r for r in coverage.simplified(df, 8.0).collect()}
    assert set(found) == {1, 2, 3, 4, 5}
    assert found[1].area == pytest.approx(9750) and found[3].area > 0  # the bay's tip stays, its two feet go
    pairs = overlay.combined(df.limit(0).unionByName(spark.createDataFrame([(1, found[1].rings)], SHAPES)), spark.createDataFrame([(1, found[2].rings)], SHAPES), "id")
    assert overlay.measures(pairs, "id").count() == 0
    assert sum(found[i].area for i in (3, 4, 5)) == pytest.approx(16000)


def test_holes_and_islands(spark):
    """A wavy hole filled by another shape: an endless arc between the two."""
    circle = [(50 + (20 + (k % 2)) * math.cos(2 * math.pi * k / 60), 50 + (20 + (k % 2)) * math.sin(2 * math.pi * k / 60)) for k in range(60)]
    square = [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (0.0, 100.0)]
    found = {}
    for n in (1, 5):
        df = spark.createDataFrame([(1, [square, circle]), (2, [circle])], SHAPES).repartition(n)
        found[n] = {r.id: ([len(q) for q in r.rings], round(r.area, 6)) for r in coverage.simplified(df, 3.0).collect()}
    assert found[1] == found[5] and sum(a for _, a in found[1].values()) == pytest.approx(10000)
    assert len(found[1][1][0]) == 2 and found[1][1][0][1] == found[1][2][0][0] < 20


def test_random_faces_stay_a_coverage(spark):
    """Regions of labelled cells with jagged borders, at several tolerances."""
    rng = np.random.default_rng(8)
    seeds = rng.uniform(0, 24, (9, 2))
    cells = [(int(np.argmin(((seeds - (r + 0.5, c + 0.5)) ** 2).sum(1) + rng.uniform(0, 20, 9))), r, c) for r in range(24) for c in range(24)]
    df = spark.createDataFrame([(k + 1, [[(c * 10.0, r * 10.0), (c * 10.0 + 10, r * 10.0), (c * 10.0 + 10, r * 10.0 + 10), (c * 10.0, r * 10.0 + 10)]]) for k, r, c in cells], SHAPES)
    united = overlay.united(df.withColumnRenamed("id", "g"), "g")
    whole = rings.nested(rings.stitched(united, "g"), "g").withColumn("part", F.monotonically_increasing_id()).select(F.col("part").alias("id"), "rings", "area").cache()
    n = whole.count()
    for tolerance in (4.0, 12.0):
        found = coverage.simplified(whole, tolerance).cache()
        total = found.agg(F.sum("area")).first()[0]
        union = overlay.measures(overlay.united(found.select(F.lit(1).alias("g"), "rings"), "g"), "g").first().area
        assert found.select("id").distinct().count() == n
        assert abs(total - union) < 1e-2
        outer = whole.agg(F.sum("area")).first()[0]
        assert tolerance > 4 or abs(total - outer) < 1e-2


def test_empty(spark):
    assert coverage.simplified(spark.createDataFrame([], SHAPES), 8.0).count() == 0


def test_halves_of_a_micrometre(spark):
    """Joints half way between two micrometres are told apart alike in plans and in NumPy: the chain is whole, and so is a ring."""
    y = 2.5e-6
    rows = [(1, [(1.0, y), (0.0, 5.0)]), (2, [(1.0, y), (2.0, 0.0)]), (3, [(2.0, 0.0), (3.0, 1.0)])]
    found = chains.merged(spark.createDataFrame(rows, "id long, points array<struct<x:double,y:double>>")).collect()
    assert [(r.chain, r.n_lines, len(r.points)) for r in found] == [(1, 3, 4)]
    ring = [(0.5 - y, 0.0), (1.0, 0.0), (1.0, 1.0), (0.5 - y, 1.0)]
    steps = [(1, *p, *q, q[0] - p[0], q[1] - p[1]) for p, q in zip(ring, ring[1:] + ring[:1], strict=True)]
    pieces = spark.createDataFrame(steps, "g long, x0 double, y0 double, x1 double, y1 double, dx double, dy double")
    assert [round(r.area, 3) for r in rings.stitched(pieces, "g", 0.5).collect()] == [0.5]


def test_edges_both_ways_meet_a_line_alike():
    """A shared edge comes once each way round; tiles may keep either."""
    rng = np.random.default_rng(5)
    e = rng.uniform(0, 1e6, (1000, 4)).round(2)
    for axis in (0, 1):
        line = (e[:, axis] + e[:, 2 + axis]) / 3 + 0.1
        assert (overlay._cross(e, line, axis) == overlay._cross(e[:, [2, 3, 0, 1]], line, axis)).all()
