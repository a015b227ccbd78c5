"""Planar overlay, stitched rings, faces and buffers against sampling, closed formulas and plain kernels, for all tile sides."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.operators import outlines, overlay, rings

SHAPES = "g int, rings array<array<struct<x:double,y:double>>>"


def ring(rng, corners, at, r):
    a = np.sort(rng.uniform(0, 2 * np.pi, corners))
    return [(float(at[0] + r * np.cos(t)), float(at[1] + r * np.sin(t))) for t in a]


@pytest.fixture(scope="module")
def shapes(spark):
    rng = np.random.default_rng(1)
    rows = [(i % 3, [ring(rng, int(rng.integers(3, 9)), rng.uniform(0, 1000, 2), rng.uniform(20, 200))]) for i in range(120)]
    return rows, spark.createDataFrame(rows, SHAPES).cache()


def inside(gx, gy, rings_):
    out = np.zeros(gx.shape, bool)
    for r in rings_:
        p = np.array(r)
        for (xa, ya), (xb, yb) in zip(p, np.roll(p, -1, 0), strict=True):
            with np.errstate(divide="ignore", invalid="ignore"):
                out ^= ((ya > gy) != (yb > gy)) & (gx < xa + (gy - ya) * (xb - xa) / (yb - ya))
    return out


def test_union_by_sampling_and_sides(spark, shapes):
    rows, df = shapes
    found = [{r.g: (round(r.area, 2), round(r.perimeter, 3)) for r in overlay.measures(overlay.united(df, "g", side), "g").collect()} for side in (None, 77.7, 333.0, 5000.0)]
    assert all(f == found[0] for f in found)
    n = 1000
    gx, gy = np.meshgrid((np.arange(n) + 0.5) * 1500 / n - 250, (np.arange(n) + 0.5) * 1500 / n - 250)
    for g in range(3):
        mask = np.zeros(gx.shape, bool)
        for k, r in rows:
            if k == g:
                mask |= inside(gx, gy, r)
        assert abs(mask.sum() * (1500 / n) ** 2 / found[0][g][0] - 1) < 1e-3


def test_layers_add_up(spark, shapes):
    _, df = shapes
    a, b = (df.filter(f"g = {k}").select(F.lit(1).alias("k"), "rings") for k in (0, 1))
    area = lambda pieces: overlay.measures(pieces, "k").first().area
    assert abs(area(overlay.combined(a, b, "k")) + area(overlay.combined(a, b, "k", overlay.only_first, 150.0)) - area(overlay.united(a, "k"))) < 1e-2


def test_rings_hold_the_area(spark, shapes):
    _, df = shapes
    pieces = overlay.united(df, "g", 200.0).cache()
    want = {r.g: r.area for r in overlay.measures(pieces, "g").collect()}
    seen = []
    for side in (None, 90.0, 4000.0):
        found = rings.stitched(pieces, "g", side).cache()
        assert all(abs(r.a - want[r.g]) < 1e-4 for r in found.groupBy("g").agg(F.sum("area").alias("a")).collect())
        seen.append(sorted((r.g, len(r.points), round(r.area, 2)) for r in found.collect()))
        whole = rings.nested(found, "g").collect()
        assert len(whole) == sum(1 for s in seen[-1] if s[2] > 0) and abs(sum(r.area for r in whole) - sum(want.values())) < 1e-3
        assert sum(len(r.rings) - 1 for r in whole) == sum(1 for s in seen[-1] if s[2] < 0)
    assert seen[0] == seen[1] == seen[2]


def test_repair(spark):
    square = lambda lo, hi: [(lo, lo), (hi, lo), (hi, hi), (lo, hi)]
    rows = [
        (1, [[(0.0, 0.0), (10.0, 10.0), (10.0, 0.0), (0.0, 10.0)]]),  # a bow-tie
        (2, [square(0.0, 4.0), square(2.0, 6.0)]),  # overlapping rings: what both cover is out
        (3, [square(0.0, 9.0), square(3.0, 6.0)]),
        (4, [square(0.0, 9.0) + [(0.0, 0.0)], [(1.0, 1.0)]]),  # closed, and a ring that is none
        (5, []),
        (6, None),
    ]
    found = {r.g: (round(r.area, 6), round(r.perimeter, 6)) for r in overlay.measures(overlay.repaired(spark.createDataFrame(rows, SHAPES), "g"), "g").collect()}
    assert found == {1: (50.0, round(20 + 4 * math.sqrt(50), 6)), 2: (24.0, 32.0), 3: (72.0, 48.0), 4: (81.0, 36.0)}


@pytest.mark.parametrize("side", [None, 37.0, 1000.0])
def test_faces(spark, side):
    lines = [[(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (0.0, 100.0), (0.0, 0.0)], [(100.0, 50.0), (60.0, 50.0), (60.0, 70.0)], [(20.0, 20.0), (30.0, 20.0), (30.0, 30.0), (20.0, 30.0), (20.0, 20.0)], [(-50.0, 40.0), (50.0, 40.0)], [(10.0, 80.0), (15.0, 85.0)]]
    found = rings.faces(spark.createDataFrame([(1, lines)], SHAPES), "g", side).collect()
    assert sorted((r.area, [len(q) for q in r.rings]) for r in found) == [(100.0, [4]), (9900.0, [4, 4])]  # an island, and ways that lead nowhere


def test_faces_of_random_lines(spark):
    rng = np.random.default_rng(4)
    lines = [[tuple(map(float, rng.uniform(0, 500, 2))) for _ in range(3)] for _ in range(40)]
    segments = np.concatenate([np.stack([np.array(r)[:-1], np.array(r)[1:]], axis=1) for r in lines])
    plain = [abs(outlines.signed_area(f)) for f in outlines.faces(segments)]
    for side in (None, 60.0):
        found = [r.area for r in rings.faces(spark.createDataFrame([(1, lines)], SHAPES), "g", side).collect()]
        assert len(found) == len(plain) and abs(sum(found) - sum(plain)) < 1e-3


def test_buffers(spark):
    rows = [(1, "polygon", [[(0.0, 0.0), (100.0, 0.0), (100.0, 50.0), (0.0, 50.0)]]), (2, "line", [[(0.0, 0.0), (30.0, 40.0)]]), (3, "point", [[(5.0, 5.0)]]), (4, "polygon", [[(0.0, 0.0), (60.0, 0.0), (60.0, 60.0), (0.0, 60.0)], [(20.0, 20.0), (40.0, 20.0), (40.0, 40.0), (20.0, 40.0)]])]
    df = spark.createDataFrame(rows, "g int, kind string, rings array<array<struct<x:double,y:double>>>")
    disc = lambda r: 0.5 * 32 * r * r * math.sin(math.pi / 16)
    found = {r.g: r.area for r in overlay.measures(overlay.buffered(df, "g", 10.0), "g").collect()}
    want = {1: 5000 + 20 * 150 + disc(10), 2: 1000 + disc(10), 3: disc(10), 4: 3600 + 20 * 120 + disc(10)}
    assert all(abs(found[g] - want[g]) < 1e-3 for g in want)
    by_row = {r.g: r.area for r in overlay.measures(overlay.buffered(df, "g", F.col("g") * 2.0), "g").collect()}
    assert abs(by_row[3] - disc(6)) < 1e-3 and abs(by_row[4] - (3600 + 16 * 120 + disc(8) - 16)) < 1e-3


def test_outlines_of_labels(spark):
    grid = GridSpec(20, 20, 10.0, 100.0, 500.0)
    runs = [(0, 0, 2, 1), (1, 0, 0, 1), (1, 2, 2, 1), (2, 0, 2, 1), (3, 3, 4, 1), (10, 5, 5, 2)]  # a ring of cells, two cells that touch it in a corner, one cell
    found = rings.outlines(spark.createDataFrame(runs, "row int, c0 int, c1 int, label long"), grid, 35.0).collect()
    got = sorted((r.label, round(r.area, 6), len(r.points)) for r in found)
    assert got == [(1, -100.0, 4), (1, 200.0, 4), (1, 900.0, 4), (2, 100.0, 4)]
    assert sorted((p.x, p.y) for r in found if r.label == 2 for p in r.points) == [(150.0, 390.0), (150.0, 400.0), (160.0, 390.0), (160.0, 400.0)]


def test_empty(spark):
    none = spark.createDataFrame([], SHAPES)
    assert overlay.measures(overlay.united(none, "g"), "g").count() == 0
    assert rings.faces(none, "g").count() == 0 and rings.nested(rings.stitched(overlay.united(none, "g"), "g"), "g").count() == 0
