"""Overlay of crowded shapes: areas by depth, numbers of faces, and outlines, against a raster of cells and against faces made one by one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellplane.operators import overlay, rings

SHAPES = "g long, rings array<array<struct<x:double,y:double>>>"


def crowd(n, extent=40, seed=4):
    rng = np.random.default_rng(seed)
    return [(int(x), int(y), int(x + w), int(y + h)) for x, y, w, h in rng.integers([0, 0, 1, 1], [extent, extent, 25, 25], (n, 4))]


def ring(a, b, c, d):
    return [{"x": float(x), "y": float(y)} for x, y in ((a, b), (c, b), (c, d), (a, d))]


def cells(made, size=70):
    out = np.zeros((size, size), dtype=int)
    for a, b, c, d in made:
        out[a:c, b:d] += 1
    return out


@pytest.mark.parametrize("side", [None, 9.0, 1000.0])
def test_areas_by_depth(spark, side):
    made = {g: crowd(n, seed=g) for g, n in ((1, 300), (2, 5), (3, 1))}
    df = spark.createDataFrame([(g, [ring(*b)]) for g, some in made.items() for b in some], SHAPES)
    got = {(r.g, r.depth): round(r.area, 6) for r in overlay.depths(df, "g", side).collect()}
    assert got == {(g, int(k)): float(n) for g, some in made.items() for k, n in zip(*np.unique(cells(some), return_counts=True), strict=True) if k}


@pytest.mark.parametrize("side", [None, 9.0])
def test_number_of_faces(spark, side):
    """Faces are counted as they are when each is made: crowded boxes, islands in them, parts apart, lines that lead nowhere."""
    apart = [(100, 100, 110, 110), (102, 102, 104, 104), (200, 0, 201, 1)]
    lines = {1: [ring(*b) for b in crowd(60) + apart], 2: [ring(*b) for b in apart], 3: [ring(0, 0, 9, 9)[:2]]}
    closed = {g: [r + r[:1] if len(r) > 2 else r for r in some] for g, some in lines.items()}
    df = spark.createDataFrame([(g, [r]) for g, some in closed.items() for r in some], SHAPES)
    one_by_one = {r.g: r.n for r in rings.faces(df, "g", side).groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert {r.g: r.faces for r in overlay.face_counts(df, "g", side).collect() if r.faces} == one_by_one and one_by_one[2] == 3


def test_union_of_a_crowd(spark):
    made = crowd(400)
    df = spark.createDataFrame([(1, [ring(*b)]) for b in made], SHAPES)
    got = overlay.measures(overlay.united(df, "g", 16.0), "g").first()
    on = np.pad(cells(made) > 0, 1)
    sides = sum(int((on[1:] != on[:-1]).sum()) if axis == 0 else int((on[:, 1:] != on[:, :-1]).sum()) for axis in (0, 1))
    assert round(got.area, 6) == on.sum() and round(got.perimeter, 6) == sides


def test_tiles_deep_inside_are_not_looked_at():
    """Where winding numbers exceed the edges about, no edges are cut."""
    x = np.linspace(1, 9, 500)
    e = np.stack([x, np.full(500, -5.0), x, np.full(500, 15.0)], axis=1)
    box, none = np.array([[0.0, 0.0, 10.0, 10.0]]), np.zeros(500, dtype=int)
    leaves = lambda w, rule: list(overlay._quartered(e, none, none, box, np.array([[w]]), rule))
    assert not leaves(1500, overlay.covered) and leaves(400, overlay.covered) and leaves(1500, None)


def test_shapes_widened_by_themselves(spark):
    """Boxes and single steps alone in their group come out as if they were united with the capsules of their sides."""
    line = [{"x": 3.0, "y": 4.0}, {"x": 60.0, "y": 31.0}]
    rows = [(1, "polygon", [ring(0, 0, 50, 20)]), (2, "polygon", [ring(5, 5, 30, 90)[::-1]]), (3, "line", [line]), (4, "polygon", [ring(0, 0, 9, 9)]), (4, "line", [line]), (5, "polygon", [ring(1, 1, 1, 7)])]
    df = spark.createDataFrame(rows, "g long, kind string, rings array<array<struct<x:double,y:double>>>")
    pieces = overlay.buffered(df, "g", 30.0, 8, 4096.0)
    got = {r.g: (r.area, r.perimeter) for r in overlay.measures(pieces, "g").collect()}
    want = {r.g: (r.area, r.perimeter) for r in overlay.measures(overlay._widened(df.withColumn("__r", F.lit(30.0)), ["g"], 8, 4096.0), "g").collect()}
    assert set(got) == set(want) == {1, 2, 3, 4, 5}
    assert all(np.allclose(got[g], want[g], rtol=0, atol=1e-5) for g in got)
    assert pieces.filter("g = 1").count() == 4 * 9


def test_repeated_lines_are_counted_once(spark, monkeypatch):
    """Boxes drawn over and over, either way round, add no face, and their lines are laid on tiles once."""
    seen = []
    tiled = overlay._tiled
    monkeypatch.setattr(overlay, "_tiled", lambda edges, *rest: seen.append(edges.count()) or tiled(edges, *rest))
    closed = [r + r[:1] for r in (ring(*b) for b in crowd(40))]
    for copies in (1, 30):
        df = spark.createDataFrame([(1, [r if i % 2 else r[::-1]]) for i in range(copies) for r in closed], SHAPES)
        seen.append(overlay.face_counts(df, "g").first().faces)
    assert seen[:2] == seen[2:]


@pytest.mark.parametrize("rule", ["both", "only_first"])
def test_rows_are_overlaid_by_themselves(spark, rule):
    """Areas and perimeters of each row's own shapes are those of a group of its own: regions with holes, crowded rings, rings that close, shapes apart, nothing there."""
    region = [ring(5, 5, 60, 60), ring(10, 10, 40, 30), ring(12, 12, 14, 14)]
    star = [{"x": 30 + 25 * float(np.cos(2.4 * k)), "y": 30 + 25 * float(np.sin(2.4 * k))} for k in range(5)]
    spike = [{"x": 20.0 + (k % 2) * 20, "y": 3.0 + k / 3} for k in range(90)] + [{"x": 18.0, "y": 33.0}]
    a = [[ring(*b)] for b in crowd(20)] + [[star], [star + star[:1]], [spike], [ring(100, 100, 110, 110)], [ring(8, 8, 50, 50), ring(20, 20, 25, 25)], [ring(3, 3, 3, 9)], [], None]
    df = spark.createDataFrame([(i, r, region[: 1 + i % 3]) for i, r in enumerate(a)] + [(90, [ring(6, 6, 9, 9)], None)], SHAPES + ", region array<array<struct<x:double,y:double>>>")
    got = {r.g: (r.area, r.perimeter) for r in overlay.each_measured(df, "g", ["rings", "region"], getattr(overlay, rule)).collect()}
    full = df.filter("rings is not null").select("g", "rings"), df.filter("region is not null").select("g", F.col("region").alias("rings"))
    want = {r.g: (r.area, r.perimeter) for r in overlay.measures(overlay.combined(*full, "g", getattr(overlay, rule)), "g").collect()}
    assert set(got) == set(want) and all(np.allclose(got[g], want[g], rtol=0, atol=1e-5) for g in got)
    fixed = {r.g: (r.area, r.perimeter) for r in overlay.each_measured(df, "g", ["rings"], overlay.odd).collect()}
    want = {r.g: (r.area, r.perimeter) for r in overlay.measures(overlay.repaired(full[0], "g"), "g").collect()}
    assert set(fixed) == set(want) and all(np.allclose(fixed[g], want[g], rtol=0, atol=1e-5) for g in fixed)
