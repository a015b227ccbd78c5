"""Run algebra, dilation, components and filters against plain sets of cells."""

import random

import pytest
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec, disc
from cellplane.operators import labels, raster, rasterise, runs

SCHEMA = "row int, col int"


def mask(spark, cells):
    return runs.from_cells(spark.createDataFrame(sorted(cells), SCHEMA))


def cells(df):
    got = [(r.row, r.col) for r in runs.to_cells(df).collect()]
    assert len(got) == len(set(got))
    return set(got)


def block(r, c, h, w):
    return {(r + i, c + j) for i in range(h) for j in range(w)}


def scattered(n, m, p, seed):
    rng = random.Random(seed)
    return {(i, j) for i in range(n) for j in range(m) if rng.random() < p}


def grown(s, radius, n, m):
    return {(r + dr, c + dc) for r, c in s for dr, w in disc(radius) for dc in range(-w, w + 1) if 0 <= r + dr < n and 0 <= c + dc < m}


@pytest.mark.parametrize("shape,p,seed,radius", [((24, 24), 0.05, 1234, 3), ((24, 24), 0.05, 1234, 12), ((17, 23), 0.1, 42, 7), ((9, 40), 0.1, 42, 7), ((20, 20), 1.0, 1, 6), ((16, 16), 0.0, 1, 6), ((12, 12), 0.1, 3, 0)])
def test_dilation(spark, shape, p, seed, radius):
    s = scattered(*shape, p, seed)
    assert cells(runs.dilate(mask(spark, s), radius, GridSpec(shape[1], shape[0], 1.0))) == (grown(s, radius, *shape) if radius else s)


def test_set_algebra_and_closing(spark):
    a, b, grid = scattered(20, 20, 0.4, 1), scattered(20, 20, 0.4, 2), GridSpec(20, 20, 1.0)
    x, y = mask(spark, a), mask(spark, b)
    assert cells(runs.or_(x, y)) == a | b
    assert cells(runs.and_(x, y)) == a & b
    assert cells(runs.and_not(x, y)) == a - b
    assert cells(runs.xor(x, y)) == a ^ b
    whole = block(0, 0, 20, 20)
    assert cells(runs.complement(x, grid)) == whole - a
    once = runs.close(mask(spark, scattered(20, 20, 0.1, 5)), 2, 2, grid)
    assert cells(runs.close(once, 2, 2, grid)) == cells(once)


def test_runs_are_canonical(spark):
    df = mask(spark, {(0, 1), (0, 2), (0, 4), (1, 2)})
    assert sorted((r.row, r.c0, r.c1) for r in df.collect()) == [(0, 1, 2), (0, 4, 4), (1, 2, 2)]


@pytest.mark.parametrize("parts,kept", [([(10, 10, 4, 4)], 16), ([(10, 10, 3, 3), (13, 13, 3, 3)], 0), ([(10, 10, 3, 3), (13, 10, 3, 3)], 18)])
def test_min_area(spark, parts, kept):
    s = set().union(*[block(*p) for p in parts])
    grid = GridSpec(40, 40)
    assert len(cells(labels.min_area(mask(spark, s), 1, grid))) == kept
    assert cells(labels.min_area(mask(spark, s), 0, grid)) == s


@pytest.mark.parametrize("neighbours", [4, 8])
@pytest.mark.parametrize("strip", [4, 7, 128])
def test_components(spark, neighbours, strip):
    s, grid = scattered(30, 30, 0.5, 7), GridSpec(30, 30)
    near = [(0, 1), (1, 0), (0, -1), (-1, 0)] + [(1, 1), (1, -1), (-1, 1), (-1, -1)] * (neighbours == 8)
    label, left = {}, set(s)
    while left:
        stack, seen = [left.pop()], set()
        while stack:
            r, c = stack.pop()
            seen.add((r, c))
            for dr, dc in near:
                if (q := (r + dr, c + dc)) in left:
                    left.remove(q)
                    stack.append(q)
        for q in seen:
            label[q] = min(r * 30 + c for r, c in seen)
    got = labels.components(mask(spark, s), grid, neighbours, strip).select("row", F.explode(F.sequence("c0", "c1")).alias("col"), "label").collect()
    assert {(r.row, r.col): r.label for r in got} == label


def test_blur(spark):
    grid = GridSpec(120, 120)
    square = spark.createDataFrame(sorted(block(30, 30, 60, 60)), SCHEMA)
    near, far = ({(r.row, r.col): r.percent for r in raster.blur_percent(square, s, grid).collect()} for s in (100, 300))
    assert near[60, 60] == 100 and (2, 2) not in near and 40 <= near[30, 60] <= 60
    assert far.get((20, 60), 0) > near.get((20, 60), 0)
    assert raster.blur_percent(square.limit(0), 100, grid).count() == 0


def test_shapes_on_the_grid(spark):
    grid = GridSpec(10, 10, 1.0, 0.0, 10.0)
    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    point = "array<array<struct<x:double,y:double>>>"
    shapes = spark.createDataFrame(
        [(1, "polygon", [ring((1.2, 8.8), (4.8, 8.8), (4.8, 5.2), (1.2, 5.2)), ring((2.2, 7.8), (3.8, 7.8), (3.8, 6.2), (2.2, 6.2))]), (2, "line", [ring((6.5, 0.5), (9.5, 3.5))]), (3, "point", [ring((0.5, 0.5))])],
        f"id long, kind string, rings {point}",
    )
    touched = cells(rasterise.burnt(shapes, grid))
    assert block(1, 1, 4, 4) <= touched and (9, 0) in touched
    assert {(9, 6), (8, 7), (7, 8), (6, 9)} <= touched
    centres = cells(rasterise.burnt(shapes.filter("kind = 'polygon'"), grid, all_touched=False))
    assert centres == block(1, 1, 4, 4) - block(2, 2, 2, 2)
    off = spark.createDataFrame([(1, "point", [ring((-2.5, 5.5))])], f"id long, kind string, rings {point}")
    assert cells(rasterise.burnt(off, grid, 3.0)) == {(4, 0)}
