"""Boxes on the grid without their rings: runs, parity and painting against shapes taken one by one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.operators import rasterise, runs

GRID = GridSpec(32, 32, 25.0, 0.0, 800.0)
SHAPES = "id long, kind string, rings array<array<struct<x:double,y:double>>>"


def made(n=300):
    rng = np.random.default_rng(2)
    rows = []
    for i, (x, y, w, h) in enumerate((rng.integers([-200, -200, 0, 0], [850, 850, 300, 300], (n, 4)) + rng.choice([0.0, 0.5], (n, 1))).tolist()):
        corners = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        rows.append((i, "polygon", [[{"x": a, "y": b} for a, b in (corners if i % 3 else corners[::-1])]]))
    return [*rows, (900, "polygon", None), (901, "polygon", []), (902, "line", [[{"x": 10.0, "y": 10.0}, {"x": 300.0, "y": 10.0}]])]


@pytest.mark.parametrize("touched", [True, False])
def test_runs_of_boxes(spark, touched):
    df = spark.createDataFrame(made(), SHAPES)
    cells = lambda found: {tuple(r) for r in found.select("id", "row", F.explode(F.sequence("c0", "c1"))).collect()}
    one_by_one = df.mapInArrow(rasterise._burn(GRID, touched), "id long, row int, c0 int, c1 int")
    found = rasterise.shape_runs(df, GRID, touched)
    assert cells(found) == cells(one_by_one)
    assert found.filter("id < 900").groupBy("id", "row").count().filter("count > 1").count() == 0


def test_parity_and_painting(spark):
    df = spark.createDataFrame(made()[:300], SHAPES)
    found = runs.clip(rasterise.shape_runs(df, GRID, False), GRID)
    cells = found.select("row", F.explode(F.sequence("c0", "c1")).alias("col"))
    odd = runs.odd(found)
    assert {tuple(r) for r in runs.to_cells(odd).collect()} == {tuple(r) for r in runs.parity(cells, []).collect()}
    painted = df.withColumns({"prio": F.col("id") % 7, "code": F.concat(F.lit("c"), F.col("id"))})
    best = {}
    for r in rasterise.shape_runs(df, GRID, False).collect():
        for c in range(max(r.c0, 0), min(r.c1, 31) + 1):
            if 0 <= r.row < 32:
                best[r.row, c] = max(best.get((r.row, c), (-1, -1)), (r.id % 7, r.id))
    assert {(r.row, r.col): r.code for r in rasterise.coded(painted, GRID, "prio", "code").collect()} == {k: f"c{i}" for k, (_, i) in best.items()}
