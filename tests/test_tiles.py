"""Planes as tiles against whole arrays, and pruned GeoParquet."""

import json

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.operators import raster, tiles
from cellplane.sources import geoparquet


def array(df, grid, side, fill=np.nan):
    out = np.full((grid.height, grid.width), fill)
    for r in tiles.to_cells(df, grid, side=side).collect():
        out[r.row, r.col] = r.v
    return out


@pytest.fixture(scope="module")
def plane(spark):
    rng = np.random.default_rng(3)
    grid = GridSpec(75, 53, 25.0, 100.0, 2000.0)
    v = rng.uniform(0, 100, (53, 75))
    v[rng.uniform(size=v.shape) < 0.1] = np.nan
    v[:20, :20] = np.nan  # whole tiles are missing
    r, c = np.nonzero(~np.isnan(v))
    return grid, v, spark.createDataFrame([(int(a), int(b), float(v[a, b])) for a, b in zip(r, c, strict=True)], "row int, col int, v double").repartition(3).cache()


@pytest.mark.parametrize("side", [16, 20, 256])
def test_round_trip_and_windows(plane, side):
    grid, v, df = plane
    own = tiles.from_cells(df, grid, side=side)
    assert np.array_equal(array(own, grid, side), v, equal_nan=True)
    near = lambda w: np.nansum(np.stack([w[i : w.shape[0] - 6 + i, j : w.shape[1] - 6 + j] for i in range(7) for j in range(7)]), axis=0)
    for edge in ("edge", "symmetric"):
        got = array(tiles.windowed(own, grid, 3, near, edge, side=side), grid, side, 0.0)
        assert np.allclose(got, near(np.pad(v, 3, mode=edge)))


def test_slope_as_the_cells_do(plane):
    grid, v, df = plane
    full = df.sparkSession.createDataFrame([(r, c, 0.0 if np.isnan(v[r, c]) else float(v[r, c])) for r in range(52) for c in range(72)], "row int, col int, v double")
    grid = GridSpec(72, 52, 25.0)
    found, coarse, side = tiles.slope_percent(tiles.from_cells(full, grid, 0.0, 16), grid, 4, 16)
    want = {(r.row, r.col): r.slope for r in raster.slope_percent(raster.block_mean(full, 4, grid), 18, 13, 100.0).collect()}
    got = array(found, coarse, side)
    assert got.shape == (13, 18) and all(abs(got[k] - x) < 1e-9 for k, x in want.items())
    with pytest.raises(ValueError):
        tiles.slope_percent(found, grid, 5, 16)


def test_slope_beside_missing_tiles(spark):
    """A tile that is not there gets the slopes that its neighbours' margins give it, with the fill value for its own heights."""
    grid = GridSpec(96, 96, 25.0)
    cells = [(35, 64, 50.0), (31, 95, 20.0)]
    dense = spark.createDataFrame([(r, c, dict(((a, b), v) for a, b, v in cells).get((r, c), 0.0)) for r in range(96) for c in range(96)], "row int, col int, v double")
    want = {(r.row, r.col): round(r.slope, 9) for r in raster.slope_percent(raster.block_mean(dense, 4, grid), 24, 24, 100.0).collect() if r.slope > 0}
    own = tiles.from_cells(spark.createDataFrame(cells, "row int, col int, v double"), grid, 0.0, 32)
    found, coarse, side = tiles.slope_percent(own, grid, 4, 32, 0.0)
    assert {(r.row, r.col): round(r.v, 9) for r in tiles.to_cells(found, coarse, lambda v: v > 0, side).collect()} == want


def test_blur_as_the_cells_do(spark):
    grid = GridSpec(150, 130, 25.0)
    cells = spark.createDataFrame([(0, 0), (64, 64), (129, 149), (63, 10)], "row int, col int")
    own = tiles.from_cells(cells.withColumn("v", F.lit(1.0)), grid, 0.0, 32)
    got = {(r.row, r.col): int(r.v) for r in tiles.to_cells(tiles.blur_percent(own, 60, grid, 32), grid, lambda v: v > 0, 32).collect()}
    assert got == {(r.row, r.col): r.percent for r in raster.blur_percent(cells, 60, grid).collect()}


@pytest.mark.parametrize("target", [GridSpec(31, 22, 61.0, 80.0, 2050.0), GridSpec(130, 90, 11.0, 300.5, 1900.25), GridSpec(75, 53, 25.0, 100.0, 2000.0)])
def test_warps(plane, target):
    grid, v, df = plane
    average, greatest = (array(tiles.warped(tiles.from_cells(df, grid, side=16), grid, target, how, 16), target, 16) for how in ("average", "greatest"))
    for r in range(0, target.height, 3):
        for c in range(target.width):
            y0, x0 = (2000.0 - (target.y_top - r * target.cell_m)) / 25, (target.x0 + c * target.cell_m - 100.0) / 25
            y1, x1 = y0 + target.cell_m / 25, x0 + target.cell_m / 25
            total = share = 0.0
            most = -np.inf
            for i in range(max(0, int(np.floor(y0))), min(53, int(np.ceil(y1)))):
                for j in range(max(0, int(np.floor(x0))), min(75, int(np.ceil(x1)))):
                    w = max(0.0, min(y1, i + 1) - max(y0, i)) * max(0.0, min(x1, j + 1) - max(x0, j))
                    if w > 1e-9 and not np.isnan(v[i, j]):
                        total, share, most = total + w * v[i, j], share + w, max(most, v[i, j])
            if share > 1e-6:
                assert abs(average[r, c] - total / share) < 1e-6 and greatest[r, c] == most
            elif share == 0:
                assert np.isnan(average[r, c]) and np.isnan(greatest[r, c])


def _scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_pruned_geoparquet(spark, tmp_path):
    rng = np.random.default_rng(5)
    at = rng.uniform(0, 10_000, (3000, 2)).round(2).tolist()
    rows = [(i, "polygon", [[(x, y), (x + 20, y), (x + 20, y + 10), (x, y + 10)]]) for i, (x, y) in enumerate(at)] + [(-1, None, None), (-2, "point", [[(5.0, 5.0)]])]
    df = spark.createDataFrame(rows, "id long, kind string, rings array<array<struct<x:double,y:double>>>").repartition(4)
    path = str(tmp_path / "shapes")
    geoparquet.write_geoparquet(df, path, row_group=100, files=3)
    files = sorted((tmp_path / "shapes").iterdir())
    assert len(files) == 3 and all(pq.ParquetFile(f).metadata.row_group(0).num_rows == 100 for f in files)
    geo = json.loads(pq.ParquetFile(files[0]).metadata.metadata[b"geo"])
    assert geo["columns"]["geometry"]["covering"]["bbox"]["xmin"] == ["bbox", "xmin"] and geo["columns"]["geometry"]["bbox"][0] == min(5.0, min(x for x, _ in at))
    box = (2000.0, 3000.0, 2600.0, 3500.0)
    want = {i for i, (x, y) in enumerate(at) if x <= 2600 and x + 20 >= 2000 and y <= 3500 and y + 10 >= 3000}
    found = geoparquet.read_covered(spark, path, box)
    assert {r.id for r in found.collect()} == want and want
    by_id = {r.id: r for r in geoparquet.read_covered(spark, path).collect()}
    assert len(by_id) == 3002 and by_id[-1].kind is None and not by_id[-1].rings and [tuple(p) for p in by_id[7].rings[0][:4]] == [tuple(p) for p in rows[7][2][0]]
    plain = spark.read.parquet(path).filter("bbox.xmin <= 2600 and bbox.xmax >= 2000 and bbox.ymin <= 3500 and bbox.ymax >= 3000").select("id")
    assert _scanned(plain) < 1000
    plan = found._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(bbox.xmin)" in plan
    geoparquet.write_geoparquet(df.filter("id < 0 and id > 0"), str(tmp_path / "none"))  # nothing to write is no error
