"""Kernels on outlines, faces of line work, composition and manifests."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.operators import outlines as o
from cellplane.operators import runs
from cellplane.plans import bands, compose

SQUARE = np.array([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)])


def test_hull_rectangle_axis():
    rng = np.random.default_rng(1)
    pts = np.concatenate([SQUARE, rng.uniform(0.5, 3.5, (50, 2))])
    assert {tuple(p) for p in o.convex_hull(pts)} == {tuple(p) for p in SQUARE}
    turn = np.array([[math.cos(0.4), -math.sin(0.4)], [math.sin(0.4), math.cos(0.4)]])
    strip = np.array([(0.0, 0.0), (1000.0, 0.0), (1000.0, 40.0), (0.0, 40.0)]) @ turn.T
    assert abs(abs(o.signed_area(o.rotated_rectangle(strip))) - 40_000) < 1e-6
    axis = o.long_axis(strip)
    ends = np.array([(0.0, 20.0), (1000.0, 20.0)]) @ turn.T
    assert min(np.abs(axis - ends).max(), np.abs(axis[::-1] - ends).max()) < 1e-6
    assert o.long_axis(strip / 10) is None


def test_lines_and_simplification():
    parts = [np.array([(0.0, 0), (1, 0)]), np.array([(2.0, 0), (1, 0)]), np.array([(2.0, 0), (3, 1)]), np.array([(9.0, 9), (8, 8)])]
    assert sorted(len(p) for p in o.merged_lines(parts)) == [2, 4]
    wave = np.array([(float(i), 0.5 * (i % 2)) for i in range(20)])
    assert len(o.simplified(wave, 1.0)) == 2 and len(o.simplified(wave, 0.1)) == 20
    ring = np.array([(0, 0), (2, 0.01), (4, 0), (4, 4), (0, 4)], dtype=float)
    assert len(o.simplified_ring(ring, 0.1)) == 4


def test_clip_and_clean():
    assert abs(o.signed_area(o.clipped(SQUARE, 1, 1, 9, 3)) - 6) < 1e-9
    assert len(o.clipped(SQUARE, 10, 10, 12, 12)) == 0
    hole, island = SQUARE / 2 + 1, SQUARE / 8 + 1.5
    parts = o.cleaned([SQUARE, hole, island, SQUARE[:2]])
    assert sorted(len(p) for p in parts) == [1, 2]
    assert len(o.cleaned([SQUARE, SQUARE / 100 + 10], least_area=1)) == 1


def test_path_and_affine():
    steps = [((0, 0), (1, 0)), ((1, 0), (1, 1)), ((1, 1), (0, 0)), ((5, 5), (6, 5)), ((6, 5), (6, 6))]
    assert [len(r) for r in o.path_rings(steps)] == [4, 3]
    m = np.array([[2.0, 0.5, 10], [-0.25, 3, -7]])
    px = np.array([(0.0, 0), (100, 0), (100, 50), (0, 50)])
    assert np.allclose(o.affine_fit(px, px @ m[:, :2].T + m[:, 2]), m)


@pytest.mark.parametrize("n", [1, 3])
def test_faces_of_a_lattice(spark, n):
    lines = [[(0.0, float(i)), (float(n), float(i))] for i in range(n + 1)] + [[(float(i), -0.5), (float(i), n + 0.5)] for i in range(n + 1)]
    rows = [(7, [[{"x": x, "y": y} for x, y in line] for line in lines])]
    got = o.polygonised(spark.createDataFrame(rows, f"tile long, rings {o.DDL}")).collect()
    assert len(got) == n * n
    assert all(abs(o.signed_area(np.array([(p.x, p.y) for p in r.rings[0]])) - 1) < 1e-9 for r in got)


def test_faces_across_tiles(spark):
    """Faces of line work that crosses tiles are those of a single tile, cut at the tiles."""
    rng = np.random.default_rng(3)
    made = [(x, y, x + w, y + h) for x, y, w, h in (rng.integers([0, 0, 20, 20], [2500, 2500, 450, 320], (60, 4)).astype(float) + 0.5).tolist()]
    closed = [[(a, b), (c, b), (c, d), (a, d), (a, b)] for a, b, c, d in made]
    box = lambda t: (t // 10 * 1024, t % 10 * 1024, (t // 10 + 1) * 1024, (t % 10 + 1) * 1024)
    df = spark.createDataFrame([([[{"x": x, "y": y} for x, y in r]],) for r in closed], f"rings {o.DDL}")
    tiles = o.tiled(df, 1024, 512, lambda x, y: F.when(x.between(0, 9) & y.between(0, 9), x * 10 + y))
    got = sorted((r.tile, round(o.signed_area(np.array([(p.x, p.y) for p in r.rings[0]])), 3)) for r in o.polygonised(tiles, box).collect())
    whole = o.faces(np.concatenate([np.stack([r[:-1], r[1:]], axis=1) for r in map(np.array, closed)]))
    cut = [(10 * i + j, o.clipped(f, *box(10 * i + j))) for f in whole for i in range(4) for j in range(4)]
    assert got == sorted((t, round(a, 3)) for t, f in cut if len(f) > 2 and (a := o.signed_area(f)) > 1e-9)


def test_kernel_over_shapes(spark):
    rows = [(1, [[{"x": float(x), "y": float(y)} for x, y in SQUARE]]), (2, None)]
    df = spark.createDataFrame(rows, f"id long, rings {o.DDL}")
    got = {r.id: r.rings for r in o.mapped(df, lambda rings: [o.clipped(r, 1, 1, 9, 9) for r in rings]).collect()}
    assert len(got[1][0]) == 4 and got[2] == []


def test_composition(spark):
    grid = GridSpec(40, 40)
    block = lambda r, c, h, w: spark.createDataFrame([(r + i, c, c + w - 1) for i in range(h)], "row int, c0 int, c1 int")
    valid = block(2, 2, 36, 36)
    out = compose.composed({"rail_main": block(0, 10, 40, 3), "nature_protection_areas": block(20, 0, 2, 40)}, valid, grid, 20)
    cells = {n: {(r.row, r.col) for r in runs.to_cells(m).collect()} for n, m in out.items()}
    inside = {(r, c) for r in range(2, 38) for c in range(2, 38)}
    human, nature = {(r, c) for r, c in inside if 10 <= c < 13}, {(r, c) for r, c in inside if 20 <= r < 22}
    assert cells["exclusion_human"] == human and cells["exclusion_nature"] == nature and cells["exclusion_geography"] == set()
    assert cells["all_exclusions"] == human | nature and cells[bands.RAW] == inside - human - nature
    assert cells["available_cleaned_min_20ha"] == {(r, c) for r, c in inside - human - nature if c >= 13}
    percent = {n: m.count() for n, m in compose.blurred(out[bands.RAW], grid).items()}
    assert list(percent) == [b for b in bands.BANDS if b.startswith("available_blur")]


def test_manifest(spark):
    doc = json.loads(compose.manifest(spark))
    assert doc["band_count"] == 44 and compose.findings(doc) == []
    assert [b["name"] for b in doc["bands"]] == list(bands.BANDS)
    doc["bands"][3]["abgeleitet_von"] = ["nothing"]
    doc["bands"][4]["name"] = ""
    doc["x_wirkungspfad"] = ["gone"]
    doc["caveats"] = [{"id": "c", "affects": {"bands": [99]}}]
    assert len(compose.findings(doc)) >= 4
