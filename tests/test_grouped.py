"""Chains and rings made of many groups to a call: groups that go over batches, and plans without a call for each group."""

import pytest

from cellplane.operators import chains, overlay, rings

POINTS = "array<struct<x:double,y:double>>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_groups_over_batches(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        step = lambda k, i: [{"x": float(i), "y": 10.0 * k}, {"x": float(i + 1), "y": 10.0 * k}]
        rows = [(100 * k + i, step(k, i)[:: 1 if i % 3 else -1]) for k in range(9) for i in range(k + 1)]
        rows += [(2000 + i, [{"x": float(a), "y": float(b)}, {"x": float(c), "y": float(d)}]) for i, (a, b, c, d) in enumerate([(0, 200, 9, 200), (9, 200, 9, 209), (9, 209, 0, 200)])]
        merged = chains.merged(spark.createDataFrame(rows, f"id long, points {POINTS}").repartition(3))
        found = {r.chain: r for r in merged.collect()}
        assert {c: (r.n_lines, len(r.points), r.endless) for c, r in found.items()} == {**{100 * k: (k + 1, k + 2, False) for k in range(9)}, 2000: (3, 4, True)}
        assert all(sorted(p.x for p in found[100 * k].points) in ([p.x for p in found[100 * k].points], [p.x for p in found[100 * k].points[::-1]]) for k in range(9))
        assert "FlatMapGroups" not in plan(merged)
        box = lambda x, n, y=0: [{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + n, y), (x + n, y + n), (x, y + n))]
        shapes = spark.createDataFrame([(g, [box(g, 20 + g), box(g + 5, 4 + g, 2)]) for g in range(12)], f"g long, rings array<{POINTS}>")
        for side in (None, 7.0):
            made = rings.stitched(overlay.repaired(shapes, "g"), "g", side)
            assert sorted((r.g, len(r.points), round(r.area, 6)) for r in made.collect()) == sorted(row for g in range(12) for row in ((g, 4, float((20 + g) ** 2)), (g, 4, -float((4 + g) ** 2))))
            assert "FlatMapGroups" not in plan(made)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
