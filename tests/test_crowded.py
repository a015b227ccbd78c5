"""Joins by place where very many rows share a place: results against brute force, and pairs that need not be made."""

import random

from pyspark.sql import functions as F

from cellplane.operators import cluster, spatial


def rings_of(*rings):
    return [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]


def inside(x, y, rings):
    hits = 0
    for r in rings:
        for p, q in zip(r, r[1:] + r[:1]):
            if (p["y"] > y) != (q["y"] > y) and x < p["x"] + (y - p["y"]) * (q["x"] - p["x"]) / (q["y"] - p["y"]):
                hits += 1
    return hits % 2 == 1


SHAPES = "poly long, rings array<array<struct<x: double, y: double>>>"


def test_covers_of_boxes_and_other_shapes(spark):
    rng = random.Random(5)
    shapes = []
    for i in range(60):
        x, y, w, h = rng.randint(-40, 60), rng.randint(-40, 60), rng.randint(0, 50), rng.randint(0, 50)
        box = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        kinds = [box, box[::-1], [*box, box[0]], box[:3], [box[0], box[2], box[1], box[3]]]
        shapes.append((i, rings_of(box, [(x + 1, y + 1), (x + 3, y + 1), (x + 3, y + 3)]) if i % 6 == 5 else rings_of(kinds[i % 6])))
    shapes += [(900, None), (901, [])]
    points = [(i, float(rng.randint(-45, 110)), float(rng.randint(-45, 110))) for i in range(400)]
    p, a = spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(shapes, SHAPES)
    pairs = {(i, k) for i, x, y in points for k, r in shapes if r and inside(x, y, r)}
    assert {tuple(r) for r in spatial.covering(p, a, 16.0).collect()} == pairs
    assert {r.poly for r in spatial.holding(p, a, 16.0).collect()} == {k for _, k in pairs}
    area = {r.poly: r.area for r in a.select("poly", spatial.area(F.col("rings")).alias("area")).collect()}
    least = {i: min((area[k], k) for j, k in pairs if j == i) for i in {j for j, _ in pairs}}
    assert {(r.id, r.area, r.poly) for r in spatial.smallest_cover(p, a, 16.0).collect()} == {(i, *b) for i, b in least.items()}


def joined_rows(spark, df):
    """df's rows, and the rows that its joins gave in all."""
    plan = df._jdf.queryExecution().executedPlan()
    rows = df.collect()

    def total(node):
        node = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan() if "QueryStage" in node.nodeName() else node
        own = node.metrics().get("numOutputRows").get().value() if "Join" in node.nodeName() else 0
        return own + sum(total(node.children().apply(i)) for i in range(node.children().size()))

    return rows, total(plan)


def test_smallest_cover_makes_few_pairs(spark):
    """2,000 points under 2,000 boxes each: four million pairs."""
    p = spark.range(2000).selectExpr("id", "100 + id % 50 + 0.25 as x", "100 + id / 50 + 0.25 as y")
    a = spark.range(2000).select(F.col("id").alias("poly"), spatial.rectangle(-F.col("id") / 40, -F.col("id") / 40, F.lit(300) + F.col("id") / 40, F.lit(300) + F.col("id") / 40).alias("rings"))
    rows, n = joined_rows(spark, spatial.smallest_cover(p, a, 64.0))
    assert len(rows) == 2000 and {r.poly for r in rows} == {0}
    assert n < 400_000


def test_nearest_of_crowded_points_makes_few_pairs(spark):
    """2,500 points beside as many within the radius: over six million pairs."""
    p = spark.range(2500).selectExpr("id", "id % 50 + 0.25 as x", "id div 50 + 0.5 as y")
    q = spark.range(5000).selectExpr("id", "id % 2500 % 50 + 0.0 as x", "id % 2500 div 50 + 0.0 as y")
    far = spark.createDataFrame([(9000, 120.0, 49.0), (9001, 150.0, 49.0)], "id long, x double, y double")
    rows, n = joined_rows(spark, spatial.nearest_within(p.union(far), q, 100.0))
    found = {r.id: r.nearest for r in rows}
    assert all(found[i] == i for i in range(2500)) and found[9000] == 2499 and found[9001] is None
    assert n < 1_000_000
    near = {r.id for r in spatial.any_within(p.union(far), q, 100.0).collect()}
    assert near == {*range(2500), 9000}


def test_clusters_of_crowded_points(spark):
    """Two crowds of 20,000 points each, whose pairs would be 400 million, joined by a chain."""
    p = spark.range(40_000).selectExpr("id", "id % 2 * 1000 + id div 2 % 100 as x", "id div 200 as y").union(spark.createDataFrame([(50_000 + i, 150 + 100 * i, 100) for i in range(9)], "id long, x long, y long"))
    p = p.union(spark.createDataFrame([(60_000, 5000, 5000)], "id long, x long, y long"))
    found = {r.cluster: r.n for r in cluster.eps_components(p, 105.0).groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    assert found == {0: 40_009, 60_000: 1}
    assert {r.core for r in cluster.dbscan(p, 105.0, 2).filter("id = 60000").collect()} == {False}


def test_shapes_that_meet_some_other(spark):
    rng = random.Random(8)

    def some(n, first):
        out = []
        for i in range(n):
            x, y, w, h = rng.randint(-40, 60), rng.randint(-40, 60), rng.randint(0, 30), rng.randint(0, 30)
            box = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
            out.append((first + i, rings_of([box, box[::-1], box[:3]][i % 3])))
        return out

    a, b = (spark.createDataFrame(some(n, k), SHAPES) for n, k in ((90, 0), (6, 500)))
    b = b.union(b)
    assert {r.poly for r in spatial.meeting(a, b, 16.0).collect()} == {r.poly for r in spatial.overlapping(a, b, 16.0).collect()}
    crowd = spark.createDataFrame([(i, rings_of([(0, 0), (50, 0), (50, 50), (0, 50)])) for i in range(3000)], SHAPES)
    assert spatial.meeting(crowd, crowd, 16.0).count() == 3000
