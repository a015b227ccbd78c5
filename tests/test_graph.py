"""Graphs with cycles and chains of lines against plain ones."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellplane.operators import chains
from cellplane.plans import graph
from cellplane.scratch import materialise


def cut(df):
    return materialise(df, "test")


def plain(edges, n):
    """Component, stage, reached from node 0, dead end, of each node that has an edge."""
    reach = np.eye(n, dtype=bool)
    for a, b in edges:
        reach[a, b] = True
    for k in range(n):
        reach |= reach[:, k][:, None] & reach[k][None]
    both = reach & reach.T
    c = both.argmax(axis=1)
    over = {(c[a], c[b]) for a, b in edges if c[a] != c[b]}
    stage = dict.fromkeys(set(c.tolist()), 0)
    for _ in range(n):
        for a, b in over:
            stage[b] = max(stage[b], stage[a] + 1)
    has = {x for e in edges for x in e}
    return sorted((v, int(c[v]), stage[c[v]], bool(reach[0, v]) if 0 in has else False, all(a != c[v] for a, _ in over)) for v in has)


@pytest.mark.parametrize(("n", "m", "seed"), [(30, 35, 1), (25, 60, 2), (12, 12, 3)])
def test_normalised(spark, n, m, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
    edges += [edges[0], (3, 3)]
    df = spark.createDataFrame(edges, "src long, dst long")
    out = graph.normalised(df, spark.createDataFrame([(0,)], "node long"), cut).collect()
    assert sorted((r.node, r.component, r.stage, r.reached, r.dead_end) for r in out) == plain(edges, n)


def test_no_edges(spark):
    none = spark.createDataFrame([], "src long, dst long")
    assert graph.normalised(none, spark.createDataFrame([(1,)], "node long"), cut).count() == 0
    loop = spark.createDataFrame([(4, 4), (None, 4)], "src long, dst long")
    assert graph.strong_components(loop, cut).collect() == [(4, 4)]


def test_chains(spark):
    rng = random.Random(7)
    p = [(float(i), float(i * i % 17)) for i in range(60)]
    parts = [[p[i], p[i + 1]] for i in range(20)]  # a chain
    parts += [[p[30 + i], p[30 + (i + 1) % 6]] for i in range(6)]  # a closed one
    parts += [[p[50], p[51]], [p[51], p[52]], [p[51], p[53]], [p[53], p[54], p[55]]]  # three meet in one point
    parts += [[p[58]], [(1.5, 99.0), (2.5, 99.0), (1.5, 99.0)]]  # no line; a loop by itself
    rows = [(i, q if rng.random() < 0.5 else q[::-1]) for i, q in enumerate(parts)]
    out = chains.merged(spark.createDataFrame(rows, "id long, points array<struct<x:double,y:double>>").repartition(3)).collect()
    found = {r.chain: (r.n_lines, [(q.x, q.y) for q in r.points]) for r in out}
    assert {k: v[0] for k, v in found.items()} == {0: 20, 20: 6, 26: 1, 27: 1, 28: 2, 31: 1}
    assert found[0][1] in (p[:21], p[:21][::-1])
    assert len(found[20][1]) == 7 and found[20][1][0] == found[20][1][-1] and set(found[20][1]) == set(p[30:36])
    assert found[28][1] in ([p[51], p[53], p[54], p[55]], [p[55], p[54], p[53], p[51]])


def test_long_chain(spark):
    n = 100_000
    at = lambda i: F.struct((i * 1.0).alias("x"), ((i * 7) % 1013 * 1.0).alias("y"))
    lines = spark.range(n).select("id", F.array(at(F.col("id")), at(F.col("id") + 1)).alias("points"))
    began = time.perf_counter()
    out = chains.merged(lines).select("chain", "n_lines", F.size("points").alias("n")).collect()
    assert [(r.chain, r.n_lines, r.n) for r in out] == [(0, n, n + 1)] and time.perf_counter() - began < 300
