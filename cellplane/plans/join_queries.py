"""Queries over points and shapes: nearness, cover, overlap, hull signals, clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellplane.functions import scalars as S
from cellplane.operators import cluster, labels, runs, spatial
from cellplane.plans.placed import GRID, disc_sql, components_sql, read, GRID_SQL

#: Points in metres on the 6400 m square of the grid: table, id, x, y. Each set takes all rows of its table.
SPOTS = {
    "candidates": ("customer", "c_custkey", "(c_custkey * 1237 + c_nationkey * 91) % 6400", "(c_custkey * 577 + c_nationkey * 331) % 6400"),
    "addresses": ("customer", "c_custkey", "(c_custkey * 2063 + c_nationkey * 17) % 6400", "(c_custkey * 911 + c_nationkey * 53) % 6400"),
    "gardens": ("part", "p_partkey", "(p_partkey * 1453 + p_size * 7) % 6400", "(p_partkey * 389 + p_size * 29) % 6400"),
    "register": ("part", "p_partkey", "(p_partkey * 1733 + p_size * 13) % 6400", "(p_partkey * 827 + p_size * 5) % 6400"),
    "turbines": ("supplier", "s_suppkey", "(s_suppkey * 1871 + s_nationkey * 37) % 6400", "(s_suppkey * 739 + s_nationkey * 71) % 6400"),
}
SPOT_CODE = "CASE p_size % 5 WHEN 1 THEN '01' WHEN 3 THEN '08' WHEN 2 THEN '02' ELSE '05' END"


def spots(s, d, name, *more):
    table, key, x, y = SPOTS[name]
    return read(s, d, table).selectExpr(f"cast({key} as long) as id", f"cast({x} as double) as x", f"cast({y} as double) as y", *more)


def spots_sql(name, *more):
    table, key, x, y = SPOTS[name]
    return f"{name} AS (SELECT {', '.join([f'{key}::BIGINT AS id', f'({x})::DOUBLE AS x', f'({y})::DOUBLE AS y', *more])} FROM {table})"


#: Boxes: a corner and two sides, all below half a metre off whole metres, so that no point lies on an edge.
BOX = ("part", "p_partkey", "(p_partkey * 97) % 6000 + 0.5", "(p_partkey * 41 + p_size * 11) % 6000 + 0.5", "p_size * 9", "(p_size * 17) % 300 + 20")
#: Footprints of works, off the lines of the boxes.
SITE = ("supplier", "s_suppkey", "(s_suppkey * 613 + s_nationkey * 7) % 6000 + 0.25", "(s_suppkey * 331 + s_nationkey * 19) % 6000 + 0.25", "s_nationkey * 5 + 30", "(s_suppkey % 7) * 20 + 30")


def boxes(s, d, of=BOX):
    table, key, x, y, w, h = of
    return read(s, d, table).selectExpr(f"cast({key} as long) as poly", f"cast({x} as double) as x", f"cast({y} as double) as y", f"cast({w} as double) as w", f"cast({h} as double) as h").select("poly", spatial.rectangle(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h")).alias("rings"))


def boxes_sql(name, of=BOX):
    table, key, x, y, w, h = of
    return f"{name} AS (SELECT {key}::BIGINT AS poly, ({x})::DOUBLE AS x, ({y})::DOUBLE AS y, ({w})::DOUBLE AS w, ({h})::DOUBLE AS h FROM {table})"


SIDE = 512.0


def hypot(a, b):
    return f"sqrt(pow({a}.x - {b}.x, 2) + pow({a}.y - {b}.y, 2))"


def nearest(s, d):
    return spatial.nearest_within(spots(s, d, "candidates"), spots(s, d, "register"), 100.0).select("id", "nearest", F.round("distance", 6).alias("distance"))


def oversized(s, d):
    """Large boxes stay only if an address lies inside; small ones stay as they are."""
    all_ = boxes(s, d).withColumn("area", spatial.area(F.col("rings")))
    large = all_.filter("area > 10000")
    kept = large.join(spatial.holding(spots(s, d, "addresses"), large, SIDE), "poly", "left_semi")
    return all_.filter("area <= 10000").select("poly", "area", F.lit("as it is").alias("how")).unionByName(kept.select("poly", "area", F.lit("disc").alias("how")))


def hull_mask(s, d):
    p = spots(s, d, "candidates").select(GRID.row(F.col("y")).alias("row"), GRID.col(F.col("x")).alias("col"))
    return runs.close(runs.from_cells(p.filter(GRID.inside(F.col("row"), F.col("col")))), 100, 65, GRID)


def signals(s, d):
    """Six signals of each candidate, and the label of the hull its cell lies in (-1 outside)."""
    c = spots(s, d, "candidates")
    near = lambda name, r: spatial.any_within(c, spots(s, d, name), r).select("id").withColumn(name, F.lit(True))
    code = spots(s, d, "register", f"{SPOT_CODE} AS code").select(F.col("id").alias("nearest"), "code")
    reg = spatial.nearest_within(c, spots(s, d, "register"), 100.0).join(code, "nearest", "left").select("id", "nearest", "code")
    out = c.join(near("addresses", 100.0), "id", "left").join(near("gardens", 150.0), "id", "left").join(reg, "id", "left")
    out = out.select("id", GRID.row(F.col("y")).alias("row"), GRID.col(F.col("x")).alias("col"), F.col("addresses").isNotNull().alias("has_address"), F.col("gardens").isNotNull().alias("has_garden"), F.col("nearest").isNotNull().alias("has_register"),
                     F.coalesce(F.col("code").isin(*S.RESIDENTIAL_CODES), F.lit(False)).alias("is_home"), F.coalesce(F.col("code").isin(*S.INDUSTRIAL_CODES), F.lit(False)).alias("is_industry"), (F.col("x") > 4800).alias("in_zoning"))
    return labels.sample_labels(out, labels.components(hull_mask(s, d), GRID, 8)).withColumn("label", F.coalesce("label", F.lit(-1).cast("long"))).drop("row", "col")


def classes(s, d):
    n = lambda c: F.count_if(F.col(c)).alias(f"n_{c}")
    rows = signals(s, d).filter("label >= 0").groupBy("label").agg(F.count("*").alias("n"), *[n(c) for c in ("has_address", "has_garden", "has_register", "is_home", "is_industry", "in_zoning")])
    rows = rows.withColumn("home_share", S.share(F.col("n_is_home"), F.col("n_has_register"))).withColumn("zoning_share", S.share(F.col("n_in_zoning"), F.col("n"), 0.0))
    kind = S.hull_class(F.col("n_has_address"), F.col("n_has_garden"), F.col("n_has_register"), F.col("n_is_home"), F.col("zoning_share"))
    rows = rows.withColumn("kind", kind)
    return rows.withColumn("scattered", (F.col("kind") == "bewohnt") & (F.col("n_has_address") >= 5))


def scattered(s, d):
    rows = classes(s, d).filter("scattered")
    return runs.to_cells(labels.components(hull_mask(s, d), GRID, 8).join(rows, "label", "left_semi").select("row", "c0", "c1"))


_CAND_CELLS = "cells AS (SELECT DISTINCT floor((6400 - y) / 25)::INTEGER AS row, floor(x / 25)::INTEGER AS col FROM candidates WHERE floor((6400 - y) / 25) BETWEEN 0 AND 255)"
_HULL = ", ".join([spots_sql("candidates"), _CAND_CELLS, GRID_SQL, disc_sql("cells", 100, "grown"), "hole AS (SELECT * FROM grid EXCEPT SELECT * FROM grown)", disc_sql("hole", 65, "hole_b"), "hulls AS (SELECT * FROM grid EXCEPT SELECT * FROM hole_b)", components_sql("hulls", "lab", 8)])
_SIGNALS = ", ".join([
    _HULL, spots_sql("addresses"), spots_sql("gardens"), spots_sql("register", f"{SPOT_CODE} AS code"),
    f"near AS (SELECT c.id, r.id AS rid, r.code, row_number() OVER (PARTITION BY c.id ORDER BY {hypot('c', 'r')}, r.id) AS k FROM candidates c JOIN register r ON {hypot('c', 'r')} < 100)",
    f"signals AS (SELECT c.id, EXISTS (SELECT 1 FROM addresses a WHERE {hypot('c', 'a')} < 100) AS has_address, EXISTS (SELECT 1 FROM gardens g WHERE {hypot('c', 'g')} < 150) AS has_garden, n.rid IS NOT NULL AS has_register, "
    "coalesce(n.code IN ('01', '02', '03'), false) AS is_home, coalesce(n.code = '08', false) AS is_industry, c.x > 4800 AS in_zoning, coalesce(l.label, -1)::BIGINT AS label "
    "FROM candidates c LEFT JOIN near n ON n.id = c.id AND n.k = 1 LEFT JOIN lab l ON l.row = floor((6400 - c.y) / 25) AND l.col = floor(c.x / 25))",
])
_CLASSES = _SIGNALS + """, hull AS (SELECT label, count(*) AS n, count(*) FILTER (has_address) AS n_has_address, count(*) FILTER (has_garden) AS n_has_garden, count(*) FILTER (has_register) AS n_has_register,
  count(*) FILTER (is_home) AS n_is_home, count(*) FILTER (is_industry) AS n_is_industry, count(*) FILTER (in_zoning) AS n_in_zoning FROM signals WHERE label >= 0 GROUP BY label),
 shares AS (SELECT *, CASE WHEN n_has_register > 0 THEN n_is_home::DOUBLE / n_has_register END AS home_share, n_in_zoning::DOUBLE / n AS zoning_share FROM hull),
 kinds AS (SELECT *, CASE WHEN (n_has_register > 0 AND home_share < 0.1) OR (zoning_share >= 0.5 AND NOT (n_has_register > 0 AND home_share >= 0.1)) THEN 'industrie'
  WHEN n_has_address > 0 OR n_has_garden > 0 THEN 'bewohnt' ELSE 'unbewohnt' END AS kind FROM shares),
 classes AS (SELECT *, kind = 'bewohnt' AND n_has_address >= 5 AS scattered FROM kinds)"""
EPS, MIN_PTS = 320.0, 4


def _pairs(name, eps):
    return f"{spots_sql(name)}, e AS (SELECT a.id AS s, b.id AS t, {hypot('a', 'b')} AS dist FROM {name} a JOIN {name} b ON a.id <> b.id AND {hypot('a', 'b')} <= {eps})"


def _linked(nodes, edges, name):
    return f"{name}(id, label) USING KEY (id) AS (SELECT id, id FROM {nodes} UNION SELECT e.t, min(w.label) FROM {name} w JOIN {edges} e ON e.s = w.id JOIN recurring.{name} cur ON cur.id = e.t WHERE w.label < cur.label GROUP BY e.t)"


_KDIST = f"{spots_sql('turbines')}, k AS (SELECT id, dist AS distance FROM (SELECT a.id, {hypot('a', 'b')} AS dist, row_number() OVER (PARTITION BY a.id ORDER BY {hypot('a', 'b')}, b.id) AS r FROM turbines a JOIN turbines b ON a.id <> b.id) WHERE r = 3 AND dist <= 2000), curve AS (SELECT row_number() OVER (ORDER BY distance, id) - 1 AS rank, id, distance FROM k)"

QUERIES = {
    "nearest_within_radius": (nearest, f"WITH {spots_sql('candidates')}, {spots_sql('register')}, n AS (SELECT c.id, r.id AS nearest, {hypot('c', 'r')} AS dist, row_number() OVER (PARTITION BY c.id ORDER BY {hypot('c', 'r')}, r.id) AS k FROM candidates c JOIN register r ON {hypot('c', 'r')} < 100) SELECT c.id, n.nearest, round(n.dist, 6) AS distance FROM candidates c LEFT JOIN n ON n.id = c.id AND n.k = 1"),
    "pairs_within": (lambda s, d: spatial.pairs_within(spots(s, d, "candidates"), 60.0).select("a", "b"), f"WITH {spots_sql('candidates')} SELECT a.id AS a, b.id AS b FROM candidates a JOIN candidates b ON a.id < b.id AND {hypot('a', 'b')} <= 60"),
    "points_in_polygons": (lambda s, d: spatial.covering(spots(s, d, "candidates"), boxes(s, d), SIDE), f"WITH {spots_sql('candidates')}, {boxes_sql('b')} SELECT c.id, b.poly FROM candidates c JOIN b ON c.x > b.x AND c.x < b.x + b.w AND c.y > b.y AND c.y < b.y + b.h"),
    "smallest_cover": (lambda s, d: spatial.smallest_cover(spots(s, d, "candidates"), boxes(s, d), SIDE), f"WITH {spots_sql('candidates')}, {boxes_sql('b')} SELECT id, poly, area FROM (SELECT c.id, b.poly, b.w * b.h AS area, row_number() OVER (PARTITION BY c.id ORDER BY b.w * b.h, b.poly) AS r FROM candidates c JOIN b ON c.x > b.x AND c.x < b.x + b.w AND c.y > b.y AND c.y < b.y + b.h) WHERE r = 1"),
    "anti_join_overlap": (lambda s, d: boxes(s, d).join(spatial.meeting(boxes(s, d), boxes(s, d, SITE), SIDE).hint("merge"), "poly", "left_anti").select("poly"),
        f"WITH {boxes_sql('a')}, {boxes_sql('b', SITE)} SELECT poly FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.x <= b.x + b.w AND b.x <= a.x + a.w AND a.y <= b.y + b.h AND b.y <= a.y + a.h)"),
    "oversized_rule": (oversized, f"WITH {boxes_sql('b')}, {spots_sql('addresses')} SELECT poly, w * h AS area, CASE WHEN w * h > 10000 THEN 'disc' ELSE 'as it is' END AS how FROM b WHERE w * h <= 10000 OR EXISTS (SELECT 1 FROM addresses c WHERE c.x > b.x AND c.x < b.x + b.w AND c.y > b.y AND c.y < b.y + b.h)"),
    "hull_signals": (signals, f"WITH RECURSIVE {_SIGNALS} SELECT * FROM signals"),
    "hull_classes": (classes, f"WITH RECURSIVE {_CLASSES} SELECT * FROM classes"),
    "scattered_settlements": (scattered, f"WITH RECURSIVE {_CLASSES} SELECT row, col FROM lab WHERE label IN (SELECT label FROM classes WHERE scattered)"),
    "eps_components": (lambda s, d: cluster.eps_components(spots(s, d, "turbines"), EPS), f"WITH RECURSIVE {_pairs('turbines', EPS)}, {_linked('turbines', 'e', 'w')} SELECT id, label AS cluster FROM w"),
    "dbscan": (lambda s, d: cluster.dbscan(spots(s, d, "candidates"), 150.0, MIN_PTS),
        f"WITH RECURSIVE {_pairs('candidates', 150.0)}, core AS (SELECT id FROM (SELECT c.id, count(e.t) + 1 AS n FROM candidates c LEFT JOIN e ON e.s = c.id GROUP BY c.id) WHERE n >= {MIN_PTS}), ce AS (SELECT s, t FROM e WHERE s IN (SELECT id FROM core) AND t IN (SELECT id FROM core)), {_linked('core', 'ce', 'w')}, "
        "border AS (SELECT e.s AS id, min(w.label) AS near FROM e JOIN w ON w.id = e.t GROUP BY e.s) SELECT c.id, coalesce(w.label, b.near) AS cluster, w.id IS NOT NULL AS core FROM candidates c LEFT JOIN w ON w.id = c.id LEFT JOIN border b ON b.id = c.id"),
    "kdist_curve": (lambda s, d: cluster.kdist_curve(spots(s, d, "turbines"), 3, 2000.0, 250.0).select("id", F.round("distance", 6).alias("distance"), "rank"), f"WITH {_KDIST} SELECT id, round(distance, 6) AS distance, rank FROM curve"),
    "kdist_knee": (lambda s, d: cluster.chord_knee(cluster.kdist_curve(spots(s, d, "turbines"), 3, 2000.0, 250.0)).select("rank", F.round("distance", 6).alias("distance"), F.round("gap", 9).alias("gap")),
        f"WITH {_KDIST}, ends AS (SELECT min(rank) AS r0, max(rank) AS r1, min(distance) AS d0, max(distance) AS d1 FROM curve) SELECT rank, round(distance, 6) AS distance, round(abs((distance - d0) / greatest(d1 - d0, 1e-12) - (rank - r0) / greatest(r1 - r0, 1e-12)), 9) AS gap FROM curve, ends ORDER BY gap DESC, rank LIMIT 1"),
    "eps_sweep": (lambda s, d: cluster.eps_sweep(spots(s, d, "turbines"), [160.0, 320.0, 640.0], [2, 5]), "WITH RECURSIVE " + spots_sql("turbines") + ", " + ", ".join(f"e{i} AS (SELECT a.id AS s, b.id AS t FROM turbines a JOIN turbines b ON a.id <> b.id AND {hypot('a', 'b')} <= {e}), {_linked('turbines', f'e{i}', f'w{i}')}, c{i} AS (SELECT label, count(*) AS w FROM w{i} GROUP BY label)" for i, e in enumerate((160.0, 320.0, 640.0)))
        + " " + " UNION ALL ".join(f"SELECT {e}::DOUBLE AS eps, max(w)::BIGINT AS max_cluster, count(*) FILTER (w >= 2) AS n_ge2, round(sum(CASE WHEN w >= 2 THEN w ELSE 0 END)::DOUBLE / sum(w)::DOUBLE, 4) AS share_ge2, count(*) FILTER (w >= 5) AS n_ge5, round(sum(CASE WHEN w >= 5 THEN w ELSE 0 END)::DOUBLE / sum(w)::DOUBLE, 4) AS share_ge5 FROM c{i}" for i, e in enumerate((160.0, 320.0, 640.0)))),
}
