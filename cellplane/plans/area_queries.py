"""Queries over areas, residues, parks and lists of bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellplane.operators import areas, labels, raster, runs, spatial
from cellplane.operators.validate import aligned, allowed_bands
from cellplane.plans import bands, graph
from cellplane.plans.join_queries import _CAND_CELLS, _HULL, boxes, boxes_sql, hull_mask, spots, spots_sql
from cellplane.plans.placed import GRID, GRID_SQL, VALID_SQL, components_sql, disc_sql, mask, points_sql, read, valid, zones
from cellplane.plans.plane_queries import _CENTRE, _DEM, _TOUCH, dem, shapes
from cellplane.plans.vector_queries import slabs_sql


def coverage(s, d):
    return areas.coverage(shapes(s, d), GRID).withColumns({c: F.round(c, 6) for c in ("vector_m2", "union_m2", "perimeter_m", "halo_eroded_fraction", "threshold_km2", "diff_km2", "halo_largest_ha")})


def _burnt(how, name):
    return f"{name} AS (SELECT DISTINCT g.row, g.col FROM (SELECT poly, {how} FROM b) e JOIN grid g ON g.row BETWEEN e.r0 AND e.r1 AND g.col BETWEEN e.c0 AND e.c1)"


_COVERAGE = f"""WITH RECURSIVE {GRID_SQL}, {boxes_sql('b')}, {_burnt(_TOUCH, 't')}, {_burnt(_CENTRE, 'c')}, halo AS (SELECT * FROM t EXCEPT SELECT * FROM c), {components_sql('halo', 'lab', 4)}, one AS (SELECT 1 AS g, * FROM b), {slabs_sql('one')},
 e AS (SELECT h.* FROM halo h WHERE (SELECT count(*) FROM halo n WHERE abs(n.row - h.row) + abs(n.col - h.col) = 1 AND n.row BETWEEN h.row - 1 AND h.row + 1) = 4),
 v AS (SELECT (SELECT count(*) FROM b) AS n_shapes, (SELECT sum(w * h) FROM b) AS vector_m2, (SELECT area FROM union_m) AS union_m2, (SELECT count(*) FROM t) * 625.0::DOUBLE AS raster_m2, (SELECT perimeter FROM union_m) AS perimeter_m,
  (SELECT count(*) FROM halo) AS halo_cells, (SELECT count(DISTINCT label) FROM lab) AS halo_components, (SELECT coalesce(max(n), 0) FROM (SELECT count(*) AS n FROM lab GROUP BY label)) AS big, (SELECT count(*) FROM e) AS eroded)
 SELECT n_shapes, round(vector_m2, 6) AS vector_m2, round(union_m2, 6) AS union_m2, raster_m2, round(perimeter_m, 6) AS perimeter_m, halo_cells, halo_components, round(big * 0.0625::DOUBLE, 6) AS halo_largest_ha, round(CASE WHEN halo_cells > 0 THEN eroded / halo_cells::DOUBLE ELSE 0 END, 6) AS halo_eroded_fraction,
  round(perimeter_m / 1000 * 0.025::DOUBLE, 6) AS threshold_km2, round((raster_m2 - vector_m2) / 1e6, 6) AS diff_km2, abs((raster_m2 - vector_m2) / 1e6) <= perimeter_m / 1000 * 0.025::DOUBLE AS within FROM v"""


def dissolve(s, d):
    """Boxes united by brand: area and outline of each brand's cells."""
    rows = shapes(s, d).join(read(s, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand")), "id")
    own = areas.dissolved(rows, "brand", GRID)
    size = own.groupBy("brand").agg((F.sum(F.col("c1") - F.col("c0") + 1) * 0.0625).alias("area_ha"))
    return size.join(areas.perimeter(own, "brand", GRID.cell_m), "brand")


_DISSOLVE = f"""WITH {GRID_SQL}, {boxes_sql('b')}, c AS (SELECT DISTINCT p.p_brand AS brand, g.row, g.col FROM (SELECT poly, {_CENTRE} FROM b) e JOIN part p ON p.p_partkey = e.poly JOIN grid g ON g.row BETWEEN e.r0 AND e.r1 AND g.col BETWEEN e.c0 AND e.c1),
 sides AS (SELECT p.brand, count(*) AS n FROM c p JOIN c q ON q.brand = p.brand AND ((q.row = p.row AND q.col = p.col + 1) OR (q.col = p.col AND q.row = p.row + 1)) GROUP BY p.brand)
 SELECT brand, n * 0.0625::DOUBLE AS area_ha, (4 * n - 2 * coalesce(s.m, 0)) * 25.0::DOUBLE AS perimeter_m FROM (SELECT brand, count(*) AS n FROM c GROUP BY brand) LEFT JOIN (SELECT brand, n AS m FROM sides) s USING (brand)"""


def hull_areas(s, d):
    return areas.label_areas(labels.components(hull_mask(s, d), GRID, 8), GRID)


def far_points(s, d):
    at = spots(s, d, "register").select("id", GRID.row(F.col("y")).alias("row"), GRID.col(F.col("x")).alias("col"))
    return areas.farther_than(at, mask("settlement")(s, d), 300, GRID).select("id", "far")


def building_counts(s, d):
    return areas.counts_by_cell(spots(s, d, "candidates"), GRID)


_COUNTS = "n AS (SELECT floor((6400 - y) / 25)::INTEGER AS row, floor(x / 25)::INTEGER AS col, count(*) AS n FROM candidates WHERE floor((6400 - y) / 25) BETWEEN 0 AND 255 AND floor(x / 25) BETWEEN 0 AND 255 GROUP BY ALL)"


def address_clusters(s, d):
    """Components of cells within 75 m of buildings that hold five or more."""
    return areas.weighty_components(areas.counts_by_cell(spots(s, d, "candidates"), GRID), 75, 5, GRID).groupBy("label", "weight").agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("cells"))


def residue_parts(s, d):
    evidence = {"unassigned": runs.dilate(mask("single")(s, d), 75, GRID), "gap": runs.dilate(mask("special")(s, d), 150, GRID), "outside": runs.complement(valid(s), GRID), "classified": runs.dilate(mask("gardens")(s, d), 50, GRID)}
    return areas.residues(runs.dilate(mask("settlement")(s, d), 60, GRID), evidence, GRID)


_RESIDUES = f"""settlement AS ({points_sql('settlement')}), single AS ({points_sql('single')}), special AS ({points_sql('special')}), gardens AS ({points_sql('gardens')}), {disc_sql('settlement', 60, 'rest')}, {components_sql('rest', 'lab', 8)},
 {disc_sql('single', 75, 'u')}, {disc_sql('special', 150, 'g')}, {disc_sql('gardens', 50, 'k')},
 m AS (SELECT l.label, (u.row IS NOT NULL)::INTEGER AS u, (g.row IS NOT NULL)::INTEGER AS g, (NOT (l.row BETWEEN 6 AND 249 AND l.col BETWEEN 6 AND 249))::INTEGER AS o, (k.row IS NOT NULL)::INTEGER AS k
  FROM lab l LEFT JOIN u ON u.row = l.row AND u.col = l.col LEFT JOIN g ON g.row = l.row AND g.col = l.col LEFT JOIN k ON k.row = l.row AND k.col = l.col),
 part AS (SELECT label, count(*) AS cells, avg(u)::DOUBLE AS unassigned, avg(g)::DOUBLE AS gap, avg(o)::DOUBLE AS outside, avg(k)::DOUBLE AS classified FROM m GROUP BY label),
 reasoned AS (SELECT *, CASE WHEN unassigned >= 0.5 THEN 'polygon_exists_without_ns_symbol' WHEN gap >= 0.5 THEN 'inside_dxf_bounds_but_no_polygon' WHEN outside >= 0.5 THEN 'inside_noe_but_outside_current_dkm_coverage'
  WHEN classified >= 0.5 THEN 'classified_in_diagnostics_but_white_in_final' WHEN unassigned + gap >= 0.5 THEN 'mixed_unassigned_and_no_polygon' ELSE 'mixed_or_boundary_raster_effect' END AS reason FROM part)"""
_SHARES = ", ".join(f"round({c}, 9) AS {c}" for c in ("unassigned", "gap", "outside", "classified"))


def residues(s, d):
    return residue_parts(s, d).withColumns({c: F.round(c, 9) for c in ("unassigned", "gap", "outside", "classified")})


CHAIN = 750.0


def turbines(s, d):
    return spots(s, d, "turbines")


def parks(s, d):
    return areas.park_numbers(turbines(s, d), F.col("x") < 4800, CHAIN).select("id", "park")


_PARKS = f"""WITH RECURSIVE {spots_sql('turbines')}, o AS (SELECT * FROM turbines WHERE x < 4800), e AS (SELECT a.id AS s, b.id AS t FROM o a JOIN o b ON a.id <> b.id AND sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= {CHAIN}),
 w(id, label) USING KEY (id) AS (SELECT id, id FROM o UNION SELECT e.t, min(w.label) FROM w JOIN e ON e.s = w.id JOIN recurring.w cur ON cur.id = e.t WHERE w.label < cur.label GROUP BY e.t),
 corner AS (SELECT label, min(x) AS mx, min(y) AS my FROM w JOIN o USING (id) GROUP BY label), nr AS (SELECT label, row_number() OVER (ORDER BY mx, my, label)::INTEGER AS park FROM corner)
 SELECT t.id, coalesce(nr.park, 0) AS park FROM turbines t LEFT JOIN w ON w.id = t.id LEFT JOIN nr ON nr.label = w.label"""


def park_area(s, d):
    """Cells of the park hulls outside the stripe of zone 2, of which SQL has no counterpart."""
    stripe = zones(s, d).filter("zone = 2").select("row", "c0", "c1")
    return runs.to_cells(areas.park_mask(turbines(s, d), stripe, valid(s), GRID, CHAIN))


def left_cover(s, d):
    """Every point with the smallest box over it, null where there is none."""
    return spots(s, d, "addresses").select("id").join(spatial.smallest_cover(spots(s, d, "addresses"), boxes(s, d), 512.0).select("id", "poly"), "id", "left")


def band_alignment(s, d):
    """Bands of a new product against a reference: by name where names are complete and the reference's are unique, else by number."""
    new = read(s, d, "part").selectExpr("cast(p_partkey as int) AS nr", "concat('band ', p_partkey * 3) AS name")
    old = read(s, d, "supplier").selectExpr("cast(s_suppkey as int) AS nr", "concat('band ', s_suppkey * 2) AS name")
    twice = read(s, d, "supplier").selectExpr("cast(s_suppkey as int) AS nr", "concat('band ', s_nationkey) AS name")
    return aligned(new, old).withColumn("case", F.lit("named")).unionByName(aligned(new, twice.unionByName(twice.limit(0))).withColumn("case", F.lit("twice")))


_NEW = "new AS (SELECT p_partkey::INTEGER AS nr, 'band ' || (p_partkey * 3) AS name FROM part)"
_ALIGN = f"""WITH {_NEW}, old AS (SELECT s_suppkey::INTEGER AS nr, 'band ' || (s_suppkey * 2) AS name FROM supplier), twice AS (SELECT s_suppkey::INTEGER AS nr, 'band ' || s_nationkey AS name FROM supplier),
 k AS (SELECT count(*) AS n, count(DISTINCT name) AS u FROM twice)
 SELECT new.nr, new.name, old.nr AS ref_nr, 'named' AS "case" FROM new LEFT JOIN old ON old.name = new.name
 UNION ALL SELECT new.nr, new.name, t.nr, 'twice' FROM new LEFT JOIN twice t ON CASE WHEN (SELECT n = u FROM k) THEN t.name = new.name ELSE t.nr = new.nr END"""


def allowed(s, d):
    """Bands of all impact paths of manifests, whose keys only their suffix tells."""
    doc = F.to_json(F.create_map(F.concat("c_mktsegment", F.lit("_wirkungspfad")), F.array(F.concat(F.lit("b"), F.col("c_custkey") % 50), F.lit("all")), F.concat(F.lit("other_"), F.col("c_mktsegment")), F.array(F.lit("never"))))
    return allowed_bands(read(s, d, "customer").select(doc.alias("doc")), "doc")


def endpoints(s, d):
    nodes = read(s, d, "part").selectExpr("concat('n', p_partkey) AS original", "CASE WHEN p_size % 7 = 0 THEN concat('cfg:k', p_size) ELSE concat('src/n', p_partkey, '.py') END AS id", "concat('f', p_size % 4) AS fragment")
    asked = read(s, d, "events").selectExpr("event_id", "concat('f', user_id % 4) AS fragment", "CASE event_id % 6 WHEN 0 THEN concat('n', user_id) WHEN 1 THEN concat('cfg:key', user_id % 5) WHEN 2 THEN concat('./src/n', user_id, '.py') WHEN 3 THEN 'alias' WHEN 4 THEN 'make:all' ELSE concat('lost', user_id) END AS endpoint")
    return graph.resolved(asked, nodes, s.createDataFrame([("alias", "src/main.py")], "alias string, id string")).select("event_id", "node", "stub")


_ENDPOINTS = """WITH n AS (SELECT 'n' || p_partkey AS original, CASE WHEN p_size % 7 = 0 THEN 'cfg:k' || p_size ELSE 'src/n' || p_partkey || '.py' END AS id, 'f' || (p_size % 4) AS fragment FROM part),
 a AS (SELECT event_id, 'f' || (user_id % 4) AS fragment, CASE event_id % 6 WHEN 0 THEN 'n' || user_id WHEN 1 THEN 'cfg:key' || (user_id % 5) WHEN 2 THEN './src/n' || user_id || '.py' WHEN 3 THEN 'alias' WHEN 4 THEN 'make:all' ELSE 'lost' || user_id END AS endpoint FROM events),
 own AS (SELECT fragment, original, min(id) AS id FROM n GROUP BY ALL), other AS (SELECT original, min(id) AS id FROM n GROUP BY ALL), ids AS (SELECT DISTINCT id FROM n)
 SELECT a.event_id, coalesce(CASE WHEN a.endpoint = 'alias' THEN 'src/main.py' END, own.id, other.id, CASE WHEN a.endpoint LIKE 'cfg:%' OR a.endpoint LIKE 'make:%' OR a.endpoint LIKE 'bin:%' OR a.endpoint LIKE 'layer:%' THEN a.endpoint END, regexp_replace(a.endpoint, '^(\\./)+', '')) AS node,
  a.endpoint <> 'alias' AND own.id IS NULL AND other.id IS NULL AND NOT (a.endpoint LIKE 'cfg:%' OR a.endpoint LIKE 'make:%' OR a.endpoint LIKE 'bin:%' OR a.endpoint LIKE 'layer:%') AND ids.id IS NULL AS stub
 FROM a LEFT JOIN own ON own.fragment = a.fragment AND own.original = a.endpoint LEFT JOIN other ON other.original = a.endpoint LEFT JOIN ids ON ids.id = regexp_replace(a.endpoint, '^(\\./)+', '')"""


def block_reduce(s, d):
    """Average and greatest height of blocks of 8 x 8 cells, and heights with gaps filled by the median."""
    plane = raster.reduced(dem(s), 8)
    return plane.select("row", "col", F.round("average", 6).alias("average"), F.round("greatest", 6).alias("greatest"))


def median_fill(s, d):
    rows = read(s, d, "part").selectExpr("p_partkey", "CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN cast('NaN' AS DOUBLE) ELSE cast(p_retailprice AS DOUBLE) END AS v")
    return raster.median_filled(rows, "v").select("p_partkey", F.round("v", 6).alias("v"))


def pasted(s, d):
    """Codes of tiles at their place in the whole raster; of two tiles the later wins."""
    tiles = read(s, d, "supplier").selectExpr("cast(s_suppkey as int) AS tile", "cast((s_suppkey * 13) % 200 as int) AS row0", "cast((s_suppkey * 29) % 200 as int) AS col0")
    cells = read(s, d, "nation").selectExpr("cast(n_nationkey div 5 as int) AS row", "cast(n_nationkey % 5 as int) AS col", "cast(n_nationkey as int) AS code")
    return raster.pasted(tiles, cells, GRID)


def odd_cells(s, d):
    """Cells that an odd number of boxes covers."""
    from cellplane.operators import rasterise

    return runs.to_cells(runs.odd(runs.clip(rasterise.shape_runs(shapes(s, d), GRID, False), GRID)))


def caveats(s, d):
    return bands.caveat_bands(s)


def newest(s, d):
    """The newest dated file of each kind: the greatest name."""
    return read(s, d, "events").selectExpr("event_type AS kind", "concat('stock_', date_format(ts, 'yyyyMMdd'), '.zip') AS name").groupBy("kind").agg(F.max("name").alias("newest"))


QUERIES = {
    "coverage": (coverage, _COVERAGE),
    "dissolve": (dissolve, _DISSOLVE),
    "hull_areas": (hull_areas, f"WITH RECURSIVE {_HULL} SELECT label, count(*) AS cells, count(*) * 0.0625::DOUBLE AS area_ha, min(col) * 25.0::DOUBLE AS minx, 6400 - (max(row) + 1) * 25.0::DOUBLE AS miny, (max(col) + 1) * 25.0::DOUBLE AS maxx, 6400 - min(row) * 25.0::DOUBLE AS maxy FROM lab GROUP BY label"),
    "farther_than": (far_points, f"WITH settlement AS ({points_sql('settlement')}), {spots_sql('register')}, p AS (SELECT id, floor((6400 - y) / 25)::INTEGER AS row, floor(x / 25)::INTEGER AS col FROM register) SELECT id, row BETWEEN 0 AND 255 AND NOT EXISTS (SELECT 1 FROM settlement c WHERE pow(c.row - p.row, 2) + pow(c.col - p.col, 2) <= 144) AS far FROM p"),
    "building_counts": (building_counts, f"WITH {spots_sql('candidates')}, {_COUNTS} SELECT * FROM n"),
    "address_clusters": (address_clusters, f"WITH RECURSIVE {spots_sql('candidates')}, {_COUNTS}, {disc_sql('n', 75, 'wide')}, {components_sql('wide', 'lab', 8)}, w AS (SELECT label, sum(n)::BIGINT AS weight FROM lab JOIN n USING (row, col) GROUP BY label HAVING sum(n) >= 5) SELECT label, weight, count(*) AS cells FROM lab JOIN w USING (label) GROUP BY ALL"),
    "residues": (residues, f"WITH RECURSIVE {_RESIDUES} SELECT label, cells, {_SHARES}, reason FROM reasoned"),
    "residue_statistics": (lambda s, d: areas.residue_statistics(residue_parts(s, d), GRID), f"WITH RECURSIVE {_RESIDUES} SELECT reason, count(*) AS components, sum(cells)::BIGINT AS cells, sum(cells) * 0.0625::DOUBLE AS area_ha, max(cells) * 0.0625::DOUBLE AS largest_ha FROM reasoned GROUP BY reason"),
    "park_numbers": (parks, _PARKS),
    "park_hulls": (park_area, None),
    "left_cover": (left_cover, f"WITH {spots_sql('addresses')}, {boxes_sql('b')}, c AS (SELECT a.id, b.poly, row_number() OVER (PARTITION BY a.id ORDER BY b.w * b.h, b.poly) AS k FROM addresses a JOIN b ON a.x > b.x AND a.x < b.x + b.w AND a.y > b.y AND a.y < b.y + b.h) SELECT a.id, c.poly FROM addresses a LEFT JOIN c ON c.id = a.id AND c.k = 1"),
    "band_alignment": (band_alignment, _ALIGN),
    "allowed_bands": (allowed, "SELECT DISTINCT 'b' || (c_custkey % 50) AS band_name FROM customer UNION SELECT 'all' FROM customer"),
    "endpoint_resolution": (endpoints, _ENDPOINTS),
    "block_reduce": (block_reduce, f"WITH {_DEM} SELECT (row // 8)::INTEGER AS row, (col // 8)::INTEGER AS col, round(avg(v), 6) AS average, round(max(v), 6)::DOUBLE AS greatest FROM dem GROUP BY ALL"),
    "median_fill": (median_fill, "WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 OR p_partkey % 11 = 0 THEN NULL ELSE p_retailprice::DOUBLE END AS v FROM part) SELECT p_partkey, round(coalesce(v, (SELECT median(v) FROM r)), 6) AS v FROM r"),
    "pasted_tiles": (pasted, "WITH c AS (SELECT s_suppkey AS tile, ((s_suppkey * 13) % 200 + n_nationkey // 5)::INTEGER AS row, ((s_suppkey * 29) % 200 + n_nationkey % 5)::INTEGER AS col, n_nationkey::INTEGER AS code FROM supplier, nation WHERE n_nationkey > 0) SELECT row, col, arg_max(code, tile) AS code FROM c GROUP BY row, col"),
    "odd_cells": (odd_cells, f"WITH {GRID_SQL}, {boxes_sql('b')} SELECT g.row, g.col FROM (SELECT poly, {_CENTRE} FROM b) e JOIN grid g ON g.row BETWEEN e.r0 AND e.r1 AND g.col BETWEEN e.c0 AND e.c1 GROUP BY ALL HAVING count(*) % 2 = 1"),
    "caveat_bands": (caveats, bands.CAVEATS_SQL),
    "newest_file": (newest, "SELECT event_type AS kind, max('stock_' || strftime(ts, '%Y%m%d') || '.zip') AS newest FROM events GROUP BY event_type"),
}
