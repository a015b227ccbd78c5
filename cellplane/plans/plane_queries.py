"""Queries over planes, shapes on the grid, lineage and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellplane.functions import projection
from cellplane.functions.grid import GridSpec, disc
from cellplane.operators import raster, rasterise, runs, spatial, validate
from cellplane.plans import bands
from cellplane.plans.join_queries import boxes, boxes_sql, spots, spots_sql
from cellplane.plans.placed import GRID, GRID_SQL, components_sql, mask, points_sql, read, zones, ZONES_SQL
from cellplane.scratch import materialise

HEIGHT = "(row * 13 + col * 7 + (row * col) % 101) % 400"


def dem(spark):
    cells = spark.range(256 * 256).selectExpr("cast(id div 256 as int) as row", "cast(id % 256 as int) as col")
    return cells.selectExpr("row", "col", f"cast({HEIGHT} as double) as v")


_DEM = f"{GRID_SQL}, dem AS (SELECT row, col, ({HEIGHT})::DOUBLE AS v FROM grid)"
_BLOCKS = f"{_DEM}, blocks AS (SELECT (row // 4)::INTEGER AS row, (col // 4)::INTEGER AS col, avg(v) AS v FROM dem GROUP BY ALL)"
_AT = lambda dr, dc: f"(SELECT v FROM blocks n WHERE n.row = least(greatest(b.row + {dr}, 0), 63) AND n.col = least(greatest(b.col + {dc}, 0), 63))"
_SLOPE = (
    f"{_BLOCKS}, grad AS (SELECT row, col, {' + '.join(f'({dc} * {2 - abs(dr)}) * {_AT(dr, dc)}' for dr in (-1, 0, 1) for dc in (-1, 1))} AS gx, "
    f"{' + '.join(f'({dr} * {2 - abs(dc)}) * {_AT(dr, dc)}' for dr in (-1, 1) for dc in (-1, 0, 1))} AS gy FROM blocks b), slopes AS (SELECT row, col, sqrt(gx * gx + gy * gy) / 800 * 100 AS slope FROM grad)"
)


def slopes(s, d):
    return raster.slope_percent(raster.block_mean(dem(s), 4, GRID), 64, 64, 100.0)


def thresholds(s, d):
    """Missing height and power come from cells whose numbers divide by 11 and 7."""
    blocks = slopes(s, d).withColumnsRenamed({"row": "br", "col": "bc"})
    cells = dem(s).withColumns({"br": F.expr("cast(row div 4 as int)"), "bc": F.expr("cast(col div 4 as int)")}).join(blocks, ["br", "bc"])
    cells = cells.selectExpr("row", "col", "slope", "CASE WHEN (row + col) % 11 = 0 THEN NULL ELSE v END AS height", "CASE WHEN (row * 3 + col) % 7 = 0 THEN double('NaN') ELSE v END AS power")
    out = raster.terrain_masks(cells, 26.79491924311227, 250.0, raster.shear(150, 130, 150))
    return out.agg(*[F.count_if(F.col(c)).alias(c) for c in ("too_steep", "too_high", "too_calm")])


_W = raster.kernel(4.0)
_BLUR = (
    f"{GRID_SQL}, m AS ({points_sql('settlement')}), w(o, w) AS (VALUES {', '.join(f'({o}, {w[0]!r}::DOUBLE)' for o, w in _W.items())}), "
    "ghost AS (SELECT m.row, m.col, g.r FROM m, LATERAL (SELECT unnest([m.row, -1 - m.row, 511 - m.row]) AS r) g), "
    "a AS (SELECT g.col, g.r - w.o AS row, sum(w.w) AS v FROM ghost g, w WHERE g.r - w.o BETWEEN 0 AND 255 GROUP BY ALL), "
    "ghost2 AS (SELECT a.row, a.v, g.c FROM a, LATERAL (SELECT unnest([a.col, -1 - a.col, 511 - a.col]) AS c) g), "
    "b AS (SELECT g.row, g.c - w.o AS col, sum(w.w * g.v) AS v FROM ghost2 g, w WHERE g.c - w.o BETWEEN 0 AND 255 GROUP BY ALL)"
)


def shapes(s, d):
    return boxes(s, d).select(F.col("poly").alias("id"), F.lit("polygon").alias("kind"), "rings")


_TOUCH = "floor((6400 - (y + h)) / 25) AS r0, floor((6400 - y) / 25) AS r1, floor(x / 25) AS c0, floor((x + w) / 25) AS c1"
_CENTRE = "ceil((6400 - (y + h)) / 25 - 0.5) AS r0, ceil((6400 - y) / 25 - 0.5) - 1 AS r1, ceil(x / 25 - 0.5) AS c0, ceil((x + w) / 25 - 0.5) - 1 AS c1"


def _burnt_sql(how):
    return f"{GRID_SQL}, {boxes_sql('b')}, e AS (SELECT poly, {how} FROM b), burnt AS (SELECT DISTINCT g.row, g.col FROM e JOIN grid g ON g.row BETWEEN e.r0 AND e.r1 AND g.col BETWEEN e.c0 AND e.c1)"


def painted(s, d):
    order = read(s, d, "part").selectExpr("cast(p_partkey as long) as id", "p_size as prio", "p_brand as code")
    return rasterise.coded(shapes(s, d).join(order, "id"), GRID, "prio", "code")


def lines(s, d):
    """Level lines from each turbine to the east, 400 m long."""
    p = spots(s, d, "turbines").withColumns({"x": F.col("x") + 0.5, "y": F.col("y") + 0.5})
    point = lambda x: F.struct(x.alias("x"), F.col("y").alias("y"))
    return runs.to_cells(rasterise.burnt(p.select("id", F.lit("line").alias("kind"), F.array(F.array(point(F.col("x")), point(F.col("x") + 400))).alias("rings")), GRID))


def wedges(s, d):
    p = spots(s, d, "turbines")
    rim = spatial.corridor(F.col("x"), F.col("y"), F.radians(F.col("id") % 360))
    return p.select("id", F.posexplode(F.get(rim, 0)).alias("i", "p")).select("id", F.col("i").cast("int").alias("i"), F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"))


def shape_measures(s, d):
    one = boxes(s, d)
    ring = F.get("rings", 0)
    return one.select("poly", spatial.area(F.col("rings")).alias("area"), spatial.length(F.concat(ring, F.slice(ring, 1, 1))).alias("perimeter"), F.round(spatial.centroid(ring)["x"], 6).alias("cx"), F.round(spatial.centroid(ring)["y"], 6).alias("cy"))


SHIFTED = GridSpec(100, 100, 40.0, 130.0, 6250.0)


def resample(s, d):
    return raster.resampled(dem(s), GRID, SHIFTED, F.col("tx"), F.col("ty")).select("row", "col", F.round("v", 6).alias("v"))


def _cut(df):
    return materialise(df, "impact")


def impact_paths(s, d):
    edges = bands.derived_edges(s)
    roots = {"water": s.createDataFrame([("geography_water_bodies",)], "band string"), "cadastre": bands.source_edges(s).filter(F.col("source") == bands.CADASTRE).select("band"), "cableway": s.createDataFrame([(r,) for r in bands.CABLEWAY_ROOTS], "band string")}
    out = None
    for name, r in roots.items():
        one = bands.impact(edges, r, _cut).select(F.lit(name).alias("path"), "band")
        out = one if out is None else out.unionByName(one)
    return out


def _values(rows):
    return ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in r) + ")" for r in rows)


_EDGES = [(x, b) for b, srcs in bands.DERIVED.items() for x in srcs] + [(bands.RAW, n) for n in bands.BANDS if n.startswith(("available_cleaned_min_", "available_blur_sigma_"))]
_ROOTS = [("water", "geography_water_bodies"), *[("cadastre", b) for b, k in bands.SOURCES.items() if bands.CADASTRE in k], *[("cableway", r) for r in bands.CABLEWAY_ROOTS]]


def degrees(s, d):
    """In- and out-degree of every band, and whether nothing reads it."""
    edges = bands.derived_edges(s)
    ends = edges.select(F.col("src").alias("band"), F.lit(1).alias("o"), F.lit(0).alias("i")).union(edges.select("dst", F.lit(0), F.lit(1)))
    sums = ends.groupBy("band").agg(F.sum("i").alias("i"), F.sum("o").alias("o"))
    return bands.catalogue(s).select("nr", "band").join(sums, "band", "left").select("nr", "band", F.coalesce("i", F.lit(0)).alias("in_degree"), F.coalesce("o", F.lit(0)).alias("out_degree"), (F.coalesce("o", F.lit(0)) == 0).alias("dead_end"))


def manifest_checks(s, d):
    """Findings on a foreign manifest: gaps in numbers, names twice or empty, references to nothing. Bands and references come from parts and suppliers."""
    rows = read(s, d, "part").selectExpr("p_partkey as nr", "CASE WHEN p_partkey % 17 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN 'twice' ELSE p_name || p_partkey END AS name", "p_size * 7 AS dep")
    count = rows.agg(F.count("*").alias("n"), F.max("nr").alias("top"), F.countDistinct("name").alias("names"), F.count_if(F.col("name") == "").alias("empty"))
    dangling = rows.join(rows.select(F.col("nr").alias("dep")), "dep", "left_anti").agg(F.count("*").alias("dangling"))
    return count.crossJoin(dangling).select((F.col("n") != F.col("top")).alias("gaps"), (F.col("names") < F.col("n")).alias("repeats"), (F.col("empty") > 0).alias("nameless"), "dangling")


def edge_merge(s, d):
    """Edges of several fragments merged: optional only if all say so, evidence and sources distinct and in order."""
    rows = read(s, d, "events").selectExpr("user_id % 7 AS src", "user_id % 5 AS dst", "event_type AS kind", "value > 50 AS optional", "event_id % 3 AS fragment")
    return rows.groupBy("src", "dst", "kind").agg(F.expr("bool_and(optional)").alias("optional"), F.array_join(F.transform(F.array_sort(F.collect_set("fragment")), lambda x: x.cast("string")), ",").alias("sources"), F.count("*").alias("n"))


def old_mask(s, d):
    """The settlement mask of an earlier state: one supplier in five stood a column to the right."""
    return runs.from_cells(read(s, d, "supplier").selectExpr("cast((s_suppkey * 97 + s_nationkey * 5) % 256 as int) as row", "cast((s_suppkey * 31 + s_nationkey * 11 + case when s_suppkey % 5 = 0 then 1 else 0 end) % 256 as int) as col").distinct())


def diff_metrics(s, d):
    return validate.band_diff(mask("settlement")(s, d), old_mask(s, d), zones(s, d), GRID)


RESULT = "s_suppkey AS band_nr, 'band' || s_suppkey AS band_name, CASE s_suppkey % 4 WHEN 0 THEN 'bedingung' WHEN 1 THEN 'referenz' WHEN 2 THEN 'unschaerfe' ELSE 'aggregat_gesamt' END AS role, (s_suppkey * 37) % 11 AS pixel_abs, (s_suppkey % 13) / 100.0 AS anteil_prozent, (s_suppkey % 30) / 1.0 AS groesste_flaeche_ha, (s_suppkey % 15) / 1.0 AS flaeche_km2, 'Wien' AS schwerpunkt_bundesland, s_suppkey % 9 = 0 AS ohne_gegenstueck"


def results(s, d):
    rows = s.sql(f"SELECT {RESULT} FROM {{supplier}}", supplier=read(s, d, "supplier"))
    return rows.withColumns({c: F.col(c).cast("double") for c in ("anteil_prozent", "groesste_flaeche_ha", "flaeche_km2")})


def allowed(s, d):
    return read(s, d, "supplier").filter("s_suppkey % 6 <> 5").selectExpr("concat('band', s_suppkey) as band_name")


def traffic(s, d):
    return validate.classified(results(s, d), allowed(s, d)).select("band_nr", "band_name", "ampel", "unerwartet")


def register(s, d):
    rows = read(s, d, "supplier").selectExpr("CASE WHEN s_suppkey % 3 = 0 THEN 'W1' ELSE 'W2' END AS paket", "cast(s_suppkey as string) AS band_nr", "concat('band', s_suppkey) AS band_name", "'5' AS pixel_abs", "'0.0100' AS anteil_prozent", "'1.0000' AS groesste_flaeche_ha", "'Tirol' AS schwerpunkt_bundesland", "'rot' AS ampel",
        f"CASE s_suppkey % 4 WHEN 0 THEN 'Angenommen (Punkt 33)' ELSE '{validate.TODO}' END AS ursache")
    return validate.upserted(rows, "W2", results(s, d), allowed(s, d))


_CLASSIFIED = f"""r AS (SELECT {RESULT} FROM supplier), c AS (SELECT *, pixel_abs <> 0 AND NOT ohne_gegenstueck AND band_nr % 6 = 5 AS unerwartet FROM r),
 l AS (SELECT *, CASE WHEN ohne_gegenstueck THEN 'ohne_gegenstueck' WHEN pixel_abs = 0 THEN 'bitgleich' WHEN unerwartet OR role = 'referenz' THEN 'rot'
  WHEN role = 'bedingung' THEN CASE WHEN anteil_prozent <= 0.01 AND groesste_flaeche_ha <= 1 THEN 'gruen' WHEN anteil_prozent <= 0.1 AND groesste_flaeche_ha <= 25 THEN 'gelb' ELSE 'rot' END
  WHEN flaeche_km2 <= 1 THEN 'gruen' WHEN flaeche_km2 <= 10 THEN 'gelb' ELSE 'rot' END AS ampel FROM c)"""
_REGISTER = f"""WITH {_CLASSIFIED}, old AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'W1' ELSE 'W2' END AS paket, s_suppkey AS nr, CASE s_suppkey % 4 WHEN 0 THEN 'Angenommen (Punkt 33)' ELSE '{validate.TODO}' END AS ursache FROM supplier)
 SELECT paket, nr::VARCHAR AS band_nr, 'band' || nr AS band_name, '5' AS pixel_abs, '0.0100' AS anteil_prozent, '1.0000' AS groesste_flaeche_ha, 'Tirol' AS schwerpunkt_bundesland, 'rot' AS ampel, ursache FROM old WHERE paket <> 'W2'
 UNION ALL SELECT 'W2', band_nr::VARCHAR, band_name, pixel_abs::VARCHAR, printf('%.4f', anteil_prozent::DOUBLE), printf('%.4f', groesste_flaeche_ha::DOUBLE), schwerpunkt_bundesland,
  CASE WHEN o.ursache LIKE 'Angenommen%' AND NOT unerwartet AND ampel = 'rot' THEN 'akzeptiert' ELSE ampel END,
  CASE WHEN unerwartet THEN '{validate.UNEXPECTED}' WHEN o.ursache IS NOT NULL AND o.ursache <> '{validate.TODO}' THEN o.ursache WHEN ohne_gegenstueck THEN '{validate.NO_COUNTERPART}' ELSE '{validate.TODO}' END
 FROM l LEFT JOIN (SELECT * FROM old WHERE paket = 'W2') o ON o.nr = l.band_nr WHERE pixel_abs > 0 OR ohne_gegenstueck"""
_DIFF = f"""WITH RECURSIVE a AS ({points_sql('settlement')}), b AS (SELECT DISTINCT ((s_suppkey * 97 + s_nationkey * 5) % 256)::INTEGER AS row, ((s_suppkey * 31 + s_nationkey * 11 + CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END) % 256)::INTEGER AS col FROM supplier),
 diff AS ((SELECT * FROM a EXCEPT SELECT * FROM b) UNION (SELECT * FROM b EXCEPT SELECT * FROM a)), {components_sql('diff', 'lab', 4)}, {ZONES_SQL}, where_ AS (SELECT z.zone, count(*) AS n FROM diff d JOIN zones z ON d.col BETWEEN z.c0 AND z.c1 GROUP BY z.zone),
 t AS (SELECT (SELECT count(*) FROM diff) AS p, (SELECT count(*) FROM b) AS r, (SELECT coalesce(max(n), 0) FROM (SELECT count(*) AS n FROM lab GROUP BY label)) AS big)
 SELECT p AS pixel_abs, r AS reference_cells, CASE WHEN p = 0 THEN 0.0::DOUBLE WHEN r = 0 THEN 'inf'::DOUBLE ELSE 100.0::DOUBLE * p / r END AS share_percent, 100.0::DOUBLE * p / 65536 AS grid_percent, big * 0.0625::DOUBLE AS largest_ha, p * 0.0625::DOUBLE / 100 AS km2, (SELECT zone FROM where_ ORDER BY n DESC, zone LIMIT 1) AS zone FROM t"""

QUERIES = {
    "block_mean": (lambda s, d: raster.block_mean(dem(s), 4, GRID), f"WITH {_BLOCKS} SELECT * FROM blocks"),
    "slope_sobel": (lambda s, d: slopes(s, d).select("row", "col", F.round("slope", 6).alias("slope")), f"WITH {_SLOPE} SELECT row, col, round(slope, 6) AS slope FROM slopes"),
    "threshold_nan_rules": (thresholds, f"WITH {_SLOPE} SELECT count(*) FILTER (slope > 26.79491924311227) AS too_steep, count(*) FILTER ((d.row + d.col) % 11 <> 0 AND v > 250) AS too_high, count(*) FILTER ((d.row * 3 + d.col) % 7 = 0 OR v < {raster.shear(150, 130, 150)!r}) AS too_calm FROM dem d JOIN slopes s ON s.row = d.row // 4 AND s.col = d.col // 4"),
    "blur_sigma": (lambda s, d: raster.blur_percent(runs.to_cells(mask("settlement")(s, d)), 100, GRID), f"WITH {_BLUR} SELECT row::INTEGER AS row, col::INTEGER AS col, least(100, greatest(0, round_even(round(v * 100, 9), 0)))::INTEGER AS percent FROM b WHERE round_even(round(v * 100, 9), 0) > 0"),
    "decimate_plane": (lambda s, d: raster.decimated(dem(s), 8), f"WITH {_DEM} SELECT (row // 8)::INTEGER AS row, (col // 8)::INTEGER AS col, v FROM dem WHERE row % 8 = 0 AND col % 8 = 0"),
    "resample_bilinear": (resample, f"""WITH {_DEM}, t AS (SELECT a.r::INTEGER AS row, b.c::INTEGER AS col, (130 + (b.c + 0.5) * 40) / 25 - 0.5 AS fc, (6400 - (6250 - (a.r + 0.5) * 40)) / 25 - 0.5 AS fr FROM range(0, 100) a(r), range(0, 100) b(c)),
        k AS (SELECT t.row, t.col, floor(fr) + i.i AS sr, floor(fc) + j.j AS sc, ((1 - abs(fr - floor(fr) - i.i)) * (1 - abs(fc - floor(fc) - j.j)))::DOUBLE AS w FROM t, range(0, 2) i(i), range(0, 2) j(j))
        SELECT k.row, k.col, round(sum(w * v) / sum(w), 6) AS v FROM k JOIN dem d ON d.row = sr AND d.col = sc WHERE w > 0 GROUP BY k.row, k.col"""),
    "rasterize_rects": (lambda s, d: runs.to_cells(rasterise.burnt(shapes(s, d), GRID)), f"WITH {_burnt_sql(_TOUCH)} SELECT * FROM burnt"),
    "rasterize_centres": (lambda s, d: runs.to_cells(rasterise.burnt(shapes(s, d), GRID, all_touched=False)), f"WITH {_burnt_sql(_CENTRE)} SELECT * FROM burnt"),
    "rasterize_buffered": (lambda s, d: runs.to_cells(rasterise.burnt(shapes(s, d), GRID, 100.0)), f"""WITH {GRID_SQL}, {boxes_sql('b')}, e AS (SELECT poly, {_TOUCH} FROM b), k(dr, w) AS (VALUES {', '.join(f'({dr}, {w})' for dr, w in disc(4.0))}),
        n AS (SELECT r0 - 4 AS r0, r1 + 4 AS r1, c0, c1, e.r0 AS a, e.r1 AS z FROM e) SELECT DISTINCT g.row, g.col FROM n JOIN grid g ON g.row BETWEEN n.r0 AND n.r1 JOIN k ON k.dr = CASE WHEN g.row < n.a THEN g.row - n.a WHEN g.row > n.z THEN g.row - n.z ELSE 0 END WHERE g.col BETWEEN n.c0 - k.w AND n.c1 + k.w"""),
    "rasterize_lines": (lines, f"WITH {GRID_SQL}, {spots_sql('turbines')} SELECT DISTINCT g.row, g.col FROM turbines t JOIN grid g ON g.row = floor((6400 - t.y - 0.5) / 25) AND g.col BETWEEN floor((t.x + 0.5) / 25) AND floor((t.x + 400.5) / 25)"),
    "painters_order": (painted, f"WITH {GRID_SQL}, {boxes_sql('b')}, e AS (SELECT poly, {_CENTRE} FROM b) SELECT g.row, g.col, max_by(p.p_brand, p.p_size::BIGINT * 100000000 + p.p_partkey) AS code FROM e JOIN grid g ON g.row BETWEEN e.r0 AND e.r1 AND g.col BETWEEN e.c0 AND e.c1 JOIN part p ON p.p_partkey = e.poly GROUP BY g.row, g.col"),
    "shape_measures": (shape_measures, f"WITH {boxes_sql('b')} SELECT poly, w * h AS area, 2 * (w + h) AS perimeter, round(x + w / 2, 6) AS cx, round(y + h / 2, 6) AS cy FROM b"),
    "corridor_wedge": (wedges, f"""WITH {spots_sql('turbines')}, a AS (SELECT id, x, y, i::INTEGER AS i, radians(id % 360) - radians(15) + (i - 1) * radians(15) / 6 AS t FROM turbines, range(0, 14) r(i))
        SELECT id, i, round(CASE WHEN i = 0 THEN x ELSE x + 5000 * cos(t) END, 4) AS x, round(CASE WHEN i = 0 THEN y ELSE y + 5000 * sin(t) END, 4) AS y FROM a"""),
    "web_mercator": (lambda s, d: spots(s, d, "turbines").select("id", (F.col("x") / 640 + 9).alias("lon"), (F.col("y") / 2133 + 46).alias("lat")).select("id", F.round(projection.mercator_x(F.col("lon")), 3).alias("x"), F.round(projection.mercator_y(F.col("lat")), 3).alias("y")),
        f"WITH {spots_sql('turbines')} SELECT id, round(6378137.0::DOUBLE * radians(x / 640 + 9), 3) AS x, round(6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(y / 2133 + 46) / 2)), 3) AS y FROM turbines"),
    "lambert_grid": (lambda s, d: projection.check_points(s), None),
    "impact_path": (impact_paths, f"WITH RECURSIVE e(src, dst) AS (VALUES {_values(_EDGES)}), r(path, band) AS (VALUES {_values(_ROOTS)}), w(path, band) AS (SELECT * FROM r UNION SELECT w.path, e.dst FROM w JOIN e ON e.src = w.band) SELECT * FROM w"),
    "degree_flags": (degrees, f"WITH e(src, dst) AS (VALUES {_values(_EDGES)}), b(nr, band) AS (VALUES {_values(list(enumerate(bands.BANDS, 1)))}) SELECT nr, band, (SELECT count(*) FROM e WHERE dst = band) AS in_degree, (SELECT count(*) FROM e WHERE src = band) AS out_degree, NOT EXISTS (SELECT 1 FROM e WHERE src = band) AS dead_end FROM b"),
    "band_catalogue": (lambda s, d: bands.catalogue(s), None),
    "manifest_validation": (manifest_checks, """WITH r AS (SELECT p_partkey AS nr, CASE WHEN p_partkey % 17 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN 'twice' ELSE p_name || p_partkey END AS name, p_size * 7 AS dep FROM part)
        SELECT count(*) <> max(nr) AS gaps, count(DISTINCT name) < count(*) AS repeats, count(*) FILTER (name = '') > 0 AS nameless, (SELECT count(*) FROM r x WHERE x.dep NOT IN (SELECT nr FROM r)) AS dangling FROM r"""),
    "edge_merge": (edge_merge, "SELECT src, dst, kind, bool_and(optional) AS optional, string_agg(DISTINCT fragment::VARCHAR, ',' ORDER BY fragment::VARCHAR) AS sources, count(*) AS n FROM (SELECT user_id % 7 AS src, user_id % 5 AS dst, event_type AS kind, value > 50 AS optional, event_id % 3 AS fragment FROM events) GROUP BY src, dst, kind"),
    "diff_metrics": (diff_metrics, _DIFF),
    "traffic_light": (traffic, f"WITH {_CLASSIFIED} SELECT band_nr, band_name, ampel, unerwartet FROM l"),
    "register_upsert": (register, _REGISTER),
}
