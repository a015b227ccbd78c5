"""Queries behind reports: bands in their sections, measures against references, drawings on pixels, tile jobs, corner points, symbols."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellplane.operators import cluster, drawing, runs
from cellplane.plans import bands
from cellplane.plans.join_queries import EPS, MIN_PTS, _linked, _pairs, boxes, boxes_sql, hypot, spots, spots_sql
from cellplane.plans.placed import GRID, VALID_SQL, disc_sql, mask, points_sql, read, valid
from cellplane.plans.select_queries import of
from cellplane.sources.files import decode_symbols, symbol_lookup

ROLES = ("bedingung", "aggregat_kategorie", "aggregat_gesamt", "verfuegbarkeit_roh", "verfuegbarkeit_bereinigt", "unschaerfe", "referenz", "offen")


def bands_by_role(s, d):
    """Bands of each role in the order of the roles, those without a band too."""
    rows = bands.catalogue(s).groupBy("role").agg(F.count("*").alias("n"), F.min("nr").alias("first"))
    order = s.createDataFrame([(i, r) for i, r in enumerate(ROLES)], "place int, role string")
    return order.join(rows, "role", "left").select("place", "role", F.coalesce("n", F.lit(0)).alias("n"), "first")


_ROLE = "CASE WHEN band IN ('exclusion_human', 'exclusion_nature', 'exclusion_geography', 'sources_human', 'sources_nature', 'sources_geography') THEN 'aggregat_kategorie' WHEN band = 'all_exclusions' THEN 'aggregat_gesamt' WHEN band = 'available_after_all_exclusions_raw' THEN 'verfuegbarkeit_roh' WHEN starts_with(band, 'available_cleaned_min_') THEN 'verfuegbarkeit_bereinigt' WHEN starts_with(band, 'available_blur_sigma_') THEN 'unschaerfe' WHEN band IN ('official_wind_zoning', 'wka_bestand_ausserhalb_zonen') THEN 'referenz' ELSE 'bedingung' END"
_BANDS = ", ".join(f"('{b}', {i + 1})" for i, b in enumerate(bands.BANDS))
_ROLES = (
    f"WITH b AS (SELECT {_ROLE} AS role, nr FROM (VALUES {_BANDS}) t(band, nr)), o AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{r}')" for i, r in enumerate(ROLES))}) t(place, role)) "
    "SELECT o.place::INTEGER AS place, o.role, count(b.nr) AS n, min(b.nr)::INTEGER AS first FROM o LEFT JOIN b ON b.role = o.role GROUP BY o.place, o.role"
)


def footprints(s, d):
    """The diameter of a disc of the median footprint, by brand."""
    from cellplane.operators import spatial

    rows = boxes(s, d).join(read(s, d, "part").select(F.col("p_partkey").alias("poly"), F.col("p_brand").alias("brand")), "poly")
    return rows.groupBy("brand").agg(F.round(2 * F.sqrt(F.median(spatial.area(F.col("rings"))) / F.pi()), 6).alias("diameter"))


def reference_overlap(s, d):
    """What a mask covers of a target, misses of it, adds to what is fair beyond the official zones, and excludes, in km2; one sweep."""
    masks = {"ours": runs.clip(runs.widened(mask("settlement")(s, d), GRID.radius(150)), GRID), "target": runs.clip(runs.widened(mask("single")(s, d), GRID.radius(100)), GRID), "official": runs.clip(runs.widened(mask("special")(s, d), GRID.radius(200)), GRID), "fair": valid(s)}
    on = runs.coincident(masks)
    n = lambda c, name: F.coalesce(F.sum(F.when(F.expr(c), F.col("width"))), F.lit(0)).alias(name)
    r = on.agg(n("target", "t"), n("ours and target", "c"), n("ours and fair and not official", "e"), n("ours and fair", "x"))
    km2 = lambda c: F.round(F.expr(c) * 0.000625, 6)
    return r.select(F.round(100.0 * F.col("c") / F.greatest("t", F.lit(1)), 6).alias("covered_percent"), km2("t - c").alias("missed_km2"), km2("e").alias("extra_km2"), km2("x").alias("excluded_km2"))


_OVERLAP = f"""WITH settlement AS ({points_sql('settlement')}), single AS ({points_sql('single')}), special AS ({points_sql('special')}), {disc_sql('settlement', 150, 'o')}, {disc_sql('single', 100, 't')}, {disc_sql('special', 200, 'a')},
 n AS (SELECT (SELECT count(*) FROM t) AS t, (SELECT count(*) FROM t JOIN o USING (row, col)) AS c, (SELECT count(*) FROM (SELECT * FROM o WHERE {VALID_SQL} EXCEPT SELECT * FROM a)) AS e, (SELECT count(*) FROM o WHERE {VALID_SQL}) AS x)
 SELECT round(100.0::DOUBLE * c / greatest(t, 1), 6) AS covered_percent, round((t - c) * 0.000625::DOUBLE, 6) AS missed_km2, round(e * 0.000625::DOUBLE, 6) AS extra_km2, round(x * 0.000625::DOUBLE, 6) AS excluded_km2 FROM n"""


def linkage(s, d):
    """Chains against DBSCAN at one distance: clusters, the largest, and points in clusters of five or more."""
    points = spots(s, d, "turbines")
    single = cluster.eps_components(points, EPS).select(F.lit("chain").alias("how"), "cluster")
    dense = cluster.dbscan(points, EPS, MIN_PTS).filter("cluster is not null").select(F.lit("dbscan").alias("how"), "cluster")
    sizes = single.unionByName(dense).groupBy("how", "cluster").agg(F.count("*").alias("n"))
    return sizes.groupBy("how").agg(F.count("*").alias("clusters"), F.max("n").alias("largest"), F.coalesce(F.sum(F.when(F.col("n") >= 5, F.col("n"))), F.lit(0).cast("long")).alias("in_large"))


_LINKAGE = f"""WITH RECURSIVE {_pairs('turbines', EPS)}, {_linked('turbines', 'e', 'w')}, core AS (SELECT id FROM (SELECT c.id, count(e.t) + 1 AS n FROM turbines c LEFT JOIN e ON e.s = c.id GROUP BY c.id) WHERE n >= {MIN_PTS}),
 ce AS (SELECT s, t FROM e WHERE s IN (SELECT id FROM core) AND t IN (SELECT id FROM core)), {_linked('core', 'ce', 'v')}, border AS (SELECT e.s AS id, min(v.label) AS near FROM e JOIN v ON v.id = e.t GROUP BY e.s),
 d AS (SELECT coalesce(v.label, b.near) AS label FROM turbines c LEFT JOIN v ON v.id = c.id LEFT JOIN border b ON b.id = c.id),
 n AS (SELECT 'chain' AS how, label, count(*) AS n FROM w GROUP BY label UNION ALL SELECT 'dbscan', label, count(*) FROM d WHERE label IS NOT NULL GROUP BY label)
 SELECT how, count(*) AS clusters, max(n) AS largest, coalesce(sum(CASE WHEN n >= 5 THEN n END), 0)::BIGINT AS in_large FROM n GROUP BY how"""

PATH = "l_orderkey, l_linenumber, l_partkey * 7 AS x0, l_suppkey * 11 AS y0, l_linenumber * 9 AS step"


def pixels(s, d):
    """Lines on a drawing of 25 m a pixel, without repeats one after another."""
    rows = of(s, d, "lineitem", PATH)
    points = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.struct((F.col("x0") + i * F.col("step")).cast("double").alias("x"), (F.col("y0") - i * 4).cast("double").alias("y")))
    path = drawing.pixels(points, 100.0, 90_000.0, 25.0)
    return rows.select("l_orderkey", "l_linenumber", F.array_join(F.transform(path, lambda p: F.concat_ws(":", p["px"].cast("string"), p["py"].cast("string"))), " ").alias("path"))


_PIXELS = f"""WITH p AS (SELECT *, [round_even((x0 + i * step - 100.0::DOUBLE) / 25, 0)::INTEGER || ':' || round_even((90000.0::DOUBLE - (y0 - i * 4)) / 25, 0)::INTEGER FOR i IN range(0, 8)] AS q FROM (SELECT {PATH} FROM lineitem))
 SELECT l_orderkey, l_linenumber, array_to_string([q[i] FOR i IN range(1, 9) IF i = 1 OR q[i] <> q[i - 1]], ' ') AS path FROM p"""


def tile_jobs(s, d):
    """Files of each tile of 1024 m: those whose bounds meet the tile or its halo of 100 m, edges included."""
    from cellplane.operators import spatial

    rows = boxes(s, d).select("poly", spatial.bounds(F.col("rings")).alias("b")).select("poly", "b.*")
    return drawing.tile_jobs(rows, 0.0, 0.0, 1024.0, 100.0, 7, 7).groupBy("tx", "ty").agg(F.count("*").alias("files"), F.min("poly").alias("first"))


_TILES = f"WITH {boxes_sql('b')} SELECT tx::INTEGER AS tx, ty::INTEGER AS ty, count(*) AS files, min(poly) AS first FROM b, range(0, 7) p(tx), range(0, 7) q(ty) WHERE x <= (tx + 1) * 1024 + 100 AND x + w >= tx * 1024 - 100 AND y <= (ty + 1) * 1024 + 100 AND y + h >= ty * 1024 - 100 GROUP BY ALL"

MEASURE = "p_partkey, CASE p_partkey % 5 WHEN 0 THEN concat('<< /GPTS [48.', p_size, ' 15.1 49 15 ', p_size, ' 16.5 48 16 ] >>') WHEN 1 THEN '<< /GPTS [1 2 3] >>' ELSE '<< /Other 3 >>' END AS text"
DEFAULT = ((48.0, 15.0), (49.0, 15.0), (49.0, 16.0), (48.0, 16.0))


def corners(s, d):
    """The four corner points that a drawing's dictionary states, fixed ones where it does not state four."""
    found = drawing.corner_points(F.col("text"), DEFAULT)
    return of(s, d, "part", MEASURE).select("p_partkey", *[F.get(found, i)[c].alias(f"{c}{i}") for i in (0, 2) for c in ("lat", "lon")])


_CORNERS = """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN ('48.' || p_size)::DOUBLE ELSE 48.0::DOUBLE END AS lat0, CASE p_partkey % 5 WHEN 0 THEN 15.1::DOUBLE ELSE 15.0::DOUBLE END AS lon0,
 CASE p_partkey % 5 WHEN 0 THEN p_size::DOUBLE ELSE 49.0::DOUBLE END AS lat2, CASE p_partkey % 5 WHEN 0 THEN 16.5::DOUBLE ELSE 16.0::DOUBLE END AS lon2 FROM part"""

SYMBOLS = (("NS", "FIG41", "Gebäude", "Haus", "1"), ("NS", " fig052 ", "Garten (historisch)", "", "7"), ("NS", "X9", " ", "Wald", "56"), ("XX", "FIG60", "nie", "", "3"))


def cadastre_rows(s, d):
    """Rows of a cadastre: an id of province, layer, municipality and row, and the category of the code by symbol, code and historic code."""
    rows = of(s, d, "lineitem", "concat('Tirol:NFL_V2:', l_suppkey, ':', l_orderkey, '-', l_linenumber) AS id, CASE l_linenumber % 7 WHEN 0 THEN 'fig41' WHEN 1 THEN '0052.0' WHEN 2 THEN '56' WHEN 3 THEN 'FIG60' WHEN 4 THEN ' ' WHEN 5 THEN 'x9' END AS code")
    table = s.createDataFrame(list(SYMBOLS), "layer string, symbol string, kategorie string, bezeichnung string, vermv10_nr string")
    return decode_symbols(rows, "code", symbol_lookup(table)).groupBy("code", "ns", "category").agg(F.count("*").alias("n"), F.min("id").alias("first"))


_CADASTRE = """WITH r AS (SELECT 'Tirol:NFL_V2:' || l_suppkey || ':' || l_orderkey || '-' || l_linenumber AS id, l_linenumber % 7 AS k FROM lineitem), c AS (SELECT * FROM (VALUES (0, 'fig41', '41', 'Gebäude'), (1, '0052.0', '52', 'Garten'), (2, '56', 'X9', 'Unbekannt'), (3, 'FIG60', '60', 'Unbekannt'), (4, ' ', NULL, NULL), (5, 'x9', 'X9', 'Unbekannt'), (6, NULL, NULL, NULL)) t(k, code, ns, category))
 SELECT c.code, c.ns, c.category, count(*) AS n, min(r.id) AS first FROM r JOIN c USING (k) GROUP BY ALL"""

QUERIES = {
    "bands_by_role": (bands_by_role, _ROLES),
    "manifest_bands": (lambda s, d: bands.entries(s), bands.ENTRIES_SQL),
    "footprint_diameter": (footprints, f"WITH {boxes_sql('b')} SELECT p.p_brand AS brand, round(2 * sqrt(median(b.w * b.h) / pi()), 6) AS diameter FROM b JOIN part p ON p.p_partkey = b.poly GROUP BY p.p_brand"),
    "reference_overlap": (reference_overlap, _OVERLAP),
    "linkage_comparison": (linkage, _LINKAGE),
    "pixel_paths": (pixels, _PIXELS),
    "tile_jobs": (tile_jobs, _TILES),
    "corner_points": (corners, _CORNERS),
    "cadastre_rows": (cadastre_rows, _CADASTRE),
}
