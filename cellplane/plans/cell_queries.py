"""Queries over masks: set algebra, buffers, closing, components, composition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellplane.operators import labels, runs
from cellplane.plans.placed import GRID, GRID_SQL, VALID_SQL, ZONES_SQL, components_sql, disc_sql, mask, points, points_sql, valid, zones

#: Zone 1 has the greater distance.
ZONE_METRES, OTHER_METRES = {1: 300.0}, 250.0
CELLS = "SELECT row, col FROM "


def cells(df: DataFrame) -> DataFrame:
    return runs.to_cells(df)


def settlement_buffer(spark, sf):
    return runs.dilate_by_zone(mask("settlement")(spark, sf), zones(spark, sf), ZONE_METRES, OTHER_METRES, GRID)


def human(spark, sf):
    """Buffered settlement, buffered single buildings and special sites."""
    wide = runs.clip(runs.widened(mask("single")(spark, sf), GRID.radius(100)), GRID)
    return runs.or_(settlement_buffer(spark, sf), wide, mask("special")(spark, sf))


def nature(spark, sf):
    return runs.dilate(mask("special")(spark, sf), 150, GRID)


def available_raw(spark, sf):
    masks = {"human": human(spark, sf), "nature": nature(spark, sf), "valid": valid(spark)}
    return runs.sweep(masks, lambda on: on["valid"] & ~(on["human"] | on["nature"]))


def available_cleaned(spark, sf):
    return labels.min_area(available_raw(spark, sf), 10, GRID)


def _stacked(sums: DataFrame, by: str, names: dict[str, str]) -> DataFrame:
    """One row of sums as rows (by, cells); names: column to the text of its key."""
    rows = sums.selectExpr(f"stack({len(names)}, {', '.join(f'{key}, {c}' for c, key in names.items())}) AS ({by}, cells)")
    return rows.select(by, F.coalesce("cells", F.lit(0)).cast("long").alias("cells"))


def category_totals(spark, sf):
    """Cells and square kilometres of each aggregate, inside the valid area: every mask is made once, and one sweep counts all aggregates."""
    wide = runs.clip(runs.widened(mask("single")(spark, sf), GRID.radius(100)), GRID)
    on = runs.coincident({"zoned": settlement_buffer(spark, sf), "single": wide, "special": mask("special")(spark, sf), "nature": nature(spark, sf), "valid": valid(spark)}).filter("valid")
    h, n = F.col("zoned") | F.col("single") | F.col("special"), F.col("nature")
    count = lambda c, name: F.sum(F.when(c, F.col("width"))).alias(name)
    sums = on.agg(count(h, "exclusion_human"), count(n, "exclusion_nature"), count(h | n, "all_exclusions"), count(~(h | n), "available_raw"))
    rows = _stacked(sums, "band", {c: f"'{c}'" for c in sums.columns})
    return rows.withColumn("km2", F.col("cells") * 625 / 1e6)


def closing_hulls(spark, sf):
    return runs.close(mask("buildings")(spark, sf), 100, 65, GRID)


def components8_labels(spark, sf):
    found = labels.components(closing_hulls(spark, sf), GRID, 8)
    return labels.sizes(found).withColumn("area_ha", F.col("cells") * 0.0625)


def rank_components(spark, sf):
    from pyspark.sql import Window

    found = labels.sizes(labels.components(closing_hulls(spark, sf), GRID, 8)).orderBy(F.col("cells").desc(), "label").limit(20)
    return found.withColumn("rank", F.row_number().over(Window.orderBy(F.col("cells").desc(), "label")))


def erode_border(spark, sf):
    return cells(runs.border(closing_hulls(spark, sf), GRID))


def sampled(spark, sf):
    return labels.sample_mask(points("addresses")(spark, sf), closing_hulls(spark, sf))


def sampled_labels(spark, sf):
    found = labels.sample_labels(points("addresses")(spark, sf), labels.components(closing_hulls(spark, sf), GRID, 8))
    return found.select("row", "col", F.coalesce("label", F.lit(-1).cast("long")).alias("label"))


def seeded(spark, sf):
    return cells(labels.touching_components(closing_hulls(spark, sf), points("gardens")(spark, sf), GRID))


def variant_sweep(spark, sf):
    """Available cells for each settlement distance: all distances and the rest of the exclusions in one sweep."""
    distances = (100, 200, 250, 300, 375)
    settlement = mask("settlement")(spark, sf)
    masks = {f"d{m}": runs.clip(runs.widened(settlement, GRID.radius(m)), GRID) for m in distances}
    masks |= {"single": runs.clip(runs.widened(mask("single")(spark, sf), GRID.radius(100)), GRID), "nature": nature(spark, sf), "valid": valid(spark)}
    free = runs.coincident(masks).filter("valid and not single and not nature")
    sums = free.agg(*[F.sum(F.when(~F.col(f"d{m}"), F.col("width"))).alias(f"d{m}") for m in distances])
    return _stacked(sums, "distance_m", {f"d{m}": str(m) for m in distances})


def overview_pyramid(spark, sf):
    """Cells of a band that the overviews 2, 4, 8 and 16 keep: every so many-th row and column."""
    all_ = cells(human(spark, sf))
    levels = F.explode(F.array(*[F.lit(k) for k in (2, 4, 8, 16)])).alias("level")
    return all_.select("row", "col", levels).filter("row % level = 0 and col % level = 0").select("level", F.expr("cast(row div level as int)").alias("row"), F.expr("cast(col div level as int)").alias("col"))


_SETTLEMENT = f"settlement AS ({points_sql('settlement')})"
_SINGLE = f"single AS ({points_sql('single')})"
_SPECIAL = f"special AS ({points_sql('special')})"
_BUILDINGS = f"buildings AS ({points_sql('buildings')})"
_ZONED = ", ".join([
    _SETTLEMENT, ZONES_SQL,
    "far AS (SELECT DISTINCT s.row, s.col FROM settlement s JOIN zones z ON s.col BETWEEN z.c0 AND z.c1 WHERE z.zone = 1)",
    "near AS (SELECT DISTINCT s.row, s.col FROM settlement s JOIN zones z ON s.col BETWEEN z.c0 AND z.c1 WHERE z.zone <> 1)",
    disc_sql("far", 300, "far_b"), disc_sql("near", 250, "near_b"), "zoned AS (SELECT * FROM far_b UNION SELECT * FROM near_b)",
])
_HUMAN = ", ".join([_ZONED, _SINGLE, _SPECIAL, disc_sql("single", 100, "single_b"), "human AS (SELECT * FROM zoned UNION SELECT * FROM single_b UNION SELECT * FROM special)"])
_NATURE = disc_sql("special", 150, "nature")
_VALID = f"{GRID_SQL}, valid AS (SELECT * FROM grid WHERE {VALID_SQL})"
_RAW = f"{_HUMAN}, {_NATURE}, {_VALID}, raw AS (SELECT * FROM valid EXCEPT SELECT * FROM human EXCEPT SELECT * FROM nature)"
_CLOSED = ", ".join([
    _BUILDINGS, GRID_SQL, disc_sql("buildings", 100, "grown"), "hole AS (SELECT * FROM grid EXCEPT SELECT * FROM grown)", disc_sql("hole", 65, "hole_b"),
    "hulls AS (SELECT * FROM grid EXCEPT SELECT * FROM hole_b)",
])
_HULLS = f"{_CLOSED}, {components_sql('hulls', 'labelled', 8)}"
_ADDRESSES = f"addresses AS ({points_sql('addresses')})"

QUERIES = {
    "dilate_uniform": (lambda s, d: cells(runs.dilate(mask("settlement")(s, d), 250, GRID)), f"WITH {_SETTLEMENT}, {disc_sql('settlement', 250, 'b')} {CELLS} b"),
    "dilate_by_province": (lambda s, d: cells(settlement_buffer(s, d)), f"WITH {_ZONED} {CELLS} zoned"),
    "mask_or": (lambda s, d: cells(runs.or_(mask("settlement")(s, d), mask("single")(s, d), mask("buildings")(s, d))), f"WITH {_SETTLEMENT}, {_SINGLE}, {_BUILDINGS} SELECT * FROM settlement UNION SELECT * FROM single UNION SELECT * FROM buildings"),
    "mask_and": (lambda s, d: cells(runs.and_(human(s, d), nature(s, d))), f"WITH {_HUMAN}, {_NATURE} SELECT * FROM human INTERSECT SELECT * FROM nature"),
    "mask_andnot": (lambda s, d: cells(runs.and_not(human(s, d), nature(s, d))), f"WITH {_HUMAN}, {_NATURE} SELECT * FROM human EXCEPT SELECT * FROM nature"),
    "mask_xor": (lambda s, d: cells(runs.xor(human(s, d), nature(s, d))), f"WITH {_HUMAN}, {_NATURE} (SELECT * FROM human EXCEPT SELECT * FROM nature) UNION (SELECT * FROM nature EXCEPT SELECT * FROM human)"),
    "clip_to_valid": (lambda s, d: cells(runs.and_(human(s, d), valid(s))), f"WITH {_HUMAN} SELECT * FROM human WHERE {VALID_SQL}"),
    "category_totals": (category_totals, f"""WITH {_RAW}, h AS (SELECT * FROM human WHERE {VALID_SQL}), n AS (SELECT * FROM nature WHERE {VALID_SQL}), counts AS (
        SELECT 'exclusion_human' AS band, count(*) AS cells FROM h UNION ALL SELECT 'exclusion_nature', count(*) FROM n
        UNION ALL SELECT 'all_exclusions', count(*) FROM (SELECT * FROM h UNION SELECT * FROM n) UNION ALL SELECT 'available_raw', count(*) FROM raw)
        SELECT band, cells, cells::DOUBLE * 625 / 1000000.0::DOUBLE AS km2 FROM counts"""),
    "available_raw": (lambda s, d: cells(available_raw(s, d)), f"WITH {_RAW} {CELLS} raw"),
    "available_cleaned": (lambda s, d: cells(available_cleaned(s, d)), f"WITH RECURSIVE {_RAW}, {components_sql('raw', 'lab', 4)} SELECT row, col FROM lab WHERE label IN (SELECT label FROM lab GROUP BY label HAVING count(*) >= 160)"),
    "components4_min_area": (lambda s, d: labels.sizes(labels.components(mask("buildings")(s, d), GRID, 4)), f"WITH RECURSIVE {_BUILDINGS}, {components_sql('buildings', 'lab', 4)} SELECT label, count(*) AS cells FROM lab GROUP BY label"),
    "closing_hulls": (lambda s, d: cells(closing_hulls(s, d)), f"WITH {_CLOSED} {CELLS} hulls"),
    "components8_labels": (components8_labels, f"WITH RECURSIVE {_HULLS} SELECT label, count(*) AS cells, count(*)::DOUBLE * 0.0625 AS area_ha FROM labelled GROUP BY label"),
    "rank_components": (rank_components, f"WITH RECURSIVE {_HULLS}, c AS (SELECT label, count(*) AS cells FROM labelled GROUP BY label) SELECT label, cells, (row_number() OVER (ORDER BY cells DESC, label))::INTEGER AS rank FROM c ORDER BY cells DESC, label LIMIT 20"),
    "erode_border": (erode_border, f"WITH {_CLOSED} SELECT row, col FROM hulls h WHERE (SELECT count(*) FROM hulls x WHERE abs(x.row - h.row) + abs(x.col - h.col) = 1) < 4"),
    "sample_mask_at_points": (sampled, f"WITH {_CLOSED}, {_ADDRESSES} SELECT a.row, a.col, h.row IS NOT NULL AS inside FROM addresses a LEFT JOIN hulls h ON h.row = a.row AND h.col = a.col"),
    "sample_labels": (sampled_labels, f"WITH RECURSIVE {_HULLS}, {_ADDRESSES} SELECT a.row, a.col, coalesce(l.label, -1)::BIGINT AS label FROM addresses a LEFT JOIN labelled l ON l.row = a.row AND l.col = a.col"),
    "seed_components": (seeded, f"WITH RECURSIVE {_HULLS}, gardens AS ({points_sql('gardens')}) SELECT row, col FROM labelled WHERE label IN (SELECT l.label FROM labelled l JOIN gardens g ON g.row = l.row AND g.col = l.col)"),
    "variant_sweep": (variant_sweep, "WITH " + ", ".join([_SETTLEMENT, _SINGLE, _SPECIAL, disc_sql("single", 100, "single_b"), _NATURE, _VALID, *[disc_sql("settlement", d, f"v{d}") for d in (100, 200, 250, 300, 375)]])
        + " " + " UNION ALL ".join(f"SELECT {d} AS distance_m, count(*) AS cells FROM (SELECT * FROM valid EXCEPT SELECT * FROM single_b EXCEPT SELECT * FROM nature EXCEPT SELECT * FROM v{d})" for d in (100, 200, 250, 300, 375))),
    "overview_pyramid": (overview_pyramid, f"WITH {_HUMAN} SELECT k AS level, (row // k)::INTEGER AS row, (col // k)::INTEGER AS col FROM human, (VALUES (2), (4), (8), (16)) t(k) WHERE row % k = 0 AND col % k = 0"),
    "rasterize_points": (lambda s, d: cells(mask("addresses")(s, d)), points_sql("addresses")),
}
