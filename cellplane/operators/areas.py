"""Areas of masks and shapes: coverage, dissolve, label areas, residues by reason, distance, weights of clusters, parks of turbines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.functions.scalars import residual_reason
from cellplane.operators import cluster, labels, outlines, overlay, rasterise, runs, spatial
from cellplane.scratch import materialise


def union_by(rows: DataFrame, by: str) -> DataFrame:
    """Disjoint runs (by, row, c0, c1) of overlapping ones: intervals of a row that overlap or touch become one."""
    w = Window.partitionBy(by, "row").orderBy("c0", "c1")
    reach = F.max("c1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("__new", F.coalesce((F.col("c0") > reach + 1).cast("int"), F.lit(1)))
    marked = marked.withColumn("__g", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(by, "row", "__g").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1")).drop("__g")


def dissolved(shapes: DataFrame, by: str, grid: GridSpec, all_touched: bool = False) -> DataFrame:
    """Shapes (id, kind, rings, by) united by group as disjoint runs (by, row, c0, c1) on the grid."""
    found = rasterise.shape_runs(shapes.select("id", "kind", "rings"), grid, all_touched).join(shapes.select("id", by), "id")
    on_grid = F.col("row").between(0, grid.height - 1) & (F.col("c1") >= 0) & (F.col("c0") < grid.width)
    own = found.filter(on_grid).select(by, "row", F.greatest("c0", F.lit(0)).alias("c0"), F.least("c1", F.lit(grid.width - 1)).alias("c1"))
    return union_by(own, by)


def perimeter(mask: DataFrame, by: str, cell_m: float) -> DataFrame:
    """(by, perimeter_m): length of the cell edges between a group's cells and what is not of the group. mask: disjoint runs (by, row, c0, c1)."""
    own = mask.select(by, "row", "c0", "c1")
    ends = own.groupBy(by).agg((2 * F.count("*")).alias("ends"), (2 * F.sum(F.col("c1") - F.col("c0") + 1)).alias("sides"))
    below = own.select(F.col(by).alias("__b"), (F.col("row") - 1).alias("__row"), F.col("c0").alias("__c0"), F.col("c1").alias("__c1"))
    met = own.join(below, F.col(by).eqNullSafe(F.col("__b")) & (F.col("row") == F.col("__row")) & (F.col("c0") <= F.col("__c1")) & (F.col("__c0") <= F.col("c1")))
    shared = met.groupBy(F.col(by).alias("__b")).agg((2 * F.sum(F.least("c1", "__c1") - F.greatest("c0", "__c0") + 1)).alias("shared"))
    out = ends.join(shared, F.col(by).eqNullSafe(F.col("__b")), "left")
    return out.select(by, ((F.col("ends") + F.col("sides") - F.coalesce("shared", F.lit(0))) * cell_m).alias("perimeter_m"))


def coverage(shapes: DataFrame, grid: GridSpec) -> DataFrame:
    """One row that holds shapes (id, kind, rings) against their raster.

    The raster takes every touched cell; the halo is what it has beyond the cells whose centres are covered. The raster's area may
    differ from the shapes' by the length of their common outline times a cell's side. Union and outline are those of the polygons united.
    """
    cell = grid.cell_m**2
    shapes = materialise(spatial.dealt(shapes.select("id", "kind", "rings")), "cover-shapes")
    touched = materialise(rasterise.burnt(shapes, grid), "cover-touched")
    centre = materialise(rasterise.burnt(shapes, grid, all_touched=False), "cover-centre")
    halo = materialise(runs.and_not(touched, centre), "cover-halo")
    count = lambda mask, name: mask.agg(F.coalesce(runs.n_cells(mask), F.lit(0)).cast("long").alias(name))
    parts = labels.sizes(labels.components(halo, grid, 4)).agg(F.count("*").alias("halo_components"), F.coalesce(F.max("cells"), F.lit(0)).alias("largest"))
    vector = shapes.agg(F.count("*").alias("n_shapes"), F.coalesce(F.sum(spatial.area(F.col("rings"))), F.lit(0.0)).alias("vector_m2"))
    united = overlay.measures(overlay.united(shapes.select(F.lit(1).alias("all"), "rings"), "all"), "all")
    outline = united.agg(F.coalesce(F.sum("area"), F.lit(0.0)).alias("union_m2"), F.coalesce(F.sum("perimeter"), F.lit(0.0)).alias("perimeter_m"))
    row = vector  # one row each
    for one in (count(touched, "t"), count(halo, "halo_cells"), count(runs.and_not(halo, runs.border(halo, grid)), "e"), parts, outline):
        row = row.crossJoin(one)
    threshold = F.col("perimeter_m") / 1000 * grid.cell_m / 1000
    diff = (F.col("t") * cell - F.col("vector_m2")) / 1e6
    return row.select(
        "n_shapes", "vector_m2", "union_m2", (F.col("t") * cell).alias("raster_m2"), "perimeter_m", "halo_cells", "halo_components", (F.col("largest") * cell / 1e4).alias("halo_largest_ha"),
        F.when(F.col("halo_cells") > 0, F.col("e") / F.col("halo_cells")).otherwise(0.0).alias("halo_eroded_fraction"), threshold.alias("threshold_km2"), diff.alias("diff_km2"), (F.abs(diff) <= threshold).alias("within"),
    )


def label_areas(labelled: DataFrame, grid: GridSpec) -> DataFrame:
    """(label, cells, area_ha, minx, miny, maxx, maxy) of labelled runs: what the outlines of the labels enclose."""
    x, y = lambda c: grid.x0 + F.col(c) * grid.cell_m, lambda r: grid.y_top - F.col(r) * grid.cell_m
    rows = labelled.groupBy("label").agg(F.sum(F.col("c1") - F.col("c0") + 1).alias("cells"), F.min("c0").alias("a"), F.max("c1").alias("b"), F.min("row").alias("r0"), F.max("row").alias("r1"))
    rows = rows.withColumns({"b": F.col("b") + 1, "r1": F.col("r1") + 1})
    return rows.select("label", "cells", (F.col("cells") * grid.cell_m**2 / 1e4).alias("area_ha"), x("a").alias("minx"), y("r1").alias("miny"), x("b").alias("maxx"), y("r0").alias("maxy"))


def farther_than(points: DataFrame, mask: DataFrame, metres: float, grid: GridSpec) -> DataFrame:
    """points (…, row, col) with far: the nearest set cell's centre is farther than so many metres from the own cell's. Off the grid nothing is far."""
    near = labels.sample_mask(points, runs.dilate(mask, metres, grid), "__near")
    return near.withColumn("far", grid.inside(F.col("row"), F.col("col")) & ~F.col("__near")).drop("__near")


def counts_by_cell(points: DataFrame, grid: GridSpec) -> DataFrame:
    """(row, col, n) of points (x, y) on the grid."""
    cells = points.select(grid.row(F.col("y")).alias("row"), grid.col(F.col("x")).alias("col"))
    return cells.filter(grid.inside(F.col("row"), F.col("col"))).groupBy("row", "col").agg(F.count("*").alias("n"))


def weighty_components(counts: DataFrame, reach_m: float, least: int, grid: GridSpec) -> DataFrame:
    """(row, c0, c1, label, weight): 8-connected components of the cells (row, col, n) widened by reach_m that hold a count of `least` or more."""
    wide = materialise(labels.components(runs.dilate(runs.from_cells(counts), reach_m, grid), grid, 8), "weight-labels")
    weight = labels.sample_labels(counts, wide).groupBy("label").agg(F.sum("n").alias("weight")).filter(F.col("weight") >= least)
    return wide.join(weight, "label").select("row", "c0", "c1", "label", "weight")


def residues(residual: DataFrame, evidence: dict[str, DataFrame], grid: GridSpec) -> DataFrame:
    """(label, cells, one share for each evidence, reason) for the 8-connected components of a residual mask.

    evidence: masks unassigned, gap, outside and classified.
    """
    parts = labels.components(residual, grid, 8).select(F.col("label").alias("part"), "row", F.explode(F.sequence("c0", "c1")).alias("col"))
    cells = materialise(parts, "residue-cells")
    for name in ("unassigned", "gap", "outside", "classified"):
        cells = labels.sample_mask(cells, evidence[name], name)
    rows = cells.groupBy(F.col("part").alias("label")).agg(F.count("*").alias("cells"), *[F.avg(F.col(n).cast("double")).alias(n) for n in ("unassigned", "gap", "outside", "classified")])
    return rows.withColumn("reason", residual_reason(*[F.col(n) for n in ("unassigned", "gap", "outside", "classified")]))


def residue_statistics(rows: DataFrame, grid: GridSpec) -> DataFrame:
    """(reason, components, cells, area_ha, largest_ha) of residues, all by reason."""
    ha = grid.cell_m**2 / 1e4
    return rows.groupBy("reason").agg(F.count("*").alias("components"), F.sum("cells").alias("cells"), (F.sum("cells") * ha).alias("area_ha"), (F.max("cells") * ha).alias("largest_ha"))


def park_numbers(turbines: DataFrame, outside: Column, chain_m: float = 750.0) -> DataFrame:
    """turbines (id, x, y) with park: chains of less than chain_m among those outside, numbered from 1 by their least x and y; 0 for the others."""
    own = materialise(turbines.withColumn("__out", outside), "park-points")
    chained = cluster.eps_components(own.filter("__out").select("id", "x", "y"), chain_m)
    members = own.join(chained, "id")
    corners = members.groupBy("cluster").agg(F.min("x").alias("minx"), F.min("y").alias("miny"))
    numbers = cluster.ranked(corners, "minx", "miny", "cluster", name="nth").select("cluster", (F.col("nth") + 1).cast("int").alias("park"))
    return own.join(members.join(numbers, "cluster").select("id", "park"), "id", "left").select("id", "x", "y", F.coalesce("park", F.lit(0)).alias("park"))


def park_hulls(parks: DataFrame) -> DataFrame:
    """(id, kind, rings) of the convex hull of every park (id, x, y, park), a line or a point where it has no area.

    A hull's corners are among the corners of its shares' hulls, so a park goes through shares of about 10,000 turbines.
    """
    hull = lambda rings: [outlines.convex_hull(r) for r in rings]
    own = parks.filter("park > 0")
    shares = own.groupBy("park").agg(F.ceil(F.count("*") / 10_000).alias("shares"))
    points = own.join(shares, "park").select("park", F.pmod(F.xxhash64("id"), F.col("shares")).alias("s"), F.struct("x", "y").alias("p"))
    first = points.groupBy("park", "s").agg(F.collect_set("p").alias("ring")).select(F.struct("park", "s").alias("key"), F.array("ring").alias("rings"))
    first = first.withColumn("id", F.xxhash64("key"))
    cut = outlines.mapped(first.select("id", "rings"), hull).join(first.select("id", "key"), "id")
    whole = cut.select(F.col("key.park").alias("id"), F.explode(F.get("rings", 0)).alias("p")).groupBy("id").agg(F.array(F.collect_set("p")).alias("rings"))
    out = outlines.mapped(whole, hull)
    n = F.size(F.get("rings", 0))
    return out.select("id", F.when(n >= 3, "polygon").when(n == 2, "line").otherwise("point").alias("kind"), "rings")


def park_mask(turbines: DataFrame, zone: DataFrame, valid: DataFrame, grid: GridSpec, chain_m: float = 750.0, margin_m: float = 200.0) -> DataFrame:
    """Runs of the parks outside official zones: hulls of the chained turbines, widened by the margin, less the zones."""
    at = turbines.withColumns({"row": grid.row(F.col("y")), "col": grid.col(F.col("x"))})
    at = labels.sample_mask(labels.sample_mask(at, valid, "valid"), zone, "zoned")
    parks = materialise(park_numbers(at, F.col("valid") & ~F.col("zoned"), chain_m), "parks")
    return runs.and_not(rasterise.burnt(park_hulls(parks), grid, margin_m), zone)
