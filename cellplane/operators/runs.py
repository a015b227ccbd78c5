"""Masks as runs of cells: (row, c0, c1), both ends included. All operators keep a mask canonical: disjoint, maximal runs.

Every set operation is one sweep along the rows: the ends of all runs become events, running sums say at each event which
masks are set, and a condition on those sums says where the result is. So any formula over any number of masks costs one shuffle,
by row, and no join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec, disc


def _events(mask: DataFrame, name: str, names: list[str]) -> DataFrame:
    ends = F.explode(F.array(F.struct(F.col("c0").alias("at"), F.lit(1).alias("step")), F.struct((F.col("c1") + 1).alias("at"), F.lit(-1).alias("step"))))
    return mask.select("row", ends.alias("e")).select("row", F.col("e.at").alias("at"), *[(F.col("e.step") if n == name else F.lit(0)).alias(n) for n in names])


def sweep(masks: dict[str, DataFrame], condition: Callable[[dict[str, Column]], Column]) -> DataFrame:
    """Runs of the cells where condition holds; it gets a boolean column for each mask. It must not hold where no mask is set."""
    names = list(masks)
    events = None
    for name in names:
        one = _events(masks[name], name, names)
        events = one if events is None else events.unionByName(one)
    events = events.groupBy("row", "at").agg(*[F.sum(n).alias(n) for n in names])
    along = Window.partitionBy("row").orderBy("at")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    on = condition({n: F.sum(n).over(upto) > 0 for n in names})
    events = events.select("row", "at", on.alias("on"))
    events = events.withColumn("was", F.coalesce(F.lag("on").over(along), F.lit(False))).filter("on <> was")
    return events.withColumn("c1", (F.lead("at").over(along) - 1).cast("int")).filter("on").select("row", F.col("at").cast("int").alias("c0"), "c1")


def coincident(masks: dict[str, DataFrame]) -> DataFrame:
    """(row, width, a boolean for each mask): stretches along which the same masks are set, where any is."""
    names = list(masks)
    events = None
    for name in names:
        one = _events(masks[name], name, names)
        events = one if events is None else events.unionByName(one)
    events = events.groupBy("row", "at").agg(*[F.sum(n).alias(n) for n in names])
    along = Window.partitionBy("row").orderBy("at")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    out = events.select("row", (F.lead("at").over(along) - F.col("at")).alias("width"), *[(F.sum(n).over(upto) > 0).alias(n) for n in names])
    return out.filter(_fold([F.col(n) for n in names], lambda a, b: a | b))


def from_cells(cells: DataFrame) -> DataFrame:
    """(row, col), repeats allowed, to runs."""
    return sweep({"m": cells.select("row", F.col("col").alias("c0"), F.col("col").alias("c1"))}, lambda on: on["m"])


def to_cells(runs: DataFrame) -> DataFrame:
    return runs.select("row", F.explode(F.sequence("c0", "c1")).alias("col"))


def or_(*masks: DataFrame) -> DataFrame:
    return sweep({f"m{i}": m for i, m in enumerate(masks)}, lambda on: _fold(list(on.values()), lambda a, b: a | b))


def and_(*masks: DataFrame) -> DataFrame:
    return sweep({f"m{i}": m for i, m in enumerate(masks)}, lambda on: _fold(list(on.values()), lambda a, b: a & b))


def and_not(a: DataFrame, b: DataFrame) -> DataFrame:
    return sweep({"a": a, "b": b}, lambda on: on["a"] & ~on["b"])


def xor(a: DataFrame, b: DataFrame) -> DataFrame:
    return sweep({"a": a, "b": b}, lambda on: on["a"] != on["b"])


def _fold(columns: list[Column], op: Callable[[Column, Column], Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = op(out, c)
    return out


def whole(grid: GridSpec, spark) -> DataFrame:
    return spark.range(grid.height).select(F.col("id").cast("int").alias("row"), F.lit(0).alias("c0"), F.lit(grid.width - 1).alias("c1"))


def complement(mask: DataFrame, grid: GridSpec) -> DataFrame:
    return and_not(whole(grid, mask.sparkSession), mask)


def clip(mask: DataFrame, grid: GridSpec) -> DataFrame:
    """What lies on the grid."""
    mask = mask.filter((F.col("row") >= 0) & (F.col("row") < grid.height) & (F.col("c1") >= 0) & (F.col("c0") < grid.width))
    return mask.select("row", F.greatest("c0", F.lit(0)).alias("c0"), F.least("c1", F.lit(grid.width - 1)).alias("c1"))


def widened(mask: DataFrame, radius: float) -> DataFrame:
    """Overlapping runs of the disc dilation, not clipped. A run of cells becomes one run for each row of the disc."""
    rows = F.explode(F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(w).alias("w")) for dr, w in disc(radius)]))
    out = mask.select("*", rows.alias("k"))
    return out.select((F.col("row") + F.col("k.dr")).alias("row"), (F.col("c0") - F.col("k.w")).alias("c0"), (F.col("c1") + F.col("k.w")).alias("c1"))


def dilate(mask: DataFrame, metres: float, grid: GridSpec) -> DataFrame:
    """Disc dilation of a mask of cells; what leaves the grid is lost."""
    if metres <= 0:
        return mask
    return sweep({"m": clip(widened(mask, grid.radius(metres)), grid)}, lambda on: on["m"])


def erode(mask: DataFrame, metres: float, grid: GridSpec) -> DataFrame:
    """Not the dilation of the complement inside the grid, so the grid's edge never erodes."""
    return complement(dilate(complement(mask, grid), metres, grid), grid) if metres > 0 else mask


def close(mask: DataFrame, out: float, back: float, grid: GridSpec) -> DataFrame:
    return erode(dilate(mask, out, grid), back, grid)


def dilate_by_zone(mask: DataFrame, zones: DataFrame, metres: dict, default: float, grid: GridSpec) -> DataFrame:
    """Union over zones of (mask and zone) dilated by the zone's distance. zones: (zone, row, c0, c1); cells may lie in several zones.

    The distances are few: each has one sweep of its own for the intersection, and all widened runs share one for the union.
    """
    parts = []
    for d in sorted({default, *metres.values()}):
        own = [z for z, m in metres.items() if m == d]
        others = ~F.col("zone").isin(list(metres)) if metres else F.lit(True)
        chosen = F.col("zone").isin(own) | others if d == default else F.col("zone").isin(own)
        here = and_(mask, zones.filter(chosen).select("row", "c0", "c1"))
        parts.append(clip(widened(here, grid.radius(d)), grid) if d > 0 else here)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return sweep({"m": out}, lambda on: on["m"])


def n_cells(runs: DataFrame) -> Column:
    return F.sum(F.col("c1") - F.col("c0") + 1).cast("long")


def odd(mask: DataFrame) -> DataFrame:
    """Runs of the cells that an odd number of runs (row, c0, c1) cover: of the ends, those that occur an odd number of times are starts and stops in turn."""
    ends = mask.select("row", F.explode(F.array(F.col("c0"), F.col("c1") + 1)).alias("at")).groupBy("row", "at").agg((F.count("*") % 2).alias("n")).filter("n = 1")
    along = Window.partitionBy("row").orderBy("at")
    runs = ends.select("row", F.col("at").alias("c0"), (F.lead("at").over(along) - 1).alias("c1"), (F.row_number().over(along) % 2).alias("first"))
    return runs.filter("first = 1").select("row", F.col("c0").cast("int").alias("c0"), F.col("c1").cast("int").alias("c1"))


def parity(rings: DataFrame, by: list[str]) -> DataFrame:
    """Cells (by, row, col) that occur an odd number of times: the even-odd rule over filled rings."""
    return rings.groupBy(*by, "row", "col").agg((F.count("*") % 2).alias("odd")).filter("odd = 1").drop("odd")


def border(mask: DataFrame, grid: GridSpec) -> DataFrame:
    """Cells with a 4-neighbour outside the mask; beyond the grid counts as outside."""
    shifted = [mask.select((F.col("row") + dr).alias("row"), (F.col("c0") + dc).alias("c0"), (F.col("c1") + dc).alias("c1")) for dr, dc in ((1, 0), (-1, 0), (0, 1), (0, -1))]
    return sweep({"m": mask, **{f"s{i}": s for i, s in enumerate(shifted)}}, lambda on: on["m"] & ~(on["s0"] & on["s1"] & on["s2"] & on["s3"]))
