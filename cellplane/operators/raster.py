"""Value planes (row, col, v): block means, slope, blur, thresholds, decimation, resampling.

Neighbourhood sums scatter: a cell sends its weighted value to each cell that reads it, and one grouped sum gathers. Edge rules are ghosts, copies
of edge cells beyond the grid, made before the scatter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec


def block_mean(plane: DataFrame, k: int, grid: GridSpec) -> DataFrame:
    """Mean over k x k blocks; what the last blocks lack repeats the grid's edge."""
    weight = lambda axis, n: F.when(F.col(axis) == n - 1, F.lit(float(-n % k + 1))).otherwise(1.0)
    w = weight("row", grid.height) * weight("col", grid.width)
    return plane.groupBy(F.expr(f"cast(row div {k} as int)").alias("row"), F.expr(f"cast(col div {k} as int)").alias("col")).agg((F.sum(F.col("v") * w) / F.sum(w)).alias("v"))


def _ghosts(axis: str, size: int, reach: int, mirror: bool) -> Column:
    """Places where a cell shows along an axis: its own and, near an edge, beyond it. Mirrored (d c b a | a b c d | d c b a) or the edge repeated."""
    c = F.col(axis)
    if mirror:
        places = F.array(c, -1 - c, 2 * size - 1 - c)
    else:
        low = F.when(c == 0, F.sequence(F.lit(-reach), F.lit(-1))).otherwise(F.array().cast("array<int>"))
        high = F.when(c == size - 1, F.sequence(F.lit(size), F.lit(size + reach - 1))).otherwise(F.array().cast("array<int>"))
        places = F.concat(F.array(c), low, high)
    return F.filter(places, lambda p: (p >= -reach) & (p < size + reach))


def _scatter(plane: DataFrame, axis: str, size: int, weights: dict[int, list[float]], names: list[str], sources: list[str], mirror: bool) -> DataFrame:
    """Sums along one axis: out[i] = sum of weights[name] * source[i + offset]. All names in one pass."""
    reach = max(abs(o) for o in weights)
    other = "col" if axis == "row" else "row"
    steps = F.array(*[F.struct(F.lit(o).alias("o"), *[F.lit(float(w)).alias(f"w{i}") for i, w in enumerate(ws)]) for o, ws in weights.items()])
    spread = plane.withColumn("__g", F.explode(_ghosts(axis, size, reach, mirror))).withColumn("__s", F.explode(steps))
    spread = spread.withColumn("__to", F.col("__g") - F.col("__s.o")).filter(F.col("__to").between(0, size - 1))
    sums = [F.sum(F.col(f"__s.w{i}") * F.col(src)).alias(n) for i, (n, src) in enumerate(zip(names, sources, strict=True))]
    return spread.groupBy(F.col(other), F.col("__to").cast("int").alias(axis)).agg(*sums)


def slope_percent(blocks: DataFrame, width: int, height: int, block_m: float) -> DataFrame:
    """Sobel gradient of a plane of blocks, edges repeated, as rise over run in percent: (row, col, slope)."""
    along = _scatter(blocks, "col", width, {-1: [-1, 1], 0: [0, 2], 1: [1, 1]}, ["dx", "sx"], ["v", "v"], False)
    both = _scatter(along, "row", height, {-1: [1, -1], 0: [2, 0], 1: [1, 1]}, ["gx", "gy"], ["dx", "sx"], False)
    return both.select("row", "col", (F.hypot(F.col("gx"), F.col("gy")) / (8 * block_m) * 100).alias("slope"))


def kernel(sigma: float, truncate: float = 4.0) -> dict[int, list[float]]:
    r = int(truncate * sigma + 0.5)
    w = {o: math.exp(-0.5 * (o / sigma) ** 2) for o in range(-r, r + 1)}
    total = sum(w.values())
    return {o: [x / total] for o, x in w.items()}


def blur_percent(cells: DataFrame, metres: float, grid: GridSpec) -> DataFrame:
    """Gaussian of a mask of cells, mirrored edges, cut at four sigma, in whole percent: (row, col, percent) where it is not 0."""
    w = kernel(metres / grid.cell_m)
    one = _scatter(cells.select("row", "col", F.lit(1.0).alias("v")), "row", grid.height, w, ["v"], ["v"], True)
    two = _scatter(one, "col", grid.width, w, ["v"], ["v"], True)
    return two.select("row", "col", F.least(F.lit(100), F.greatest(F.lit(0), F.rint(F.round(F.col("v") * 100, 9)))).cast("int").alias("percent")).filter("percent > 0")


def terrain_masks(plane: DataFrame, max_slope: float, max_height: float, min_power: float) -> DataFrame:
    """(row, col, too_steep, too_high, too_calm) of (row, col, slope, height, power): missing slope or height is fine, missing power is too calm."""
    missing = lambda c: F.col(c).isNull() | F.isnan(c)
    over = lambda c, most: ~missing(c) & (F.col(c) > most)
    return plane.select("row", "col", over("slope", max_slope).alias("too_steep"), over("height", max_height).alias("too_high"), (missing("power") | (F.col("power") < min_power)).alias("too_calm"))


def shear(power: float, height: float, at: float, alpha: float = 0.143) -> float:
    """Power density at another height by the power law."""
    return power * (at / height) ** (3 * alpha)


def decimated(plane: DataFrame, k: int) -> DataFrame:
    """Nearest: every k-th row and column."""
    return plane.filter(f"row % {k} = 0 and col % {k} = 0").withColumns({"row": F.expr(f"cast(row div {k} as int)"), "col": F.expr(f"cast(col div {k} as int)")})


def resampled(plane: DataFrame, source: GridSpec, target: GridSpec, x: Column, y: Column, how: str = "bilinear") -> DataFrame:
    """A plane on another grid. x, y: source coordinates of a target cell's centre, from its columns tx, ty. Cells beyond the source are missing."""
    spark = plane.sparkSession
    cells = spark.range(target.width * target.height).select((F.col("id") / target.width).cast("int").alias("row"), (F.col("id") % target.width).cast("int").alias("col"))
    cells = cells.withColumns({"tx": target.x0 + (F.col("col") + 0.5) * target.cell_m, "ty": target.y_top - (F.col("row") + 0.5) * target.cell_m})
    at = cells.withColumns({"fc": (x - source.x0) / source.cell_m - 0.5, "fr": (source.y_top - y) / source.cell_m - 0.5})
    if how not in ("nearest", "bilinear"):
        raise ValueError(f"no way to resample: {how!r}; averages and greatest values come from `reduced`")
    if how == "nearest":
        near = at.select("row", "col", F.round("fr").cast("int").alias("sr"), F.round("fc").cast("int").alias("sc"), F.lit(1.0).alias("w"))
    else:
        corner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
        near = at.withColumn("k", corner).withColumns({"sr": F.floor("fr").cast("int") + F.col("k.i"), "sc": F.floor("fc").cast("int") + F.col("k.j")})
        near = near.withColumn("w", (1 - F.abs(F.col("fr") - F.col("sr"))) * (1 - F.abs(F.col("fc") - F.col("sc")))).filter("w > 0")
    src = plane.select(F.col("row").alias("sr"), F.col("col").alias("sc"), "v")
    return near.join(src, ["sr", "sc"]).groupBy("row", "col").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("v"))


def reduced(plane: DataFrame, k: int) -> DataFrame:
    """Blocks of k x k cells: (row, col, average, greatest). Missing cells take no part; a block without any is missing."""
    at = plane.filter("v is not null and not isnan(v)").withColumns({"row": F.expr(f"cast(row div {k} as int)"), "col": F.expr(f"cast(col div {k} as int)")})
    return at.groupBy("row", "col").agg(F.avg("v").alias("average"), F.max("v").alias("greatest"))


def median_filled(df: DataFrame, v: str) -> DataFrame:
    """df with null and NaN in a column replaced by the median of the others."""
    known = F.when(~F.isnan(v), F.col(v))
    middle = df.agg(F.median(known).alias("__m"))  # one row
    return df.crossJoin(F.broadcast(middle)).withColumn(v, F.coalesce(known, F.col("__m"))).drop("__m")


def pasted(tiles: DataFrame, cells: DataFrame, grid: GridSpec) -> DataFrame:
    """(row, col, code) of tiles (tile, row0, col0) that all carry cells (row, col, code) at their place; 0 paints nothing, of two tiles the greater wins.

    cells may have a column tile: then a tile carries its own ones only.
    """
    own = cells.filter("code <> 0").withColumnsRenamed({"row": "r", "col": "c"})
    both = tiles.join(own, "tile") if "tile" in cells.columns else tiles.join(F.broadcast(own)) if own.count() <= 65_536 else tiles.crossJoin(own)
    at = both.select("tile", (F.col("row0") + F.col("r")).alias("row"), (F.col("col0") + F.col("c")).alias("col"), "code")
    return at.filter(grid.inside(F.col("row"), F.col("col"))).groupBy("row", "col").agg(F.max_by("code", "tile").alias("code"))
