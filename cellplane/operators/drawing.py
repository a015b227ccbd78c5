"""Between maps and drawings: pixels, tile jobs, corner points, and points inside shapes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pixels(points: Column, minx: float, maxy: float, metres: float) -> Column:
    """Points (x, y) as whole pixels (px, py), rounded half to even; a pixel that repeats the one before goes."""
    path = F.transform(points, lambda p: F.struct(F.rint((p["x"] - minx) / metres).cast("int").alias("px"), F.rint((maxy - p["y"]) / metres).cast("int").alias("py")))
    # Neighbours are compared by place: repeats that are not neighbours stay. The path is bound by a name, else it would be made anew for each of its points.
    return F.get(F.transform(F.array(path), lambda all_: F.filter(all_, lambda p, i: (i == 0) | (p != F.get(all_, i - 1)))), 0)


def tile_jobs(files: DataFrame, x0: float, y0: float, side: float, halo: float, columns: int, rows: int) -> DataFrame:
    """files (…, minx, miny, maxx, maxy) with tx, ty: once for each tile of the lattice that their bounds, widened by the halo, meet."""
    tiles = lambda lo, hi, start, n: F.sequence(F.greatest(F.ceil((lo - halo - start) / side).cast("int") - 1, F.lit(0)), F.least(F.floor((hi + halo - start) / side).cast("int"), F.lit(n - 1)))
    met = (F.col("maxx") + halo >= x0) & (F.col("minx") - halo <= x0 + columns * side) & (F.col("maxy") + halo >= y0) & (F.col("miny") - halo <= y0 + rows * side)
    own = files.filter(met).withColumn("tx", F.explode(tiles(F.col("minx"), F.col("maxx"), x0, columns)))
    return own.withColumn("ty", F.explode(tiles(F.col("miny"), F.col("maxy"), y0, rows)))


def corner_points(text: Column, default: tuple[tuple[float, float], ...]) -> Column:
    """The points (lat, lon) of a /GPTS entry; the default unless it has exactly as many numbers as that."""
    inner = F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), r"/GPTS\s*\[([^\]]+)\]", 1))
    numbers = F.transform(F.split(inner, r"\s+"), lambda x: x.try_cast("double"))
    n = len(default)
    point = lambda lat, lon: F.struct(lat.alias("lat"), lon.alias("lon"))
    stated = F.array(*[point(F.get(numbers, 2 * i), F.get(numbers, 2 * i + 1)) for i in range(n)])
    usable = (F.size(numbers) == 2 * n) & ~F.exists(numbers, lambda x: x.isNull())
    return F.when(usable, stated).otherwise(F.array(*[point(F.lit(float(a)), F.lit(float(b))) for a, b in default]))


def disc_ring(x: Column, y: Column, metres: float, sides: int = 32) -> Column:
    """A regular ring around a point: what stands in for a footprint that is too large to be one."""
    return F.transform(F.sequence(F.lit(0), F.lit(sides - 1)), lambda i: F.struct((x + metres * F.cos(2 * F.pi() * i / sides)).alias("x"), (y + metres * F.sin(2 * F.pi() * i / sides)).alias("y")))


def interior_point(rings: list[np.ndarray]) -> np.ndarray | None:
    """A point inside a polygon (even-odd over its rings): the middle of the widest stretch on a level line between corners, nearest half height."""
    ys = np.unique(np.concatenate([r[:, 1] for r in rings])) if rings else np.empty(0)
    if len(ys) < 2:
        return None
    levels = (ys[1:] + ys[:-1]) / 2
    y = levels[np.argmin(np.abs(levels - (ys[0] + ys[-1]) / 2))]
    cuts = []
    for r in rings:
        a, b = r, np.roll(r, -1, axis=0)
        hit = (a[:, 1] > y) != (b[:, 1] > y)
        a, b = a[hit], b[hit]
        cuts.append(a[:, 0] + (y - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0]))
    x = np.sort(np.concatenate(cuts)).reshape(-1, 2)
    if not len(x):
        return None
    widest = int(np.argmax(x[:, 1] - x[:, 0]))
    return np.array([x[widest].mean(), y])
