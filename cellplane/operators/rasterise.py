"""Shapes to runs of cells. A cell is [col, col + 1) x [row, row + 1) in units of cells, rows downwards from the grid's top.

all_touched: every cell whose square a shape's outline crosses, and every cell whose centre lies inside. Otherwise centres only. Shapes are
rings of points (polygons, even-odd) or open paths (lines); a path of one point is its cell.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.operators import runs, spatial

OUT = pa.schema([("id", pa.int64()), ("row", pa.int32()), ("c0", pa.int32()), ("c1", pa.int32())])


def outline(points: np.ndarray, closed: bool) -> list[tuple[int, int, int]]:
    """(row, first col, last col) of the squares that the path crosses, edge by edge."""
    if len(points) == 1 or (len(points) and np.ptp(points, axis=0).max() == 0):
        x, y = points[0]
        return [(math.floor(y), math.floor(x), math.floor(x))]
    ends = np.roll(points, -1, axis=0) if closed else points[1:]
    out = []
    for (x0, y0), (x1, y1) in zip(points[: len(ends)].tolist(), ends.tolist(), strict=True):
        if y0 > y1:
            x0, y0, x1, y1 = x1, y1, x0, y0
        for row in range(math.floor(y0), math.floor(y1) + 1):
            if y1 == y0:
                a, b = x0, x1
            else:
                lo, hi = max(y0, row), min(y1, row + 1)
                a, b = x0 + (lo - y0) * (x1 - x0) / (y1 - y0), x0 + (hi - y0) * (x1 - x0) / (y1 - y0)
            out.append((row, math.floor(min(a, b)), math.floor(max(a, b))))
    return out


def filled(rings: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """Runs of cells whose centres lie inside, by the even-odd rule over all rings."""
    if not rings:
        return []
    top, bottom = min(r[:, 1].min() for r in rings), max(r[:, 1].max() for r in rings)
    out = []
    for row in range(math.floor(top), math.floor(bottom) + 1):
        y, at = row + 0.5, []
        for r in rings:
            p, q = r, np.roll(r, -1, axis=0)
            hit = (p[:, 1] > y) != (q[:, 1] > y)
            at += (p[hit, 0] + (y - p[hit, 1]) * (q[hit, 0] - p[hit, 0]) / (q[hit, 1] - p[hit, 1])).tolist()
        at.sort()
        for a, b in zip(at[::2], at[1::2], strict=True):
            first, last = math.ceil(a - 0.5), math.ceil(b - 0.5) - 1
            if first <= last:
                out.append((row, first, last))
    return out


def _burn(grid: GridSpec, all_touched: bool):
    def run(batches):
        for b in batches:
            ids, rows = [], []
            for key, kind, rings in zip(b.column("id").to_pylist(), b.column("kind").to_pylist(), b.column("rings").to_pylist(), strict=True):
                shape = [np.array([((p["x"] - grid.x0) / grid.cell_m, (grid.y_top - p["y"]) / grid.cell_m) for p in r]) for r in rings or [] if r]
                found = [x for r in shape for x in outline(r, kind == "polygon")] if all_touched or kind != "polygon" else []
                found += filled(shape) if kind == "polygon" else []
                ids += [key] * len(found)
                rows += found
            cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(c, pa.int32()) for c in cols]], schema=OUT)

    return run


def shape_runs(shapes: DataFrame, grid: GridSpec, all_touched: bool = True) -> DataFrame:
    """(id, kind, rings) to overlapping runs (id, row, c0, c1), not clipped. kind: polygon, line or point."""
    own = spatial.dealt(shapes.select(F.col("id").cast("long").alias("id"), "kind", "rings"))
    box = F.coalesce((F.col("kind") == "polygon") & spatial._is_box(F.col("rings")), F.lit(False))
    other = own.filter(~box).mapInArrow(_burn(grid, all_touched), "id long, row int, c0 int, c1 int")
    return _box_runs(own.filter(box), grid, all_touched).unionByName(other)


def _box_runs(boxes: DataFrame, grid: GridSpec, all_touched: bool) -> DataFrame:
    """shape_runs of boxes: what the outline crosses and what lies inside make one run in each row."""
    own = boxes.select("id", spatial.bounds(F.col("rings")).alias("b"))
    places = {"l": F.col("b.minx") - grid.x0, "r": F.col("b.maxx") - grid.x0, "t": grid.y_top - F.col("b.maxy"), "u": grid.y_top - F.col("b.miny")}
    own = own.select("id", *[(v / grid.cell_m).alias(k) for k, v in places.items()])
    first = (lambda c: F.floor(c)) if all_touched else (lambda c: F.ceil(F.col(c) - 0.5))
    last = (lambda c: F.floor(c)) if all_touched else (lambda c: F.ceil(F.col(c) - 0.5) - 1)
    own = own.select("id", *[f.cast("int").alias(n) for n, f in (("r0", first("t")), ("r1", last("u")), ("c0", first("l")), ("c1", last("r")))]).filter("r0 <= r1 and c0 <= c1")
    return own.select("id", F.explode(F.sequence("r0", "r1")).alias("row"), "c0", "c1")


def burnt(shapes: DataFrame, grid: GridSpec, buffer_m: float = 0.0, all_touched: bool = True) -> DataFrame:
    """The mask of all shapes, widened before it is clipped: what lies off the grid reaches into it."""
    own = shape_runs(shapes, grid, all_touched).select("row", "c0", "c1")
    wide = runs.widened(own, grid.radius(buffer_m)) if buffer_m > 0 else own
    return runs.sweep({"m": runs.clip(wide, grid)}, lambda on: on["m"])


def coded(shapes: DataFrame, grid: GridSpec, order: str, code: str) -> DataFrame:
    """(row, col, code) of the shape that paints a cell last, by centre. order: a column, greatest last."""
    found = shape_runs(shapes, grid, False)
    found = found.filter((F.col("row") >= 0) & (F.col("row") < grid.height) & (F.col("c1") >= 0) & (F.col("c0") < grid.width))
    found = found.select("id", "row", F.greatest("c0", F.lit(0)).alias("c0"), F.least("c1", F.lit(grid.width - 1)).alias("c1"))
    # The last of equal runs goes on, so that no more than the grid's runs are taken apart into cells.
    last = found.join(shapes.select(F.col("id").cast("long").alias("id"), order, code), "id").groupBy("row", "c0", "c1").agg(F.max(F.struct(order, "id", code)).alias("__s"))
    cells = last.select("row", F.explode(F.sequence("c0", "c1")).alias("col"), "__s")
    return cells.groupBy("row", "col").agg(F.max("__s").alias("__s")).select("row", "col", F.col(f"__s.{code}").alias(code))
