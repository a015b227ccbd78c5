"""Connected components of masks of runs, 4- or 8-neighbour, and what is built on them.

Rows are cut into strips. Inside a strip the runs are labelled at once, in one grouped Arrow pass; only the labels that touch across
the edges of strips go through the distributed loop. A component's label is its least cell number, row * width + column.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.operators.components import least_labels
from cellplane.scratch import materialise

STRIP, BAND = 128, 256
LABELLED = pa.schema([("row", pa.int32()), ("c0", pa.int32()), ("c1", pa.int32()), ("label", pa.int64())])


def _touching(row: np.ndarray, c0: np.ndarray, c1: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of runs in consecutive rows that touch. Sorted by row and start; runs of a row are disjoint."""
    span = np.int64(max(int(c1.max()) + 3, 3))
    start, end = row * span + c0, row * span + c1
    # Runs of the row below that end at or after my start, and start at or before my end.
    first = np.searchsorted(end, (row + 1) * span + c0 - reach, side="left")
    last = np.searchsorted(start, (row + 1) * span + c1 + reach, side="right")
    n = np.maximum(last - first, 0)
    a = np.repeat(np.arange(len(row)), n)
    b = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    same = row[b] == row[a] + 1
    return a[same], b[same]


def _settled(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index reachable from each of n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while (jump := new[new]).tobytes() != new.tobytes():
            new = jump
        if np.array_equal(new, label):
            return label
        label = new


def _strip(width: int, reach: int):
    def run(t: pa.Table) -> pa.Table:
        row, c0, c1 = (t.column(c).to_numpy().astype(np.int64) for c in ("row", "c0", "c1"))
        order = np.lexsort((c0, row))
        row, c0, c1 = row[order], c0[order], c1[order]
        label = _settled(len(row), *_touching(row, c0, c1, reach))
        first = row * width + c0
        return pa.table([pa.array(row.astype(np.int32)), pa.array(c0.astype(np.int32)), pa.array(c1.astype(np.int32)), pa.array(first[label])], schema=LABELLED)

    return run


def components(mask: DataFrame, grid: GridSpec, neighbours: int = 4, strip: int = STRIP) -> DataFrame:
    """(row, c0, c1, label) for each run of the mask."""
    reach = {4: 0, 8: 1}[neighbours]
    cut = F.expr(f"row div {strip}").alias("strip")
    local = mask.select("row", "c0", "c1", cut).groupBy("strip").applyInArrow(_strip(grid.width, reach), "row int, c0 int, c1 int, label long")
    local = materialise(local, "labels")
    edge = local.filter(F.col("row") % strip == strip - 1).withColumn("next", F.col("row") + 1)
    below = local.filter((F.col("row") % strip == 0) & (F.col("row") > 0))
    # Long rows are cut into bands of columns, so that the overlap is looked for among near runs only.
    bands = lambda lo, hi: F.explode(F.sequence(F.floor(lo / BAND), F.floor(hi / BAND)))
    up = edge.select(F.col("next").alias("row"), F.col("c0").alias("a0"), F.col("c1").alias("a1"), F.col("label").alias("a"), bands(F.col("c0") - reach, F.col("c1") + reach).alias("band"))
    down = below.select("row", F.col("c0").alias("b0"), F.col("c1").alias("b1"), F.col("label").alias("b"), bands(F.col("c0"), F.col("c1")).alias("band"))
    meet = up.join(down, ["row", "band"]).filter((F.col("a0") - reach <= F.col("b1")) & (F.col("b0") <= F.col("a1") + reach)).select("a", "b").distinct()
    meet = materialise(meet, "label-edges")
    if not meet.head(1):
        return local
    to = least_labels(meet, lambda df: materialise(df, "label-rounds"))
    out = local.join(to.select(F.col("v").alias("label"), F.col("label").alias("least")), "label", "left")
    return out.select("row", "c0", "c1", F.coalesce("least", "label").alias("label"))


def sizes(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("label").agg(F.sum(F.col("c1") - F.col("c0") + 1).cast("long").alias("cells"))


def min_area(mask: DataFrame, hectares: float, grid: GridSpec, neighbours: int = 4) -> DataFrame:
    """Components of at least so many hectares; 0 or less keeps all."""
    if hectares <= 0:
        return mask
    labelled = components(mask, grid, neighbours)
    large = sizes(labelled).filter(F.col("cells") >= grid.min_cells(hectares))
    return labelled.join(large, "label", "left_semi").select("row", "c0", "c1")


def touching_components(mask: DataFrame, seeds: DataFrame, grid: GridSpec, neighbours: int = 8) -> DataFrame:
    """Components with at least one seed cell (row, col)."""
    labelled = components(mask, grid, neighbours)
    hit = sample_labels(seeds.select("row", "col").distinct(), labelled).filter("label is not null").select("label").distinct()
    return labelled.join(hit, "label", "left_semi").select("row", "c0", "c1")


def sample_labels(points: DataFrame, labelled: DataFrame) -> DataFrame:
    """points (…, row, col) with the label of their cell, null outside. Runs are found by row and band of columns."""
    band = labelled.select(F.col("row").alias("lr"), "c0", "c1", "label", F.explode(F.sequence(F.floor(F.col("c0") / BAND), F.floor(F.col("c1") / BAND))).alias("band"))
    hit = (F.col("row") == F.col("lr")) & (F.floor(F.col("col") / BAND) == F.col("band")) & F.col("col").between(F.col("c0"), F.col("c1"))
    return points.join(band, hit, "left").drop("lr", "c0", "c1", "band")


def sample_mask(points: DataFrame, mask: DataFrame, name: str = "inside") -> DataFrame:
    """points with a boolean: whether their cell is set."""
    return sample_labels(points, mask.select("row", "c0", "c1", F.lit(1).alias("label"))).withColumn(name, F.col("label").isNotNull()).drop("label")
