"""Value planes as square tiles: a row holds side x side cells as one array, so a neighbourhood costs a margin of cells, not a row for each weight.

A tile is (tr, tc, data): data are float64 values by rows, NaN where a cell is missing. The tiles at the lower and right edge of a grid are cut to it. An
operator over neighbourhoods sends each tile to itself and its margins to the eight tiles around it, and works on whole arrays in one grouped
Arrow pass. Tiles that are not there hold the fill value, so sparse planes stay sparse. A task holds one tile with its margin.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.operators import raster

SIDE = 256
TILE = "tr int, tc int, data binary"
_PART = "tr int, tc int, r0 int, c0 int, h int, w int, data binary"


def _shape(grid: GridSpec, side: int, tr: int, tc: int) -> tuple[int, int]:
    return min(side, grid.height - tr * side), min(side, grid.width - tc * side)


def from_cells(plane: DataFrame, grid: GridSpec, fill: float = float("nan"), side: int = SIDE) -> DataFrame:
    """Tiles of cells (row, col, v), each cell once; the others of a tile hold the fill value."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        tr, tc = (k.as_py() for k in key)
        out = np.full(_shape(grid, side, tr, tc), fill)
        v = t.column("v").to_numpy(zero_copy_only=False).astype(float)
        out[t.column("row").to_numpy() - tr * side, t.column("col").to_numpy() - tc * side] = v
        return pa.table([pa.array([tr], pa.int32()), pa.array([tc], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["tr", "tc", "data"])

    own = plane.select("row", "col", F.col("v").cast("double").alias("v"), F.expr(f"cast(row div {side} as int)").alias("tr"), F.expr(f"cast(col div {side} as int)").alias("tc"))
    return own.filter(f"row >= 0 and col >= 0 and row < {grid.height} and col < {grid.width}").groupBy("tr", "tc").applyInArrow(run, TILE)


def to_cells(tiles: DataFrame, grid: GridSpec, keep: Callable[[np.ndarray], np.ndarray] = lambda v: ~np.isnan(v), side: int = SIDE) -> DataFrame:
    """(row, col, v) of the cells that are kept: those that are not missing, unless said otherwise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tr, tc, data in zip(*[c.to_pylist() for c in b.columns], strict=True):
                v = np.frombuffer(data).reshape(_shape(grid, side, tr, tc))
                r, c = np.nonzero(keep(v))
                yield pa.RecordBatch.from_arrays([pa.array((r + tr * side).astype(np.int32)), pa.array((c + tc * side).astype(np.int32)), pa.array(v[r, c])], ["row", "col", "v"])

    return tiles.select("tr", "tc", "data").mapInArrow(run, "row int, col int, v double")


def mapped(tiles: DataFrame, grid: GridSpec, fn: Callable[[np.ndarray], np.ndarray], side: int = SIDE) -> DataFrame:
    """fn of each tile's array, without a shuffle: values by place, or blocks of cells if the side is a multiple of theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tr, tc, data in zip(*[c.to_pylist() for c in b.columns], strict=True):
                out = np.ascontiguousarray(fn(np.frombuffer(data).reshape(_shape(grid, side, tr, tc))), dtype=float)
                yield pa.RecordBatch.from_arrays([pa.array([tr], pa.int32()), pa.array([tc], pa.int32()), pa.array([out.tobytes()], pa.binary())], ["tr", "tc", "data"])

    return tiles.select("tr", "tc", "data").mapInArrow(run, TILE)


def _assembled(dealt: DataFrame, shape: Callable[[int, int], tuple[int, int, int, int]], fill: float, fn: Callable[[np.ndarray, int, int], np.ndarray | None]) -> DataFrame:
    """fn of each tile's window, put together from the parts (r0, c0 on the whole grid) that were dealt to it. shape: first row and column, height and width of the window."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        tr, tc = (k.as_py() for k in key)
        r0, c0, h, w = shape(tr, tc)
        window = np.full((h, w), fill)
        for r, c, ph, pw, data in zip(*[t.column(n).to_pylist() for n in ("r0", "c0", "h", "w", "data")], strict=True):
            window[r - r0 : r - r0 + ph, c - c0 : c - c0 + pw] = np.frombuffer(data).reshape(ph, pw)
        out = fn(window, tr, tc)
        rows = [] if out is None else [np.ascontiguousarray(out, dtype=float).tobytes()]
        return pa.table([pa.array([tr] * len(rows), pa.int32()), pa.array([tc] * len(rows), pa.int32()), pa.array(rows, pa.binary())], names=["tr", "tc", "data"])

    return dealt.groupBy("tr", "tc").applyInArrow(run, TILE)


def _dealt(tiles: DataFrame, grid: GridSpec, side: int, to: Callable[[int, int, int, int], Iterator[tuple[int, int, int, int, int, int]]]) -> DataFrame:
    """Parts of tiles on their way. to: (r0, r1, c0, c1) of a tile to (tr, tc, r0, r1, c0, c1) of what each receiver gets of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tr, tc, data in zip(*[c.to_pylist() for c in b.columns], strict=True):
                h, w = _shape(grid, side, tr, tc)
                v, top, left = np.frombuffer(data).reshape(h, w), tr * side, tc * side
                rows = [(a, b_, r0, c0, r1 - r0, c1 - c0, v[r0 - top : r1 - top, c0 - left : c1 - left].tobytes()) for a, b_, r0, r1, c0, c1 in to(top, top + h, left, left + w)]
                kinds = [pa.int32()] * 6 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["tr", "tc", "r0", "c0", "h", "w", "data"])

    return tiles.select("tr", "tc", "data").mapInArrow(run, _PART)


def windowed(tiles: DataFrame, grid: GridSpec, reach: int, fn: Callable[[np.ndarray], np.ndarray], edge: str, fill: float = float("nan"), side: int = SIDE) -> DataFrame:
    """fn of each tile with a margin of reach cells, to an array of the tile's size; edge: numpy's name of what lies beyond the grid (edge, symmetric).

    A tile that is missing is made too if a neighbour's margin reaches into it.
    """
    last_r, last_c = (grid.height - 1) // side, (grid.width - 1) // side

    def to(r0: int, r1: int, c0: int, c1: int) -> Iterator[tuple[int, int, int, int, int, int]]:
        for tr in range(max(0, (r0 - reach) // side), min(last_r, (r1 - 1 + reach) // side) + 1):
            for tc in range(max(0, (c0 - reach) // side), min(last_c, (c1 - 1 + reach) // side) + 1):
                h, w = _shape(grid, side, tr, tc)
                yield tr, tc, max(r0, tr * side - reach), min(r1, tr * side + h + reach), max(c0, tc * side - reach), min(c1, tc * side + w + reach)

    def shape(tr: int, tc: int) -> tuple[int, int, int, int]:
        h, w = _shape(grid, side, tr, tc)
        r0, c0 = max(0, tr * side - reach), max(0, tc * side - reach)
        return r0, c0, min(grid.height, tr * side + h + reach) - r0, min(grid.width, tc * side + w + reach) - c0

    def run(window: np.ndarray, tr: int, tc: int) -> np.ndarray:
        h, w = _shape(grid, side, tr, tc)
        r0, c0, n, m = shape(tr, tc)
        above, before = reach - (tr * side - r0), reach - (tc * side - c0)
        return fn(np.pad(window, ((above, h + 2 * reach - n - above), (before, w + 2 * reach - m - before)), mode=edge))

    return _assembled(_dealt(tiles, grid, side, to), shape, fill, run)


def block_mean(k: int) -> Callable[[np.ndarray], np.ndarray]:
    """Means of k x k cells of an array; what the last blocks lack repeats the array's edge."""

    def fn(v: np.ndarray) -> np.ndarray:
        v = np.pad(v, ((0, -v.shape[0] % k), (0, -v.shape[1] % k)), mode="edge")
        return v.reshape(v.shape[0] // k, k, v.shape[1] // k, k).mean(axis=(1, 3))

    return fn


def slope_percent(tiles: DataFrame, grid: GridSpec, k: int, side: int = SIDE, fill: float = float("nan")) -> tuple[DataFrame, GridSpec, int]:
    """Sobel gradient of means of k x k cells, edges repeated, as rise over run in percent: tiles, their grid and side. fill: the height of tiles that are not there."""
    if side % k:
        raise ValueError(f"tiles of {side} cells are not made of blocks of {k}")
    coarse = GridSpec(-(-grid.width // k), -(-grid.height // k), grid.cell_m * k, grid.x0, grid.y_top)

    def fn(v: np.ndarray) -> np.ndarray:
        a, b, c = v[:-2], v[1:-1], v[2:]
        gx = (a[:, 2:] + 2 * b[:, 2:] + c[:, 2:]) - (a[:, :-2] + 2 * b[:, :-2] + c[:, :-2])
        gy = (c[:, :-2] + 2 * c[:, 1:-1] + c[:, 2:]) - (a[:, :-2] + 2 * a[:, 1:-1] + a[:, 2:])
        return np.hypot(gx, gy) / (8 * coarse.cell_m) * 100

    return windowed(mapped(tiles, grid, block_mean(k), side), coarse, 1, fn, "edge", fill, side // k), coarse, side // k


def blur_percent(tiles: DataFrame, metres: float, grid: GridSpec, side: int = SIDE) -> DataFrame:
    """Gaussian of a mask (1 where set, missing tiles 0), mirrored edges, cut at four sigma, in whole percent."""
    weights = raster.kernel(metres / grid.cell_m)
    reach = max(weights)
    w = [weights[o][0] for o in range(-reach, reach + 1)]

    def fn(v: np.ndarray) -> np.ndarray:
        one = sum(x * v[i : v.shape[0] - 2 * reach + i] for i, x in enumerate(w))
        two = sum(x * one[:, i : v.shape[1] - 2 * reach + i] for i, x in enumerate(w))
        return np.clip(np.rint(np.round(two * 100, 9)), 0, 100)

    return windowed(tiles, grid, reach, fn, "symmetric", 0.0, side)


def warped(tiles: DataFrame, source: GridSpec, target: GridSpec, how: str, side: int = SIDE) -> DataFrame:
    """A plane on another grid with the same axes, by the share of each source cell that a target cell covers: average, or the greatest of those it meets.
    Missing source cells take no part; a target cell that meets none is missing."""
    if how not in ("average", "greatest"):
        raise ValueError(f"no way to warp: {how!r}")

    def edges(first: int, n: int, axis: int) -> np.ndarray:
        """Edges of n target cells from the first on, counted in source cells."""
        at = first + np.arange(n + 1)
        if axis == 0:
            return (source.y_top - target.y_top + at * target.cell_m) / source.cell_m
        return (target.x0 - source.x0 + at * target.cell_m) / source.cell_m

    def span(first: int, n: int, axis: int) -> tuple[int, int]:
        e = edges(first, n, axis)
        return max(0, int(np.floor(e[0]))), min(source.height if axis == 0 else source.width, int(np.ceil(e[-1])))

    def targets(lo: int, hi: int, axis: int) -> range:
        """Tiles of the target that source cells lo to hi reach."""
        shift = (source.y_top - target.y_top if axis == 0 else target.x0 - source.x0) / source.cell_m
        a, b = ((x - shift) * source.cell_m / target.cell_m for x in (lo, hi))
        n = target.height if axis == 0 else target.width
        return range(max(0, int(np.floor(a)) // side), min(n - 1, int(np.ceil(b))) // side + 1)

    def shape(tr: int, tc: int) -> tuple[int, int, int, int]:
        h, w = _shape(target, side, tr, tc)
        (r0, r1), (c0, c1) = span(tr * side, h, 0), span(tc * side, w, 1)
        return r0, c0, max(r1 - r0, 0), max(c1 - c0, 0)

    def to(r0: int, r1: int, c0: int, c1: int) -> Iterator[tuple[int, int, int, int, int, int]]:
        for tr in targets(r0, r1, 0):
            for tc in targets(c0, c1, 1):
                a, b, h, w = shape(tr, tc)
                part = max(r0, a), min(r1, a + h), max(c0, b), min(c1, b + w)
                if part[0] < part[1] and part[2] < part[3]:
                    yield (tr, tc, *part)

    def weights(first: int, n: int, axis: int, lo: int, m: int) -> np.ndarray:
        e, cell = edges(first, n, axis), lo + np.arange(m)
        return np.maximum(0.0, np.minimum(e[1:, None], cell[None] + 1) - np.maximum(e[:-1, None], cell[None]))

    def run(window: np.ndarray, tr: int, tc: int) -> np.ndarray:
        h, w = _shape(target, side, tr, tc)
        r0, c0, n, m = shape(tr, tc)
        down, across = weights(tr * side, h, 0, r0, n), weights(tc * side, w, 1, c0, m)
        known = ~np.isnan(window)
        if how == "average":
            share = down @ known.astype(float) @ across.T
            with np.errstate(invalid="ignore"):
                return np.where(share > 1e-12, (down @ np.where(known, window, 0.0) @ across.T) / share, np.nan)
        v = np.where(known, window, -np.inf)
        rows = np.stack([v[x > 1e-12].max(axis=0, initial=-np.inf) for x in down])
        out = np.stack([rows[:, x > 1e-12].max(axis=1, initial=-np.inf) for x in across], axis=1)
        return np.where(np.isinf(out), np.nan, out)

    return _assembled(_dealt(tiles, source, side, to), shape, float("nan"), run)
