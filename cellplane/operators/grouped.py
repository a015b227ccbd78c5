"""Groups of rows worked on in Arrow batches: many groups to a call, where each is too small for a call of its own.

Tasks get functions by value: what runs in them names functions of this package, not its modules.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cellplane.operators.spatial import dealt

POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])


def changes(t: pa.Table, names: list[str]) -> np.ndarray:
    """Where rows begin that differ in the named columns from the row before; the first does."""
    out = np.zeros(t.num_rows, dtype=bool)
    out[:1] = True
    for n in names:
        code = pc.fill_null(pa.concat_arrays(t.column(n).chunks).dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        out[1:] |= code[1:] != code[:-1]
    return out


def firsts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal rows one number each, in the order of the rows' columns, and for each row its place among those."""
    order = np.lexsort(rows.T[::-1])
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[order[1:]] != rows[order[:-1]]).any(axis=1)
    group = np.empty(len(rows), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group


def worked(df: DataFrame, names: list[str], solve: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str, order: tuple[str, ...] = ()) -> DataFrame:
    """What solve(rows, starts of groups) makes of whole groups of rows alike in the named columns, as many at once as a batch holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # the last group may go on in the next batch
        whole = lambda t: solve(t, np.flatnonzero(changes(t, names)))
        for b in batches:
            t = pa.Table.from_batches([b])
            if not t.num_rows:
                continue
            new = np.flatnonzero(changes(pa.concat_tables([*[h.slice(0, 1) for h in held[:1]], t]), names))[1:] - bool(held)
            if len(new):
                yield from whole(pa.concat_tables([*held, t.slice(0, int(new[-1]))]))
                held = [t.slice(int(new[-1]))]
            else:
                held.append(t)
        if held:
            yield from whole(pa.concat_tables(held))

    return dealt(df, *names).sortWithinPartitions(*names, *order).mapInArrow(run, schema)


def array(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """A column in one piece."""
    return column if isinstance(column, pa.Array) else column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def offsets(many: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(many)]).astype(np.int64)


def lists(values: np.ndarray, many: np.ndarray) -> pa.Array:
    """Lists of so many values each."""
    return pa.ListArray.from_arrays(pa.array(offsets(many), pa.int32()), pa.array(values, pa.float64()))


def points(xy: np.ndarray, many: np.ndarray) -> pa.Array:
    """Lists of so many points (x, y) each."""
    made = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[:, i]), pa.float64()) for i in (0, 1)], fields=list(POINT))
    return pa.ListArray.from_arrays(pa.array(offsets(many), pa.int32()), made)


def coordinates(lists_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Points (n, 2) of lists of points, and where each list begins; the last entry is their number."""
    xy = lists_.flatten().flatten()
    return np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in xy], axis=1), offsets(sizes(lists_))


def joined(parts: list[np.ndarray]) -> pa.Array:
    """Lists of points of arrays (n, 2)."""
    return points(np.concatenate([np.empty((0, 2)), *parts]), np.array([len(p) for p in parts], dtype=np.int64))
