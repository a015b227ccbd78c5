"""Lines joined end to end over a distributed table.

Two lines are linked where just they end at a point. Linked lines are components of a graph without branches, found by least labels and pointer jumping; the
lines of one component are laid one behind the other in one pass over them, so the work is linear in the pieces. A joined line is a row and must fit in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellplane.operators.components import least_labels
from cellplane.operators.grouped import array, coordinates, joined, worked
from cellplane.operators.rings import FINE, POINTS
from cellplane.scratch import materialise

def _walked(first: dict[int, tuple], last: dict[int, tuple], joints: set[tuple]) -> tuple[list[tuple[int, bool]], bool]:
    """The lines of one chain (where each begins and ends), one behind the other from the chain's open end of least number, each with whether it runs backwards; and whether the
    chain has no open end: such a one begins with its least line."""
    at: dict[tuple, list[int]] = {}
    for i in first:
        for p in (first[i], last[i]):
            at.setdefault(p, []).append(i)
    ends = sorted((i, side) for i in first for side, p in enumerate((first[i], last[i])) if p not in joints)
    i, side = ends[0] if ends else (min(first), 0)
    out, seen, tip = [(i, side == 1)], {i}, last[i] if side == 0 else first[i]
    while len(seen) < len(first):
        i = next(j for j in at[tip] if j not in seen)
        seen.add(i)
        out.append((i, first[i] != tip))
        tip = last[i] if first[i] == tip else first[i]
    return out, not ends


def merged(lines: DataFrame) -> DataFrame:
    """(chain, n_lines, points, endless) of lines (id, points), ids being different whole numbers: chain is the least id of the lines that are joined. Lines of fewer
    than two points have no part. A chain that closes where other lines end too begins and ends there; endless are closed chains that meet no other line."""
    own = materialise(lines.filter(F.size("points") > 1).select(F.col("id").cast("long").alias("id"), "points"), "lines")
    spot = lambda p: F.struct(F.rint(p["x"] * FINE).cast("long").alias("x"), F.rint(p["y"] * FINE).cast("long").alias("y"))  # halves go to even, as in NumPy
    ends = own.select("id", F.explode(F.array(spot(F.get("points", 0)), spot(F.get("points", F.size("points") - 1)))).alias("at"))
    links = ends.groupBy("at").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).filter("n = 2 and a <> b").select("a", "b", "at")
    links = materialise(links, "line-links")
    of = least_labels(links.select("a", "b"), lambda df: materialise(df, "line-rounds"))
    joints = links.groupBy(F.col("a").alias("id")).agg(F.collect_list("at").alias("joints"))  # a line has two ends, so two at most
    chained = own.join(of.select(F.col("v").alias("id"), "label").hint("merge"), "id", "left").join(joints.hint("merge"), "id", "left")
    chained = chained.select(F.coalesce("label", "id").alias("chain"), "id", "points", "joints")

    def run(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Many chains at once."""
        xy, begin = coordinates(array(t.column("points")))
        spots = np.round(xy * FINE).astype(np.int64)
        first, last = ([tuple(p) for p in spots[at].tolist()] for at in (begin[:-1], begin[1:] - 1))
        ids, joints = t.column("id").to_pylist(), t.column("joints").to_pylist()
        parts, many, endless = [], np.diff(np.append(starts, t.num_rows)), []
        for g, n in zip(starts.tolist(), many.tolist(), strict=True):
            rows = range(g, g + n)
            row = {ids[r]: r for r in rows}
            way, open_ = [(ids[g], False)], False
            if n > 1 or joints[g]:
                met = {(p["x"], p["y"]) for r in rows for p in joints[r] or []}
                way, open_ = _walked({ids[r]: first[r] for r in rows}, {ids[r]: last[r] for r in rows}, met)
            laid = [xy[begin[row[i]] : begin[row[i] + 1]][:: -1 if back else 1] for i, back in way]
            parts.append(laid[0] if n == 1 else np.concatenate([laid[0], *[p[1:] for p in laid[1:]]]))
            endless.append(open_)
        yield pa.RecordBatch.from_arrays([array(t.column("chain")).take(pa.array(starts)), pa.array(many), joined(parts), pa.array(endless)], names=["chain", "n_lines", "points", "endless"])

    return worked(chained, ["chain"], run, f"chain long, n_lines long, points {POINTS}, endless boolean")
