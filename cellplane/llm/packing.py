"""Operator 4: packing into optimal length buckets.

The global histogram of lengths (one row for each length that occurs) goes to a dynamic programme that picks the bucket boundaries with
the least padding; inside each bucket, batches of documents fill a token budget. Least costs and their boundaries move only upwards with the
length, so each bucket's column of the programme is found by halving, in m log m steps for m lengths: every length is looked at, at any scale.

Defined results: null or wordless texts have length 0 and lie in the first bucket; a document longer than the budget makes a
batch of its own. Rows repeat as they do in the input. Among boundaries of equal padding the lower ones are taken. Batches are numbered from 0 in
each bucket, without gaps: every batch of a bucket but the last holds floor(budget / boundary) documents, in an order by hash of the key. A key
column named like a result column comes back as key_<name>; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytesops import ranges
from .common import materialise, n_words, numbered, own_name, table


def boundaries(lengths: np.ndarray, counts: np.ndarray, k: int) -> list[int]:
    """At most k boundaries (greatest lengths of buckets) with the least sum of boundary - length. lengths: ascending, distinct."""
    m = len(lengths)
    if m <= k:
        return [int(x) for x in lengths]
    top = np.concatenate([[0], lengths]).astype(np.int64)
    n = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    cost = top * n  # cost[j]: least padded size of the first j lengths, in one bucket
    chosen = [np.zeros(m + 1, dtype=np.int64)]
    for _ in range(k - 1):
        best, pick = cost.copy(), np.zeros(m + 1, dtype=np.int64)
        # Pieces (lo, hi) of places whose boundaries lie in [low, high]: all middles of a level at once.
        lo, hi, low, high = (np.array([x], dtype=np.int64) for x in (1, m, 0, m - 1))
        while len(lo):
            mid = (lo + hi) // 2
            many = np.minimum(high, mid - 1) - low + 1
            of, i = np.repeat(np.arange(len(mid)), many), ranges(low, many)
            tried = cost[i] + top[mid[of]] * (n[mid[of]] - n[i])
            begin = np.cumsum(many) - many
            least = np.minimum.reduceat(tried, begin)
            hit = np.flatnonzero(tried == least[of])
            at = i[hit[np.searchsorted(of[hit], np.arange(len(mid)))]]
            best[mid], pick[mid] = least, at
            lo, hi, low, high = (np.concatenate(x) for x in ((lo, mid + 1), (mid - 1, hi), (low, at), (at, high)))
            some = lo <= hi
            lo, hi, low, high = lo[some], hi[some], low[some], high[some]
        chosen.append(pick)
        cost = best
    out, j = [], m
    for pick in reversed(chosen):
        if j == 0:
            break
        out.append(int(top[j]))
        j = int(pick[j])
    return sorted(set(out))


def length_buckets(docs: DataFrame, key: str, length: Column, buckets: int = 16, budget: int = 65536) -> DataFrame:
    """One row for each document: the key, n_tokens, bucket_len (padded length), batch (number in the bucket), slot (place in the batch)."""
    key_as = own_name(key, ["n_tokens", "bucket_len", "batch", "slot"])
    rows = materialise(docs.select(F.col(key).alias("k"), F.coalesce(length.cast("long"), F.lit(0)).alias("n")), "pack-rows")
    found = rows.groupBy("n").agg(F.count("*").alias("c")).orderBy("n").toPandas()  # one row for each length
    if not len(found):
        return rows.select(F.col("k").alias(key_as), *[F.lit(0).cast("long").alias(c) for c in ("n_tokens", "bucket_len", "batch", "slot")])
    lengths, counts = found["n"].to_numpy(), found["c"].to_numpy()
    ends = boundaries(lengths, counts, buckets)
    before = [int(counts[lengths <= e].sum()) for e in (-1, *ends[:-1])]
    pick = lambda values: F.coalesce(*[F.when(F.col("n") <= e, F.lit(v).cast("long")) for e, v in zip(ends, values, strict=True)])
    # A bucket, and a key, may hold most rows: places come from ranges of the order, which a random number ends.
    rows = rows.withColumns({"bucket_len": pick(ends), "h": F.xxhash64("k"), "any": F.rand(1)})
    out = numbered(rows, [F.col(c) for c in ("bucket_len", "h", "k", "n", "any")], "nth").withColumn("at", F.col("nth") - pick(before))
    fit = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(F.col("bucket_len"), F.lit(1))))
    return out.select(F.col("k").alias(key_as), F.col("n").alias("n_tokens"), "bucket_len", F.floor(F.col("at") / fit).alias("batch"), (F.col("at") % fit).cast("long").alias("slot"))


def op4_packing(spark, sf_dir):
    return length_buckets(table(spark, sf_dir, "documents"), "doc_id", n_words("text"))
