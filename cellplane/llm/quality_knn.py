"""Operator 10: quality classification by nearest-neighbour voting in a latent semantic space.

Texts are counts of 2048 hashed byte trigrams and 48 style marks; tf-idf weights take the document frequencies of the whole table.
A truncated singular value decomposition of labelled documents gives a space of 64 dimensions. The labelled vectors, at most
`sample` of them (those of least hash of the key, a stated bound on what is fitted and sent to executors), go to every executor; each
document is held against all of them in blocks of exact cosine products, and its nearest `near` vote with weights that rise
steeply with similarity. The weights of the two labels are balanced against their shares among the labelled.

Similarities count to six digits; of neighbours that are equally near, those of the least keys vote.

Rows whose crc32 of the key as text is divisible by `folds` are held out: their labels are never read. Labels, language, source and key are no inputs.

Defined results: null texts count as empty; a text without trigrams gets the labelled rows' share of label 1. A key labelled twice counts
by its greatest label; null labels are left out. With no labels all scores are 0.5. Rows repeat as they do in the input and are scored
alike; texts of any length are taken whole. Keys must be whole numbers or castable to such; a key column named like a result column comes
back as key_<name>, other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, own_name, table
from .features import STEPS, STYLES, styles, trigrams
from .words import blocks

BITS, DIMENSIONS, SAMPLE, NEAR, FOLDS, CUT = 11, 64, 4000, 25, 5, 0.3
WIDTH = (1 << BITS) + STYLES * STEPS


def counted(texts: list[bytes]) -> np.ndarray:
    return np.concatenate([trigrams(texts, BITS, fold=False), styles(texts).astype(np.int64)], axis=1)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of length 1: log counts times idf; the marks have half of the weight. A text without trigrams is all 0."""
    x = np.log1p(counts).astype(np.float32) * idf
    for part in (slice(0, 1 << BITS), slice(1 << BITS, WIDTH)):
        x[:, part] /= np.maximum(np.linalg.norm(x[:, part], axis=1, keepdims=True), 1e-9)
    x[counts[:, : 1 << BITS].sum(axis=1) == 0] = 0
    return x


def texts_in(batches):
    rows = ((t.as_py() or b"", k) for b in batches for t, k in zip(b.column("text"), b.column("k").to_pylist(), strict=True))
    return blocks(rows)


def frequencies(batches):
    """How many of the task's documents have each feature; feature -1 counts the documents."""
    df, n = np.zeros(WIDTH, dtype=np.int64), 0
    for block in texts_in(batches):
        df += (counted([t for t, _ in block]) > 0).sum(axis=0)
        n += len(block)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, WIDTH), pa.int32()), pa.array(np.concatenate([[n], df]))], names=["feature", "n"])


def vectors(batches):
    for block in texts_in(batches):
        x = np.minimum(counted([t for t, _ in block]), 65535).astype(np.uint16)
        yield pa.RecordBatch.from_arrays([pa.array([k for _, k in block], pa.int64()), pa.array([row.tobytes() for row in x], pa.binary())], names=["k", "x"])


def nearest(sims: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest values of each row; of equal values the first places."""
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(sims, top, axis=1).min(axis=1, keepdims=True)
    for i in np.flatnonzero((sims >= least).sum(axis=1) > k):
        top[i] = np.argsort(-sims[i], kind="stable")[:k]
    return top


def vote(idf: np.ndarray, axes: np.ndarray, known: np.ndarray, labels: np.ndarray, near: int):
    share = float(labels.mean()) if len(labels) else 0.5
    per = np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)).astype(np.float32)

    def run(batches):
        for block in texts_in(batches):
            x = weighted(counted([t for t, _ in block]), idf)
            out = np.full(len(block), share)
            if len(known):
                z = x @ axes
                size = np.linalg.norm(z, axis=1)
                sims = (z / np.maximum(size, 1e-9)[:, None]) @ known.T
                top = nearest(np.round(sims, 6), min(near, len(known)))
                sim = np.take_along_axis(sims, top, axis=1)
                weight = np.exp(12.0 * (sim - sim.max(axis=1, keepdims=True)).astype(np.float64)) * per[top]
                score = np.clip((weight * labels[top]).sum(axis=1) / weight.sum(axis=1), 0.0, 1.0)
                out = np.where(size > 1e-6, score, share)
            yield pa.RecordBatch.from_arrays([pa.array([k for _, k in block], pa.int64()), pa.array(out.astype(np.float64))], names=["k", "score"])

    return run


def held_out(key: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))


def nearest_votes(docs: DataFrame, key: str, text: str, labels: DataFrame, label: str, sample: int = SAMPLE, near: int = NEAR) -> DataFrame:
    """One row for each document: the key, held_out, score. labels: the key and a label of 0 or 1."""
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    bounded_batches(docs.sparkSession)
    counts = rows.mapInArrow(frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    found = {r.feature: r.n for r in counts}
    idf = np.log((1 + found.get(-1, 0)) / (1 + np.array([found.get(i, 0) for i in range(WIDTH)], dtype=np.float64))).astype(np.float32) + np.float32(0.1)
    marked = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
    marked = marked.groupBy(F.col(key).cast("long").alias("k")).agg(F.max(label).cast("int").alias("y"))
    marked = marked.join(rows.select("k").distinct(), "k", "left_semi").orderBy(F.xxhash64("k"), "k").limit(sample)
    chosen = {r.k: r.y for r in marked.collect()}
    seen: dict[int, np.ndarray] = {}
    if chosen:
        few = rows.sparkSession.createDataFrame([(k,) for k in chosen], "k long")
        for r in rows.join(F.broadcast(few), "k").mapInArrow(vectors, "k long, x binary").toLocalIterator():
            seen[r.k] = min(seen.get(r.k, r.x), r.x)
    order = sorted(seen)
    y = np.array([chosen[k] for k in order], dtype=np.int64)
    x = weighted(np.array([np.frombuffer(seen.pop(k), np.uint16) for k in order]).reshape(len(order), WIDTH), idf)
    if len(order):
        _, vecs = np.linalg.eigh(x.T.astype(np.float64) @ x)
        axes = np.ascontiguousarray(vecs[:, ::-1][:, :DIMENSIONS]).astype(np.float32)
        z = x @ axes
        known = z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
    else:
        axes, known = np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32)
    scored = rows.mapInArrow(vote(idf, axes, known, y, near), "k long, score double")
    return scored.select(F.col("k").alias(own_name(key, ["held_out", "score"])), held_out(F.col("k")).alias("held_out"), "score")


def op10_quality_knn(spark, sf_dir):
    out = nearest_votes(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "labels"), "quality")
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
