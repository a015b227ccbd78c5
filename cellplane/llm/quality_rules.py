"""Operator 6: quality rules on repetition inside a document, by suffix arrays over words.

The suffixes of all documents of a block are sorted at once by prefix doubling; words of different documents never compare equal,
and a suffix leaves the sort as soon as it stands alone. The ranks of each round give the longest common prefix of neighbours, and
the greater of a suffix's two is its longest repeat: the intervals of equal prefixes are the maximal repeated substrings. Those of
`shortest` words or more are united; a document fails if they cover more than `covered` of its words or one is longer than `longest`.

A level of the sort keeps only the suffixes that do not stand alone yet, at eight bytes each.

Beside them stand base counts: words, code points in words, symbols, repeated lines, words in repeated three-word windows.

Defined results: null texts have no words; a document of fewer than 50 words fails. Rows repeat as they do in the input. Documents
are judged one by one, so copies have equal results. Texts of any length are taken whole. Keys must be whole numbers or castable to
such; a key column named like a result column comes back as key_<name>, other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesops import Spans, mix
from .common import bounded_batches, own_name, table
from .words import _GAP, BLOCK, blocks

SHORTEST, COVERED, LONGEST = 5, 0.3, 60
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")
SCHEMA = pa.schema([("k", pa.int64()), *[(f, pa.int64()) for f in FIELDS]])


def dense(*keys: np.ndarray) -> np.ndarray:
    """Rank of each record: the number of records below its key, equal for equal keys."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return out


def longest_repeats(codes: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each position of texts one after another, the length of the longest run from it that the text has elsewhere too.

    codes: equal for equal words of one text, different across texts. end: where the position's text ends.
    """
    n = len(codes)
    if not n:
        return np.empty(0, dtype=np.int64)
    rank, step, levels = dense(codes).astype(np.int32), 1, []  # positions of a block are fewer than 2^31: it has fewer bytes
    while True:
        size = np.bincount(rank, minlength=n)
        active = np.flatnonzero(size[rank] > 1).astype(np.int32)
        del size
        if not len(active):
            break
        first = rank[active]
        levels.append((active, first))  # other positions stand alone, so they equal none at this level
        after = active.astype(np.int64) + step
        inside = after < end[active]
        key = np.where(inside, rank[np.minimum(after, n - 1)] + 1, active - end[active])  # a shorter suffix equals no other
        del after, inside
        key += n
        key += first.astype(np.int64) * (2 * n + 2)
        order = np.argsort(key)
        key, f = key[order], first[order]
        head, new = (np.ones(len(f), dtype=bool) for _ in range(2))
        head[1:] = f[1:] != f[:-1]
        new[1:] = key[1:] != key[:-1]
        del key
        place = np.arange(len(f), dtype=np.int32)
        f += np.maximum.accumulate(np.where(new, place, np.int32(0)))
        f -= np.maximum.accumulate(np.where(head, place, np.int32(0)))
        rank = rank.copy()
        rank[active[order]] = f
        del order, place, head, new, f
        step *= 2
    order = np.empty(n, dtype=np.int32)
    order[rank] = np.arange(n, dtype=np.int32)
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, dtype=np.int32)
    live = np.flatnonzero(codes[a] == codes[b])
    x, y = a[live], b[live]  # copies; ends of the texts do not change along a walk
    stop_x, stop_y, got = end[x], end[y], np.zeros(len(live), dtype=np.int32)
    while levels:
        active, first = levels.pop()
        rank[active] = first  # the ranks of this level; those of positions alone differ from all
        ok = (x < stop_x) & (y < stop_y)
        ok &= rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)]
        more = ok.astype(np.int32) << np.int32(len(levels))
        got += more
        x += more
        y += more
    common[live] = got
    out = np.zeros(n, dtype=np.int64)
    out[a] = common
    out[b] = np.maximum(out[b], common)
    return out


def covered_by(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in some run [start, start + length)."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def measured(texts: list[bytes], shortest: int) -> list[np.ndarray]:
    """The counts of FIELDS for each text."""
    d = len(texts)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    gap = _GAP[data]
    edge = np.diff(np.concatenate([[True], gap]).astype(np.int8))
    start = np.flatnonzero(edge == -1)
    stop = np.flatnonzero(edge == 1)  # the closing line feed is a gap
    doc = np.searchsorted(begin, start, side="right") - 1
    of = lambda mask: np.add.reduceat(mask, begin[:-1], dtype=np.int64) if d else np.zeros(0, dtype=np.int64)
    n_words = np.bincount(doc, minlength=d)
    chars, symbols = of(~gap & ((data & 0xC0) != 0x80)), of(_SYMBOL[data])
    spans = Spans(data, 12)
    line_end = np.flatnonzero(data == 0x0A)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    worded = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end = line_start[worded], line_end[worded]
    line_doc = np.searchsorted(begin, line_start, side="right") - 1
    line = mix(spans.of(line_start, line_end) + (line_end - line_start).astype(np.uint64))
    order = np.lexsort((line, line_doc))
    same = np.flatnonzero((line[order][1:] == line[order][:-1]) & (line_doc[order][1:] == line_doc[order][:-1]))
    dup_lines = np.bincount(line_doc[order][same + 1], minlength=d)
    word = mix(spans.of(start, stop) + (stop - start).astype(np.uint64))
    n = len(word)
    codes = dense(doc, word)
    del spans, data, gap, edge, start, stop, word, line_start, line_end, worded, line  # the sort needs the room
    end = np.cumsum(n_words)[doc] if len(doc) else doc
    repeat = longest_repeats(codes, end)
    # A three-word window found twice is a repeat of three words or more.
    tri = np.flatnonzero(repeat >= 3)
    per = lambda mask: np.bincount(doc[mask], minlength=d)
    thrice = per(covered_by(tri, np.full(len(tri), 3), n))
    long = np.flatnonzero(repeat >= shortest)
    covered = per(covered_by(long, repeat[long], n))
    longest = np.zeros(d, dtype=np.int64)
    np.maximum.at(longest, doc, repeat)
    return [n_words, chars, symbols, dup_lines, thrice, covered, longest]


def measure(shortest: int):
    def run(batches):
        rows = ((t.as_py() or b"", k) for b in batches for t, k in zip(b.column("text"), b.column("k").to_pylist(), strict=True))
        for block in blocks(rows, BLOCK // 2):
            counts = measured([t for t, _ in block], shortest)
            yield pa.RecordBatch.from_arrays([pa.array([k for _, k in block], pa.int64()), *[pa.array(c.astype(np.int64)) for c in counts]], schema=SCHEMA)

    return run


def repetition_rules(docs: DataFrame, key: str, text: str, shortest: int = SHORTEST, covered: float = COVERED, longest: int = LONGEST) -> DataFrame:
    """One row for each document: the key, the base counts, covered_words, longest_repeat, base_failed, kept."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("binary").alias("text"))
    out = rows.mapInArrow(measure(shortest), "k long, " + ", ".join(f"{f} long" for f in FIELDS))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fine = (F.col("covered_words") <= covered * F.col("n_words")) & (F.col("longest_repeat") <= longest)
    return out.select(F.col("k").alias(own_name(key, [*FIELDS, "base_failed", "kept"])), *FIELDS, failed.alias("base_failed"), (~failed & fine).alias("kept"))


def op6_quality_rules(spark, sf_dir):
    out = repetition_rules(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words", "longest_repeat")
