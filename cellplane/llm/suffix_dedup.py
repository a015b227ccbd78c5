"""Operator 7: removal of repeated byte passages by a depth-limited radix sort of suffixes.

A byte goes if a string of `threshold` bytes around it also starts earlier (smaller key, or same document and earlier start). Suffixes are
ordered only through threshold bytes, most significant digit first, and a suffix that stands alone leaves the sort:

1. Every string of threshold bytes (window) is led by its anchor, the 32-byte gram in it of least hash, which its bytes alone determine. So
   equal windows have equal anchors at equal offsets, and one suffix in 32, the anchors', carries all windows. First digit: the 32 bytes of
   the anchor, by which suffixes are dealt out. Anchors that are met once leave.
2. The run of windows that an anchor leads is compared as a whole. In a group of equal runs all but the first go whole; its first stands
   for it. Anchors with one run leave.
3. Where one anchor leads different runs, their bytes are fetched, and their windows go through passes of 8-byte digits, up to threshold bytes;
   what stands alone leaves after each pass. The groups that are left are exactly the repeated windows.

Each sender packs what it holds for one receiver and drops what an earlier copy of its own decides, so a hot passage costs a
sender one record. An anchor that a sender meets often with different surroundings is dealt out by its runs instead, and
its windows are compared by their own hash; a marker tells the anchor's usual receiver. The first digit is compared as a hash of 96
bits, runs as one of 64 more, windows of hot anchors as one of 128. Receivers are as many as the bytes of all texts ask for
(`VOLUME` each, `SLOTS` at least), whatever the session's partitions.

Defined results: null texts count as empty. Rows that agree in key and text count as one document, and each row gets its result; rows
of one key with different texts are told apart and ordered by a hash of 62 bits, which is checked for clashes before use. Null keys come first; keys must be whole numbers or castable to such.
Texts of any length are worked on whole, in overlapping pieces. Other columns are returned as they are, but for those named like the two new
ones, which are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blobs import DDL, SCHEMA, as_table, batch, by_slot, joined, pack, unpack
from .bytesops import MASK64, Spans, merged, mix, radix_groups, ranges, sliding_min
from .common import bounded_batches, table

GRAM, BLOCK_BITS = 32, 19
POSITION = (1 << BLOCK_BITS) - 1
#: Records that a sender gathers before it packs them; how often it may meet an anchor until it deals it out.
FLUSH, OFTEN = 200_000, 128
#: Bytes of text to a receiver, and the least number of receivers.
VOLUME, SLOTS = 4 << 20, 64
SPANS, POSTINGS, MARKERS, HOT, REQUESTS, CONTEXTS, WINDOWS = range(7)
NULL_KEY = -(1 << 63)


def groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: whether a record is the first of its group, and where its group begins."""
    first = np.ones(len(keys[0]), dtype=bool)
    if len(first):
        first[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return first, np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def repeats(key: list[np.ndarray], place: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the records by key and place; which are the first of their key; which occur later than that first."""
    order = np.lexsort([*reversed(place), *reversed(key)])
    first, begin = groups(*[k[order] for k in key])
    later = np.logical_or.reduce([p[order] != p[order][begin] for p in place])
    return order, first, later


def spans_by_part(k, th, start, end, parts: int, out: list) -> None:
    """Packs spans for their documents, united where they touch."""
    if not len(k):
        return
    order = np.lexsort((th, k))
    k, th, start, end = k[order], th[order], start[order], end[order]
    _, begin = groups(k, th)
    g, s, e = merged(begin, start, end)
    by_slot(th[g].astype(np.int64) % parts, SPANS, [k[g], th[g], s, e - s], out)


def anchors(data: np.ndarray, lens: np.ndarray, threshold: int) -> tuple[np.ndarray, ...]:
    """Of texts one after another: text number, first window and number of windows less one of each run that an anchor leads, anchor's and run's hash."""
    off = np.cumsum(lens) - lens
    n = np.maximum(lens - threshold + 1, 0)
    win, doc = ranges(off, n), np.repeat(np.arange(len(lens)), n)
    if not len(win):
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    gram = mix(Spans(data, 1).grams(GRAM))
    ranked = (gram & np.uint64(MASK64 ^ POSITION)) | np.arange(len(gram), dtype=np.uint64)
    lead = (sliding_min(ranked, threshold - GRAM + 1)[win] & np.uint64(POSITION)).astype(np.int64)
    first, _ = groups(lead, doc)
    at = np.flatnonzero(first)
    last = np.concatenate([at[1:], [len(win)]]) - 1
    a, b, p = win[at], win[last], lead[at]
    shape = (p - a).astype(np.uint64) * np.uint64(1 << 16) + (b - a).astype(np.uint64)
    run = mix(Spans(data, 2).of(a, b + threshold) + shape * np.uint64(0x9E3779B97F4A7C15))
    return doc[at], a - off[doc[at]], b - a, mix(gram[p] + np.uint64(1)), run


class Sender:
    """Gathers the runs of many texts and packs them for their receivers."""

    def __init__(self, threshold: int, slots: int, parts: int):
        self.threshold, self.slots, self.parts = threshold, slots, parts
        self.texts, self.ids, self.size, self.held, self.count = [], [], 0, [], 0

    def add(self, k: int, th: int, text: bytes):
        step = (1 << (BLOCK_BITS - 1)) - self.threshold
        for at in range(0, max(1, len(text) - self.threshold + 1), step):
            piece = text[at : at + step + self.threshold - 1]
            if self.size + len(piece) > POSITION:
                self.block()
            self.texts.append(piece)
            self.ids.append((k, th, at))
            self.size += len(piece)
        if self.count >= FLUSH:
            return self.flush()
        return []

    def block(self):
        if self.texts:
            ids = np.array(self.ids, dtype=np.int64)
            doc, a, run, h, c = anchors(np.frombuffer(b"".join(self.texts), np.uint8), np.array([len(t) for t in self.texts]), self.threshold)
            self.held.append((h, c, ids[doc, 0], ids[doc, 1], a + ids[doc, 2], run))
            self.count += len(doc)
        self.texts, self.ids, self.size = [], [], 0

    def flush(self) -> list:
        self.block()
        out: list = []
        if self.count:
            h, c, k, th, a, run = (np.concatenate(x) for x in zip(*self.held, strict=True))
            order, first, later = repeats([h, c], [k, th, a])
            h, c, k, th, a, run = (x[order] for x in (h, c, k, th, a, run))
            spans_by_part(k[later], th[later], a[later], a[later] + run[later] + self.threshold, self.parts, out)
            h, c, k, th, a, run = (x[first] for x in (h, c, k, th, a, run))
            new, begin = groups(h)
            often = (np.bincount(begin, minlength=len(h))[begin] > OFTEN) if len(h) else new
            slot, digit = (h >> np.uint64(32)).astype(np.int64) % self.slots, h & np.uint64(0xFFFFFFFF)
            post = [digit, c, k, th, a, run]
            by_slot(slot[~often], POSTINGS, [x[~often] for x in post], out)
            by_slot(slot[often & new], MARKERS, [digit[often & new]], out)
            by_slot((mix(h[often] ^ c[often]) >> np.uint64(33)).astype(np.int64) % self.slots, HOT, [x[often] for x in post], out)
        self.held, self.count = [], 0
        return out


def send(threshold: int, slots: int, parts: int):
    def run(batches):
        sender = Sender(threshold, slots, parts)
        for b in batches:
            for k, th, text in zip(b.column("k").to_pylist(), b.column("th").to_pylist(), b.column("text"), strict=True):
                if rows := sender.add(k, th, text.as_py()):
                    yield batch(rows)
        yield batch(sender.flush())

    return run


POST = ("u8", "u8", "i8", "i8", "i8", "i8")


def kinds_of(t: pa.Table) -> dict[int, list[list[np.ndarray]]]:
    pa.default_memory_pool().release_unused()  # what the group before this one held
    got: dict[int, list] = {}
    for kind, data in zip(t.column("kind").to_pylist(), t.column("data").to_pylist(), strict=True):
        got.setdefault(kind, []).append(data)
    return {kind: x if kind == SPANS else [unpack(d) for d in x] for kind, x in got.items()}


def passed(got: dict, out: list, parts: int) -> None:
    """Spans on their way to their documents go on, united."""
    if SPANS in got:
        k, th, s, n = joined([unpack(d) for d in got[SPANS]], ("i8",) * 4)
        spans_by_part(k, th, s, s + n, parts, out)


def first_digits(threshold: int, slots: int, parts: int, chunk: int = 4096):
    """Groups of one anchor: spans of whole runs that occur earlier, requests for the bytes of the rest."""

    def run(t: pa.Table) -> pa.Table:
        got, out = kinds_of(t), []
        here = t.column("slot")[0].as_py()
        for kind in (POSTINGS, HOT):
            h, c, k, th, a, n = joined(got.get(kind, []), POST)
            marked = np.isin(h, joined(got.get(MARKERS, []), ("u8",))[0]) if kind == POSTINGS else np.ones(len(h), bool)
            _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
            keep = (count[inverse] > 1) | marked
            h, c, k, th, a, n, marked = (x[keep] for x in (h, c, k, th, a, n, marked))
            if not len(h):
                continue
            order, first, later = repeats([h, c], [k, th, a])
            h, c, k, th, a, n, marked = (x[order] for x in (h, c, k, th, a, n, marked))
            spans_by_part(k[later], th[later], a[later], a[later] + n[later] + threshold, parts, out)
            h, k, th, a, n, marked = (x[first] for x in (h, k, th, a, n, marked))
            _, begin = groups(h)
            size = np.bincount(begin, minlength=len(h))[begin]
            nth = np.arange(len(h)) - begin
            ask = (size > 1) | marked
            hot = (marked | (size > chunk)).astype(np.uint8)
            to = (mix(h + ((nth // chunk).astype(np.uint64) << np.uint64(32)) + np.uint64(here * 0x9E3779B97F4A7C15 & MASK64)) >> np.uint64(33)).astype(np.int64) % slots
            by_slot(th[ask] % parts, REQUESTS, [x[ask] for x in (k, th, a, n, hot, to)], out)
        passed(got, out, parts)
        return as_table(out)

    return run


def texts_of(docs: pa.Table) -> dict[tuple[int, int], bytes]:
    return dict(zip(zip(docs.column("k").to_pylist(), docs.column("th").to_pylist(), strict=True), docs.column("text").to_pylist(), strict=True))


def fetch(threshold: int, slots: int):
    """The bytes that requests ask for, to where they are compared; spans go along."""

    def run(key, docs: pa.Table, t: pa.Table) -> pa.Table:
        got, out = kinds_of(t), []
        out += [(key[0].as_py() % slots, SPANS, d) for d in got.get(SPANS, [])]
        if REQUESTS in got:
            texts = texts_of(docs)
            k, th, a, n, hot, to = joined(got[REQUESTS], ("i8", "i8", "i8", "i8", "u1", "i8"))
            order = np.argsort(to, kind="stable")
            k, th, a, n, hot, to = (x[order] for x in (k, th, a, n, hot, to))
            first, _ = groups(to)
            at = np.flatnonzero(first).tolist()
            for s, e in zip(at, [*at[1:], len(to)], strict=True):
                cut = [texts[x, y][z : z + m + threshold] for x, y, z, m in zip(k[s:e].tolist(), th[s:e].tolist(), a[s:e].tolist(), n[s:e].tolist(), strict=True)]
                out.append((int(to[s]), CONTEXTS, pack(k[s:e], th[s:e], a[s:e], n[s:e], hot[s:e], np.frombuffer(b"".join(cut), np.uint8))))
        return as_table(out)

    return run


def last_digits(threshold: int, slots: int, parts: int):
    """Windows of fetched runs: spans of those that occur earlier; the first windows of hot anchors go on to be compared with others'."""

    def run(t: pa.Table) -> pa.Table:
        got, out = kinds_of(t), []
        k, th, a, n, hot, data = joined(got.get(CONTEXTS, []), ("i8", "i8", "i8", "i8", "u1", "u1"))
        if len(k):
            size = n + threshold
            off = np.cumsum(size) - size
            rec, at = np.repeat(np.arange(len(k)), n + 1), ranges(off, n + 1)
            k, th, i, hot = k[rec], th[rec], a[rec] + at - off[rec], hot[rec] > 0
            live, group = radix_groups(data, at, threshold)
            order = np.lexsort((i[live], th[live], k[live], group))
            live, group = live[order], group[order]
            first, begin = groups(group)
            late = live[(k[live] != k[live][begin]) | (th[live] != th[live][begin]) | (i[live] != i[live][begin])]
            spans_by_part(k[late], th[late], i[late], i[late] + threshold, parts, out)
            hot[live[~first]] = False
            x, y = (mix(Spans(data, s).of(at[hot], at[hot] + threshold)) for s in (3, 4)) if hot.any() else (np.empty(0, np.uint64),) * 2
            by_slot((x >> np.uint64(33)).astype(np.int64) % slots, WINDOWS, [x, y, k[hot], th[hot], i[hot]], out)
        out = [(s % slots, kind, d) if kind == SPANS else (s, kind, d) for s, kind, d in out]
        out += [(t.column("slot")[0].as_py(), SPANS, d) for d in got.get(SPANS, [])]
        return as_table(out)

    return run


def hot_windows(threshold: int, parts: int):
    def run(t: pa.Table) -> pa.Table:
        got, out = kinds_of(t), []
        x, y, k, th, i = joined(got.get(WINDOWS, []), ("u8", "u8", "i8", "i8", "i8"))
        if len(x):
            order, _, later = repeats([x, y], [k, th, i])
            k, th, i = (v[order][later] for v in (k, th, i))
            spans_by_part(k, th, i, i + threshold, parts, out)
        passed(got, out, parts)
        return as_table(out)

    return run


def cut_out(fields: list[str], schema: pa.Schema, characters: bool):
    """The documents without their spans."""

    def run(key, docs: pa.Table, t: pa.Table) -> pa.Table:
        got = kinds_of(t)
        spans: dict[tuple[int, int], list] = {}
        k, th, s, n = joined([unpack(d) for d in got.get(SPANS, [])], ("i8",) * 4)
        if len(k):
            order = np.lexsort((th, k))
            k, th, s, e = k[order], th[order], s[order], (s + n)[order]
            _, begin = groups(k, th)
            for g, x, y in zip(*(v.tolist() for v in merged(begin, s, e)), strict=True):
                spans.setdefault((int(k[g]), int(th[g])), []).append((x, y))
        found, kept = [], []
        for (x, y), text in zip(zip(docs.column("k").to_pylist(), docs.column("th").to_pylist(), strict=True), docs.column("text").to_pylist(), strict=True):
            own = spans.get((x, y), [])
            if characters and own:  # only characters whose bytes all go: the rest stays valid UTF-8
                part = lambda p: p < len(text) and text[p] & 0xC0 == 0x80  # noqa: E731, B023
                own = [(next(p for p in range(s, len(text) + 1) if not part(p)), next(p for p in range(e, -1, -1) if not part(p))) for s, e in own]
                own = [(s, e) for s, e in own if s < e]
            at, pieces = 0, []
            for s, e in own:
                pieces.append(text[at:s])
                at = e
            found.append([{"start": s, "end": e} for s, e in own])
            kept.append(b"".join([*pieces, text[at:]]) if own else text)
        columns = {f: docs.column(f) for f in fields}
        columns["removed_spans"], columns["kept"] = pa.array(found, schema.field("removed_spans").type), pa.array(kept, pa.binary())
        return pa.table([columns[f.name].cast(f.type) if f.name in fields else columns[f.name] for f in schema], schema=schema)

    return run


def identity(docs: DataFrame, key: Column, text: Column, bits: int) -> Column:
    """A hash of key and text by which no two different texts of one key agree: another seed is taken if two do.

    Agreement is told by a second hash of 64 bits and the length. A row of five numbers for each document is shuffled for it.
    """
    for seed in range(64):
        th = F.xxhash64(F.lit(seed), key, text).bitwiseAND(F.lit((1 << bits) - 1))
        seen = docs.select(key.alias("k"), th.alias("th"), F.xxhash64(F.lit(-1 - seed), text).alias("x"), F.octet_length(text).alias("n")).groupBy("k", "th")
        if not seen.agg(F.min("x").alias("a"), F.max("x").alias("b"), F.min("n").alias("c"), F.max("n").alias("d")).filter("a <> b or c <> d").head(1):
            return th
    raise ValueError(f"{bits} bits do not tell the texts of one key apart")


def without_repeats(docs: DataFrame, key: str, text: str, threshold: int = 100, characters: bool = False, bits: int = 62) -> DataFrame:
    """docs with removed_spans (array of start, end in bytes) and kept (the other bytes). characters: cut no character apart. bits: of the
    hash by which rows of one key are told apart."""
    if threshold < GRAM:
        raise ValueError(f"threshold must be at least {GRAM}")
    bounded_batches(docs.sparkSession)
    volume = docs.agg(F.sum(F.octet_length(F.col(text).cast("binary")))).first()[0] or 0
    slots = parts = max(SLOTS, -(-volume // VOLUME))
    k = F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY))
    th = identity(docs, k, F.coalesce(F.col(text).cast("binary"), F.lit(b"")), bits)
    carried = [c for c in docs.columns if c not in (text, "removed_spans", "kept")]
    fields = [f"c{i}" for i in range(len(carried))]
    keyed = docs.select(
        (th % parts).cast("int").alias("slot"), k.alias("k"), th.alias("th"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
        *[F.col(c).alias(f) for c, f in zip(carried, fields, strict=True)],
    )
    sent = keyed.select("k", "th", "text").mapInArrow(send(threshold, slots, parts), DDL)
    ordered = sent.groupBy("slot").applyInArrow(first_digits(threshold, slots, parts), DDL)
    fetched = keyed.groupBy("slot").cogroup(ordered.groupBy("slot")).applyInArrow(fetch(threshold, slots), DDL)
    compared = fetched.groupBy("slot").applyInArrow(last_digits(threshold, slots, parts), DDL)
    found = compared.groupBy("slot").applyInArrow(hot_windows(threshold, parts), DDL)
    from pyspark.sql.pandas.types import to_arrow_schema

    empty = keyed.select(*fields, F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("removed_spans"), F.lit(None).cast("binary").alias("kept"))
    out = keyed.groupBy("slot").cogroup(found.groupBy("slot")).applyInArrow(cut_out(fields, to_arrow_schema(empty.schema), characters), empty.schema)
    return out.select(*[F.col(f).alias(c) for c, f in zip(carried, fields, strict=True)], "removed_spans", "kept")


def op7_suffix_dedup(spark, sf_dir):
    out = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    gone = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", (F.octet_length("kept") + gone).cast("long").alias("n_bytes"), gone.alias("n_removed"), F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
