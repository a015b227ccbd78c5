"""Operator 13: fill-in-middle transformation by a parallel automaton scan.

Units (lines by default) and the sentinels' absence are both told by finite automata over the bytes of the text. A text is cut into chunks of
equal size wherever they fall. Each chunk is read once from all states at the same time and gives a function, entry state to last state, and for
each entry state the number of units that begin in it. Functions compose associatively, so a few rounds of doubling give every chunk its entry state and
the units before it; a unit's place is then found in the one chunk that holds it.

Texts of at most `piece` bytes are scanned where they lie, whole batches at once, without a shuffle. Longer ones are cut into pieces that any
executor may take: pieces send back one small row each (function, counts, code points), a document's rows are composed in order, and only
the pieces that hold a cut are read again. A value has at most 2 GB, so a document has at most 2 GB / `piece` such rows.

Where a cut falls is decided by the first four groups of eight hex digits, h1 to h4, of the SHA-256 of `<seed>:<key>`: after h1 % (n + 1) and h2 % (n + 1) units;
the text stays plain if h3 % 100 >= rate, and is written suffix first if h4 % 100 < spm_rate.

Defined results: null texts count as empty; empty texts, and texts that hold a sentinel, stay plain with null sizes. A null key counts as an empty
string. Rows of one key are cut by the same hash, each on its own text; repeated rows give repeated results. Columns of any names pass through; one that is
named like a result is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, table
from .words import blocks

#: Bytes of a chunk, of texts scanned at once, and of a piece of a long document.
CHUNK, BLOCK, PIECE = 512, 1 << 21, 1 << 16
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULT = ("n", "form", "prefix_chars", "middle_chars", "output")
_START = np.zeros(256, dtype=np.int64)
_START[:0x80] = _START[0xC0:] = 1  # bytes that begin a code point


class Machine:
    """Automata side by side as one table: state after (byte, state), whether a unit begins there, and the first state of each."""

    def __init__(self, *parts: tuple[np.ndarray, np.ndarray]):
        self.first = np.cumsum([0] + [p.shape[1] for p, _ in parts])[:-1]
        self.size = sum(p.shape[1] for p, _ in parts)
        self.step = np.concatenate([p + at for (p, _), at in zip(parts, self.first, strict=True)], axis=1).astype(np.uint16)
        self.begin = np.concatenate([b for _, b in parts], axis=1).astype(np.int32)


def line_units() -> tuple[np.ndarray, np.ndarray]:
    """Lines with their newline: state 0 stands before a line, state 1 inside one."""
    step = np.ones((256, 2), dtype=np.int64)
    step[0x0A] = 0
    begin = np.zeros((256, 2), dtype=np.int64)
    begin[:, 0] = 1
    return step, begin


def word_units() -> tuple[np.ndarray, np.ndarray]:
    """Words with the white space behind them (the text's leading space counts as a unit): states are before all, in a word, in space."""
    gap = np.zeros(256, dtype=bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    step = np.repeat(np.where(gap, 2, 1)[:, None], 3, axis=1)
    begin = np.zeros((256, 3), dtype=np.int64)
    begin[:, 0], begin[~gap, 2] = 1, 1
    return step, begin


def finds(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Whether one of the words has occurred: the states are their proper beginnings, the last one means found and is never left."""
    states = sorted({w[:i] for w in words for i in range(len(w))}, key=lambda s: (len(s), s))
    found, step = len(states), np.zeros((256, len(states) + 1), dtype=np.int64)
    for at, s in enumerate(states):
        for b in range(256):
            read = s + bytes([b])
            hit = any(read.endswith(w) for w in words)
            step[b, at] = found if hit else next(states.index(read[i:]) for i in range(len(read) + 1) if read[i:] in states)
    step[:, found] = found
    return step, np.zeros_like(step)


def _columns(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Byte after byte of many stretches at once: how many are still read (longest first), and their bytes."""
    longest = int((end - start).max(initial=0))
    live = len(start)
    for i in range(longest):
        while live and start[live - 1] + i >= end[live - 1]:
            live -= 1
        yield live, data[start[:live] + i]


def functions(m: Machine, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Last state and units begun, by stretch and entry state."""
    order = np.argsort(start - end, kind="stable")
    state = np.repeat(np.arange(m.size, dtype=np.uint16)[None], len(start), axis=0)
    count = np.zeros(state.shape, dtype=np.int32)
    step, begin = m.step.ravel(), m.begin.ravel()
    for live, byte in _columns(data, start[order], end[order]):
        at = byte.astype(np.int32)[:, None] * m.size + state[:live]
        count[:live] += begin[at]
        state[:live] = step[at]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return state[back].astype(np.int64), count[back].astype(np.int64)


def composed(state: np.ndarray, count: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running composition over the stretches of each document (of is sorted), by doubling: from the document's start through each stretch."""
    state, count, d = state.copy(), count.copy(), 1
    while True:
        on = np.flatnonzero(of[d:] == of[:-d]) + d if d < len(of) else np.empty(0, np.int64)
        if not len(on):
            return state, count
        before, units = state[on - d], count[on - d]
        late = np.take_along_axis(count[on], before, axis=1) + units
        state[on], count[on] = np.take_along_axis(state[on], before, axis=1), late
        d *= 2


def select(m: Machine, data: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Where unit nth (from 0) of each stretch begins, read from the entry state; the stretch's end where it has no such unit."""
    order = np.argsort(start - end, kind="stable")
    state, left, place = state[order].astype(np.int64), nth[order].copy(), end[order].copy()
    begun, step, begin = start[order], m.step.ravel(), m.begin.ravel()
    for i, (live, byte) in enumerate(_columns(data, start[order], end[order])):
        at = byte.astype(np.int64) * m.size + state[:live]
        b = begin[at]
        hit = np.flatnonzero((b == 1) & (left[:live] == 0))
        place[hit] = begun[hit] + i
        left[:live] -= b
        state[:live] = step[at]
    out = np.empty_like(place)
    out[order] = place
    return out


def scan(m: Machine, texts: list[bytes], cuts: np.ndarray, rate: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, whether it holds a sentinel, and code points before each of its two cuts (cuts: h1, h2 by text)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.cumsum(size) - size
    many = np.maximum(-(-size // CHUNK), 1)
    of = np.repeat(np.arange(len(texts)), many)
    last = np.cumsum(many) - 1
    start = begin[of] + (np.arange(len(of)) - (last - many + 1)[of]) * CHUNK
    end = np.minimum(start + CHUNK, (begin + size)[of])
    state, count = composed(*functions(m, data, start, end), of)
    n, found = count[last, m.first[0]], state[last, m.first[1]] == m.size - 1
    # The chunk of a cut is the first whose running count exceeds it; documents are told apart by lifting their counts.
    running = count[:, m.first[0]]
    lift = np.cumsum(n + 1) - (n + 1)
    unit = cuts % (n + 1)[:, None]
    at = np.minimum(np.searchsorted(running + lift[of], (unit + lift[:, None]).ravel(), side="right"), np.repeat(last, 2))
    inner = at > np.repeat(last - many + 1, 2)
    entry = np.where(inner, state[at - 1, m.first[0]], m.first[0])
    place = select(m, data, start[at], end[at], entry, unit.ravel() - np.where(inner, running[at - 1], 0))
    chars = np.concatenate([[0], np.cumsum(_START[data])])
    return n, found, np.sort((chars[place] - np.repeat(chars[begin], 2)).reshape(-1, 2), axis=1)


def _machine(units: Callable, sentinels: tuple[str, str, str]) -> Machine:
    return Machine(units(), finds([s.encode() for s in sentinels]))


SCAN = pa.struct([("n", pa.int64()), ("found", pa.bool_()), ("first", pa.int64()), ("second", pa.int64())])
PIECES = "__row long, no int, data binary"
SUMMARY = "__row long, no int, chars long, state array<int>, units array<long>"


def _short(text: Column, h1: Column, h2: Column, units: Callable, sentinels: tuple[str, str, str], block: int) -> Column:
    @F.arrow_udf("n long, found boolean, first long, second long")
    def of(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        m = _machine(units, sentinels)
        for t, a, b in batches:
            parts = []
            for rows in blocks(zip(t.cast(pa.binary()).to_pylist(), a.to_pylist(), b.to_pylist(), strict=True), block):
                n, found, at = scan(m, [r[0] for r in rows], np.array([r[1:] for r in rows], dtype=np.int64), 100)
                parts.append(pa.StructArray.from_arrays([pa.array(n), pa.array(found), pa.array(at[:, 0]), pa.array(at[:, 1])], fields=list(SCAN)))
            yield pa.concat_arrays(parts) if parts else pa.array([], SCAN)

    return of(text, h1, h2)


def _long(docs: DataFrame, units: Callable, sentinels: tuple[str, str, str], piece: int) -> DataFrame:
    """docs (long texts, as __t) with __scan. The pieces of all documents are scanned wherever they land."""
    docs = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "long-texts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                data = memoryview(text.as_buffer())
                for no, at in enumerate(range(0, len(data), piece)):
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([no], pa.int32()), pa.array([data[at : at + piece].tobytes()], pa.binary())], ["__row", "no", "data"])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _machine(units, sentinels)
        for batch in batches:
            out: list[list] = [[], [], []]
            for data in batch.column("data"):
                data = np.frombuffer(data.as_buffer(), np.uint8)
                start = np.arange(0, len(data), CHUNK)
                state, count = composed(*functions(m, data, start, np.minimum(start + CHUNK, len(data))), np.zeros(len(start), dtype=np.int64))
                out[0].append(int(_START[data].sum())), out[1].append(state[-1].tolist()), out[2].append(count[-1].tolist())
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("__row"), batch.column("no"), *[pa.array(v, k) for v, k in zip(out, kinds, strict=True)]], ["__row", "no", "chars", "state", "units"])

    pieces = docs.select("__row", "__t").mapInArrow(cut, PIECES)
    summary = materialise(pieces.repartition("__row", "no").mapInArrow(summarise, SUMMARY), "pieces")
    of = summary.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("no", "chars", "state", "units"))).alias("__pieces"))

    @F.arrow_udf("n long, found boolean, first long, second long")
    def finish(text: pa.Array, h1: pa.Array, h2: pa.Array, pieces: pa.Array) -> pa.Array:
        m, out = _machine(units, sentinels), []
        for t, a, b, rows in zip(text.cast(pa.binary()), h1.to_pylist(), h2.to_pylist(), pieces.to_pylist(), strict=True):
            state, count = composed(np.array([r["state"] for r in rows], dtype=np.int64), np.array([r["units"] for r in rows], dtype=np.int64), np.zeros(len(rows), dtype=np.int64))
            running, data = count[:, m.first[0]], np.frombuffer(t.as_buffer(), np.uint8)
            before = np.concatenate([[0], np.cumsum([r["chars"] for r in rows])])
            n, places = int(running[-1]), []
            for unit in (a % (n + 1), b % (n + 1)):
                at = min(int(np.searchsorted(running, unit, side="right")), len(rows) - 1)
                start, end = at * piece, min((at + 1) * piece, len(data))
                entry = state[at - 1, m.first[0]] if at else m.first[0]
                one = lambda x: np.array([x], dtype=np.int64)
                place = int(select(m, data, one(start), one(end), one(entry), one(unit - (running[at - 1] if at else 0)))[0])
                places.append(int(before[at] + _START[data[start:place]].sum()))
            out.append((n, bool(state[-1, m.first[1]] == m.size - 1), min(places), max(places)))
        return pa.array([dict(zip(("n", "found", "first", "second"), r, strict=True)) for r in out], SCAN)

    out = docs.join(of, "__row")  # every long text has a piece
    return out.withColumn("__scan", finish("__t", "__h.h1", "__h.h2", "__pieces")).drop("__row", "__pieces")


def fill_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100, spm_rate: int = 50, units: Callable = line_units,
    sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE), piece: int = PIECE, block: int = BLOCK,
) -> DataFrame:
    """docs with n (units), form (plain, psm or spm), prefix_chars, middle_chars and output, the rearranged text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    group = lambda i: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
    kept = [c for c in docs.columns if c not in RESULT]
    docs = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__t"),
        F.struct(*[group(i).alias(f"h{i + 1}") for i in range(4)]).alias("__h"),
    )
    is_long = F.octet_length("__t") > piece
    short = docs.filter(~is_long).withColumn("__scan", _short(F.col("__t"), F.col("__h.h1"), F.col("__h.h2"), units, sentinels, block))
    out = short.unionByName(_long(docs.filter(is_long), units, sentinels, piece))
    s, t, (p_, s_, m_) = F.col("__scan"), F.col("__t"), sentinels
    plain = (t == "") | s.found | (F.col("__h.h3") % 100 >= rate)
    a, b = s["first"], s["second"]
    prefix, middle, suffix = F.substring(t, F.lit(1), a.cast("int")), F.substring(t, (a + 1).cast("int"), (b - a).cast("int")), F.substring(t, (b + 1).cast("int"), F.length(t))
    form = F.when(plain, "plain").when(F.col("__h.h4") % 100 < spm_rate, "spm").otherwise("psm")
    out = out.select("row", "__t", s.n.alias("n"), form.alias("form"), F.when(~plain, a).alias("prefix_chars"), F.when(~plain, b - a).alias("middle_chars"), prefix.alias("p"), middle.alias("m"), suffix.alias("s"))
    text_of = F.when(F.col("form") == "plain", t).when(F.col("form") == "psm", F.concat(F.lit(p_), "p", F.lit(s_), "s", F.lit(m_), "m")).otherwise(F.concat(F.lit(s_), "s", F.lit(p_), "p", F.lit(m_), "m"))
    return out.select("row.*", "n", "form", "prefix_chars", "middle_chars", text_of.alias("output"))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text from a rearranged one. Sentinels stand once each, as texts that hold one stay plain."""
    p_, s_, m_ = sentinels
    parts = F.split(output, "|".join(rf"\Q{s}\E" for s in sentinels), -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op13_fill_middle(spark, sf_dir):
    """Every document rearranged by lines, and the text rebuilt from it; both as digests."""
    out = fill_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
