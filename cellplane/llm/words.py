"""Words of many texts at once, as 64-bit hashes. A word is a run of bytes outside space and U+0009 to U+000D."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .bytesops import Spans, mix

_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Bytes of texts, and texts, that are worked on at once.
BLOCK, TEXTS = 1 << 19, 1024


def blocks(rows: Iterator[tuple], size: int = BLOCK) -> Iterator[list[tuple]]:
    """Rows (text first) in lists of about size bytes and TEXTS rows at most; a longer text is alone."""
    held, total = [], 0
    for row in rows:
        if held and (total + len(row[0]) > size or len(held) == TEXTS):
            yield held
            held, total = [], 0
        held.append(row)
        total += len(row[0])
    if held:
        yield held


def _words(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    gap = _GAP[data]
    edge = np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return mix(Spans(_LOWER[data] if lower else data, 11).of(start, end) + (end - start).astype(np.uint64)), start, end


def word_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, in order. One text of any length goes through in pieces."""
    if len(texts) == 1 and len(texts[0]) > 4 * BLOCK:
        text, at, found = texts[0], 0, []
        while at < len(text):
            end = min(len(text), at + 4 * BLOCK)
            while end < len(text) and not _GAP[text[end]]:
                end += 1
            found.append(_words(np.frombuffer(text, np.uint8, end - at, at), lower)[0])
            at = end
        words = np.concatenate(found)
        return words, np.zeros(len(words), dtype=np.int64)
    words, start, _ = _words(np.frombuffer(b" ".join(texts) + b" ", np.uint8), lower)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    return words, np.searchsorted(begins, start, side="right") - 1


def shingles(words: np.ndarray, doc: np.ndarray, k: int, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of k words of a text; a text of fewer words has its whole sequence as one."""
    many = np.bincount(doc, minlength=n_docs)
    if len(words) >= k:
        inside = doc[: len(doc) - k + 1] == doc[k - 1 :]
        out = words[: len(words) - k + 1].copy()
        for i in range(1, k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - k + 1 + i]
        out, of = mix(out[inside] + np.uint64(k)), doc[: len(doc) - k + 1][inside]
    else:
        out, of = np.empty(0, np.uint64), np.empty(0, np.int64)
    begin = np.cumsum(many) - many
    short = np.flatnonzero((many > 0) & (many < k))
    if len(short):
        more = np.zeros(len(short), dtype=np.uint64)
        for i in range(k - 1):
            on = many[short] > i
            more[on] = more[on] * np.uint64(0x9E3779B97F4A7C15) + words[begin[short[on]] + i]
        out, of = np.concatenate([out, mix(more + many[short].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))]), np.concatenate([of, short])
    return out, of


def distinct(values: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, sorted by text and value."""
    order = np.argsort(values)
    order = order[np.argsort(doc[order].astype(np.uint16 if len(doc) and doc.max() < 1 << 16 else np.int64), kind="stable")]
    values, doc = values[order], doc[order]
    if len(values):
        keep = np.concatenate([[True], (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])])
        values, doc = values[keep], doc[keep]
    return values, doc
