"""Hashed byte trigrams and style marks of many texts at once."""

from __future__ import annotations

import numpy as np

from .bytesops import Spans, mix
from .words import _GAP

_FOLD = np.arange(256, dtype=np.uint8)  # letters of ASCII fold, bytes of other letters stay, the rest is a gap
_FOLD[0x41:0x5B] += 0x20
_FOLD[[c for c in range(0x80) if not chr(c).isalpha()]] = 0x20
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>@^~=+{}[]\\_")] = True
_UPPER, _DIGIT, _MARK = (np.zeros(256, dtype=bool) for _ in range(3))
_UPPER[0x41:0x5B] = _DIGIT[0x30:0x3A] = True
_MARK[list(b"!?.,;:")] = True
STYLES, STEPS = 6, 8


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with two blanks between, and the text number of each byte."""
    sizes = np.array([len(t) + 2 for t in texts])
    return np.frombuffer(b"  ".join(texts) + b"  ", np.uint8), np.repeat(np.arange(len(texts)), sizes)


def trigrams(texts: list[bytes], bits: int, fold: bool) -> np.ndarray:
    """Counts of hashed trigrams whose middle is no gap: a row for each text."""
    data, doc = laid_out(texts)
    x = (_FOLD[data] if fold else data).astype(np.uint32)
    h = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - bits)
    keep = (x[1:-1] != 0x20) if fold else ~_GAP[data[1:-1]]
    at = (doc[1:-1][keep] << bits) + h[keep]
    return np.bincount(at, minlength=len(texts) << bits).reshape(len(texts), 1 << bits)


def styles(texts: list[bytes]) -> np.ndarray:
    """One of STEPS marks for each of STYLES shares: symbols, capitals, digits, punctuation, words equal to an earlier one, length."""
    data, doc = laid_out(texts)
    n = len(texts)
    per = lambda mask: np.bincount(doc[mask], minlength=n).astype(np.float64)
    size = np.maximum(per(~_GAP[data]), 1)
    edge = np.diff(np.concatenate([[True], _GAP[data]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    word = mix(Spans(data, 13).of(start, end))
    of = doc[start]
    order = np.lexsort((word, of))
    twice = np.flatnonzero((word[order][1:] == word[order][:-1]) & (of[order][1:] == of[order][:-1]))
    words = np.maximum(np.bincount(of, minlength=n), 1)
    shares = [per(_SYMBOLS[data]) / size, per(_UPPER[data]) / size, per(_DIGIT[data]) / size, per(_MARK[data]) / size]
    shares += [np.maximum(np.bincount(of[order][twice + 1], minlength=n) / words - 0.5, 0), np.minimum(np.log2(words + 1) / 32, 1)]
    out = np.zeros((n, STYLES, STEPS))
    for i, s in enumerate(shares):
        out[np.arange(n), i, np.minimum((np.sqrt(s) * STEPS).astype(np.int64), STEPS - 1)] = 1
    return out.reshape(n, -1)
