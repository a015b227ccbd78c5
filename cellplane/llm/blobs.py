"""Columns of many small records, packed into one binary value for a shuffle: the records of one sender for one receiver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Rows on the way: slot (who receives it), kind (what it holds), data (packed arrays).
SCHEMA = pa.schema([("slot", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
DDL = "slot int, kind int, data binary"
_KINDS = [np.dtype(x) for x in ("u1", "u2", "u4", "u8", "i8", "f4", "f8")]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays to bytes; whole numbers of 0 or more take as few bytes as the largest needs."""
    out = [bytes([len(arrays)])]
    for a in arrays:
        if a.dtype.kind in "iu" and a.dtype != np.uint8:
            if len(a) and a.min() >= 0:
                top = int(a.max())
                a = a.astype("u1" if top < 1 << 8 else "u2" if top < 1 << 16 else "u4" if top < 1 << 32 else "u8")
            elif a.dtype.kind == "i":
                a = a.astype("i8")
        out += [bytes([_KINDS.index(a.dtype)]), len(a).to_bytes(8, "little"), a.tobytes()]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    at, out = 1, []
    for _ in range(data[0]):
        kind, n = _KINDS[data[at]], int.from_bytes(data[at + 1 : at + 9], "little")
        out.append(np.frombuffer(data, dtype=kind, count=n, offset=at + 9))
        at += 9 + n * kind.itemsize
    return out


def joined(parts: list[list[np.ndarray]], kinds: tuple[str, ...]) -> list[np.ndarray]:
    """Unpacked values, one below another, as arrays of the given types."""
    return [np.concatenate([p[i].astype(k, copy=False) for p in parts]) if parts else np.empty(0, k) for i, k in enumerate(kinds)]


def by_slot(slot: np.ndarray, kind: int, arrays: list[np.ndarray], out: list[tuple[int, int, bytes]]) -> None:
    """Appends a row for each slot with the records that go there."""
    if not len(slot):
        return
    order = np.argsort(slot, kind="stable")
    slot = slot[order]
    at = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
    ends = np.concatenate([at[1:], [len(slot)]])
    arrays = [a[order] for a in arrays]
    for s, e in zip(at.tolist(), ends.tolist(), strict=True):
        out.append((int(slot[s]), kind, pack(*[a[s:e] for a in arrays])))


def batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    slots, kinds, data = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(kinds, pa.int32()), pa.array(data, pa.binary())], schema=SCHEMA)


def as_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.Table.from_batches([batch(rows)], schema=SCHEMA)
