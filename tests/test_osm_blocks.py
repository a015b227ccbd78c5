"""Files of blocks, written here byte by byte: every split reads the same elements, and features have their places and rings."""

import struct
import zlib

import numpy as np
import pytest

from cellplane.sources import osm_blocks as o


def num(v):
    out = b""
    v &= (1 << 64) - 1
    while v > 0x7F:
        out, v = out + bytes([v & 0x7F | 0x80]), v >> 7
    return out + bytes([v])


def field(n, v):
    return num(n << 3) + num(v) if isinstance(v, int) else num(n << 3 | 2) + num(len(v)) + v


def fold(v):
    return v * 2 if v >= 0 else -v * 2 - 1


def many(values, signed=False, delta=False):
    if delta:
        values = [v - w for v, w in zip(values, [0, *values[:-1]], strict=True)]
    return b"".join(num(fold(v) if signed else v) for v in values)


def frame(kind, message, packed=True):
    blob = field(2, len(message)) + field(3, zlib.compress(message)) if packed else field(1, message)
    header = field(1, kind) + field(3, len(blob))
    return struct.pack(">I", len(header)) + header + blob


class Words(list):
    def of(self, w):
        if w not in self:
            self.append(w)
        return self.index(w)


def block(nodes=(), ways=(), relations=(), dense=True, packed=True):
    """nodes (id, lon, lat, tags), ways (id, refs, tags), relations (id, members, tags), places in hundreds of billionths of a degree."""
    words, group = Words([""]), b""
    tags = lambda t: field(2, many([words.of(k) for k in t])) + field(3, many([words.of(v) for v in t.values()]))
    if nodes and dense:
        flat = [x for n in nodes for x in [*[words.of(w) for kv in n[3].items() for w in kv], 0]]
        group += field(2, field(1, many([n[0] for n in nodes], True, True)) + field(8, many([n[2] for n in nodes], True, True)) + field(9, many([n[1] for n in nodes], True, True)) + field(10, many(flat)))
    for i, lon, lat, t in () if dense else nodes:
        group += field(1, field(1, fold(i)) + tags(t) + field(8, fold(lat)) + field(9, fold(lon)))
    for i, refs, t in ways:
        group += field(3, field(1, i) + tags(t) + field(8, many(refs, True, True)))
    for i, members, t in relations:
        kinds, refs, roles = zip(*members, strict=True)
        group += field(4, field(1, i) + tags(t) + field(8, many([words.of(r) for r in roles])) + field(9, many(list(refs), True, True)) + field(10, many([o.KINDS.index(k) for k in kinds])))
    return frame(b"OSMData", field(1, b"".join(field(1, w.encode()) for w in words)) + field(2, group), packed)


@pytest.fixture(scope="module")
def file(tmp_path_factory):
    rng = np.random.default_rng(5)
    square = lambda i, x, y, d: [(i + k, x + dx * d, y + dy * d, {}) for k, (dx, dy) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1)))]
    data = frame(b"OSMHeader", field(4, b"OsmSchema-V0.6"))
    data += block(square(1, -500, 100, 10) + square(11, 0, 0, 1000) + square(21, 200, 200, 100))
    data += block([(31, 7, -8, {"man_made": "wind_turbine", "name": "Mühle"}), (32, 1, 2, {"amenity": "bench"})], dense=False, packed=False)
    data += b"".join(block([(1000 * b + k, int(x), int(y), {"note": "\n\x07OSMData" * (k % 3)} if k % 5 == 0 else {}) for k, (x, y) in enumerate(rng.integers(-1800000000, 1800000000, (200, 2)))], packed=b % 2 == 0) for b in range(1, 12))
    data += block(ways=[(1, [1, 2, 3, 4, 1], {"building": "yes"}), (2, [1, 2, 3], {"highway": "track", "surface": "x"}), (3, [11, 12, 13], {}), (4, [11, 14, 13], {}), (5, [21, 22, 23, 24, 21], {"natural": "wood"}), (6, [1, 2, 99], {"highway": "path"}), (7, [99], {"highway": "path"}), (8, [1, 2, 3, 1], {"building": "yes", "area": "yes"})])
    data += block(relations=[(1, [("way", 3, "outer"), ("way", 5, "inner"), ("way", 4, "outer"), ("node", 32, "label")], {"type": "multipolygon", "natural": "water"}), (2, [("way", 3, "outer")], {"type": "multipolygon", "natural": "water"}), (3, [("way", 3, "")], {"type": "route", "natural": "water"})])
    path = tmp_path_factory.mktemp("osm") / "country.osm.pbf"
    path.write_bytes(data)
    return str(path)


def test_every_split_reads_all(spark, file):
    rows = {s: sorted(map(str, o.read_osm(spark, file, s).collect())) for s in (50, 777, 5000, 1 << 26)}
    assert len(rows[50]) == 12 + 2 + 2200 + 8 + 3 and len(set(map(tuple, rows.values()))) == 1
    one = o.read_osm(spark, file).filter("kind = 'node' and id = 31").first()
    assert (round(one.lon, 9), round(one.lat, 9), one.tags) == (7e-7, -8e-7, {"man_made": "wind_turbine", "name": "Mühle"})


def test_features(spark, file):
    out = lambda name: sorted((r.kind, r.id, r.shape.kind, [len(x) for x in r.shape.rings], r.attrs) for r in o.layer(spark, file, name).collect())
    assert out("buildings") == [("way", 1, "line", [5], {"building": "yes"}), ("way", 1, "polygon", [4], {"building": "yes"}), ("way", 8, "polygon", [3], {"building": "yes"})]
    assert out("roads") == [("way", 2, "line", [3], {"highway": "track"}), ("way", 6, "line", [2], {"highway": "path"})]
    assert out("windpower") == [("node", 31, "point", [1], {"man_made": "wind_turbine", "name": "Mühle"})]
    # The ring of two ways with its hole; the hole's way has a tag to keep. A relation whose ways close no ring, and a route, do not come.
    assert out("water") == [("relation", 1, "polygon", [4, 4], {"natural": "water"}), ("way", 5, "line", [5], {"natural": "wood"}), ("way", 5, "polygon", [4], {"natural": "wood"})]
    assert out("military") == []
    at = [(round(p.x, 9), round(p.y, 9)) for p in o.layer(spark, file, "roads").filter("id = 2").first().shape.rings[0]]
    assert at == [(-5e-5, 1e-5), (-4.9e-5, 1e-5), (-4.9e-5, 1.1e-5)]


def test_missing_and_odd(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert o.read_osm(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="gone"):
        o.read_osm(spark, str(tmp_path / "gone.pbf")).count()
    assert o.packed(many([3, -4, 10, 2**40, -(2**40)], True), True).tolist() == [3, -4, 10, 2**40, -(2**40)]
    with pytest.raises(ValueError, match="not read"):
        o.unpacked(field(4, b"x"))
