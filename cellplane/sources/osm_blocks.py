"""Map data in blocks (.osm.pbf): a data source whose partitions are byte ranges of the files, and features of the elements by tag filters.

A file is a row of framed, compressed blocks. A task takes the blocks that begin in its range; it finds the first by the mark of a data block, and takes it for one
only if the block behind it begins with the mark too or the file ends there. So nobody walks a whole file, and nothing but one block is held at a time.
Elements refer to each other by id: a way's places come by a join with the nodes, a relation's outlines by a join with the ways.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ELEMENTS = "kind string, id long, lon double, lat double, tags map<string,string>, refs array<long>, members array<struct<kind:string,ref:long,role:string>>"
#: Tag filters of the object groups (kinds of element / tag, with a value or any), and the tags that features keep.
FILTERS = {
    "buildings": ["w/building", "r/building"],
    "roads": ["w/highway"],
    "railways": ["w/railway"],
    "powerlines": ["w/power=line", "w/power=minor_line"],
    "transport": ["n/aeroway", "w/aeroway", "r/aeroway"],
    "aerialways": ["n/aerialway", "w/aerialway", "r/aerialway"],
    "military": ["w/landuse=military", "r/landuse=military", "w/military", "r/military"],
    "nature": ["w/boundary=protected_area", "r/boundary=protected_area", "w/boundary=national_park", "r/boundary=national_park", "w/leisure=nature_reserve", "r/leisure=nature_reserve", "w/protect_class", "r/protect_class", "w/protection_title", "r/protection_title"],
    "windpower": ["nwr/generator:source=wind", "nwr/man_made=wind_turbine"],
    "water": ["w/natural=water", "r/natural=water", "w/waterway=riverbank", "r/waterway=riverbank", "w/landuse=reservoir", "r/landuse=reservoir"],
}
KEPT_TAGS = {
    "buildings": ["building"],
    "roads": ["highway", "tunnel"],
    "railways": ["railway", "tunnel"],
    "powerlines": ["power", "voltage"],
    "transport": ["aeroway"],
    "aerialways": ["aerialway"],
    "military": ["landuse", "military"],
    "nature": ["boundary", "leisure", "protect_class", "protection_title", "name"],
    "windpower": ["power", "generator:source", "man_made", "name"],
    "water": ["natural", "water", "waterway", "landuse", "name"],
}
MARK, SPLIT, WINDOW, KINDS = b"\x0a\x07OSMData", 64 << 20, 1 << 20, ("node", "way", "relation")
_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_RINGS = pa.list_(pa.list_(_POINT))
_ARROW = pa.schema([("kind", pa.string()), ("id", pa.int64()), ("lon", pa.float64()), ("lat", pa.float64()), ("tags", pa.map_(pa.string(), pa.string())), ("refs", pa.list_(pa.int64())), ("members", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.int64()), ("role", pa.string())])))])


def varint(data: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        byte = data[at]
        out |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return out, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields: whole numbers, or the bytes of what has a length."""
    at = 0
    while at < len(data):
        tag, at = varint(data, at)
        if tag & 7 == 0:
            value, at = varint(data, at)
        elif tag & 7 == 2:
            size, at = varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = {1: 8, 5: 4}[tag & 7]
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def packed(data: bytes, signed: bool = False, delta: bool = False) -> np.ndarray:
    """Whole numbers of a packed field; signed: folded signs; delta: each is the difference to the one before."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.int64)
    start = np.concatenate([[0], np.flatnonzero(raw < 0x80)[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(start, np.diff(np.append(start, len(raw))))
    out = np.add.reduceat((raw & 0x7F).astype(np.uint64) << (7 * place).astype(np.uint64), start)
    out = ((out >> np.uint64(1)) ^ (np.uint64(0) - (out & np.uint64(1)))).astype(np.int64) if signed else out.astype(np.int64)
    return np.cumsum(out) if delta else out


def folded(value: int) -> int:
    return (value >> 1) ^ -(value & 1)


def unpacked(blob: bytes) -> bytes:
    """The message in a blob."""
    parts = dict(fields(blob))
    if 1 in parts:
        return parts[1]
    if 3 in parts:
        return zlib.decompress(parts[3])
    raise ValueError(f"block packed by a method that is not read: field {sorted(parts)}")


def _tags(keys: np.ndarray, values: np.ndarray, words: list[str]) -> list[tuple[str, str]]:
    return [(words[k], words[v]) for k, v in zip(keys.tolist(), values.tolist(), strict=True)]


def elements(block: bytes) -> pa.RecordBatch:
    """The elements of one data block."""
    words, groups, grain, lon0, lat0 = [], [], 100, 0, 0
    for number, value in fields(block):
        if number == 1:
            words = [w.decode("utf-8", "replace") for n, w in fields(value) if n == 1]
        elif number == 2:
            groups.append(value)
        elif number == 17:
            grain = value
        elif number == 19:
            lat0 = value - (1 << 64) if value >> 63 else value
        elif number == 20:
            lon0 = value - (1 << 64) if value >> 63 else value
    rows: list[tuple] = []
    for group in groups:
        for number, value in fields(group):
            if number == 2:
                part = dict(fields(value))
                ids = packed(part.get(1, b""), True, True)
                lat, lon = ((o + grain * packed(part.get(n, b""), True, True)) * 1e-9 for n, o in ((8, lat0), (9, lon0)))
                flat, tags, at = packed(part.get(10, b"")).tolist(), [[] for _ in range(len(ids))], 0
                i = 0
                while i < len(flat):  # word pairs of one node after another, a nought behind each node's
                    if flat[i]:
                        tags[at].append((words[flat[i]], words[flat[i + 1]]))
                        i += 2
                    else:
                        at, i = at + 1, i + 1
                rows += [("node", *r, None, None) for r in zip(ids.tolist(), lon.tolist(), lat.tolist(), tags, strict=True)]
            elif number in (1, 3, 4):
                part = dict(fields(value))
                tags = _tags(packed(part.get(2, b"")), packed(part.get(3, b"")), words)
                if number == 1:
                    rows.append(("node", folded(part[1]), (lon0 + grain * folded(part[9])) * 1e-9, (lat0 + grain * folded(part[8])) * 1e-9, tags, None, None))
                elif number == 3:
                    rows.append(("way", part[1], None, None, tags, packed(part.get(8, b""), True, True).tolist(), None))
                else:
                    who = zip(packed(part.get(10, b"")).tolist(), packed(part.get(9, b""), True, True).tolist(), packed(part.get(8, b"")).tolist(), strict=True)
                    rows.append(("relation", part[1], None, None, tags, None, [{"kind": KINDS[k], "ref": r, "role": words[s]} for k, r, s in who]))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)


class Range(InputPartition):
    def __init__(self, path: str, low: int, high: int, size: int):
        self.path, self.low, self.high, self.size = path, low, high, size


class BlockReader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[Range]:
        store, path = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [info] if info.type == fs.FileType.File else [i for i in store.get_file_info(fs.FileSelector(path, recursive=True)) if i.type == fs.FileType.File and i.path.endswith(".pbf")]
        return [Range(i.path, low, min(low + self.split, i.size), i.size) for i in sorted(files, key=lambda i: i.path) for low in range(0, i.size, self.split)] or [Range("", 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.size:
            return
        store, _ = fs.FileSystem.from_uri(self.path)
        with store.open_input_file(partition.path) as f:
            at = self._first(f, partition)
            while at is not None and at < partition.high:
                head = f.read_at(4, at)
                size = struct.unpack(">I", head)[0]
                header = dict(fields(f.read_at(size, at + 4)))
                if header[1] == b"OSMData":
                    yield elements(unpacked(f.read_at(header[3], at + 4 + size)))
                at += 4 + size + header[3]

    def _first(self, f, part: Range) -> int | None:
        """Where the first block begins that begins in the range."""
        if part.low == 0:
            return 0
        at = part.low + 4
        while at < part.high + 4:
            window = f.read_at(min(WINDOW + len(MARK) - 1, part.size - at), at)
            hit = window.find(MARK)
            while hit >= 0:
                if at + hit - 4 < part.high and self._begins(f, at + hit - 4, part.size):
                    return at + hit - 4
                hit = window.find(MARK, hit + 1)
            at += WINDOW
        return None

    @staticmethod
    def _begins(f, at: int, size: int) -> bool:
        """Whether a data block begins here: its header is one, and behind it the next block begins or the file ends."""
        try:
            head = struct.unpack(">I", f.read_at(4, at))[0]
            header = dict(fields(f.read_at(min(head, 1 << 16), at + 4)))
            after = at + 4 + head + header[3]
        except (IndexError, KeyError, TypeError, struct.error):
            return False
        return head < 1 << 16 and header.get(1) == b"OSMData" and (after == size or f.read_at(len(MARK), after + 4) == MARK)


class OsmBlocks(DataSource):
    """spark.read.format("osm_blocks").load(path): elements of a file, or of all .pbf files below a folder. Option split: bytes of a partition."""

    @classmethod
    def name(cls) -> str:
        return "osm_blocks"

    def schema(self) -> str:
        return ELEMENTS

    def reader(self, schema) -> BlockReader:
        return BlockReader(self.options["path"], int(self.options.get("split", SPLIT)))


def read_osm(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """The elements (ELEMENTS) of a file or folder of blocks."""
    spark.dataSource.register(OsmBlocks)
    return spark.read.format("osm_blocks").option("split", str(split)).load(path)


def matches(filters: list[str]) -> Column:
    """Whether an element passes one of the filters: kinds/tag or kinds/tag=value."""
    out = F.lit(False)
    for rule in filters:
        kinds, _, tag = rule.partition("/")
        key, _, value = tag.partition("=")
        got = F.col("tags")[key]
        out = out | (F.col("kind").isin(*[k for k in KINDS if k[0] in kinds]) & (got == value if value else got.isNotNull()))
    return F.coalesce(out, F.lit(False))


def closed_rings(lines: list[list[dict]]) -> list[list[dict]]:
    """Rings of lines that meet end to end, in the order of their first line; lines that close no ring are left out."""
    key = lambda p: (p["x"], p["y"])
    at: dict[tuple, list[int]] = {}
    for i, pts in enumerate(lines):
        for p in (pts[0], pts[-1]):
            at.setdefault(key(p), []).append(i)
    used, out = [False] * len(lines), []
    for first in range(len(lines)):
        if used[first]:
            continue
        used[first], ring = True, list(lines[first])
        while key(ring[0]) != key(ring[-1]):
            spot = at[key(ring[-1])]
            while spot and used[spot[-1]]:
                spot.pop()
            if not spot:
                break
            i = spot.pop()
            used[i] = True
            ring += (lines[i] if key(lines[i][0]) == key(ring[-1]) else lines[i][::-1])[1:]
        if len(ring) > 3 and key(ring[0]) == key(ring[-1]):
            out.append(ring[:-1])
    return out


def features(found: DataFrame, filters: list[str], keep: list[str]) -> DataFrame:
    """(kind, id, attrs, shape) of the elements that pass the filters, or belong to a relation that does, and have one of the tags to keep.

    Nodes are points. Ways are lines, and closed ones polygons beside, unless the tag area says which. Relations of type multipolygon or boundary are polygons of all rings that
    their ways form, holes being inside others. An element whose nodes or ways are not in the files comes without them; one of which too little is left does not come.
    """
    hit = found.filter(matches(filters))
    relations = hit.filter("kind = 'relation' and tags['type'] in ('multipolygon', 'boundary')").select("id", "tags", "members")
    of = relations.select(F.col("id").alias("relation"), F.posexplode("members").alias("place", "m")).select("relation", "place", F.col("m.kind").alias("kind"), F.col("m.ref").alias("id"))
    named = hit.select("kind", "id").union(of.select("kind", "id")).distinct()
    ways = found.filter("kind = 'way'").join(named.filter("kind = 'way'").select("id"), "id", "left_semi").select("id", "tags", "refs")
    refs = ways.select("id", F.posexplode("refs").alias("place", "ref"))
    nodes = found.filter("kind = 'node'").select(F.col("id").alias("ref"), F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")).alias("p")).dropDuplicates(["ref"])
    lines = refs.join(nodes, "ref").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "p"))), lambda s: s["p"]).alias("line")).filter(F.size("line") > 1)
    tagged = ways.select("id", "tags").join(lines, "id")
    area = F.coalesce(F.col("tags")["area"], F.lit(""))
    closed = (F.get("line", 0) == F.element_at("line", -1)) & (F.size("line") > 3)
    shape = lambda kind, r: F.struct(F.lit(kind).alias("kind"), r.alias("rings"))
    as_line, as_ring = shape("line", F.array("line")), shape("polygon", F.array(F.slice("line", 1, F.size("line") - 1)))
    both = F.when(closed & (area == "yes"), F.array(as_ring)).when(closed & (area != "no"), F.array(as_line, as_ring)).otherwise(F.array(as_line))
    ways_out = tagged.select(F.lit("way").alias("kind"), "id", "tags", F.explode(both).alias("shape"))

    def run(key: tuple, t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("place").to_numpy(), kind="stable")
        made = closed_rings(t.column("line").take(pa.array(order)).to_pylist())
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([made], _RINGS)], names=["id", "rings"])

    parts = of.filter("kind = 'way'").join(lines, "id").select("relation", "place", "line")
    formed = parts.groupBy("relation").applyInArrow(run, "id long, rings array<array<struct<x:double,y:double>>>").filter(F.size("rings") > 0)
    relations_out = relations.select("id", "tags").join(formed, "id").select(F.lit("relation").alias("kind"), "id", "tags", shape("polygon", F.col("rings")).alias("shape"))
    points = found.filter("kind = 'node'").join(named.filter("kind = 'node'").select("id"), "id", "left_semi")
    points = points.select("kind", "id", "tags", shape("point", F.array(F.array(F.struct(F.col("lon").alias("x"), F.col("lat").alias("y"))))).alias("shape"))
    out = points.unionByName(ways_out).unionByName(relations_out).withColumn("attrs", F.map_filter("tags", lambda k, _: k.isin(*keep)))
    return out.filter(F.size("attrs") > 0).select("kind", "id", "attrs", "shape")


def layer(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The features of one object group of FILTERS."""
    return features(read_osm(spark, path), FILTERS[name], KEPT_TAGS[name])
