"""Named layers on disk: masks with tags, written once and reused while their tags, grid and inputs stay the same; products of many bands.

A layer is a folder of Parquet runs and a line of JSON beside it. All paths go through Spark, so any file system that it reads will do.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec

VERSION = 2


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    at, fs = _path(spark, path)
    if not fs.exists(at):
        return None
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0].value if rows else ""


def write_text(spark: SparkSession, path: str, text: str) -> None:
    at, fs = _path(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def fingerprint(spark: SparkSession, inputs: Iterable[str], code: Iterable[bytes] = ()) -> dict:
    """Of input files size and time of change, of code its SHA-256; a missing input is an entry too."""
    entries: dict[str, dict] = {}
    for name in inputs:
        at, fs = _path(spark, name)
        status = fs.globStatus(at)
        found = [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in status] if status else []
        entries[name] = {"kind": "stat", "files": sorted([p.rpartition("/")[2], n, t] for p, n, t in found)}
    for i, data in enumerate(code):
        entries[f"code{i}"] = {"kind": "sha256", "sha256": hashlib.sha256(data).hexdigest()}
    return {"_fingerprint_version": VERSION, "entries": entries}


@dataclass(frozen=True)
class LayerStore:
    spark: SparkSession
    root: str
    grid: GridSpec

    def _at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def tags(self, name: str) -> dict | None:
        text = read_text(self.spark, f"{self._at(name)}.json")
        try:
            return json.loads(text) if text else None
        except ValueError:
            return None

    def _wanted(self, name: str, tags: dict) -> dict:
        return {"layer": name, "grid": asdict(self.grid), "tags": tags}

    def done(self, name: str, tags: dict) -> bool:
        """Whether the layer is there, of this grid and with these tags."""
        at, fs = _path(self.spark, f"{self._at(name)}/_SUCCESS")
        return fs.exists(at) and self.tags(name) == json.loads(json.dumps(self._wanted(name, tags)))

    def write(self, name: str, mask: DataFrame, tags: dict) -> None:
        mask.select("row", "c0", "c1").sortWithinPartitions("row", "c0").write.mode("overwrite").option("compression", "zstd").parquet(self._at(name))
        write_text(self.spark, f"{self._at(name)}.json", json.dumps(self._wanted(name, tags), sort_keys=True))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._at(name))

    def require(self, names: Iterable[str]) -> None:
        """Raises with all layers that are missing."""
        missing = [n for n in names if self.tags(n) is None]
        if missing:
            raise FileNotFoundError(f"missing layers: {', '.join(missing)}")

    def ensure(self, names: list[str], build: Callable[[], dict[str, DataFrame]], tags: dict) -> list[str]:
        """Builds the group once if any layer is missing or stale, writes only those; a name that build lacks is an empty mask. Returns what was written."""
        stale = [n for n in names if not self.done(n, tags)]
        if stale:
            built = build()
            for n in stale:
                self.write(n, built.get(n, self.spark.createDataFrame([], "row int, c0 int, c1 int")), tags)
        return stale


def write_product(bands: dict[str, DataFrame], path: str, grid: GridSpec, manifest: dict) -> None:
    """All bands as one Parquet table by band, one at a time, and the manifest, whose bands are those written."""
    spark = next(iter(bands.values())).sparkSession
    for i, (name, mask) in enumerate(bands.items()):
        mask.select("row", "c0", "c1").sortWithinPartitions("row", "c0").write.mode("overwrite" if i == 0 else "append").option("compression", "zstd").parquet(f"{path}/band={name}")
    names = [{"index": i + 1, "name": n} for i, n in enumerate(bands)]
    write_text(spark, f"{path}.json", json.dumps(manifest | {"band_count": len(names), "bands": names, "raster": asdict(grid)}, ensure_ascii=False, sort_keys=True))


def read_product(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def png(width: int, height: int, rows: Iterable[bytes]) -> bytes:
    """An image of RGBA rows."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    body = b"".join(b"\0" + r for r in rows)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">2I5B", width, height, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body, 9)) + chunk(b"IEND", b"")


def overlay(mask: DataFrame, grid: GridSpec, rgba: tuple[int, int, int, int], most: int = 3000) -> bytes:
    """A mask as an image of at most so many pixels a side; a pixel's alpha is the share of its cells that are set. Bounded by most * most pixels."""
    step = -(-max(grid.width, grid.height) // most)
    w, h = -(-grid.width // step), -(-grid.height // step)
    cells = mask.select(F.expr(f"row div {step}").alias("r"), F.explode(F.sequence("c0", "c1")).alias("c")) if step > 1 else mask.select(F.col("row").alias("r"), F.explode(F.sequence("c0", "c1")).alias("c"))
    shares = cells.groupBy("r", F.expr(f"c div {step}").alias("c")).agg(F.count("*").alias("n"))
    image = [bytearray(4 * w) for _ in range(h)]
    for p in shares.toLocalIterator():
        image[p.r][4 * p.c : 4 * p.c + 4] = bytes((*rgba[:3], min(255, round(rgba[3] * p.n / step**2))))
    return png(w, h, map(bytes, image))
