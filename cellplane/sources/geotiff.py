"""GeoTIFF files: headers, planes of cells, runs of set cells, and a writer. Strips or tiles, plain or deflated, one or several bands.

A file is one row of Spark's binaryFile source; it is unpacked on an executor strip by strip, so a task holds the file and one strip.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec

# Fixed values of the format: bytes and codes of field types, tags, sample formats.
TYPES = {1: (1, "B"), 2: (1, "c"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q"), 17: (8, "q")}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, STRIP_ROWS, STRIP_BYTES, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT, SCALE, TIEPOINT, KEYS, NODATA = 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946
KINDS = {1: "u", 2: "i", 3: "f"}
#: Cells of a batch that leaves a task.
BATCH = 1 << 20


def fields(data: bytes) -> tuple[str, dict[int, tuple]]:
    """Byte order and the first directory's fields by tag, classic or big."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None:
        raise ValueError("no TIFF file")
    big = struct.unpack_from(order + "H", data, 2)[0] == 43
    (at,) = struct.unpack_from(order + ("Q" if big else "I"), data, 8 if big else 4)
    (n,) = struct.unpack_from(order + ("Q" if big else "H"), data, at)
    at += 8 if big else 2
    out = {}
    for i in range(n):
        entry = at + i * (20 if big else 12)
        tag, kind = struct.unpack_from(order + "HH", data, entry)
        (count,) = struct.unpack_from(order + ("Q" if big else "I"), data, entry + 4)
        if kind not in TYPES:
            continue
        size, code = TYPES[kind]
        value = entry + (12 if big else 8)
        if size * count > (8 if big else 4):
            (value,) = struct.unpack_from(order + ("Q" if big else "I"), data, value)
        out[tag] = (data[value : value + count],) if kind == 2 else struct.unpack_from(order + (f"{count}{code}" if len(code) == 1 else code * count), data, value)
    return order, out


def header(data: bytes) -> dict:
    """Size, place, type, bands and reference system of a file; cells that are not square are an error."""
    order, f = fields(data)
    (sx, sy), tie = f.get(SCALE, (1.0, 1.0))[:2], f.get(TIEPOINT, (0.0,) * 6)
    if abs(sx - sy) > 1e-9:
        raise ValueError(f"cells of {sx} x {sy}")
    keys = f.get(KEYS, ())
    epsg = next((keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i] in (3072, 2048) and keys[i + 1] == 0), None)
    nodata = f[NODATA][0].rstrip(b"\0 ").decode() if NODATA in f else None
    dtype = KINDS[f.get(FORMAT, (1,))[0]] + str(f[BITS][0] // 8)
    return {
        "width": f[WIDTH][0], "height": f[HEIGHT][0], "bands": f.get(SAMPLES, (1,))[0], "dtype": order + dtype, "cell_m": float(sx), "x0": tie[3] - tie[0] * sx, "y_top": tie[4] + tie[1] * sy,
        "epsg": epsg, "nodata": None if nodata in (None, "") else float(nodata), "fields": f,
    }


def parts(data: bytes) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(band, first row, first column, values) of every strip or tile; a strip of interleaved bands comes once for each."""
    h = header(data)
    f, (width, height, bands) = h["fields"], (h[k] for k in ("width", "height", "bands"))
    packed = f.get(COMPRESSION, (PLAIN,))[0]
    if packed not in (PLAIN, DEFLATE, OLD_DEFLATE):
        raise ValueError(f"compression {packed} is not read")
    predictor = f.get(PREDICTOR, (1,))[0]
    if predictor not in (1, 2) or predictor == 2 and h["dtype"][1] == "f":
        raise ValueError(f"predictor {predictor} is not read")
    tiled = TILES in f
    cols, rows = (f[TILE_WIDTH][0], f[TILE_HEIGHT][0]) if tiled else (width, f.get(STRIP_ROWS, (height,))[0])
    across, down = -(-width // cols), -(-height // rows)
    apart = f.get(PLANAR, (1,))[0] == 2
    for i, (at, size) in enumerate(zip(f[TILES if tiled else STRIPS], f[TILE_BYTES if tiled else STRIP_BYTES], strict=True)):
        band, place = divmod(i, across * down) if apart else (0, i)
        r0, c0 = place // across * rows, place % across * cols
        raw = data[at : at + size] if packed == PLAIN else zlib.decompress(data[at : at + size])
        depth = 1 if apart else bands
        values = np.frombuffer(raw, h["dtype"])
        values = values[: len(values) // (cols * depth) * cols * depth].reshape(-1, cols, depth)
        if predictor == 2:
            values = np.cumsum(values, axis=1, dtype=values.dtype.newbyteorder("="))
        values = values[: height - r0, : width - c0]
        for b in range(depth):
            yield band + b + 1, r0, c0, values[:, :, b]


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


HEADER = "path string, width int, height int, bands int, dtype string, cell_m double, x0 double, y_top double, epsg int, nodata double"


def headers(spark: SparkSession, path: str) -> DataFrame:
    """One row of HEADER for each file."""
    names = [c.split()[0] for c in HEADER.split(", ")][1:]
    schema = pa.schema([("path", pa.string()), *[(n, pa.int32()) for n in names[:3]], ("dtype", pa.string()), *[(n, pa.float64()) for n in names[4:7]], ("epsg", pa.int32()), ("nodata", pa.float64())])

    def run(batches):
        for b in batches:
            found = [{"path": p, **{n: v for n, v in header(c.as_py()).items() if n in names}} for p, c in zip(b.column("path").to_pylist(), b.column("content"), strict=True)]
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    return _files(spark, path).mapInArrow(run, HEADER)


def grid_of(row) -> GridSpec:
    """The grid of a row of headers."""
    return GridSpec(row["width"], row["height"], row["cell_m"], row["x0"], row["y_top"], f"EPSG:{row['epsg']}")


def planes(spark: SparkSession, path: str) -> DataFrame:
    """(path, band, row, col, v) of every cell; missing values are null."""
    schema = pa.schema([("path", pa.string()), ("band", pa.int32()), ("row", pa.int32()), ("col", pa.int32()), ("v", pa.float64())])

    def run(batches):
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                data = content.as_py()
                nodata = header(data)["nodata"]
                for band, r0, c0, values in parts(data):
                    step = max(1, BATCH // max(1, values.shape[1]))
                    for i in range(0, len(values), step):
                        v = values[i : i + step].astype(np.float64)
                        row, col = (x.ravel().astype(np.int32) for x in np.indices(v.shape))
                        gone = np.isnan(v) | (v == nodata if nodata is not None else False)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * v.size, pa.string()), pa.array(np.full(v.size, band, np.int32)), pa.array(row + np.int32(r0 + i)), pa.array(col + np.int32(c0)), pa.array(v.ravel(), mask=gone.ravel())], schema=schema
                        )

    return _files(spark, path).mapInArrow(run, "path string, band int, row int, col int, v double")


def set_runs(spark: SparkSession, path: str) -> DataFrame:
    """(path, band, row, c0, c1): runs of the cells that are neither 0 nor missing. Runs end at the edges of tiles."""
    schema = pa.schema([("path", pa.string()), *[(n, pa.int32()) for n in ("band", "row", "c0", "c1")]])

    def run(batches):
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                data = content.as_py()
                nodata = header(data)["nodata"]
                for band, r0, c, values in parts(data):
                    on = (values != 0) & ~np.isnan(values.astype(np.float64)) & (values != nodata if nodata is not None else True)
                    edge = np.diff(np.pad(on, ((0, 0), (1, 1))).astype(np.int8), axis=1)
                    (row, start), (_, end) = np.nonzero(edge == 1), np.nonzero(edge == -1)
                    ints = (np.full(len(row), band), row + r0, start + c, end - 1 + c)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(row), pa.string()), *[pa.array(x.astype(np.int32)) for x in ints]], schema=schema)

    return _files(spark, path).mapInArrow(run, "path string, band int, row int, c0 int, c1 int")


def encoded(bands: list[np.ndarray], grid: GridSpec, rows: int = 64, nodata: float | None = None) -> bytes:
    """A file of the bands (equal shapes and types), deflated strips band by band."""
    height, width = bands[0].shape
    dtype = bands[0].dtype.newbyteorder("<")
    strips = [zlib.compress(np.ascontiguousarray(b[i : i + rows], dtype).tobytes()) for b in bands for i in range(0, height, rows)]
    at, offsets = 8, []
    for s in strips:
        offsets.append(at)
        at += len(s)
    epsg = int(grid.crs.split(":")[1])
    kind = next(k for k, v in KINDS.items() if v == dtype.kind)
    entries = [
        (WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [dtype.itemsize * 8] * len(bands)), (COMPRESSION, 3, [DEFLATE]), (262, 3, [1]), (STRIPS, 4, offsets), (SAMPLES, 3, [len(bands)]), (STRIP_ROWS, 4, [rows]),
        (STRIP_BYTES, 4, [len(s) for s in strips]), (PLANAR, 3, [2]), (FORMAT, 3, [kind] * len(bands)), (SCALE, 12, [grid.cell_m, grid.cell_m, 0.0]), (TIEPOINT, 12, [0.0, 0.0, 0.0, grid.x0, grid.y_top, 0.0]),
        (KEYS, 3, [1, 1, 0, 1, 3072, 0, 1, epsg]),
    ]
    if nodata is not None:
        entries.append((NODATA, 2, f"{nodata:g}\0".encode()))
    far = at + 2 + 12 * len(entries) + 4
    table, tail = [], b""
    for tag, code, values in entries:
        raw = values if isinstance(values, bytes) else struct.pack(f"<{len(values)}{TYPES[code][1]}", *values)
        if len(raw) > 4:
            place, tail = struct.pack("<I", far + len(tail)), tail + raw + b"\0" * (len(raw) % 2)
        else:
            place = raw.ljust(4, b"\0")
        table.append(struct.pack("<HHI", tag, code, len(values)) + place)
    return b"II*\0" + struct.pack("<I", at) + b"".join(strips) + struct.pack("<H", len(table)) + b"".join(table) + b"\0" * 4 + tail


def mask_array(runs: DataFrame, grid: GridSpec) -> np.ndarray:
    """A mask as an array of the driver, for a product's export: one byte a cell, rows fetched in order."""
    out = np.zeros((grid.height, grid.width), dtype=np.uint8)
    for r in runs.filter(F.col("row").between(0, grid.height - 1)).toLocalIterator():
        out[r.row, max(0, r.c0) : r.c1 + 1] = 1
    return out
