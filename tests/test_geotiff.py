"""GeoTIFF files: round trips, layouts, and what is not read."""

import struct
import zlib

import numpy as np
import pytest

from cellplane.functions.grid import GridSpec
from cellplane.operators import raster
from cellplane.sources import geotiff

GRID = GridSpec(70, 45, 25.0, 1000.0, 9000.0)


def tiled(values, size=16, order=">"):
    """A big-endian file of plain tiles with horizontal differences."""
    height, width = values.shape
    tiles = []
    for r in range(0, height, size):
        for c in range(0, width, size):
            tile = np.zeros((size, size), dtype=values.dtype)
            part = values[r : r + size, c : c + size]
            tile[: part.shape[0], : part.shape[1]] = part
            tile[:, 1:] = np.diff(tile, axis=1)
            tiles.append(tile.astype(values.dtype.newbyteorder(order)).tobytes())
    offsets = [8 + sum(map(len, tiles[:i])) for i in range(len(tiles))]
    at = 8 + sum(map(len, tiles))
    entries = [(256, 3, [width]), (257, 3, [height]), (258, 3, [16]), (259, 3, [1]), (317, 3, [2]), (322, 3, [size]), (323, 3, [size]), (324, 4, offsets), (325, 4, [len(t) for t in tiles]), (339, 3, [2])]
    far, table, tail = at + 2 + 12 * len(entries) + 4, b"", b""
    for tag, code, v in entries:
        raw = struct.pack(f">{len(v)}{'H' if code == 3 else 'I'}", *v)
        place = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack(">I", far + len(tail))
        tail += raw if len(raw) > 4 else b""
        table += struct.pack(">HHI", tag, code, len(v)) + place
    return b"MM\0*" + struct.pack(">I", at) + b"".join(tiles) + struct.pack(">H", len(entries)) + table + b"\0" * 4 + tail


def test_round_trip(spark, tmp_path):
    rng = np.random.default_rng(1)
    bands = [rng.normal(size=(45, 70)).astype(np.float32), np.where(rng.random((45, 70)) < 0.3, -9999, 7).astype(np.float32)]
    bands[0][3, 4] = np.nan
    (tmp_path / "a.tif").write_bytes(geotiff.encoded(bands, GRID, rows=11, nodata=-9999))
    (head,) = geotiff.headers(spark, str(tmp_path / "a.tif")).collect()
    assert geotiff.grid_of(head) == GRID and (head.bands, head.dtype, head.nodata) == (2, "<f4", -9999.0)
    for r in geotiff.planes(spark, str(tmp_path / "a.tif")).collect():
        v = bands[r.band - 1][r.row, r.col]
        assert r.v is None if np.isnan(v) or v == -9999 else r.v == v
    got = np.zeros((2, 45, 70), dtype=bool)
    for r in geotiff.set_runs(spark, str(tmp_path / "a.tif")).collect():
        assert not got[r.band - 1, r.row, r.c0 : r.c1 + 1].any()
        got[r.band - 1, r.row, r.c0 : r.c1 + 1] = True
    assert (got[1] == (bands[1] == 7)).all() and not got[0, 3, 4] and got[0].sum() == 45 * 70 - 1


def test_tiles_and_differences(spark, tmp_path):
    values = np.random.default_rng(2).integers(-300, 300, (40, 50)).astype(np.int16)
    (tmp_path / "t.tif").write_bytes(tiled(values))
    got = np.zeros((40, 50))
    for r in geotiff.planes(spark, str(tmp_path / "t.tif")).collect():
        got[r.row, r.col] = r.v
    assert (got == values).all()
    blocks = {(r.row, r.col): (r.average, r.greatest) for r in raster.reduced(geotiff.planes(spark, str(tmp_path / "t.tif")), 10).collect()}
    assert len(blocks) == 20 and blocks[1, 2] == (values[10:20, 20:30].mean(), values[10:20, 20:30].max())


def test_mask_round_trip(spark, tmp_path):
    on = np.random.default_rng(3).random((45, 70)) < 0.4
    (tmp_path / "m.tif").write_bytes(geotiff.encoded([on.astype(np.uint8)], GRID))
    assert (geotiff.mask_array(geotiff.set_runs(spark, str(tmp_path / "m.tif")).select("row", "c0", "c1"), GRID) == on).all()


def test_what_is_not_read():
    data = geotiff.encoded([np.zeros((4, 4), np.uint8)], GRID)
    with pytest.raises(ValueError, match="no TIFF"):
        geotiff.header(b"PK" + data)
    at = data.index(struct.pack("<HHI", geotiff.COMPRESSION, 3, 1))
    with pytest.raises(ValueError, match="compression 5"):
        next(geotiff.parts(data[: at + 8] + b"\5\0" + data[at + 10 :]))
    assert zlib.decompress(zlib.compress(b"x")) == b"x"
