"""Readers and writers on small files made here."""

import io
import json
import sqlite3
import struct
import zipfile

from pyspark.sql import functions as F

from cellplane.functions import projection
from cellplane.functions.grid import GridSpec
from cellplane.operators import runs
from cellplane.sources import files, shapes, store

SQUARE = [[{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 4.0}, {"x": 0.0, "y": 4.0}, {"x": 0.0, "y": 0.0}]]


def test_wkb_round_trip(spark):
    rows = [(1, "polygon", SQUARE), (2, "line", [SQUARE[0][:3]]), (3, "point", [SQUARE[0][1:2]]), (4, None, None)]
    df = spark.createDataFrame(rows, "id long, kind string, rings array<array<struct<x:double,y:double>>>")
    back = shapes.decoded(shapes.encoded(df), "geometry").orderBy("id").collect()
    assert [(r.id, r.kind) for r in back] == [(i, k) for i, k, _ in rows]
    assert [[[p.asDict() for p in ring] for ring in r.rings] for r in back[:3]] == [r for _, _, r in rows[:3]]


def test_geojson(spark, tmp_path):
    lines = [
        '{"type":"Feature","properties":{"highway":"primary","name":"A"},"geometry":{"type":"LineString","coordinates":[[0,0],[3,4]]}}',
        '\x1e{"type":"Feature","properties":{"building":"yes"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[4,0],[4,4],[0,0]]],[[[9,9],[10,9],[10,10],[9,9]]]]}}',
        "", '{"type":"Feature","properties":{},"geometry":{"type":"Point","coordinates":[1.5,2.5]}}',
    ]
    (tmp_path / "a.geojsonseq").write_text("\n".join(lines))
    df = files.with_class(files.read_geojson_seq(spark, str(tmp_path / "a.geojsonseq")))
    got = sorted((r.shape.kind, len(r.shape.rings), r.fclass, r.type) for r in df.collect())
    assert got == [("line", 1, "primary", None), ("point", 1, None, None), ("polygon", 2, None, "yes")]
    assert files.read_geojson_seq(spark, str(tmp_path / "none")).count() == 0
    features = [r.f for r in df.select(files.feature_text(F.col("attrs"), F.col("shape.kind"), F.col("shape.rings")).alias("f")).collect()]
    text = files.collection_text(features, "EPSG:31287")
    assert files.check_collection(text, 3, "EPSG:31287") == [] and len(files.check_collection(text, 2, "EPSG:4326")) == 2
    (tmp_path / "b.geojson").write_text(text)
    assert sorted(r.shape.kind for r in files.read_geojson(spark, str(tmp_path / "b.geojson")).collect()) == ["line", "point", "polygon"]


def shapefile() -> dict[str, bytes]:
    ring = [(p["x"], p["y"]) for p in SQUARE[0]]
    content = struct.pack("<i4d2i", 5, 0, 0, 4, 4, 1, len(ring)) + struct.pack("<i", 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    record = struct.pack(">2i", 1, len(content) // 2) + content
    empty = struct.pack(">2i", 2, 2) + struct.pack("<i", 0)
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(record) + len(empty)) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)
    field = b"NS".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([4]) + b"\0" * 15
    dbf = bytes([3, 0, 0, 0]) + struct.pack("<IHH", 2, 32 + 32 + 1, 5) + b"\0" * 20 + field + b"\r" + b" 41  " + b"     "
    return {"x/NFL.shp": head + record + empty, "x/NFL.dbf": dbf}


def zipped(members: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def test_shapefile_in_nested_zip(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zipped({"inner.zip": zipped(shapefile())}))
    rows = files.read_shapefiles(spark, str(tmp_path)).orderBy("row").collect()
    assert [(r.layer, r.row, r.kind, r.attrs.get("NS")) for r in rows] == [("nfl", 0, "polygon", "41"), ("nfl", 1, None, None)]


def test_geopackage(spark, tmp_path):
    path = tmp_path / "g.gpkg"
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    db.execute("INSERT INTO gpkg_geometry_columns VALUES ('zones', 'geom')")
    db.execute("CREATE TABLE zones (fid INTEGER, status TEXT, geom BLOB)")
    blob = b"GP\0\x01" + struct.pack("<i", 31287) + shapes.to_wkb("polygon", SQUARE)
    db.executemany("INSERT INTO zones VALUES (?, ?, ?)", [(1, "A", blob), (2, None, None)])
    db.commit()
    db.close()
    rows = files.read_geopackages(spark, str(path)).orderBy("row").collect()
    assert [(r.layer, r.kind, r.attrs["status"]) for r in rows] == [("zones", "polygon", "A"), ("zones", None, None)]


def test_drawing(spark, tmp_path):
    pairs = [(0, "SECTION"), (0, "INSERT"), (8, "NS"), (2, "FIG041"), (10, 5), (20, 6), (0, "LWPOLYLINE"), (8, "GG"), (70, 1), (10, 0), (20, 0), (10, 4), (20, 0), (10, 4), (20, 4), (0, "LINE"), (8, "GG"), (10, 0), (20, 0), (11, 1), (21, 1)]
    pairs += [(0, "POLYLINE"), (8, "GG"), (70, 1), (0, "VERTEX"), (10, 0), (20, 0), (0, "VERTEX"), (10, 2), (20, 0), (0, "VERTEX"), (10, 2), (20, 2), (0, "SEQEND"), (0, "ENDSEC"), (0, "EOF")]
    (tmp_path / "d.dxf").write_text("\n".join(f"{c}\n{v}" for c, v in pairs), encoding="latin-1")
    rows = files.read_drawings(spark, str(tmp_path / "d.dxf")).orderBy("row").collect()
    assert [(r.layer, r.kind, len(r.rings[0])) for r in rows] == [("NS", "point", 1), ("GG", "line", 4), ("GG", "line", 2), ("GG", "line", 4)]
    assert rows[0].attrs["symbol"] == "FIG041"
    b = files.drawing_bounds(files.read_drawings(spark, str(tmp_path / "d.dxf"))).first()
    assert (b.minx, b.miny, b.maxx, b.maxy) == (0, 0, 5, 6)


def test_symbols(spark, tmp_path):
    (tmp_path / "s.csv").write_text("layer;symbol;kategorie;bezeichnung;vermv10_nr\nNS;FIG041;Baufläche (historisch);Gebäude;66\nNS;FIG052;Garten;;\nXX;FIG099;x;y;1\n", encoding="utf-8-sig")
    lookup = files.symbol_lookup(files.read_csv(spark, str(tmp_path / "s.csv")))
    df = spark.createDataFrame([("fig041",), ("41.0",), ("66",), ("FIG99",), (None,)], "v string")
    got = {r.v: (r.ns, r.category, r.label) for r in files.decode_symbols(df, "v", lookup).collect()}
    assert got == {"fig041": ("41", "Baufläche", "Gebäude"), "41.0": ("41", "Baufläche", "Gebäude"), "66": ("41", "Baufläche", "Gebäude"), "FIG99": ("99", "Unbekannt", None), None: (None, None, None)}


def test_store(spark, tmp_path):
    grid = GridSpec(20, 20)
    layers = store.LayerStore(spark, str(tmp_path / "layers"), grid)
    built = []

    def build():
        built.append(1)
        return {"a": runs.from_cells(spark.createDataFrame([(1, 2), (1, 3)], "row int, col int"))}

    assert layers.ensure(["a", "b"], build, {"d": 100}) == ["a", "b"]
    assert layers.ensure(["a", "b"], build, {"d": 100}) == [] and len(built) == 1
    assert layers.read("a").count() == 1 and layers.read("b").count() == 0
    assert layers.ensure(["a"], build, {"d": 200}) == ["a"]
    layers.require(["a", "b"])
    try:
        layers.require(["a", "x", "y"])
        raise AssertionError
    except FileNotFoundError as e:
        assert "x, y" in str(e)
    store.write_product({"a": layers.read("a"), "z": layers.read("a")}, str(tmp_path / "product"), grid, {"schema_version": "1"})
    assert store.read_product(spark, str(tmp_path / "product")).groupBy("band").count().count() == 2
    assert [b["name"] for b in json.loads((tmp_path / "product.json").read_text())["bands"]] == ["a", "z"]
    assert store.overlay(layers.read("a"), grid, (255, 0, 0, 200)).startswith(b"\x89PNG")


def test_fingerprint(spark, tmp_path):
    f = tmp_path / "in.txt"
    f.write_text("one")
    first = store.fingerprint(spark, [str(f)], [b"code"])
    assert first == store.fingerprint(spark, [str(f)], [b"code"])
    f.write_text("three")
    assert first != store.fingerprint(spark, [str(f)], [b"code"])
    assert first != store.fingerprint(spark, [str(f), str(tmp_path / "more")], [b"code"])


def test_projections(spark):
    assert all(abs(r.dx) < 1e-3 and abs(r.dy) < 1e-3 for r in projection.check_points(spark).collect())
    # On the strip's own meridian at the equator's distance of a parallel, the conic's origin: x0, y0.
    lon, lat = projection.conic_to_geographic(F.lit(400_000.0), F.lit(400_000.0))
    r = spark.range(1).select(lon.alias("lon"), lat.alias("lat")).first()
    assert abs(r.lon - (13 + 20 / 60)) < 1e-9 and abs(r.lat - 47.5) < 1e-9
    x, y = projection.strip_to_conic(F.lit(0.0), F.lit(262_000.0), "EPSG:31255")
    assert abs(spark.range(1).select(x.alias("x")).first().x - 400_000) < 1e-6
    there = projection.national_to_wgs84(F.lit(14.0), F.lit(48.0))
    back = projection.wgs84_to_national(*there)
    r = spark.range(1).select(back[0].alias("lon"), back[1].alias("lat")).first()
    assert abs(r.lon - 14) < 1e-6 and abs(r.lat - 48) < 1e-6
