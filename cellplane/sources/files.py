"""Readers and writers of vector, tabular and drawing files. Missing files are empty layers where the rule says so; else they raise.

Containers (zip in zip, shapefile, GeoPackage, DXF) are read as bytes by Spark's binaryFile source and unpacked on executors, one file a row.
"""

from __future__ import annotations

import io
import json
import sqlite3
import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellplane.functions.scalars import category_base, normal_code
from cellplane.sources.shapes import DDL, decoded, from_gpkg, from_shp_record, geojson_shape, geojson_text, merged

FEATURES = "attrs map<string,string>, shape " + DDL
# Tags that make up the class of a feature, first present wins.
CLASS_TAGS = ("landuse", "highway", "railway", "aeroway", "aerialway")


def with_class(df: DataFrame, attrs: str = "attrs") -> DataFrame:
    """fclass, the first present of the class tags, and type, the building tag."""
    return df.withColumns({"fclass": F.coalesce(*[F.col(attrs)[t] for t in CLASS_TAGS]), "type": F.col(attrs)["building"]})


def _empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def features_of(lines: DataFrame) -> DataFrame:
    """(attrs, shape) of lines (value) of GeoJSON features. Record separators and lines too short for a feature are skipped."""
    kept = lines.select(F.regexp_replace("value", "^\x1e", "").alias("f")).filter(F.length(F.trim("f")) >= 10)
    return kept.select(F.from_json(F.get_json_object("f", "$.properties"), "map<string,string>").alias("attrs"), geojson_shape(F.get_json_object("f", "$.geometry")).alias("shape"))


def read_geojson_seq(spark: SparkSession, path: str) -> DataFrame:
    """(attrs, shape) of a file or folder of GeoJSON features, one a line. Record separators and blank lines are skipped; a missing path is empty."""
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return _empty(spark, FEATURES)
    return features_of(lines)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(attrs, shape) of FeatureCollection files, one document a file."""
    try:
        whole = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return _empty(spark, FEATURES)
    # Members stay text: a map of strings keeps nested JSON as it is written.
    parts = F.explode(F.from_json(F.get_json_object("value", "$.features"), "array<struct<properties:string,geometry:string>>")).alias("f")
    kept = whole.filter(F.length("value") >= 10).select(parts)
    return kept.select(F.from_json("f.properties", "map<string,string>").alias("attrs"), geojson_shape(F.col("f.geometry")).alias("shape"))


def read_geoparquet(spark: SparkSession, path: str, geometry: str = "geometry") -> DataFrame:
    """A GeoParquet table with kind and rings in place of its geometry. Filters on the result's attributes are pushed down only if made before: see `attributes`."""
    return decoded(spark.read.parquet(path), geometry)


def read_csv(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """All columns as text, a byte order mark skipped."""
    df = spark.read.csv(path, sep=sep, header=True, inferSchema=False, encoding="UTF-8")
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def members(content: bytes, name: str = "") -> Iterator[tuple[str, bytes]]:
    """Files in a zip, those of zips inside it too; a file that is no zip is itself."""
    if content[:2] != b"PK":
        yield name, content
        return
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for info in z.infolist():
            if not info.is_dir():
                inner = z.read(info)
                yield from members(inner, f"{name}/{info.filename}") if info.filename.lower().endswith(".zip") else [(f"{name}/{info.filename}", inner)]


def dbf_rows(data: bytes) -> list[dict[str, str | None]]:
    """Rows of a dBase table as text, blanks as null."""
    n, head, size = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("latin-1"), data[at + 16]))
        at += 32
    out = []
    for i in range(n):
        at = head + i * size + 1
        row = {}
        for name, width in fields:
            raw = data[at : at + width]
            try:
                text = raw.decode("utf-8").strip(" \0")
            except UnicodeDecodeError:
                text = raw.decode("latin-1").strip(" \0")
            row[name], at = text or None, at + width
        out.append(row)
    return out


def shp_shapes(data: bytes) -> list[tuple[str | None, list]]:
    out, at = [], 100
    while at + 8 <= len(data):
        (words,) = struct.unpack_from(">i", data, at + 4)
        out.append(merged(from_shp_record(data[at + 8 : at + 8 + 2 * words])))
        at += 8 + 2 * words
    return out


def _features(read):
    """A mapInArrow function over (path, content) that emits (source, layer, row, attrs, kind, rings); read yields (layer, row, attrs, kind, rings)."""
    point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
    schema = pa.schema([("source", pa.string()), ("layer", pa.string()), ("row", pa.int64()), ("attrs", pa.map_(pa.string(), pa.string())), ("kind", pa.string()), ("rings", pa.list_(pa.list_(point)))])

    def run(batches):
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                rows = list(read(path, content.as_py()))
                for i in range(0, len(rows), 5000):
                    part = rows[i : i + 5000]
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(part), pa.string()), *[pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), list(schema)[1:], strict=True)]], schema=schema)

    return run


FEATURE_ROWS = "source string, layer string, row long, attrs map<string,string>, kind string, rings array<array<struct<x:double,y:double>>>"


def _binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def _shapefiles(path: str, content: bytes):
    files = {n.lower(): d for n, d in members(content, "")}
    for name in sorted(files):
        if name.endswith(".shp"):
            rows = dbf_rows(files[name[:-4] + ".dbf"]) if name[:-4] + ".dbf" in files else []
            for i, (kind, rings) in enumerate(shp_shapes(files[name])):
                attrs = rows[i] if i < len(rows) else {}
                yield name[:-4].rpartition("/")[2], i, list(attrs.items()), kind, rings


def read_shapefiles(spark: SparkSession, path: str) -> DataFrame:
    """Features of all shapefiles in zips (and zips in zips) under a path: source, layer, row, attrs, kind, rings."""
    return _binary(spark, path).mapInArrow(_features(_shapefiles), FEATURE_ROWS)


def _geopackage(path: str, content: bytes):
    for name, data in members(content, ""):
        if content[:2] == b"PK" and not name.lower().endswith(".gpkg"):
            continue
        db = sqlite3.connect(":memory:")
        db.deserialize(data)
        for layer, column in db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY table_name").fetchall():
            rows = db.execute(f'SELECT * FROM "{layer}"')
            names = [d[0] for d in rows.description]
            for i, row in enumerate(rows):
                values = dict(zip(names, row, strict=True))
                blob = values.pop(column)
                yield layer, i, [(k, None if v is None else str(v)) for k, v in values.items() if not isinstance(v, bytes)], *merged(from_gpkg(blob) if blob else [])
        db.close()


def read_geopackages(spark: SparkSession, path: str) -> DataFrame:
    """Features of all layers of GeoPackages, zipped or not."""
    return _binary(spark, path).mapInArrow(_features(_geopackage), FEATURE_ROWS)


def dxf_pairs(content: bytes) -> Iterator[tuple[int, str]]:
    lines = content.decode("latin-1").splitlines()
    for i in range(0, len(lines) - 1, 2):
        if lines[i].strip().lstrip("-").isdigit():
            yield int(lines[i]), lines[i + 1].strip()


def _drawing(path: str, content: bytes):
    """INSERT as points with their symbol, LINE, LWPOLYLINE and POLYLINE as lines; closed ones end where they begin."""
    kind, layer, symbol, closed, xs, ys, n = None, "", None, False, [], [], 0
    vertices: list[tuple[float, float]] | None = None  # of an old-style polyline under way
    out = []

    def emit():
        nonlocal n
        points = list(zip(xs, ys, strict=False))
        if kind == "INSERT" and points:
            out.append((layer, n, [("symbol", symbol)], "point", [[{"x": points[0][0], "y": points[0][1]}]]))
        elif kind in ("LINE", "LWPOLYLINE", "POLYLINE") and len(points) > 1:
            points += points[:1] if closed and points[0] != points[-1] else []
            out.append((layer, n, [("closed", str(closed).lower())], "line", [[{"x": x, "y": y} for x, y in points]]))
        else:
            return
        n += 1

    for code, value in [*dxf_pairs(content), (0, "EOF")]:
        if code == 0:
            if vertices is not None and kind == "VERTEX" and xs:
                vertices.append((xs[-1], ys[-1]))
            if kind == "POLYLINE" and value == "VERTEX":
                vertices = []
            elif vertices is not None and value == "SEQEND":
                kind, xs, ys = "POLYLINE", [v[0] for v in vertices], [v[1] for v in vertices]
                emit()
                vertices = None
            elif vertices is None:
                emit()
            if value == "VERTEX" or (vertices is not None and value == "SEQEND"):
                kind, xs, ys = value, [], []
            else:
                kind, layer, symbol, closed, xs, ys = value, "", None, False, [], []
        elif code == 8 and kind != "VERTEX":
            layer = value
        elif code == 2:
            symbol = value
        elif code == 70 and kind in ("LWPOLYLINE", "POLYLINE"):
            closed = bool(int(value) & 1)
        elif code in (10, 11):
            xs.append(float(value))
        elif code in (20, 21):
            ys.append(float(value))
    return out


def read_drawings(spark: SparkSession, path: str) -> DataFrame:
    """Features of DXF drawings, zipped or not."""
    def each(path: str, content: bytes):
        for name, data in members(content, ""):
            if content[:2] != b"PK" or name.lower().endswith(".dxf"):
                yield from _drawing(path, data)

    return _binary(spark, path).mapInArrow(_features(each), FEATURE_ROWS)


def drawing_bounds(features: DataFrame) -> DataFrame:
    pts = F.explode(F.flatten("rings")).alias("p")
    return features.select("source", pts).groupBy("source").agg(F.min("p.x").alias("minx"), F.min("p.y").alias("miny"), F.max("p.x").alias("maxx"), F.max("p.y").alias("maxy"))


def symbol_lookup(table: DataFrame) -> DataFrame:
    """(symbol, ns, vermv10, category, label) of the rows of layer NS of a symbol table (layer, symbol, kategorie, bezeichnung, vermv10_nr)."""
    rows = table.filter((F.trim("layer") == "NS") & (F.trim(F.coalesce("symbol", F.lit(""))) != ""))
    return rows.select(F.upper(F.trim("symbol")).alias("symbol"), normal_code(F.col("symbol")).alias("ns"), normal_code(F.col("vermv10_nr")).alias("vermv10"), category_base(F.col("kategorie")).alias("category"), F.nullif(F.trim("bezeichnung"), F.lit("")).alias("label"))


def decode_symbols(df: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """df with ns, category and label: by symbol, else by code, else by historic code, else Unbekannt; null stays null. The last row of a key counts."""
    def by(key: str, name: str) -> DataFrame:
        return F.broadcast(lookup.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"__k{name}")).agg(F.max(F.struct("symbol", "ns", "category", "label")).alias(name)))

    code = normal_code(F.col(column))
    out = df.withColumns({"__s": F.upper(F.trim(F.col(column))), "__c": code})
    for key, name, on in (("symbol", "__a", "__s"), ("ns", "__b", "__c"), ("vermv10", "__d", "__c")):
        out = out.join(by(key, name), F.col(on) == F.col(f"__k{name}"), "left")
    hit = F.coalesce("__a", "__b", "__d")
    out = out.withColumns({"ns": F.coalesce(hit["ns"], F.col("__c")), "category": F.when(F.col("__c").isNotNull(), F.coalesce(hit["category"], F.lit("Unbekannt"))), "label": hit["label"]})
    return out.select(*df.columns, "ns", "category", "label")


def feature_text(attrs: Column, kind: Column, rings: Column) -> Column:
    return F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(attrs), F.lit(',"geometry":'), F.coalesce(geojson_text(kind, rings), F.lit("null")), F.lit("}"))


def write_geojson_seq(df: DataFrame, path: str) -> None:
    """Features, one a line, in as many files as df has partitions. attrs (map or struct), kind, rings."""
    df.select(feature_text(F.col("attrs"), F.col("kind"), F.col("rings")).alias("value")).write.mode("overwrite").text(path)


def collection_text(features: list[str], crs: str) -> str:
    """A FeatureCollection that names its reference system."""
    name = json.dumps({"type": "name", "properties": {"name": f"urn:ogc:def:crs:{crs.replace(':', '::')}"}})
    return f'{{"type":"FeatureCollection","crs":{name},"features":[' + ",\n".join(features) + "]}"


def check_collection(text: str, features: int, crs: str) -> list[str]:
    """What is wrong with a written collection."""
    found, doc = [], json.loads(text)
    if len(doc.get("features", [])) != features:
        found.append(f"{len(doc.get('features', []))} features, not {features}")
    if crs.replace(":", "::") not in json.dumps(doc.get("crs", {})):
        found.append(f"the reference system is not {crs}")
    return found
