"""Zones dissolved, cut, simplified and written twice."""

import json

import pytest
from pyspark.sql import functions as F

from cellplane.functions import projection
from cellplane.plans import zone_layers

ZONES = "zone string, rings array<array<struct<x:double,y:double>>>"


def square(x, y, d):
    return [(x, y), (x + d, y), (x + d, y + d), (x, y + d)]


def test_zones(spark, tmp_path):
    x, y = 600000.0, 450000.0
    rows = [("a", [square(x, y, 100.0)]), ("a", [square(x + 50, y, 100.0)]), ("b", [square(x + 150, y, 100.0)]), ("b", [square(x + 400, y, 50.0)]), (None, [square(x, y, 10.0)]), ("c", [square(x + 5000, y, 10.0)]), ("d", None)]
    region = spark.createDataFrame([([square(x, y - 5, 420.0)],)], "rings array<array<struct<x:double,y:double>>>")
    out = zone_layers.prepared(spark.createDataFrame(rows, ZONES), region, "zone").cache()
    assert sorted((r.zone, len(r.rings[0]), round(r.area_m2, 6), r.area_ha) for r in out.collect()) == [("a", 4, 15000.0, 1.5), ("b", 4, 1000.0, 0.1), ("b", 4, 10000.0, 1.0)]
    paths = zone_layers.write_twins(out, str(tmp_path / "zones"))
    plane, world = (sorted((json.loads(r.value) for r in spark.read.text(p).collect()), key=lambda f: (f["properties"]["zone"], f["properties"]["area_m2"])) for p in paths)
    assert [f["properties"] for f in plane] == [f["properties"] for f in world] and len(world) == 3
    near = [p for f in world for p in f["geometry"]["coordinates"][0]]
    assert all(15.0 < lon < 17.5 and 47.0 < lat < 49.5 for lon, lat in near)
    back = spark.createDataFrame(near, "lon double, lat double").select(F.struct(*projection.geographic_to_conic(*projection.wgs84_to_national(F.col("lon"), F.col("lat")))).alias("p")).collect()
    for r, (px, py) in zip(back, [p for f in plane for p in f["geometry"]["coordinates"][0]], strict=True):
        assert r.p[0] == pytest.approx(px, abs=0.01) and r.p[1] == pytest.approx(py, abs=0.01)
