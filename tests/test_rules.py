"""Scalar rules, predicates, traffic lights and the register."""

import pytest
from pyspark.sql import functions as F

from cellplane.functions import scalars as S
from cellplane.functions.predicates import matches
from cellplane.operators import cluster, spatial, validate

KINDS = [
    ("41", None, "building"), ("041", None, "building"), ("FIG041", None, "building"), ("fig41", None, "building"), ("41.0", None, "building"), ("66", None, "building"), ("52", None, "garden"), ("71", None, "garden"),
    ("FIG052", None, "garden"), ("abc", None, None), ("", None, None), (None, None, None), ("99", "Baufläche (begrünt)", "building"), ("99", "BAUFLAECHE", "building"), ("99", "Garten", "garden"), (None, "garten x", "garden"), ("41", "Garten", "building"),
]


def test_land_use(spark):
    rows = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(KINDS)], "i int, a string, b string")
    got = {r.i: r.k for r in rows.select("i", S.land_use_kind(F.col("a"), F.col("b")).alias("k")).collect()}
    assert got == {i: k for i, (_, _, k) in enumerate(KINDS)}


def test_parsers(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    assert one(S.power_kw(F.lit("2 MW"))) == 2000 and one(S.power_kw(F.lit("0,5 gw"))) == 500_000 and one(S.power_kw(F.lit("800"))) == 0.8
    assert one(S.power_kw(F.lit("3 hp"))) is None and one(S.power_kw(F.lit(" "))) is None
    assert one(S.voltages_kv(F.lit("110000;20000, 400"))) == [20, 110]
    assert one(S.transliterated(F.lit("Kärnten ß"))) == "Kaernten ss" and one(S.display_province(F.lit("Oberoesterreich"))) == "Oberösterreich"
    assert one(S.category_base(F.lit(" (historisch) "))) == "Unbekannt" and one(S.category_base(F.lit("Wald (historisch)"))) == "Wald"
    assert one(S.str_value(F.lit(41.0))) == "41" and one(S.str_value(F.lit(41.5))) == "41.5"


def test_predicates(spark):
    df = spark.createDataFrame([("Gemischtes Baugebiet",), ("Gemischtes Baugebiet-Betriebsbaugebiet",), (None,)], "w string")
    look = {"match": [{"col": "w", "contains": "^Gemischtes Baugebiet(?!-Betriebsbaugebiet)"}]}
    assert df.filter(matches(look, df.columns)).count() == 1
    with pytest.raises(KeyError):
        matches({"match": [{"col": "x", "values": [1]}]}, df.columns)
    with pytest.raises(ValueError):
        matches({"match": [{"col": "w", "like": "x"}]}, df.columns)


@pytest.mark.parametrize(
    "role,share,ha,km2,light",
    [("bedingung", 0.01, 1.0, 0, "gruen"), ("bedingung", 0.010001, 1.0, 0, "gelb"), ("bedingung", 0.1, 25.0, 0, "gelb"), ("bedingung", 0.1, 25.000001, 0, "rot"), ("unschaerfe", 9, 9, 1.0, "gruen"), ("unschaerfe", 0, 0, 1.000001, "gelb"), ("aggregat_gesamt", 0, 0, 10.000001, "rot"), ("referenz", 0, 0, 0, "rot")],
)
def test_lights(spark, role, share, ha, km2, light):
    got = spark.range(1).select(S.light(F.lit(role), F.lit(float(share)), F.lit(float(ha)), F.lit(float(km2))).alias("l")).first().l
    assert got == light


def test_register(spark):
    columns = "band_nr int, band_name string, role string, pixel_abs long, anteil_prozent double, groesste_flaeche_ha double, flaeche_km2 double, schwerpunkt_bundesland string, ohne_gegenstueck boolean"
    rows = [(1, "a", "bedingung", 9, 5.0, 50.0, 1.0, "Wien", False), (2, "b", "bedingung", 0, 0.0, 0.0, 0.0, "", False), (3, "c", "bedingung", 9, 5.0, 50.0, 1.0, "Wien", False), (4, "d", "bedingung", 0, 0.0, 0.0, 0.0, "", True)]
    old = spark.createDataFrame([("P", "1", "a", "1", "", "", "", "rot", "vom Nutzer angenommen"), ("Q", "7", "z", "1", "", "", "", "gelb", "x")], ", ".join(f"{c} string" for c in validate.COLUMNS))
    allowed = spark.createDataFrame([("a",), ("b",)], "band_name string")
    new = validate.upserted(old, "P", spark.createDataFrame(rows, columns), allowed)
    got = {(r.paket, r.band_name): (r.ampel, r.ursache) for r in new.collect()}
    assert got == {("P", "a"): ("akzeptiert", "vom Nutzer angenommen"), ("P", "c"): ("rot", validate.UNEXPECTED), ("P", "d"): ("ohne_gegenstueck", validate.NO_COUNTERPART), ("Q", "z"): ("gelb", "x")}
    again = validate.upserted(new, "P", spark.createDataFrame(rows, columns), allowed)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, new.collect()))


def test_overlap_and_cover(spark):
    def square(i, x, y, side):
        return (i, [[{"x": x, "y": y}, {"x": x + side, "y": y}, {"x": x + side, "y": y + side}, {"x": x, "y": y + side}]])

    schema = "poly long, rings array<array<struct<x:double,y:double>>>"
    a = spark.createDataFrame([square(1, 0.0, 0.0, 10.0), square(2, 100.0, 100.0, 5.0), square(3, 2.0, 2.0, 2.0)], schema)
    b = spark.createDataFrame([square(8, 9.0, 9.0, 5.0), square(9, 1.0, 1.0, 8.0)], schema)
    assert {tuple(r) for r in spatial.overlapping(a, b, 16.0).collect()} == {(1, 8), (1, 9), (3, 9)}
    p = spark.createDataFrame([(1, 3.0, 3.0), (2, 9.5, 1.0), (3, 50.0, 50.0)], "id long, x double, y double")
    assert {(r.id, r.poly) for r in spatial.smallest_cover(p, a, 16.0).collect()} == {(1, 3), (2, 1)}


def test_knee_and_ranks(spark):
    curve = spark.createDataFrame([(i, float(d)) for i, d in enumerate([1, 1, 1, 1, 1, 2, 9])], "rank long, distance double")
    assert cluster.chord_knee(curve).first()["rank"] == 5
    ranked = cluster.ranked(spark.range(100).withColumn("v", F.pmod(F.col("id") * 37, F.lit(101))), "v", "id").orderBy("v", "id").collect()
    assert [r["rank"] for r in ranked] == list(range(100))
