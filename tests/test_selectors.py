"""Parameters, registries, graphs and masks that have no SQL or more cases than it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellplane.functions import selectors
from cellplane.operators import areas, raster, runs, validate
from cellplane.plans import graph
from cellplane.scratch import materialise
from cellplane.sources import registry
from cellplane.functions.grid import GridSpec

GRID = GridSpec(60, 50, 25.0, 0.0, 1250.0)


def test_parameters():
    assert selectors.rule_distance("rail_main", "standard", 200) == 150
    heights = {"x": {"standard": "max(h,100)", "minimum": "h"}}
    assert selectors.rule_distance("x", "standard", 80, heights) == 100 and selectors.rule_distance("x", "minimum", 80, heights) == 80
    assert selectors.bbox("1, 2,3,4") == (1, 2, 3, 4) and selectors.bbox("") is None
    with pytest.raises(ValueError):
        selectors.bbox("1,2,3")
    assert selectors.expanded((0, 1, 2, 3), 10) == (-10, -9, 12, 13)
    base = {"a": 1000, "b": 1200}
    assert selectors.variant_buffers(None, base) == selectors.variant_buffers("baseline", base) == {"a": 1000.0, "b": 1200.0}
    assert selectors.variant_buffers(800, base) == {"a": 800.0, "b": 800.0} and selectors.variant_buffers({"a": 5}, base) == {"a": 5.0, "b": 1200.0}
    with pytest.raises(ValueError):
        selectors.variant_buffers("other", base)
    assert selectors.variant_bands("settlement_buffer", "800m", 10.0)[3] == "available_cleaned_min_10ha_800m"
    assert selectors.chosen(["Tirol", "Wien"], " wien ,x") == ["Wien"] and selectors.chosen(["a"], None) == ["a"]
    assert selectors.chain_hull(150) == (75, 40) and selectors.chain_hull(60) == (30, 5)


def test_tables_without_columns(spark):
    bare = spark.createDataFrame([(1, "rail"), (2, None)], "id long, fclass string").withColumn("kind", F.lit("line"))
    assert [(r.id, r.layer) for r in selectors.layers(bare).collect()] == [(1, "rail_main")]
    assert selectors.postal_addresses(bare).count() == 0


def test_registry_errors(spark):
    df = spark.createDataFrame([(1, "Eignung"), (2, None)], "poly long, Status string").withColumn("rings", F.lit(None).cast("array<array<struct<x:double,y:double>>>"))
    source = registry.ZoneSource("k", "Tirol", lambda: df, "Status", ("Eig",))
    assert registry.zone_features(df, source).count() == 1
    assert registry.zones([source]).count() == 0 and registry.zones([source], enabled=False) is None
    gone = registry.ZoneSource("gone", "Tirol", lambda: spark.read.parquet("/nowhere/at/all"), "Status")
    assert registry.zones([gone]) is None and registry.zones([gone, source]).count() == 0
    with pytest.raises(KeyError):
        registry.zone_features(df.drop("Status"), source)
    with pytest.raises(ValueError):
        registry.zone_features(df, registry.ZoneSource("k", "Tirol", lambda: df, "Status"))
    with pytest.raises(KeyError):
        registry.cleaned(df, ["other"])
    sets = {"a": registry.Dataset("a", "Tirol", ("x",))}
    rules = [{"dataset": "a", "bucket": "u", "match": [{"col": "y", "values": [1]}]}, {"dataset": "a", "bucket": "v", "match": [{"col": "x", "values": [1]}]}]
    assert registry.dataset_columns(rules, sets, "a") == ["x", "y"]
    assert len(registry.sources_for(rules, sets, "a", "v")) == 1 and registry.sources_for(rules, sets, "a", provinces={"Wien"}) == []


def test_grids_and_outcome(spark):
    validate.same_grid(GRID, GRID)
    with pytest.raises(ValueError, match="width"):
        validate.same_grid(GRID, GridSpec(61, 50, 25.0, 0.0, 1250.0))
    rows = spark.createDataFrame([(True,), (False,)], "unerwartet boolean")
    assert validate.outcome(rows) == 1 and validate.outcome(rows, same_hash=True) == 0 and validate.outcome(rows.filter("not unerwartet")) == 0
    one = spark.createDataFrame([(1, "a"), (2, "b")], "nr int, name string")
    assert sorted((r.nr, r.ref_nr) for r in validate.aligned(one, spark.createDataFrame([(1, "b"), (2, "")], "nr int, name string")).collect()) == [(1, 1), (2, 2)]
    docs = spark.createDataFrame([('{"x_wirkungspfad": ["a", "b"], "y_wirkungspfad": "no list", "z": ["c"]}',), (None,)], "doc string")
    assert sorted(r.band_name for r in validate.allowed_bands(docs, "doc").collect()) == ["a", "b"]


def test_graph(spark):
    edges = spark.createDataFrame([("p", "f", "actor", "artifact", "writes"), ("p", "g", "actor", "artifact", "reads"), ("f", "q", "artifact", "actor", "writes"), ("p", "q", "actor", "actor", "invokes")], "src string, dst string, src_kind string, dst_kind string, verb string")
    assert sorted((r.producer, r.consumer) for r in graph.directed(edges).collect()) == [("g", "p"), ("p", "f"), ("q", "f")]
    line = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "x")], "src string, dst string")
    assert sorted((r.node, r.stage) for r in graph.stages(line, lambda df: materialise(df, "stages")).collect()) == [("a", 0), ("b", 1), ("c", 2)]


def test_perimeter_and_union(spark):
    rng = np.random.default_rng(5)
    cells = np.unique(rng.integers(0, 12, (60, 2)), axis=0)
    own = [(1, int(r), int(c), int(c)) for r, c in cells] + [(2, 3, 0, 4), (2, 3, 2, 9), (2, 3, 11, 12), (2, 4, 5, 5)]
    mask = areas.union_by(spark.createDataFrame(own, "g int, row int, c0 int, c1 int"), "g")
    assert sorted((r.row, r.c0, r.c1) for r in mask.filter("g = 2").collect()) == [(3, 0, 9), (3, 11, 12), (4, 5, 5)]
    grid = np.zeros((14, 14), dtype=int)
    grid[cells[:, 0] + 1, cells[:, 1] + 1] = 1
    exposed = np.abs(np.diff(grid, axis=0)).sum() + np.abs(np.diff(grid, axis=1)).sum()
    assert {r.g: r.perimeter_m for r in areas.perimeter(mask, "g", 25.0).collect()} == {1: exposed * 25.0, 2: (2 * 13 + 2 * 3 - 2) * 25.0}


def test_park_mask(spark):
    """Cells of every park hull widened by the margin, against distances from the hulls' cells."""
    rng = np.random.default_rng(2)
    places = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(50, 1200, (14, 2)))]
    turbines = spark.createDataFrame(places, "id long, x double, y double")
    everywhere = runs.whole(GRID, spark)
    zone = spark.createDataFrame([(r, 0, 15) for r in range(50)], "row int, c0 int, c1 int")
    got = {(r.row, r.col) for r in runs.to_cells(areas.park_mask(turbines, zone, everywhere, GRID, 200.0, 50.0)).collect()}
    outside = [(x, y) for _, x, y in places if int(x // 25) > 15]
    group = list(range(len(outside)))
    for _ in outside:
        for i, a in enumerate(outside):
            for j, b in enumerate(outside):
                if np.hypot(a[0] - b[0], a[1] - b[1]) <= 200:
                    group[i] = group[j] = min(group[i], group[j])
    from cellplane.operators import outlines, rasterise

    want = set()
    for g in set(group):
        hull = outlines.convex_hull(np.array([p for p, o in zip(outside, group, strict=True) if o == g]))
        unit = np.stack([hull[:, 0] / 25, (1250 - hull[:, 1]) / 25], axis=1)
        own = rasterise.outline(unit, len(hull) > 2) + (rasterise.filled([unit]) if len(hull) > 2 else [])
        base = {(r, c) for r, c0, c1 in own for c in range(c0, c1 + 1)}
        want |= {(r + dr, c + dc) for r, c in base for dr in range(-2, 3) for dc in range(-2, 3) if dr * dr + dc * dc <= 4}
    assert got == {(r, c) for r, c in want if 0 <= r < 50 and 15 < c < 60}


def test_resampling_kinds(spark):
    plane = spark.createDataFrame([(0, 0, 1.0), (0, 1, 3.0), (1, 0, None), (5, 5, float("nan"))], "row int, col int, v double")
    assert [(r.row, r.col, r.average, r.greatest) for r in raster.reduced(plane, 2).collect()] == [(0, 0, 2.0, 3.0)]
    with pytest.raises(ValueError):
        raster.resampled(plane, GRID, GRID, F.col("tx"), F.col("ty"), "cubic")
    assert [r.v for r in raster.median_filled(plane, "v").orderBy("row", "col").collect()] == [1.0, 3.0, 2.0, 2.0]


def test_manifest(spark):
    import json

    from cellplane.plans import bands, compose

    doc = json.loads(compose.manifest(spark, parameters={"a": "b"}, grid=GRID))
    assert compose.findings(doc) == [] and doc["band_count"] == 44 and doc["bands"][31]["label_de"] == "Eignungsflächen"
    assert all(b["label_de"] and b["familie"] and b["stufe"] in doc["stufe_order"] for b in doc["bands"])
    assert [b["label_de"] for b in doc["bands"] if b["value_type"] == "percent_0_100"] == ["Unschärfe schwach", "Unschärfe mittel", "Unschärfe stark", "Unschärfe sehr stark"]
    touched = {c["id"]: {bands.BANDS[i - 1] for i in c["affects"]["bands"]} for c in doc["caveats"]}
    assert touched["blur_bleed"] == {b for b in bands.BANDS if b.startswith("available_blur")} and "haeuser_im_gruenen" not in touched["noe_dkm"]
    assert compose.header_findings(doc, 44, 60, 50, GRID.crs) == [] and len(compose.header_findings(doc, 43, 60, 51, "x")) == 3
    own = compose.report(doc)
    assert sum(map(len, own["by_role"].values())) == sum(map(len, own["by_category"].values())) == 44 and own["findings"] == []
    assert "# Band 32: Eignungsflächen" in compose.band_page(doc["bands"][31])
    assert compose.table_page(["a"], [["x|y"], [None]]) == "| a |\n| --- |\n| x\\|y |\n|  |\n"
