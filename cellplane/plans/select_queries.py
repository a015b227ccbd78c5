"""Queries over selectors and registries. Features are orders, parts and events with tags made of their keys, by expressions that SQL repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellplane.functions import selectors
from cellplane.functions.predicates import matches
from cellplane.plans.join_queries import boxes, boxes_sql
from cellplane.plans.placed import read
from cellplane.sources import registry


def of(s, d, table, columns):
    """The columns of a whole table, by an expression that both engines know."""
    return s.sql(f"SELECT {columns} FROM {{t}}", t=read(s, d, table))


FEATURES = """o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'polygon' WHEN 1 THEN 'line' ELSE 'point' END AS kind,
 CASE o_custkey % 9 WHEN 0 THEN 'motorway' WHEN 1 THEN 'trunk_link' WHEN 2 THEN 'primary' WHEN 3 THEN 'tertiary_link' WHEN 4 THEN 'residential'
  WHEN 5 THEN 'rail' WHEN 6 THEN 'Gondola' WHEN 7 THEN 'drag_lift' END AS fclass,
 CASE o_orderkey % 7 WHEN 0 THEN 'yes' WHEN 1 THEN ' No ' WHEN 2 THEN '0' END AS tunnel,
 CASE o_custkey % 5 WHEN 0 THEN 'Military' WHEN 1 THEN 'forest' END AS landuse,
 CASE o_custkey % 11 WHEN 0 THEN 'Barracks' WHEN 1 THEN 'range' WHEN 2 THEN 'bunker' END AS military,
 CASE o_custkey % 7 WHEN 0 THEN 'national_park' WHEN 1 THEN 'administrative' END AS boundary,
 CASE o_custkey % 6 WHEN 0 THEN 'Nature_Reserve' WHEN 1 THEN 'park' END AS leisure,
 CASE o_custkey % 13 WHEN 0 THEN '1a' WHEN 1 THEN '3' WHEN 2 THEN '5' END AS protect_class,
 CASE o_orderkey % 17 WHEN 0 THEN 'Natura  2000' WHEN 3 THEN 'Vogelschutzgebiet' WHEN 5 THEN 'Natur' END AS protection_title,
 CASE o_orderkey % 19 WHEN 0 THEN 'Bird Island' WHEN 4 THEN o_orderpriority END AS name"""
_LOW = "lower(coalesce({}, ''))"
_NATURE = (
    f"kind = 'polygon' AND (regexp_matches({_LOW.format('protection_title')} || ' ' || {_LOW.format('name')}, '{selectors.NATURE_WORDS}') OR {_LOW.format('boundary')} = 'national_park' "
    f"OR {_LOW.format('leisure')} = 'nature_reserve' OR {_LOW.format('protect_class')} IN {selectors.PROTECT_CLASSES})"
)
_MILITARY = f"kind = 'polygon' AND ({_LOW.format('landuse')} = 'military' OR {_LOW.format('military')} IN {selectors.MILITARY_AREAS})"
_OPEN = "trim(lower(coalesce(tunnel, ''))) IN ('', 'no', 'false', '0')"
_LAYERS = {
    "road_motorway_trunk": f"{_OPEN} AND fclass IN ('motorway', 'motorway_link', 'trunk', 'trunk_link')",
    "road_federal_state": f"{_OPEN} AND fclass IN ('primary', 'primary_link', 'secondary', 'secondary_link', 'tertiary', 'tertiary_link')",
    "rail_main": f"{_OPEN} AND fclass IN ('rail', 'narrow_gauge')",
    "cableway_people_150m": "lower(fclass) IN ('gondola', 'cable_car', 'chair_lift', 'mixed_lift')",
    "osm_nature_protection_areas": _NATURE,
    "military_restricted_area": _MILITARY,
}


def layers(s, d):
    """Every layer that a feature belongs to, in one pass."""
    return selectors.layers(of(s, d, "orders", FEATURES)).select("id", "layer")


ADDRESS = """o_orderkey AS id, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey AS {text}) ELSE ' ' END AS {q}addr:housenumber{q},
 CASE WHEN o_custkey % 5 <> 0 THEN 'Ort' END AS {q}addr:city{q}, CASE o_custkey % 3 WHEN 0 THEN '' ELSE '1010' END AS {q}addr:postcode{q}"""


def addresses(s, d):
    return selectors.postal_addresses(of(s, d, "orders", ADDRESS.format(text="STRING", q="`"))).select("id")


COLOURS = "event_id AS id, (event_id % 101) / 100.0 AS r, (user_id % 51) / 50.0 AS g, CASE WHEN event_id % 9 = 0 THEN NULL ELSE (event_id % 11) / 10.0 END AS b"
WANTED = (0.5, 0.4, 0.3)


def colours(s, d):
    return of(s, d, "events", COLOURS).filter(selectors.colour_matches([F.col(c).cast("double") for c in "rgb"], WANTED, 0.105)).select("id")


#: A registry over parts: two datasets, one of each brand group, with prefix, pattern and value selections.
DATASETS = {"a": registry.Dataset("a", "Tirol", ("poly", "p_type")), "b": registry.Dataset("b", "Wien", ("poly", "p_type"))}
SELECTIONS = [
    {"key": "a_homes", "dataset": "a", "bucket": "settlement", "category": "core", "match": [{"col": "p_type", "startswith": ("LARGE", "SMALL")}]},
    {"key": "a_works", "dataset": "a", "bucket": "industry", "category": "works", "match": [{"col": "p_type", "contains": "(?i)brass$"}]},
    {"key": "b_green", "dataset": "b", "bucket": "green", "category": "garden", "match": [{"col": "p_brand", "values": ["Brand#11", "Brand#12"]}]},
    {"key": "b_all", "dataset": "b", "bucket": "settlement", "category": "core", "match": [{"col": "p_brand", "values": ["Brand#12", "Brand#13"]}, {"col": "p_type", "startswith": "STANDARD"}]},
]
_WHERE = {"a_homes": "p_type LIKE 'LARGE%' OR p_type LIKE 'SMALL%'", "a_works": "regexp_matches(p_type, '(?i)brass$')", "b_green": "p_brand IN ('Brand#11', 'Brand#12')", "b_all": "p_brand IN ('Brand#12', 'Brand#13') AND p_type LIKE 'STANDARD%'"}
BOX = (1000.0, 1000.0, 5500.0, 5800.0)


def parts(s, d):
    """Boxes with their attributes; one in eleven has no geometry."""
    rows = boxes(s, d).join(read(s, d, "part").select(F.col("p_partkey").alias("poly"), "p_type", "p_brand"), "poly")
    return rows.withColumn("rings", F.when(F.col("poly") % 11 != 0, F.col("rings")))


def registered(s, d):
    """The registry's pass over both datasets: empty geometries and what reaches beyond the box go, the rest is tagged by every selection."""
    out = None
    for key in DATASETS:
        own = registry.sources_for(SELECTIONS, DATASETS, key)
        rows = registry.cleaned(parts(s, d), registry.dataset_columns(own, DATASETS, key), BOX)
        one = registry.select_buckets(rows, own, ["key", "bucket", "category"]).select("poly", "key", "bucket", "category", F.lit(DATASETS[key].province).alias("province"))
        out = one if out is None else out.unionByName(one)
    return out


_INSIDE = "p.p_partkey % 11 <> 0 AND b.x >= 1000 AND b.y >= 1000 AND b.x + b.w <= 5500 AND b.y + b.h <= 5800"
_REGISTERED = f"WITH {boxes_sql('b')} " + " UNION ALL ".join(
    f"SELECT b.poly, '{x['key']}' AS key, '{x['bucket']}' AS bucket, '{x['category']}' AS category, '{DATASETS[x['dataset']].province}' AS province FROM b JOIN part p ON p.p_partkey = b.poly WHERE {_INSIDE} AND ({_WHERE[x['key']]})" for x in SELECTIONS
)


def zones(s, d):
    """Zone sources: one filtered by the start of its status, one whole, one whose file is missing."""
    from cellplane.plans.join_queries import SITE

    def missing():
        raise FileNotFoundError("no file")

    status = F.when(F.col("poly") % 3 == 0, "Eignungszone A").when(F.col("poly") % 3 == 1, "Ausschluss")
    found = registry.zones([
        registry.ZoneSource("east", "Burgenland", lambda: parts(s, d).withColumn("Status", status), "Status", ("Eignung",)),
        registry.ZoneSource("south", "Steiermark", lambda: boxes(s, d, SITE)), registry.ZoneSource("west", "Tirol", missing),
    ])
    return found.groupBy("key", "province").agg(F.count("*").alias("n"))


def clipped_layer(s, d):
    """A layer cut to a condition, two columns and the features that meet a box."""
    return registry.layer(parts(s, d).filter("rings is not null"), F.col("p_brand").startswith("Brand#1"), ["poly", "p_type"], BOX).select("poly", "p_type")


def predicate_values(s, d):
    """Membership of the raw column: numbers match numbers."""
    rows = read(s, d, "part")
    return rows.filter(matches({"match": [{"col": "p_size", "values": [1, 7, 50]}]}, rows.columns)).select("p_partkey", "p_size")


QUERIES = {
    "layer_selectors": (layers, f"WITH f AS (SELECT {FEATURES} FROM orders) " + " UNION ALL ".join(f"SELECT id, '{n}' AS layer FROM f WHERE {w}" for n, w in _LAYERS.items())),
    "postal_addresses": (addresses, f"""SELECT id FROM (SELECT {ADDRESS.format(text='VARCHAR', q='"')} FROM orders) WHERE trim("addr:housenumber") <> '' AND trim(coalesce("addr:city", '')) <> '' AND trim("addr:postcode") <> ''"""),
    "colour_match": (colours, f"SELECT id FROM (SELECT {COLOURS} FROM events) WHERE abs(r::DOUBLE - 0.5) <= 0.105 AND abs(g::DOUBLE - 0.4) <= 0.105 AND abs(b::DOUBLE - 0.3) <= 0.105"),
    "registry_buckets": (registered, _REGISTERED),
    "zone_sources": (zones, f"WITH {boxes_sql('b')} SELECT 'east' AS key, 'Burgenland' AS province, count(*) AS n FROM b WHERE poly % 11 <> 0 AND poly % 3 = 0 UNION ALL SELECT 'south', 'Steiermark', count(*) FROM supplier"),
    "clipped_layer": (clipped_layer, f"WITH {boxes_sql('b')} SELECT b.poly, p.p_type FROM b JOIN part p ON p.p_partkey = b.poly WHERE p.p_partkey % 11 <> 0 AND p.p_brand LIKE 'Brand#1%' AND b.x <= 5500 AND b.x + b.w >= 1000 AND b.y <= 5800 AND b.y + b.h >= 1000"),
    "predicate_values": (predicate_values, "SELECT p_partkey, p_size FROM part WHERE p_size IN (1, 7, 50)"),
}
