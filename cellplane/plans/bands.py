"""The bands of the product: names in file order, roles, buffers, sources and what each is derived from; impact paths and checks over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellplane.plans import manifest_values as V

# Band names in file order.
BANDS = (
    "official_settlement_source", "settlement_buffer", "haeuser_im_gruenen_ferienhaus", "haeuser_im_gruenen_widmung", "haeuser_im_gruenen_streusiedlung", "haeuser_im_gruenen_noe_pdf", "haeuser_im_gruenen",
    "nonresidential_hulls_source", "nonresidential_hulls_buffer", "cableway_buildings_source", "cableway_buildings_buffer", "general_buildings_source", "general_buildings_buffer", "road_motorway_trunk",
    "road_federal_state", "rail_main", "cableway_people_150m", "military_restricted_area", "airport_area_major", "airport_runway_corridor_5km", "nature_protection_areas", "osm_nature_protection_areas",
    "geography_slope_too_steep", "geography_elevation_too_high", "geography_wind_too_low", "geography_water_bodies", "exclusion_human", "exclusion_nature", "exclusion_geography", "all_exclusions",
    "available_after_all_exclusions_raw", "available_cleaned_min_10ha", "available_blur_sigma_100m", "available_blur_sigma_200m", "available_blur_sigma_250m", "available_blur_sigma_300m",
    "official_wind_zoning", "wka_bestand_ausserhalb_zonen", "haeuser_im_gruenen_source", "general_buildings_roh_osm", "general_buildings_roh_dkm", "sources_human", "sources_nature", "sources_geography",
)
# Groups of bands.
HIG = ("haeuser_im_gruenen_ferienhaus", "haeuser_im_gruenen_widmung", "haeuser_im_gruenen_streusiedlung")
HUMAN = ("settlement_buffer", "haeuser_im_gruenen", "nonresidential_hulls_buffer", "cableway_buildings_buffer", "general_buildings_buffer", "road_motorway_trunk", "road_federal_state", "rail_main", "cableway_people_150m", "military_restricted_area", "airport_area_major", "airport_runway_corridor_5km")
NATURE = ("nature_protection_areas", "osm_nature_protection_areas")
GEOGRAPHY = ("geography_slope_too_steep", "geography_elevation_too_high", "geography_wind_too_low", "geography_water_bodies")
# What a band is derived from.
DERIVED = {
    "settlement_buffer": ("official_settlement_source",),
    "haeuser_im_gruenen": (*HIG, "haeuser_im_gruenen_noe_pdf"),
    "nonresidential_hulls_buffer": ("nonresidential_hulls_source",),
    "cableway_buildings_buffer": ("cableway_buildings_source",),
    "general_buildings_buffer": ("general_buildings_source",),
    "exclusion_human": HUMAN,
    "exclusion_nature": NATURE,
    "exclusion_geography": GEOGRAPHY,
    "all_exclusions": ("exclusion_human", "exclusion_nature", "exclusion_geography"),
    "available_after_all_exclusions_raw": ("all_exclusions",),
    "wka_bestand_ausserhalb_zonen": ("official_wind_zoning",),
    "haeuser_im_gruenen_source": HIG,
    "sources_human": ("official_settlement_source", *HIG, "haeuser_im_gruenen_noe_pdf", "nonresidential_hulls_source", "cableway_buildings_source", "general_buildings_source", "military_restricted_area", "airport_area_major"),
    "sources_nature": NATURE,
    "sources_geography": GEOGRAPHY,
}
RAW = "available_after_all_exclusions_raw"
# Raw data that a band reads.
ZONING = ("flaechenwidmung_bgld", "flaechenwidmung_ktn", "flaechenwidmung_noe", "flaechenwidmung_ooe", "flaechenwidmung_sbg", "flaechenwidmung_stmk", "flaechenwidmung_tirol", "flaechenwidmung_vbg", "flaechenwidmung_wien")
ADMIN, REGISTER, CADASTRE, OSM = "verwaltungsgrenzen_vgd", "bev_adressregister", "dkm_geoparquet", "osm_pbf"
SOURCES = {
    "official_settlement_source": ZONING, "settlement_buffer": (ADMIN,), "haeuser_im_gruenen_ferienhaus": ZONING, "haeuser_im_gruenen_widmung": (*ZONING, ADMIN),
    "haeuser_im_gruenen_streusiedlung": (REGISTER, CADASTRE, ADMIN), "haeuser_im_gruenen_noe_pdf": ("noe_sekrop_mindestabstandszonen",), "nonresidential_hulls_source": (CADASTRE, OSM),
    "cableway_buildings_source": (OSM, CADASTRE), "general_buildings_source": (OSM, CADASTRE, REGISTER), "road_motorway_trunk": (OSM,), "road_federal_state": (OSM,), "rail_main": (OSM,), "cableway_people_150m": (OSM,),
    "military_restricted_area": (OSM,), "airport_area_major": (OSM,), "airport_runway_corridor_5km": (OSM,), "nature_protection_areas": ("naturschutzgebiete",), "osm_nature_protection_areas": (OSM,),
    "geography_slope_too_steep": ("dgm_25m",), "geography_elevation_too_high": ("dgm_25m",), "geography_wind_too_low": ("wind_leistungsdichte_150m",), "geography_water_bodies": (OSM,),
    "official_wind_zoning": ("amtliche_windzonen_noe", "amtliche_windzonen_bgld", "amtliche_windzonen_ktn", "amtliche_windzonen_stmk", "amtliche_windzonen_sbg", ADMIN), "wka_bestand_ausserhalb_zonen": (OSM,),
    "general_buildings_roh_osm": (OSM,), "general_buildings_roh_dkm": (CADASTRE, REGISTER),
}
# Buffers in metres where one value holds everywhere.
BUFFERS = {"haeuser_im_gruenen": 750.0, "nonresidential_hulls_buffer": 25.0, "cableway_buildings_buffer": 50.0, "general_buildings_buffer": 25.0, "road_motorway_trunk": 150.0, "road_federal_state": 150.0, "rail_main": 150.0, "cableway_people_150m": 150.0}
CABLEWAY_ROOTS = ("cableway_buildings_source", "general_buildings_source", "general_buildings_roh_osm", "cableway_people_150m")
# Panel sections and the prefixes that sort a band into them, in the order of the tests.
TOTALS = {"exclusion_human": "Mensch", "tot_exclusion_human": "Mensch", "exclusion_nature": "Natur", "tot_exclusion_nature": "Natur", "exclusion_geography": "Geografie", "tot_exclusion_geography": "Geografie", "all_exclusions": "Total & Ergebnis", "tot_exclusion_all": "Total & Ergebnis", "sources_human": "Mensch", "sources_nature": "Natur", "sources_geography": "Geografie"}
# Endings of the bands of a distance variant.
VARIANTS = ("_default", "_800m", "_1000m", "_1200m", "_1500m", "_2000m")
SECTIONS = (
    ("Mensch", ("settlement_", "greenland_", "haeuser_im_gruenen", "important_objects_", "cableway_buildings_", "general_buildings_", "power_", "road_", "rail_", "cableway_", "military_", "airport_", "human_", "official_settlement_", "official_hig_", "ferienhaus_", "hig_hulls_", "noe_pdf_", "bewohnt_", "nonresidential_")),
    ("Natur", ("nature_", "osm_nature_")),
    ("Geografie", ("geography_", "geo_")),
    ("Total & Ergebnis", ("available_", "cleaned_")),
    ("Referenz (Zonen & WKA-Bestand)", ("official_", "wka_")),
)


def role(name: Column) -> Column:
    starts = name.startswith
    return (
        F.when(name.isin("exclusion_human", "exclusion_nature", "exclusion_geography", "sources_human", "sources_nature", "sources_geography"), "aggregat_kategorie").when(name == "all_exclusions", "aggregat_gesamt")
        .when(name == RAW, "verfuegbarkeit_roh").when(starts("available_cleaned_min_"), "verfuegbarkeit_bereinigt").when(starts("available_blur_sigma_"), "unschaerfe")
        .when(name.isin("official_wind_zoning", "wka_bestand_ausserhalb_zonen"), "referenz").otherwise("bedingung")
    )


def section(name: Column) -> Column:
    out = F.lit("Sonstige")
    for title, prefixes in reversed(SECTIONS):
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | name.startswith(p)
        out = F.when(hit, title).otherwise(out)
    for v in VARIANTS:
        out = F.when(name.endswith(v), "Siedlungsabstand-Varianten").otherwise(out)
    for n, title in TOTALS.items():
        out = F.when(name == n, title).otherwise(out)
    return out


def catalogue(spark: SparkSession, names=BANDS) -> DataFrame:
    """(nr, band, role, section, total, buffer_m) of the bands."""
    df = spark.createDataFrame([(i + 1, n, BUFFERS.get(n)) for i, n in enumerate(names)], "nr int, band string, buffer_m double")
    return df.select("nr", "band", role(F.col("band")).alias("role"), section(F.col("band")).alias("section"), F.col("band").isin(*TOTALS).alias("total"), "buffer_m")


def derived_edges(spark: SparkSession, names=BANDS) -> DataFrame:
    """(src, dst): dst is computed from src."""
    pairs = [(s, d) for d, srcs in DERIVED.items() for s in srcs]
    pairs += [(RAW, n) for n in names if n.startswith(("available_cleaned_min_", "available_blur_sigma_"))]
    return spark.createDataFrame([p for p in pairs if p[1] in names], "src string, dst string")


def source_edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, b) for b, keys in SOURCES.items() for k in keys], "source string, band string")


def impact(edges: DataFrame, roots: DataFrame, cut) -> DataFrame:
    """All nodes (band) that the roots reach along edges (src, dst), the roots among them. cut writes a table and reads it again."""
    reached = cut(roots.select("band").distinct())
    frontier = reached
    while frontier.head(1):
        step = edges.join(frontier, F.col("src") == F.col("band"), "left_semi").select(F.col("dst").alias("band")).distinct()
        frontier = cut(step.join(reached, "band", "left_anti"))
        reached = cut(reached.unionByName(frontier))
    return reached


# Bands that a caveat names, by whole name or by the start of it.
CAVEATS = {
    "noe_dkm": (
        ("nonresidential_hulls_source", "nonresidential_hulls_buffer", "general_buildings_source", "general_buildings_buffer", "exclusion_human", "all_exclusions", "available_after_all_exclusions_raw", "general_buildings_roh_dkm"),
        ("exclusion_human_", "all_exclusions_", "available_after_all_exclusions_raw_", "available_cleaned_min_", "available_blur_sigma_"),
    ),
    "blur_bleed": ((), ("available_blur_sigma_",)),
    "tunnelfilter": (("road_motorway_trunk", "road_federal_state", "rail_main", "exclusion_human", "all_exclusions", "available_after_all_exclusions_raw", "available_cleaned_min_10ha"), ()),
}
# Bands that are cut to the country, by whole name or by the start of it; the prefix of bands in percent.
CLIPPED = (
    ("exclusion_human", "exclusion_nature", "exclusion_geography", "all_exclusions", "available_after_all_exclusions_raw"),
    ("exclusion_human_", "exclusion_nature_", "exclusion_geography_", "all_exclusions_", "available_after_all_exclusions_raw_", "available_cleaned_min_", "available_blur_sigma_"),
)
PERCENT_PREFIX = "available_blur_sigma_"


def named(name: Column, names: tuple[str, ...], prefixes: tuple[str, ...]) -> Column:
    """Whether a band is one of the names or starts with one of the prefixes."""
    out = name.isin(*names) if names else F.lit(False)
    for p in prefixes:
        out = out | name.startswith(p)
    return out


def value_type(name: Column) -> Column:
    return F.when(name.startswith(PERCENT_PREFIX), "percent_0_100").otherwise("binary")


def caveat_bands(spark: SparkSession, names=BANDS) -> DataFrame:
    """(band, nr, value_type, clipped, caveats): the caveats that touch a band, in order, joined by commas."""
    rows = catalogue(spark, names)
    touched = F.array(*[F.when(named(F.col("band"), *of), F.lit(c)) for c, of in CAVEATS.items()])
    return rows.select("band", "nr", value_type(F.col("band")).alias("value_type"), named(F.col("band"), *CLIPPED).alias("clipped"), F.array_join(F.filter(touched, lambda c: c.isNotNull()), ",").alias("caveats"))


def entries(spark: SparkSession, names=BANDS) -> DataFrame:
    """(nr, band, label, familie, stufe, dashboard_layer, default_visible): what the manifest states of each band. Unknown names label themselves."""
    known = spark.createDataFrame(list(V.BANDS), "band string, l string, f string, s string")
    name = F.col("band")
    tail = F.element_at(F.split(name, "_"), -1)
    strength = F.concat(F.lit(f"{V.BLUR_LABEL} "), F.element_at(F.create_map(*[F.lit(x) for pair in V.STRENGTH.items() for x in pair]), tail))
    result = name.startswith(V.CLEANED) | name.startswith(V.BLUR)
    label = F.coalesce("l", F.when(name.startswith(V.CLEANED), V.CLEANED_LABEL).when(name.startswith(V.BLUR), strength), name)
    ends = lambda c: F.coalesce(F.col(c), F.when(result, "ergebnis"))
    rows = catalogue(spark, names).join(known, "band", "left")
    return rows.select("nr", "band", label.alias("label"), ends("f").alias("familie"), ends("s").alias("stufe"), name.isin(*V.PANEL).alias("dashboard_layer"), name.isin(*V.VISIBLE).alias("default_visible"))


ENTRIES_SQL = (
    f"WITH b AS (SELECT * FROM (VALUES {', '.join(f"('{b}', {i + 1})" for i, b in enumerate(BANDS))}) t(band, nr)), k AS (SELECT * FROM (VALUES {', '.join(str(e) for e in V.BANDS)}) t(band, l, f, s)), "
    f"w AS (SELECT * FROM (VALUES {', '.join(str(e) for e in V.STRENGTH.items())}) t(tail, word)) "
    f"SELECT b.nr::INTEGER AS nr, b.band, coalesce(k.l, CASE WHEN starts_with(b.band, '{V.CLEANED}') THEN '{V.CLEANED_LABEL}' WHEN starts_with(b.band, '{V.BLUR}') THEN '{V.BLUR_LABEL} ' || w.word END, b.band) AS label, "
    f"coalesce(k.f, 'ergebnis') AS familie, coalesce(k.s, 'ergebnis') AS stufe, b.band IN {V.PANEL} AS dashboard_layer, b.band IN {V.VISIBLE} AS default_visible "
    "FROM b LEFT JOIN k ON k.band = b.band LEFT JOIN w ON ends_with(b.band, '_' || w.tail) AND starts_with(b.band, 'available_blur')"
)


def _named_sql(names: tuple[str, ...], prefixes: tuple[str, ...]) -> str:
    tests = [f"band = '{n}'" for n in names] + [f"starts_with(band, '{p}')" for p in prefixes]
    return "(" + " OR ".join(tests) + ")"


CAVEATS_SQL = (
    "SELECT band, nr::INTEGER AS nr, CASE WHEN starts_with(band, 'available_blur_sigma_') THEN 'percent_0_100' ELSE 'binary' END AS value_type, "
    f"{_named_sql(*CLIPPED)} AS clipped, concat_ws(',', {', '.join(f"CASE WHEN {_named_sql(*of)} THEN '{c}' END" for c, of in CAVEATS.items())}) AS caveats "
    f"FROM (VALUES {', '.join(f"('{b}', {i + 1})" for i, b in enumerate(BANDS))}) t(band, nr)"
)
