"""Scalar rules over attributes, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Land-use codes and category prefixes, units, umlauts, provinces, register codes.
BUILDING_CODES, GARDEN_CODES = ("41", "66"), ("52", "71")
BUILDING_PREFIXES, GARDEN_PREFIXES = ("baufläche", "bauflaeche"), ("garten",)
UNIT_KW = {"w": 0.001, "kw": 1.0, "mw": 1000.0, "gw": 1_000_000.0}
UMLAUTS = {"ä": "ae", "ö": "oe", "ü": "ue", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue", "ß": "ss"}
PROVINCES = ("Burgenland", "Kärnten", "Niederösterreich", "Oberösterreich", "Salzburg", "Steiermark", "Tirol", "Vorarlberg", "Wien")
RESIDENTIAL_CODES, INDUSTRIAL_CODES = ("01", "02", "03"), ("08",)
NO_TUNNEL = ("", "no", "false", "0")


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def none_if_blank(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def str_value(c: Column) -> Column:
    """A double as text; whole numbers without a fraction; NaN is null."""
    return F.when(F.isnan(c), F.lit(None)).when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))


def _code(stripped: Column) -> Column:
    number = stripped.try_cast("double")
    return F.when(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < 9e18), number.cast("long").cast("string")).otherwise(stripped)


def normal_code(c: Column) -> Column:
    """A land-use code without blanks, a leading FIG (any case), zeros in front and fractions; null if blank."""
    bare = F.trim(c.cast("string"))
    return F.when(bare != "", _code(F.when(F.upper(bare).startswith("FIG"), F.substring(bare, 4, 1_000_000)).otherwise(bare)))


def land_use_kind(code: Column, category: Column) -> Column:
    """building, garden or null, by code or by the start of the category."""
    known = _code(F.regexp_replace(F.upper(F.trim(text(code))), "^FIG", ""))
    cat = F.lower(F.trim(text(category)))
    starts = lambda prefixes: F.lit(False) if not prefixes else _any([cat.startswith(p) for p in prefixes])
    return F.when(known.isin(*BUILDING_CODES) | starts(BUILDING_PREFIXES), "building").when(known.isin(*GARDEN_CODES) | starts(GARDEN_PREFIXES), "garden")


def _any(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out | c
    return out


def category_base(c: Column) -> Column:
    """Without "(historisch)"; blank is Unbekannt."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(text(c), r"\s*\(historisch\)\s*", " ")), F.lit("")), F.lit("Unbekannt"))


def not_tunnel(c: Column) -> Column:
    return F.trim(F.lower(text(c))).isin(*NO_TUNNEL)


def voltages_kv(c: Column) -> Column:
    """Distinct whole kilovolts of a list by ; or , of volts; values below 1000 are none."""
    volts = F.transform(F.split(F.replace(text(c), F.lit(","), F.lit(";")), ";"), lambda v: F.trim(v).try_cast("double"))
    return F.array_sort(F.array_distinct(F.transform(F.filter(volts, lambda v: v >= 1000), lambda v: F.rint(v / 1000).cast("int"))))


def power_kw(c: Column) -> Column:
    """"2 MW", "1500 kW", "0,5 gw" in kilowatts; no unit is watts; anything else is null."""
    pattern = r"^\s*([0-9]+(?:[.,][0-9]+)?)\s*([a-zA-Z]*)\s*$"
    unit = F.lower(F.regexp_extract(c, pattern, 2))
    factor = F.create_map(*[F.lit(x) for pair in UNIT_KW.items() for x in pair])
    number = F.replace(F.regexp_extract(c, pattern, 1), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(c.rlike(pattern), number * F.try_element_at(factor, F.when(unit == "", F.lit("w")).otherwise(unit)))


def transliterated(c: Column) -> Column:
    for one, two in UMLAUTS.items():
        c = F.replace(c, F.lit(one), F.lit(two))
    return c


def display_province(c: Column) -> Column:
    """The name with umlauts of a transliterated province, else the value itself."""
    plain = lambda name: "".join(UMLAUTS.get(x, x) for x in name)
    names = F.create_map(*[F.lit(x) for p in PROVINCES for x in (plain(p), p)])
    return F.coalesce(F.try_element_at(names, c), c)


def number_or_null(c: Column) -> Column:
    """A coordinate as text; "#" and other non-numbers are null."""
    return F.trim(c).try_cast("double")


def share(part: Column, whole: Column, empty: float | None = None) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(empty).cast("double"))


def hull_class(n_address: Column, n_garden: Column, n_register: Column, n_homes: Column, zoning_share: Column, least_homes: float = 0.1, least_zoning: float = 0.5) -> Column:
    """Register evidence beats zoning: without enough homes a hull is industrial, with enough it never is."""
    homes = F.coalesce(n_homes.cast("double") / F.nullif(n_register, F.lit(0)), F.lit(0.0))
    seen = n_register > 0
    industrial = (seen & (homes < least_homes)) | ((zoning_share >= least_zoning) & ~(seen & (homes >= least_homes)))
    return F.when(industrial, "industrie").when((n_address > 0) | (n_garden > 0), "bewohnt").otherwise("unbewohnt")


# The names of the reasons are fixed values.
def residual_reason(unassigned: Column, gap: Column, outside: Column, classified: Column) -> Column:
    """The first share of half or more names the reason."""
    return (
        F.when(unassigned >= 0.5, "polygon_exists_without_ns_symbol").when(gap >= 0.5, "inside_dxf_bounds_but_no_polygon")
        .when(outside >= 0.5, "inside_noe_but_outside_current_dkm_coverage").when(classified >= 0.5, "classified_in_diagnostics_but_white_in_final")
        .when(unassigned + gap >= 0.5, "mixed_unassigned_and_no_polygon").otherwise("mixed_or_boundary_raster_effect")
    )


def light(role: Column, share_percent: Column, largest_ha: Column, km2: Column) -> Column:
    """Green, yellow or red by role: conditions need share and area, references are always red, all others have an area budget."""
    condition = F.when((share_percent <= 0.01) & (largest_ha <= 1.0), "gruen").when((share_percent <= 0.1) & (largest_ha <= 25.0), "gelb").otherwise("rot")
    budget = F.when(km2 <= 1.0, "gruen").when(km2 <= 10.0, "gelb").otherwise("rot")
    return F.when(role == "bedingung", condition).when(role == "referenz", "rot").otherwise(budget)
