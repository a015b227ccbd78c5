"""Comparison of two products band by band, traffic lights, and the register of accepted deviations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.functions.scalars import light
from cellplane.operators import labels, runs

# The register's columns, and its causes.
COLUMNS = ("paket", "band_nr", "band_name", "pixel_abs", "anteil_prozent", "groesste_flaeche_ha", "schwerpunkt_bundesland", "ampel", "ursache")
TODO = "TODO: von Hand eintragen"
# The register must read like the files that exist, so this message is a fixed value too.
UNEXPECTED = "FEHLER: in keinem *_wirkungspfad des Manifests - verstoesst gegen PLAN.md Paragraph 13.9, vor Fortsetzung klaeren"
NO_COUNTERPART = "kein Gegenstueck in run1 (neues Band seit Schema 2.2.0/W7.1)"
ACCEPTED = "angenommen"


def band_diff(new: DataFrame, old: DataFrame, zones: DataFrame, grid: GridSpec) -> DataFrame:
    """One row for two masks: differing cells, set cells of the old, shares, largest 4-connected difference in ha, area in km2, zone with most of it.

    The share's base is the old mask (infinite if it is empty). Cells in no zone do not vote; ties go to the least zone.
    """
    diff = runs.xor(new, old)
    n = lambda df, name: df.agg(F.coalesce(runs.n_cells(df), F.lit(0).cast("long")).alias(name))
    largest = labels.sizes(labels.components(diff, grid, 4)).agg(F.coalesce(F.max("cells"), F.lit(0)).alias("largest"))
    cells = runs.to_cells(diff)
    spots = zones.select("zone", "row", F.explode(F.sequence("c0", "c1")).alias("col"))
    where = cells.join(spots, ["row", "col"]).groupBy("zone").agg(F.count("*").alias("n")).agg(F.max_by("zone", F.struct("n", -F.col("zone"))).alias("zone"))
    row = n(diff, "pixel_abs").crossJoin(n(old, "reference_cells")).crossJoin(largest).crossJoin(where)
    ha = grid.cell_m**2 / 10_000
    share = F.when(F.col("pixel_abs") == 0, 0.0).when(F.col("reference_cells") == 0, F.lit(float("inf"))).otherwise(100.0 * F.col("pixel_abs") / F.col("reference_cells"))
    return row.select("pixel_abs", "reference_cells", share.alias("share_percent"), (100.0 * F.col("pixel_abs") / (grid.width * grid.height)).alias("grid_percent"), (F.col("largest") * ha).alias("largest_ha"), (F.col("pixel_abs") * ha / 100).alias("km2"), "zone")


def classified(results: DataFrame, allowed: DataFrame) -> DataFrame:
    """results (band_name, role, pixel_abs, anteil_prozent, groesste_flaeche_ha, flaeche_km2, ohne_gegenstueck, ...) with ampel and unerwartet. allowed: (band_name)."""
    known = allowed.select("band_name").distinct().withColumn("__ok", F.lit(True))
    df = results.join(known, "band_name", "left")
    own, same = F.col("ohne_gegenstueck"), F.col("pixel_abs") == 0
    odd = ~own & ~same & F.col("__ok").isNull()
    found = light(F.col("role"), F.col("anteil_prozent"), F.col("groesste_flaeche_ha"), F.col("flaeche_km2"))
    return df.select(*results.columns, F.when(own, "ohne_gegenstueck").when(same, "bitgleich").when(odd, "rot").otherwise(found).alias("ampel"), odd.alias("unerwartet"))


def upserted(register: DataFrame, package: str, results: DataFrame, allowed: DataFrame) -> DataFrame:
    """The register with this package's rows rebuilt from results; other packages stay, causes written by hand stay, accepted reds are named so."""
    rows = classified(results.filter((F.col("pixel_abs") > 0) | F.col("ohne_gegenstueck")), allowed)
    prior = register.filter(F.col("paket") == package).select(F.col("band_name").alias("__b"), F.col("ursache").alias("__u"))
    rows = rows.join(prior, F.col("band_name") == F.col("__b"), "left")
    accepted = F.coalesce(F.lower("__u").contains(ACCEPTED), F.lit(False)) & ~F.col("unerwartet") & (F.col("ampel") == "rot")
    by_hand = F.col("__u").isNotNull() & (F.col("__u") != "") & ~F.col("__u").isin(TODO, UNEXPECTED)
    cause = F.when(F.col("unerwartet"), UNEXPECTED).when(by_hand, F.col("__u")).when(F.col("ohne_gegenstueck"), NO_COUNTERPART).otherwise(TODO)
    new = rows.select(F.lit(package).alias("paket"), F.col("band_nr").cast("string").alias("band_nr"), "band_name", F.col("pixel_abs").cast("string").alias("pixel_abs"), F.format_string("%.4f", "anteil_prozent").alias("anteil_prozent"),
                      F.format_string("%.4f", "groesste_flaeche_ha").alias("groesste_flaeche_ha"), "schwerpunkt_bundesland", F.when(accepted, "akzeptiert").otherwise(F.col("ampel")).alias("ampel"), cause.alias("ursache"))
    return register.filter(F.col("paket") != package).select(*COLUMNS).unionByName(new).orderBy("paket", F.col("band_nr").cast("int"))


def aligned(new: DataFrame, reference: DataFrame) -> DataFrame:
    """(nr, name, ref_nr): the counterpart of every new band (nr, name), null without one.

    By name if all names of both sides are there and the reference's are unique, else by number.
    """
    blank = F.count_if(F.coalesce(F.col("name"), F.lit("")) == "").alias("blank")
    sides = new.agg(blank).select((F.col("blank") == 0).alias("a")).crossJoin(
        reference.agg(blank, F.count("*").alias("n"), F.countDistinct("name").alias("names")).select(((F.col("blank") == 0) & (F.col("n") == F.col("names"))).alias("b"))
    )  # one row
    usable = sides.select((F.col("a") & F.col("b")).alias("by_name"))
    key = lambda: F.when(F.col("by_name"), F.col("name")).otherwise(F.concat(F.lit("#"), F.col("nr").cast("string")))
    left = new.crossJoin(F.broadcast(usable)).select("nr", "name", key().alias("key"))
    right = reference.crossJoin(F.broadcast(usable)).select(F.col("nr").alias("ref_nr"), key().alias("key"))
    return left.join(right, "key", "left").select("nr", "name", "ref_nr")


def same_grid(new: GridSpec, reference: GridSpec) -> None:
    """Raises where two products do not share a grid."""
    wrong = [f for f in ("width", "height", "cell_m", "x0", "y_top", "crs") if getattr(new, f) != getattr(reference, f)]
    if wrong:
        raise ValueError("grids differ: " + ", ".join(f"{f} {getattr(new, f)} against {getattr(reference, f)}" for f in wrong))


def allowed_bands(manifests: DataFrame, doc: str, suffix: str = "_wirkungspfad") -> DataFrame:
    """(band_name) of all lists under keys of the suffix, whatever their other name. Members that are no lists of texts are passed over."""
    members = F.from_json(F.col(doc), "map<string,string>")
    lists = F.map_values(F.map_filter(members, lambda k, _: k.endswith(suffix)))
    return manifests.select(F.explode(lists).alias("list")).select(F.explode(F.from_json("list", "array<string>")).alias("band_name")).distinct()


def outcome(classified_rows: DataFrame, same_hash: bool = False) -> int:
    """Exit code of a validation: 0 for equal hashes or where nothing unexpected differs, else 1."""
    return 0 if same_hash or not classified_rows.filter("unerwartet").head(1) else 1
