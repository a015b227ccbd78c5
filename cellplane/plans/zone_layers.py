"""Zones as layers to hand out: dissolved by a key, clipped to a region, simplified with neighbours staying joined, written in the national system and in WGS84."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellplane.functions.projection import conic_to_geographic, national_to_wgs84
from cellplane.operators import coverage, overlay, rings
from cellplane.sources.files import write_geojson_seq

TOLERANCE = 8.0


def prepared(zones: DataFrame, region: DataFrame, by: str, tolerance: float = TOLERANCE) -> DataFrame:
    """(by, rings, area_m2, area_ha) of zones (by, rings), united by the key and cut to the region (rings); a key whose zones lie apart comes in several rows.

    by: a whole number or text; nulls are no zone. The region is taken once for each key, so keys are to be few beside shapes. Uniting and cutting are one overlay.
    """
    zones = zones.filter(F.col(by).isNotNull()).select(by, "rings")
    whole = zones.select(by).distinct().crossJoin(F.broadcast(region.select("rings")) if region.count() == 1 else region.select("rings"))
    cut = rings.nested(rings.stitched(overlay.combined(zones, whole, by), by), by)
    parts = overlay.materialise(cut.select(by, "rings").withColumn("id", F.monotonically_increasing_id()), "zone-parts")
    thin = coverage.simplified(parts, tolerance).filter("area > 0")
    return thin.join(parts.select("id", by), "id").select(by, "rings", F.col("area").alias("area_m2"), F.round(F.col("area") / 1e4, 2).alias("area_ha"))


def in_wgs84(shapes: Column) -> Column:
    """Rings of the national conic system as longitudes and latitudes of WGS84."""

    def moved(p: Column) -> Column:
        lon, lat = national_to_wgs84(*conic_to_geographic(p["x"], p["y"]))
        return F.struct(lon.alias("x"), lat.alias("y"))

    return F.transform(shapes, lambda r: F.transform(r, moved))


def write_twins(layer: DataFrame, path: str) -> tuple[str, str]:
    """Writes a layer (rings and attributes) as GeoJSON features below path, and its twin in WGS84 below path_wgs84; both paths."""
    attrs = F.struct(*[c for c in layer.columns if c != "rings"])
    twin = f"{path}_wgs84"
    for shapes, to in ((F.col("rings"), path), (in_wgs84(F.col("rings")), twin)):
        write_geojson_seq(layer.select(attrs.alias("attrs"), F.lit("polygon").alias("kind"), shapes.alias("rings")), to)
    return path, twin
