"""Map projections as closed-form column expressions: Gauss-Krueger strips and Lambert conic on Bessel's ellipsoid, web Mercator, datum shift.

Formulas are the series of the transverse Mercator projection and of the Lambert conformal conic with two parallels. Between the strips and the
conic there is no datum shift; WGS 84 takes seven parameters.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Bessel 1841, WGS 84, the projection and the shift from the national datum to WGS 84 (position vector, metres, arc seconds, ppm).
BESSEL_A, BESSEL_F = 6377397.155, 1 / 299.1528128
WGS_A, WGS_F = 6378137.0, 1 / 298.257223563
STRIPS = {"EPSG:31254": 10 + 20 / 60, "EPSG:31255": 13 + 20 / 60, "EPSG:31256": 16 + 20 / 60}
STRIP_NORTHING = -5_000_000.0
CONIC = {"lat1": 49.0, "lat2": 46.0, "lat0": 47.5, "lon0": 13 + 20 / 60, "x0": 400_000.0, "y0": 400_000.0}
SHIFT = (577.326, 90.129, 463.919, 5.137, 1.474, 5.297, 2.4232)


def _poly(x: Column, *terms: float) -> Column:
    out = F.lit(terms[-1])
    for t in reversed(terms[:-1]):
        out = out * x + t
    return out


def strip_to_geographic(x: Column, y: Column, strip: str) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of a Gauss-Krueger point."""
    a, f = BESSEL_A, BESSEL_F
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = (y - STRIP_NORTHING) / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    phi = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu)
    s, c, t = F.sin(phi), F.cos(phi), F.tan(phi)
    n = a / F.sqrt(1 - e2 * s * s)
    r = a * (1 - e2) / F.pow(1 - e2 * s * s, 1.5)
    c1, t1, d = ep2 * c * c, t * t, x / n
    lat = phi - (n * t / r) * (d * d / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1 * c1 - 9 * ep2) * F.pow(d, 4) / 24 + (61 + 90 * t1 + 298 * c1 + 45 * t1 * t1 - 252 * ep2 - 3 * c1 * c1) * F.pow(d, 6) / 720)
    lon = (d - (1 + 2 * t1 + c1) * F.pow(d, 3) / 6 + (5 - 2 * c1 + 28 * t1 - 3 * c1 * c1 + 8 * ep2 + 24 * t1 * t1) * F.pow(d, 5) / 120) / c
    return F.degrees(lon) + STRIPS[strip], F.degrees(lat)


def _conic_constants() -> tuple[float, float, float, float]:
    e = math.sqrt(BESSEL_F * (2 - BESSEL_F))
    m = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    p1, p2, p0 = (math.radians(CONIC[k]) for k in ("lat1", "lat2", "lat0"))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big = m(p1) / (n * t(p1) ** n)
    return e, n, big, BESSEL_A * big * t(p0) ** n


def geographic_to_conic(lon: Column, lat: Column) -> tuple[Column, Column]:
    e, n, big, r0 = _conic_constants()
    p = F.radians(lat)
    t = F.tan(math.pi / 4 - p / 2) / F.pow((1 - e * F.sin(p)) / (1 + e * F.sin(p)), e / 2)
    r, theta = BESSEL_A * big * F.pow(t, n), n * F.radians(lon - CONIC["lon0"])
    return CONIC["x0"] + r * F.sin(theta), CONIC["y0"] + r0 - r * F.cos(theta)


def conic_to_geographic(x: Column, y: Column) -> tuple[Column, Column]:
    e, n, big, r0 = _conic_constants()
    dx, dy = x - CONIC["x0"], r0 - (y - CONIC["y0"])
    t = F.pow(F.hypot(dx, dy) / (BESSEL_A * big), 1 / n)
    p = math.pi / 2 - 2 * F.atan(t)
    for _ in range(5):
        p = math.pi / 2 - 2 * F.atan(t * F.pow((1 - e * F.sin(p)) / (1 + e * F.sin(p)), e / 2))
    return F.degrees(F.atan2(dx, dy) / n) + CONIC["lon0"], F.degrees(p)


def strip_to_conic(x: Column, y: Column, strip: str) -> tuple[Column, Column]:
    return geographic_to_conic(*strip_to_geographic(x, y, strip))


def _shifted(lon: Column, lat: Column, from_: tuple[float, float], to: tuple[float, float], sign: int) -> tuple[Column, Column]:
    a, f = from_
    e2 = f * (2 - f)
    p, l = F.radians(lat), F.radians(lon)
    n = a / F.sqrt(1 - e2 * F.sin(p) * F.sin(p))
    x, y, z = n * F.cos(p) * F.cos(l), n * F.cos(p) * F.sin(l), n * (1 - e2) * F.sin(p)
    tx, ty, tz = (sign * v for v in SHIFT[:3])
    rx, ry, rz = (sign * math.radians(v / 3600) for v in SHIFT[3:6])
    k = 1 + sign * SHIFT[6] * 1e-6
    x, y, z = tx + k * (x - rz * y + ry * z), ty + k * (rz * x + y - rx * z), tz + k * (-ry * x + rx * y + z)
    a, f = to
    e2 = f * (2 - f)
    flat = F.hypot(x, y)
    theta = F.atan2(z, flat * (1 - f))
    p = F.atan2(z + e2 / (1 - e2) * a * (1 - f) * F.pow(F.sin(theta), 3), flat - e2 * a * F.pow(F.cos(theta), 3))
    return F.degrees(F.atan2(y, x)), F.degrees(p)


def national_to_wgs84(lon: Column, lat: Column) -> tuple[Column, Column]:
    return _shifted(lon, lat, (BESSEL_A, BESSEL_F), (WGS_A, WGS_F), 1)


def wgs84_to_national(lon: Column, lat: Column) -> tuple[Column, Column]:
    return _shifted(lon, lat, (WGS_A, WGS_F), (BESSEL_A, BESSEL_F), -1)


def mercator_x(lon: Column) -> Column:
    return WGS_A * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    return WGS_A * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))


def strip_by_mean(mean_x: Column) -> Column:
    """The strip of a raw drawing, from its mean easting."""
    return F.when(mean_x > 75_000, "EPSG:31254").otherwise("EPSG:31256")


def check_points(spark: SparkSession):
    """A lattice of conic points, there and back: (x, y, dx, dy) with the differences in metres."""
    p = spark.range(400).select((F.col("id") % 20 * 30_000 + 120_000).cast("double").alias("x"), (F.floor(F.col("id") / 20) * 15_000 + 270_000).cast("double").alias("y"))
    lon, lat = conic_to_geographic(F.col("x"), F.col("y"))
    p = p.withColumns({"lon": lon, "lat": lat})
    x, y = geographic_to_conic(F.col("lon"), F.col("lat"))
    return p.select("x", "y", F.round(x - F.col("x"), 6).alias("dx"), F.round(y - F.col("y"), 6).alias("dy"))
