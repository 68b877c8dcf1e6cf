"""Geodetic and angular column expressions. Units: degrees and metres."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: WGS-84
A, FLATTENING = 6378137.0, 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)


def ecef(lat: Column, lon: Column, alt: Column) -> tuple[Column, Column, Column]:
    la, lo = F.radians(lat), F.radians(lon)
    n = F.lit(A) / F.sqrt(1 - E2 * F.sin(la) * F.sin(la))
    return (n + alt) * F.cos(la) * F.cos(lo), (n + alt) * F.cos(la) * F.sin(lo), (n * (1 - E2) + alt) * F.sin(la)


def enu(lat: Column, lon: Column, alt: Column, lat0: Column, lon0: Column, alt0: Column) -> tuple[Column, Column, Column]:
    """East, north and up of a position seen from an origin."""
    x, y, z = (a - b for a, b in zip(ecef(lat, lon, alt), ecef(lat0, lon0, alt0)))
    la, lo = F.radians(lat0), F.radians(lon0)
    east = -F.sin(lo) * x + F.cos(lo) * y
    north = -F.sin(la) * F.cos(lo) * x - F.sin(la) * F.sin(lo) * y + F.cos(la) * z
    up = F.cos(la) * F.cos(lo) * x + F.cos(la) * F.sin(lo) * y + F.sin(la) * z
    return east, north, up


def with_geodetic(rows: DataFrame, x: Column, y: Column, z: Column, rounds: int = 6) -> DataFrame:
    """Adds lat, lon and alt of an earth-centred position, by a fixed number of fixed-point steps.

    Each step is a column of its own, so that the expression doesn't double with every step.
    """
    rows = rows.withColumns({"__z": z, "__flat": F.hypot(x, y), "__lon": F.degrees(F.atan2(y, x))}).withColumn("__lat", F.atan2(F.col("__z"), F.col("__flat") * (1 - E2)))
    n = F.lit(A) / F.sqrt(1 - E2 * F.pow(F.sin("__lat"), F.lit(2)))
    for _ in range(rounds):
        rows = rows.withColumn("__n", n).withColumn("__lat", F.atan2(F.col("__z") + E2 * F.col("__n") * F.sin("__lat"), F.col("__flat")))
    return rows.withColumns({"lat": F.degrees("__lat"), "lon": F.col("__lon"), "alt": F.col("__flat") / F.cos("__lat") - n}).drop("__z", "__flat", "__lon", "__lat", "__n")


def heading(east: Column, north: Column) -> Column:
    """Compass direction in [0, 360)."""
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def turn(before: Column, after: Column) -> Column:
    """Signed change of heading in [-180, 180)."""
    return F.pmod(after - before + 180.0, F.lit(360.0)) - 180.0


def quaternion_angles(w: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Yaw, pitch and roll in degrees; the sine of pitch is clipped."""
    yaw = F.degrees(F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z)))
    pitch = F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * (w * y - z * x)))))
    roll = F.degrees(F.atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y)))
    return yaw, pitch, roll


def from_dms(degrees: Column, minutes: Column, seconds: Column, hemisphere: Column) -> Column:
    value = degrees + minutes / 60.0 + seconds / 3600.0
    return F.when(F.upper(hemisphere).isin("S", "W"), -value).otherwise(value)


def utm_epsg(line: Column) -> Column:
    """EPSG code from text such as "WGS84 UTM 32N"; null where there is none."""
    zone = F.nullif(F.regexp_extract(line, r"WGS84 UTM (\d+)([NS])", 1), F.lit("")).cast("int")
    return zone + F.when(F.regexp_extract(line, r"WGS84 UTM (\d+)([NS])", 2) == "S", 32700).otherwise(32600)


def human_size(size: Column) -> Column:
    """Bytes as text: B without decimals, KB and MB with one, GB with two; ties go to the even digit."""
    return (
        F.when(size < 1024, F.format_string("%d B", size.cast("long")))
        .when(size < 1024**2, F.format_string("%.1f KB", F.bround(size / 1024.0, 1)))
        .when(size < 1024**3, F.format_string("%.1f MB", F.bround(size / 1024.0**2, 1)))
        .otherwise(F.format_string("%.2f GB", F.bround(size / 1024.0**3, 2)))
    )


def horizontal_accuracy(h: Column) -> Column:
    return F.greatest(F.lit(0.02), F.least(F.lit(50.0), F.coalesce(F.nanvl(h, F.lit(None)), F.lit(3.0))))


def vertical_accuracy(v: Column, h: Column) -> Column:
    return F.greatest(F.lit(0.03), F.least(F.lit(75.0), F.coalesce(F.nanvl(v, F.lit(None)), 1.5 * horizontal_accuracy(h))))


def _series() -> tuple[float, list[float], list[float], list[float]]:
    """(radius of the rectifying sphere, and Krüger's series forward, back, and for latitudes) to the third order of the third flattening."""
    n = FLATTENING / (2 - FLATTENING)
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    back = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    latitude = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    return radius, forward, back, latitude


# fixed values: scale on the central meridian, false easting, false northing of the southern half
UTM_SCALE, UTM_EAST, UTM_SOUTH = 0.9996, 500000.0, 10000000.0


def utm_zone(lon: Column) -> Column:
    return (F.pmod(F.floor((lon + 180) / 6), F.lit(60)) + 1).cast("int")


def utm(lat: Column, lon: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Easting and northing in a zone; within a millimetre up to some 3,000 km from its meridian."""
    radius, forward, _, _ = _series()
    n = FLATTENING / (2 - FLATTENING)
    k = 2 * n**0.5 / (1 + n)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - k * F.atanh(k * s))
    d = F.radians(lon - (zone * 6 - 183))
    xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
    east = eta + sum((a * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta) for j, a in enumerate(forward)), F.lit(0.0))
    north = xi + sum((a * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta) for j, a in enumerate(forward)), F.lit(0.0))
    return UTM_EAST + UTM_SCALE * radius * east, F.when(south, UTM_SOUTH).otherwise(0.0) + UTM_SCALE * radius * north


def from_utm(east: Column, north: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Latitude and longitude of a place in a zone."""
    radius, _, back, latitude = _series()
    xi = (north - F.when(south, UTM_SOUTH).otherwise(0.0)) / (UTM_SCALE * radius)
    eta = (east - UTM_EAST) / (UTM_SCALE * radius)
    a = xi - sum((b * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta) for j, b in enumerate(back)), F.lit(0.0))
    e = eta - sum((b * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta) for j, b in enumerate(back)), F.lit(0.0))
    chi = F.asin(F.sin(a) / F.cosh(e))
    lat = chi + sum((d * F.sin(2 * (j + 1) * chi) for j, d in enumerate(latitude)), F.lit(0.0))
    return F.degrees(lat), F.degrees(F.atan2(F.sinh(e), F.cos(a))) + zone * 6 - 183


def from_swiss(east: Column, north: Column) -> tuple[Column, Column]:
    """Latitude and longitude of Swiss LV95 coordinates, by the national survey's published approximation (within some 0.1 seconds of arc)."""
    y, x = (east - 2600000.0) / 1e6, (north - 1200000.0) / 1e6
    lon = 2.6779094 + 4.728982 * y + 0.791484 * y * x + 0.1306 * y * x * x - 0.0436 * y * y * y
    lat = 16.9023892 + 3.238272 * x - 0.270978 * y * y - 0.002528 * x * x - 0.0447 * y * y * x - 0.0140 * x * x * x
    return lat * 100 / 36, lon * 100 / 36


def to_swiss(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Swiss LV95 coordinates of a place, by the same survey's approximation (within a metre in Switzerland)."""
    a, b = (lat * 3600 - 169028.66) / 1e4, (lon * 3600 - 26782.5) / 1e4
    east = 2600072.37 + 211455.93 * b - 10938.51 * b * a - 0.36 * b * a * a - 44.54 * b * b * b
    north = 1200147.07 + 308807.95 * a + 3745.25 * b * b + 76.63 * a * a - 194.56 * b * b * a + 119.79 * a * a * a
    return east, north


def widened(value: Column) -> Column:
    """An 8-bit colour as 16 bits."""
    return (value * 257).cast("int")


def narrowed(value: Column) -> Column:
    """A 16-bit colour as 8 bits."""
    return F.shiftright(value.cast("int"), 8)


def dms(value: Column) -> Column:
    """Whole degrees, whole minutes, and seconds to four decimals of an angle without its sign."""
    v = F.abs(value)
    d = F.floor(v)
    m = F.floor((v - d) * 60)
    return F.struct(d.cast("int").alias("degrees"), m.cast("int").alias("minutes"), F.round((v - d - m / 60) * 3600, 4).alias("seconds"))
