"""Numeric, date and geodetic columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
# Fixed values of public geodesy: GRS80, Lambert-93, and the zones of the overseas projections (longitude of origin,
# false northing) by EPSG code.
A, FLATTENING = 6378137.0, 1 / 298.257222101
LAMBERT_N, LAMBERT_C, LAMBERT_XS, LAMBERT_YS = 0.7256077650532670, 11754255.426096, 700000.0, 12655612.049876
UTM_ZONES = {5490: (-63.0, 0.0), 2972: (-51.0, 0.0), 2975: (57.0, 1e7), 4471: (45.0, 1e7)}
E2 = FLATTENING * (2 - FLATTENING)
# the series from isometric (conformal) to geodetic latitude, in sin(2k chi)
CONFORMAL = (E2 / 2 + 5 * E2**2 / 24 + E2**3 / 12 + 13 * E2**4 / 360, 7 * E2**2 / 48 + 29 * E2**3 / 240 + 811 * E2**4 / 11520, 7 * E2**3 / 120 + 81 * E2**4 / 1120, 4279 * E2**4 / 161280)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(a))


def cell(coordinate: Column, side: float) -> Column:
    """The index of the grid cell of a coordinate."""
    return F.floor(coordinate / F.lit(side)).cast("int")


def clip01(x: Column) -> Column:
    """x between 0 and 1; null is 0."""
    return F.least(F.greatest(F.coalesce(x, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def half_life(day: Column, as_of: Column, days: float) -> Column:
    """0.5 to the power of the age in half-lives; 0 for null and for days to come."""
    age = F.datediff(as_of, day)
    return F.when(age >= 0, F.pow(F.lit(0.5), age / F.lit(float(days)))).otherwise(0.0)


def growth(now: Column, before: Column, digits: int = 4) -> Column:
    """Relative change; null where either is null or the base is 0."""
    return F.round(F.try_divide((now - before).cast("double"), F.abs(before).cast("double")), digits)


def _geodetic(chi: Column) -> Column:
    return chi + sum((F.sin(2 * (k + 1) * chi) * c for k, c in enumerate(CONFORMAL)), F.lit(0.0))


def lambert93_latitude(x: Column, y: Column) -> Column:
    """Latitude of Lambert-93 coordinates, in degrees."""
    iso = -F.log(F.hypot(x - LAMBERT_XS, F.lit(LAMBERT_YS) - y) / LAMBERT_C) / LAMBERT_N
    return F.degrees(_geodetic(2 * F.atan(F.exp(iso)) - math.pi / 2))


def lambert93_longitude(x: Column, y: Column) -> Column:
    """Longitude of Lambert-93 coordinates, in degrees."""
    return 3 + F.degrees(F.atan2(x - LAMBERT_XS, F.lit(LAMBERT_YS) - y) / LAMBERT_N)


def _utm(x: Column, y: Column, zone: int) -> tuple[Column, Column]:
    """(conformal latitude, longitude difference) in radians, by Krueger's series to the third order."""
    n = FLATTENING / (2 - FLATTENING)
    rectified = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    xi, eta = (y - UTM_ZONES[zone][1]) / (0.9996 * rectified), (x - 500000.0) / (0.9996 * rectified)
    xi1 = xi - sum((F.sin(2 * (k + 1) * xi) * F.cosh(2 * (k + 1) * eta) * b for k, b in enumerate(beta)), F.lit(0.0))
    eta1 = eta - sum((F.cos(2 * (k + 1) * xi) * F.sinh(2 * (k + 1) * eta) * b for k, b in enumerate(beta)), F.lit(0.0))
    return F.asin(F.sin(xi1) / F.cosh(eta1)), F.atan2(F.sinh(eta1), F.cos(xi1))


def utm_latitude(x: Column, y: Column, zone: int) -> Column:
    """Latitude of transverse Mercator coordinates of an overseas zone (an EPSG code), in degrees."""
    return F.degrees(_geodetic(_utm(x, y, zone)[0]))


def utm_longitude(x: Column, y: Column, zone: int) -> Column:
    """Longitude of the same."""
    return UTM_ZONES[zone][0] + F.degrees(_utm(x, y, zone)[1])


def tile(lat: Column, lon: Column, zoom: int) -> tuple[Column, Column]:
    """(x, y) of the web map tile at a zoom."""
    n = float(1 << zoom)
    x = F.floor((lon + 180) / 360 * n).cast("int")
    return x, F.floor((1 - F.asinh(F.tan(F.radians(lat))) / math.pi) / 2 * n).cast("int")
