"""Transverse Mercator on the GRS80 ellipsoid as columns, by Krueger's series to the fourth order."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: GRS80, and zone IX of the Japanese plane system (EPSG:6677).
A, INVERSE_F = 6378137.0, 298.257222101
LAT0, LON0, K0 = 36.0, 139.0 + 50.0 / 60.0, 0.9999

N = 1.0 / (2.0 * INVERSE_F - 1.0)
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
ALPHA = [
    N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180,
    13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440,
    61 * N**3 / 240 - 103 * N**4 / 140,
    49561 * N**4 / 161280,
]
BETA = [
    N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360,
    N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440,
    17 * N**3 / 480 - 37 * N**4 / 840,
    4397 * N**4 / 161280,
]
DELTA = [
    2 * N - 2 * N**2 / 3 - 2 * N**3 + 116 * N**4 / 45,
    7 * N**2 / 3 - 8 * N**3 / 5 - 227 * N**4 / 45,
    56 * N**3 / 15 - 136 * N**4 / 35,
    4279 * N**4 / 630,
]
E1 = 2 * math.sqrt(N) / (1 + N)


def _northing0(lat0: float) -> float:
    s = math.sin(math.radians(lat0))
    t = math.sinh(math.atanh(s) - E1 * math.atanh(E1 * s))
    xi = math.atan(t)
    return xi + sum(a * math.sin(2 * (j + 1) * xi) for j, a in enumerate(ALPHA))



def to_plane(lon: Column, lat: Column, lon0: float = LON0, lat0: float = LAT0, k0: float = K0) -> Column:
    """struct(x, y) in metres, x east and y north, of degrees."""
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - E1 * F.atanh(E1 * s))
    d = F.radians(lon - lon0)
    xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
    north, east = xi, eta
    for j, a in enumerate(ALPHA):
        north = north + a * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta)
        east = east + a * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta)
    return F.struct((k0 * RADIUS * east).alias("x"), (k0 * RADIUS * (north - _northing0(lat0))).alias("y"))


def to_degrees(x: Column, y: Column, lon0: float = LON0, lat0: float = LAT0, k0: float = K0) -> Column:
    """struct(lon, lat) in degrees of plane metres."""
    xi = y / (k0 * RADIUS) + _northing0(lat0)
    eta = x / (k0 * RADIUS)
    a, b = xi, eta
    for j, c in enumerate(BETA):
        a = a - c * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta)
        b = b - c * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta)
    chi = F.asin(F.sin(a) / F.cosh(b))
    lat = chi
    for j, c in enumerate(DELTA):
        lat = lat + c * F.sin(2 * (j + 1) * chi)
    return F.struct((lon0 + F.degrees(F.atan2(F.sinh(b), F.cos(a)))).alias("lon"), F.degrees(lat).alias("lat"))
