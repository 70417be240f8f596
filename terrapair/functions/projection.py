"""Map projections as Column expressions: transverse Mercator (Krueger series) and web Mercator."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

A, FLAT = 6378137.0, 1 / 298.257223563
N = FLAT / (2 - FLAT)
K0, EAST = 0.9996, 500000.0
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
# Published series coefficients (Krueger 1912; Karney 2011) to the fourth order.
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180, 13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440, 61 * N**3 / 240 - 103 * N**4 / 140, 49561 * N**4 / 161280)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360, N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440, 17 * N**3 / 480 - 37 * N**4 / 840, 4397 * N**4 / 161280)
E1 = math.sqrt(FLAT * (2 - FLAT))


def utm_zone(lon: float, lat: float) -> str:
    """EPSG code of the UTM zone of a mean position."""
    return f"EPSG:{(32600 if lat >= 0 else 32700) + int((lon + 180) / 6) + 1}"


def _zone(epsg: str) -> tuple[float, float]:
    code = int(epsg.split(":")[1])
    if not (32601 <= code <= 32660 or 32701 <= code <= 32760):
        raise ValueError(f"not a UTM zone: {epsg}")
    return math.radians((code % 100) * 6 - 183), 10_000_000.0 if code >= 32700 else 0.0


def to_utm(lon: Column, lat: Column, epsg: str) -> tuple[Column, Column]:
    """(x, y) in metres."""
    central, north = _zone(epsg)
    phi, lam = F.radians(lat), F.radians(lon) - central
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - F.atanh(s * E1) * E1)
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(t * t + 1))
    x, y = eta, xi
    for j, a in enumerate(ALPHA, 1):
        x = x + F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j)) * a
        y = y + F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j)) * a
    return x * (K0 * RADIUS) + EAST, y * (K0 * RADIUS) + north


def from_utm(x: Column, y: Column, epsg: str) -> tuple[Column, Column]:
    """(lon, lat) in degrees."""
    central, north = _zone(epsg)
    xi0, eta0 = (y - north) / (K0 * RADIUS), (x - EAST) / (K0 * RADIUS)
    xi, eta = xi0, eta0
    for j, b in enumerate(BETA, 1):
        xi = xi - F.sin(xi0 * (2 * j)) * F.cosh(eta0 * (2 * j)) * b
        eta = eta - F.cos(xi0 * (2 * j)) * F.sinh(eta0 * (2 * j)) * b
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = chi
    # the conformal latitude inverted by a fixed number of Newton-like steps
    for _ in range(5):
        lat = F.asin(F.tanh(F.atanh(F.sin(chi)) + F.atanh(F.sin(lat) * E1) * E1))
    return F.degrees(F.atan2(F.sinh(eta), F.cos(xi)) + central), F.degrees(lat)


def to_web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * A, F.log(F.tan(F.radians(lat) / 2 + math.pi / 4)) * A


def from_web_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / A), F.degrees(F.atan(F.exp(y / A)) * 2 - math.pi / 2)
