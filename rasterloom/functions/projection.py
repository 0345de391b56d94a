"""Map projections as closed expressions, of columns or, with ``m=Arrays``, of NumPy arrays.

Polar stereographic: Snyder, "Map Projections - A Working Manual" (USGS PP 1395), eqs. 15-9, 21-33,
3-5. Transverse Mercator: Krueger's series to the third order in the flattening, good to about a
millimetre inside a zone.
"""

import math

import numpy as np
from pyspark.sql import functions as F


class Arrays:
    """NumPy's names for the functions that the projections use."""

    sin, cos, tan, sinh, cosh, sqrt = np.sin, np.cos, np.tan, np.sinh, np.cosh, np.sqrt
    asin, atan, atan2, atanh = np.arcsin, np.arctan, np.arctan2, np.arctanh
    radians, degrees, pow = np.radians, np.degrees, np.power

    @staticmethod
    def lit(x):
        return x


# WGS 84, EPSG:3413 and UTM.
A = 6378137.0
FLATTENING = 1 / 298.257223563
POLAR_LATITUDE = 70.0
POLAR_MERIDIAN = -45.0
UTM_SCALE = 0.9996
UTM_EASTING = 500000.0

E2 = FLATTENING * (2 - FLATTENING)
E = math.sqrt(E2)
N = FLATTENING / (2 - FLATTENING)
RECTIFYING = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16, 13 * N**2 / 48 - 3 * N**3 / 5, 61 * N**3 / 240)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96, N**2 / 48 + N**3 / 15, 17 * N**3 / 480)
DELTA = (2 * N - 2 * N**2 / 3 - 2 * N**3, 7 * N**2 / 3 - 8 * N**3 / 5, 56 * N**3 / 15)
CONFORMAL = (
    E2 / 2 + 5 * E2**2 / 24 + E2**3 / 12 + 13 * E2**4 / 360,
    7 * E2**2 / 48 + 29 * E2**3 / 240 + 811 * E2**4 / 11520,
    7 * E2**3 / 120 + 81 * E2**4 / 1120,
    4279 * E2**4 / 161280,
)


def _polar_scale():
    phi = math.radians(POLAR_LATITUDE)
    s = math.sin(phi)
    m = math.cos(phi) / math.sqrt(1 - E2 * s * s)
    t = math.tan(math.pi / 4 - phi / 2) / ((1 - E * s) / (1 + E * s)) ** (E / 2)
    return A * m / t


POLAR_SCALE = _polar_scale()


def _sine_series(angle, terms, m=F):
    total = m.lit(0.0)
    for k, c in enumerate(terms, start=1):
        total = total + c * m.sin(2.0 * k * angle)
    return total


def polar_from_lonlat(lon, lat, m=F):
    phi = m.radians(lat)
    s = m.sin(phi)
    t = m.tan(math.pi / 4 - phi / 2) / m.pow((1 - E * s) / (1 + E * s), m.lit(E / 2))
    rho = POLAR_SCALE * t
    dlon = m.radians(lon - POLAR_MERIDIAN)
    return rho * m.sin(dlon), -rho * m.cos(dlon)


def lonlat_from_polar(x, y, m=F):
    rho = m.sqrt(x * x + y * y)
    chi = math.pi / 2 - 2 * m.atan(rho / POLAR_SCALE)
    lon = POLAR_MERIDIAN + m.degrees(m.atan2(x, -y))
    return lon, m.degrees(chi + _sine_series(chi, CONFORMAL, m))


def central_meridian(zone):
    return zone * 6.0 - 183.0


def utm_from_lonlat(lon, lat, zone, m=F):
    k = 2 * math.sqrt(N) / (1 + N)
    s = m.sin(m.radians(lat))
    t = m.sinh(m.atanh(s) - k * m.atanh(k * s))
    dlon = m.radians(lon - central_meridian(zone))
    xi = m.atan2(t, m.cos(dlon))
    eta = m.atanh(m.sin(dlon) / m.sqrt(1 + t * t))
    east, north = eta, xi
    for j, c in enumerate(ALPHA, start=1):
        east = east + c * m.cos(2.0 * j * xi) * m.sinh(2.0 * j * eta)
        north = north + c * m.sin(2.0 * j * xi) * m.cosh(2.0 * j * eta)
    return UTM_EASTING + UTM_SCALE * RECTIFYING * east, UTM_SCALE * RECTIFYING * north


def lonlat_from_utm(x, y, zone, m=F):
    xi = y / (UTM_SCALE * RECTIFYING)
    eta = (x - UTM_EASTING) / (UTM_SCALE * RECTIFYING)
    xi_p, eta_p = xi, eta
    for j, c in enumerate(BETA, start=1):
        xi_p = xi_p - c * m.sin(2.0 * j * xi) * m.cosh(2.0 * j * eta)
        eta_p = eta_p - c * m.cos(2.0 * j * xi) * m.sinh(2.0 * j * eta)
    chi = m.asin(m.sin(xi_p) / m.cosh(eta_p))
    lat = m.degrees(chi + _sine_series(chi, DELTA, m))
    return central_meridian(zone) + m.degrees(m.atan2(m.sinh(eta_p), m.cos(xi_p))), lat


def polar_from_utm(x, y, zone, m=F):
    return polar_from_lonlat(*lonlat_from_utm(x, y, zone, m), m)


def utm_from_polar(x, y, zone, m=F):
    return utm_from_lonlat(*lonlat_from_polar(x, y, m), zone, m)
