"""Projected coordinates, straight-line metres and speeds."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctua.functions.days import second_of_day

# WGS 84 ellipsoid and UTM zone 32 north.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, FALSE_EASTING, CENTRAL_MERIDIAN = 0.9996, 500000.0, 9.0

_N = FLATTENING / (2 - FLATTENING)
_E = math.sqrt(FLATTENING * (2 - FLATTENING))
RECTIFYING_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Krueger's series to the fourth order in n; the rest is far below a millimetre.
KRUEGER = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)


def transverse_sphere(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Gauss-Schreiber coordinates (xi, eta) of the conformal sphere."""
    sin_lat = F.sin(F.radians(lat))
    away = F.radians(lon - F.lit(CENTRAL_MERIDIAN))
    tan_conformal = F.sinh(F.atanh(sin_lat) - F.lit(_E) * F.atanh(F.lit(_E) * sin_lat))
    xi = F.atan2(tan_conformal, F.cos(away))
    eta = F.asinh(F.sin(away) / F.sqrt(tan_conformal * tan_conformal + F.cos(away) * F.cos(away)))
    return xi, eta


def krueger_metres(xi: Column, eta: Column) -> tuple[Column, Column]:
    """Easting and northing in metres from the sphere coordinates."""
    east, north = eta, xi
    for order, factor in enumerate(KRUEGER, start=1):
        angle, stretch = F.lit(2.0 * order) * xi, F.lit(2.0 * order) * eta
        east = east + F.lit(factor) * F.cos(angle) * F.sinh(stretch)
        north = north + F.lit(factor) * F.sin(angle) * F.cosh(stretch)
    size = F.lit(SCALE * RECTIFYING_RADIUS)
    return F.lit(FALSE_EASTING) + size * east, size * north


def straight_line_m(east: Column, north: Column, east_to: Column, north_to: Column) -> Column:
    """Length between two projected points, cut to whole metres."""
    dx, dy = east_to - east, north_to - north
    return F.sqrt(dx * dx + dy * dy).cast("int")


def scheduled_seconds(departure: Column, arrival: Column) -> Column:
    """Seconds from departure to arrival, taken within one day, by the local clock."""
    return F.pmod(second_of_day(arrival) - second_of_day(departure), F.lit(86400)).cast("int")


def plausible_speed(metres: Column, seconds: Column) -> Column:
    """km/h; with no time at all 999 beyond a kilometre, else 1."""
    return (
        F.when((seconds == 0) & (metres > 1000), F.lit(999.0))
        .when(seconds == 0, F.lit(1.0))
        .otherwise(F.try_divide(metres.cast("double"), seconds.cast("double")) * F.lit(3.6))
    )
