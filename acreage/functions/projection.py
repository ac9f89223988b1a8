"""Modified Transverse Mercator zone 5 to spherical Mercator, as column arithmetic.

The grid is inverted with the Krüger series in the third flattening, to the fourth order. The two datum steps
between the Canadian frame and WGS 84 are left out; their effect is at the metre level.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The only source system accepted and the target.
SOURCE_SYSTEM = "NAD_1983_CSRS_2010_MTM_5_Nova_Scotia"
TARGET_CODE = 3857
# GRS 80 ellipsoid and the zone's parameters.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
CENTRAL_MERIDIAN = -64.5
SCALE = 0.9999
FALSE_EASTING = 25500000.0

_N = FLATTENING / (2 - FLATTENING)
_ECC2 = FLATTENING * (2 - FLATTENING)
_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Coefficients of the inverse series.
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)


def to_web_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """Easting and northing in the zone as spherical Mercator metres."""
    xi = y / F.lit(SCALE * _RADIUS)
    eta = (x - F.lit(FALSE_EASTING)) / F.lit(SCALE * _RADIUS)
    north, east = xi, eta
    for k, beta in enumerate(_BETA, start=1):
        north = north - F.lit(beta) * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        east = east - F.lit(beta) * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    conformal = F.asin(F.sin(north) / F.cosh(east))
    longitude = F.lit(math.radians(CENTRAL_MERIDIAN)) + F.atan2(F.sinh(east), F.cos(north))
    # isometric latitude of the conformal sphere, turned back to the ellipsoid by fixed-point steps
    isometric = F.log(F.tan(F.lit(math.pi / 4) + conformal / 2))
    ecc = math.sqrt(_ECC2)
    latitude = conformal
    for _ in range(6):
        shift = F.lit(ecc) * F.atanh(F.lit(ecc) * F.sin(latitude))
        latitude = 2 * F.atan(F.exp(isometric + shift)) - F.lit(math.pi / 2)
    mercator_y = F.lit(SEMI_MAJOR) * F.log(F.tan(F.lit(math.pi / 4) + latitude / 2))
    return F.lit(SEMI_MAJOR) * longitude, mercator_y


def reprojected(points: DataFrame, x: str, y: str, source_system: str, target_code: int = TARGET_CODE) -> DataFrame:
    """``points`` with ``x`` and ``y`` in the target system; any other system is refused."""
    if source_system != SOURCE_SYSTEM:
        raise ValueError(f"not a valid source system: {source_system}")
    if target_code != TARGET_CODE:
        raise ValueError(f"no projection to {target_code}")
    new_x, new_y = to_web_mercator(F.col(x), F.col(y))
    return points.withColumns({x: new_x, y: new_y})
