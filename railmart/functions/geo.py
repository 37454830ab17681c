"""Distances, countries and grid cells."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from railmart import constants as C


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km. A NULL coordinate makes the result NULL by itself."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_dlon), F.lit(2.0))
    # antipodes can push the chord above 1 by rounding
    return F.lit(2 * C.EARTH_RADIUS_KM) * F.atan2(
        F.sqrt(chord), F.sqrt(F.greatest(1 - chord, F.lit(0.0)))
    )


def first_rectangle(lat: Column, lon: Column, rectangles: list[tuple]) -> Column:
    """Value of the first (value, lat min, lat max, lon min, lon max) that holds the point; NULL at
    (0, 0) or outside all."""
    return reduce(
        lambda case, r: case.when(lat.between(r[1], r[2]) & lon.between(r[3], r[4]), F.lit(r[0])),
        rectangles,
        F.when((lat == 0.0) & (lon == 0.0), F.lit(None)),
    )


def country_of(lat: Column, lon: Column) -> Column:
    """ISO code of a place by rectangles."""
    return first_rectangle(lat, lon, C.COUNTRY_RECTANGLES)


def step_value(x: Column, steps: list[tuple[float | None, float]]) -> Column:
    """Value of the first step whose upper bound is at least `x`."""
    *bounded, (_, last) = steps
    first, *rest = bounded
    case = F.when(x <= first[0], F.lit(first[1]))
    for upper, value in rest:
        case = case.when(x <= upper, F.lit(value))
    return case.when(x.isNotNull(), F.lit(last))


def within_band(lat1: Column, lon1: Column, lat2: Column, lon2: Column, band: float) -> Column:
    return (F.abs(lat1 - lat2) <= band) & (F.abs(lon1 - lon2) <= band)


def degrees_of_latitude(km: float) -> float:
    """Degrees of latitude spanned by `km`, a hair wider so that rounding cannot lose a point."""
    return math.degrees(km / C.EARTH_RADIUS_KM) * (1 + 1e-9)


def cell(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(size)).cast("int")
