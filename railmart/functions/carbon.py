"""CO2 per passenger and the savings derived from it."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.geo import first_rectangle, step_value


def lookup(key: Column, table: dict[str, float], default: float) -> Column:
    """Constant table lookup, folded into the plan as a map literal."""
    literal = F.create_map(*[F.lit(v) for v in chain.from_iterable(table.items())])
    return F.coalesce(F.try_element_at(literal, key), F.lit(default))


def electricity_factor(lat: Column, lon: Column) -> Column:
    """kg CO2 per kWh at a place. Rectangles lead straight to the value of their country, so a row
    takes one walk through them."""
    factors = [(C.ELECTRICITY[code], *sides) for code, *sides in C.COUNTRY_RECTANGLES]
    return F.coalesce(first_rectangle(lat, lon, factors), F.lit(C.DEFAULT_ELECTRICITY))


def train_co2(distance_km: Column, lat: Column, lon: Column) -> Column:
    kwh = distance_km * (C.TRAIN_WH_PER_PKM / 1000.0)
    return F.when(distance_km > 0, kwh * electricity_factor(lat, lon))


def flight_intensity(distance_km: Column) -> Column:
    """kg CO2 per seat km: burn, load and forcing depend on the distance alone, so their three step
    tables are one table over all their bounds."""
    tables = (C.KEROSENE_G_PER_SEAT_KM, C.LOAD_FACTOR, C.RADIATIVE_FORCING)
    bounds = sorted({upper for table in tables for upper, _ in table if upper is not None})
    steps = []
    for upper in [*bounds, None]:
        burn, load, forcing = (
            next(v for u, v in table if u is None or (upper is not None and upper <= u))
            for table in tables
        )
        steps.append((upper, burn / load / 1000.0 * C.KEROSENE_KG_CO2_PER_KG * forcing))
    return step_value(distance_km, steps)


def plane_co2(distance_km: Column) -> Column:
    return F.when(distance_km > 0, distance_km * flight_intensity(distance_km))


def is_plane(vehicule_type: Column) -> Column:
    return vehicule_type.contains(C.PLANE)


def co2_kg(distance_km: Column, vehicule_type: Column, lat: Column, lon: Column) -> Column:
    """CO2 of one passenger; the origin decides the electricity mix of a train."""
    return (
        F.when(vehicule_type.isNull(), F.lit(None).cast("double"))
        .when(is_plane(vehicule_type), plane_co2(distance_km))
        .otherwise(train_co2(distance_km, lat, lon))
    )


def co2_saved(train_kg: Column, plane_kg: Column) -> Column:
    return plane_kg - train_kg


def is_substitutable(distance_km: Column, plane_kg: Column) -> Column:
    """1 when the train ride is short enough and a flight exists, else 0 (also for NULL km)."""
    short = F.coalesce(distance_km <= C.SUBSTITUTION_LIMIT_KM, F.lit(False))
    return (short & plane_kg.isNotNull()).cast("int")


def is_long_distance(distance_km: Column, limit: float = C.LONG_DISTANCE_KM) -> Column:
    return distance_km > limit


def vehicle_factor(service_type: Column) -> Column:
    return lookup(service_type, C.VEHICLE_FACTOR, C.DEFAULT_VEHICLE_FACTOR)


def intensity(co2: Column, distance_km: Column) -> Column:
    return F.try_divide(co2, distance_km)
