"""From landed files to the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from railmart.operators.cleaning import rail_routes
from railmart.operators.keep import undirected
from railmart.operators.lookups import enrich_stations
from railmart.operators.nearest import nearest_airports, stations_of
from railmart.operators.night_sheet import sheet_legs
from railmart.operators.planes import plane_routes
from railmart.operators.star import (
    dim_route, dim_station, dim_vehicle_type, fact_corridors, fact_wide, unique_routes,
)
from railmart.operators.timetable import timetable_legs
from railmart.schemas import ROUTE_TYPES, typed


def unite(parts: list[DataFrame]) -> DataFrame:
    """Union by name; a column a part lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def all_legs(
    timetables: dict[str, DataFrame] | None,
    night_sheet: dict[str, DataFrame] | None,
    strict: bool = False,
) -> DataFrame:
    parts = []
    if timetables:
        parts.append(timetable_legs(timetables, strict))
    if night_sheet:
        parts.append(sheet_legs(night_sheet, strict))
    if not parts:
        raise ValueError("neither timetables nor a night sheet given")
    return unite(parts)


def final_routes(rail: DataFrame, links: DataFrame | None, bidirectional: bool = False) -> DataFrame:
    """Rail routes and the flights beside them, one row per ends, type and source."""
    parts = [rail] if links is None else [rail, plane_routes(rail, links)]
    united = typed(unite(parts), ROUTE_TYPES)
    return unique_routes(undirected(united) if bidirectional else united)


def star_schema(
    routes: DataFrame,
    footfall: DataFrame | None = None,
    communes: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Staging tables of the star schema from the final relation."""
    return star_tables(routes, fact_corridors(routes), footfall, communes, gazetteer)


def star_tables(
    routes: DataFrame,
    fact: DataFrame,
    footfall: DataFrame | None = None,
    communes: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
) -> dict[str, DataFrame]:
    stations = enrich_stations(dim_station(fact), footfall, communes, gazetteer)
    return {
        "dim_vehicle_type": dim_vehicle_type(routes),
        "dim_route": dim_route(routes),
        "dim_station_frequentation": stations,
        "fact": fact,
        "fact_wide": fact_wide(fact, stations),
    }


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write a relation that several later stages read, and go on from the files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def run(
    spark: SparkSession,
    work: str,
    timetables: dict[str, DataFrame] | None = None,
    night_sheet: dict[str, DataFrame] | None = None,
    airports: DataFrame | None = None,
    footfall: DataFrame | None = None,
    communes: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
    strict: bool = False,
    band: float | None = 1.0,
    bidirectional: bool = False,
) -> dict[str, DataFrame]:
    """The whole job. Relations with more than one reader are staged under `work`, so nothing is
    computed twice and a lost executor costs one stage."""
    rail = staged(rail_routes(all_legs(timetables, night_sheet, strict), strict), f"{work}/rail_routes")
    links = None
    if airports is not None:
        links = staged(nearest_airports(stations_of(rail), airports, band=band), f"{work}/airport_links")
    routes = staged(final_routes(rail, links, bidirectional), f"{work}/routes_final")
    fact = staged(fact_corridors(routes), f"{work}/fact")
    tables = star_tables(routes, fact, footfall, communes, gazetteer)
    stations = staged(tables["dim_station_frequentation"], f"{work}/dim_station")
    tables |= {
        "routes_final": routes,
        "dim_station_frequentation": stations,
        "fact_wide": fact_wide(fact, stations),
    }
    if links is not None:
        tables["airport_links"] = links
    return tables
