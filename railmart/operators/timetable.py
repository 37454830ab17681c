"""From timetable tables to legs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.geo import haversine
from railmart.functions.trains import (
    classify_timetable, final_type, hour_of, is_night, service_code,
)
from railmart.operators.cleaning import named_stop, usable_stop
from railmart.operators.keep import keep_first
from railmart.schemas import LEG_TYPES, typed

TRIP = ["feed", "trip_id"]
PATTERN = ["pattern_1", "pattern_2"]  # both halves of a stop pattern's digest


def is_rail(route_type: Column) -> Column:
    return (route_type == C.RAIL_ROUTE_TYPE) | route_type.between(*C.RAIL_ROUTE_TYPE_RANGE)


def rail_only(routes: DataFrame, strict: bool = False) -> DataFrame:
    """Routes with a readable rail type. The train type is a matter of the route, so it is settled
    here, once per route instead of once per call or pair."""
    readable = routes.withColumn("route_type", F.col("route_type").try_cast("int"))
    code = service_code(F.col("route_short_name"), F.col("route_long_name"))
    return readable.where(is_rail(F.col("route_type"))).withColumn(
        "base_type", classify_timetable(code, F.col("route_type"), strict)
    )


def rail_trips(trips: DataFrame, routes: DataFrame, strict: bool = False) -> DataFrame:
    return trips.join(rail_only(routes, strict), ["feed", "route_id"])


def rail_calls(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Calls (stop times) of rail trips with the attributes of their route."""
    calls = stop_times.withColumn("stop_sequence", F.col("stop_sequence").try_cast("int"))
    attributes = trips.select(*TRIP, "route_type", "route_short_name", "route_long_name", "base_type")
    return calls.join(attributes, TRIP)


def stop_points(stops: DataFrame) -> DataFrame:
    return stops.select(
        "feed",
        "stop_id",
        F.col("stop_name").alias("sname"),
        F.col("stop_lat").try_cast("double").alias("lat"),
        F.col("stop_lon").try_cast("double").alias("lon"),
    )


def trip_lengths(
    calls: DataFrame,
    stops: DataFrame,
    trip: list[str] = TRIP,
    order: list[str] | None = None,
    stop_keys: list[str] | None = None,
) -> DataFrame:
    """Km along the stops of every trip, stop to stop; a segment at an unplaced stop adds nothing.

    `lag` over a trip would put a trip into one task. Here the calls are range-partitioned by
    (trip, order), so a trip longer than a partition is cut into runs. Segments are measured inside
    a run; a run then is one row (first point, last point, km), and only these rows, at most one per
    trip and partition, meet again per trip to close the gaps between runs.
    """
    order = order or ["stop_sequence", "stop_id"]
    stop_keys = stop_keys or ["feed", "stop_id"]
    placed = stops.where(usable_stop(F.col("lat"), F.col("lon"))).select(*stop_keys, "lat", "lon")
    located = calls.select(*dict.fromkeys([*trip, *order, *stop_keys])).join(placed, stop_keys, "left")
    runs = located.repartitionByRange(*trip, *order).withColumn("run", F.spark_partition_id())

    in_run = Window.partitionBy("run", *trip).orderBy(*order)
    segment = haversine(
        F.lag("lat").over(in_run), F.lag("lon").over(in_run), F.col("lat"), F.col("lon")
    )
    position = F.struct(*order)
    point = F.struct("lat", "lon")
    per_run = (
        runs.withColumn("km", segment)
        .groupBy("run", *trip)
        .agg(
            F.min_by(point, position).alias("head"),
            F.max_by(point, position).alias("tail"),
            F.sum("km").alias("km"),
        )
    )
    before = F.lag("tail").over(Window.partitionBy(*trip).orderBy("run"))
    gap = haversine(before["lat"], before["lon"], F.col("head.lat"), F.col("head.lon"))
    return per_run.withColumn("gap", gap).groupBy(*trip).agg(
        F.when(
            F.count("km") + F.count("gap") > 0,
            F.coalesce(F.sum("km"), F.lit(0.0)) + F.coalesce(F.sum("gap"), F.lit(0.0)),
        ).alias("stop_distance_km")
    )


def trip_summary(
    calls: DataFrame,
    trip: list[str] = TRIP,
    sequence: str = "stop_sequence",
    order: list[str] | None = None,
    attributes: list[str] | None = None,
) -> DataFrame:
    """Per trip the sequence bounds and the first known value of each attribute, by call order."""
    order = order or [sequence, "stop_id"]
    attributes = attributes or ["route_type", "route_short_name", "route_long_name"]
    return calls.groupBy(*trip).agg(
        F.min(sequence).alias("min_seq"),
        F.max(sequence).alias("max_seq"),
        *[
            F.min(F.when(F.col(a).isNotNull(), F.struct(*order, F.col(a).alias("value"))))["value"].alias(a)
            for a in attributes
        ],
    )


def served_stops(calls: DataFrame, stops: DataFrame) -> DataFrame:
    """One row per trip and stop name: its first call `a` and its last call `b`."""
    named = stop_points(stops).where(named_stop(F.col("sname"), F.col("lat")))
    called = calls.join(named, ["feed", "stop_id"]).where(F.col("stop_sequence").isNotNull())
    first = F.min(
        F.struct("stop_sequence", "departure_time", "lat", "lon", "stop_id", "base_type")
    ).alias("a")
    last = F.max(F.struct("stop_sequence", "arrival_time", "lat", "lon", "stop_id")).alias("b")
    return called.groupBy(*TRIP, "sname").agg(first, last)


def with_pattern(served: DataFrame) -> DataFrame:
    """With the digest of the trip's stop pattern: its names with the places and numbers of their first and last
    calls, but no times. Trips of a feed that call alike share it.

    Two XORs of 64-bit hashes over the trip's names, so no list is built and the order of rows does not matter. A trip has
    at most one row per stop name here, so the window stays small however many calls there are.
    """
    call = [F.col(f"{end}.{c}") for end in "ab" for c in ("stop_sequence", "stop_id", "lat", "lon")]
    over_trip = Window.partitionBy(*TRIP)
    return served.withColumns({
        half: F.bit_xor(F.xxhash64(F.lit(half), "sname", *call)).over(over_trip) for half in PATTERN
    })


def pattern_starts(served: DataFrame) -> DataFrame:
    """Of all trips of a pattern the one that leaves a stop first (by departure, then trip id): one row per
    feed, pattern and stop name. Trips are combined before the shuffle, so a pattern run by many trips is no hot key."""
    kept = F.min(F.struct("a.departure_time", "trip_id", "a")).alias("kept")
    return with_pattern(served).groupBy("feed", *PATTERN, "sname").agg(kept).select(
        "feed", "kept.trip_id", F.col("sname").alias("origin"), "kept.a"
    )


def pattern_pairs(calls: DataFrame, stops: DataFrame) -> DataFrame:
    """Every (origin, destination) a stop pattern serves, with the first trip of the pattern to leave the origin.

    A pair exists exactly if the first call at one end comes before the last call at the other, which the pattern decides. For
    the trips of a pattern that differ in time only the earliest one can survive, so pairs are made from its starts
    alone: their number is bounded by the patterns' lengths, not by the number of trips. The join is an equi-join on the trip.
    """
    served = served_stops(calls, stops)
    end = served.select(*TRIP, F.col("sname").alias("destination"), "b")
    pairs = pattern_starts(served).join(end, TRIP).where(
        (F.col("a.stop_sequence") < F.col("b.stop_sequence"))
        & (F.col("origin") != F.col("destination"))
    )
    return pairs.select(
        "feed", "origin", "destination",
        F.col("a.departure_time").alias("departure_time"),
        "trip_id",
        F.col("a.lat").alias("station_lat"),
        F.col("a.lon").alias("station_long"),
        F.col("b.lat").alias("station_lat_dest"),
        F.col("b.lon").alias("station_long_dest"),
        F.col("b.arrival_time").alias("arrival_time"),
        F.col("a.base_type").alias("base_type"),
    )


def stop_pairs(calls: DataFrame, stops: DataFrame) -> DataFrame:
    """Every (origin, destination) a rail trip serves, one row per feed and pair: the earliest departure, then trip id."""
    return keep_first(
        pattern_pairs(calls, stops), ["feed", "origin", "destination"], ["departure_time", "trip_id"]
    )


def with_train_type(pairs: DataFrame) -> DataFrame:
    night = is_night(hour_of(F.col("departure_time")), F.col("base_type"))
    return pairs.withColumn("is_night_train", night).withColumn(
        "vehicule_type", final_type(F.col("base_type"), F.col("is_night_train"))
    )


def timetable_legs(tables: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """Legs of all feeds in one plan."""
    trips = rail_trips(tables["trips"], tables["routes"], strict)
    calls = rail_calls(tables["stop_times"], trips)
    pairs = with_train_type(stop_pairs(calls, tables["stops"]))
    return typed(
        pairs.withColumns({"source": F.lit("mobility_db"), "provider": F.col("feed")}), LEG_TYPES
    )
