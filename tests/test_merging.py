"""Loads that merge feed by feed against one load of all feeds."""

import random

import pytest
from pyspark.sql import functions as F

from railmart.operators.cleaning import rail_routes
from railmart.operators.nearest import nearest_airports, stations_of
from railmart.operators.star import fact_corridors
from railmart.plans import merging, pipeline, warehouse
from railmart.schemas import LEG_TYPES, typed
from railmart.session import cut_lineage
from tests.helpers import rows

TYPES = ["TGV", "ICE", "Nightjet"]
SOURCES = ["mobility_db", "night_sheet"]


def legs_of(spark, feed, seed, n=60, places=9):
    """Legs of one feed between shared names; a name may lie elsewhere in another feed, so its airport may move."""
    rng = random.Random(seed)

    def place(k):
        return 44.0 + k * 1.3 + rng.choice([0, 0, 0.25]), 1.0 + k * 1.1

    found = []
    for _ in range(n):
        a, b = rng.sample(range(places), 2)
        (lat, lon), (lat_b, lon_b) = place(a), place(b)
        found.append((
            f"Stop {chr(65 + a)}", f"Stop {chr(65 + b)}", rng.choice(TYPES), lat, lon, lat_b, lon_b,
            f"{rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:00", rng.choice(SOURCES), feed,
        ))
    return spark.createDataFrame(
        found, "origin string, destination string, vehicule_type string, station_lat double, station_long double, "
        "station_lat_dest double, station_long_dest double, departure_time string, source string, provider string",
    )


@pytest.fixture(scope="module")
def airports(spark):
    return spark.createDataFrame(
        [(f"X{k}", 44.3 + k * 1.3, 1.1 + k * 1.1, f"Port {k}", "FR") for k in range(0, 9, 2)]
        + [(f"Y{k}", 44.1 + k * 1.3 + 0.3, 1.0 + k * 1.1, f"Field {k}", "FR") for k in range(0, 9, 3)],
        "iata_code string, aero_lat double, aero_long double, airport_name string, country_code string",
    )


def rail_of(spark, *feeds):
    parts = [legs_of(spark, *feed) for feed in feeds]
    return cut_lineage(rail_routes(typed(pipeline.unite(parts), LEG_TYPES)))


def whole(rail, airports):
    """The staging tables as the batch job makes them."""
    links = cut_lineage(nearest_airports(stations_of(rail), airports))
    routes = cut_lineage(pipeline.final_routes(rail, links))
    return pipeline.star_tables(routes, cut_lineage(fact_corridors(routes)))


def same(got, want):
    for name in ("dim_vehicle_type", "dim_route", "dim_station_frequentation", "fact", "fact_wide"):
        columns = sorted(want[name].columns)
        assert sorted(got[name].columns) == columns, name
        numbers = [[tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows(t[name], *columns)] for t in (got, want)]
        assert sorted(numbers[0], key=repr) == sorted(numbers[1], key=repr), name


A, B, C, N = ("A", 1), ("B", 2, 40), ("C", 3, 25, 5), (None, 4, 20)


def test_feed_by_feed_equals_all_at_once(spark, airports, tmp_path):
    root = str(tmp_path / "state")
    for batch in ((A,), (B, N)):
        merging.merge(spark, root, rail_of(spark, *batch), airports)
    got = merging.merge(spark, root, rail_of(spark, C), airports)
    want = whole(rail_of(spark, A, B, N, C), airports)
    same(got, want)

    star, direct = str(tmp_path / "star"), str(tmp_path / "direct")
    assert warehouse.load_star(spark, star, got) == warehouse.load_star(spark, direct, want)
    loaded, expected = warehouse.read_star(spark, star), warehouse.read_star(spark, direct)
    for name in expected:
        assert rows(loaded[name], *expected[name].columns) == rows(expected[name]), name


def test_a_batch_replaces_its_feeds(spark, airports, tmp_path):
    root = str(tmp_path / "state")
    merging.merge(spark, root, rail_of(spark, A, B), airports)
    later = ("A", 9, 30, 6)
    same(merging.merge(spark, root, rail_of(spark, later), airports), whole(rail_of(spark, later, B), airports))
    # a feed that has nothing left takes its corridors, stations and links along
    nothing = rail_of(spark, B).where("false")
    same(merging.merge(spark, root, nothing, airports, feeds=["B"]), whole(rail_of(spark, later), airports))
    same(merging.merge(spark, root, nothing, airports, rebuild=True), whole(rail_of(spark, later), airports))


def test_only_touched_corridors_are_rebuilt(spark, airports, tmp_path):
    """A feed of two stations far from all others rebuilds its corridor only."""
    root = tmp_path / "state"
    merging.merge(spark, str(root), rail_of(spark, A, B), airports)
    far = rail_of(spark, ("Z", 5, 4, 2)).withColumns({c: F.concat(c, F.lit(" far")) for c in ("origin", "destination")})
    merging.merge(spark, str(root), far, airports)
    version = warehouse.current_version(spark, str(root))
    touched = spark.read.parquet(f"{version}/touched")
    assert touched.count() > 0 and touched.where("origin NOT LIKE '% far' OR destination NOT LIKE '% far'").isEmpty()


def test_a_merge_that_breaks_off_changes_nothing(spark, airports, tmp_path, monkeypatch):
    root = tmp_path / "state"
    merging.merge(spark, str(root), rail_of(spark, A), airports)
    before = warehouse.current_version(spark, str(root))

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(merging, "dim_route", lost)
    with pytest.raises(RuntimeError):
        merging.merge(spark, str(root), rail_of(spark, B), airports)
    monkeypatch.undo()
    assert warehouse.current_version(spark, str(root)) == before
    assert len(list((root / "rides").iterdir())) == len(list((root / "points").iterdir())) == 1
