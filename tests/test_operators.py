import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from railmart.operators import lookups, profile, quantiles, split, timetable
from railmart.operators.keep import keep_first
from railmart.operators.nearest import nearby_pairs, nearest_airports
from railmart.operators.night_sheet import sheet_legs
from railmart.operators.numbering import dense_ids, rank_by_hash
from railmart.operators.quantiles import exact_quantiles
from railmart.sources.cube import cube_columns, decode_cube
from tests.helpers import rows


def km(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


# --- airports -------------------------------------------------------------------
@pytest.mark.parametrize("band", [1.0, None])
def test_grid_join_equals_brute_force(spark, band):
    rng = random.Random(5)
    # scattered points, a crowd in one spot of a degree, and both sides of the 63.28 degree line
    points = [(rng.uniform(35, 70), rng.uniform(-10, 30)) for _ in range(150)]
    points += [(48 + rng.random() / 2, 2 + rng.random() / 2) for _ in range(150)]
    points += [(rng.uniform(62.8, 63.8), rng.uniform(10, 12)) for _ in range(60)]
    fields = [(rng.uniform(35, 70), rng.uniform(-10, 30)) for _ in range(100)]
    fields += [(48 + rng.random() / 2, 2 + rng.random() / 2) for _ in range(60)]
    fields += [(rng.uniform(62.8, 63.8), rng.uniform(10, 12)) for _ in range(60)]
    stations = spark.createDataFrame([(f"s{i}", *p) for i, p in enumerate(points)], "station_name string, station_lat double, station_long double")
    airports = spark.createDataFrame([(f"a{i}", *p) for i, p in enumerate(fields)], "iata_code string, aero_lat double, aero_long double")
    want = {
        (f"s{i}", f"a{j}")
        for i, p in enumerate(points) for j, q in enumerate(fields)
        if km(p, q) <= 50 and (band is None or (abs(p[0] - q[0]) <= band and abs(p[1] - q[1]) <= band))
    }
    got = nearby_pairs(stations, airports, band=band)
    assert {tuple(r) for r in got.select("station_name", "iata_code").collect()} == want
    assert got.count() == len(want)


def test_circle_goes_round_the_globe(spark):
    stations = spark.createDataFrame([("a", 60.0, 179.9), ("b", 89.9, 10.0)], "station_name string, station_lat double, station_long double")
    airports = spark.createDataFrame([("x", 60.0, -179.9), ("y", 89.9, -170.0)], "iata_code string, aero_lat double, aero_long double")
    got = nearby_pairs(stations, airports, band=None)
    assert rows(got, "station_name", "iata_code") == [("a", "x"), ("b", "y")]


def test_nearest_breaks_ties_and_merges_homonyms(spark):
    stations = spark.createDataFrame(
        [("Halle", 51.0, 4.0), ("Halle", 52.0, 8.4), ("Far", 10.0, 10.0)],
        "station_name string, station_lat double, station_long double",
    )
    airports = spark.createDataFrame(
        [("B", 52.1, 8.4, "n1"), ("A", 52.1, 8.4, "n2"), ("C", 51.4, 4.0, "n3")],
        "iata_code string, aero_lat double, aero_long double, airport_name string",
    ).withColumn("country_code", F.lit("DE"))
    got = nearest_airports(stations, airports).collect()
    assert [(r.station_name, r.station_lat, r.iata_code) for r in got] == [("Halle", 52.0, "A")]


# --- trips ----------------------------------------------------------------------
def trips_with_repeats(rng, n_trips, longest):
    calls = []
    for t in range(n_trips):
        for _ in range(rng.randint(1, longest)):
            calls.append((f"T{t}", str(rng.randint(0, 8)), rng.randint(1, 6)))
    return calls


def test_stop_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    calls = trips_with_repeats(rng, 12, 25)
    df = spark.createDataFrame(calls, "trip_id string, stop_id string, stop_sequence int").select(
        F.lit("F").alias("feed"), "*", F.format_string("%02d:00:00", "stop_sequence").alias("departure_time"),
        F.format_string("%02d:30:00", "stop_sequence").alias("arrival_time"), F.lit("TGV").alias("base_type"),
    )
    stops = spark.createDataFrame(
        [("F", str(i), f"N{i // 2}", str(45 + i), str(5.0)) for i in range(8)] + [("F", "8", None, "1", "1")],
        "feed string, stop_id string, stop_name string, stop_lat string, stop_lon string",
    )
    want = set()
    for trip, stop_a, a in calls:
        for other, stop_b, b in calls:
            names = [f"N{int(s) // 2}" for s in (stop_a, stop_b)]
            if trip == other and a < b and "8" not in (stop_a, stop_b) and names[0] != names[1]:
                want.add(tuple(names))
    got = timetable.stop_pairs(df, stops)
    assert {tuple(r) for r in got.select("origin", "destination").collect()} == want
    assert got.count() == len(want)


def timetable_of_patterns(spark, rng, patterns, trips):
    """Calls of `trips` trips that run `patterns` stop lists at all hours, and the stops."""
    lists = [[rng.randint(0, 11) for _ in range(rng.randint(2, 9))] for _ in range(patterns)]
    calls = []
    for t in range(trips):
        at = rng.randint(0, 1000)
        for k, stop in enumerate(lists[t % patterns]):
            calls.append((f"F{t % 2}", f"T{t:04d}", str(stop), 10 * k, f"{at:05d}+{k}", f"{at:05d}-{k}", "TGV" if t % 3 else "ICE"))
    df = spark.createDataFrame(
        calls, "feed string, trip_id string, stop_id string, stop_sequence int, departure_time string, arrival_time string, base_type string"
    )
    stops = spark.createDataFrame(
        [(f, str(i), f"N{i // 2}", str(45 + i), str(5.0)) for i in range(12) for f in ("F0", "F1")],
        "feed string, stop_id string, stop_name string, stop_lat string, stop_lon string",
    )
    return calls, df, stops


def test_pairs_are_bounded_by_patterns_not_by_trips(spark):
    """Ten times the trips over the same patterns give the same number of pair rows before the survivors are chosen."""
    few, many = (
        timetable.pattern_pairs(*timetable_of_patterns(spark, random.Random(5), 6, trips)[1:]).count() for trips in (60, 600)
    )
    assert few == many > 0


def test_pairs_by_pattern_keep_the_earliest_trip(spark):
    """Whole rows against brute force over all trips: times, trip, places and type of the survivor."""
    calls, df, stops = timetable_of_patterns(spark, random.Random(6), 7, 90)
    trips = {}
    for feed, trip, stop, seq, dep, arr, kind in calls:
        trips.setdefault((feed, trip), {}).setdefault(f"N{int(stop) // 2}", []).append((seq, dep, arr, int(stop), kind))
    want = {}
    for (feed, trip), names in trips.items():
        for a, starts in names.items():
            for b, ends in names.items():
                first, last = min(starts), max(ends)
                if a != b and first[0] < last[0]:
                    row = (first[1], trip, 45.0 + first[3], 45.0 + last[3], last[2], first[4])
                    want[feed, a, b] = min(row, want.get((feed, a, b), row))
    got = timetable.stop_pairs(df, stops).select(
        "feed", "origin", "destination", "departure_time", "trip_id", "station_lat", "station_lat_dest", "arrival_time", "base_type"
    ).collect()
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == want and len(got) == len(want)


def test_patterns_tell_stop_lists_apart(spark):
    def patterns(rows):
        df = spark.createDataFrame([("F", t, s, q, "1", "2", "TGV") for t, s, q in rows],
                                   "feed string, trip_id string, stop_id string, stop_sequence int, departure_time string, arrival_time string, base_type string")
        stops = spark.createDataFrame([("F", s, s, "45", "5") for s in "ABC"],
                                      "feed string, stop_id string, stop_name string, stop_lat string, stop_lon string")
        served = timetable.with_pattern(timetable.served_stops(df, stops))
        return {r.trip_id: (r.pattern_1, r.pattern_2) for r in served.distinct().collect()}

    got = patterns([("1", "A", 1), ("1", "B", 2), ("2", "B", 1), ("2", "A", 2), ("3", "B", 2), ("3", "A", 1), ("4", "A", 1),
                    ("5", "A", 1), ("5", "B", 2), ("5", "A", 3), ("6", "A", 1), ("6", "B", 2), ("6", "C", 3)])
    assert got["1"] == got["3"] and len(set(got.values())) == 5


def test_trip_lengths_of_a_trip_longer_than_a_partition(spark):
    """One trip has a third and more of all calls and is cut into runs; its length is unchanged."""
    rng = random.Random(8)
    calls = [("hot", rng.randint(1, 400), rng.randint(0, 29)) for _ in range(3000)]
    calls += [(f"t{rng.randint(0, 99)}", rng.randint(1, 9), rng.randint(0, 29)) for _ in range(3000)]
    places = {i: (45 + i * 0.1, 2 + i * 0.07) for i in range(29)}  # stop 29 has no place
    df = spark.createDataFrame(calls, "trip_id string, stop_sequence int, stop_id int")
    stops = spark.createDataFrame([(i, *p) for i, p in places.items()], "stop_id int, lat double, lon double")
    lengths = timetable.trip_lengths(df, stops, ["trip_id"], ["stop_sequence", "stop_id"], ["stop_id"])
    got = {r.trip_id: r.stop_distance_km for r in lengths.collect()}
    for trip in {c[0] for c in calls}:
        ordered = [places.get(s) for _, _, s in sorted(c for c in calls if c[0] == trip)]
        segments = [km(a, b) for a, b in zip(ordered, ordered[1:]) if a and b]
        assert got[trip] == (pytest.approx(sum(segments)) if segments else None), trip


def test_night_sheet(spark):
    tabs = {
        "routes": spark.createDataFrame([("1", "102"), ("2", "2")], "route_id string, vehicule_type string"),
        "trips": spark.createDataFrame(
            [("1", "Paris", "Wien", None, "20:00", "08:00"), ("2", "Paris", "#N/A", "NJ 1", None, None),
             ("2", "Paris", "Nice", "Intercités de Nuit", None, None), ("9", " ", "Nice", None, None, None)],
            "route_id string, trip_origin string, trip_headsign string, trip_short_name string, "
            "origin_departure_time string, destination_arrival_time string",
        ),
        # a name listed twice must not double the trips
        "stops": spark.createDataFrame([("Paris", "48.8", "2.3"), ("Paris", "48.9", "2.4"), ("Wien", "x", "16")],
                                       "station_name string, station_lat string, station_long string"),
    }
    got = rows(sheet_legs(tabs), "origin", "destination", "vehicule_type", "station_lat", "station_lat_dest")
    assert got == [
        ("Paris", "Nice", "Intercités Nuit", 48.8, None), ("Paris", "Wien", "Train Nuit", 48.8, None),
    ]


# --- keep one -------------------------------------------------------------------
def test_keep_first_is_the_same_on_every_layout(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 30)}", rng.randint(0, 5), str(rng.random())) for _ in range(2000)]
    df = spark.createDataFrame(data, "k string, o int, v string")
    want = sorted({k: min((o, v) for kk, o, v in data if kk == k) for k, _, _ in data}.items())
    for n in (1, 4, 32):
        got = rows(keep_first(df.repartition(n), ["k"], ["o"]))
        assert [(k, (o, v)) for k, o, v in got] == want
    once = keep_first(df, ["k"], ["o"])
    assert rows(keep_first(once, ["k"], ["o"])) == rows(once)


# --- names ----------------------------------------------------------------------
FOOTFALL = [("Paris Gare de Lyon", 100.0, 0), ("Lyon Part Dieu", 50.0, 1), ("Lyon", 7.0, 2), ("Lyon", 9.0, 3)]


def folded_names(spark, names):
    return spark.createDataFrame([(n,) for n in names], "norm string")


def test_tiered_lookup(spark):
    reference = lookups.fold_reference(spark.createDataFrame(FOOTFALL, "name string, value double, ord long"))
    names = folded_names(spark, ["LYON PART DIEU", "LYON", "GARE LYON PART DIEU TER", "PART DIEU", "GENEVE", "P", ""])
    got = {r.norm: (r.value, r.tier) for r in lookups.tiered_lookup(names, reference).collect()}
    assert got == {
        "LYON PART DIEU": (50.0, 1), "LYON": (9.0, 1), "GARE LYON PART DIEU TER": (50.0, 2),
        "PART DIEU": (50.0, 3), "P": (100.0, 3),
    }


def test_sketches_of_feeds_unite_to_the_distinct_counts(spark):
    """Stored per feed, united in any grouping, within four standard errors of the exact count; a feed counted twice changes nothing."""
    rng = random.Random(13)
    rides = spark.createDataFrame(
        [(f"f{k % 5}", f"s{rng.randint(0, 9000)}", f"s{rng.randint(4000, 20000)}") for k in range(30_000)] + [("f9", None, "s1")],
        "provider string, origin string, destination string",
    )
    sketches = profile.end_sketches(rides, ["provider"]).cache()
    exact = profile.distinct_ends(rides).first()
    once, twice = (profile.united_ends(df).first() for df in (sketches, sketches.unionByName(sketches)))
    assert once == twice
    for name in ("origins", "destinations", "stations"):
        assert abs(once[name] / exact[name] - 1) < 4 * 1.04 / 2 ** (profile.SKETCH_BITS / 2)
    assert profile.united_ends(sketches, ["provider"]).count() == 6


def test_short_names_never_pair(spark):
    """One- and two-letter names on both sides: the hits of brute force, from one row per name and piece at most."""
    rng = random.Random(21)
    letters = "ABÉ C"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n)).strip()
    norms = sorted({text(rng.randint(1, 5)) for _ in range(150)} - {""})
    refs = sorted({text(rng.randint(1, 4)) for _ in range(120)} | {"A", "B", "AB"})
    rng.shuffle(refs)
    names = spark.createDataFrame([(n,) for n in norms], "norm string")
    reference = spark.createDataFrame([(r, f"v{k}", k) for k, r in enumerate(refs)], "ref string, value string, ord long")
    want = {}
    for n in norms:
        hits = [(1 if r == n else 2 if r in n else 3, k, f"v{k}") for k, r in enumerate(refs) if r and (r in n or n in r)]
        if hits:
            want[n] = (min(hits)[2], min(hits)[0])
    found = lookups.tiered_lookup(names, reference)
    assert {r.norm: (r.value, r.tier) for r in found.collect()} == want and found.count() == len(want)
    assert lookups.short_around(names, reference).count() == len([n for n in norms if len(n) < 3 and any(n in r for r in refs)])
    assert lookups.contained_pairs(reference, names, "ref", "norm").where("length(ref) < 3").isEmpty()


def test_tiered_lookup_equals_brute_force(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("AB ") for _ in range(rng.randint(1, 7))).strip()
    names = sorted({word() for _ in range(60)} - {""})
    refs = [(w, float(i), i) for i, w in enumerate(dict.fromkeys(word() for _ in range(60))) if w]
    want = {}
    for n in names:
        hits = [(1 if r == n else 2 if r in n else 3, o, r, v) for r, v, o in refs if r in n or n in r]
        if hits:
            want[n] = (min(hits)[3], min(hits)[0])
    reference = spark.createDataFrame(refs, "ref string, value double, ord long")
    got = {r.norm: (r.value, r.tier) for r in lookups.tiered_lookup(folded_names(spark, names), reference).collect()}
    assert got == want


def test_prefix_lookup(spark):
    communes = spark.createDataFrame(
        [("Lyon", 500000.0), ("Lyon", 10.0), ("Saint-Étienne", 170000.0), ("Gare", 5.0)], "name string, population double"
    )
    table = lookups.largest_by_name(communes, ["name"])
    names = folded_names(spark, ["LYON PART DIEU", "SAINT ETIENNE CHATEAUCREUX", "GARE DE LYON", "AEROPORT DE LYON", "GENEVE"])
    got = {r.norm: r.population for r in lookups.prefix_lookup(names, table).collect()}
    assert got == {
        "LYON PART DIEU": 500000.0, "SAINT ETIENNE CHATEAUCREUX": 170000.0, "GARE DE LYON": 5.0, "AEROPORT DE LYON": 500000.0,
    }
    second = spark.createDataFrame([("GENEVE", 200000.0), ("LYON", 1.0)], "key string, population double")
    both = {r.norm: r.population for r in lookups.prefix_lookup_with_fallback(names, table, second).collect()}
    assert both == {**got, "GENEVE": 200000.0}


# --- cubes ----------------------------------------------------------------------
def test_cube_decode(spark):
    doc = """{"id": ["freq", "geo", "time"], "size": [1, 2, 2], "value": {"0": 10, "2": 20, "3": 30},
      "dimension": {"freq": {"category": {"index": {"A": 0}}}, "geo": {"category": {"index": {"FR": 0, "DE": 1}}},
      "time": {"category": {"index": {"2020": 0}}}}}"""
    from railmart.sources.cube import CUBE_SCHEMA

    cubes = spark.createDataFrame([(doc,)], "doc string").select(F.from_json("doc", CUBE_SCHEMA).alias("d")).select("d.*")
    got = rows(cube_columns(decode_cube(cubes), ["freq", "geo", "time"]))
    assert got == [("A", "DE", "1", 30.0), ("A", "DE", "2020", 20.0), ("A", "FR", "2020", 10.0)]


def test_cube_positions_beyond_doubles(spark):
    """The last cell of a cube of more than 2^53 cells; a quotient in double rounds it up to a whole stride."""
    from railmart.sources.cube import CUBE_SCHEMA

    size = 2**31 - 1
    doc = json.dumps({"id": ["a", "b"], "size": [size, size], "value": {str(size * size - 1): 1.5}, "dimension": {}})
    cubes = spark.createDataFrame([(doc,)], "doc string").select(F.from_json("doc", CUBE_SCHEMA).alias("d")).select("d.*")
    got = decode_cube(cubes).select("flat", F.col("codes")["a"].alias("a"), F.col("codes")["b"].alias("b")).collect()
    assert [tuple(r) for r in got] == [(size * size - 1, str(size - 1), str(size - 1))]


# --- numbers --------------------------------------------------------------------
def test_dense_ids_have_no_gaps(spark):
    names = [f"n{i:04d}" for i in random.Random(2).sample(range(5000), 700)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(9)
    got = {r.name: r.id for r in dense_ids(df, ["name"], "id").collect()}
    assert got == {n: i for i, n in enumerate(sorted(names), 1)}


def test_rank_by_hash_with_a_hot_and_a_null_class(spark):
    data = [(i, "hot" if i % 3 else None if i % 2 else "cold") for i in range(1500)]
    df = spark.createDataFrame(data, "id long, kind string")
    got = rank_by_hash(df, ["id"], F.xxhash64("id"), within=["kind"]).collect()
    for kind in ("hot", "cold", None):
        ranks = sorted(r["rank"] for r in got if r.kind == kind)
        n = sum(1 for _, k in data if k == kind)
        assert ranks == list(range(1, n + 1))
        assert {r.total for r in got if r.kind == kind} == {n}


def test_split_is_exact_disjoint_and_layout_free(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1000)], "id long, y int")
    got = split.exact_split(df, ["id"], ["y"])
    counts = {(r.y, r.split): r["count"] for r in got.groupBy("y", "split").count().collect()}
    assert counts == {(1, "train"): 70, (1, "val"): 15, (1, "test"): 15,
                      (0, "train"): 630, (0, "val"): 135, (0, "test"): 135}
    assert rows(got) == rows(split.exact_split(df.repartition(13), ["id"], ["y"]))


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(10)], "a double, b double")
    scaled = split.apply_scaler(df, split.fit_scaler(df, ["a", "b"]), ["a", "b"]).collect()
    a = np.array([r.a for r in scaled])
    assert abs(a.mean()) < 1e-12 and abs(a.std() - 1) < 1e-12
    assert {r.b for r in scaled} == {0.0}


@pytest.mark.parametrize("by", [None, ["g"]])
def test_quantiles_are_exact(spark, by):
    rng = np.random.default_rng(4)
    x = np.concatenate([np.round(rng.normal(0, 50, 3000), 1), np.full(2000, 7.0)])  # a hot value
    g = rng.integers(0, 3, len(x))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, x)] + [(0, None)], "g int, x double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    for row in exact_quantiles(df, "x", shares, by).collect():
        part = x if by is None else x[g == row.g]
        assert row.quantiles == pytest.approx(np.quantile(part, shares), abs=1e-9)


def test_the_largest_sorted_bucket_does_not_grow(spark):
    """Thirty times the values: more narrowings, no larger bucket, and the same quantiles as from one sorted array."""
    shares = [0.01, 0.5, 0.77]
    sizes = {}
    for n in (3_000, 90_000):
        x = np.random.default_rng(n).exponential(size=n)
        df = spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate(x)], "g int, x double")
        counted = df.groupBy("g", "x").agg(F.count("*").alias("n"))
        times = quantiles.narrowings(counted, 30)
        kept = quantiles.wanted_buckets(counted, shares, ["g"], times)
        sizes[n] = (times, max(r["count"] for r in kept.groupBy("g", "bucket").count().collect()))
        for row in exact_quantiles(df, "x", shares, ["g"], largest=30).collect():
            assert row["quantiles"] == pytest.approx(np.quantile(x[row.g::2], shares), abs=1e-12)
    assert sizes[3_000][0] == 1 and sizes[90_000][0] == 2
    assert sizes[90_000][1] <= sizes[3_000][1] <= 60


def test_quantiles_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]).first().quantiles == [None]
    assert exact_quantiles(df.fillna(3.0), "x", [0.5, 1.0]).first().quantiles == [3.0, 3.0]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(float(i), 2.0, float(-i) if i % 2 else None) for i in range(10)], "a double, c double, n double")
    got = {(r.a, r.b): r["corr"] for r in profile.correlations(df, ["a", "c", "n"]).collect()}
    assert got["a", "c"] is None and got["c", "c"] is None
    assert got["a", "n"] == pytest.approx(-1.0) and got["n", "a"] == got["a", "n"]


def test_histogram_holds_the_maximum_and_empty_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 1, 10)], "x double")
    assert [r.n for r in profile.histogram(df, "x", 5).orderBy("bin").collect()] == [3, 0, 0, 0, 1]
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r.n for r in profile.histogram(same, "x", 2).orderBy("bin").collect()] == [2, 0]


def test_sample_is_reproducible(spark):
    df = spark.range(1000)
    assert rows(split.sample_rows(df, ["id"], 20)) == rows(split.sample_rows(df.repartition(7), ["id"], 20))


def test_correlations_keep_digits_beside_a_far_value(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=500)
    y = x + rng.normal(size=500)
    x[7], z = -1e9, rng.normal(size=500) + 1e4
    df = spark.createDataFrame([(float(a), float(b), float(c), 5.0) for a, b, c in zip(x, y, z)], "x double, y double, z double, k double")
    found = {(r.a, r.b): r["corr"] for r in profile.correlations(df.repartition(5), ["x", "y", "z", "k"]).collect()}
    want = np.corrcoef([x, y, z])
    for i, a in enumerate("xyz"):
        assert found[a, "k"] is found["k", a] is None
        for j, b in enumerate("xyz"):
            assert found[a, b] == pytest.approx(want[i, j], abs=1e-7)
    assert found["k", "k"] is None
