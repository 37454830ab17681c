import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from railmart.operators import profile
from railmart.operators.nearest import nearest_airports, stations_of
from railmart.plans import modelling, pipeline, queries, report, warehouse
from railmart.sources.airports import read_airports
from railmart.sources.gtfs import find_feeds, parse_countries, read_feeds
from railmart.sources.population import read_communes, read_footfall, read_gazetteer
from tests import mini
from tests.helpers import rows


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    return mini.write_all(tmp_path_factory.mktemp("landed"))


@pytest.fixture(scope="module")
def tables(spark, landed, tmp_path_factory):
    return pipeline.run(
        spark,
        str(tmp_path_factory.mktemp("work")),
        timetables=read_feeds(spark, landed["gtfs"]),
        airports=read_airports(spark, landed["airports"]),
        footfall=read_footfall(spark, landed["lists"]),
        communes=read_communes(spark, landed["lists"]),
        gazetteer=read_gazetteer(spark, landed["lists"]),
    )


def test_feeds_are_filtered(spark, landed):
    assert list(find_feeds(spark, landed["gtfs"])) == ["DE_demo_2", "FR_demo_1"]
    assert list(find_feeds(spark, landed["gtfs"], ["FR"])) == ["FR_demo_1"]
    assert parse_countries("FR, de") == parse_countries("['FR','DE']") == ["FR", "DE"]
    assert read_feeds(spark, landed["gtfs"], ["IT"]) is None


def test_columns_are_placed_by_each_feeds_own_header(spark, landed):
    stops = read_feeds(spark, landed["gtfs"])["stops"]
    assert ("B", "Basel SBB", "47.5474", "7.5896", "DE_demo_2") in rows(stops)


def test_fact(tables):
    got = {
        (r.origin, r.destination, r.vehicule_type): (
            r.distance_km, r.co2_train_kg, r.co2_avion_kg, r.co2_saved_kg, r.is_substitutable
        )
        for r in tables["fact"].collect()
    }
    assert got.keys() == mini.EXPECTED.keys()
    for key, want in mini.EXPECTED.items():
        assert got[key] == pytest.approx(want, abs=6e-5), key


def test_nearest_airports(tables):
    got = {r.station_name: (r.iata_code, r.station_airport_km) for r in tables["airport_links"].collect()}
    assert got.keys() == mini.NEAREST.keys()
    for name, (iata, km) in mini.NEAREST.items():
        assert got[name][0] == iata and got[name][1] == pytest.approx(km, abs=6e-5)


def test_dimensions(tables):
    assert {r.service_type for r in tables["dim_vehicle_type"].collect()} == {"TGV", "ICE", "ICE Nuit"}
    assert tables["dim_station_frequentation"].count() == tables["dim_route"].count() == 6
    stations = {r.station_name: r for r in tables["dim_station_frequentation"].collect()}
    assert stations["Lyon Part-Dieu"].annual_station_traffic == 50
    assert stations["Paris Gare de Lyon"].annual_station_traffic == 100
    assert stations["Köln Hbf"].annual_station_traffic is None
    assert stations["Lyon Part-Dieu"].city_population == 500000
    assert stations["Köln Hbf"].city_population == 1000000
    assert stations["Frankfurt(Main)Hbf"].city_population == 700000


def test_wide_fact_has_the_18_columns(tables):
    assert len(tables["fact_wide"].columns) == 18
    row = tables["fact_wide"].where("origin = 'Lyon Part-Dieu'").first()
    assert (row.origin_station_traffic, row.dest_city_population) == (50, 860000)


def test_result_does_not_depend_on_layout(spark, landed):
    def fact(n):
        feeds = {k: v.repartition(n) for k, v in read_feeds(spark, landed["gtfs"]).items()}
        airports = read_airports(spark, landed["airports"]).repartition(n)
        rail = pipeline.rail_routes(pipeline.all_legs(feeds, None))
        links = nearest_airports(stations_of(rail), airports)
        return rows(pipeline.star_schema(pipeline.final_routes(rail, links))["fact"])

    assert fact(1) == fact(7)


def test_load_reset_then_incremental(spark, tables, tmp_path):
    root = str(tmp_path / "warehouse")
    first = warehouse.load_star(spark, root, tables)
    assert first == {
        "dim_station_frequentation": 6, "dim_route": 6, "dim_vehicle_type": 3, "fact_route_analysis": 6,
    }
    assert warehouse.load_star(spark, root, tables, mode="incremental") == first
    star = warehouse.read_star(spark, root)
    assert dict(star["fact_route_analysis"].dtypes)["co2_train_kg"] == "decimal(10,4)"
    assert dict(star["dim_route"].dtypes)["distance_km"] == "decimal(10,3)"

    new_fact = tables["fact"].where("origin = 'Basel SBB'").withColumn("origin", F.lit("Zug"))
    extra = pipeline.star_schema(tables["routes_final"])
    extra["fact"] = new_fact
    extra["dim_route"] = extra["dim_route"].where("dep_name = 'Basel SBB'").withColumns(
        {"dep_name": F.lit("Zug"), "route_id": F.xxhash64(F.lit("Zug"), "arr_name")}
    )
    second = warehouse.load_star(spark, root, extra, mode="incremental")
    assert second["dim_route"] == 8 and second["fact_route_analysis"] == 8


def test_a_load_that_breaks_off_leaves_the_old_star(spark, tables, tmp_path, monkeypatch):
    root = str(tmp_path / "warehouse")
    first = warehouse.load_star(spark, root, tables)
    before = warehouse.current_version(spark, root)
    written = warehouse.write_parquet

    def break_off(df, path):
        if path.endswith("dim_vehicle_type"):
            raise RuntimeError("lost")
        written(df, path)

    monkeypatch.setattr(warehouse, "write_parquet", break_off)
    with pytest.raises(RuntimeError):
        warehouse.load_star(spark, root, tables)
    monkeypatch.undo()
    assert warehouse.current_version(spark, root) == before
    assert {name: df.count() for name, df in warehouse.read_star(spark, root).items()} == first
    assert sorted(p.name for p in (tmp_path / "warehouse").iterdir()) == sorted(["_published", before.rsplit("/", 1)[1]])


def test_a_damaged_table_is_not_taken_for_absent(spark, tables, tmp_path):
    root = str(tmp_path / "warehouse")
    warehouse.load_star(spark, root, tables)
    version = Path(warehouse.current_version(spark, root))
    for part in (version / "dim_route").glob("*.parquet"):
        part.write_bytes(b"broken")
    with pytest.raises(Exception):
        warehouse.load_star(spark, root, tables, mode="incremental")
    assert warehouse.current_version(spark, root) == str(version)


def test_old_versions_go(spark, tables, tmp_path):
    root = str(tmp_path / "warehouse")
    for _ in range(3):
        warehouse.load_star(spark, root, tables)
    assert len([p for p in (tmp_path / "warehouse").iterdir() if p.name.startswith("v-")]) == 2


def test_load_refuses_numbers_beyond_their_column(spark, tables, tmp_path):
    root = str(tmp_path / "w")
    large = dict(tables, fact=tables["fact"].withColumn("co2_train_kg", F.lit(1234567.5)))
    with pytest.raises(warehouse.LoadError):
        warehouse.load_star(spark, root, large)
    with pytest.raises(warehouse.LoadError):
        warehouse.read_star(spark, root)


def test_load_refuses_duplicate_keys(spark, tables, tmp_path):
    broken = dict(tables, dim_route=tables["dim_route"].union(tables["dim_route"]))
    with pytest.raises(warehouse.LoadError):
        warehouse.load_star(spark, str(tmp_path / "w"), broken)
    with pytest.raises(ValueError):
        warehouse.load_star(spark, str(tmp_path / "w"), tables, mode="other")


@pytest.fixture(scope="module")
def view(spark, tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    warehouse.load_star(spark, root, tables)
    star = warehouse.read_star(spark, root)
    return queries.data_view(
        star["fact_route_analysis"], star["dim_route"], star["dim_vehicle_type"]
    ).cache()


def test_view_and_search(view):
    assert view.count() == 12
    hits = queries.search(view, "PARIS", "lyon")
    assert {r.vehicule_type for r in hits.collect()} == {"TGV", "Avion"}
    assert queries.search(view, "paris", "lyon", "tgv").count() == 1
    assert queries.search(view, "nowhere", "lyon").count() == 0


def test_compare(view):
    row = queries.compare(view, "frankfurt", "köln").first()
    assert (row.day_n, row.night_n, row.gain_pct, row.advice) == (1, 0, 0.0, "no_night_train")
    assert queries.compare(view, "Basel", "Köln").count() == 0
    assert "nuit" in queries.advice_text(row.asDict())


def test_report_tables_have_rows(tables, view):
    for name, df in {**report.report(tables["routes_final"]), **report.charts(view),
                     **report.dashboard(view), **report.explore(tables["fact_wide"])}.items():
        # the report's word list for trains knows none of TGV and ICE
        if name not in ("train_types", "nulls"):
            assert not df.isEmpty(), name
    assert report.report(tables["routes_final"])["coverage"].first().stations == 6
    quality = report.dashboard(view)["quality"].first()
    total = sum(r.nulls for r in report.dashboard(view)["nulls"].collect())
    assert (quality.rows, quality.nulls) == (view.count(), total)


def test_sections_hold_the_values_of_every_table(tables, view):
    """The report as one long relation: each row of each section, read back from its JSON."""
    parts = report.report(tables["routes_final"]) | report.dashboard(view)
    found = {}
    for r in profile.sections(parts).collect():
        found.setdefault(r.section, []).append(json.loads(r.row))
    for name, df in parts.items():
        want = [json.loads(t) for t in df.toJSON().collect()]
        assert sorted(found.get(name, []), key=repr) == sorted(want, key=repr), name
    assert found["coverage"][0]["stations"] == 6


def test_model_tables(tables, tmp_path, spark):
    model = modelling.prepare(tables["fact_wide"])
    assert [r.vehicule_type for r in model.encoder.orderBy("code").collect()] == ["ICE", "ICE Nuit", "TGV"]
    assert model.classification.count() == 6
    assert model.regression.count() == 6
    warehouse.save_parameters(model.encoder, model.scaler, str(tmp_path))
    warehouse.write_splits({"m1": model.classification, "m2": model.regression}, str(tmp_path / "ml"))
    again = spark.read.parquet(str(tmp_path / "ml" / "model=m1"))
    assert {r.split for r in again.select("split").collect()} <= {"train", "val", "test"}
    scaler = {r.feature: r for r in spark.read.parquet(str(tmp_path / "scaler")).collect()}
    assert len(scaler) == 8
