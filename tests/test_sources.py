import json
import zipfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from railmart.operators.timetable import timetable_legs
from railmart.plans import warehouse
from railmart.schemas import keep_existing, rename_existing, typed
from railmart.sources import archive, catalogue, cube, files, night_sheet, population, snapshots
from railmart.sources.airports import read_airports
from railmart.sources.gtfs import read_feeds
from railmart.streaming.feeds import load_new_feeds
from tests import mini
from tests.helpers import rows


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    return mini.write_all(tmp_path_factory.mktemp("landed"))


def test_csv_is_text_with_blank_as_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a,b"\n2,  \n3\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("y,z,x\nq,9,4\n", encoding="utf-8")
    df = files.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], ["x", "y", "none"])
    assert rows(df) == [("1", "a,b", None), ("2", None, None), ("3", None, None), ("4", "q", None)]


def test_many_headers_are_one_scan(spark, tmp_path):
    want = []
    for k in range(12):
        names = ["x", "y", "z"][k % 3:] + [f"own{k}"]
        (tmp_path / f"f{k:02d}.csv").write_text(
            "\ufeff" * (k % 2) + ",".join(f'"{n}"' for n in names) + "\n" + ",".join(f"{n}{k}" for n in names) + "\n\n", encoding="utf-8"
        )
        want.append((f"x{k}" if "x" in names else None, f"z{k}", f"f{k:02d}.csv"))
    df = files.read_csv(spark, sorted(map(str, tmp_path.glob("*.csv"))), ["x", "z"], with_path=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    assert [(r.x, r.z, r.path.rsplit("/", 1)[-1]) for r in df.orderBy("path").collect()] == want


def test_newest_airports(spark, landed):
    got = read_airports(spark, landed["airports"])
    assert sorted(r.iata_code for r in got.collect()) == ["BSL", "CDG", "CGN", "FRA", "LYS", "MRS", "ORY"]


def test_footfall_with_bom_and_year_fallback(spark, landed, tmp_path):
    got = population.read_footfall(spark, landed["lists"])
    assert [(r.name, r.value) for r in got.orderBy("ord").collect()] == [
        ("Paris Gare de Lyon", 100.0), ("Lyon Part Dieu", 50.0), ("Lyon", 7.0), ("Lyon", 9.0)
    ]
    (tmp_path / "sncf_frequentation_2025-01-01.csv").write_text(
        "Nom de la gare;Total Voyageurs 2023\nA;5\n;6\nB;?\n", encoding="utf-8"
    )
    assert rows(population.read_footfall(spark, str(tmp_path)), "name", "value") == [("A", 5.0), ("B", None)]


def test_communes_and_gazetteer(spark, landed, tmp_path):
    assert ("Saint-Étienne", 170000.0) in rows(population.read_communes(spark, landed["lists"]))
    assert ("Koeln", "Köln", 1000000.0) in rows(population.read_gazetteer(spark, landed["lists"]))
    path = tmp_path / "communes.json"
    path.write_text(json.dumps([{"nom": "Ain", "code": "01001", "population": 7}, {"nom": "B"}]), encoding="utf-8")
    assert rows(population.read_communes_json(spark, str(path)), "nom", "code", "population") == [
        ("Ain", "01001", 7), ("B", None, None)
    ]


def test_gazetteer_dump(spark, tmp_path):
    def line(name, country, n=19):
        fields = ["1", name, name.lower(), "", "48.1", "2.2", "P", "PPL", country, "", "", "", "", "", "1000", "", "", "", ""]
        return "\t".join(fields[:n])

    path = tmp_path / "cities.txt"
    path.write_text("\n".join([line('Pa"ris', "FR"), line("Tokyo", "JP"), line("Short", "FR", 14),
                               line("Empty", "FR", 15).replace("1000", "")]), encoding="utf-8")
    for _ in range(2):  # a second call reads the same
        assert rows(population.read_gazetteer_dump(spark, str(path))) == [
            ("Empty", "empty", "FR", None, "48.1", "2.2"), ('Pa"ris', 'pa"ris', "FR", "1000", "48.1", "2.2")
        ]


def test_catalogue(spark, tmp_path):
    feeds = [
        {"id": "f1", "provider": "SNCF: Voyageurs", "feed_name": None, "country": "FR", "latest_dataset": {"hosted_url": "u1"}},
        {"id": "f2", "provider": "City Tram", "country": "FR", "latest_dataset": {"hosted_url": "u2"}},
        {"id": "f3", "provider": None, "country": "FR", "latest_dataset": {"hosted_url": "u3"}},
        {"id": "f4", "provider": "DB", "country": "DE", "latest_dataset": None},
        {"id": "f5", "provider": "SBB", "country": "CH", "latest_dataset": {"hosted_url": ""}},
    ]
    path = tmp_path / "feeds.json"
    path.write_text(json.dumps(feeds), encoding="utf-8")
    got = rows(catalogue.feeds_to_load(catalogue.read_catalogue(spark, str(path))), "folder", "url")
    assert got == [("FR_SNCF_Voyageurs_f1", "u1"), ("FR_Unknown_f3", "u3")]


def test_cube_file(spark, tmp_path):
    path = tmp_path / "cube.json"
    path.write_text(json.dumps({
        "id": ["geo", "time"], "size": [2, 1], "value": {"1": 5},
        "dimension": {"geo": {"category": {"index": {"FR": 0, "DE": 1}}}, "time": {"category": {"index": {"2020": 0}}}},
    }), encoding="utf-8")
    got = cube.cube_columns(cube.decode_cube(cube.read_cubes(spark, str(path))), ["geo", "time"])
    assert rows(got) == [("DE", "2020", 5.0)]


def test_archives_give_the_same_legs_as_folders(spark, landed, tmp_path):
    for feed, tables in (("FR_demo_1", mini.FR), ("DE_demo_2", mini.DE), ("XX_broken_3", {"stops": mini.STOPS})):
        with zipfile.ZipFile(tmp_path / f"{feed}.zip", "w") as z:
            for table, content in tables.items():
                z.writestr(f"{table}.txt", content)
    archive.unpack(spark, str(tmp_path / "*.zip"), str(tmp_path / "tables"))
    unpacked = timetable_legs(archive.read_unpacked(spark, str(tmp_path / "tables")))
    assert rows(unpacked) == rows(timetable_legs(read_feeds(spark, landed["gtfs"])))


def test_snapshot_is_written_once_a_day(spark, tmp_path):
    root = str(tmp_path / "snap")
    assert snapshots.write_snapshot(spark.range(2), root, "2026-01-01")
    assert not snapshots.write_snapshot(spark.range(9), root, "2026-01-01")
    assert snapshots.write_snapshot(spark.range(3), root, "2026-01-02")
    assert snapshots.write_snapshot(spark.range(4), root, "2026-01-02", replace=True)
    assert spark.read.parquet(root).count() == 6


def test_night_sheet_needs_both_ends(spark, tmp_path):
    for tab, text in {
        "routes": "route_id,vehicule_type\n1,2\n", "stops": "station_name,station_lat,station_long\nA,1,2\n",
        "trips": "route_id,trip_origin\n1,A\n",
    }.items():
        (tmp_path / f"back_on_track_{tab}.csv").write_text(text, encoding="utf-8")
    assert night_sheet.read_night_sheet(spark, str(tmp_path)) is None
    (tmp_path / "back_on_track_trips.csv").write_text("route_id,trip_origin,trip_headsign\n1,A,B\n", encoding="utf-8")
    assert night_sheet.read_night_sheet(spark, str(tmp_path))["trips"].count() == 1


def test_tolerant_projection(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    assert keep_existing(df, ["b", "nope"]).columns == ["b"]
    assert rename_existing(df, {"a": "b", "b": "c", "z": "y"}).columns == ["a", "c"]
    assert rows(typed(df, {"b": "double", "n": "int", "a": "int"})) == [(None, None, 1)]


def test_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([("Köln", 1.5)], "a string, b double")
    warehouse.write_csv(df, str(tmp_path / "plain"))
    warehouse.write_csv(df, str(tmp_path / "packed"), gzip=True)
    assert any(p.name.endswith(".csv.gz") for p in (tmp_path / "packed").iterdir())
    for name in ("plain", "packed"):
        assert rows(spark.read.option("header", True).csv(str(tmp_path / name))) == [("Köln", "1.5")]


def test_new_feeds_are_loaded_once(spark, tmp_path):
    root, seen = tmp_path / "gtfs", []
    load = lambda legs: seen.append(sorted({r.provider for r in legs.collect()}))
    mini.write_feed(root, "FR_demo_1", mini.FR)
    for _ in range(2):
        load_new_feeds(spark, str(root), str(tmp_path / "progress"), load)
    mini.write_feed(root, "DE_demo_2", mini.DE)
    load_new_feeds(spark, str(root), str(tmp_path / "progress"), load)
    assert seen == [["FR_demo_1"], ["DE_demo_2"]]
    (root / "IT_half").mkdir()  # a feed without its other tables is passed over
    (root / "IT_half" / "stop_times.txt").write_text("trip_id,stop_id\n1,2\n", encoding="utf-8")
    load_new_feeds(spark, str(root), str(tmp_path / "progress"), load)
    assert len(seen) == 2


def test_row_counts_come_with_the_job(spark):
    from pyspark.sql import Observation

    from railmart.operators.profile import counted

    seen = Observation("stage")
    assert counted(spark.range(3), seen).where("id > 0").count() == 2
    assert seen.get == {"rows": 3}
    seen = Observation("n")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    assert seen.get == {"rows": 5}
