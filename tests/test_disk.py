"""What steps leave on disk while later ones run."""

import time
from pathlib import Path

import pytest

from railmart import session
from railmart.catalog import fact, geo
from railmart.catalog import standins as S
from railmart.plans import merging, warehouse
from tests.test_merging import A, B, airports, rail_of  # noqa: F401


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "shuffle_" in f}


def staged_tables(spark):
    return set(Path(session.staging_folder(spark).removeprefix("file:")).glob("*"))


def test_shuffles_of_a_staged_table_are_freed(spark):
    before = shuffle_files(spark)
    kept = session.cut_lineage(spark.range(1000, numPartitions=3).selectExpr("id % 7 AS k").groupBy("k").count())
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert kept.count() == 7
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"


@pytest.fixture
def tables(spark, airports, monkeypatch):  # noqa: F811
    monkeypatch.setattr(S, "rail", lambda *_: rail_of(spark, A, B))
    monkeypatch.setattr(S, "airports", lambda *_: airports)
    attributes = spark.createDataFrame([], "station_name string, annual_station_traffic long, city_population long")
    monkeypatch.setattr(fact, "station_attributes", lambda *_: attributes)


@pytest.mark.parametrize(("query", "left"), [
    (S.routes, 1), (fact.data_view, 3), (fact.fk_resolution, 4), (fact.fact_enriched, 1), (fact.model_rows, 1),
    (geo.map_lines_query, 1),
])
def test_tables_that_no_later_step_reads_are_dropped(spark, tables, query, left):
    before = staged_tables(spark)
    rows = query(spark, "")
    assert len(staged_tables(spark) - before) == left
    assert rows.count() > 0


def test_a_merge_drops_what_the_last_one_alone_has_read(spark, airports, tmp_path):  # noqa: F811
    root = str(tmp_path / "state")
    merging.merge(spark, root, rail_of(spark, A), airports)
    first = warehouse.current_version(spark, root)
    merging.merge(spark, root, rail_of(spark, B), airports)
    second = warehouse.current_version(spark, root)
    assert not Path(first, "touched").exists() and Path(first, "fact").exists()
    assert not {"mine", "rebuilt"} & {p.name for p in Path(second).iterdir()}
