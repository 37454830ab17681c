"""Pairs of places in reach, dealt over all tasks however small the tables are."""

import pytest
from pyspark.sql import functions as F

from railmart.operators.nearest import nearby_pairs

COLUMNS = ["station_name", "iata_code", "station_airport_km"]


@pytest.fixture
def places(spark):
    points = spark.range(200, numPartitions=1).selectExpr(
        "concat('S', id) AS station_name", "IF(id = 7, NULL, 48.0 + id % 10 / 100) AS station_lat", "2.0 + id % 7 / 10 AS station_long"
    )
    airports = spark.range(12, numPartitions=1).selectExpr(
        "concat('A', id) AS iata_code", "47.5 + id / 10 AS aero_lat", "2.0 + id % 3 / 2 AS aero_long", "'' AS airport_name", "'' AS country_code"
    )
    return points, airports


@pytest.mark.parametrize("band", [1.0, None])
def test_a_spread_changes_no_pair(places, band):
    rows = [sorted(map(tuple, nearby_pairs(*places, band=band, spread=n).select(*COLUMNS).collect())) for n in (1, 4)]
    assert rows[0] == rows[1] and 0 < len(rows[0]) < 200 * 12


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_pairs_of_one_small_file_are_made_by_several_tasks(spark, places, broadcast):
    """One file is one split, and small shuffles are put together: without a spread a single task makes all pairs."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        tasks = nearby_pairs(*places).groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < sum(r["count"] for r in tasks) * 0.7
