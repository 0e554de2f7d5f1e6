from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarmac.plans.warehouse import MONTHLY_TABLES, WRITE_ORDER, Warehouse
from tarmac.sources.tables import layer_path, shared_folder, write_monthly

SF_DIR = "/root/testdata/sf0.001"
AS_OF = dt.datetime(2024, 3, 1)


def checksum(df) -> tuple:
    """Order-free fingerprint of a table."""
    return tuple(df.select(F.xxhash64(*sorted(df.columns)).alias("h")).agg(F.count("h"), F.expr("bit_xor(h)")).first())


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    return root, Warehouse.of_driver_tables(spark, SF_DIR, AS_OF).write(root)


def test_written_tables_equal_the_computed_ones(spark, written):
    _, paths = written
    fresh = Warehouse.of_driver_tables(spark, SF_DIR, AS_OF)
    for name in WRITE_ORDER:
        expected = getattr(fresh, name)
        assert checksum(spark.read.parquet(paths[name]).select(*expected.columns)) == checksum(expected), name


def test_layers_and_month_folders(spark, written):
    root, paths = written
    assert paths["route_stats"] == layer_path(root, "route_stats", "intermediate")
    assert layer_path(root, "x") == f"{root}/default/x" and layer_path(root, "x", " marts ") == f"{root}/marts/x"
    for name in MONTHLY_TABLES:
        assert "flight_month_start" in spark.read.parquet(paths[name]).columns


def test_a_month_filter_prunes_folders(spark, written):
    facts = spark.read.parquet(written[1]["fact_flights"])
    one = facts.filter(F.col("flight_month_start") == dt.date(2020, 5, 1)).select("arr_delay_minutes")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(flight_month_start" in plan and "ReadSchema: struct<arr_delay_minutes:double>" in plan
    assert 0 < len(one.inputFiles()) <= len(facts.inputFiles())


def test_overwriting_months_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")

    def table(day: str, value: int):
        return spark.createDataFrame([(dt.date.fromisoformat(day), value)], "d date, v int")

    month = F.col("d")
    write_monthly(table("2020-01-05", 1).union(table("2020-02-05", 2)), path, month, ["v"], "overwrite")
    write_monthly(table("2020-02-09", 3), path, month, ["v"], "overwrite")
    write_monthly(table("2020-02-10", 4), path, month, ["v"], "append")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3, 4]


def test_a_rebuild_drops_months_that_left_the_flights(spark, tmp_path):
    root = str(tmp_path)
    whole = Warehouse.of_driver_tables(spark, SF_DIR, AS_OF)
    whole.write(root)
    recent = whole.raw_flights.filter(F.col("FL_DATE") >= dt.date(2021, 1, 1))
    paths = Warehouse(recent, whole.raw_airlines, whole.raw_airports, AS_OF).write(root)
    for name in ("flights_enriched", "delay_classified", "fact_flights"):
        first = spark.read.parquet(paths[name]).agg(F.min("flight_month_start")).first()[0]
        assert first == dt.date(2021, 1, 1), name


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
