"""Results and plans when keys are hot, lookups are large and shared folders are missing."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

import pytest
from helpers import airports, lookup
from pyspark.sql import functions as F

from tarmac.operators import enrichment, profiling, quality, routes
from tarmac.operators.enrichment import enrich_flights
from tarmac.operators.staging import stage_airlines, stage_airports, stage_flights
from tarmac.plans.warehouse import Warehouse
from tarmac.sources import driver_tables, tables

SF_DIR = "/root/testdata/sf0.01"
AS_OF = dt.datetime(2024, 3, 1)


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fingerprint(df) -> tuple:
    return tuple(df.select(F.xxhash64(*sorted(df.columns)).alias("h")).agg(F.count("h"), F.expr("bit_xor(h)")).first())


def hot_flights(spark):
    """Driver flights with every third one moved to one carrier, route and day."""
    raw = driver_tables.raw_flights(spark, SF_DIR)
    hot = {
        "OP_UNIQUE_CARRIER": F.lit("AA"), "ORIGIN": F.lit("ATL"), "DEST": F.lit("LAX"),
        "ORIGIN_AIRPORT_ID": F.lit(10397), "DEST_AIRPORT_ID": F.lit(12892), "FL_DATE": F.lit(dt.date(2019, 8, 5)),
        "OP_CARRIER_FL_NUM": F.lit(1), "ORIGIN_STATE_ABR": F.lit("GA"), "DEST_STATE_ABR": F.lit("CA"),
        "DISTANCE": F.lit(1946.0),
    }
    third = F.col("OP_CARRIER_FL_NUM") % 3 == 0
    return raw.select(*[F.when(third, hot[c]).otherwise(F.col(c)).alias(c) if c in hot else F.col(c) for c in raw.columns])


def test_lookups_too_large_to_broadcast_give_the_same_rows(spark):
    def enriched():
        return Warehouse.of_driver_tables(spark, SF_DIR, AS_OF).flights_enriched

    expected = fingerprint(enriched())
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        shuffled = enriched()
        assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
        assert fingerprint(shuffled) == expected


def test_a_busy_airport_is_split_over_tasks(spark):
    flights = stage_flights(hot_flights(spark))
    many = lookup(spark, [(str(20000 + i), f"City{i}, TX: Airport {i}") for i in range(2000)])
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        flights = flights.repartition(6)
        joined = enrich_flights(flights, stage_airlines(many), stage_airports(airports(spark).union(many)))
        assert joined.select("flight_id", "origin_airport_name").write.format("noop").mode("overwrite").save() is None
        result = joined.select("flight_id", "origin_airport_name", "dest_airport_name")
        assert result.count() == flights.count()
        result.collect()
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()


def test_a_hot_route_month_keeps_its_exact_median(spark):
    enriched = Warehouse(
        hot_flights(spark), driver_tables.raw_airlines(spark, SF_DIR), driver_tables.raw_airports(spark, SF_DIR), AS_OF
    ).flights_enriched
    operated = routes.operated(enriched)
    keys = ["month_start", *routes.ROUTE_COLUMNS]
    exact = routes.with_month(operated).groupBy(*keys).agg(
        F.expr("percentile_disc(0.5) within group (order by arr_delay_minutes)").alias("expected")
    )
    stats = routes.route_month_stats(operated)
    assert stats.agg(F.max("total_operated_flights")).first()[0] > 15_000
    condition = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    wrong = stats.alias("a").join(exact.alias("b"), condition).filter(~F.col("median_arr_delay").eqNullSafe(F.col("expected")))
    assert wrong.count() == 0 and stats.count() == exact.count()


def test_hot_keys_are_combined_before_the_shuffle(spark):
    raw = hot_flights(spark)
    for df in (quality.natural_key_dups(raw), profiling.delay_counts(raw), quality.unique("t", raw, "OP_CARRIER_FL_NUM")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchange = plan.index("Exchange hashpartitioning")
        assert "partial_" in plan[exchange:]
    assert quality.natural_key_dups(raw).first().duplicate_rows > 15_000


def test_an_oversized_month_is_written_by_several_tasks(spark, tmp_path):
    raw = hot_flights(spark).repartition(8)  # a partition is cut between the map tasks that wrote it
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="512KB"):
        tables.write_monthly(raw, str(tmp_path / "t"), F.col("FL_DATE"), ["OP_UNIQUE_CARRIER", "ORIGIN"], "append")
    files = {
        month.name: len(list(month.glob("*.parquet"))) for month in (tmp_path / "t").iterdir() if month.is_dir()
    }
    hot = files.pop("flight_month_start=2019-08-01")
    assert hot >= 4 and hot >= max(files.values())
    assert spark.read.parquet(str(tmp_path / "t")).count() == raw.count()


def test_moments_match_the_builtin_functions(spark):
    raw = driver_tables.raw_flights(spark, SF_DIR)
    mine = profiling.delay_describe(raw).first()
    theirs = profiling.operated_delays(raw).agg(
        F.avg("ARR_DELAY").alias("mean"), F.stddev_samp("ARR_DELAY").alias("std"),
        F.percentile("ARR_DELAY", [0.25, 0.5, 0.75]).alias("q"), F.count("ARR_DELAY").alias("n"),
    ).first()
    assert mine["mean"] == pytest.approx(theirs["mean"], abs=1e-4) and mine["std"] == pytest.approx(theirs["std"], abs=1e-4)
    assert [mine["q25"], mine["median"], mine["q75"]] == theirs["q"] and mine["count"] == theirs["n"]


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "yarn"
            applicationId = "x"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_folder(Cluster())


@pytest.mark.parametrize(("master", "warehouse", "fine"), [
    ("yarn", "file:/tmp/warehouse", False), ("local-cluster[2,1,1024]", "/tmp/warehouse", False),
    ("yarn", "hdfs://name/warehouse", True), ("local[4]", "/tmp/warehouse", True), ("local", "file:/tmp/warehouse", True),
])
def test_a_local_warehouse_is_for_a_local_master(master, warehouse, fine):
    class Session:
        conf = {"spark.sql.warehouse.dir": warehouse}

        class sparkContext:  # noqa: N801
            pass

    Session.sparkContext.master = master
    if fine:
        assert tables.shared_folder(Session()) == f"{warehouse}/_intermediate"
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            tables.shared_folder(Session())


def test_a_carrier_is_in_few_files_of_a_split_month(spark, tmp_path):
    import pyarrow.parquet as pq

    raw = driver_tables.raw_flights(spark, SF_DIR).withColumn("FL_DATE", F.lit(dt.date(2019, 8, 5))).repartition(8)
    tables.write_monthly(
        raw, str(tmp_path / "t"), F.col("FL_DATE"), ["OP_UNIQUE_CARRIER", "ORIGIN", "DEST"], "append", rows_per_file=1500
    )
    files = list((tmp_path / "t").glob("*/*.parquet"))
    spans = []
    for file in files:
        groups = pq.ParquetFile(file).metadata
        column = groups.schema.to_arrow_schema().get_field_index("OP_UNIQUE_CARRIER")
        stats = [groups.row_group(i).column(column).statistics for i in range(groups.num_row_groups)]
        spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    assert len(files) >= 30
    for carrier in ("AA", "DL", "UA", "WN"):
        assert sum(low <= carrier <= high for low, high in spans) <= len(files) / 4
    assert spark.read.parquet(str(tmp_path / "t")).count() == raw.count()


def test_a_hot_combination_is_dealt_to_several_files(spark):
    rows = spark.range(1000).selectExpr("date'2019-01-01' as m", "if(id < 900, null, 'AA') as c", "'X' as o", "id")
    dealt = tables.dealt_to_files(rows, "m", ["c", "o"], 100)
    counts = [r["count"] for r in dealt.groupBy("_file").count().collect()]
    assert sum(counts) == 1000 and max(counts) < 250 and len(counts) >= 9


def test_large_lookups_are_cut_to_the_keys_in_use(spark):
    warehouse = Warehouse.of_driver_tables(spark, SF_DIR, AS_OF)
    expected = fingerprint(enrich_flights(warehouse.stg_flights, warehouse.stg_airlines, warehouse.stg_airports))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="16KB", spark__sql__adaptive__autoBroadcastJoinThreshold="16KB"):
        enriched = warehouse.flights_enriched
        plan = enriched._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        assert fingerprint(enriched) == expected
    airlines_used, airports_used = warehouse.lookups_in_use
    assert airlines_used.count() < warehouse.stg_airlines.count() and airports_used.count() < 10


def test_lookups_in_use_keep_repeated_codes_and_pass_over_missing_keys(spark):
    flights = spark.createDataFrame(
        [("AA", "1", "2"), ("AA", "1", None), (None, None, "9")], "carrier_code string, origin_airport_id string, dest_airport_id string"
    )
    found = enrichment.lookup_keys(flights)
    lines = lookup(spark, [("7", "A: AA"), ("8", "B: AA"), ("9", "C: DL"), ("10", "Uncoded")])
    places = lookup(spark, [("1", "City, ST: One"), ("2", "City, ST: Two"), ("3", "City, ST: Three")])
    kept = enrichment.airlines_in_use(stage_airlines(lines), found).collect()
    assert sorted(r.carrier_id for r in kept) == ["7", "8"]
    assert sorted(r.airport_id for r in enrichment.airports_in_use(stage_airports(places), found).collect()) == ["1", "2"]


def test_rows_meet_their_file_numbers_without_a_shuffle(spark):
    rows = spark.range(100_000).selectExpr("date'2019-01-01' as m", "cast(id % 7 as string) as c", "'X' as o", "id")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="64KB", spark__sql__adaptive__autoBroadcastJoinThreshold="64KB"):
        plan = tables.dealt_to_files(rows, "m", ["c", "o"], 10_000)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
