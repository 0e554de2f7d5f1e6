from __future__ import annotations

import datetime as dt

import pytest
from helpers import airlines, airports, by, lookup, raw_flight, raw_flights
from pyspark.sql import functions as F

from tarmac.operators import quality
from tarmac.plans import declared_checks
from tarmac.plans.warehouse import Warehouse

AS_OF = dt.datetime(2024, 3, 1)


def test_declared_check_counts():
    assert sum(map(len, declared_checks.NOT_NULL.values())) == 91
    assert sum(map(len, declared_checks.UNIQUE.values())) == 19
    assert sum(map(len, declared_checks.ACCEPTED.values())) == 27
    assert len(declared_checks.RELATIONSHIPS) == 2


def test_checks_ignore_or_count_missing_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, "c"), (2, "a")], "k long, v string")
    assert by(quality.not_null("t", df, ["k", "v"]), "column_name")["k"]["failures"] == 2
    accepted = by(quality.accepted_values("t", df, {"v": ["a", "b"]}), "column_name")
    assert (accepted["v"]["failures"], accepted["v"]["status"]) == (1, "FAIL")
    assert quality.unique("t", df, "k").first().failures == 1
    parents = spark.createDataFrame([(1,)], "id long")
    orphan = quality.relationship("t", df, "k", parents, "id").first()
    assert (orphan.failures, orphan.status) == (1, "WARN")


@pytest.mark.parametrize(("days", "status"), [(0, "pass"), (35, "pass"), (36, "warn"), (65, "warn"), (66, "error")])
def test_freshness(spark, days, status):
    raw = raw_flights(spark, [raw_flight(_loaded_at=AS_OF - dt.timedelta(days=days))])
    assert quality.freshness(raw, AS_OF).first().status == status


def test_scorecard_totals(spark):
    rows = [raw_flight(), raw_flight(), raw_flight(CANCELLED=None, OP_CARRIER_FL_NUM=2), raw_flight(ORIGIN=None)]
    card = by(quality.scorecard(raw_flights(spark, rows)), "check_name")
    failed = sorted(name for name, r in card.items() if r["status"] == "FAIL")
    assert failed == [
        "CANCELLED flag is binary", "Delay cause sum matches ARR_DELAY_NEW", "Natural key has no duplicates",
        "origin airport has no nulls",
    ]
    assert {(r["passed_checks"], r["failed_checks"]) for r in card.values()} == {(6, 4)}
    assert card["Natural key has no duplicates"]["result"] == "1 duplicates found"
    assert card["Natural key has no duplicates"]["note"] and not card["CANCELLED flag is binary"]["note"]
    causes = dict.fromkeys(["WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"], 0.0)
    late = raw_flight(ARR_DEL15=1.0, ARR_DELAY_NEW=30.0, CARRIER_DELAY=30.0, **causes)
    gap = by(quality.scorecard(raw_flights(spark, [late, late, late | {"CARRIER_DELAY": 10.0}])), "check_name")
    assert gap["Delay cause sum matches ARR_DELAY_NEW"]["result"] == "1 records with diff > 5 min (33.3% of delayed flights)"


def test_all_checks_over_a_small_warehouse(spark):
    rows = [raw_flight(), raw_flight(OP_CARRIER_FL_NUM=2, ORIGIN_AIRPORT_ID=77)]
    w = Warehouse(raw_flights(spark, rows), airlines(spark), airports(spark), AS_OF)
    found = by(declared_checks.all_checks(w), "check_name", "table_name", "column_name")
    assert len(found) == 139
    failures = {k: r["failures"] for k, r in found.items() if r["status"] != "PASS"}
    assert failures == {("relationships", "stg_flights", "origin_airport_id"): 1}


def test_grain_checks_report_what_is_taken_for_granted(spark):
    letters = airports(spark).unionByName(lookup(spark, [("ABC", "Letters, TX: L"), (None, "None, TX: N")]))
    rows = [raw_flight(), raw_flight(OP_CARRIER_FL_NUM=2, DISTANCE=100.0)]
    w = Warehouse(raw_flights(spark, rows), airlines(spark), letters, AS_OF)
    found = by(declared_checks.grain_checks(w), "table_name")
    assert (found["raw_airports"]["failures"], found["route_stats"]["failures"]) == (1, 1)


def test_shared_passes_count_what_each_table_holds(spark):
    """Broken rows, a carrier listed twice, and the same checks table by table and on stored tables."""
    rows = [
        raw_flight(),
        raw_flight(),
        raw_flight(OP_CARRIER_FL_NUM=3, ARR_DEL15=1.0, ARR_DELAY=30.0, ARR_DELAY_NEW=30.0, DEST_AIRPORT_ID=None),
        raw_flight(OP_CARRIER_FL_NUM=3, ARR_DEL15=1.0, ARR_DELAY=30.0, ARR_DELAY_NEW=30.0, CANCELLED=2.0),
        raw_flight(OP_CARRIER_FL_NUM=4, DIVERTED=1.0, ORIGIN=None, CANCELLED=None),
        raw_flight(OP_CARRIER_FL_NUM=5, ORIGIN_STATE_ABR=None, CANCELLATION_CODE="X", MONTH=13),
    ]
    twice = airlines(spark).unionByName(airlines(spark).withColumn("Code", F.concat(F.lit("9"), "Code")))
    w = Warehouse(raw_flights(spark, rows), twice, airports(spark), AS_OF)
    key = ("check_name", "table_name", "column_name")
    found = by(declared_checks.all_checks(w), *key)
    assert len(found) == 139
    plain = {}
    for table, columns in declared_checks.NOT_NULL.items():
        accepted = declared_checks.ACCEPTED.get(table, {})
        plain |= by(quality.row_checks(table, getattr(w, table), columns, accepted), *key)
    for table, columns in declared_checks.UNIQUE.items():
        counts = by(quality.unique_columns(table, getattr(w, table), columns), "column_name")
        plain |= {("unique", table, c): r for c, r in counts.items()}
    kinds = {kind: by(checks(w), "table_name", "column_name") for kind, checks in {
        "not_null": declared_checks.not_null_checks, "accepted_values": declared_checks.accepted_values_checks,
        "unique": declared_checks.unique_checks}.items()}
    for (kind, table, column), r in plain.items():
        expected = (r["failures"], r["status"])
        assert (found[kind, table, column]["failures"], found[kind, table, column]["status"]) == expected
        assert (kinds[kind][table, column]["failures"], kinds[kind][table, column]["status"]) == expected
    assert found["not_null", "stg_flights", "dest_airport_id"]["failures"] == 1
    assert found["unique", "flights_enriched", "flight_id"]["failures"] == 3
    assert found["unique", "delay_classified", "flight_id"]["failures"] == 1


def test_checks_of_stored_tables_read_what_is_stored(spark, tmp_path):
    w = Warehouse(raw_flights(spark, [raw_flight(), raw_flight(OP_CARRIER_FL_NUM=2)]), airlines(spark), airports(spark), AS_OF)
    w.write(str(tmp_path))
    w.fact_flights = w.fact_flights.withColumn("route_key", F.lit(None).cast("string"))
    found = by(declared_checks.not_null_checks(w), "table_name", "column_name")
    assert found["fact_flights", "route_key"]["failures"] == 2
    assert found["flights_enriched", "route_key"]["failures"] == 0


def test_checks_of_no_flights(spark):
    w = Warehouse(raw_flights(spark, []), airlines(spark), airports(spark), AS_OF)
    found = by(declared_checks.all_checks(w), "check_name", "table_name", "column_name")
    assert len(found) == 139 and {r["failures"] for r in found.values()} == {0}
