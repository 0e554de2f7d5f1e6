from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from helpers import airlines, airports, by, raw_flight, raw_flights
from pyspark.sql import functions as F

from tarmac.operators import routes
from tarmac.plans.warehouse import Warehouse

AS_OF = dt.datetime(2024, 3, 1)


def warehouse(spark, rows) -> Warehouse:
    return Warehouse(raw_flights(spark, rows), airlines(spark), airports(spark), AS_OF)


def month_of(year: int, month: int, on_time: int, late: int, **changes) -> list[dict]:
    day = dt.date(year, month, 10)
    punctual = [raw_flight(FL_DATE=day, OP_CARRIER_FL_NUM=i, **changes) for i in range(on_time)]
    delayed = {"ARR_DELAY": 40.0, "ARR_DELAY_NEW": 40.0, "ARR_DEL15": 1.0}
    return punctual + [raw_flight(FL_DATE=day, OP_CARRIER_FL_NUM=1000 + i, **(delayed | changes)) for i in range(late)]


def test_gap_months_are_filled(spark):
    rows = month_of(2019, 1, 2, 0) + month_of(2019, 2, 1, 1) + month_of(2019, 4, 1, 0)
    stats = by(warehouse(spark, rows).route_stats, "month_start")
    assert sorted(stats) == [dt.date(2019, m, 1) for m in (1, 2, 3, 4)]
    gap = stats[dt.date(2019, 3, 1)]
    assert gap["total_operated_flights"] == 0 and gap["otp_rate_pct"] is None and gap["flight_season"] is None
    assert gap["dominant_delay_cause"] == "No Operations" and gap["otp_performance_band"].startswith("No Operations")
    assert gap["otp_rate_3m_avg"] == 75.0
    assert stats[dt.date(2019, 2, 1)]["otp_rate_mom_change"] == -50.0


def test_chronic_needs_three_months_with_volume(spark):
    rows = [r for m in (1, 2, 3) for r in month_of(2019, m, 26, 14)] + month_of(2019, 4, 18, 11)
    stats = by(warehouse(spark, rows).route_stats, "month_start")
    chronic = [stats[dt.date(2019, m, 1)]["is_chronic_delay_route"] for m in (1, 2, 3, 4)]
    assert chronic == [False, False, True, False]


def test_year_over_year_uses_the_calendar(spark):
    rows = month_of(2019, 1, 1, 1) + month_of(2019, 5, 1, 0) + month_of(2020, 1, 3, 1)
    stats = by(warehouse(spark, rows).route_stats, "month_start")
    assert stats[dt.date(2020, 1, 1)]["otp_rate_yoy_change"] == 25.0


@pytest.mark.parametrize(
    ("causes", "label"),
    [
        ({}, "No Delay"),
        ({"CARRIER_DELAY": 20.0, "NAS_DELAY": 20.0}, "Multiple Causes"),
        ({"WEATHER_DELAY": 5.0, "NAS_DELAY": 30.0}, "NAS"),
        ({"SECURITY_DELAY": 5.0}, "Security"),
    ],
)
def test_dominant_cause(spark, causes, label):
    row = warehouse(spark, month_of(2019, 1, 0, 1, **causes)).route_stats.first()
    assert row.dominant_delay_cause == label


def test_cancelled_flights_are_not_counted(spark):
    rows = month_of(2019, 1, 3, 1) + [raw_flight(FL_DATE=dt.date(2019, 1, 3), CANCELLED=1.0, ARR_DELAY=None)]
    row = warehouse(spark, rows).route_stats.first()
    assert (row.total_operated_flights, row.otp_rate_pct) == (4, 75.0)


def test_rank_leaves_gaps_after_ties(spark):
    rows = []
    for dest, on_time, late in (("LAX", 30, 10), ("BOS", 30, 10), ("JFK", 35, 5), ("ORD", 10, 10)):
        rows += month_of(2019, 1, on_time, late, DEST=dest)
    ranks = by(warehouse(spark, rows).route_worst_rank, "route_key")
    assert {k: r["route_rank_worst_otp"] for k, r in ranks.items()} == {"ATL-LAX": 1, "ATL-BOS": 1, "ATL-JFK": 3}


def test_statistics_against_brute_force(spark):
    """One route with most flights, and missing delays; median, means and counts from plain Python."""
    rng = random.Random(7)
    rows, expected = [], {}
    for dest, month, n in (("LAX", 1, 401), ("LAX", 2, 900), ("BOS", 1, 6), ("BOS", 2, 1)):
        delays = [None if rng.random() < 0.05 else float(rng.randint(-30, 200)) for _ in range(n)]
        for i, delay in enumerate(delays):
            late = None if delay is None else float(delay >= 15)
            rows.append(
                raw_flight(
                    FL_DATE=dt.date(2019, month, 1 + i % 28), OP_CARRIER_FL_NUM=i, DEST=dest, ARR_DELAY=delay,
                    ARR_DELAY_NEW=delay and max(delay, 0.0), ARR_DEL15=late, CARRIER_DELAY=float(i % 9),
                )
            )
        timed = [d for d in delays if d is not None]
        late = [d for d in timed if d >= 15]
        expected[(f"ATL-{dest}", dt.date(2019, month, 1))] = (
            n, len(late), len(timed) - len(late), len(timed),
            statistics.median_low(timed) if timed else None,
            round(statistics.fmean(timed), 2) if timed else None,
            round(statistics.fmean(late), 2) if late else None,
            float(sum(i % 9 for i in range(n))),
        )
    found = by(warehouse(spark, rows).route_month_stats, "route_key", "month_start")
    assert {
        key: (
            r["total_operated_flights"], r["delayed_flights"], r["on_time_flights"], r["flights_with_valid_arr_delay"],
            r["median_arr_delay"], r["avg_arr_delay_all"], r["avg_arr_delay_delayed_only"], r["total_carrier_delay_min"],
        )
        for key, r in found.items()
    } == expected


def test_two_attribute_sets_of_a_route_meet_in_every_month(spark):
    """The spine has one row per attribute set, the join only knows carrier, route and month."""
    rows = month_of(2019, 1, 2, 0) + month_of(2019, 1, 3, 0, DISTANCE=100.0) + month_of(2019, 2, 1, 0)
    w = warehouse(spark, rows)
    filled = w.route_month_filled.groupBy("month_start").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_operated_flights").alias("flights")
    )
    found = {k: (r["rows"], r["flights"]) for k, r in by(filled, "month_start").items()}
    assert found == {dt.date(2019, 1, 1): (4, 10), dt.date(2019, 2, 1): (1, 1)}


def test_universe_is_the_same_from_flights_and_from_months(spark):
    w = warehouse(spark, month_of(2019, 1, 2, 0) + month_of(2019, 6, 1, 1) + month_of(2019, 3, 1, 0, DEST="BOS"))
    from_flights = routes.route_universe(routes.with_month(w.operated))
    from_months = routes.route_universe(w.route_months)
    assert sorted(map(str, from_flights.collect())) == sorted(map(str, from_months.collect()))


def test_spine_covers_every_month_once(spark):
    w = warehouse(spark, month_of(2019, 11, 1, 0) + month_of(2020, 2, 1, 0))
    assert sorted(r.month_start for r in w.route_month_spine.collect()) == [
        dt.date(2019, 11, 1), dt.date(2019, 12, 1), dt.date(2020, 1, 1), dt.date(2020, 2, 1),
    ]
