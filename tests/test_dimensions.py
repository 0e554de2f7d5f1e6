from __future__ import annotations

import datetime as dt

from helpers import by, lookup

from tarmac.operators import dimensions
from tarmac.operators.staging import stage_airlines

AS_OF = dt.datetime(2024, 3, 1)


def test_calendar(spark):
    days = by(dimensions.dim_date(spark, AS_OF), "full_date")
    assert len(days) == 1826 and sum(d["is_federal_holiday"] for d in days.values()) == 30
    saturday = days[dt.date(2021, 1, 2)]
    assert (saturday["isoyear"], saturday["isoweek"], saturday["day_of_week"], saturday["is_weekend"]) == (2020, 53, 6, True)
    leap = days[dt.date(2020, 2, 29)]
    assert leap["is_month_end"] and leap["date_key"] == 20200229 and leap["season"] == "Winter"
    assert leap["quarter_label"] == "Q1" and leap["day_of_week_name_short"] == "Sat" and leap["month_name_short"] == "Feb"
    for day, row in days.items():
        assert row["isoweek"] == day.isocalendar().week and row["isoyear"] == day.isocalendar().year


def test_carriers(spark):
    raw = lookup(spark, [("1", "Delta Air Lines Inc.: DL"), ("2", "Alaska Airlines: AS"), ("3", "Nameless")])
    carriers = by(dimensions.dim_carrier(stage_airlines(raw), AS_OF), "carrier_id")
    assert carriers["1"]["airline_name"] == "Delta Air Lines Inc." and carriers["1"]["is_big4_carrier"]
    assert carriers["2"]["is_major_carrier"] and not carriers["2"]["is_big4_carrier"]
    assert carriers["3"]["airline_name"] is None and carriers["3"]["is_big4_carrier"] is None


def test_routes(spark):
    rows = [
        ("A-B", "A", "B", "GA", "CA", "Long", 10.0), ("A-B", "A", "B", "GA", "CA", "Long", 12.0),
        ("A-B", "A", "B", "GA", "CA", "Short", 7.0), ("C-D", "C", "D", "TX", "TX", "Long", None),
        ("E-F", "E", "F", None, "HI", "Long", 3.0),
    ]
    stats = spark.createDataFrame(
        rows,
        "route_key string, origin_airport_code string, dest_airport_code string, origin_state_code string, "
        "dest_state_code string, route_distance_category string, avg_distance_miles double",
    )
    found = by(dimensions.dim_route(stats, AS_OF), "route_key", "route_distance_category")
    assert {k: (r["is_interstate_route"], r["route_distance_miles"]) for k, r in found.items()} == {
        ("A-B", "Long"): (True, 12.0), ("A-B", "Short"): (True, 12.0),
        ("C-D", "Long"): (False, None), ("E-F", "Long"): (None, 3.0),
    }


def test_delay_causes(spark):
    causes = by(dimensions.dim_delay_cause(spark), "delay_cause_id")
    assert len(causes) == 5 and causes[2]["controllability_class"] == "Indirect"
