from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarmac.functions import labels
from tarmac.functions.numbers import bin_number, percent, safe_divide
from tarmac.functions.text import NULL_KEY_PART, surrogate_key


def evaluate(spark, column, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_severity_bounds(spark):
    minutes = [-1.0, 0.0, 15.0, 16.0, 45.0, 46.0, 120.0, 121.0, 240.0, 241.0, None]
    names = evaluate(spark, lambda x: labels.severity(F.lit(False), x), minutes, "double")
    assert names == ["Early", "On Time", "On Time", "Minor Delay", "Minor Delay", "Moderate Delay", "Moderate Delay",
                     "Severe Delay", "Severe Delay", "Extreme Delay", None]
    order = evaluate(spark, lambda x: labels.severity_order(F.lit(False), x), minutes, "double")
    assert order == [1, 2, 2, 3, 3, 4, 4, 5, 5, 6, None]
    assert evaluate(spark, lambda x: labels.severity(F.lit(True), x), [20.0], "double") == [None]


def test_distance_bounds(spark):
    found = evaluate(spark, labels.distance_band, [None, 249.0, 250.0, 749.0, 750.0, 1499.0, 1500.0], "double")
    short, medium, long, ultra = (label for label, _ in labels.DISTANCE_BANDS)
    assert found == [None, short, medium, medium, long, long, ultra]


def test_clock_bounds(spark):
    found = evaluate(
        spark, labels.time_of_day, [0, 459, 460, 500, 859, 900, 1200, 1500, 1800, 2100, 2359, 2400, None], "long"
    )
    assert [f.split(" (")[0] for f in found] == [
        "Red-Eye", "Red-Eye", "Unknown", "Early Morning", "Early Morning", "Morning", "Afternoon", "Late Afternoon",
        "Evening", "Night", "Night", "Unknown", "Unknown",
    ]


def test_covid_bounds(spark):
    days = [dt.date(2020, 2, 29), dt.date(2020, 3, 1), dt.date(2021, 12, 31), dt.date(2022, 1, 1)]
    assert evaluate(spark, labels.covid_phase, days, "date") == [
        "Pre-Covid", "COVID Impact", "COVID Impact", "Recovery",
    ]
    assert evaluate(spark, labels.in_covid, days, "date") == [False, True, True, False]


def test_names_outside_their_range(spark):
    assert evaluate(spark, labels.weekday_name, [1, 7, 0, 8, None], "long") == [
        "Monday", "Sunday", "Unknown", "Unknown", "Unknown",
    ]
    assert evaluate(spark, labels.month_name, [1, 12, 0, 13, None], "long") == ["January", "December", None, None, None]
    assert evaluate(spark, labels.season, [12, 3, 8, 11, 13], "long") == ["Winter", "Spring", "Summer", "Fall", None]


@pytest.mark.parametrize(
    ("minutes", "cause"),
    [
        ({"carrier": 20.0, "late_aircraft": 20.0}, "Carrier"),
        ({"nas": 3.0, "weather": 5.0, "security": 5.0}, "Weather"),
        ({"security": 1.0}, "Security"),
        ({"carrier": 0.0, "nas": 0.0}, "Unattributed"),
        ({}, None),
    ],
)
def test_primary_cause(spark, minutes, cause):
    columns = [F.lit(minutes.get(c)).cast("double").alias(f"{c}_delay_minutes") for c in labels.CAUSES.values()]
    assert spark.range(1).select(*columns).select(labels.primary_cause()).first()[0] == cause


def test_duration_bands(spark):
    assert evaluate(spark, labels.duration_band, [None, 60.0, 61.0, 120.0, 240.0, 241.0], "double") == [
        "unknown", "under_1_hour", "1_to_2_hours", "1_to_2_hours", "2_to_4_hours", "over_4_hours",
    ]


def test_otp_bands(spark):
    bands = evaluate(spark, labels.otp_band, [None, 85.0, 84.99, 80.0, 79.99, 70.0, 69.99, 60.0, 59.99], "double")
    assert [b.split(" ")[0] for b in bands] == [
        "No", "Excellent", "Good", "Good", "Fair", "Fair", "Poor", "Poor", "Critical",
    ]


def test_safe_arithmetic(spark):
    row = spark.range(1).select(
        safe_divide(F.lit(1.0), F.lit(0.0)).alias("zero"),
        safe_divide(F.lit(1.0), F.lit(None).cast("double")).alias("missing"),
        percent(F.lit(1), F.lit(3)).alias("third"),
    ).first()
    assert (row.zero, row.missing, row.third) == (None, None, 33.33)


def test_bins_are_clipped_and_closed(spark):
    found = evaluate(spark, lambda x: bin_number(x, 0, 10, 5), [-3.0, 0.0, 1.9, 2.0, 9.9, 10.0, 99.0], "double")
    assert found == [1, 1, 1, 2, 5, 5, 5]


def test_surrogate_key_marks_missing_parts(spark):
    key = surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit(5))
    expected = F.md5(F.lit(f"a-{NULL_KEY_PART}-5"))
    assert spark.range(1).select(key == expected).first()[0]
