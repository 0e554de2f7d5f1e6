"""Fact tables of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.dimensions import stamp
from tarmac.operators.routes import CAUSE_TOTALS
from tarmac.operators.staging import CAUSE_NAMES

FLIGHT_FACT_COLUMNS = [
    "flight_id", "flight_date", "date_key", "carrier_id", "origin_airport_id", "dest_airport_id", "route_key",
    "scheduled_dep_time_hhmm", "actual_dep_time_hhmm", "scheduled_arr_time_hhmm", "actual_arr_time_hhmm",
    "taxi_out_minutes", "taxi_in_minutes", "wheels_off_time_hhmm", "wheels_on_time_hhmm",
    "dep_time_of_day", "is_cancelled", "is_diverted", "is_on_time", "is_dep_delayed", "is_arr_delayed",
    "cancellation_code", "cancellation_reason",
    "dep_delay_minutes", "arr_delay_minutes", "arr_delay_minutes_pos", "delay_severity", "delay_severity_order",
    *[f"{name}_delay_minutes" for name in CAUSE_NAMES], "total_cause_minutes", "primary_delay_cause",
    "scheduled_elapsed_minutes", "actual_elapsed_minutes", "air_time_minutes", "distance_miles", "distance_group",
]


def fact_flights(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FLIGHT_FACT_COLUMNS)


def fact_route_monthly(route_stats: DataFrame, as_of: dt.datetime) -> DataFrame:
    return route_stats.select(
        "flight_date_key",
        F.col("month_start").alias("flight_month_date"),
        "carrier_id",
        "carrier_code",
        "origin_airport_id",
        "dest_airport_id",
        "route_key",
        "is_chronic_delay_route",
        "total_operated_flights",
        "on_time_flights",
        "delayed_flights",
        "flights_with_valid_arr_delay",
        *CAUSE_TOTALS,
        "total_delay_minutes",
        stamp(as_of).alias("dw_last_refreshed_at"),
    )


def route_stats_null_volume(route_stats: DataFrame) -> DataFrame:
    """Route-months without a flight count; empty when the gap fill works."""
    missing = F.col("total_operated_flights").isNull()
    return route_stats.filter(missing).groupBy("total_operated_flights").agg(F.count(F.lit(1)).alias("total_rows"))
