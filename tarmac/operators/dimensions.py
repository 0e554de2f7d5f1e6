"""Dimension tables of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.functions import labels
from tarmac.functions.text import extract_or_null, surrogate_key

# Fixed values -----------------------------------------------------------------
FEDERAL_HOLIDAYS = [
    "2019-01-01", "2020-01-01", "2021-01-01", "2022-01-01", "2023-01-02",  # New Year's Day
    "2019-05-27", "2020-05-25", "2021-05-31", "2022-05-30", "2023-05-29",  # Memorial Day
    "2019-07-04", "2020-07-03", "2021-07-05", "2022-07-04", "2023-07-04",  # Independence Day
    "2019-09-02", "2020-09-07", "2021-09-06", "2022-09-05", "2023-09-04",  # Labor Day
    "2019-11-28", "2020-11-26", "2021-11-25", "2022-11-24", "2023-11-23",  # Thanksgiving
    "2019-12-25", "2020-12-25", "2021-12-24", "2022-12-26", "2023-12-25",  # Christmas
]
US_REGIONS = {
    "Northeast": ["ME", "VT", "RI", "NY", "PA", "NH", "MA", "CT", "NJ"],
    "Midwest": ["OH", "MI", "IN", "IL", "WI", "MN", "IA", "MO", "ND", "SD", "NE", "KS"],
    "South": [
        "DE", "MD", "DC", "VA", "WV", "NC", "SC", "GA", "FL", "KY", "TN", "AL", "MS", "AR", "LA", "OK", "TX",
    ],
    "West": ["MT", "ID", "WY", "CO", "NM", "AZ", "UT", "NV", "WA", "OR", "CA", "AK", "HI"],
}
MAJOR_HUBS = [
    "ATL", "DFW", "DEN", "ORD", "LAX", "JFK", "LAS", "MCO", "CLT", "PHX",
    "SEA", "MIA", "IAH", "BOS", "SFO", "MSP", "DTW", "FLL", "EWR", "LGA",
    "BWI", "SLC", "SAN", "DCA", "MDW", "HNL", "PDX", "DAL", "STL", "BNA",
]
BIG_FOUR = ["AA", "DL", "UA", "WN"]
MAJOR_CARRIERS = [*BIG_FOUR, "AS", "B6", "NK", "F9", "G4", "HA"]
DELAY_CAUSES = [
    (
        1, "carrier", "Carrier Delay", "Airline Operations", "carrier_delay_minutes",
        "Delay caused by circumstances within the airline control, such as maintenance, crew problems, "
        "aircraft cleaning, baggage loading, and fueling.",
        "Direct",
    ),
    (
        2, "late_aircraft", "Late Aircraft Delay", "Aircraft Rotation", "late_aircraft_delay_minutes",
        "Delay caused by a previous flight with the same aircraft arriving late, resulting in a cascading delay.",
        "Indirect",
    ),
    (
        3, "nas", "NAS Delay", "National Aviation System", "nas_delay_minutes",
        "Delay attributable to the National Aviation System, including air traffic control, airport operations, "
        "and non-extreme weather conditions.",
        "External",
    ),
    (
        4, "weather", "Weather Delay", "Weather", "weather_delay_minutes",
        "Delay caused by extreme weather conditions, such as hurricanes, blizzards, heavy snow, icing, low ceilings, "
        "and poor visibility.",
        "External",
    ),
    (
        5, "security", "Security Delay", "Security", "security_delay_minutes",
        "Delay caused by security issues, such as evacuation of gate areas, security breaches, inoperative screening "
        "equipment, and long security lines.",
        "External",
    ),
]
# ------------------------------------------------------------------------------


def stamp(as_of: dt.datetime) -> Column:
    """Refresh stamp; passed in, so that a run can be repeated."""
    return F.lit(as_of).cast("timestamp")


def dim_date(
    spark: SparkSession,
    as_of: dt.datetime,
    start: dt.date = dt.date(2019, 1, 1),
    end_exclusive: dt.date = dt.date(2024, 1, 1),
) -> DataFrame:
    """One row per calendar day."""
    last = end_exclusive - dt.timedelta(days=1)
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(last))).alias("full_date"))
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    weekend = weekday.isin(6, 7)
    month = labels.month_name(F.month(day))
    weekday_name = labels.weekday_name(weekday)
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("long").alias("date_key"),
        day,
        F.year(day).cast("long").alias("year"),
        F.month(day).cast("long").alias("month"),
        F.day(day).cast("long").alias("day"),
        F.quarter(day).cast("long").alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter_label"),
        weekday.cast("long").alias("day_of_week"),
        month.alias("month_name"),
        F.left(month, F.lit(3)).alias("month_name_short"),
        weekday_name.alias("day_of_week_name"),
        F.left(weekday_name, F.lit(3)).alias("day_of_week_name_short"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        labels.season(F.month(day)).alias("season"),
        day.isin([dt.date.fromisoformat(d) for d in FEDERAL_HOLIDAYS]).alias("is_federal_holiday"),
        labels.covid_phase(day).alias("covid_period"),
        F.trunc(day, "month").alias("first_day_of_month"),
        F.last_day(day).alias("last_day_of_month"),
        F.trunc(day, "quarter").alias("first_day_of_quarter"),
        F.trunc(day, "year").alias("first_day_of_year"),
        F.extract(F.lit("YEAROFWEEK"), day).cast("long").alias("isoyear"),
        F.weekofyear(day).cast("long").alias("isoweek"),
        F.dayofyear(day).cast("long").alias("day_of_year"),
        (day == F.trunc(day, "month")).alias("is_month_start"),
        (day == F.last_day(day)).alias("is_month_end"),
        stamp(as_of).alias("dw_loaded_at"),
    )


def dim_carrier(airlines: DataFrame, as_of: dt.datetime) -> DataFrame:
    code = F.col("carrier_code")
    return airlines.select(
        "carrier_id",
        code,
        extract_or_null(F.col("airline_name_full"), "^([^:]+):").alias("airline_name"),
        "carrier_type",
        code.isin(BIG_FOUR).alias("is_big4_carrier"),
        code.isin(MAJOR_CARRIERS).alias("is_major_carrier"),
        stamp(as_of).alias("dw_last_refreshed_at"),
    )


def dim_airport(airports: DataFrame, enriched: DataFrame) -> DataFrame:
    """Airports that occur as origin or destination.

    Flights are read once and cut down to their distinct airport pairs before
    each pair is unfolded into its two airports.
    """
    ends = ["origin_airport_id", "origin_airport_code", "dest_airport_id", "dest_airport_code"]
    both = F.array(
        *[
            F.struct(F.col(f"{role}_airport_id").alias("airport_id"), F.col(f"{role}_airport_code").alias("airport_code"))
            for role in ("origin", "dest")
        ]
    )
    used = enriched.select(*ends).distinct().select(F.inline(both)).distinct()
    region = F.coalesce(
        *[F.when(F.col("state_code").isin(states), name) for name, states in US_REGIONS.items()], F.lit("Other")
    )
    return airports.join(used, "airport_id").select(
        "airport_id",
        "airport_code",
        "city_name",
        "state_code",
        "airport_name",
        region.alias("us_region"),
        F.coalesce(F.col("airport_code").isin(MAJOR_HUBS), F.lit(False)).alias("is_major_hub"),
        "loaded_at",
    )


def dim_route(route_stats: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row per directional route and attribute set, with the longest mean distance of the route."""
    attributes = [
        "route_key", "origin_airport_code", "dest_airport_code", "origin_state_code", "dest_state_code",
        "route_distance_category",
    ]
    same_route = Window.partitionBy("route_key")
    origin, dest = F.col("origin_state_code"), F.col("dest_state_code")
    return (
        route_stats.groupBy(*attributes)
        .agg(F.max("avg_distance_miles").alias("miles"))
        .select(
            surrogate_key(F.col("route_key")).alias("route_id"),
            *attributes[:5],
            (origin != dest).alias("is_interstate_route"),
            "route_distance_category",
            F.max("miles").over(same_route).alias("route_distance_miles"),
            stamp(as_of).alias("dw_last_refreshed_at"),
        )
    )


def dim_delay_cause(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DELAY_CAUSES,
        "delay_cause_id long, delay_cause_code string, delay_cause_name string, operational_domain string, "
        "fact_column_name string, cause_definition string, controllability_class string",
    )


def flights_per_day(calendar: DataFrame, fact_flights: DataFrame) -> DataFrame:
    """The calendar with the flights and cancellations of each day, days without flights included."""
    per_day = fact_flights.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("flights"), F.count_if("is_cancelled").alias("cancelled")
    )
    return calendar.join(per_day, "date_key", "left").withColumns(
        {name: F.coalesce(name, F.lit(0)) for name in ("flights", "cancelled")}
    )


def minutes_per_cause(causes: DataFrame, fact_flights: DataFrame) -> DataFrame:
    """Each delay cause with its minutes and flights in the flight fact, matched by fact column."""
    columns = [row[4] for row in DELAY_CAUSES]
    sums = fact_flights.agg(
        *[F.sum(c).alias(f"{c}_sum") for c in columns], *[F.count_if(F.col(c) > 0).alias(f"{c}_n") for c in columns]
    )
    per_cause = sums.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("fact_column_name"),
                        F.col(f"{c}_sum").alias("total_minutes"),
                        F.col(f"{c}_n").alias("flights"),
                    )
                    for c in columns
                ]
            )
        )
    )
    return causes.join(per_cause, "fact_column_name", "left")
