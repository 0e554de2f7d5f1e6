"""Checks of the raw tables after a load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.numbers import percent


def _rows() -> Column:
    return F.count(F.lit(1))


def rows_by_year(raw: DataFrame) -> DataFrame:
    return raw.groupBy(F.year("FL_DATE").cast("long").alias("year")).agg(
        _rows().alias("total_row"), F.sum("CANCELLED").alias("cancelled_flights")
    )


def rows_by_month(raw: DataFrame) -> DataFrame:
    return raw.groupBy(
        F.year("FL_DATE").cast("long").alias("year"), F.month("FL_DATE").cast("long").alias("month")
    ).agg(_rows().alias("row_count"), F.min("FL_DATE").alias("first_date"), F.max("FL_DATE").alias("last_date"))


def carriers(raw: DataFrame) -> DataFrame:
    """Flights, date range and years per carrier, busiest first.

    Counting per carrier and year first keeps the distinct count of years off
    the flight rows.
    """
    per_year = raw.groupBy("OP_UNIQUE_CARRIER", F.year("FL_DATE").alias("year")).agg(
        _rows().alias("n"), F.min("FL_DATE").alias("first"), F.max("FL_DATE").alias("last")
    )
    return (
        per_year.groupBy(F.col("OP_UNIQUE_CARRIER").alias("reporting_airline"))
        .agg(
            F.sum("n").alias("total_flights"),
            F.min("first").alias("first_flight"),
            F.max("last").alias("last_flight"),
            F.count("year").alias("year_present"),
        )
        .orderBy(F.desc("total_flights"), "reporting_airline")
    )


def null_rates(raw: DataFrame) -> DataFrame:
    columns = {
        "FL_DATE": "pct_null_flight_date",
        "OP_UNIQUE_CARRIER": "pct_null_carrier",
        "ORIGIN": "pct_null_origin",
        "DEST": "pct_null_dest",
        "ARR_DELAY": "pct_null_arr_delay",
        "ARR_DEL15": "pct_null_arr_del15",
    }
    return raw.agg(
        *[(F.try_divide(F.count_if(F.col(c).isNull()), _rows()) * 100).alias(name) for c, name in columns.items()]
    )


def cause_coverage(raw: DataFrame) -> DataFrame:
    """How often causes are recorded, by delay and cancellation flag."""
    carrier = F.count_if(F.col("CARRIER_DELAY").isNotNull())
    return raw.groupBy(F.col("ARR_DEL15").alias("delay_15"), F.col("CANCELLED").alias("cancelled")).agg(
        carrier.alias("has_carrier_delay"),
        F.count_if(F.col("WEATHER_DELAY").isNotNull()).alias("has_weather_delay"),
        percent(carrier, _rows()).alias("pct_has_cause_data"),
    )


def lineage(raw: DataFrame) -> DataFrame:
    """Missing lineage, files and load times, counted per file first."""
    per_file = raw.groupBy("_source_file").agg(
        _rows().alias("n"),
        F.count_if(F.col("_loaded_at").isNull()).alias("unstamped"),
        F.min("_loaded_at").alias("first"),
        F.max("_loaded_at").alias("last"),
    )
    unnamed = F.sum(F.when(F.col("_source_file").isNull(), F.col("n")))
    return per_file.agg(
        F.coalesce(F.sum("unstamped"), F.lit(0)).alias("null_loaded_at"),
        F.coalesce(unnamed, F.lit(0)).alias("null_source_file"),
        F.count("_source_file").alias("distinct_source_file"),
        F.min("first").alias("earliest_loaded_file"),
        F.max("last").alias("latest_loaded_file"),
    )


def lookup_counts(raw_airlines: DataFrame, raw_airports: DataFrame) -> DataFrame:
    def count(name: str, table: DataFrame) -> DataFrame:
        return table.agg(_rows().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    return count("airline_lookup", raw_airlines).unionByName(count("airport_lookup", raw_airports))


def carrier_join(raw: DataFrame, airlines: DataFrame) -> DataFrame:
    """Flights per carrier with the matched airline name.

    Flights are counted per carrier before the join, so a busy carrier costs one
    row. A code listed several times counts its flights once per listing, as a
    join of the flights themselves would.
    """
    flights = raw.groupBy(F.col("OP_UNIQUE_CARRIER").alias("reporting_airline")).agg(_rows().alias("n"))
    names = airlines.groupBy(F.col("carrier_code").alias("reporting_airline")).agg(
        _rows().alias("listings"), F.max("airline_name_full").alias("airline_name")
    )
    return flights.join(names, "reporting_airline", "left").select(
        "reporting_airline",
        (F.col("n") * F.coalesce("listings", F.lit(1))).alias("flight_count"),
        "airline_name",
    )


def duplicates(raw: DataFrame, top: int = 20) -> DataFrame:
    """The most repeated flight keys; equal counts are ordered by key."""
    key = ["FL_DATE", "OP_UNIQUE_CARRIER", "OP_CARRIER", "ORIGIN", "DEST"]
    return raw.groupBy(*key).agg(_rows().alias("occurence_count")).orderBy(F.desc("occurence_count"), *key).limit(top)
