"""Small hand-written inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tarmac.schemas import RAW_FLIGHT_COLUMNS, lookup_schema, raw_flight_schema

LOADED = dt.datetime(2024, 1, 15)


def raw_flight(**changes) -> dict:
    """A punctual AA flight ATL-LAX on 2019-03-04, with changes."""
    day = changes.get("FL_DATE", dt.date(2019, 3, 4))
    row = dict.fromkeys(RAW_FLIGHT_COLUMNS)
    row |= {
        "YEAR": day.year, "QUARTER": (day.month + 2) // 3, "MONTH": day.month, "DAY_OF_MONTH": day.day,
        "DAY_OF_WEEK": day.isoweekday(), "FL_DATE": day, "OP_UNIQUE_CARRIER": "AA", "OP_CARRIER": "AA",
        "OP_CARRIER_FL_NUM": 1, "ORIGIN_AIRPORT_ID": 10397, "ORIGIN": "ATL", "ORIGIN_STATE_ABR": "GA",
        "DEST_AIRPORT_ID": 12892, "DEST": "LAX", "DEST_STATE_ABR": "CA", "CRS_DEP_TIME": 930, "ARR_DELAY": 0.0,
        "ARR_DELAY_NEW": 0.0, "ARR_DEL15": 0.0, "CANCELLED": 0.0, "DIVERTED": 0.0, "CRS_ELAPSED_TIME": 100.0,
        "ACTUAL_ELAPSED_TIME": 90.0, "FLIGHTS": 1.0, "DISTANCE": 1946.0, "_loaded_at": LOADED,
        "_source_file": f"ontime_{day:%Y_%m}.csv",
    }
    return row | changes


def raw_flights(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[c] for c in RAW_FLIGHT_COLUMNS) for r in rows], raw_flight_schema())


def lookup(spark: SparkSession, rows: list[tuple[str | None, str | None]], loaded_at: dt.datetime = LOADED) -> DataFrame:
    return spark.createDataFrame([(*r, loaded_at, "lookup.csv") for r in rows], lookup_schema())


def airlines(spark: SparkSession) -> DataFrame:
    return lookup(spark, [("19805", "American Airlines Inc.: AA"), ("19790", "Delta Air Lines Inc.: DL")])


def airports(spark: SparkSession) -> DataFrame:
    return lookup(
        spark, [("10397", "Atlanta, GA: Hartsfield-Jackson"), ("12892", "Los Angeles, CA: LAX International")]
    )


def by(df: DataFrame, *key: str) -> dict:
    """Rows by the value of their key columns."""
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r.asDict() for r in df.collect()}
