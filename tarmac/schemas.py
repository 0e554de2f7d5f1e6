"""Declared schemas of the raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of a monthly flight file, in file order.
FLIGHT_FILE_COLUMNS = {
    "YEAR": "long",
    "QUARTER": "long",
    "MONTH": "long",
    "DAY_OF_MONTH": "long",
    "DAY_OF_WEEK": "long",
    "FL_DATE": "date",
    "OP_UNIQUE_CARRIER": "string",
    "OP_CARRIER": "string",
    "TAIL_NUM": "string",
    "OP_CARRIER_FL_NUM": "long",
    "ORIGIN_AIRPORT_ID": "long",
    "ORIGIN": "string",
    "ORIGIN_CITY_NAME": "string",
    "ORIGIN_STATE_ABR": "string",
    "DEST_AIRPORT_ID": "long",
    "DEST": "string",
    "DEST_CITY_NAME": "string",
    "DEST_STATE_ABR": "string",
    "CRS_DEP_TIME": "long",
    "DEP_TIME": "double",
    "DEP_DELAY": "double",
    "DEP_DELAY_NEW": "double",
    "DEP_DEL15": "double",
    "DEP_DELAY_GROUP": "double",
    "TAXI_OUT": "double",
    "WHEELS_OFF": "double",
    "WHEELS_ON": "double",
    "TAXI_IN": "double",
    "CRS_ARR_TIME": "long",
    "ARR_TIME": "double",
    "ARR_DELAY": "double",
    "ARR_DELAY_NEW": "double",
    "ARR_DEL15": "double",
    "ARR_DELAY_GROUP": "double",
    "CANCELLED": "double",
    "CANCELLATION_CODE": "string",
    "DIVERTED": "double",
    "CRS_ELAPSED_TIME": "double",
    "ACTUAL_ELAPSED_TIME": "double",
    "AIR_TIME": "double",
    "FLIGHTS": "double",
    "DISTANCE": "double",
    "DISTANCE_GROUP": "long",
    "CARRIER_DELAY": "double",
    "WEATHER_DELAY": "double",
    "NAS_DELAY": "double",
    "SECURITY_DELAY": "double",
    "LATE_AIRCRAFT_DELAY": "double",
}

LINEAGE_COLUMNS = {"_loaded_at": "timestamp", "_source_file": "string"}

LOOKUP_FILE_COLUMNS = {"Code": "string", "Description": "string"}

RAW_FLIGHT_COLUMNS = FLIGHT_FILE_COLUMNS | LINEAGE_COLUMNS

RAW_CAUSES = ["CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"]

# What makes two raw rows the same scheduled flight.
NATURAL_KEY = ["FL_DATE", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST"]


def struct_of(columns: dict[str, str]) -> T.StructType:
    """All-nullable StructType of a name -> type-name mapping."""
    return T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in columns.items()))


def raw_flight_schema() -> T.StructType:
    return struct_of(RAW_FLIGHT_COLUMNS)


def lookup_schema() -> T.StructType:
    return struct_of(LOOKUP_FILE_COLUMNS | LINEAGE_COLUMNS)
