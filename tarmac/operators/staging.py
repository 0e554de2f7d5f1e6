"""Raw tables to typed, renamed staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import labels
from tarmac.functions.numbers import is_one, or_zero
from tarmac.functions.text import extract_or_null, piece, surrogate_key
from tarmac.schemas import NATURAL_KEY

CAUSE_NAMES = ["carrier", "weather", "nas", "security", "late_aircraft"]


def is_staged() -> Column:
    """Whether a raw row is a scheduled, non-diverted flight segment."""
    return F.col("DIVERTED").cast("double") != 1


def staged_columns() -> list[Column]:
    """The staged columns of a raw row."""
    c = F.col

    def number(source: str, name: str) -> Column:
        return c(source).cast("double").alias(name)

    def whole(source: str, name: str) -> Column:
        return c(source).cast("long").alias(name)

    def text(source: str, name: str) -> Column:
        return c(source).cast("string").alias(name)

    late = c("ARR_DEL15").cast("double")
    on_time = F.when(~F.coalesce(is_one(c("CANCELLED")), F.lit(False)), F.when(late == 0, True).when(late == 1, False))
    causes = {name: c(f"{name.upper()}_DELAY").cast("double") for name in CAUSE_NAMES}
    total = sum((or_zero(m) for m in list(causes.values())[1:]), or_zero(causes["carrier"]))

    return [
        surrogate_key(*map(c, NATURAL_KEY)).alias("flight_id"),
        c("FL_DATE").cast("date").alias("flight_date"),
        whole("YEAR", "flight_year"),
        whole("QUARTER", "flight_quarter"),
        whole("MONTH", "flight_month"),
        whole("DAY_OF_MONTH", "flight_day_of_month"),
        whole("DAY_OF_WEEK", "flight_day_of_week"),
        labels.weekday_name(c("DAY_OF_WEEK")).alias("day_of_week_name"),
        text("OP_UNIQUE_CARRIER", "carrier_code"),
        text("TAIL_NUM", "tail_number"),
        text("OP_CARRIER_FL_NUM", "flight_number"),
        text("ORIGIN_AIRPORT_ID", "origin_airport_id"),
        text("ORIGIN", "origin_airport_code"),
        text("ORIGIN_CITY_NAME", "origin_city_name"),
        text("ORIGIN_STATE_ABR", "origin_state_code"),
        text("DEST_AIRPORT_ID", "dest_airport_id"),
        text("DEST", "dest_airport_code"),
        text("DEST_CITY_NAME", "dest_city_name"),
        text("DEST_STATE_ABR", "dest_state_code"),
        whole("CRS_DEP_TIME", "scheduled_dep_time_hhmm"),
        number("DEP_TIME", "actual_dep_time_hhmm"),
        number("DEP_DELAY", "dep_delay_minutes"),
        number("DEP_DELAY_NEW", "dep_delay_minutes_pos"),
        is_one(c("DEP_DEL15")).alias("is_dep_delayed"),
        number("TAXI_OUT", "taxi_out_minutes"),
        number("WHEELS_OFF", "wheels_off_time_hhmm"),
        number("WHEELS_ON", "wheels_on_time_hhmm"),
        number("TAXI_IN", "taxi_in_minutes"),
        whole("CRS_ARR_TIME", "scheduled_arr_time_hhmm"),
        number("ARR_TIME", "actual_arr_time_hhmm"),
        number("ARR_DELAY", "arr_delay_minutes"),
        number("ARR_DELAY_NEW", "arr_delay_minutes_pos"),
        is_one(c("ARR_DEL15")).alias("is_arr_delayed"),
        is_one(c("CANCELLED")).alias("is_cancelled"),
        is_one(c("DIVERTED")).alias("is_diverted"),
        on_time.alias("is_on_time"),
        text("CANCELLATION_CODE", "cancellation_code"),
        labels.cancellation_reason(c("CANCELLATION_CODE")).alias("cancellation_reason"),
        number("CRS_ELAPSED_TIME", "scheduled_elapsed_minutes"),
        number("ACTUAL_ELAPSED_TIME", "actual_elapsed_minutes"),
        number("AIR_TIME", "air_time_minutes"),
        number("DISTANCE", "distance_miles"),
        whole("DISTANCE_GROUP", "distance_group"),
        *[minutes.alias(f"{name}_delay_minutes") for name, minutes in causes.items()],
        total.alias("total_cause_minutes"),
        c("_loaded_at").cast("timestamp").alias("loaded_at"),
        text("_source_file", "source_file"),
    ]


def stage_flights(raw: DataFrame) -> DataFrame:
    """One row per scheduled, non-diverted flight segment. Map-only."""
    return raw.filter(is_staged()).select(*staged_columns())


def _newest(raw: DataFrame, key: Column) -> DataFrame:
    """Newest load per key, ties settled by the larger text.

    A ``max`` over a struct combines before the shuffle, so a key with very many
    loads never has to fit one task, as it would under a row_number window.
    """
    load = F.struct(
        F.col("_loaded_at").cast("timestamp").alias("loaded_at"),
        F.col("Description").cast("string").alias("description"),
        F.col("Code").cast("string").alias("code"),
        F.col("_source_file").cast("string").alias("source_file"),
    )
    return raw.groupBy(key.alias("dedupe_key")).agg(F.max(load).alias("newest")).select("newest.*")


def stage_airlines(raw: DataFrame) -> DataFrame:
    """Newest row per airline id, with the carrier code read from the description."""
    code = extract_or_null(F.col("description"), r":\s*([^:]+)$")
    return (
        _newest(raw, F.col("Code").cast("string"))
        .withColumn("carrier_code", code)
        .select(
            F.col("code").alias("carrier_id"),
            "carrier_code",
            F.col("description").alias("airline_name_full"),
            labels.carrier_type(F.col("carrier_code")).alias("carrier_type"),
            "loaded_at",
            "source_file",
        )
    )


def stage_airports(raw: DataFrame) -> DataFrame:
    """Newest row per numeric airport id, with ``City, ST: Name`` taken apart.

    Ids that are not numbers share one key and so keep one row between them.
    """
    text = F.col("description")
    return _newest(raw, F.col("Code").try_cast("long")).select(
        F.col("code").alias("airport_id"),
        text.alias("airport_description_full"),
        F.trim(piece(text, ",", 0)).alias("city_name"),
        F.trim(piece(piece(text, ",", 1), ":", 0)).alias("state_code"),
        F.trim(piece(text, ":", 1)).alias("airport_name"),
        "loaded_at",
        "source_file",
    )
