"""The named queries, each over the driver tables of one scale folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.operators import dimensions, facts, kpis, profiling, quality, questions, routes, verification
from tarmac.plans import declared_checks
from tarmac.plans.route_state import RouteState
from tarmac.plans.warehouse import Warehouse
from tarmac.schemas import FLIGHT_FILE_COLUMNS
from tarmac.session import setting, tune
from tarmac.sources import landing
from tarmac.sources.tables import fresh_folder

AS_OF = dt.datetime(2024, 3, 1)
LOADED_AT = dt.datetime(2024, 1, 15)
FIRST_MONTH = dt.date(2019, 1, 1)
# Part files of landed months that a task writes side by side, and the rows of one, which one task reads again.
MONTHS_OPEN = 200
ROWS_PER_PART = 1 << 18

WarehouseQuery = Callable[[Warehouse], DataFrame]


def _without_stamp(df: DataFrame) -> DataFrame:
    return df.drop("dw_loaded_at", "dw_last_refreshed_at")


# --- landed files -------------------------------------------------------------


def _filing_month(on_time: bool):
    """Month whose file a flight is found in: its own, or for late filing the next one when it has no clock time.

    A flight without a date is in the file of its year and month, or else in the first.
    """
    own = F.coalesce(F.trunc("FL_DATE", "month"), F.trunc(F.make_date("YEAR", "MONTH", F.lit(1)), "month"), F.lit(FIRST_MONTH))
    return own if on_time else F.when(F.col("CRS_DEP_TIME").isNull(), F.add_months(own, 1)).otherwise(own)


def land_flights(raw: DataFrame, on_time: bool = True) -> str:
    """Write flights as monthly CSV files in two layouts; returns their folder.

    Odd months come as exported: US dates, quoted cities, a trailing empty
    column. Even months have ISO dates, other column order and an extra column.
    Flights are not moved: each task adds gzipped part files of its own to the months it holds, all of them
    open at once, so that rows need no order. More months than ``MONTHS_OPEN`` in a task are sorted.
    """
    folder = fresh_folder(raw.sparkSession, "landing")
    filed = raw.drop("_loaded_at", "_source_file").withColumn("filed", _filing_month(on_time)).withColumn(
        "file", F.concat(F.lit("ontime_"), F.date_format("filed", "yyyy_MM"), F.lit(".csv"))
    )
    names = list(FLIGHT_FILE_COLUMNS)
    us_date = F.concat(F.date_format("FL_DATE", "M/d/yyyy"), F.lit(" 12:00:00 AM"))
    layouts = [
        (F.month("filed") % 2 == 1, [us_date.alias("FL_DATE") if c == "FL_DATE" else F.col(c) for c in names]
         + [F.lit(None).cast("string").alias("Unnamed: 48")]),
        (F.month("filed") % 2 == 0, [F.lit("x").alias("EXTRA"), *map(F.col, reversed(names))]),
    ]
    with setting(raw.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", MONTHS_OPEN):
        for chosen, columns in layouts:
            (
                filed.filter(chosen)
                .select("file", *columns)
                .write.mode("append")
                .partitionBy("file")
                .option("maxRecordsPerFile", ROWS_PER_PART)
                .option("compression", "gzip")
                .option("zlib.compress.level", "BEST_SPEED")
                .option("header", "true")
                .option("escape", '"')
                .csv(folder)
            )
    return folder


_landed: dict[tuple, str] = {}


def landed(w: Warehouse, on_time: bool = True) -> str:
    """The folder of a warehouse's landed files; the landing queries of a session share one for each way of filing."""
    key = (w.spark.sparkContext.applicationId, w.name, on_time)
    if w.name is None or key not in _landed:
        _landed[key] = land_flights(w.raw_flights, on_time)
    return _landed[key]


def _landed_cells(w: Warehouse, on_time: bool = True) -> DataFrame:
    return landing.read_month_files(w.spark, landing.month_files(w.spark, landed(w, on_time)))


def ingest_flights(w: Warehouse) -> DataFrame:
    return landing.ingest_flights(_landed_cells(w), LOADED_AT)


def months_to_load(w: Warehouse) -> DataFrame:
    """Months of the landed files that a table loaded up to 2020 still lacks."""
    files = landing.month_files(w.spark, landed(w))
    before = w.raw_flights.filter(F.col("FL_DATE") < F.lit(dt.date(2021, 1, 1)))
    return landing.months_to_load(files, landing.table_months(before)).select("year", "month", "filename")


def load_append(w: Warehouse) -> DataFrame:
    """Rows per month and file after two loads, the second of which skips the months of the first."""
    table = fresh_folder(w.spark, "raw-flights")
    landing.load_months(w.spark, landed(w), table, LOADED_AT, years=(2019, 2020))
    landing.load_months(w.spark, landed(w), table, LOADED_AT)
    return (
        w.spark.read.parquet(table)
        .groupBy("YEAR", "MONTH", "_source_file")
        .agg(F.count(F.lit(1)).alias("table_rows"), F.sum("ARR_DELAY").alias("delay_minutes"))
    )


def load_reconcile(w: Warehouse) -> DataFrame:
    table = fresh_folder(w.spark, "raw-flights")
    return landing.load_months(w.spark, landed(w, on_time=False), table, LOADED_AT).drop("error", "uploaded_at")


def load_audit(w: Warehouse) -> DataFrame:
    """The audit files of two loads, read back: each load's files against what the table held of their months then."""
    table, audit = fresh_folder(w.spark, "raw-flights"), fresh_folder(w.spark, "load-audit")
    for years in ((2019, 2020), None):
        landing.save_audit(landing.load_months(w.spark, landed(w, on_time=False), table, LOADED_AT, years=years), audit)
    return landing.read_audit(w.spark, audit).drop("error")


def load_lookups(w: Warehouse) -> DataFrame:
    """Both lookups through their files: airlines in UTF-8, airports in Latin-1."""
    folder = fresh_folder(w.spark, "lookups")
    loads = []
    for name, table, encoding in (
        ("L_AIRLINE_ID.csv", w.raw_airlines, "UTF-8"),
        ("L_AIRPORT.csv", w.raw_airports, "ISO-8859-1"),
    ):
        accented = F.concat("Description", F.lit(' "é"'))
        rows = table.select("Code", accented.alias("Description"), F.lit(1).alias("Unused"))
        rows.write.option("header", "true").option("escape", '"').option("encoding", encoding).csv(f"{folder}/{name}")
        loads.append(landing.load_lookup(w.spark, f"{folder}/{name}", f"{folder}/loaded-{name}", LOADED_AT))
    return loads[0].unionByName(loads[1]).select("Code", "Description", "_source_file")


def file_month_check(w: Warehouse) -> DataFrame:
    return landing.file_month_check(_landed_cells(w, on_time=False))


def missing_files(w: Warehouse) -> DataFrame:
    found = landing.month_files(w.spark, landed(w))
    return landing.missing_files(landing.expected_months(w.spark), found)


def route_stats_merged(w: Warehouse) -> DataFrame:
    """The route statistics from two loads, the second of which adds months and the late flights of an earlier one."""
    state = RouteState(w.spark, fresh_folder(w.spark, "route-state"))
    date = F.col("flight_date")
    late = (F.trunc(date, "month") == F.lit(dt.date(2020, 6, 1))) & F.col("scheduled_dep_time_hhmm").isNull()
    second = (date >= F.lit(dt.date(2021, 1, 1))) | late
    for load, flights in (("first", w.operated.filter(~second)), ("second", w.operated.filter(second))):
        state.add_load(load, flights)
        state.refresh()
    return state.route_stats()


# --- registry -----------------------------------------------------------------

MODELS: dict[str, WarehouseQuery] = {
    "stg_flights": lambda w: w.stg_flights,
    "stg_airlines": lambda w: w.stg_airlines,
    "stg_airports": lambda w: w.stg_airports,
    "flights_enriched": lambda w: w.flights_enriched,
    "delay_classified": lambda w: w.delay_classified,
    "route_universe": lambda w: routes.route_universe(routes.with_month(w.operated)),
    "calendar_month_attributes": lambda w: routes.calendar_month_attributes(routes.with_month(w.operated)),
    "route_month_spine": lambda w: routes.route_month_spine(routes.route_universe(routes.with_month(w.operated))),
    "route_month_stats": lambda w: w.route_month_stats,
    "route_month_filled": lambda w: w.route_month_filled,
    "route_otp_windows": lambda w: w.route_otp_windows,
    "route_worst_rank": lambda w: w.route_worst_rank,
    "route_stats": lambda w: w.route_stats,
    "route_stats_merged": route_stats_merged,
    "dim_date": lambda w: _without_stamp(dimensions.flights_per_day(w.dim_date, w.fact_flights)),
    "dim_carrier": lambda w: _without_stamp(w.dim_carrier),
    "dim_airport": lambda w: w.dim_airport,
    "dim_route": lambda w: _without_stamp(w.dim_route),
    "dim_delay_cause": lambda w: dimensions.minutes_per_cause(w.dim_delay_cause, w.fact_flights),
    "fact_flights": lambda w: w.fact_flights,
    "fact_route_monthly": lambda w: _without_stamp(w.fact_route_monthly),
    "executive_kpis": lambda w: w.executive_kpis,
    "route_stats_null_volume": lambda w: facts.route_stats_null_volume(w.route_stats),
}

LANDING: dict[str, WarehouseQuery] = {
    "ingest_flights": ingest_flights,
    "months_to_load": months_to_load,
    "load_append": load_append,
    "load_reconcile": load_reconcile,
    "load_audit": load_audit,
    "load_lookups": load_lookups,
    "file_month_check": file_month_check,
    "missing_files": missing_files,
}

VERIFICATION: dict[str, WarehouseQuery] = {
    "verify_rows_by_year": lambda w: verification.rows_by_year(w.raw_flights),
    "verify_rows_by_month": lambda w: verification.rows_by_month(w.raw_flights),
    "verify_carriers": lambda w: verification.carriers(w.raw_flights),
    "verify_null_rates": lambda w: verification.null_rates(w.raw_flights),
    "verify_cause_coverage": lambda w: verification.cause_coverage(w.raw_flights),
    "verify_lineage": lambda w: verification.lineage(w.raw_flights),
    "verify_lookup_counts": lambda w: verification.lookup_counts(w.raw_airlines, w.raw_airports),
    "verify_carrier_join": lambda w: verification.carrier_join(w.raw_flights, w.stg_airlines),
    "verify_duplicates": lambda w: verification.duplicates(w.raw_flights),
}

QUALITY: dict[str, WarehouseQuery] = {
    "dq_not_null": declared_checks.not_null_checks,
    "dq_unique": declared_checks.unique_checks,
    "dq_accepted_values": declared_checks.accepted_values_checks,
    "dq_relationships": declared_checks.relationship_checks,
    "dq_freshness": lambda w: quality.freshness(w.raw_flights, AS_OF),
    "dq_scorecard": lambda w: quality.scorecard(w.raw_flights),
    "dq_cause_sum": lambda w: quality.cause_sum(w.raw_flights),
    "dq_natural_key_dups": lambda w: quality.natural_key_dups(w.raw_flights),
}

PROFILING: dict[str, WarehouseQuery] = {
    "profile_schema": lambda w: profiling.schema_profile(w.raw_flights),
    "profile_missing": lambda w: profiling.missing(w.raw_flights),
    "profile_status": lambda w: profiling.status(w.raw_flights),
    "profile_cause_nulls": lambda w: profiling.cause_nulls(w.raw_flights),
    "monthly_otp_trend": lambda w: profiling.monthly_otp_trend(w.raw_flights),
    "covid_volume_change": lambda w: profiling.covid_volume_change(
        profiling.monthly_otp_trend(w.raw_flights), recovery=2022
    ),
    "delay_distribution": lambda w: profiling.delay_distribution(w.raw_flights),
    "delay_describe": lambda w: profiling.delay_describe(w.raw_flights),
    "cause_share": lambda w: profiling.cause_share(w.raw_flights),
    "cause_share_by_year": lambda w: profiling.cause_share_by_year(w.raw_flights),
    "profile_summary": lambda w: profiling.summary(w.raw_flights),
}

KPIS: dict[str, WarehouseQuery] = {
    "kpi_on_time_rate": lambda w: kpis.on_time_rate(w.reported_flights),
    "kpi_avg_arr_delay": lambda w: kpis.avg_arr_delay(w.reported_flights),
    "kpi_cancel_rate": lambda w: kpis.cancel_rate(w.reported_flights),
    "kpi_cause_contribution": lambda w: kpis.cause_contribution(w.reported_flights),
    "kpi_monthly_volume": lambda w: kpis.monthly_volume(w.reported_flights),
}

QUESTIONS: dict[str, WarehouseQuery] = {
    "carrier_consistency": lambda w: questions.carrier_consistency(w.reported_flights),
    "carrier_significance": lambda w: questions.carrier_significance(w.reported_flights),
    "origin_delay_rank": lambda w: questions.origin_delay_rank(w.reported_flights),
    "seasonality": lambda w: questions.seasonality(w.reported_flights),
    "volume_delay_corr": lambda w: questions.volume_delay_corr(w.route_month_stats),
    "otp_projection": lambda w: questions.otp_projection(
        profiling.monthly_otp_trend(w.raw_flights), since=(2020, 7)
    ),
}

WAREHOUSE_QUERIES = MODELS | LANDING | VERIFICATION | QUALITY | PROFILING | KPIS | QUESTIONS


def comparable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, so that any client compares them alike."""
    formats = {T.DateType(): "yyyy-MM-dd", T.TimestampType(): "yyyy-MM-dd HH:mm:ss"}
    return df.select(
        *[
            F.date_format(f.name, formats[f.dataType]).alias(f.name) if f.dataType in formats else F.col(f.name)
            for f in df.schema
        ]
    )


def _bound(query: WarehouseQuery) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: comparable(query(Warehouse.of_driver_tables(tune(spark), sf_dir, AS_OF)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bound(query) for name, query in WAREHOUSE_QUERIES.items()}
