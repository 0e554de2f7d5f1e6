"""Monthly statistics per carrier and route.

Only ``delay_counts`` reads flights. Everything after it works on one row
per carrier, route and month, whose number does not grow with the flights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions import labels
from tarmac.functions.numbers import or_zero, percent
from tarmac.operators.staging import CAUSE_NAMES

ROUTE_COLUMNS = [
    "carrier_id",
    "carrier_code",
    "carrier_type",
    "route_key",
    "origin_airport_id",
    "dest_airport_id",
    "origin_airport_code",
    "dest_airport_code",
    "origin_state_code",
    "dest_state_code",
    "route_distance_category",
]
ROUTE_MONTH = ["carrier_code", "route_key", "month_start"]
CAUSE_TOTALS = [f"total_{name}_delay_min" for name in CAUSE_NAMES]
MINUTE_TOTALS = [*CAUSE_TOTALS, "total_delay_minutes"]
COUNT_KEYS = ["month_start", *ROUTE_COLUMNS, "arr_delay_minutes"]
COUNTS = ["total_operated_flights", "delayed_flights", "on_time_flights", "flights_with_valid_arr_delay"]


def operated(enriched: DataFrame) -> DataFrame:
    return enriched.filter(~F.col("is_cancelled"))


def with_month(flights: DataFrame) -> DataFrame:
    return flights.withColumn("month_start", F.trunc("flight_date", "month"))


def route_universe(months: DataFrame) -> DataFrame:
    """Distinct route attribute sets with their first and last active month.

    ``months`` is anything with the route columns and ``month_start``: operated
    flights through ``with_month``, or the smaller result of ``route_month_stats``.
    """
    return months.groupBy(*ROUTE_COLUMNS).agg(
        F.min("month_start").alias("first_month"), F.max("month_start").alias("last_month")
    )


def calendar_month_attributes(months: DataFrame) -> DataFrame:
    """Season and phase of every month that has flights; both are the same all month."""
    return (
        months.select("month_start")
        .distinct()
        .select(
            "month_start",
            labels.season(F.month("month_start")).alias("flight_season"),
            labels.covid_phase(F.col("month_start")).alias("covid_period"),
        )
    )


def delay_counts(flights: DataFrame) -> DataFrame:
    """Operated flights and their totals per route, month and distinct arrival delay.

    This combines before the shuffle and leaves at most a few thousand rows per
    route-month however many flights it has. All of it are sums, so counts of
    several loads can be kept apart and merged later.
    """
    sources = [*[f"{name}_delay_minutes" for name in CAUSE_NAMES], "total_cause_minutes"]
    return (
        with_month(flights)
        .groupBy(*COUNT_KEYS)
        .agg(
            F.count(F.lit(1)).alias("flights"),
            F.count_if("is_arr_delayed").alias("delayed"),
            F.count_if("is_on_time").alias("on_time"),
            *[F.sum(or_zero(F.col(s))).alias(t) for s, t in zip(sources, MINUTE_TOTALS, strict=True)],
            F.sum("distance_miles").alias("miles"),
            F.count("distance_miles").alias("measured"),
        )
    )


def merged_counts(counts: DataFrame) -> DataFrame:
    """Counts of any number of loads, or parts of one, as those of all their flights."""
    sums = [c for c in counts.columns if c not in COUNT_KEYS]
    return counts.groupBy(*COUNT_KEYS).agg(*[F.sum(c).alias(c) for c in sums])


def stats_from_counts(per_delay: DataFrame) -> DataFrame:
    """Volume, punctuality, delay and cause totals per route and month, from one row per distinct delay.

    The median is exact: a running count over the distinct delays finds the middle.
    """
    c = F.col
    keys = ["month_start", *ROUTE_COLUMNS]
    delay = c("arr_delay_minutes")
    group = Window.partitionBy(*keys)
    counted = (
        per_delay.withColumn("timed", F.when(delay.isNotNull(), c("flights")).otherwise(0))
        .withColumn("so_far", F.sum("timed").over(group.orderBy("arr_delay_minutes")))
        .withColumn("timed_in_all", F.sum("timed").over(group))
    )

    late_minutes = F.sum(F.when(c("delayed") > 0, delay * c("delayed")))
    late_flights = F.sum(F.when(delay.isNotNull(), c("delayed")))
    return (
        counted.groupBy(*keys)
        .agg(
            F.sum("flights").alias("total_operated_flights"),
            F.sum("delayed").alias("delayed_flights"),
            F.sum("on_time").alias("on_time_flights"),
            F.sum("timed").alias("flights_with_valid_arr_delay"),
            percent(F.sum("on_time"), F.sum("timed")).alias("otp_rate_pct"),
            F.round(F.try_divide(F.sum(delay * c("timed")), F.sum("timed")), 2).alias("avg_arr_delay_all"),
            F.round(F.try_divide(late_minutes, late_flights), 2).alias("avg_arr_delay_delayed_only"),
            F.round(F.max(delay), 2).alias("max_arr_delay"),
            F.min(F.when((c("timed") > 0) & (c("so_far") * 2 >= c("timed_in_all")), delay)).alias("median_arr_delay"),
            *[F.sum(t).alias(t) for t in MINUTE_TOTALS],
            F.round(F.try_divide(F.sum("miles"), F.sum("measured")), 2).alias("avg_distance_miles"),
        )
    )


def route_month_stats(flights: DataFrame) -> DataFrame:
    """The statistics of operated flights, counted and summed up in one plan."""
    return stats_from_counts(delay_counts(flights))


def route_month_spine(universe: DataFrame) -> DataFrame:
    """Every month between the first and last active month of each route."""
    months = F.sequence("first_month", "last_month", F.expr("interval 1 month"))
    return universe.select(*ROUTE_COLUMNS, F.explode(months).alias("month_start"))


def route_month_filled(spine: DataFrame, stats: DataFrame, month_attributes: DataFrame) -> DataFrame:
    """The spine with its statistics; months without flights get zero counts and NULL rates."""
    metrics = [c for c in stats.columns if c not in ROUTE_COLUMNS and c != "month_start"]
    month = F.col("month_start")
    zero_filled = {*COUNTS, *CAUSE_TOTALS, "total_delay_minutes"}
    return (
        spine.join(stats.select(*ROUTE_MONTH, *metrics), ROUTE_MONTH, "left")
        .join(month_attributes, "month_start", "left")
        .select(
            F.date_format(month, "yyyyMMdd").cast("long").alias("flight_date_key"),
            F.year(month).cast("long").alias("flight_year"),
            F.month(month).cast("long").alias("flight_month"),
            labels.month_name(F.month(month)).alias("flight_month_name"),
            F.quarter(month).cast("long").alias("flight_quarter"),
            "month_start",
            "flight_season",
            "covid_period",
            *ROUTE_COLUMNS,
            *[F.coalesce(m, F.lit(0)).alias(m) if m in zero_filled else F.col(m) for m in metrics],
        )
    )


def _has_volume(min_flights: int):
    return F.col("total_operated_flights") >= min_flights


def route_otp_windows(filled: DataFrame, chronic_otp: float = 70, min_flights: int = 30) -> DataFrame:
    """Three-month on-time rate, rates one month and one year back, and below-threshold flags."""
    otp = F.col("otp_rate_pct")
    history = Window.partitionBy("carrier_code", "route_key").orderBy("month_start")
    quarter = history.rowsBetween(-2, Window.currentRow)
    below = F.col("is_below_chronic_threshold")
    return (
        filled.withColumn(
            "is_below_chronic_threshold",
            F.coalesce((otp < chronic_otp) & _has_volume(min_flights), F.lit(False)),
        )
        .select(
            *filled.columns,
            percent(
                F.sum("on_time_flights").over(quarter), F.sum("flights_with_valid_arr_delay").over(quarter)
            ).alias("otp_rate_3m_avg"),
            F.lag(otp, 12).over(history).alias("otp_rate_same_month_prev_year"),
            F.lag(otp, 1).over(history).alias("otp_rate_prev_month"),
            below,
            F.lag(below, 1).over(history).alias("prev_month_below_threshold"),
            F.lag(below, 2).over(history).alias("prev2_month_below_threshold"),
        )
    )


def route_worst_rank(filled: DataFrame, min_flights: int = 30) -> DataFrame:
    """Rank of each route by lowest on-time rate within carrier and month."""
    otp = F.col("otp_rate_pct")
    worst_first = Window.partitionBy("carrier_code", "month_start").orderBy(otp.asc())
    return filled.filter(_has_volume(min_flights) & otp.isNotNull()).select(
        *ROUTE_MONTH, F.rank().over(worst_first).cast("long").alias("route_rank_worst_otp")
    )


def route_stats(windows: DataFrame, ranks: DataFrame) -> DataFrame:
    """Final route-month table: chronic flag, bands, changes and dominant cause."""
    c = F.col
    otp = c("otp_rate_pct")
    chronic = (
        c("is_below_chronic_threshold")
        & F.coalesce("prev_month_below_threshold", F.lit(False))
        & F.coalesce("prev2_month_below_threshold", F.lit(False))
    )
    totals = [f"total_{name}_delay_min" for name in labels.CAUSES.values()]
    return windows.join(ranks, ROUTE_MONTH, "left").select(
        *windows.columns,
        F.greatest(*totals).alias("max_cause_delay_min"),
        "route_rank_worst_otp",
        chronic.alias("is_chronic_delay_route"),
        labels.otp_band(otp).alias("otp_performance_band"),
        F.round(otp - c("otp_rate_prev_month"), 2).alias("otp_rate_mom_change"),
        F.round(otp - c("otp_rate_same_month_prev_year"), 2).alias("otp_rate_yoy_change"),
        labels.dominant_cause().alias("dominant_delay_cause"),
    )
