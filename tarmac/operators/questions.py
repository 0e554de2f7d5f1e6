"""Answers to the business questions that need more than one table column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.numbers import percent, safe_divide


def _punctuality(flights: DataFrame, *keys) -> DataFrame:
    """On-time and valid arrivals of operated flights per key."""
    return (
        flights.filter(~F.col("is_cancelled"))
        .groupBy(*keys)
        .agg(
            F.count_if("is_on_time").alias("on_time"),
            F.count_if("is_arr_delayed").alias("delayed"),
            F.count("arr_delay_minutes").alias("arrivals"),
        )
    )


def carrier_consistency(flights: DataFrame) -> DataFrame:
    """How each carrier ranks by yearly on-time rate: mean, spread, best and worst rank."""
    yearly = _punctuality(flights, "carrier_code", "flight_year").withColumn(
        "otp", percent(F.col("on_time"), F.col("arrivals"))
    )
    best_first = Window.partitionBy("flight_year").orderBy(F.desc_nulls_last("otp"))
    ranked = yearly.withColumn("rank", F.rank().over(best_first).cast("long"))
    return ranked.groupBy("carrier_code").agg(
        F.count(F.lit(1)).alias("years"),
        F.round(F.avg("otp"), 4).alias("mean_yearly_otp"),
        F.round(F.avg("rank"), 4).alias("mean_rank"),
        F.round(F.stddev_pop("rank"), 4).alias("rank_spread"),
        F.min("rank").alias("best_rank"),
        F.max("rank").alias("worst_rank"),
    )


def carrier_significance(flights: DataFrame, critical_z: float = 1.96) -> DataFrame:
    """Two-proportion z-test of each carrier's on-time rate against all other carriers.

    Every carrier is compared with the rest of the industry rather than with
    every other carrier, so the work is one row per carrier.
    """
    carriers = _punctuality(flights, "carrier_code")
    everyone = carriers.agg(
        F.struct(F.sum("on_time").alias("on_time"), F.sum("arrivals").alias("arrivals")).alias("t")
    )
    total = everyone.scalar()
    row = carriers.withColumn("t", total)
    own, n = F.col("on_time"), F.col("arrivals")
    rest, m = F.col("t.on_time") - own, F.col("t.arrivals") - n
    pooled = safe_divide(F.col("t.on_time"), F.col("t.arrivals"))
    error = F.sqrt(pooled * (1 - pooled) * (safe_divide(F.lit(1.0), n) + safe_divide(F.lit(1.0), m)))
    z = safe_divide(safe_divide(own, n) - safe_divide(rest, m), error)
    return row.select(
        "carrier_code",
        n.alias("arrivals"),
        percent(own, n).alias("otp_pct"),
        percent(rest, m).alias("others_otp_pct"),
        F.round(z, 4).alias("z_score"),
        (F.abs(z) > critical_z).alias("is_significant"),
    )


def origin_delay_rank(flights: DataFrame) -> DataFrame:
    """Origin airports by the share of their flights that arrive late, worst first.

    Rates have two decimals, so the ranking runs over at most 10,001 of them and the
    airports take their rate's rank.
    """
    origins = _punctuality(flights, "origin_airport_code").withColumn(
        "delay_rate_pct", percent(F.col("delayed"), F.col("arrivals"))
    )
    rates = origins.groupBy(F.col("delay_rate_pct").alias("rate")).agg(F.count(F.lit(1)).alias("airports"))
    worse = Window.orderBy(F.desc_nulls_last("rate")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = rates.select("rate", (F.coalesce(F.sum("airports").over(worse), F.lit(0)) + 1).cast("long").alias("delay_rank"))
    return origins.join(ranks, F.col("delay_rate_pct").eqNullSafe(F.col("rate"))).select(
        "origin_airport_code", "arrivals", "delayed", "delay_rate_pct", "delay_rank"
    )


def seasonality(flights: DataFrame) -> DataFrame:
    """Delay rate and mean delay by month and weekday, with subtotals per month and overall.

    The rollup runs over the at most 84 month-weekday rows, not over flights.
    """
    cells = (
        flights.filter(~F.col("is_cancelled"))
        .groupBy("flight_month", "flight_day_of_week")
        .agg(
            F.count_if("is_arr_delayed").alias("delayed"),
            F.count("arr_delay_minutes").alias("arrivals"),
            F.sum("arr_delay_minutes").alias("minutes"),
        )
    )
    return cells.rollup("flight_month", "flight_day_of_week").agg(
        F.sum("arrivals").alias("arrivals"),
        percent(F.sum("delayed"), F.sum("arrivals")).alias("delay_rate_pct"),
        F.round(safe_divide(F.sum("minutes"), F.sum("arrivals")), 2).alias("mean_delay_min"),
    )


def volume_delay_corr(route_month_stats: DataFrame) -> DataFrame:
    """Correlation of a route-month's volume with its share of late flights."""
    n = F.col("total_operated_flights")
    rate = safe_divide(F.col("delayed_flights"), F.col("flights_with_valid_arr_delay"))
    return route_month_stats.agg(
        F.count(rate).alias("route_months"), F.round(F.corr(n.cast("double"), rate), 6).alias("correlation")
    )


def otp_projection(trend: DataFrame, since: tuple[int, int] = (2022, 1), months: int = 12) -> DataFrame:
    """On-time rate of the next months: linear trend plus the mean deviation of the same calendar month.

    ``trend`` is the monthly on-time trend; months before ``since`` are left out.
    """
    month_index = F.col("year") * 12 + F.col("month") - 1
    series = trend.select(
        month_index.cast("double").alias("t"),
        "month",
        (safe_divide(F.col("operated") - F.col("delayed"), F.col("operated")) * 100).alias("otp"),
    ).filter((F.col("t") >= since[0] * 12 + since[1] - 1) & F.col("otp").isNotNull())

    line = series.agg(
        F.regr_slope("otp", "t").alias("slope"),
        F.avg("otp").alias("mean_otp"),
        F.avg("t").alias("mean_t"),
        F.max("t").alias("last"),
    )
    ahead = line.select(
        "slope", "mean_otp", "mean_t", F.explode(F.sequence(F.lit(1), F.lit(months))).alias("step"), "last"
    ).withColumn("t", F.col("last") + F.col("step"))
    by_month = series.groupBy("month").agg(F.avg("otp").alias("month_otp"), F.avg("t").alias("month_t"))
    future = ahead.select(
        "*",
        F.floor(F.col("t") / 12).cast("long").alias("year"),
        (F.floor(F.col("t") % 12) + 1).cast("long").alias("month"),
    )

    def on_line(t: str):
        return F.col("mean_otp") + F.col("slope") * (F.col(t) - F.col("mean_t"))

    seasonal = F.coalesce(F.col("month_otp") - on_line("month_t"), F.lit(0.0))
    return future.join(by_month, "month", "left").select(
        "year",
        "month",
        F.round(on_line("t"), 4).alias("trend_otp"),
        F.round(on_line("t") + seasonal, 4).alias("projected_otp"),
    )
