"""Key figures of the executive report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.numbers import percent

# The business targets.
ON_TIME_TARGET, MEAN_DELAY_TARGET, CANCEL_TARGET = 80.0, 45.0, 2.0
PUNCTUAL_MINUTES = 15
TRACKED_CAUSES = ["carrier", "weather", "nas", "late_aircraft"]


def _rows() -> Column:
    return F.count(F.lit(1))


def _operated() -> Column:
    return ~F.col("is_cancelled")


def _mean_late() -> Column:
    delay = F.col("arr_delay_minutes")
    return F.round(F.avg(F.when(delay > PUNCTUAL_MINUTES, delay)), 2)


def _cause_shares() -> list[Column]:
    total = F.sum("total_cause_minutes")
    return [percent(F.sum(f"{c}_delay_minutes"), total).alias(f"{c}_contribution_pct") for c in TRACKED_CAUSES]


def executive_kpis(flights: DataFrame) -> DataFrame:
    """Punctuality, cancellations, mean delay, cause shares and volume per year and COVID phase."""
    on_time = F.count_if(_operated() & F.col("is_on_time"))
    return flights.groupBy("flight_year", "covid_period").agg(
        percent(on_time, F.count_if(_operated())).alias("otp_rate_pct"),
        percent(F.count_if("is_cancelled"), _rows()).alias("cancel_rate_pct"),
        _mean_late().alias("avg_arr_delay_min"),
        *_cause_shares(),
        F.count_if(_operated()).alias("operated_flights"),
    )


def on_time_rate(flights: DataFrame) -> DataFrame:
    """Share of operated flights at most 15 minutes late."""
    punctual = F.count_if(_operated() & (F.col("arr_delay_minutes") <= PUNCTUAL_MINUTES))
    rate = percent(punctual, F.count_if(_operated()))
    return flights.agg(rate.alias("on_time_rate_pct"), (rate >= ON_TIME_TARGET).alias("meets_target"))


def avg_arr_delay(flights: DataFrame) -> DataFrame:
    """Mean arrival delay of the flights more than 15 minutes late."""
    return flights.agg(
        _mean_late().alias("avg_arr_delay_min"), (_mean_late() <= MEAN_DELAY_TARGET).alias("meets_target")
    )


def cancel_rate(flights: DataFrame) -> DataFrame:
    rate = percent(F.count_if("is_cancelled"), _rows())
    return flights.agg(rate.alias("cancel_rate_pct"), (rate <= CANCEL_TARGET).alias("meets_target"))


def cause_contribution(flights: DataFrame) -> DataFrame:
    """Minutes of each tracked cause as a share of all recorded delay minutes."""
    return flights.agg(*_cause_shares())


def monthly_volume(flights: DataFrame) -> DataFrame:
    """Operated flights per month."""
    return flights.filter(_operated()).groupBy("flight_year", "flight_month").agg(_rows().alias("operated_flights"))

