"""Profiles of the raw flights: schema, missing values, trends, distributions, causes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.labels import CAUSES
from tarmac.functions.numbers import bin_number, percent, safe_divide
from tarmac.operators.quality import union_rows
from tarmac.schemas import RAW_CAUSES

KEY_COLUMNS = [
    "FL_DATE", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "ARR_DELAY", "ARR_DEL15", "CANCELLED",
    "DEP_DELAY", "TAXI_OUT", "TAXI_IN", "AIR_TIME", *RAW_CAUSES,
]
# cause label -> raw column
CAUSE_COLUMNS = {label: f"{name.upper()}_DELAY" for label, name in CAUSES.items()}


def _rows() -> Column:
    return F.count(F.lit(1))


def _unfold(df: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Each dict becomes one output row of every input row."""
    structs = [F.struct(*[column.alias(name) for name, column in row.items()]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def schema_profile(raw: DataFrame, columns_at_once: int = 20) -> DataFrame:
    """Type, NULL count and a sample value (the smallest) of every column.

    Columns are taken some at a time, texts apart from the rest: a pass reads its own columns only, keeps
    within what the JVM will compile, and the smallest of fixed-size values is found by a hash aggregate.
    """
    texts = [c for c, dtype in raw.dtypes if dtype == "string"]
    others = [c for c in raw.columns if c not in texts]
    passes = [part[i : i + columns_at_once] for part in (texts, others) for i in range(0, len(part), columns_at_once)]
    return union_rows([_columns_profile(raw.select(*columns)) for columns in passes])


def _columns_profile(raw: DataFrame) -> DataFrame:
    measured = raw.agg(
        _rows().alias("rows"),
        *[F.count(c).alias(f"{c}__n") for c in raw.columns],
        *[F.min(c).cast("string").alias(f"{c}__low") for c in raw.columns],
    )
    return _unfold(
        measured,
        [
            {
                "column_name": F.lit(name),
                "dtype": F.lit(dtype),
                "non_null_count": F.col(f"{name}__n"),
                "null_count": F.col("rows") - F.col(f"{name}__n"),
                "null_pct": percent(F.col("rows") - F.col(f"{name}__n"), F.col("rows")),
                "sample_value": F.coalesce(f"{name}__low", F.lit("ALL NULL")),
            }
            for name, dtype in raw.dtypes
        ],
    )


def missing(raw: DataFrame, columns: list[str] = KEY_COLUMNS) -> DataFrame:
    """NULL count and share of the key columns, worst first."""
    measured = raw.agg(_rows().alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _unfold(
        measured,
        [
            {"column_name": F.lit(c), "null_count": F.col(c), "null_pct": percent(F.col(c), F.col("rows"))}
            for c in columns
        ],
    ).orderBy(F.desc("null_pct"), "column_name")


def status(raw: DataFrame) -> DataFrame:
    """Cancelled, on-time and delayed flights and their share of all rows."""
    flags = {
        "Cancelled": F.col("CANCELLED") == 1,
        "On-Time": F.col("ARR_DEL15") == 0,
        "Delayed": F.col("ARR_DEL15") == 1,
    }
    measured = raw.agg(_rows().alias("rows"), *[F.count_if(flag).alias(name) for name, flag in flags.items()])
    return _unfold(
        measured,
        [{"status": F.lit(n), "flights": F.col(n), "pct": percent(F.col(n), F.col("rows"))} for n in flags],
    )


def cause_nulls(raw: DataFrame) -> DataFrame:
    """Share of delayed flights without each cause."""
    measured = raw.filter(F.col("ARR_DEL15") == 1).agg(
        _rows().alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in RAW_CAUSES]
    )
    return _unfold(
        measured,
        [
            {"cause": F.lit(c), "null_count": F.col(c), "null_pct": percent(F.col(c), F.col("rows"))}
            for c in RAW_CAUSES
        ],
    )


def monthly_otp_trend(raw: DataFrame) -> DataFrame:
    """Flights, cancellations and on-time rate per month."""
    operated = F.col("total_flights") - F.col("cancelled")
    return (
        raw.groupBy("YEAR", "MONTH")
        .agg(
            F.sum("FLIGHTS").alias("total_flights"),
            F.sum("CANCELLED").alias("cancelled"),
            F.sum("ARR_DEL15").alias("delayed"),
        )
        .select(
            F.col("YEAR").alias("year"),
            F.col("MONTH").alias("month"),
            "total_flights",
            "cancelled",
            "delayed",
            operated.alias("operated"),
            percent(operated - F.col("delayed"), operated).alias("otp_rate"),
            percent(F.col("cancelled"), F.col("total_flights")).alias("cancel_rate"),
        )
    )


def covid_volume_change(
    trend: DataFrame, baseline: int = 2019, low: tuple[int, list[int]] = (2020, [4, 5]), recovery: int = 2023
) -> DataFrame:
    """Mean monthly operated flights before, at the low of and after the pandemic."""
    year, month, operated = F.col("year"), F.col("month"), F.col("operated")
    means = trend.agg(
        F.avg(F.when(year == baseline, operated)).alias("before"),
        F.avg(F.when((year == low[0]) & month.isin(low[1]), operated)).alias("at_low"),
        F.avg(F.when(year == recovery, operated)).alias("after"),
    )

    def change(name: str) -> Column:
        return F.round((safe_divide(F.col(name), F.col("before")) - 1) * 100, 2)

    return means.select(
        F.round("before", 2).alias("mean_before"),
        F.round("at_low", 2).alias("mean_at_low"),
        change("at_low").alias("low_change_pct"),
        F.round("after", 2).alias("mean_after"),
        change("after").alias("after_change_pct"),
    )


def operated_delays(raw: DataFrame) -> DataFrame:
    """Arrival delays of the flights that were not cancelled."""
    return raw.filter((F.col("CANCELLED") == 0) & F.col("ARR_DELAY").isNotNull()).select("ARR_DELAY")


def delay_counts(delays: DataFrame) -> DataFrame:
    """Flights per distinct delay: all that histograms and quantiles need."""
    return delays.groupBy("ARR_DELAY").agg(_rows().alias("n"))


# histogram -> smallest delay left out, low edge, high edge, bins
HISTOGRAMS = {"all": (None, -60, 300, 100), "late": (15, 15, 500, 80)}


def delay_distribution(raw: DataFrame) -> DataFrame:
    """Clipped histograms of all delays and of those over 15 minutes, empty bins included.

    Both are read off the same flights per distinct delay.
    """
    delay = F.col("ARR_DELAY")
    spark = raw.sparkSession

    def bin_of(name: str) -> Column:
        above, low, high, bins = HISTOGRAMS[name]
        entry = F.struct(F.lit(name).alias("histogram"), bin_number(delay, low, high, bins).alias("bin"))
        return entry if above is None else F.when(delay > above, entry)

    def edges(name: str) -> DataFrame:
        _, low, high, bins = HISTOGRAMS[name]
        start = F.lit(float(low)) + F.col("id") * ((high - low) / bins)
        return spark.range(bins).select(
            F.lit(name).alias("histogram"), (F.col("id") + 1).alias("bin"), F.round(start, 4).alias("lower_edge")
        )

    filled = (
        delay_counts(operated_delays(raw))
        .select("n", F.inline(F.array_compact(F.array(*map(bin_of, HISTOGRAMS)))))
        .groupBy("histogram", "bin")
        .agg(F.sum("n").alias("flights"))
    )
    return (
        edges("all")
        .unionByName(edges("late"))
        .join(filled, ["histogram", "bin"], "left")
        .select("histogram", "bin", "lower_edge", F.coalesce("flights", F.lit(0)).alias("flights"))
    )


def _moments(value: str, weight: str) -> dict[str, Column]:
    """Sample mean, deviation, skewness and excess kurtosis of weighted values.

    Sums of whole minutes are exact, so the result does not depend on the order
    in which partitions are combined.
    """
    x, w = F.col(value), F.col(weight)
    n = F.sum(w)
    m1, m2, m3, m4 = (F.sum(w * F.pow(x, F.lit(k))) / n for k in (1, 2, 3, 4))
    v2 = m2 - m1 * m1
    v3 = m3 - 3 * m1 * m2 + 2 * m1 * m1 * m1
    v4 = m4 - 4 * m1 * m3 + 6 * m1 * m1 * m2 - 3 * m1 * m1 * m1 * m1
    skew = v3 / (v2 * F.sqrt(v2))
    excess = v4 / (v2 * v2) - 3
    return {
        "mean": m1,
        "std": F.sqrt(v2 * n / (n - 1)),
        "skewness": F.sqrt(n * (n - 1)) / (n - 2) * skew,
        "kurtosis": (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * excess + 6),
    }


def delay_describe(raw: DataFrame) -> DataFrame:
    """Count, moments, extremes and interpolated quartiles of the arrival delay.

    Flights are counted per distinct delay first; quartiles and moments come
    from those counts.
    """
    quartiles = F.percentile("ARR_DELAY", [0.25, 0.5, 0.75], F.col("n"))
    moments = _moments("ARR_DELAY", "n")
    return delay_counts(operated_delays(raw)).agg(
        F.sum("n").alias("count"),
        F.round(moments["mean"], 4).alias("mean"),
        F.round(moments["std"], 4).alias("std"),
        F.min("ARR_DELAY").alias("min"),
        F.get(quartiles, F.lit(0)).alias("q25"),
        F.get(quartiles, F.lit(1)).alias("median"),
        F.get(quartiles, F.lit(2)).alias("q75"),
        F.max("ARR_DELAY").alias("max"),
        F.round(moments["skewness"], 4).alias("skewness"),
        F.round(moments["kurtosis"], 4).alias("kurtosis"),
    )


def cause_share(raw: DataFrame) -> DataFrame:
    """Minutes and share of each cause over all delayed flights with causes, largest first."""
    sums = raw.filter((F.col("ARR_DEL15") == 1) & F.col("CARRIER_DELAY").isNotNull()).agg(
        *[F.sum(c).alias(label) for label, c in CAUSE_COLUMNS.items()]
    )
    total = sum((F.col(label) for label in list(CAUSE_COLUMNS)[1:]), F.col("Carrier"))
    return _unfold(
        sums,
        [
            {"cause": F.lit(label), "minutes": F.col(label), "share_pct": percent(F.col(label), total)}
            for label in CAUSE_COLUMNS
        ],
    ).orderBy(F.desc("minutes"), "cause")


def cause_share_by_year(raw: DataFrame) -> DataFrame:
    """Share of each cause per year."""
    names = list(CAUSES.values())
    total = sum((F.coalesce(name, F.lit(0.0)) for name in names[1:]), F.coalesce(names[0], F.lit(0.0)))
    return (
        raw.filter(F.col("ARR_DEL15") == 1)
        .groupBy(F.col("YEAR").alias("year"))
        .agg(*[F.sum(f"{name.upper()}_DELAY").alias(name) for name in names])
        .select("year", *[percent(F.col(name), total).alias(f"{name}_pct") for name in names])
    )


def summary(raw: DataFrame, year: int = 2019) -> DataFrame:
    """One-row overview: volume, carriers, delay figures and one year's cancellation rate.

    One pass counts flights per carrier, year, cancellation flag and distinct
    delay; everything else is read off those counts.
    """
    in_year = F.col("YEAR") == year
    counts = raw.groupBy("OP_UNIQUE_CARRIER", "YEAR", "ARR_DELAY").agg(
        _rows().alias("n"), F.sum("CANCELLED").alias("cancelled")
    )
    timed = F.when(F.col("ARR_DELAY").isNotNull(), F.col("n")).otherwise(0)
    moments = _moments("ARR_DELAY", "timed")
    return counts.withColumn("timed", timed).agg(
        F.sum("n").alias("total_records"),
        F.count_distinct("OP_UNIQUE_CARRIER").alias("unique_carriers"),
        F.round(moments["mean"], 4).alias("arr_delay_mean"),
        F.percentile("ARR_DELAY", 0.5, F.col("timed")).alias("arr_delay_median"),
        F.round(moments["std"], 4).alias("arr_delay_std"),
        F.round(moments["skewness"], 4).alias("arr_delay_skewness"),
        percent(F.sum(F.when(in_year, F.col("cancelled"))), F.sum(F.when(in_year, F.col("n")))).alias(
            "cancelled_rate_year_pct"
        ),
    )
