"""Data-quality checks. Every check returns rows, one per checked column or rule."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.numbers import safe_divide
from tarmac.schemas import NATURAL_KEY, RAW_CAUSES


def _status(failures: Column, otherwise: str = "FAIL") -> Column:
    return F.when(failures == 0, "PASS").otherwise(otherwise)


def union_rows(parts: list[DataFrame]) -> DataFrame:
    """One table of all parts, united in pairs so that no plan is analysed over and over."""
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [pair[0].union(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return parts[0]


def _tidy(table: str, counts: DataFrame, columns: list[str], otherwise: str = "FAIL") -> DataFrame:
    """One row of counts to one row per column."""
    rows = F.inline(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("failures")) for c in columns])
    )
    return counts.select(F.lit(table).alias("table_name"), rows).withColumn(
        "status", _status(F.col("failures"), otherwise)
    )


def _missing(columns: list[str]) -> dict[str, Column]:
    return {c: F.col(c).isNull() for c in columns}


def _outside(accepted: dict[str, list]) -> dict[str, Column]:
    return {c: ~F.col(c).isin(values) for c, values in accepted.items()}


def _failing_rows(table: str, df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return _tidy(table, df.agg(*[F.count_if(bad).alias(c) for c, bad in conditions.items()]), list(conditions))


def not_null(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows missing each column, all columns in one pass."""
    return _failing_rows(table, df, _missing(columns))


def accepted_values(table: str, df: DataFrame, accepted: dict[str, list]) -> DataFrame:
    """Rows outside each column's value list, all columns in one pass; NULL is not a failure."""
    return _failing_rows(table, df, _outside(accepted))


def row_checks(table: str, df: DataFrame, columns: list[str], accepted: dict[str, list]) -> DataFrame:
    """Both kinds of row check of a table in the same pass, with the kind in ``check_name``."""
    kinds = {"not_null": _missing(columns), "accepted_values": _outside(accepted)}
    named = {f"{kind}:{c}": bad for kind, conditions in kinds.items() for c, bad in conditions.items()}
    return _failing_rows(table, df, named).select(
        F.substring_index("column_name", ":", 1).alias("check_name"),
        "table_name",
        F.substring_index("column_name", ":", -1).alias("column_name"),
        "failures",
        "status",
    )


class Derived(NamedTuple):
    """A table that is a choice of rows and columns of another one, so that both are checked in one pass."""

    columns: list[Column] | None = None  # all columns of the other table where None
    member: Column | None = None  # all rows where None


def _values_of(base: DataFrame, derived: Derived, wanted: list[str]) -> list[Column]:
    """The wanted columns of a derived table as expressions over its base."""
    if derived.columns is None:
        return [F.col(c) for c in wanted]
    by_name = dict(zip(base.select(*derived.columns).columns, derived.columns, strict=True))
    return [by_name[c] for c in wanted]


def shared_row_checks(
    base: DataFrame,
    tables: dict[str, Derived],
    required: dict[str, list[str]],
    accepted: dict[str, dict[str, list]],
    by: list[str] | None = None,
) -> DataFrame:
    """Failures of the row checks of all tables that derive from ``base``, counted in one pass over it.

    ``required`` and ``accepted`` hold the checks of each table. One row, or one per combination of ``by``;
    a column ``kind:table:column`` for each check.
    """
    values, failures = [F.col(c) for c in by or []], {}
    for table, derived in tables.items():
        conditions = {"not_null": _missing(required.get(table, [])), "accepted_values": _outside(accepted.get(table, {}))}
        wanted = sorted({c for kind in conditions.values() for c in kind})
        place = {c: f"{table}:{c}" for c in wanted}
        values += [v.alias(place[c]) for c, v in zip(wanted, _values_of(base, derived, wanted), strict=True)]
        inside = f"{table}:"
        values.append((F.lit(True) if derived.member is None else derived.member).alias(inside))
        for c in required.get(table, []):
            failures[f"not_null:{place[c]}"] = F.col(inside) & F.col(place[c]).isNull()
        for c, allowed in accepted.get(table, {}).items():
            failures[f"accepted_values:{place[c]}"] = F.col(inside) & ~F.col(place[c]).isin(allowed)
    counts = [F.count_if(bad).alias(name) for name, bad in failures.items()]
    return base.select(*values).groupBy(*by or []).agg(*counts)


def check_rows(counts: DataFrame) -> DataFrame:
    """One row per check of ``shared_row_checks``, over all its combinations, with the kind in ``check_name``."""
    names = [c for c in counts.columns if c.count(":") == 2]
    totals = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    labels = ["check_name", "table_name", "column_name"]
    rows = [
        F.struct(*[F.lit(v).alias(k) for k, v in zip(labels, c.split(":"), strict=True)], F.col(c).alias("failures"))
        for c in names
    ]
    return totals.select(F.inline(F.array(*rows))).withColumn("status", _status(F.col("failures")))


def unique(table: str, df: DataFrame, *columns: str) -> DataFrame:
    """Values, or combinations of values, that occur more than once; NULL is not checked."""
    name = ", ".join(columns)
    repeated = df.dropna(subset=list(columns)).groupBy(*columns).count().filter("count > 1")
    return _tidy(table, repeated.agg(F.count(F.lit(1)).alias(name)), [name])


def _digest(column: str, kind: T.DataType) -> Column:
    """A value's own text while it is short, else its SHA-256, so that equal digests mean equal values."""
    text = F.col(column).cast("string")
    if not isinstance(kind, T.StringType):
        return text
    return F.when(F.octet_length(text) < 64, text).otherwise(F.sha2(text, 256))


def unique_columns(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Values of each column that occur more than once, all columns in one aggregate; NULL is not checked.

    Each row unfolds to its (column, value) pairs, which are counted together and combined before the shuffle.
    """
    pairs = [
        F.struct(F.lit(i).alias("place"), _digest(c, df.schema[c].dataType).alias("value")) for i, c in enumerate(columns)
    ]
    values = df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*").filter("value is not null")
    repeated = values.groupBy("place", "value").count().filter("count > 1")
    return _tidy(table, repeated.agg(*[F.count_if(F.col("place") == i).alias(c) for i, c in enumerate(columns)]), columns)


def unique_in_all(base: DataFrame, tables: dict[str, Column | None], column: str) -> DataFrame:
    """Values that occur more than once in each of the tables made of rows of ``base``, in one grouping; NULL is not checked.

    ``tables`` gives the rows that belong to each, all where None. Rows are counted per value and table before the shuffle.
    """
    inside = {t: F.lit(True) if member is None else member for t, member in tables.items()}
    rows = base.select(column, *[member.alias(f"in {t}") for t, member in inside.items()]).dropna(subset=[column])
    times = rows.groupBy(column).agg(*[F.count_if(f"`in {t}`").alias(t) for t in tables])
    counts = times.agg(*[F.count_if(F.col(t) > 1).alias(t) for t in tables])
    found = F.inline(F.array(*[F.struct(F.lit(t).alias("table_name"), F.col(t).alias("failures")) for t in tables]))
    return counts.select(found).select(
        "table_name", F.lit(column).alias("column_name"), "failures", _status(F.col("failures")).alias("status")
    )


def numeric(table: str, df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is not a whole number; NULL is not checked."""
    text = F.col(column)
    return _failing_rows(table, df, {column: text.isNotNull() & text.try_cast("long").isNull()})


def relationship(table: str, df: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value has no parent; NULL is not checked. A miss is a warning.

    Rows are counted per value before the join, which then sees one row per value.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    orphans = values.join(parents, F.col(column) == F.col(parent_column), "left_anti")
    return _tidy(table, orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(column)), [column], otherwise="WARN")


def freshness(df: DataFrame, as_of: dt.datetime, warn_days: int = 35, error_days: int = 65) -> DataFrame:
    """Age of the newest load against the two limits."""
    newest = F.max("_loaded_at")
    age = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(newest)) / 86400
    return df.agg(
        newest.alias("newest_load"),
        age.alias("age_days"),
        F.when(age > error_days, "error").when(age > warn_days, "warn").otherwise("pass").alias("status"),
    )


def _attributed(raw: DataFrame) -> Column:
    return (F.col("ARR_DEL15") == 1) & F.col("CARRIER_DELAY").isNotNull()


def _cause_gap(tolerance: float) -> Column:
    causes = sum((F.col(c) for c in RAW_CAUSES[1:]), F.col(RAW_CAUSES[0]))
    return F.abs(causes - F.col("ARR_DELAY_NEW")) > tolerance


def cause_sum(raw: DataFrame, tolerance: float = 5, limit: float = 0.05) -> DataFrame:
    """Delayed flights whose causes do not add up to the delay."""
    off = F.count_if(_attributed(raw) & _cause_gap(tolerance))
    checked = F.count_if(_attributed(raw))
    share = safe_divide(off, checked)
    return raw.agg(
        checked.alias("checked"),
        off.alias("inconsistent"),
        share.alias("share"),
        F.when(share < limit, "PASS").otherwise("FAIL").alias("status"),
    )


def natural_key_dups(raw: DataFrame) -> DataFrame:
    """Rows beyond the first per flight key."""
    repeats = raw.groupBy(*NATURAL_KEY).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return repeats.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_rows"))


SCORECARD_NOTES = {
    "Delay cause sum matches ARR_DELAY_NEW": "Small differences come from rounding.",
    "Natural key has no duplicates": "Above 0, look at diverted flights and entry errors.",
}


def scorecard(raw: DataFrame) -> DataFrame:
    """Ten checks in five dimensions with their result and the totals.

    One pass over the flights plus one grouping for the duplicates, which enters
    as a scalar subquery.
    """
    c = F.col
    nulls = {name: F.count_if(c(name).isNull()) for name in ("FL_DATE", "OP_UNIQUE_CARRIER", "ORIGIN")}
    share = safe_divide(F.count_if(_attributed(raw) & _cause_gap(5)), F.count_if(_attributed(raw)))
    measured = raw.agg(
        *[n.alias(f"null_{name}") for name, n in nulls.items()],
        F.count_if(~c("MONTH").between(1, 12)).alias("bad_month"),
        F.count_if(~c("DAY_OF_WEEK").between(1, 7)).alias("bad_weekday"),
        F.count_if(c("CANCELLED").isNull() | ~c("CANCELLED").isin(0.0, 1.0)).alias("bad_cancelled"),
        F.count_if(~c("ARR_DEL15").isin(0.0, 1.0)).alias("bad_late_flag"),
        F.count_if(_attributed(raw) & _cause_gap(5)).alias("cause_gap"),
        share.alias("cause_gap_share"),
        F.min("FL_DATE").alias("first"),
        F.max("FL_DATE").alias("last"),
    ).withColumn("repeats", natural_key_dups(raw).scalar())

    def counted(column: str, unit: str) -> Column:
        return F.concat_ws(" ", c(column), F.lit(unit))

    percent_off = F.round(100 * c("cause_gap_share"), 1).cast("decimal(5,1)").cast("string")
    gap_share = F.concat(F.lit("("), percent_off, F.lit("% of delayed flights)"))
    checks = [
        ("FL_DATE has no nulls", "Completeness", counted("null_FL_DATE", "nulls"), c("null_FL_DATE") == 0),
        ("OP_UNIQUE_CARRIER has no nulls", "Completeness", counted("null_OP_UNIQUE_CARRIER", "nulls"),
         c("null_OP_UNIQUE_CARRIER") == 0),
        ("origin airport has no nulls", "Completeness", counted("null_ORIGIN", "nulls"), c("null_ORIGIN") == 0),
        ("Month values in valid range", "Validity", counted("bad_month", "invalid records"), c("bad_month") == 0),
        ("DAY_OF_WEEK values in valid range", "Validity", counted("bad_weekday", "invalid records"),
         c("bad_weekday") == 0),
        ("CANCELLED flag is binary", "Validity", counted("bad_cancelled", "invalid records"), c("bad_cancelled") == 0),
        ("ARR_DEL15 flag is binary where not null", "Validity", counted("bad_late_flag", "invalid records"),
         c("bad_late_flag") == 0),
        ("Delay cause sum matches ARR_DELAY_NEW", "Consistency",
         F.concat_ws(" ", "cause_gap", F.lit("records with diff > 5 min"), gap_share),
         F.coalesce(c("cause_gap_share") < 0.05, F.lit(False))),
        ("Natural key has no duplicates", "Uniqueness", counted("repeats", "duplicates found"), c("repeats") == 0),
        ("Date range matches expected period", "Timeliness", F.concat_ws(" to ", c("first"), c("last")), F.lit(True)),
    ]
    passed = sum((ok.cast("long") for *_, ok in checks[1:]), checks[0][3].cast("long"))
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("check_name"),
                    F.lit(dimension).alias("dimension"),
                    result.alias("result"),
                    F.when(ok, "PASS").otherwise("FAIL").alias("status"),
                    F.lit(SCORECARD_NOTES.get(name, "")).alias("note"),
                )
                for name, dimension, result, ok in checks
            ]
        )
    )
    return measured.select(
        rows, passed.alias("passed_checks"), (F.lit(len(checks)).cast("long") - passed).alias("failed_checks")
    )
