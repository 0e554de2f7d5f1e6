"""Route statistics as a stored state that loads are merged into.

Four tables below one folder, none of which is as large as the flights:

* ``counts``: flights per load, route, month and distinct delay. Loads stay apart, so that running one again replaces
  its own counts only; readers add them up.
* ``months``: statistics per route and month, made from the counts of that month.
* ``universe``: the routes with their first and last month.
* ``route_stats``: the published table.

All but the universe are in monthly folders. ``refresh`` reads the counts of the changed months, the
statistics of the months that the rebuilt ones look back at, and writes only the rebuilt ones.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators import routes
from tarmac.sources.tables import overwrite_table, read_table, written_once

MONTH = "_month"
YEAR_BACK = 12
#: How many months later a month shows in another one's row: 3-month rate and flags, and the rate one year back.
LOOKED_BACK_AT = (0, 1, 2, YEAR_BACK)


def months_after(month: dt.date, n: int) -> dt.date:
    years, place = divmod(month.month - 1 + n, 12)
    return dt.date(month.year + years, place + 1, 1)


def _months(df: DataFrame, column: str) -> set[dt.date]:
    """The distinct months of a column: one row each reaches the driver, as many as the calendar has."""
    return {row[0] for row in df.select(column).distinct().collect()}


def _write(df: DataFrame, path: str, mode: str) -> None:
    """Monthly folders; with ``dynamic`` only the months in ``df`` are replaced."""
    (
        df.withColumn(MONTH, F.col("month_start"))
        .hint("rebalance", F.col(MONTH))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(MONTH)
        .parquet(path)
    )


class RouteState:
    """The state below ``root``. One load or refresh runs at a time."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def pending(self) -> set[dt.date]:
        """Months whose counts have changed since the last finished refresh."""
        noted = read_table(self.spark, self._path("pending"))
        return set() if noted is None else _months(noted, "month_start")

    def _note(self, months: set[dt.date]) -> None:
        rows = self.spark.createDataFrame([(m,) for m in sorted(months)], "month_start date")
        overwrite_table(rows.coalesce(1), self._path("pending"))

    def add_load(self, load: str, operated: DataFrame) -> set[dt.date]:
        """Store the counts of one load's operated flights and return the months this changes.

        A load of the same name is replaced, so a broken run can simply be repeated; months that only the earlier
        run had count as changed too. Flights without a date belong to no month and are left out, as they
        are from the full table.
        """
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", load):
            raise ValueError(f"a load is named by letters, digits, dots and dashes, not {load!r}")
        dated = operated.filter(F.col("flight_date").isNotNull())
        counts = written_once(routes.delay_counts(dated), "route-counts")
        path = self._path(f"counts/load={load}")
        earlier = read_table(self.spark, path)
        changed = _months(counts, "month_start") | (set() if earlier is None else _months(earlier, MONTH))
        self._note(self.pending() | changed)  # before the counts, so that a broken load is rebuilt too
        _write(counts, path, "static")
        return changed

    def refresh(self) -> set[dt.date]:
        """Bring the published table up to date and return the months that were rebuilt.

        The months are noted as done at the very end, so that a broken refresh is made up for by the next one.
        """
        changed = self.pending()
        if not changed:
            return set()
        counts = read_table(self.spark, self._path("counts"))
        counted = set() if counts is None else _months(counts, MONTH)
        if changed & counted:
            merged = routes.merged_counts(counts.filter(F.col(MONTH).isin(*changed)).drop("load", MONTH))
            _write(routes.stats_from_counts(merged), self._path("months"), "dynamic")
        if not counted:
            if (universe := read_table(self.spark, self._path("universe"))) is not None:
                none_left = self.spark.createDataFrame([], universe.schema)
                overwrite_table(none_left, self._path("universe"))
            self._note(set())
            return set()
        stats = read_table(self.spark, self._path("months")).filter(F.col(MONTH).isin(*counted))
        after = written_once(routes.route_universe(stats), "route-universe")
        before = read_table(self.spark, self._path("universe"))
        before = after.limit(0) if before is None else before
        rebuilt = self._affected(changed, before, after) & self._spine_months(after)
        if rebuilt:
            _write(self.rebuild(rebuilt, stats, after), self._path("route_stats"), "dynamic")
        overwrite_table(after, self._path("universe"))
        self._note(set())
        return rebuilt

    @staticmethod
    def _spine_months(universe: DataFrame) -> set[dt.date]:
        return _months(routes.route_month_spine(universe), "month_start")

    @staticmethod
    def _affected(changed: set[dt.date], before: DataFrame, after: DataFrame) -> set[dt.date]:
        """Months with another row than before.

        These are the changed months, the months that a route gains or loses at its ends, and those that look
        back at either. Frames and lags count rows: where a route has several attribute sets, and so several rows a
        month, they reach any month up to a year back, and then all of them are taken.
        """
        both = before.withColumn("_new", F.lit(False)).unionByName(after.withColumn("_new", F.lit(True)))

        def spine(new: bool):
            first, last = (F.max(F.when(F.col("_new") == new, F.col(c))) for c in ("first_month", "last_month"))
            months = F.when(first.isNotNull(), F.sequence(first, last, F.expr("interval 1 month")))
            return F.coalesce(months, F.array().cast("array<date>"))

        sets = both.groupBy(*routes.ROUTE_COLUMNS).agg(spine(False).alias("old"), spine(True).alias("new"))
        moved = F.array_union(F.array_except("old", "new"), F.array_except("new", "old"))
        touched = changed | _months(sets.select(F.explode(moved).alias("month")), "month")
        per_route = both.groupBy("_new", "carrier_code", "route_key").count()
        several = bool(per_route.filter("count > 1").head(1))
        steps = range(YEAR_BACK + 1) if several else LOOKED_BACK_AT
        return {months_after(m, n) for m in touched for n in steps}

    @staticmethod
    def rebuild(months: set[dt.date], stats: DataFrame, universe: DataFrame) -> DataFrame:
        """The published rows of these months, from the year before each and no other month."""
        needed = {months_after(m, -n) for m in months for n in range(YEAR_BACK + 1)}
        read = stats.filter(F.col(MONTH).isin(*needed)).drop(MONTH)
        spine = routes.route_month_spine(universe).filter(F.col("month_start").isin(*needed))
        filled = routes.route_month_filled(spine, read, routes.calendar_month_attributes(read))
        rows = routes.route_stats(routes.route_otp_windows(filled), routes.route_worst_rank(filled))
        return rows.filter(F.col("month_start").isin(*months))

    def route_stats(self) -> DataFrame:
        """The published table as of the last refresh, without folders of months that no route reaches any more."""
        universe = read_table(self.spark, self._path("universe"))
        if universe is None:
            raise ValueError(f"nothing has been refreshed below {self.root}")
        months = self._spine_months(universe)
        return read_table(self.spark, self._path("route_stats")).filter(F.col(MONTH).isin(*months)).drop(MONTH)
