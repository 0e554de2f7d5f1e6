"""Statistics merged load by load against those of all flights at once."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import airlines, airports, raw_flights
from test_routes import AS_OF, month_of

from tarmac.plans import route_state
from tarmac.plans.route_state import RouteState
from tarmac.plans.warehouse import Warehouse


def warehouse(spark, rows) -> Warehouse:
    return Warehouse(raw_flights(spark, rows), airlines(spark), airports(spark), AS_OF)


def month(year: int, number: int) -> dt.date:
    return dt.date(year, number, 1)


def same(state: RouteState, full: Warehouse) -> bool:
    columns = full.route_stats.columns
    return sorted(map(str, state.route_stats().select(*columns).collect())) == sorted(map(str, full.route_stats.collect()))


def two_years() -> list[dict]:
    return [r for y in (2019, 2020) for m in range(1, 13) for r in month_of(y, m, 1 + m % 3, m % 2)]


def test_a_merged_month_gives_the_rows_of_a_full_rebuild(spark, tmp_path):
    late = month_of(2019, 6, 1, 2) + [r | {"FL_DATE": None} for r in month_of(2019, 6, 1, 0)]
    state = RouteState(spark, str(tmp_path))
    state.add_load("on-time", warehouse(spark, two_years()).operated)
    assert len(state.refresh()) == 24
    assert state.add_load("late", warehouse(spark, late).operated) == {month(2019, 6)}
    assert state.refresh() == {month(2019, 6), month(2019, 7), month(2019, 8), month(2020, 6)}
    assert same(state, warehouse(spark, two_years() + late))
    assert state.refresh() == set()


def test_a_load_that_runs_again_replaces_itself(spark, tmp_path):
    first, second = month_of(2019, 1, 2, 1) + month_of(2019, 2, 1, 1), month_of(2019, 3, 3, 0)
    state = RouteState(spark, str(tmp_path))
    for load, rows in (("a", first), ("b", month_of(2019, 5, 9, 9)), ("a", first), ("b", second)):
        state.add_load(load, warehouse(spark, rows).operated)
        state.refresh()
    assert same(state, warehouse(spark, first + second))  # May is gone with the first version of b


def test_new_ends_gaps_and_attribute_sets(spark, tmp_path):
    base = two_years() + month_of(2019, 2, 2, 0, DEST="BOS")
    more = month_of(2021, 4, 2, 1) + month_of(2019, 9, 1, 0, DEST="BOS") + month_of(2018, 11, 2, 2, DEST="JFK")
    other_set = month_of(2019, 3, 2, 1, DISTANCE=100.0) + month_of(2019, 8, 1, 0, DISTANCE=100.0)
    state, rows = RouteState(spark, str(tmp_path)), []
    for number, part in enumerate((base, more, other_set)):
        rows += part
        state.add_load(f"load-{number}", warehouse(spark, part).operated)
        state.refresh()
        assert same(state, warehouse(spark, rows)), number


def test_a_broken_refresh_is_made_up_for(spark, tmp_path, monkeypatch):
    late = month_of(2020, 2, 4, 0)
    state = RouteState(spark, str(tmp_path))
    state.add_load("a", warehouse(spark, two_years()).operated)
    state.refresh()
    state.add_load("b", warehouse(spark, late).operated)
    with monkeypatch.context() as patch:
        patch.setattr(RouteState, "rebuild", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.refresh()
    assert state.pending() == {month(2020, 2)}
    state.refresh()
    assert same(state, warehouse(spark, two_years() + late))


def test_a_load_that_breaks_before_its_counts_is_repeated(spark, tmp_path, monkeypatch):
    state = RouteState(spark, str(tmp_path))
    with monkeypatch.context() as patch:
        patch.setattr(route_state, "_write", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.add_load("a", warehouse(spark, month_of(2019, 1, 2, 1)).operated)
    state.refresh()
    state.add_load("a", warehouse(spark, month_of(2019, 1, 2, 1)).operated)
    state.refresh()
    assert same(state, warehouse(spark, month_of(2019, 1, 2, 1)))


def test_only_the_months_looked_back_at_are_read(spark, tmp_path):
    state = RouteState(spark, str(tmp_path))
    state.add_load("a", warehouse(spark, two_years()).operated)
    state.refresh()
    stats = spark.read.parquet(f"{tmp_path}/months")
    rows = state.rebuild({month(2020, 6)}, stats, spark.read.parquet(f"{tmp_path}/universe"))
    scans = [
        line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines()
        if "FileScan" in line and "otp_rate_pct" in line
    ]
    assert scans
    for scan in scans:
        filters = scan[scan.index("PartitionFilters: ["):scan.index("PushedFilters")]
        assert route_state.MONTH in filters
    shown = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "2019-06-01" in shown or "18048" in shown
    assert "2019-05-01" not in shown and "18017" not in shown
    assert [r.month_start for r in rows.collect()] == [month(2020, 6)]


@pytest.mark.parametrize("name", ["", "../x", "a/b", "load=1"])
def test_load_names_are_plain(spark, tmp_path, name):
    with pytest.raises(ValueError, match="named by"):
        RouteState(spark, str(tmp_path)).add_load(name, warehouse(spark, month_of(2019, 1, 1, 0)).operated)


def test_nothing_loaded(spark, tmp_path):
    state = RouteState(spark, str(tmp_path))
    assert state.refresh() == set()
    with pytest.raises(ValueError, match="nothing has been refreshed"):
        state.route_stats()
    state.add_load("none", warehouse(spark, month_of(2019, 1, 1, 0)).operated.limit(0))
    assert state.refresh() == set()
