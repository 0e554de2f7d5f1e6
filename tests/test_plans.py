"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from tarmac.plans import registry
from tarmac.plans.warehouse import Warehouse

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in registry.WAREHOUSE_QUERIES if n not in registry.LANDING])
def test_no_cross_joins_and_no_python(spark, name):
    plan = physical(registry.queries()[name](spark, SF_DIR))
    assert not [node for node in FORBIDDEN if node in plan]


def warehouse(spark) -> Warehouse:
    return Warehouse.of_driver_tables(spark, SF_DIR, registry.AS_OF)


def scans_of_flights(plan: str) -> int:
    return plan.count("l_extendedprice") and sum("FileScan" in line and "l_" in line for line in plan.splitlines())


def test_staging_and_classification_do_not_shuffle_flights(spark):
    w = warehouse(spark)
    assert "Exchange" not in physical(w.stg_flights)
    flights_side = [line for line in physical(w.delay_classified).splitlines() if "Exchange hashpartitioning" in line]
    assert all("_groupingexpression" in line for line in flights_side)


def test_flights_are_read_once_for_route_stats(spark):
    w = warehouse(spark)
    assert scans_of_flights(physical(w.route_month_stats)) == 1
    assert scans_of_flights(physical(w.route_stats)) == 0


def test_trend_reads_only_its_columns(spark):
    plan = physical(registry.queries()["monthly_otp_trend"](spark, SF_DIR))
    schema = plan[plan.index("ReadSchema") :]
    assert "l_orderkey" not in schema and "l_tax" not in schema


def test_route_windows_share_one_sort(spark):
    windows = [line for line in physical(warehouse(spark).route_otp_windows).splitlines() if " Window " in line]
    assert len(windows) == 1


def test_shared_aggregates_read_flights_once(spark):
    for name in ("delay_distribution", "otp_projection", "carrier_significance"):
        df = registry.queries()[name](spark, SF_DIR)
        df.collect()
        final = physical(df).split("== Initial Plan ==")[0]
        assert scans_of_flights(final) <= 1, name


@pytest.mark.parametrize(("name", "scans"), [("dq_not_null", 1), ("dq_accepted_values", 1), ("dq_unique", 3)])
def test_declared_checks_share_their_passes(spark, name, scans):
    """Beside these the passes over enriched flights and operated flights are written once."""
    plan = physical(registry.queries()[name](spark, SF_DIR))
    assert sum("FileScan" in line and "struct<l_" in line for line in plan.splitlines()) == scans
