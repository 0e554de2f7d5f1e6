"""The checks declared for each table, and the jobs that run them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.functions import labels
from tarmac.operators import dimensions, enrichment, quality, staging
from tarmac.operators.quality import Derived
from tarmac.plans.warehouse import Warehouse
from tarmac.sources.tables import written_once

# Fixed values -----------------------------------------------------------------
YEARS = [2019, 2020, 2021, 2022, 2023]
PHASES = ["Pre-Covid", "COVID Impact", "Recovery"]
SEASON_NAMES = ["Winter", "Spring", "Summer", "Fall"]
CARRIER_KINDS = ["Legacy", "Low-Cost", "Mid-Size", "Ultra Low-Cost", "Regional", "Other"]
DISTANCES = [
    "Short-Haul (<250mi)", "Medium-Haul (250-750mi)", "Long-Haul (750-1500mi)", "Ultra Long-Haul (>1500mi)",
]
CAUSE_LABELS = ["Carrier", "Late Aircraft", "NAS", "Weather", "Security"]

NOT_NULL = {
    "raw_flights": ["FL_DATE", "OP_UNIQUE_CARRIER", "ORIGIN", "DEST", "CANCELLED", "_loaded_at", "_source_file"],
    "raw_airlines": ["Code", "Description"],
    "raw_airports": ["Code", "Description"],
    "stg_flights": [
        "flight_id", "flight_date", "flight_year", "flight_quarter", "flight_month", "flight_day_of_week",
        "carrier_code", "flight_number", "origin_airport_id", "dest_airport_id", "origin_state_code",
        "dest_state_code", "is_cancelled", "is_diverted", "loaded_at", "source_file",
    ],
    "stg_airlines": ["carrier_id", "airline_name_full", "carrier_code", "carrier_type"],
    "stg_airports": ["airport_id", "city_name"],
    "flights_enriched": [
        "flight_id", "flight_date", "covid_period", "flight_season", "carrier_code", "carrier_type", "route_key",
        "dep_time_of_day", "route_distance_category",
    ],
    "delay_classified": ["flight_id", "arr_delay_minutes_pos", "is_cascade_delay"],
    "route_stats": [
        "flight_month_name", "carrier_code", "route_key", "total_operated_flights", "is_chronic_delay_route",
        "otp_performance_band", "dominant_delay_cause",
    ],
    "dim_date": ["date_key", "full_date", "year", "season", "covid_period", "is_weekend", "is_federal_holiday"],
    "dim_carrier": [
        "carrier_id", "carrier_code", "carrier_type", "is_big4_carrier", "is_major_carrier", "dw_last_refreshed_at",
    ],
    "dim_airport": ["airport_id", "airport_code", "is_major_hub", "us_region", "loaded_at"],
    "dim_route": ["route_id", "route_key", "route_distance_category", "dw_last_refreshed_at"],
    "dim_delay_cause": ["delay_cause_id", "delay_cause_code", "delay_cause_name", "fact_column_name"],
    "fact_flights": [
        "flight_id", "date_key", "carrier_id", "origin_airport_id", "dest_airport_id", "route_key", "is_diverted",
    ],
    "fact_route_monthly": [
        "flight_date_key", "carrier_id", "route_key", "total_operated_flights", "is_chronic_delay_route",
        "dw_last_refreshed_at",
    ],
}

UNIQUE = {
    "raw_airports": ["Code"],
    "stg_flights": ["flight_id"],
    "stg_airlines": ["carrier_id"],
    "stg_airports": ["airport_id"],
    "flights_enriched": ["flight_id"],
    "delay_classified": ["flight_id"],
    "dim_date": ["date_key", "full_date"],
    "dim_carrier": ["carrier_id", "carrier_code"],
    "dim_airport": ["airport_id", "airport_code"],
    "dim_route": ["route_id", "route_key"],
    "dim_delay_cause": ["delay_cause_id", "delay_cause_code", "delay_cause_name", "fact_column_name"],
    "fact_flights": ["flight_id"],
}

ACCEPTED = {
    "raw_flights": {"CANCELLED": [0.0, 1.0]},
    "stg_flights": {
        "flight_year": YEARS,
        "flight_quarter": [1, 2, 3, 4],
        "flight_month": list(range(1, 13)),
        "flight_day_of_week": list(range(1, 8)),
        "day_of_week_name": labels.WEEKDAYS,
        "is_diverted": [False],
        "cancellation_code": ["A", "B", "C", "D"],
        "cancellation_reason": ["Carrier", "Weather", "National Air System", "Security"],
    },
    "stg_airlines": {"carrier_type": CARRIER_KINDS},
    "flights_enriched": {
        "covid_period": PHASES,
        "flight_season": SEASON_NAMES,
        "carrier_type": CARRIER_KINDS,
        "dep_time_of_day": [
            "Early Morning (5-9am)", "Morning (9am-12pm)", "Afternoon (12-3pm)", "Late Afternoon (3-6pm)",
            "Evening (6-9pm)", "Night (9pm-12am)", "Red-Eye (12-5am)", "Unknown",
        ],
        "primary_delay_cause": ["Unattributed", *CAUSE_LABELS, "Unknown"],
        "route_distance_category": DISTANCES,
    },
    "delay_classified": {"primary_delay_cause": [*CAUSE_LABELS, "Unattributed"]},
    "route_stats": {
        "otp_performance_band": [
            "No Operations / No Data", "Excellent (>=85%)", "Good (80-85%)", "Fair (70-80%)", "Poor (60-70%)",
            "Critical (<60%)",
        ],
        "dominant_delay_cause": ["Multiple Causes", *CAUSE_LABELS, "No Delay", "No Operations", "Unknown"],
    },
    "dim_date": {"year": YEARS, "season": SEASON_NAMES, "covid_period": PHASES},
    "dim_carrier": {"carrier_type": CARRIER_KINDS},
    "dim_airport": {"us_region": ["Northeast", "Midwest", "South", "West", "Other"]},
    "dim_route": {"route_distance_category": DISTANCES},
    "fact_flights": {
        "delay_severity": ["Early", "On Time", "Minor Delay", "Moderate Delay", "Severe Delay", "Extreme Delay"],
        "primary_delay_cause": ["Unattributed", *CAUSE_LABELS, "Unknown"],
    },
}

# (table, column, parent table, parent column)
RELATIONSHIPS = [
    ("stg_flights", "origin_airport_id", "stg_airports", "airport_id"),
    ("stg_flights", "dest_airport_id", "stg_airports", "airport_id"),
]
# ------------------------------------------------------------------------------


AIRPORT_ENDS = ["origin_airport_id", "origin_airport_code", "dest_airport_id", "dest_airport_code"]


def _row_checks(tables: Warehouse, required: dict[str, list[str]], accepted: dict[str, dict[str, list]]) -> DataFrame:
    """The given row checks, with the kind in ``check_name``.

    Stored tables are read one by one. Otherwise tables that are made row by row of the same flights share a pass over
    them: raw with staged flights, and enriched with delayed flights and the flight fact. The latter pass counts
    per pair of airports and is written once, so that the airports in use come from it as well.
    """
    wanted = list(dict.fromkeys([*required, *accepted]))
    parts = []
    if not tables.stored:
        raw = {"raw_flights": Derived(), "stg_flights": Derived(staging.staged_columns(), staging.is_staged())}
        enriched = {
            "flights_enriched": Derived(),
            "delay_classified": Derived(enrichment.classified_columns(), enrichment.is_classified()),
            "fact_flights": Derived(),
        }
        parts.append(quality.check_rows(quality.shared_row_checks(tables.raw_flights, raw, required, accepted)))
        pairs = quality.shared_row_checks(tables.flights_enriched, enriched, required, accepted, by=AIRPORT_ENDS)
        pairs = written_once(pairs, "checks-per-airports")
        parts.append(quality.check_rows(pairs))
        tables = _with_routes_written(tables, wanted)
        tables.dim_airport = dimensions.dim_airport(tables.stg_airports, pairs)
        wanted = [t for t in wanted if t not in raw and t not in enriched]
    parts += [
        quality.row_checks(table, getattr(tables, table), required.get(table, []), accepted.get(table, {}))
        for table in wanted
    ]
    return quality.union_rows(parts)


def _with_routes_written(tables: Warehouse, wanted: list[str]) -> Warehouse:
    """The same tables, with route statistics written once where several of the wanted tables read them."""
    shared = Warehouse(tables.raw_flights, tables.raw_airlines, tables.raw_airports, tables.as_of, tables.name)
    shared.flights_enriched = tables.flights_enriched
    if len({"route_stats", "dim_route", "fact_route_monthly"} & set(wanted)) > 1:
        shared.route_stats = written_once(tables.route_stats, "route-stats")
    return shared


def not_null_checks(tables: Warehouse) -> DataFrame:
    return _row_checks(tables, NOT_NULL, {}).drop("check_name")


def unique_checks(tables: Warehouse) -> DataFrame:
    """Repeated values of each unique column; the tables made of enriched flights share one grouping by flight."""
    parts, shared = [], {}
    if not tables.stored:
        shared = {"flights_enriched": None, "delay_classified": enrichment.is_classified(), "fact_flights": None}
        parts = [quality.unique_in_all(tables.flights_enriched, shared, "flight_id")]
    parts += [
        quality.unique_columns(table, getattr(tables, table), columns)
        for table, columns in UNIQUE.items()
        if table not in shared
    ]
    return quality.union_rows(parts)


def accepted_values_checks(tables: Warehouse) -> DataFrame:
    return _row_checks(tables, {}, ACCEPTED).drop("check_name")


def relationship_checks(tables: Warehouse) -> DataFrame:
    return quality.union_rows(
        [
            quality.relationship(table, getattr(tables, table), column, getattr(tables, parent), parent_column)
            for table, column, parent, parent_column in RELATIONSHIPS
        ]
    )


def all_checks(tables: Warehouse) -> DataFrame:
    """Every declared check as one table; the row checks of a table share one pass."""
    by_key = [
        checks(tables).selectExpr(f"'{kind}' as check_name", "*")
        for kind, checks in {"unique": unique_checks, "relationships": relationship_checks}.items()
    ]
    return quality.union_rows([_row_checks(tables, NOT_NULL, ACCEPTED), *by_key])


def grain_checks(tables: Warehouse) -> DataFrame:
    """What the tables rely on without declaring it: numeric airport ids, one row per carrier, route and month."""
    return quality.union_rows(
        [
            quality.numeric("raw_airports", tables.raw_airports, "Code"),
            quality.unique("route_stats", tables.route_stats, "carrier_code", "route_key", "month_start"),
        ]
    )
