"""DuckDB SQL of every named query."""

from __future__ import annotations

from oracle.tables import CAUSES, PHASE, TABLES, over_tables, pct, r
from tarmac.plans.declared_checks import ACCEPTED, NOT_NULL, RELATIONSHIPS, UNIQUE
from tarmac.schemas import FLIGHT_FILE_COLUMNS, RAW_FLIGHT_COLUMNS

ISO_COLUMNS = [
    "flight_date", "loaded_at", "first_month", "last_month", "month_start", "flight_month_date", "full_date",
    "first_day_of_month", "last_day_of_month", "first_day_of_quarter", "first_day_of_year",
]


def _table(name: str) -> str:
    """A table as the query returns it: no refresh stamp, dates and timestamps as text."""
    text = TABLES[name]
    iso = [c for c in ISO_COLUMNS if _has(name, c)]
    dropped = [c for c in ("dw_loaded_at", "dw_last_refreshed_at") if c in text]
    exclude = f" exclude ({', '.join(dropped)})" if dropped else ""
    replace = f" replace ({', '.join(f'cast({c} as varchar) as {c}' for c in iso)})" if iso else ""
    return f"select *{exclude}{replace} from {name}"


# date and timestamp columns of each table that is a query of its own
_ISO = {
    "stg_flights": ["flight_date", "loaded_at"],
    "stg_airlines": ["loaded_at"],
    "stg_airports": ["loaded_at"],
    "flights_enriched": ["flight_date", "loaded_at"],
    "delay_classified": ["flight_date", "loaded_at"],
    "route_universe": ["first_month", "last_month"],
    "calendar_month_attributes": ["month_start"],
    "route_month_spine": ["month_start"],
    "route_month_stats": ["month_start"],
    "route_month_filled": ["month_start"],
    "route_otp_windows": ["month_start"],
    "route_worst_rank": ["month_start"],
    "route_stats": ["month_start"],
    "dim_airport": ["loaded_at"],
    "fact_flights": ["flight_date"],
    "fact_route_monthly": ["flight_month_date"],
}


def _has(name: str, column: str) -> bool:
    return column in _ISO.get(name, [])


MODELS = {name: _table(name) for name in _ISO} | {
    "route_stats_merged": _table("route_stats"),
    "dim_carrier": _table("dim_carrier"),
    "dim_route": _table("dim_route"),
    "dim_date": f"""
        select
            d.* exclude (dw_loaded_at) replace (
                {', '.join(f'cast({c} as varchar) as {c}' for c in ISO_COLUMNS[6:])}
            ),
            count(f.flight_id) as flights, count(*) filter (f.is_cancelled) as cancelled
        from dim_date d left join fact_flights f using (date_key) group by all
    """,
    "dim_delay_cause": """
        select dim_delay_cause.*, total_minutes, flights
        from dim_delay_cause
        join (
            select fact_column_name, sum(minutes) as total_minutes, count(*) filter (minutes > 0) as flights
            from (
                unpivot (select columns('^(carrier|late_aircraft|nas|weather|security)_delay_minutes$') from fact_flights)
                on columns(*) into name fact_column_name value minutes
            )
            group by fact_column_name
        ) using (fact_column_name)
    """,
    "executive_kpis": f"""
        select
            flight_year, covid_period,
            {pct('count(*) filter (not is_cancelled and is_on_time)', 'count(*) filter (not is_cancelled)')}
                as otp_rate_pct,
            {pct('count(*) filter (is_cancelled)', 'count(*)')} as cancel_rate_pct,
            {r('avg(arr_delay_minutes) filter (arr_delay_minutes > 15)')} as avg_arr_delay_min,
            {', '.join(f"{pct(f'sum({c}_delay_minutes)', 'sum(total_cause_minutes)')} as {c}_contribution_pct"
                       for c in ('carrier', 'weather', 'nas', 'late_aircraft'))},
            count(*) filter (not is_cancelled) as operated_flights
        from (select *, {PHASE.format(d='flight_date')} as covid_period from stg_flights) group by flight_year, covid_period
    """,
    "route_stats_null_volume": """
        select total_operated_flights, count(*) as total_rows
        from route_stats where total_operated_flights is null group by total_operated_flights
    """,
}

_FILED = "date_trunc('month', FL_DATE) + case when CRS_DEP_TIME is null then interval 1 month else interval 0 month end"

LANDING = {
    "ingest_flights": f"""
        select {', '.join(c for c in FLIGHT_FILE_COLUMNS if c != 'FL_DATE')}, cast(FL_DATE as varchar) as FL_DATE,
            cast(_loaded_at as varchar) as _loaded_at, _source_file
        from raw_flights
    """,
    "months_to_load": """
        select YEAR as year, MONTH as month, _source_file as filename
        from raw_flights group by all having min(FL_DATE) >= date '2021-01-01'
    """,
    "load_append": """
        select YEAR, MONTH, _source_file, count(*) as table_rows, sum(ARR_DELAY) as delay_minutes
        from raw_flights group by all
    """,
    "load_reconcile": f"""
        select
            year(filed) as year, month(filed) as month, strftime(filed, 'ontime_%Y_%m.csv') as filename, csv_rows,
            coalesce(n, 0) as table_rows, csv_rows = coalesce(n, 0) as match,
            if(csv_rows = coalesce(n, 0), 'SUCCESS', 'ROW_MISMATCH') as status
        from (select {_FILED} as filed, count(*) as csv_rows from raw_flights group by filed)
        left join (select date_trunc('month', FL_DATE) as filed, count(*) as n from raw_flights group by filed)
            using (filed)
    """,
    "load_audit": f"""
        with flights as (
            select {_FILED} as filed, date_trunc('month', FL_DATE) as flown from raw_flights
        ),
        loads as (select *, if(filed < date '2021-01-01', 1, 2) as load from flights),
        files as (select filed, load, count(*) as csv_rows from loads group by all),
        held as (
            select files.filed, files.load, csv_rows, count(flown) as table_rows
            from files left join loads on flown = files.filed and loads.load <= files.load
            group by files.filed, files.load, csv_rows
        )
        select
            year(filed) as year, month(filed) as month, strftime(filed, 'ontime_%Y_%m.csv') as filename, csv_rows,
            table_rows, csv_rows = table_rows as match,
            if(csv_rows = table_rows, 'SUCCESS', 'ROW_MISMATCH') as status, '2024-01-15 00:00:00' as uploaded_at
        from held
    """,
    "load_lookups": """
        select Code, Description || ' "é"' as Description, _source_file from raw_airlines
        union all select Code, Description || ' "é"', _source_file from raw_airports
    """,
    "file_month_check": f"""
        select
            strftime(filed, 'ontime_%Y_%m.csv') as filename, sum(n)::bigint as rows,
            string_agg(actual, ', ' order by actual) as actual_months,
            if(count(*) = 1 and min(actual) = strftime(filed, '%Y-%m'), '', 'WRONG') as verdict
        from (
            select {_FILED} as filed, strftime(FL_DATE, '%Y-%m') as actual, count(*) as n
            from raw_flights group by filed, actual
        )
        group by filed
    """,
    "missing_files": """
        select year(m) as year, month(m) as month, strftime(m, 'ontime_%Y_%m.csv') as filename
        from (select unnest(generate_series(date '2019-01-01', date '2023-12-01', interval 1 month)) as m)
        where strftime(m, 'ontime_%Y_%m.csv') not in (select _source_file from raw_flights)
    """,
}

VERIFICATION = {
    "verify_rows_by_year": """
        select YEAR as year, count(*) as total_row, sum(CANCELLED) as cancelled_flights from raw_flights group by YEAR
    """,
    "verify_rows_by_month": """
        select YEAR as year, MONTH as month, count(*) as row_count, cast(min(FL_DATE) as varchar) as first_date,
            cast(max(FL_DATE) as varchar) as last_date
        from raw_flights group by YEAR, MONTH
    """,
    "verify_carriers": """
        select OP_UNIQUE_CARRIER as reporting_airline, count(*) as total_flights,
            cast(min(FL_DATE) as varchar) as first_flight, cast(max(FL_DATE) as varchar) as last_flight,
            count(distinct year(FL_DATE)) as year_present
        from raw_flights group by OP_UNIQUE_CARRIER order by total_flights desc, reporting_airline
    """,
    "verify_null_rates": "select "
    + ", ".join(
        f"count(*) filter ({column} is null) / count(*) * 100 as pct_null_{name}"
        for column, name in [
            ("FL_DATE", "flight_date"), ("OP_UNIQUE_CARRIER", "carrier"), ("ORIGIN", "origin"), ("DEST", "dest"),
            ("ARR_DELAY", "arr_delay"), ("ARR_DEL15", "arr_del15"),
        ]
    )
    + " from raw_flights",
    "verify_cause_coverage": f"""
        select ARR_DEL15 as delay_15, CANCELLED as cancelled, count(CARRIER_DELAY) as has_carrier_delay,
            count(WEATHER_DELAY) as has_weather_delay,
            {pct('count(CARRIER_DELAY)', 'count(*)')} as pct_has_cause_data
        from raw_flights group by ARR_DEL15, CANCELLED
    """,
    "verify_lineage": """
        select count(*) filter (_loaded_at is null) as null_loaded_at,
            count(*) filter (_source_file is null) as null_source_file,
            count(distinct _source_file) as distinct_source_file,
            cast(min(_loaded_at) as varchar) as earliest_loaded_file,
            cast(max(_loaded_at) as varchar) as latest_loaded_file
        from raw_flights
    """,
    "verify_lookup_counts": """
        select 'airline_lookup' as table_name, count(*) as row_count from raw_airlines
        union all select 'airport_lookup', count(*) from raw_airports
    """,
    "verify_carrier_join": """
        select OP_UNIQUE_CARRIER as reporting_airline, count(*) as flight_count,
            max(airline_name_full) as airline_name
        from raw_flights left join stg_airlines on carrier_code = OP_UNIQUE_CARRIER
        group by OP_UNIQUE_CARRIER
    """,
    "verify_duplicates": """
        select cast(FL_DATE as varchar) as FL_DATE, OP_UNIQUE_CARRIER, OP_CARRIER, ORIGIN, DEST,
            count(*) as occurence_count
        from raw_flights group by all
        order by occurence_count desc, FL_DATE, OP_UNIQUE_CARRIER, OP_CARRIER, ORIGIN, DEST limit 20
    """,
}


def _literal(value: object) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value).lower()


def _check(table: str, column: str, failing: str, failure: str = "FAIL") -> str:
    return (
        f"select '{table}' as table_name, '{column}' as column_name, count(*) as failures, "
        f"if(count(*) = 0, 'PASS', '{failure}') as status from ({failing})"
    )


def _all(checks: list[str]) -> str:
    return " union all ".join(checks)


_CAUSE_GAP = "abs(CARRIER_DELAY + WEATHER_DELAY + NAS_DELAY + SECURITY_DELAY + LATE_AIRCRAFT_DELAY - ARR_DELAY_NEW) > 5"
_KEY = "FL_DATE, OP_UNIQUE_CARRIER, OP_CARRIER_FL_NUM, ORIGIN, DEST"
_REPEATS = f"(select count(*) - (select count(*) from (select distinct {_KEY} from raw_flights)) from raw_flights)"

_SCORECARD = [
    ("FL_DATE has no nulls", "Completeness", "nulls", "FL_DATE is null"),
    ("OP_UNIQUE_CARRIER has no nulls", "Completeness", "nulls", "OP_UNIQUE_CARRIER is null"),
    ("origin airport has no nulls", "Completeness", "nulls", "ORIGIN is null"),
    ("Month values in valid range", "Validity", "invalid records", "MONTH < 1 or MONTH > 12"),
    ("DAY_OF_WEEK values in valid range", "Validity", "invalid records", "DAY_OF_WEEK < 1 or DAY_OF_WEEK > 7"),
    ("CANCELLED flag is binary", "Validity", "invalid records", "CANCELLED is null or CANCELLED not in (0, 1)"),
    ("ARR_DEL15 flag is binary where not null", "Validity", "invalid records", "ARR_DEL15 not in (0, 1)"),
]

QUALITY = {
    "dq_not_null": _all(
        [_check(t, c, f"select 1 from {t} where {c} is null") for t, columns in NOT_NULL.items() for c in columns]
    ),
    "dq_unique": _all(
        [
            _check(t, c, f"select {c} from {t} where {c} is not null group by {c} having count(*) > 1")
            for t, columns in UNIQUE.items()
            for c in columns
        ]
    ),
    "dq_accepted_values": _all(
        [
            _check(t, c, f"select 1 from {t} where {c} not in ({', '.join(map(_literal, values))})")
            for t, columns in ACCEPTED.items()
            for c, values in columns.items()
        ]
    ),
    "dq_relationships": _all(
        [
            _check(
                t, c, f"select 1 from {t} where {c} is not null and {c} not in (select {pc} from {p} where {pc} is not null)",
                "WARN",
            )
            for t, c, p, pc in RELATIONSHIPS
        ]
    ),
    "dq_freshness": """
        select cast(newest as varchar) as newest_load, age_days,
            case when age_days > 65 then 'error' when age_days > 35 then 'warn' else 'pass' end as status
        from (
            select max(_loaded_at) as newest,
                date_diff('second', max(_loaded_at), timestamp '2024-03-01 00:00:00') / 86400 as age_days
            from raw_flights
        )
    """,
    "dq_scorecard": f"""
        select check_name, dimension, result, if(ok, 'PASS', 'FAIL') as status,
            case check_name when 'Delay cause sum matches ARR_DELAY_NEW' then 'Small differences come from rounding.'
                when 'Natural key has no duplicates' then 'Above 0, look at diverted flights and entry errors.' else '' end as note,
            (count(*) filter (ok) over ()) as passed_checks, (count(*) filter (not ok) over ()) as failed_checks
        from (
            {_all([
                f"select '{name}' as check_name, '{dimension}' as dimension, count(*) || ' {unit}' as result, "
                f"count(*) = 0 as ok from raw_flights where {failing}"
                for name, dimension, unit, failing in _SCORECARD
            ])}
            union all
            select 'Delay cause sum matches ARR_DELAY_NEW', 'Consistency',
                concat_ws(' ', count(*) filter ({_CAUSE_GAP}), 'records with diff > 5 min',
                    '(' || cast(round(100 * (count(*) filter ({_CAUSE_GAP}) / nullif(count(*), 0)), 1) as decimal(5,1)) || '% of delayed flights)'),
                coalesce(count(*) filter ({_CAUSE_GAP}) / nullif(count(*), 0) < 0.05, false)
            from raw_flights where ARR_DEL15 = 1 and CARRIER_DELAY is not null
            union all
            select 'Natural key has no duplicates', 'Uniqueness', {_REPEATS} || ' duplicates found', {_REPEATS} = 0
            union all
            select 'Date range matches expected period', 'Timeliness',
                cast(min(FL_DATE) as varchar) || ' to ' || cast(max(FL_DATE) as varchar), true
            from raw_flights
        )
    """,
    "dq_cause_sum": f"""
        select count(*) as checked, count(*) filter ({_CAUSE_GAP}) as inconsistent,
            count(*) filter ({_CAUSE_GAP}) / nullif(count(*), 0) as share,
            if(count(*) filter ({_CAUSE_GAP}) / nullif(count(*), 0) < 0.05, 'PASS', 'FAIL') as status
        from raw_flights where ARR_DEL15 = 1 and CARRIER_DELAY is not null
    """,
    "dq_natural_key_dups": f"select {_REPEATS} as duplicate_rows",
}

_SPARK_TYPES = {"long": "bigint"}


def _profile(column: str, kind: str) -> str:
    return (
        f"select '{column}' as column_name, '{_SPARK_TYPES.get(kind, kind)}' as dtype, "
        f"count({column}) as non_null_count, count(*) - count({column}) as null_count, "
        f"{pct(f'count(*) - count({column})', 'count(*)')} as null_pct, "
        f"coalesce(cast(min({column}) as varchar), 'ALL NULL') as sample_value from raw_flights"
    )


_KEY_COLUMNS = (
    "FL_DATE OP_UNIQUE_CARRIER OP_CARRIER_FL_NUM ORIGIN DEST ARR_DELAY ARR_DEL15 CANCELLED DEP_DELAY TAXI_OUT TAXI_IN "
    "AIR_TIME CARRIER_DELAY WEATHER_DELAY NAS_DELAY SECURITY_DELAY LATE_AIRCRAFT_DELAY"
).split()
_TREND = f"""
    select YEAR as year, MONTH as month, sum(FLIGHTS) as total_flights, sum(CANCELLED) as cancelled,
        sum(ARR_DEL15) as delayed, sum(FLIGHTS) - sum(CANCELLED) as operated,
        {pct('sum(FLIGHTS) - sum(CANCELLED) - sum(ARR_DEL15)', 'sum(FLIGHTS) - sum(CANCELLED)')} as otp_rate,
        {pct('sum(CANCELLED)', 'sum(FLIGHTS)')} as cancel_rate
    from raw_flights group by YEAR, MONTH
"""


def _null_shares(name: str, columns: list[str], where: str = "true") -> str:
    return _all(
        [
            f"select '{c}' as {name}, count(*) - count({c}) as null_count, "
            f"{pct(f'count(*) - count({c})', 'count(*)')} as null_pct from raw_flights where {where}"
            for c in columns
        ]
    )


def _histogram(name: str, low: int, high: int, bins: int, where: str) -> str:
    return f"""
        select '{name}' as histogram, b as bin, {r(f'{low} + (b - 1) * cast({high - low} as double) / {bins}', 4)} as lower_edge,
            (
                select count(*) from raw_flights
                where CANCELLED = 0 and {where}
                    and least(floor((least(greatest(ARR_DELAY, {low}), {high}) - {low}) * {bins} / {high - low}), {bins - 1}) + 1 = b
            ) as flights
        from range(1, {bins + 1}) t(b)
    """


_FLOWN = "raw_flights where CANCELLED = 0 and ARR_DELAY is not null"

PROFILING = {
    "profile_schema": _all([_profile(c, kind) for c, kind in RAW_FLIGHT_COLUMNS.items()]),
    "profile_missing": _null_shares("column_name", _KEY_COLUMNS),
    "profile_status": _all(
        [
            f"select '{name}' as status, count(*) filter ({flag}) as flights, "
            f"{pct(f'count(*) filter ({flag})', 'count(*)')} as pct from raw_flights"
            for name, flag in [("Cancelled", "CANCELLED = 1"), ("On-Time", "ARR_DEL15 = 0"), ("Delayed", "ARR_DEL15 = 1")]
        ]
    ),
    "profile_cause_nulls": _null_shares("cause", [f"{c.upper()}_DELAY" for c in CAUSES], "ARR_DEL15 = 1"),
    "monthly_otp_trend": _TREND,
    "covid_volume_change": f"""
        select {r('before')} as mean_before, {r('low')} as mean_at_low, {r('(low / before - 1) * 100')} as low_change_pct,
            {r('after')} as mean_after, {r('(after / before - 1) * 100')} as after_change_pct
        from (
            select avg(operated) filter (year = 2019) as before,
                avg(operated) filter (year = 2020 and month in (4, 5)) as low,
                avg(operated) filter (year = 2022) as after
            from ({_TREND})
        )
    """,
    "delay_distribution": _histogram("all", -60, 300, 100, "ARR_DELAY is not null")
    + " union all "
    + _histogram("late", 15, 500, 80, "ARR_DELAY > 15"),
    "delay_describe": f"""
        select count(*) as count, {r('avg(ARR_DELAY)', 4)} as mean, {r('stddev_samp(ARR_DELAY)', 4)} as std,
            min(ARR_DELAY) as min, quantile_cont(ARR_DELAY, 0.25) as q25, median(ARR_DELAY) as median,
            quantile_cont(ARR_DELAY, 0.75) as q75, max(ARR_DELAY) as max, {r('skewness(ARR_DELAY)', 4)} as skewness,
            {r('kurtosis(ARR_DELAY)', 4)} as kurtosis
        from {_FLOWN}
    """,
    "cause_share": f"""
        select cause, minutes, {pct('minutes', 'sum(minutes) over ()')} as share_pct
        from (
            unpivot (
                select sum(CARRIER_DELAY) as Carrier, sum(LATE_AIRCRAFT_DELAY) as "Late Aircraft",
                    sum(NAS_DELAY) as NAS, sum(WEATHER_DELAY) as Weather, sum(SECURITY_DELAY) as Security
                from raw_flights where ARR_DEL15 = 1 and CARRIER_DELAY is not null
            ) on columns(*) into name cause value minutes
        )
    """,
    "cause_share_by_year": "select YEAR as year, "
    + ", ".join(
        f"{pct(f'sum({c.upper()}_DELAY)', ' + '.join(f'coalesce(sum({d.upper()}_DELAY), 0)' for d in CAUSES))} as {c}_pct"
        for c in CAUSES
    )
    + " from raw_flights where ARR_DEL15 = 1 group by YEAR",
    "profile_summary": f"""
        select count(*) as total_records, count(distinct OP_UNIQUE_CARRIER) as unique_carriers,
            {r('avg(ARR_DELAY)', 4)} as arr_delay_mean, median(ARR_DELAY) as arr_delay_median,
            {r('stddev_samp(ARR_DELAY)', 4)} as arr_delay_std, {r('skewness(ARR_DELAY)', 4)} as arr_delay_skewness,
            {pct('sum(CANCELLED) filter (YEAR = 2019)', 'count(*) filter (YEAR = 2019)')} as cancelled_rate_year_pct
        from raw_flights
    """,
}

_ON_TIME = pct(
    "count(*) filter (not is_cancelled and arr_delay_minutes <= 15)", "count(*) filter (not is_cancelled)"
)
_LATE = r("avg(arr_delay_minutes) filter (arr_delay_minutes > 15)")
_CANCELLED = pct("count(*) filter (is_cancelled)", "count(*)")

KPIS = {
    "kpi_on_time_rate": f"select {_ON_TIME} as on_time_rate_pct, {_ON_TIME} >= 80 as meets_target from stg_flights",
    "kpi_avg_arr_delay": f"select {_LATE} as avg_arr_delay_min, {_LATE} <= 45 as meets_target from stg_flights",
    "kpi_cancel_rate": f"select {_CANCELLED} as cancel_rate_pct, {_CANCELLED} <= 2 as meets_target from stg_flights",
    "kpi_cause_contribution": "select "
    + ", ".join(
        f"{pct(f'sum({c}_delay_minutes)', 'sum(total_cause_minutes)')} as {c}_contribution_pct"
        for c in ("carrier", "weather", "nas", "late_aircraft")
    )
    + " from stg_flights",
    "kpi_monthly_volume": """
        select flight_year, flight_month, count(*) as operated_flights
        from stg_flights where not is_cancelled group by flight_year, flight_month
    """,
}

QUESTIONS = {
    "carrier_consistency": f"""
        select carrier_code, count(*) as years, {r('avg(otp)', 4)} as mean_yearly_otp, {r('avg(rank)', 4)} as mean_rank,
            {r('stddev_pop(rank)', 4)} as rank_spread, min(rank) as best_rank, max(rank) as worst_rank
        from (
            select *, rank() over (partition by flight_year order by otp desc nulls last) as rank
            from (
                select carrier_code, flight_year,
                    {pct('count(*) filter (is_on_time)', 'count(arr_delay_minutes)')} as otp
                from stg_flights where not is_cancelled group by carrier_code, flight_year
            )
        )
        group by carrier_code
    """,
    "carrier_significance": f"""
        select carrier_code, n as arrivals, {pct('k', 'n')} as otp_pct, {pct('kk - k', 'nn - n')} as others_otp_pct,
            {r('z', 4)} as z_score, abs(z) > 1.96 as is_significant
        from (
            select *, (k / n - (kk - k) / (nn - n)) / sqrt(kk / nn * (1 - kk / nn) * (1 / n + 1 / (nn - n))) as z
            from (
                select carrier_code, count(*) filter (is_on_time) as k, count(arr_delay_minutes) as n,
                    cast(sum(count(*) filter (is_on_time)) over () as bigint) as kk,
                    cast(sum(count(arr_delay_minutes)) over () as bigint) as nn
                from stg_flights where not is_cancelled group by carrier_code
            )
        )
    """,
    "origin_delay_rank": f"""
        select *, rank() over (order by delay_rate_pct desc nulls last) as delay_rank
        from (
            select origin_airport_code, count(arr_delay_minutes) as arrivals,
                count(*) filter (is_arr_delayed) as delayed,
                {pct('count(*) filter (is_arr_delayed)', 'count(arr_delay_minutes)')} as delay_rate_pct
            from stg_flights where not is_cancelled group by origin_airport_code
        )
    """,
    "seasonality": f"""
        select flight_month, flight_day_of_week, count(arr_delay_minutes) as arrivals,
            {pct('count(*) filter (is_arr_delayed)', 'count(arr_delay_minutes)')} as delay_rate_pct,
            {r('avg(arr_delay_minutes)')} as mean_delay_min
        from stg_flights where not is_cancelled group by rollup (flight_month, flight_day_of_week)
    """,
    "volume_delay_corr": f"""
        select count(rate) as route_months, {r('corr(total_operated_flights, rate)', 6)} as correlation
        from (
            select *, delayed_flights / nullif(cast(flights_with_valid_arr_delay as double), 0) as rate
            from route_month_stats
        )
    """,
    "otp_projection": f"""
        with series as (
            select year * 12 + month - 1 as t, month, (operated - delayed) / nullif(operated, 0) * 100 as otp
            from ({_TREND}) where year * 12 + month - 1 >= 2020 * 12 + 6
        ),
        line as (select regr_slope(otp, t) as slope, regr_intercept(otp, t) as base, max(t) as last from series),
        seasonal as (select month, avg(otp - base - slope * t) as shift from series, line group by month)
        select cast((last + step) // 12 as bigint) as year, cast((last + step) % 12 + 1 as bigint) as month,
            {r('base + slope * (last + step)', 4)} as trend_otp,
            {r('base + slope * (last + step) + coalesce(shift, 0)', 4)} as projected_otp
        from line cross join range(1, 13) s(step) left join seasonal on seasonal.month = (last + step) % 12 + 1
    """,
}

SQL = MODELS | LANDING | VERIFICATION | QUALITY | PROFILING | KPIS | QUESTIONS


def complete(select: str) -> str:
    """A self-contained statement, also for selects that open with their own WITH."""
    inner = select.strip()
    return over_tables(f"select * from ({inner})" if inner.startswith("with ") else inner)
