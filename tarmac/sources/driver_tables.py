"""Raw flight and lookup tables derived from the generic test tables.

The test data holds no flights, so each line item becomes one scheduled flight,
each supplier an airline and each customer an airport. The expressions are plain
SQL that Spark and DuckDB evaluate alike; ``SPARK`` holds the few that differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.schemas import FLIGHT_FILE_COLUMNS

SPARK = {
    "days": "datediff(cast(l_shipdate as date), date'1995-01-01')",
    "FL_DATE": "date_add(date'2019-07-01', dd)",
    "DAY_OF_WEEK": "cast(weekday(FL_DATE) + 1 as bigint)",
    "pick": "get(array({items}), cast({index} as int))",
}

_ORIGINS, _DESTS = "ATL,ORD,DFW,JFK,SEA,GUM", "LAX,ATL,IAH,BOS,LAX,HNL"
_ORIGIN_IDS, _DEST_IDS = "10397,13930,11298,12478,14747,12016", "12892,10397,12266,10721,12892,12173"
_ORIGIN_CITIES = "Atlanta, GA;Chicago, IL;Dallas/Fort Worth, TX;New York, NY;Seattle, WA;Guam, TT"
_DEST_CITIES = "Los Angeles, CA;Atlanta, GA;Houston, TX;Boston, MA;Los Angeles, CA;Honolulu, HI"


def _chooser(dialect: dict[str, str]):
    def pick(values: str, index: str, separator: str = ",") -> str:
        items = ", ".join(f"'{value}'" for value in values.split(separator))
        return dialect["pick"].format(items=items, index=index)

    return pick


def _clock(hour: str, minute: str) -> str:
    return f"(({hour}) % 24) * 100 + ({minute}) % 60"


_MINUTE = "cast(floor(h / 24) as bigint)"


def flight_steps(dialect: dict[str, str]) -> list[dict[str, str]]:
    """Successive projections from ``lineitem`` to the raw flight table: name -> SQL."""
    pick = _chooser(dialect)
    base = {
        "dd": f"cast({dialect['days']} % 1096 as int)",
        "ci": "cast(l_suppkey % 8 as int)",
        "ri": "cast(case when l_partkey % 97 = 0 then 5 else l_partkey % 5 end as int)",
        "h": "cast(round(l_extendedprice * 100) as bigint)",
        "fl_num": "cast(l_orderkey * 10 + l_linenumber as bigint)",
    }
    drawn = {
        "ci": "ci",
        "ri": "ri",
        "h": "h",
        "fl_num": "fl_num",
        "FL_DATE": dialect["FL_DATE"],
        "can": "case when h % 53 = 0 then 1 else 0 end",
        "dv": "case when h % 211 = 0 then 1 else 0 end",
        "ad": "case when h % 101 = 0 then 250 + h % 90 when h % 29 = 0 then 46 + h % 175 "
        "else (h % 61) - 40 + ci * 2 + case when ri = 3 then 8 else 0 end end",
        "dist": f"cast({pick('1946,606,224,187,954,3801', 'ri')} as int)",
    }
    judged = {
        **{name: name for name in drawn},
        "ok": "can = 0 and dv = 0",
        "has": "can = 0 and dv = 0 and ad >= 15 and h % 17 <> 0",
        "pat": "h % 6",
    }

    def flown(value: str) -> str:
        return f"cast(case when ok then {value} end as double)"

    def departed(value: str) -> str:
        return f"cast(case when can = 0 then {value} end as double)"

    def caused(cases: str) -> str:
        return f"cast(case when has then case {cases} else 0 end end as double)"

    flight = {
        "YEAR": "cast(year(FL_DATE) as bigint)",
        "QUARTER": "cast(quarter(FL_DATE) as bigint)",
        "MONTH": "cast(month(FL_DATE) as bigint)",
        "DAY_OF_MONTH": "cast(day(FL_DATE) as bigint)",
        "DAY_OF_WEEK": dialect["DAY_OF_WEEK"],
        "FL_DATE": "FL_DATE",
        "OP_UNIQUE_CARRIER": pick("AA,DL,UA,WN,AS,B6,NK,ZZ", "ci"),
        "OP_CARRIER": pick("AA,DL,UA,WN,AS,B6,NK,ZZ", "ci"),
        "TAIL_NUM": "case when h % 401 <> 0 then concat('N', cast(100 + h % 900 as string)) end",
        "OP_CARRIER_FL_NUM": "fl_num",
        "ORIGIN_AIRPORT_ID": f"cast({pick(_ORIGIN_IDS, 'ri')} as bigint)",
        "ORIGIN": pick(_ORIGINS, "ri"),
        "ORIGIN_CITY_NAME": pick(_ORIGIN_CITIES, "ri", ";"),
        "ORIGIN_STATE_ABR": f"nullif({pick('GA,IL,TX,NY,WA,', 'ri')}, '')",
        "DEST_AIRPORT_ID": f"cast({pick(_DEST_IDS, 'ri')} as bigint)",
        "DEST": pick(_DESTS, "ri"),
        "DEST_CITY_NAME": pick(_DEST_CITIES, "ri", ";"),
        "DEST_STATE_ABR": pick("CA,GA,TX,MA,CA,HI", "ri"),
        "CRS_DEP_TIME": f"cast(case when h % 997 <> 0 then {_clock('h', _MINUTE)} end as bigint)",
        "DEP_TIME": departed(_clock("h", f"{_MINUTE} + h % 7")),
        "DEP_DELAY": departed("ad - 5"),
        "DEP_DELAY_NEW": departed("greatest(ad - 5, 0)"),
        "DEP_DEL15": departed("case when ad - 5 >= 15 then 1 else 0 end"),
        "DEP_DELAY_GROUP": departed("floor(least(greatest(ad - 5, -30), 180) / 15)"),
        "TAXI_OUT": departed("8 + h % 23"),
        "WHEELS_OFF": departed(_clock("h + 1", "h")),
        "WHEELS_ON": flown(_clock("h + 3", "h")),
        "TAXI_IN": flown("3 + h % 11"),
        "CRS_ARR_TIME": f"cast({_clock('h + 3', _MINUTE)} as bigint)",
        "ARR_TIME": flown(_clock("h + 3", "h + 11")),
        "ARR_DELAY": flown("ad"),
        "ARR_DELAY_NEW": flown("greatest(ad, 0)"),
        "ARR_DEL15": flown("case when ad >= 15 then 1 else 0 end"),
        "ARR_DELAY_GROUP": flown("floor(least(greatest(ad, -30), 180) / 15)"),
        "CANCELLED": "cast(can as double)",
        "CANCELLATION_CODE": f"case when can = 1 then {pick('A,B,C,D', 'h % 4')} end",
        "DIVERTED": "cast(dv as double)",
        "CRS_ELAPSED_TIME": "cast(case when h % 499 = 0 then 0 else 30 + floor(dist / 8) end as double)",
        "ACTUAL_ELAPSED_TIME": flown("30 + floor(dist / 8) + h % 31 - 15"),
        "AIR_TIME": flown("20 + floor(dist / 8) + h % 17 - 8"),
        "FLIGHTS": "cast(1 as double)",
        "DISTANCE": "cast(dist as double)",
        "DISTANCE_GROUP": "cast(floor(dist / 250) + 1 as bigint)",
        "CARRIER_DELAY": caused(
            "when pat = 0 then ad when pat = 1 then floor(ad / 2) when pat = 5 then floor(ad / 3)"
        ),
        "WEATHER_DELAY": caused("when pat = 4 and h % 4 <> 0 then ad"),
        "NAS_DELAY": caused("when pat = 3 then ad when pat = 5 then ad - floor(ad / 3)"),
        "SECURITY_DELAY": caused("when pat = 4 and h % 4 = 0 and h % 24 <> 4 then ad"),
        "LATE_AIRCRAFT_DELAY": caused("when pat = 1 then floor(ad / 2) when pat = 2 then ad"),
        "_loaded_at": "timestamp '2024-01-15 00:00:00'",
        "_source_file": "concat('ontime_', cast(year(FL_DATE) as string), '_', "
        "lpad(cast(month(FL_DATE) as string), 2, '0'), '.csv')",
    }
    assert [*FLIGHT_FILE_COLUMNS] == [*flight][:-2]
    return [base, drawn, judged, flight]


_KNOWN_AIRLINES = (
    "American Airlines Inc.: AA;Delta Air Lines Inc.: DL;United Air Lines Inc.: UA;Southwest Airlines Co.: WN;"
    "Alaska Airlines Inc.: AS;JetBlue Airways: B6;Spirit Air Lines: NK;Uncoded Charter;Frontier Airlines Inc.: F9;"
    "Allegiant Air: G4;Hawaiian Airlines Inc.: HA;Envoy Air: MQ;SkyWest Airlines Inc.: OO;Republic Airline: YX;"
    "PSA Airlines Inc.: OH;Horizon Air: QX;Endeavor Air Inc.: 9E;Mesa Airlines Inc.: YV"
)
_KNOWN_AIRPORTS = (
    "Atlanta, GA: Hartsfield-Jackson;Chicago, IL: O Hare International;Dallas/Fort Worth, TX: DFW International;"
    "New York, NY: John F. Kennedy;Seattle, WA: Sea-Tac;Los Angeles, CA: LAX International;"
    "Houston, TX: George Bush;Boston, MA: Logan International;Honolulu, HI: Daniel K. Inouye"
)
_KNOWN_AIRPORT_IDS = "10397,13930,11298,12478,14747,12892,12266,10721,12173"
_STATES = "AL,AK,AZ,AR,CA,CO,CT,DE,FL,GA,ID,IL,IN,IA,KS,KY,LA,ME,MD,MA,MI,MN,PR,VI,NV"


def airline_rows(dialect: dict[str, str]) -> dict[str, str]:
    """Newest airline row of each supplier."""
    pick = _chooser(dialect)
    known = f"s_suppkey < {_KNOWN_AIRLINES.count(';') + 1}"
    return {
        "Code": "cast(19000 + s_suppkey as string)",
        "Description": f"case when {known} then {pick(_KNOWN_AIRLINES, 's_suppkey', ';')} "
        "else concat(s_name, ': S', cast(s_suppkey as string)) end",
        "_loaded_at": "timestamp '2024-01-15 00:00:00'",
        "_source_file": "'L_AIRLINE_ID.csv'",
    }


def airport_rows(dialect: dict[str, str]) -> dict[str, str]:
    """Newest airport row of each customer; some ids are letters, some names lack a comma."""
    pick = _chooser(dialect)
    known = f"c_custkey < {_KNOWN_AIRPORT_IDS.count(',') + 1}"
    return {
        "Code": f"case when {known} then {pick(_KNOWN_AIRPORT_IDS, 'c_custkey')} "
        "when c_custkey % 50 = 49 then concat('X', cast(c_custkey as string)) "
        "else cast(20000 + c_custkey as string) end",
        "Description": f"case when {known} then {pick(_KNOWN_AIRPORTS, 'c_custkey', ';')} "
        "when c_custkey % 11 = 9 then c_name "
        f"else concat(c_mktsegment, ', ', {pick(_STATES, 'c_nationkey % 25')}, ': ', c_name) end",
        "_loaded_at": "timestamp '2024-01-15 00:00:00'",
        "_source_file": "'L_AIRPORT.csv'",
    }


# Every fifth airline and seventh airport also has an older load to be replaced.
OLDER_AIRLINES, OLDER_AIRPORTS = "s_suppkey % 5 = 0", "c_custkey % 7 = 0"
OLDER = {"_loaded_at": "timestamp '2023-01-15 00:00:00'", "Description": "concat('Former ', Description)"}


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} as `{name}`" for name, sql in columns.items()])


def _driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _driver_table(spark, sf_dir, "lineitem")
    for step in flight_steps(SPARK):
        df = _project(df, step)
    return df


def _with_older(source: DataFrame, rows: dict[str, str], older: str) -> DataFrame:
    newest = _project(source, rows)
    replaced = _project(_project(source.filter(older), rows), {name: OLDER.get(name, name) for name in rows})
    return newest.unionByName(replaced)


def raw_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_older(_driver_table(spark, sf_dir, "supplier"), airline_rows(SPARK), OLDER_AIRLINES)


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_older(_driver_table(spark, sf_dir, "customer"), airport_rows(SPARK), OLDER_AIRPORTS)
