from __future__ import annotations

import datetime as dt

from helpers import LOADED, airlines, airports, by, lookup, raw_flight, raw_flights

from tarmac.operators.enrichment import classify_delays, enrich_flights
from tarmac.operators.staging import stage_airlines, stage_airports, stage_flights


def test_flags_keep_missing_values(spark):
    rows = [
        raw_flight(OP_CARRIER_FL_NUM=1, CANCELLED=1.0, ARR_DEL15=None, ARR_DELAY=None),
        raw_flight(OP_CARRIER_FL_NUM=2, DIVERTED=None),
        raw_flight(OP_CARRIER_FL_NUM=3, DIVERTED=1.0),
        raw_flight(OP_CARRIER_FL_NUM=4, ARR_DEL15=1.0, CARRIER_DELAY=20.0),
        raw_flight(OP_CARRIER_FL_NUM=5, ARR_DEL15=None),
    ]
    staged = by(stage_flights(raw_flights(spark, rows)), "flight_number")
    assert set(staged) == {"1", "4", "5"}
    assert staged["1"]["is_on_time"] is None and staged["1"]["is_cancelled"] and staged["1"]["is_arr_delayed"] is None
    assert staged["4"]["is_on_time"] is False and staged["4"]["total_cause_minutes"] == 20.0
    assert staged["5"]["is_on_time"] is None and staged["5"]["total_cause_minutes"] == 0.0


def test_airline_descriptions(spark):
    raw = lookup(spark, [("1", "X Inc.: XX"), ("2", "X Inc."), ("3", "A: B: CC"), ("4", "Y: OO")])
    staged = by(stage_airlines(raw), "carrier_id")
    assert [staged[i]["carrier_code"] for i in "1234"] == ["XX", None, "CC", "OO"]
    assert staged["4"]["carrier_type"] == "Regional" and staged["2"]["carrier_type"] == "Other"


def test_airport_descriptions(spark):
    raw = lookup(spark, [("1", "Dallas, TX: DFW Intl"), ("2", "NoComma")])
    staged = by(stage_airports(raw), "airport_id")
    assert [staged["1"][c] for c in ("city_name", "state_code", "airport_name")] == ["Dallas", "TX", "DFW Intl"]
    assert [staged["2"][c] for c in ("city_name", "state_code", "airport_name")] == ["NoComma", None, None]


def test_newest_load_wins_and_letters_share_a_key(spark):
    old = lookup(spark, [("1", "Old, TX: A"), ("ABC", "Zed, TX: Z")], LOADED - dt.timedelta(days=9))
    new = lookup(spark, [("1", "New, TX: A"), ("XYZ", "Abe, TX: A"), ("01", "Dup, TX: A")])
    staged = by(stage_airports(old.unionByName(new)), "airport_id")
    assert set(staged) == {"1", "XYZ"}
    assert staged["1"]["city_name"] == "New"


def test_a_key_with_very_many_loads(spark):
    loads = spark.range(200_000).selectExpr(
        "if(id % 3 = 0, cast(id as string), '7') as Code",
        "concat('City', id, ', TX: N') as Description",
        "timestamp_seconds(id) as _loaded_at",
        "'f' as _source_file",
    )
    staged = stage_airports(loads.filter("id % 3 != 0"))
    assert [(r.airport_id, r.city_name) for r in staged.collect()] == [("7", "City199999")]


def enriched(spark, *rows):
    return enrich_flights(
        stage_flights(raw_flights(spark, list(rows))), stage_airlines(airlines(spark)), stage_airports(airports(spark))
    )


def test_lookup_misses_keep_the_flight(spark):
    rows = by(
        enriched(spark, raw_flight(), raw_flight(OP_UNIQUE_CARRIER="ZZ", ORIGIN_AIRPORT_ID=99, CRS_ELAPSED_TIME=0.0)),
        "carrier_code",
    )
    assert rows["AA"]["carrier_id"] == "19805" and rows["AA"]["carrier_type"] == "Legacy"
    assert rows["AA"]["schedule_efficiency_ratio"] == 0.9 and rows["AA"]["route_key"] == "ATL-LAX"
    assert rows["ZZ"]["carrier_id"] is None and rows["ZZ"]["carrier_type"] == "Other"
    assert rows["ZZ"]["origin_airport_name"] is None and rows["ZZ"]["dest_airport_name"] == "LAX International"
    assert rows["ZZ"]["schedule_efficiency_ratio"] is None


def test_a_code_listed_twice_multiplies_its_flights(spark):
    twice = airlines(spark).unionByName(lookup(spark, [("1", "Second American: AA")]))
    flights = stage_flights(raw_flights(spark, [raw_flight()]))
    joined = enrich_flights(flights, stage_airlines(twice), stage_airports(airports(spark)))
    assert sorted(r.carrier_id for r in joined.collect()) == ["1", "19805"]


def test_classified_delays(spark):
    late = {"ARR_DEL15": 1.0, "ARR_DELAY": 90.0, "ARR_DELAY_NEW": 90.0}
    rows = by(
        classify_delays(
            enriched(
                spark,
                raw_flight(OP_CARRIER_FL_NUM=1),
                raw_flight(OP_CARRIER_FL_NUM=2, **late),
                raw_flight(OP_CARRIER_FL_NUM=3, **late, CARRIER_DELAY=30.0, LATE_AIRCRAFT_DELAY=60.0),
                raw_flight(OP_CARRIER_FL_NUM=4, **late, CARRIER_DELAY=45.0, NAS_DELAY=45.0),
            )
        ),
        "flight_id",
    )
    assert len(rows) == 3
    nothing, mostly_late, tie = sorted(rows.values(), key=lambda r: (r["total_cause_minutes"], r["is_cascade_delay"] * -1))
    assert nothing["carrier_delay_pct"] is None and nothing["carrier_is_majority"] is False
    assert mostly_late["carrier_delay_pct"] == 33.33 and mostly_late["late_aircraft_is_majority"]
    assert mostly_late["is_cascade_delay"] and mostly_late["delay_duration_category"] == "1_to_2_hours"
    assert tie["primary_delay_cause"] == "Carrier" and tie["carrier_is_majority"] is False
