"""Business labels of a flight: calendar, severity, cause and distance bands."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -----------------------------------------------------------------
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
SEASONS = {"Winter": [12, 1, 2], "Spring": [3, 4, 5], "Summer": [6, 7, 8], "Fall": [9, 10, 11]}
COVID_START = dt.date(2020, 3, 1)
COVID_END = dt.date(2022, 1, 1)
COVID_PHASES = ["Pre-Covid", "COVID Impact", "Recovery"]
CANCELLATION_REASONS = {"A": "Carrier", "B": "Weather", "C": "National Air System", "D": "Security"}
CARRIER_TYPES = {
    "Legacy": ["AA", "DL", "UA"],
    "Low-Cost": ["WN", "B6"],
    "Mid-Size": ["AS"],
    "Ultra Low-Cost": ["NK", "F9", "G4"],
    "Regional": ["HA", "MQ", "OO", "YX", "OH", "QX", "9E", "YV"],
}
OTHER_CARRIER = "Other"
# (label, first HHMM, last HHMM), both included
TIMES_OF_DAY = [
    ("Early Morning (5-9am)", 500, 859),
    ("Morning (9am-12pm)", 900, 1159),
    ("Afternoon (12-3pm)", 1200, 1459),
    ("Late Afternoon (3-6pm)", 1500, 1759),
    ("Evening (6-9pm)", 1800, 2059),
    ("Night (9pm-12am)", 2100, 2359),
    ("Red-Eye (12-5am)", 0, 459),
]
# severity label and its longest delay in minutes, shortest first
SEVERITIES = [
    ("On Time", 15), ("Minor Delay", 45), ("Moderate Delay", 120), ("Severe Delay", 240), ("Extreme Delay", None),
]
# label and the mileage it stays below
DISTANCE_BANDS = [
    ("Short-Haul (<250mi)", 250),
    ("Medium-Haul (250-750mi)", 750),
    ("Long-Haul (750-1500mi)", 1500),
    ("Ultra Long-Haul (>1500mi)", None),
]
# cause labels in order of precedence
CAUSES = {
    "Carrier": "carrier", "Late Aircraft": "late_aircraft", "NAS": "nas", "Weather": "weather", "Security": "security",
}
# label and the on-time percentage it starts at
OTP_BANDS = [
    ("Excellent (>=85%)", 85), ("Good (80-85%)", 80), ("Fair (70-80%)", 70), ("Poor (60-70%)", 60),
    ("Critical (<60%)", None),
]
NO_OTP = "No Operations / No Data"
# label and the longest delay in minutes
DURATIONS = [("under_1_hour", 60), ("1_to_2_hours", 120), ("2_to_4_hours", 240), ("over_4_hours", None)]
# ------------------------------------------------------------------------------


def _choose(branches: list[tuple[Column, object]], otherwise: object = None) -> Column:
    """First true branch wins."""
    chain = F
    for condition, label in branches:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def _nth(names: list[str], number: Column) -> Column:
    """1-based pick from a short list; NULL outside it."""
    return F.get(F.array(*map(F.lit, names)), number.cast("int") - 1)


def weekday_name(day_of_week: Column) -> Column:
    """Name of weekday 1 (Monday) to 7 (Sunday), else ``Unknown``."""
    return F.coalesce(_nth(WEEKDAYS, day_of_week), F.lit("Unknown"))


def month_name(month: Column) -> Column:
    return _nth(MONTHS, month)


def season(month: Column) -> Column:
    return _choose([(month.isin(months), name) for name, months in SEASONS.items()])


def covid_phase(day: Column) -> Column:
    before, during, after = COVID_PHASES
    return _choose([(day < F.lit(COVID_START), before), (day < F.lit(COVID_END), during)], after)


def in_covid(day: Column) -> Column:
    return (day >= F.lit(COVID_START)) & (day < F.lit(COVID_END))


def cancellation_reason(code: Column) -> Column:
    return _choose([(code == letter, reason) for letter, reason in CANCELLATION_REASONS.items()])


def carrier_type(code: Column) -> Column:
    return _choose([(code.isin(codes), kind) for kind, codes in CARRIER_TYPES.items()], OTHER_CARRIER)


def time_of_day(hhmm: Column) -> Column:
    return _choose([(hhmm.between(first, last), label) for label, first, last in TIMES_OF_DAY], "Unknown")


def _severity(cancelled: Column, delay: Column, values: list[object]) -> Column:
    early, *late = values
    branches = [(cancelled, None), (delay < 0, early)]
    for value, (_, longest) in zip(late, SEVERITIES, strict=True):
        branches.append((delay.isNotNull() if longest is None else delay <= longest, value))
    return _choose(branches)


def severity(cancelled: Column, delay: Column) -> Column:
    return _severity(cancelled, delay, ["Early"] + [label for label, _ in SEVERITIES])


def severity_order(cancelled: Column, delay: Column) -> Column:
    return _severity(cancelled, delay, list(range(1, len(SEVERITIES) + 2))).cast("long")


def distance_band(miles: Column) -> Column:
    bounded = [(miles < below, label) for label, below in DISTANCE_BANDS if below]
    return _choose([*bounded, (miles.isNotNull(), DISTANCE_BANDS[-1][0])])


def duration_band(minutes: Column) -> Column:
    bounded = [(minutes <= longest, label) for label, longest in DURATIONS if longest]
    return _choose([(minutes.isNull(), "unknown"), *bounded], DURATIONS[-1][0])


def otp_band(otp: Column) -> Column:
    bounded = [(otp >= start, label) for label, start in OTP_BANDS if start]
    return _choose([(otp.isNull(), NO_OTP), *bounded], OTP_BANDS[-1][0])


def cause_minutes(label: str) -> Column:
    """A flight's minutes of one cause."""
    return F.col(f"{CAUSES[label]}_delay_minutes")


def primary_cause() -> Column:
    """Largest cause of a flight; a tie goes to the cause listed first."""
    minutes = {label: cause_minutes(label) for label in CAUSES}
    longest = F.greatest(*[F.coalesce(m, F.lit(0.0)) for m in minutes.values()])
    nothing_recorded = F.coalesce(*minutes.values()).isNull()
    tops = [(m == longest, label) for label, m in minutes.items()]
    return _choose([(nothing_recorded, None), (longest == 0, "Unattributed"), *tops], "Unknown")


def dominant_cause() -> Column:
    """Largest cause of a route-month; a tie is its own label."""
    minutes = {label: F.col(f"total_{name}_delay_min") for label, name in CAUSES.items()}
    longest = F.greatest(*minutes.values())
    at_top = sum((F.when(m == longest, 1).otherwise(0) for m in minutes.values()), F.lit(0))
    tops = [(m == longest, label) for label, m in minutes.items()]
    return _choose(
        [
            (F.col("total_operated_flights") == 0, "No Operations"),
            (F.col("total_delay_minutes") == 0, "No Delay"),
            (at_top > 1, "Multiple Causes"),
            *tops,
        ],
        "Unknown",
    )
