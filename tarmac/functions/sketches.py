"""Mergeable rank sketches, for columns with too many distinct values to count each.

A sketch of a group is a small binary value. Sketches of parts of a group merge into one of
the whole, so that they can be stored per month and put together later. The exact ways, from
counts per distinct value, stay the default; nothing in the warehouse uses a sketch in their place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of a sketch, and the rank error that 99 of 100 quantiles taken from one stay within.
SKETCH_SIZE = 400
RANK_ERROR = 0.0085


def rank_sketch(values: Column) -> Column:
    """Aggregate: a sketch of the values that are not NULL."""
    return F.kll_sketch_agg_double(values.cast("double"), F.lit(SKETCH_SIZE))


def merged(sketches: Column) -> Column:
    """Aggregate: one sketch of all that the given ones have seen."""
    return F.kll_merge_agg_double(sketches, F.lit(SKETCH_SIZE))


def quantile(sketch: Column, rank: float) -> Column:
    """The value at a rank from 0 to 1, NULL for a sketch that has seen none."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))


def sketched(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per key: its rows, and the sketch of a column. States of parts are merged by ``merge_sketched``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), rank_sketch(F.col(value)).alias("sketch"))


def merge_sketched(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of several parts, or of finer keys, as one per key."""
    return states.groupBy(*keys).agg(F.sum("rows").alias("rows"), merged(F.col("sketch")).alias("sketch"))
