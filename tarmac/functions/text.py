"""Text parsing and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what stands for a missing part inside a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """md5 hex of the parts as text, joined by ``-``."""
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_KEY_PART)) for p in parts]))


def extract_or_null(text: Column, pattern: str) -> Column:
    """First capture group, trimmed; NULL when the pattern does not match."""
    return F.trim(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")))


def piece(text: Column, delimiter: str, index: int) -> Column:
    """0-based piece of a split; NULL when there are too few pieces."""
    return F.get(F.split(text, delimiter), F.lit(index))
