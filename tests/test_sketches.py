"""Rank sketches against exact ranks, and the entry without the libraries of the text operators."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tarmac.functions import sketches

VALUES = {
    "skewed": "exp(pmod(xxhash64(id), 100000) / 10000)",
    "tied": "cast(pmod(xxhash64(id), 7) as double)",
    "mostly one": "if(id % 3 > 0, 0D, cast(id as double))",
}


@pytest.mark.parametrize("kind", VALUES)
def test_merged_sketches_keep_their_rank_error(spark, kind):
    rows = spark.range(60_000).selectExpr("id % 2 as route", "id % 12 as month", f"{VALUES[kind]} as delay")
    monthly = sketches.sketched(rows, ["route", "month"], "delay")
    whole = sketches.merge_sketched(monthly, ["route"])
    ranks = [0.05, 0.25, 0.5, 0.9, 0.99]
    got = whole.select("route", "rows", *[sketches.quantile(F.col("sketch"), r).alias(f"q{i}") for i, r in enumerate(ranks)])
    joined = rows.join(got, "route").groupBy("route", "rows").agg(
        *[F.struct(F.avg((F.col("delay") < F.col(f"q{i}")).cast("int")).alias("below"),
                   F.avg((F.col("delay") <= F.col(f"q{i}")).cast("int")).alias("upto")).alias(f"r{i}") for i in range(len(ranks))]
    )
    for row in joined.collect():
        assert row["rows"] == 30_000
        for i, rank in enumerate(ranks):
            found = row[f"r{i}"]
            assert found.below - 2 * sketches.RANK_ERROR <= rank <= found.upto + 2 * sketches.RANK_ERROR


def test_a_sketch_of_nothing_has_no_median(spark):
    rows = spark.createDataFrame([("a", None), ("b", 2.0), ("b", None)], "k string, v double")
    got = sketches.sketched(rows, ["k"], "v").select("k", sketches.quantile(F.col("sketch"), 0.5).alias("m"))
    assert dict(map(tuple, got.collect())) == {"a": None, "b": 2.0}


@pytest.mark.parametrize("absent", ["zstandard", "tokenizers", "public_tokenizers"])
def test_the_entry_stands_without_text_libraries(absent):
    code = f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; assert len(e.queries()) >= 68; e.oracle_sql()"
    root = Path(__file__).resolve().parent.parent
    assert subprocess.run([sys.executable, "-c", code], cwd=root, timeout=120, check=False).returncode == 0
