"""The pipeline's stages against plain versions, and the DuckDB counterparts of the queries."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from tarmac.llm import minhash, queries, secret_scan  # noqa: E402
from tarmac.llm.common import table  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_counterparts(spark, name):
    con = duckdb.connect()
    for view in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF}/{view}.parquet'")
    expected = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    rows = sorted(expected.fetchall())
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names) and sorted(map(tuple, got.select(*names).collect())) == rows


def test_stages(spark):
    large = "/root/testdata/sf0.1"
    docs, labels = table(spark, large, "documents"), table(spark, large, "labels")
    clean = corpus_pipeline.toxicity(spark, docs, large)
    assert clean.columns == docs.columns
    toxic = labels.filter("toxic = 1")
    assert clean.join(toxic, "doc_id").count() <= 0.1 * toxic.count()
    fine = labels.filter("toxic = 0")
    assert clean.join(fine, "doc_id").count() >= 0.95 * fine.count()

    docs = table(spark, SF, "documents")
    doubled = docs.unionByName(docs.limit(50)).unionByName(docs.limit(5).withColumn("doc_id", F.lit(None).cast("long")))
    kept = corpus_pipeline.near_dedup(spark, doubled, SF)
    assert kept.columns == docs.columns and kept.filter("doc_id is null").count() == 5
    ids = [r.doc_id for r in kept.filter("doc_id is not null").collect()]
    assert len(ids) == len(set(ids)) == corpus_pipeline.near_dedup(spark, docs, SF).count()

    blotted = corpus_pipeline.secrets(spark, docs, SF)
    assert blotted.columns == docs.columns and blotted.count() == docs.count()
    assert all(not secret_scan.find_spans(r.text) and r.n_chars == len(r.text) for r in blotted.collect())

    mixed = corpus_pipeline.mix(spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3


def test_rows_of_one_id_remove_only_their_likes(spark):
    def text(k):
        return " ".join(f"w{k}x{n}" for n in range(60))

    def near(k):
        return text(k) + f" end{k}"

    rows = [(7, text(1)), (7, text(2)), (7, None), (7, text(1)), (7, near(2)), (3, near(1)), (9, text(2)), (5, text(3)), (5, ""), (5, None), (None, text(3))]
    docs = spark.createDataFrame([(k, x, "en", "s", 1) for k, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, SF)
    got = sorted((r.doc_id or 0, "null" if r.text is None else r.text) for r in kept.collect())
    of_two = [x for k, x in got if k == 7 and x in (text(2), near(2))]
    assert kept.columns == docs.columns and len(of_two) == 1
    assert got == sorted([(0, text(3)), (3, near(1)), (5, ""), (5, "null"), (5, text(3)), (7, "null"), (7, of_two[0])])
    classes = {(r.doc_id, r.class_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert classes == {(None, 5, True), (3, 3, True), (5, 5, True), (7, 3, False), (7, 7, True), (7, 7, False), (9, 7, False)}


def test_stages_on_odd_and_empty_tables(spark):
    from test_operators import empty_docs, odd_docs

    names = ["row", "judged", "id", "mark", "place", "read", "_text", "_judged", "_mark", "_first", "predicted"]
    for docs in (odd_docs(spark), empty_docs(spark)):
        docs = docs.selectExpr("*", *[f"concat('own ', '{n}') as {n}" for n in names])
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            if name != "encode":
                assert out.columns == docs.columns
                assert all(r[n] == f"own {n}" for r in rows for n in names)
            if name == "secrets":
                assert len(rows) == docs.count()
            assert docs.count() or not rows


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and out.filter("not restored").count() == 0
    assert np.all([len(r.ids) == r.n_tokens for r in out.collect()])
