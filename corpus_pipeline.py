"""A corpus pipeline of five stages. Each stage's rows are written and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm import minhash, mixing, secret_scan, suffix_pieces, text_cnn
from tarmac.llm.common import JOIN, table, written
from tarmac.llm.queries import PIECES


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, with all their columns whatever their names.

    Null and empty texts are judged as texts without words, long ones whole; equal rows fare
    alike. Where there is nothing to learn from, the share of toxic labels decides. An empty table stays empty.
    """
    model, share = text_cnn.learn(docs, table(spark, sf_dir, "labels"), "toxic")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("judged"))
    return text_cnn.classify(rows, model, share, "judged").filter("predicted = 0").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, with all its columns; documents without an id stay.

    Rows that share an id but not a text are documents of their own; of rows that share both
    one stays. Texts without words, null ones among them, are near no other. An empty table stays empty.
    """
    kept = minhash.row_classes(docs.select("doc_id", "text")).filter("kept and doc_id is not null")
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("mark").alias("kept_mark")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.col("text").alias("read"))
    rows = rows.withColumn("mark", minhash.mark("read"))
    found = rows.join(kept.hint(JOIN), (rows["id"] == kept["kept_id"]) & (rows["mark"] == kept["kept_mark"]), "left_semi")
    first = F.row_number().over(Window.partitionBy("id", "mark").orderBy("read"))
    one = found.withColumn("place", first).filter("place = 1").select("row.*")
    return one.unionByName(docs.filter("doc_id is null"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets blotted out and ``n_chars`` set anew; null texts stay null, other columns as they are."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document once for each time it is taken, whole, with all its columns.

    Texts without words, null ones among them, are never taken, since they have no share in a source.
    A null source is a source of its own. An empty table stays empty.
    """
    mixed = mixing.mix(docs).withColumn("n_chars", F.length("text").cast("long"))
    return mixed.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix, whole texts; equal rows stay rows of their own, an empty table stays empty."""
    return suffix_pieces.encode(docs.select("doc_id", "text"), suffix_pieces.load_pieces(PIECES))


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("secrets", secrets), ("mix", mix), ("encode", encode)]

#: Classifier, signatures, decoding and pieces are beyond SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
