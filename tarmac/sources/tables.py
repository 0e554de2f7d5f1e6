"""Parquet tables, one folder per layer, and the shared folder for intermediate results."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DEFAULT_LAYER = "default"
ROWS_PER_FILE = 1 << 20


def layer_path(root: str, table: str, layer: str | None = None) -> str:
    """Folder of a table: the layer name as given, or the default layer."""
    return "/".join([root.rstrip("/"), (layer or DEFAULT_LAYER).strip(), table])


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate results that every executor can reach.

    The session's ``spark.checkpoint.dir``, or a folder in its warehouse where
    that is unset. A warehouse on the machine's own disk is shared by the threads of a local
    master only, so that a cluster has to name one or the other.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or ""
    one_process = spark.sparkContext.master.split("[")[0] == "local"
    if not warehouse or not (one_process or ":/" in warehouse and not warehouse.startswith("file:")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_intermediate"


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder.

    Used where several branches of one plan need the same aggregate: flights are
    then read once, and a lost executor costs a re-read of the small table.
    """
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None while nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def dealt_to_files(df: DataFrame, month: str, cluster_by: list[str], rows_per_file: int) -> DataFrame:
    """The rows with ``_file``, the number of the file within its month that they belong to.

    A month is cut into runs of its clustering columns of about ``rows_per_file`` rows, so that
    the smallest and largest values in a file's footer tell readers what it can't hold. Only
    the clustering columns are read to count; a combination with more rows than a file is
    dealt to several by a hash of the row. Running sums are over a month's combinations, not over its rows.
    The counts are written once, so that their small size is known and the rows need no shuffle to meet them.
    """
    keys = cluster_by[:2]
    runs = df.groupBy(month, *keys).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(month).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    runs = runs.select(
        *[F.col(c).alias(f"_{c}") for c in (month, *keys)],
        F.floor(before / rows_per_file).alias("_first"), F.ceil(F.col("_rows") / rows_per_file).alias("_parts"),
    )
    runs = written_once(runs, "file-runs")
    same = [df[c].eqNullSafe(runs[f"_{c}"]) for c in (month, *keys)]
    dealt = df.join(runs, same)
    part = F.when(F.col("_parts") > 1, F.pmod(F.xxhash64(*df.columns), "_parts")).otherwise(0)
    return dealt.select(*df.columns, (F.col("_first") + part).alias("_file"))


def write_monthly(
    df: DataFrame, path: str, month: Column, cluster_by: list[str], mode: str, partition: str = "flight_month_start",
    keep_other_months: bool = True, rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Write a table in monthly folders, its files cut along the clustering columns and ordered by them.

    The rebalance hint gathers a file's rows and lets adaptive execution cut what is
    far larger than the rest into several tasks. With mode ``overwrite`` only the
    months present in ``df`` are replaced, or the whole table without ``keep_other_months``.
    """
    monthly = df.withColumn(partition, F.trunc(month, "month"))
    (
        dealt_to_files(monthly, partition, cluster_by, rows_per_file)
        .hint("rebalance", F.col(partition), F.col("_file"))
        .sortWithinPartitions(partition, "_file", *cluster_by)
        .drop("_file")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if keep_other_months else "static")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(partition)
        .parquet(path)
    )


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
