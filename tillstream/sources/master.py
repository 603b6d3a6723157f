"""The account master: CSV with a header; the last row of an account wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import keep_first
from ..schemas import MASTER_FIELDS


def latest_per_account(rows: DataFrame, order: list[Column]) -> DataFrame:
    """One row per account: the last in ``order`` (given ascending)."""
    last_first = [c.desc_nulls_last() for c in order]
    return keep_first(rows, ["account_id"], last_first).select(*MASTER_FIELDS)


def _by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of the master, grouped by their header line; as many as there are files."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
    )
    first = lines.filter(F.trim("value") != "").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    layouts: dict[str, list[str]] = {}
    for row in first.collect():
        layouts.setdefault(row.header.strip("\r\ufeff"), []).append(row.file)
    return list(layouts.values())


def read_master(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Columns are found by header name, whatever their order, in each file; others are
    ignored. A file without one of them raises.

    "Last" means later file (by modification time, then name), then further down
    the file. A block's rows are read in order, so the running id orders them.
    ``multiline`` allows line breaks inside quotes; then a file is read by one task.
    """
    frames = []
    for files in _by_header(spark, path):
        reader = spark.read.option("header", "true").option("escape", '"')
        frames.append(
            reader.option("multiLine", str(multiline).lower())
            .csv(files)
            .select(
                *MASTER_FIELDS,
                F.col("_metadata.file_modification_time").alias("_file_time"),
                F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("_block"),
                F.monotonically_increasing_id().alias("_row"),
            )
        )
    if not frames:
        empty = T.StructType([T.StructField(n, T.StringType()) for n in MASTER_FIELDS])
        return spark.createDataFrame([], empty)
    rows = reduce(DataFrame.unionByName, frames)
    order = [F.col(c) for c in ("_file_time", "_file", "_block", "_row")]
    return latest_per_account(rows, order)


def save_master(master: DataFrame, table: str, buckets: int) -> None:
    """Keep a large master as a table bucketed by account, in place of an older one.

    Lookups then shuffle events only. Give as many buckets as the session has shuffle partitions
    or more: Spark prefers the side with more partitions.
    """
    (
        master.select(*MASTER_FIELDS)
        .repartition(buckets, "account_id")  # one file a bucket
        .write.mode("overwrite")
        .bucketBy(buckets, "account_id")
        .sortBy("account_id")
        .saveAsTable(table)
    )
