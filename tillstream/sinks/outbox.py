"""Output of micro-batches: a folder per stream and batch, replaced when it is replayed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.files import exists

KEYS = T.StructType(
    [T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())]
)


def query_id(spark: SparkSession) -> str:
    """The id of the stream whose micro-batch this thread handles, ``batch`` outside one.

    It stays the same over restarts from one checkpoint, and another checkpoint has another.
    """
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def batch_path(spark: SparkSession, path: str, batch_id: int) -> str:
    return f"{path}/query_id={query_id(spark)}/batch_id={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(batch_path(df.sparkSession, path, batch_id))


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches so far, with ``query_id`` and ``batch_id``; empty before the first."""
    full = T.StructType([*schema.fields, *KEYS.fields])
    if not exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)
