"""Ids of all transactions ever loaded, so that a load finds repeats without reading the table.

The ids are a table of loads beside the processed layer (``<processed>_ids``), with a
directory for each of a fixed number of buckets of their hash. A load reads the buckets its
own ids fall into. Files are sorted by id and have Bloom filters, so with few new ids Spark
skips row groups that hold none of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LOADED_IDS
from ..sinks.zones import write_load
from .files import drop_path, exists, write_text
from .live import read_loads
from .zones import read_processed

KEY = "transaction_id"
BUCKETS = 64
# So many new ids at most are looked for by name, which Parquet's filters can use.
FEW_IDS = 1_000
# So many new ids at most are sent to all tasks; more are matched by a shuffle.
BROADCAST_IDS = 2_000_000
OPTIONS = {f"parquet.bloom.filter.enabled#{KEY}": "true", "parquet.bloom.filter.max.bytes": str(1 << 20)}


def ids_path(processed_path: str) -> str:
    return f"{processed_path}_ids"


def bucket_of(key: str = KEY) -> Column:
    """The bucket of an id. The number of buckets is that of the table for good."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")


def kept_ids(spark: SparkSession, processed_path: str) -> bool:
    """Whether the table's ids are kept; from the first load that asks for it every load adds its own."""
    return exists(spark, f"{ids_path(processed_path)}/_complete")


def keep_ids(spark: SparkSession, processed_path: str) -> None:
    """Begin to keep ids: write those of all loads so far, once."""
    path = ids_path(processed_path)
    if kept_ids(spark, processed_path):
        return
    drop_path(spark, path)
    rows = read_processed(spark, processed_path)
    if rows is not None:
        ids = rows.select(KEY, bucket_of(), "load_id").hint("rebalance", "bucket", "load_id")
        ids = ids.sortWithinPartitions("bucket", "load_id", KEY)
        ids.write.options(**OPTIONS).partitionBy("bucket", "load_id").parquet(path)
    write_text(spark, f"{path}/_complete", "")


def write_ids(rows: DataFrame, processed_path: str, load_id: str, again: bool | None = None) -> None:
    """Add the ids of a load's written rows."""
    write_load(
        rows.select(KEY, bucket_of()), ids_path(processed_path), LOADED_IDS, "bucket", load_id, again, (KEY,), **OPTIONS
    )


def read_ids(spark: SparkSession, processed_path: str, buckets: list[int]) -> DataFrame | None:
    """``transaction_id`` and ``load_id`` of these buckets; no others are listed or opened."""
    return read_loads(spark, ids_path(processed_path), LOADED_IDS, "bucket", [str(b) for b in buckets])


def loaded_before(rows: DataFrame, processed_path: str, load_id: str) -> DataFrame | None:
    """The ids of ``rows`` that other loads hold; None where none can.

    ``rows`` is read three times at most. All that is shuffled are its own ids: the table's are
    filtered where they are read, by name, by a broadcast of the new ids, or, where these
    are too many for that, both sides meet by a shuffle.
    """
    spark = rows.sparkSession
    own = rows.select(KEY, bucket_of()).filter(f"{KEY} is not null")
    counts = own.groupBy("bucket").count().collect()  # at most one row a bucket
    seen = read_ids(spark, processed_path, sorted(r.bucket for r in counts))
    if seen is None:
        return None
    seen = seen.filter(F.col("load_id") != load_id).select(KEY)
    n = sum(r["count"] for r in counts)
    if n <= FEW_IDS:
        return seen.filter(F.col(KEY).isin([r[0] for r in own.select(KEY).collect()]))
    own = own.select(KEY)
    return seen.join(F.broadcast(own) if n <= BROADCAST_IDS else own, KEY, "left_semi")
