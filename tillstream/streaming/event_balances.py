"""Transactions → each event with its account's balance after it, as a stream.

A micro-batch is summed like a batch (``running_balance``, so an account with very many
events is cut into slices) on top of what its accounts had before. These balances are kept as
a table by micro-batch: what a micro-batch changed, and every so often all of them. The one of
micro-batch n is made from those before n, so a micro-batch that runs again gives the same.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.balances import SPLIT_ROWS, running_balance, signed_cents
from ..operators.cleaning import valid_only
from ..operators.keys import keep_first
from ..settings import Rules
from ..sinks.outbox import batch_path, write_batch
from ..sources.files import drop_path, exists
from .balances import MOVING
from .start import start

# Every so many micro-batches all balances are written, and older ones dropped.
SNAPSHOT_EVERY = 50
BROADCAST_ACCOUNTS = 1_000_000
CARRIED = T.StructType([T.StructField("account_id", T.StringType()), T.StructField("_carried", T.LongType())])


def _before(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """What each account had moved, in cents, before micro-batch ``batch_id`` of this stream."""
    first = max(0, (batch_id - 1) // SNAPSHOT_EVERY * SNAPSHOT_EVERY)
    paths = [batch_path(spark, path, b) for b in range(first, batch_id)]
    paths = [p for p in paths if exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], CARRIED)
    base = batch_path(spark, path, 0).rsplit("/", 1)[0]
    rows = spark.read.schema(T.StructType([*CARRIED.fields, T.StructField("batch_id", T.LongType())]))
    rows = rows.option("basePath", base).parquet(*paths)
    return keep_first(rows, ["account_id"], [F.desc("batch_id")]).drop("batch_id")


def _with_carried(rows: DataFrame, own: DataFrame) -> DataFrame:
    """``own`` has a row an account; few are broadcast, else accounts are shuffled and AQE
    splits those that are skewed."""
    few = own.limit(BROADCAST_ACCOUNTS + 1).count() <= BROADCAST_ACCOUNTS
    return rows.join(F.broadcast(own) if few else own, "account_id", "left")


def event_balances(
    events: DataFrame,
    opening: Column,
    path: str,
    checkpoint: str,
    order: tuple[str, ...] = ("transaction_timestamp", "_kafka_partition", "_kafka_offset"),
    every: str | None = None,
    rules: Rules = Rules(),
    split_rows: int = SPLIT_ROWS,
) -> StreamingQuery:
    """Write each event of a micro-batch with ``balance_after_transaction`` to ``<path>/events``.

    Events of one micro-batch are taken in ``order``, which must be unique within an account;
    those of a later one come after them, whatever their time. So it equals ``running_balance``
    over all events where they arrive in order. ``opening`` is in cents and may use the account
    only. Events that can move no balance (no id, account, amount or status) are dropped.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = valid_only(batch, MOVING).persist(StorageLevel.DISK_ONLY)
        before = _before(spark, f"{path}/state", batch_id).persist(StorageLevel.DISK_ONLY)
        try:
            moved = batch.groupBy("account_id").agg(F.sum(signed_cents(rules)).alias("_moved"))
            after = moved.join(before, "account_id", "left").select(
                "account_id", (F.coalesce("_carried", F.lit(0)) + F.col("_moved")).alias("_carried")
            )
            if batch_id % SNAPSHOT_EVERY == 0:
                after = after.unionByName(before.join(moved, "account_id", "left_anti"))
            write_batch(after, f"{path}/state", batch_id)
            # Only accounts of this micro-batch; each has one row, so a hot one is no more.
            own = before.join(moved, "account_id", "left_semi")
            rows = running_balance(batch, F.lit(0).cast("bigint"), order, rules, split_rows, "_in_batch")
            cents = F.rint(F.col("_in_batch") * 100).cast("bigint")
            total = (opening + F.coalesce("_carried", F.lit(0)) + cents).cast("double") / 100
            rows = _with_carried(rows, own).withColumn("balance_after_transaction", total)
            write_batch(rows.drop("_in_batch", "_carried"), f"{path}/events", batch_id)
        finally:
            batch.unpersist()
            before.unpersist()
        if batch_id % SNAPSHOT_EVERY == 1 and batch_id > SNAPSHOT_EVERY:
            for old in range(batch_id - 1 - SNAPSHOT_EVERY, batch_id - 1):
                drop_path(spark, batch_path(spark, f"{path}/state", old))

    return start(events.writeStream.foreachBatch(write), checkpoint, every)
