"""Transactions → current balance per account, kept as stream state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.balances import current_balance
from ..operators.cleaning import valid_only
from ..operators.keys import keep_first
from ..settings import Rules
from ..sinks.outbox import read_batches, write_batch
from ..sources.files import drop_path, exists, found_paths
from .start import start

BALANCE = T.StructType(
    [T.StructField("account_id", T.StringType()), T.StructField("balance", T.DoubleType())]
)
SNAPSHOT = T.StructType([*BALANCE.fields, T.StructField("as_of", T.TimestampType())])
SNAPSHOTS = "snapshot"

# An event without any of these moves no balance.
MOVING = ("transaction_id", "account_id", "amount", "transaction_status")


def balances(
    events: DataFrame,
    opening: Column,
    path: str | None,
    checkpoint: str,
    every: str | None = None,
    rules: Rules = Rules(),
    unique_within: str | None = None,
) -> StreamingQuery:
    """Write, per micro-batch, the new balance of every account it touched; without ``path``
    only keep them as state, for ``balances_in_state``.

    Each delivery counts. With ``unique_within``, such as "2 hours", a transaction that is
    delivered again within that time counts once; its id is kept as state so long.
    """
    events = valid_only(events, MOVING)
    if unique_within:
        events = events.withWatermark("transaction_timestamp", unique_within)
        events = events.dropDuplicatesWithinWatermark(["transaction_id"])
    writer = current_balance(events, opening, rules).writeStream.outputMode("update")
    if path is None:
        writer = writer.format("noop")
    else:
        writer = writer.foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
    return start(writer, checkpoint, every)


def _updates(spark: SparkSession, path: str) -> DataFrame:
    """All updates with the time each was written, which a snapshot keeps."""
    rows = read_batches(spark, path, SNAPSHOT)
    if not exists(spark, path):
        return rows
    written = F.coalesce("as_of", F.col("_metadata.file_modification_time"))
    return rows.withColumn("as_of", written)


def read_balances(spark: SparkSession, path: str) -> DataFrame:
    """The latest balance of every account: the one written last, by the later batch."""
    latest = [F.desc("as_of"), F.desc("batch_id")]
    return keep_first(_updates(spark, path), ["account_id"], latest).select(*BALANCE.fieldNames())


def compact_balances(spark: SparkSession, path: str) -> None:
    """Replace updates so far by one row per account.

    Each stream's last batch stays, as the stream may still replay it. A batch that is
    written meanwhile is neither read nor dropped.
    """
    if not exists(spark, path):
        return
    updates = _updates(spark, path)
    # As many rows as there are streams.
    last = {r.query_id: r.last for r in updates.groupBy("query_id").agg(F.max("batch_id").alias("last")).collect()}
    latest = keep_first(updates, ["account_id"], [F.desc("as_of"), F.desc("batch_id")])
    number = last.get(SNAPSHOTS, -1) + 1
    latest.drop("query_id", "batch_id").write.parquet(f"{path}/query_id={SNAPSHOTS}/batch_id={number}")
    for folder in found_paths(spark, f"{path}/query_id=*/batch_id=*"):
        query, batch = (part.split("=", 1)[1] for part in folder.rsplit("/", 2)[1:])
        if int(batch) < last.get(query, -1) + (query == SNAPSHOTS):
            drop_path(spark, folder)


def balances_in_state(spark: SparkSession, checkpoint: str, opening: Column) -> DataFrame:
    """The balance of every account from the stream's own state, which has one row for each.

    No update that was written is read, so ``balances`` need not write any. It is the state
    as of the last micro-batch that was committed.
    """
    operators = spark.read.format("state-metadata").load(checkpoint)
    # The other state, where there is one, holds ids.
    sums = operators.filter("operatorName = 'stateStoreSave'").select("operatorId").first()[0]
    state = spark.read.format("statestore").option("operatorId", sums).load(checkpoint)
    (moved,) = state.schema["value"].dataType.fieldNames()
    rows = state.select(F.col("key.account_id").alias("account_id"), F.col(f"value.`{moved}`").alias("_moved"))
    return rows.select("account_id", ((opening + F.col("_moved")).cast("double") / 100).alias("balance"))
