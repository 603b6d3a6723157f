"""Running balance per account."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import cents
from ..session import scratch
from ..settings import Rules
from .keys import hot_keys, split_hot

SPLIT_ROWS = 5_000_000
# Slices are cut by tasks of at least about so many rows.
RANGE_ROWS = 50_000


def signed_cents(rules: Rules = Rules()) -> Column:
    """What an event does to its account: −amount for a debit, +amount otherwise,
    nothing unless it succeeded."""
    move = cents(F.col("amount"))
    sign = F.when(F.col("transaction_type") == rules.debit, -1).otherwise(1)
    done = F.col("transaction_status") == rules.success
    return F.when(done, F.coalesce(move, F.lit(0)) * sign).otherwise(F.lit(0).cast("bigint"))


def current_balance(df: DataFrame, opening: Column, rules: Rules = Rules()) -> DataFrame:
    """Balance per account after all its events; works on a stream (update mode).

    ``opening`` is in cents and may use the account only.
    """
    moved = df.groupBy("account_id").agg(F.sum(signed_cents(rules)).alias("_moved"))
    return moved.select(
        "account_id", ((opening + F.col("_moved")).cast("double") / 100).alias("balance")
    )


def running_balance(
    df: DataFrame,
    opening: Column,
    order: tuple[str, ...] = ("transaction_timestamp", "_kafka_partition", "_kafka_offset"),
    rules: Rules = Rules(),
    split_rows: int = SPLIT_ROWS,
    out: str = "balance_after_transaction",
) -> DataFrame:
    """Add each event's balance after it: opening cents + all moves up to the event.

    An account with up to ``split_rows`` events is summed in one window. A longer
    one is cut into consecutive slices of at most as many that are summed apart, and each
    slice adds the total of those before it. ``order`` must be unique within an account.
    """
    key = "account_id"
    df = df.withColumn("_moved", signed_cents(rules))
    hot = hot_keys(df, key, split_rows)
    if not hot:
        summed = _in_one_window(df, key, order)
    else:
        long, short = split_hot(df, key, hot)
        rows = sum(r["n"] for r in hot)
        summed = _in_one_window(short, key, order).unionByName(
            _in_slices(long, key, order, rows, split_rows)
        )
    balance = (opening + F.col("_sum")).cast("double") / 100
    return summed.withColumn(out, balance).drop("_moved", "_sum")


def _in_one_window(df: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    so_far = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("_sum", F.sum("_moved").over(so_far))


def _in_slices(df: DataFrame, key: str, order: tuple[str, ...], rows: int, split_rows: int) -> DataFrame:
    # Slices are runs of rows of a sorted range partition, which is a task and a file and so
    # holds many small slices. They are written out because their number is read
    # twice below and must be the same both times, also after a lost executor.
    path = scratch(df.sparkSession, "balance-slices")
    ranges = math.ceil(rows / max(split_rows, RANGE_ROWS))
    # The partition's number above 33 bits, the row's in it below.
    place = F.monotonically_increasing_id()
    row = place.bitwiseAND((1 << 33) - 1)
    (
        df.repartitionByRange(ranges, key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn("_slice", place - row + F.floor(row / split_rows))
        .write.parquet(path)
    )
    cut = df.sparkSession.read.parquet(path)

    within = W.partitionBy(key, "_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    # One row per slice an account continues into: fewer than there are slices.
    carry = (
        cut.groupBy(key, "_slice")
        .agg(F.sum("_moved").alias("_total"))
        .withColumn("_carry", F.sum("_total").over(before))
        .filter(F.col("_carry").isNotNull())
        .select(F.col(key).alias("_k"), F.col("_slice").alias("_s"), "_carry")
    )
    same = F.col(key).eqNullSafe(F.col("_k")) & (F.col("_slice") == F.col("_s"))
    return (
        cut.withColumn("_sum", F.sum("_moved").over(within))
        .join(F.broadcast(carry), same, "left")
        .withColumn("_sum", F.col("_sum") + F.coalesce("_carry", F.lit(0)))
        .drop("_slice", "_k", "_s", "_carry")
    )
