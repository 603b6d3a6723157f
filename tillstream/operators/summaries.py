"""The two daily summaries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_mean, exact_sum, money_parts
from ..schemas import ACCOUNT_KEYS, CHANNEL_CATEGORY_KEYS


def flag_count(name: str) -> Column:
    return F.sum(F.col(name).cast("int")).alias(name)


def group_aggregates() -> list[Column]:
    """Everything but the distinct counts; each of these can be merged (``operators.partials``)."""
    amount = F.col("amount")
    return [
        F.count("*").alias("total_transactions"),
        *money_parts(amount, "amount"),
        F.max(amount).alias("_max"),
        F.min(amount).alias("_min"),
        flag_count("is_high_value"),
        flag_count("is_failed"),
        flag_count("is_debit"),
    ]


def group_columns(parts: DataFrame) -> DataFrame:
    """The summary from its aggregates and ``unique_accounts``, ``unique_merchants``."""
    return parts.select(
        *CHANNEL_CATEGORY_KEYS,
        "total_transactions",
        exact_sum("amount").alias("total_amount"),
        exact_mean("amount").alias("avg_amount"),
        F.round("_max", 2).alias("max_amount"),
        F.round("_min", 2).alias("min_amount"),
        F.col("is_high_value").alias("high_value_count"),
        F.col("is_failed").alias("failed_count"),
        F.col("is_debit").alias("debit_count"),
        "unique_accounts",
        "unique_merchants",
    )


def channel_category_summary(df: DataFrame) -> DataFrame:
    """Totals per day, channel, category, status and bucket; NULL keys form groups.

    The two exact distinct counts are planned as one expanded aggregate whose
    first shuffle is keyed by group *and* distinct value, after a partial
    aggregate: neither a big group nor a hot account lands in one task.
    """
    parts = df.groupBy(*CHANNEL_CATEGORY_KEYS).agg(
        *group_aggregates(),
        F.count_distinct("account_id").alias("unique_accounts"),
        F.count_distinct("merchant_name").alias("unique_merchants"),
    )
    return group_columns(parts)


def order_in_day() -> Column:
    """Time, then partition, then offset of an event within its day, as one number.

    ``max_by`` over a struct would make Spark sort all rows for the aggregate; a
    number lets it hash them. The parts cannot overlap: a day has under 9.2e10
    microseconds, a topic under 1e8 partitions, and an offset is below 1e19.
    """
    day = F.unix_micros(F.col("transaction_date").cast("timestamp"))
    time = F.unix_micros("transaction_timestamp") - day
    partition = F.coalesce("_kafka_partition", F.lit(-1)) + 1
    offset = F.coalesce("_kafka_offset", F.lit(-1)) + 1
    high = time * 100_000_000 + partition
    return high.cast("decimal(19,0)") * F.lit(Decimal(10**19)) + offset.cast("decimal(19,0)")


def account_aggregates() -> list[Column]:
    """What an account's day is made of."""
    amount, balance = F.col("amount"), F.col("balance_after_transaction")
    return [
        F.count("*").alias("total_transactions"),
        *money_parts(amount, "amount"),
        *money_parts(F.when(F.col("is_failed"), amount), "failed"),
        flag_count("is_failed"),
        flag_count("is_high_value"),
        flag_count("is_debit"),
        F.min(balance).alias("_min"),
        F.max(balance).alias("_max"),
        F.max_by(balance, order_in_day()).alias("_latest"),
    ]


def account_columns(parts: DataFrame) -> DataFrame:
    """The summary from its aggregates."""
    return parts.select(
        *ACCOUNT_KEYS,
        "total_transactions",
        exact_sum("amount").alias("total_amount"),
        F.col("is_failed").alias("failed_count"),
        F.col("is_high_value").alias("high_value_count"),
        F.col("is_debit").alias("debit_count"),
        F.col("is_failed").alias("total_failed_amount"),
        F.coalesce(exact_sum("failed"), F.lit(0.0)).alias("failed_amount"),
        F.round("_min", 2).alias("min_balance"),
        F.round("_max", 2).alias("max_balance"),
        F.round("_latest", 2).alias("latest_balance"),
    )


def account_summary(df: DataFrame) -> DataFrame:
    """Totals and balances per day and account.

    ``total_failed_amount`` is a count, as its users know it; the sum that its
    name promises is ``failed_amount``. ``latest_balance`` is the balance of the
    last event by time, then partition, then offset.
    """
    return account_columns(df.groupBy(*ACCOUNT_KEYS).agg(*account_aggregates()))
