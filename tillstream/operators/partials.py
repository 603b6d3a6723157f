"""Summaries in parts: what one load adds to its days, and the days from all their parts.

Counts, cents, smallest and largest values add up or compare; the latest balance keeps its
place in the day. The exact distinct counts are bitmaps: each account or merchant has a
number for good (``sources.numbers``), a load sets the bits of those it holds, and the bits
of all loads are united before they are counted. So a day is rebuilt from a few rows of each
of its loads, none of which is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ACCOUNT_KEYS, ACCOUNT_PARTIALS, CHANNEL_CATEGORY_KEYS, GROUP_PARTIALS
from .summaries import account_aggregates, account_columns, group_aggregates, group_columns, order_in_day

# Columns whose distinct values a summary counts.
MEMBERS = {"account_id": "unique_accounts", "merchant_name": "unique_merchants"}


def _kept_exact(parts: DataFrame, *money: str) -> DataFrame:
    """A load whose cents did not fit has no exact sum, and no day that it is part of has one."""
    return parts.withColumns(
        {f"_{m}_exact": F.when(F.col(f"_{m}_cents").isNotNull(), F.col(f"_{m}_exact")).otherwise(0) for m in money}
    )


def group_partials(df: DataFrame) -> DataFrame:
    """A load's rows → its part of each channel and category group."""
    return _kept_exact(df.groupBy(*CHANNEL_CATEGORY_KEYS).agg(*group_aggregates()), "amount")


def account_partials(df: DataFrame) -> DataFrame:
    """A load's rows → its part of each account's day."""
    parts = df.groupBy(*ACCOUNT_KEYS).agg(*account_aggregates(), F.max(order_in_day()).alias("_latest_order"))
    return _kept_exact(parts, "amount", "failed")


def member_values(df: DataFrame, member: str) -> DataFrame:
    """The distinct values of ``member`` in each group, NULL not being one."""
    values = df.select(*CHANNEL_CATEGORY_KEYS, F.col(member).alias("value"))
    return values.filter("value is not null").distinct()


def member_bits(values: DataFrame, member: str) -> DataFrame:
    """``member_values`` with their numbers (``part``, ``number``) → bitmaps of them."""
    bucket, bit = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    rows = values.select(*CHANNEL_CATEGORY_KEYS, "part", bucket.alias("bucket"), bit.alias("bit"))
    bits = rows.groupBy(*CHANNEL_CATEGORY_KEYS, "part", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    return bits.withColumn("member", F.lit(member))


def _united(name: str) -> Column:
    """How a column of several parts becomes one."""
    if name in ("_max", "_latest_order"):
        return F.max(name)
    if name == "_min":
        return F.min(name)
    if name == "_latest":
        return F.max_by(name, "_latest_order")
    return F.try_sum(name) if name.endswith("_cents") else F.sum(name)


def _merged(parts: DataFrame, keys: tuple[str, ...], schema) -> DataFrame:
    names = [n for n in schema.fieldNames() if n not in (*keys, "load_id")]
    return parts.groupBy(*keys).agg(*[_united(n).alias(n) for n in names])


def merged_groups(groups: DataFrame, members: DataFrame) -> DataFrame:
    """The channel and category summary from all parts of its days.

    Bitmaps are united per group, member and bucket of 32,768 numbers, so a task holds one
    bitmap at a time; their counts meet the groups in one more aggregate, which also matches
    NULL keys.
    """
    keys = CHANNEL_CATEGORY_KEYS
    bits = members.groupBy(*keys, "member", "part", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    counted = bits.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("member") == m, F.col("n"))).alias(out) for m, out in MEMBERS.items()]
    )
    sums = _merged(groups, keys, GROUP_PARTIALS)
    both = sums.unionByName(counted, allowMissingColumns=True)
    names = [n for n in both.columns if n not in keys]
    whole = both.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])
    return group_columns(whole.fillna(0, list(MEMBERS.values())))


def merged_accounts(parts: DataFrame) -> DataFrame:
    """The account summary from all parts of its days."""
    return account_columns(_merged(parts, ACCOUNT_KEYS, ACCOUNT_PARTIALS))
