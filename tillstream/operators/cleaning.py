"""Raw → processed: types, derived columns, validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_double, as_int, as_long, as_timestamp
from ..settings import Rules

# A row without any of these is dropped; every other column may be NULL.
REQUIRED = (
    "transaction_id",
    "account_id",
    "amount",
    "transaction_status",
    "transaction_timestamp",
)

CASTS = {
    "amount": as_double,
    "balance_after_transaction": as_double,
    "transaction_timestamp": as_timestamp,
    "_ingestion_timestamp": as_timestamp,
    "_kafka_offset": as_long,
    "_kafka_partition": as_int,
}


def typed(df: DataFrame) -> DataFrame:
    """Cast the columns that have a canonical type; bad values become NULL."""
    return df.withColumns({n: cast(df, n) for n, cast in CASTS.items() if n in df.columns})


def valid_only(df: DataFrame, required=REQUIRED) -> DataFrame:
    """Keep rows whose required columns are neither NULL nor NaN.

    Spelled out rather than ``dropna``, whose one opaque predicate is not pushed
    into a Parquet scan.
    """
    for name in required:
        df = df.filter(F.col(name).isNotNull())
        if df.schema[name].dataType.typeName() in ("double", "float"):
            df = df.filter(~F.isnan(name))
    return df


def is_valid(df: DataFrame, required=REQUIRED) -> Column:
    """What ``valid_only`` keeps, as a condition that is never NULL."""
    valid = F.lit(True)
    for name in required:
        valid = valid & F.col(name).isNotNull()
        if df.schema[name].dataType.typeName() in ("double", "float"):
            valid = valid & ~F.isnan(F.coalesce(name, F.lit(0.0)))
    return valid


def is_true(condition: Column) -> Column:
    """NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def amount_bucket(amount: Column, rules: Rules) -> Column:
    bucket = F
    for edge, name in zip(rules.bucket_edges, rules.bucket_names):
        bucket = bucket.when(amount < edge, name)
    return bucket.otherwise(rules.bucket_names[-1])


def derived(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Calendar parts, flags and the amount bucket."""
    ts, amount = F.col("transaction_timestamp"), F.col("amount")
    return df.withColumns(
        {
            "transaction_date": F.to_date(ts),
            "transaction_hour": F.hour(ts),
            "transaction_day_of_week": F.dayofweek(ts),
            "is_high_value": is_true(amount > rules.high_value),
            "is_failed": is_true(F.col("transaction_status") == rules.failed),
            "is_debit": is_true(F.col("transaction_type") == rules.debit),
            "amount_bucket": amount_bucket(amount, rules),
        }
    )


def processed(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Typed, valid and enriched rows, not yet de-duplicated."""
    return df.transform(typed).transform(valid_only).transform(derived, rules)
