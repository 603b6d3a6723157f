"""Explicit schemas of every layer, so that no job ever infers one."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# fixed values: the fields of one transaction message
EVENT_FIELDS = (
    "transaction_id",
    "account_id",
    "transaction_type",
    "amount",
    "currency",
    "balance_after_transaction",
    "transaction_timestamp",
    "channel",
    "merchant_name",
    "merchant_category",
    "counterparty_account",
    "counterparty_bank",
    "reference_number",
    "transaction_status",
    "branch_id",
)

# fixed values: what ingest adds to each message
INGEST_FIELDS = ("_ingestion_timestamp", "_kafka_offset", "_kafka_partition")


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Numbers and times arrive as text and are cast later with ``try_cast``: a number
# written as a string, or a word where a number belongs, must cost one value,
# never the whole record.
EVENT = _strings(EVENT_FIELDS)

# ``_extra`` holds, as JSON text, message fields the schema does not name.
# ``_bad_value`` holds a message that is not a JSON object.
RAW = T.StructType(
    [
        *EVENT.fields,
        *_strings(INGEST_FIELDS).fields,
        T.StructField("_extra", T.StringType()),
        T.StructField("_bad_value", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

MASTER_FIELDS = ("account_id", "user_name", "user_email")

PROCESSED = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("balance_after_transaction", T.DoubleType()),
        T.StructField("transaction_timestamp", T.TimestampType()),
        T.StructField("channel", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("counterparty_account", T.StringType()),
        T.StructField("counterparty_bank", T.StringType()),
        T.StructField("reference_number", T.StringType()),
        T.StructField("transaction_status", T.StringType()),
        T.StructField("branch_id", T.StringType()),
        T.StructField("_ingestion_timestamp", T.TimestampType()),
        T.StructField("_kafka_offset", T.LongType()),
        T.StructField("_kafka_partition", T.IntegerType()),
        T.StructField("_extra", T.StringType()),
        T.StructField("transaction_hour", T.IntegerType()),
        T.StructField("transaction_day_of_week", T.IntegerType()),
        T.StructField("is_high_value", T.BooleanType()),
        T.StructField("is_failed", T.BooleanType()),
        T.StructField("is_debit", T.BooleanType()),
        T.StructField("amount_bucket", T.StringType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("load_id", T.StringType()),
    ]
)

CHANNEL_CATEGORY_KEYS = (
    "transaction_date",
    "channel",
    "merchant_category",
    "transaction_status",
    "amount_bucket",
)

CHANNEL_CATEGORY_SUMMARY = T.StructType(
    [
        T.StructField("channel", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("transaction_status", T.StringType()),
        T.StructField("amount_bucket", T.StringType()),
        T.StructField("total_transactions", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("avg_amount", T.DoubleType()),
        T.StructField("max_amount", T.DoubleType()),
        T.StructField("min_amount", T.DoubleType()),
        T.StructField("high_value_count", T.LongType()),
        T.StructField("failed_count", T.LongType()),
        T.StructField("debit_count", T.LongType()),
        T.StructField("unique_accounts", T.LongType()),
        T.StructField("unique_merchants", T.LongType()),
        T.StructField("transaction_date", T.DateType()),
    ]
)

ACCOUNT_KEYS = ("transaction_date", "account_id")

ACCOUNT_SUMMARY = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("total_transactions", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("failed_count", T.LongType()),
        T.StructField("high_value_count", T.LongType()),
        T.StructField("debit_count", T.LongType()),
        T.StructField("total_failed_amount", T.LongType()),
        T.StructField("failed_amount", T.DoubleType()),
        T.StructField("min_balance", T.DoubleType()),
        T.StructField("max_balance", T.DoubleType()),
        T.StructField("latest_balance", T.DoubleType()),
        T.StructField("transaction_date", T.DateType()),
    ]
)


def _typed(**kinds: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name, kind in kinds.items()]


def _money(*names: str) -> list[T.StructField]:
    """The columns of ``functions.money_parts``."""
    return [
        field
        for n in names
        for field in _typed(
            **{f"_{n}_cents": T.LongType(), f"_{n}_exact": T.LongType(), f"_{n}_sum": T.DoubleType(), f"_{n}_n": T.LongType()}
        )
    ]


_GROUP_KEYS = _strings(CHANNEL_CATEGORY_KEYS[1:]).fields
_OF_A_LOAD = _typed(transaction_date=T.DateType(), load_id=T.StringType())
_FLAGS = _typed(is_high_value=T.LongType(), is_failed=T.LongType(), is_debit=T.LongType())

# What each load adds to the summaries of its days; see ``operators.partials``.
GROUP_PARTIALS = T.StructType(
    [
        *_GROUP_KEYS,
        *_typed(total_transactions=T.LongType()),
        *_money("amount"),
        *_typed(_max=T.DoubleType(), _min=T.DoubleType()),
        *_FLAGS,
        *_OF_A_LOAD,
    ]
)
ACCOUNT_PARTIALS = T.StructType(
    [
        *_typed(account_id=T.StringType(), total_transactions=T.LongType()),
        *_money("amount", "failed"),
        *_FLAGS,
        *_typed(_min=T.DoubleType(), _max=T.DoubleType(), _latest=T.DoubleType(), _latest_order=T.DecimalType(38, 0)),
        *_OF_A_LOAD,
    ]
)
# Bits of the numbers that a group's accounts or merchants have; see ``sources.numbers``.
MEMBER_PARTIALS = T.StructType(
    [
        *_GROUP_KEYS,
        *_typed(member=T.StringType(), part=T.IntegerType(), bucket=T.LongType(), bits=T.BinaryType()),
        *_OF_A_LOAD,
    ]
)

# Transaction ids that were loaded, by a hash of them.
LOADED_IDS = T.StructType(
    _typed(transaction_id=T.StringType(), bucket=T.IntegerType(), load_id=T.StringType())
)

LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("load", T.LongType()),
    ]
)

MARK = T.StructType(
    [
        T.StructField("last_processed_timestamp", T.StringType()),
        T.StructField("last_run_utc", T.StringType()),
    ]
)
