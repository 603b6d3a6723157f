"""Driver tables → canonical transactions and account master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators.balances import running_balance
from tillstream.schemas import MASTER_FIELDS
from tillstream.session import use_utc

# fixed values: domains of the transaction fields
CHANNELS = ("UPI", "ATM", "CARD", "NEFT", "RTGS", "IMPS")
CATEGORIES = (
    "GROCERY",
    "RESTAURANT",
    "FUEL",
    "TRAVEL",
    "ECOMMERCE",
    "ENTERTAINMENT",
    "UTILITIES",
)
BANKS = ("HDFC", "ICICI", "SBI", "AXIS", "KOTAK")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def pick(words: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (index % len(words) + 1).cast("int"))


def account_id(number: Column) -> Column:
    return F.concat(F.lit("AC"), (number + 100000).cast("string"))


def opening_cents(account: Column) -> Column:
    number = F.substring(account, 3, 20).cast("bigint") - 100000
    return 500000 + number * 791900 % 9500100


def transactions_of(events: DataFrame) -> DataFrame:
    """Events as transactions, without a balance; row by row, so also on a stream."""
    n = F.col("event_id")
    amount_cents = F.floor(F.col("value") * 7300)
    return events.select(
        n.cast("string").alias("transaction_id"),
        account_id(F.col("user_id")).alias("account_id"),
        F.when(n % 3 == 0, "CREDIT").otherwise("DEBIT").alias("transaction_type"),
        (amount_cents.cast("double") / 100).alias("amount"),
        F.lit("INR").alias("currency"),
        F.col("ts").cast("timestamp").alias("transaction_timestamp"),
        pick(CHANNELS, n).alias("channel"),
        F.concat(F.lit("M"), F.get_json_object("props", "$.k")).alias("merchant_name"),
        pick(CATEGORIES, n).alias("merchant_category"),
        account_id(n % 900000).alias("counterparty_account"),
        pick(BANKS, n).alias("counterparty_bank"),
        F.lpad(n.cast("string"), 12, "0").alias("reference_number"),
        F.when(n % 5 == 0, "FAILED").otherwise("SUCCESS").alias("transaction_status"),
        F.concat(F.lit("BR"), (n % 900 + 100).cast("string")).alias("branch_id"),
        n.alias("_kafka_offset"),
        F.lit(0).alias("_kafka_partition"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as transactions, without a balance."""
    return transactions_of(table(spark, sf_dir, "events"))


# Transaction ids are numbers written as text; this orders them as numbers.
EVENT_ORDER = ("transaction_timestamp", "_kafka_offset")


def transactions_with_balance(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """All events as transactions, each with its account's balance after it."""
    return running_balance(
        transactions(spark, sf_dir),
        opening_cents(F.col("account_id")),
        order=EVENT_ORDER,
        **options,
    )


def master_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a master row, with its number."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        account_id(key).alias("account_id"),
        F.col("c_name").alias("user_name"),
        F.concat(key.cast("string"), F.lit("@example.com")).alias("user_email"),
        key.alias("number"),
    )


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account master: four of five customers."""
    return master_rows(spark, sf_dir).filter("number % 5 <> 4").select(*MASTER_FIELDS)
