"""SQL access to the curated layer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..schemas import ACCOUNT_SUMMARY, CHANNEL_CATEGORY_SUMMARY

CURATED: dict[str, T.StructType] = {
    "channel_category_summary": CHANNEL_CATEGORY_SUMMARY,
    "account_summary": ACCOUNT_SUMMARY,
}


def register_views(spark: SparkSession, curated_path: str, prefix: str = "") -> list[str]:
    """Temporary views; they see the days that exist when they are registered."""
    names = []
    for table, schema in CURATED.items():
        name = prefix + table
        spark.read.schema(schema).parquet(f"{curated_path}/{table}").createOrReplaceTempView(name)
        names.append(name)
    return names


def register_tables(
    spark: SparkSession,
    curated_path: str,
    database: str = "default",
    days: Sequence[date] | None = None,
) -> list[str]:
    """External partitioned tables. Call it again to pick up new ``days``; without them
    the whole layer is listed."""
    names = []
    for table, schema in CURATED.items():
        name = f"`{database}`.`{table}`"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        location = f"{curated_path}/{table}".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"PARTITIONED BY (transaction_date) LOCATION '{location}'"
        )
        if days is None:
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        elif days:
            parts = " ".join(f"PARTITION (transaction_date = DATE'{d}')" for d in sorted(days))
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        names.append(name)
    return names
