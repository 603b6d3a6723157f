"""Keyed helpers that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    Spark plans the ``= 1`` filter as a group limit before the shuffle, so every
    map task sends at most one row per key and a hot key costs no more than others.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedupe_transactions(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row per transaction: the earliest delivery. Run it on valid rows only,
    or an invalid copy may shadow a valid one."""
    order = [
        F.col(c)
        for c in (
            "_kafka_partition",
            "_kafka_offset",
            "_ingestion_timestamp",
            "transaction_timestamp",
        )
        if c in df.columns
    ]
    return keep_first(df, [key], order)


def not_seen_in(df: DataFrame, earlier: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys ``earlier`` does not hold (de-duplication across loads).

    Copies of a key in ``earlier`` are folded map-side; the shuffle that folds the
    rest also serves the join.
    """
    keys = keys or ("transaction_id",)
    return df.join(earlier.select(*keys).distinct(), list(keys), "left_anti")


def hot_keys(df: DataFrame, key: str, min_rows: int) -> list[Row]:
    """Keys with more than ``min_rows`` rows, as ``(key, count)``, largest first.

    Counts are combined map-side. There are fewer such keys than rows / ``min_rows``,
    which bounds the list that comes to the driver.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    found = counts.filter(F.col("n") > min_rows).collect()
    return sorted(found, key=lambda r: (-r["n"], str(r[key])))


def split_hot(df: DataFrame, key: str, hot: list[Row]) -> tuple[DataFrame, DataFrame]:
    """(rows of hot keys, all other rows); NULL is a key like any other."""
    keys = (
        df.sparkSession.createDataFrame([(r[key],) for r in hot], df.select(key).schema)
        .withColumnRenamed(key, "_hot_key")
    )
    same = df[key].eqNullSafe(F.col("_hot_key"))
    return (
        df.join(F.broadcast(keys), same, "left_semi"),
        df.join(F.broadcast(keys), same, "left_anti"),
    )
