"""Curated days from the parts that each load left, so a rebuild costs what is new.

Beside the processed layer, each load writes what it adds to the summaries of its days. A
day that gets rows again is rebuilt from these parts; the rows of its earlier loads are not
read. Parts are tables of loads, so a load that runs again replaces its part, and days with
many loads can have theirs merged into few files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.partials import (
    MEMBERS,
    account_partials,
    group_partials,
    member_bits,
    member_values,
    merged_accounts,
    merged_groups,
)
from ..schemas import ACCOUNT_PARTIALS, GROUP_PARTIALS, MEMBER_PARTIALS
from ..session import together
from ..sinks.zones import write_load
from ..sources.live import merge_loads, read_loads
from ..sources.numbers import numbered

DAY = "transaction_date"
TABLES: dict[str, T.StructType] = {
    "groups": GROUP_PARTIALS,
    "accounts": ACCOUNT_PARTIALS,
    "members": MEMBER_PARTIALS,
}


def write_partials(rows: DataFrame, path: str, load_id: str, again: bool | None = None) -> None:
    """Write what ``rows``, all rows of load ``load_id``, add to the summaries of their days."""

    def bits(member: str) -> DataFrame:
        values = member_values(rows, member)
        return member_bits(values.join(numbered(values, f"{path}/numbers/{member}"), "value"), member)

    def put(name: str, parts: Callable[[], DataFrame]) -> None:
        write_load(parts(), f"{path}/{name}", TABLES[name], DAY, load_id, again)

    together(
        rows.sparkSession,
        lambda: put("groups", lambda: group_partials(rows)),
        lambda: put("accounts", lambda: account_partials(rows)),
        lambda: put("members", lambda: reduce(DataFrame.unionByName, map(bits, MEMBERS))),
    )


def drop_partials(spark: SparkSession, path: str, load_id: str, again: bool) -> None:
    """Take the part of a load that ran before and has no rows now out of all tables."""
    if again:
        for name, schema in TABLES.items():
            write_load(spark.createDataFrame([], schema), f"{path}/{name}", schema, DAY, load_id, again)


def read_partials(
    spark: SparkSession, path: str, dates: Sequence[date]
) -> dict[str, DataFrame] | None:
    """The parts of ``dates`` by table; None where there are none."""
    days = [d.isoformat() for d in dates]
    found = {n: read_loads(spark, f"{path}/{n}", schema, DAY, days) for n, schema in TABLES.items()}
    if found["groups"] is None:
        return None
    # Groups without any account and merchant have no bitmaps.
    found = {n: spark.createDataFrame([], TABLES[n]) if df is None else df for n, df in found.items()}
    return {n: df.filter(F.col(DAY).isin(list(dates))) for n, df in found.items()}


def compact_partials(spark: SparkSession, path: str, days: Sequence[date], keep_merged: bool = False) -> None:
    """Merge the parts of all loads of each of ``days`` into few files."""
    for name, schema in TABLES.items():
        merge_loads(spark, f"{path}/{name}", schema, DAY, [d.isoformat() for d in days], keep_merged)


def summaries(parts: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Both summaries from ``read_partials``."""
    return merged_groups(parts["groups"], parts["members"]), merged_accounts(parts["accounts"])
