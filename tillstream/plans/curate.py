"""Processed → curated: rebuild whole days of both summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.summaries import account_summary, channel_category_summary
from ..session import together
from ..sinks.zones import write_days
from ..sources.zones import (
    read_account_summary,
    read_channel_category_summary,
    read_processed,
)
from .partials import read_partials, summaries


@dataclass(frozen=True)
class CurateResult:
    records: int
    channel_category_rows: int
    account_rows: int


def build_curated(
    spark: SparkSession,
    processed_path: str,
    curated_path: str,
    dates: Sequence[date],
    partials_path: str | None = None,
) -> CurateResult | None:
    """Rebuild ``dates``; other days stay as they are.

    None where these days hold no rows; such days are left alone. With ``partials_path`` the
    days are put together from what each of their loads left there, and no row of the
    processed layer is read; all loads of these days must have been written with it.
    """
    if partials_path:
        parts = read_partials(spark, partials_path, dates)
        if parts is None:
            return None
        groups, accounts = summaries(parts)
    else:
        days = read_processed(spark, processed_path, dates)
        if days is None:
            return None
        groups, accounts = channel_category_summary(days), account_summary(days)
    together(
        spark,
        lambda: write_days(groups, f"{curated_path}/channel_category_summary"),
        lambda: write_days(accounts, f"{curated_path}/account_summary"),
    )

    # Counted from what was written: small, and right after any retry.
    groups = read_channel_category_summary(spark, curated_path, dates)
    if groups is None:
        return None
    accounts = read_account_summary(spark, curated_path, dates)
    written = groups.select("total_transactions", F.lit(1).alias("group"), F.lit(0).alias("account"))
    written = written.unionAll(accounts.select(F.lit(0).cast("bigint"), F.lit(0), F.lit(1)))
    return CurateResult(*written.agg(F.sum("total_transactions"), F.sum("group"), F.sum("account")).first())
