"""Few files for old days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from ..schemas import PROCESSED
from ..sources.live import merge_loads


def compact_days(
    spark: SparkSession, processed_path: str, days: Sequence[date], keep_merged: bool = False
) -> None:
    """Merge all loads of each of ``days`` into one directory. Days may get rows later all the
    same, and loads in them may run again; see ``merge_loads``."""
    values = [d.isoformat() for d in days]
    merge_loads(spark, processed_path, PROCESSED, "transaction_date", values, keep_merged)
