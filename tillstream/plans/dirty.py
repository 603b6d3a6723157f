"""Days that changed and wait to be rebuilt.

Loads that come every minute would rebuild today's summaries every minute. They enter
the days they touched instead, and one rebuild at a time of its own takes all of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from ..sources.files import drop_path, exists
from .curate import CurateResult, build_curated


def enter_days(spark: SparkSession, path: str, days: Sequence[date]) -> None:
    """Note that ``days`` have new rows."""
    rows = spark.createDataFrame([(d,) for d in days], "day date")
    rows.coalesce(1).write.parquet(f"{path}/entry={uuid.uuid4().hex}")


def curate_dirty(
    spark: SparkSession,
    processed_path: str,
    curated_path: str,
    path: str,
    partials_path: str | None = None,
) -> CurateResult | None:
    """Rebuild each day entered since the last time, once. None if there was none.

    Entries are dropped after the rebuild, and only those that it saw: a day entered
    meanwhile, or before a crash, waits for the next one.
    """
    if not exists(spark, f"{path}/entry=*"):
        return None
    rows = spark.read.schema("day date, entry string").parquet(path)
    found = [(r.entry, r.day) for r in rows.distinct().collect()]
    days = sorted({d for _, d in found})
    result = build_curated(spark, processed_path, curated_path, days, partials_path)
    for entry in {e for e, _ in found}:
        drop_path(spark, f"{path}/entry={entry}")
    return result
