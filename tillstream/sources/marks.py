"""The load mark: up to which file time a load has read."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..schemas import MARK
from .files import drop_path, exists, found_paths

# So many marks are kept at most before all but the last are deleted.
MOST_MARKS = 20

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def read_mark(spark: SparkSession, path: str) -> datetime:
    """The latest mark; 1970-01-01 UTC if none was written yet. Any other problem
    raises: taking an unreadable mark for a missing one would reload everything."""
    if not exists(spark, path):
        return EPOCH
    marks = spark.read.schema(MARK).option("mode", "FAILFAST").json(path)
    latest = marks.agg(F.max("last_processed_timestamp")).first()[0]
    return datetime.fromisoformat(latest) if latest else EPOCH


def write_mark(spark: SparkSession, path: str, at: datetime) -> None:
    """Append a mark. ISO text of one zone and width sorts by time."""
    at = at.astimezone(timezone.utc)
    old = found_paths(spark, f"{path}/*.json")
    row = (at.isoformat(timespec="microseconds"), at.strftime("%Y-%m-%d %H:%M:%S UTC"))
    spark.createDataFrame([row], MARK).coalesce(1).write.mode("append").json(path)
    if len(old) >= MOST_MARKS and read_mark(spark, path) == at:
        for file in old:
            drop_path(spark, file)
