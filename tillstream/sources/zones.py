"""Reading the raw, processed and curated layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ACCOUNT_SUMMARY, CHANNEL_CATEGORY_SUMMARY, CORRUPT, PROCESSED, RAW
from .codec import parsed
from .files import exists
from .live import read_loads

SUFFIX = "*.json"


def _option_time(t: datetime) -> str:
    if t.tzinfo is not None:
        t = t.astimezone(timezone.utc).replace(tzinfo=None)
    return t.isoformat(timespec="microseconds")


def _raw_files(reader, suffix: str):
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", suffix)


def list_raw(
    spark: SparkSession, path: str, after: datetime | None = None, suffix: str = SUFFIX
) -> DataFrame:
    """``path`` and ``modified`` of the layer's files, modified after ``after``.

    Where a stream writes the layer, its commit log says which files there are: what a
    micro-batch left that was never committed is not listed. Contents are not read. Files of
    0 bytes are not listed, as Spark lists none.
    """
    reader = _raw_files(spark.read.format("binaryFile"), suffix)
    if after is not None:
        reader = reader.option("modifiedAfter", _option_time(after))
    return reader.load(path).select("path", F.col("modificationTime").alias("modified"))


def read_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    after: datetime | None = None,
    until: datetime | None = None,
    schema: T.StructType = RAW,
    suffix: str = SUFFIX,
) -> DataFrame:
    """JSON lines below ``paths``: files named like ``suffix``, modified strictly
    after ``after`` and up to ``until`` (whole milliseconds, inclusive).

    A line that is not exactly one JSON object keeps its text in ``_corrupt_record``;
    blank lines are no rows. The directory names (year, month, day, hour) are no columns.
    """
    reader = _raw_files(spark.read, suffix)
    if after is not None:
        reader = reader.option("modifiedAfter", _option_time(after))
    if until is not None:
        reader = reader.option("modifiedBefore", _option_time(until + timedelta(milliseconds=1)))
    lines = reader.text([paths] if isinstance(paths, str) else list(paths))
    return _decoded(lines, schema)


def _decoded(lines: DataFrame, schema: T.StructType) -> DataFrame:
    known = T.StructType([f for f in schema.fields if f.name != CORRUPT])
    lines = lines.select("value", F.col("_metadata.file_path").alias("_file"))
    rows = parsed(lines.filter(F.trim("value") != ""), known)
    corrupt = F.when(F.col("_event").isNull(), F.col("value")).alias(CORRUPT)
    return rows.select(*[F.col(f"_event.{n}") for n in known.fieldNames()], corrupt, "_file")


def stream_raw(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    schema: T.StructType = RAW,
) -> DataFrame:
    """The raw layer as a stream of files; the checkpoint remembers which were read."""
    reader = _raw_files(spark.readStream, SUFFIX)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _decoded(reader.text(path), schema)


def bad_text(raw: DataFrame) -> Column:
    """The text of a raw row that could not be read, here or when it was ingested."""
    return F.coalesce(CORRUPT, "_bad_value") if "_bad_value" in raw.columns else F.col(CORRUPT)


def split_bad(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable rows, quarantined rows as ``bad_value``)."""
    text = bad_text(raw)
    return (
        raw.filter(text.isNull()).drop(CORRUPT, "_bad_value", "_file"),
        raw.filter(text.isNotNull()).select(text.alias("bad_value"), *[
            c for c in raw.columns if c not in (CORRUPT, "_bad_value", "_file")
        ]),
    )


def read_processed(
    spark: SparkSession, path: str, dates: Sequence[date] | None = None
) -> DataFrame | None:
    """The processed layer, pruned to whole days; None where there is nothing."""
    days = None if dates is None else [d.isoformat() for d in dates]
    rows = read_loads(spark, path, PROCESSED, "transaction_date", days)
    return rows if rows is None or dates is None else rows.filter(F.col("transaction_date").isin(list(dates)))


def read_load(
    spark: SparkSession, path: str, load_id: str, dates: Sequence[date] | None = None
) -> DataFrame | None:
    """The rows one load wrote and that were not merged since; quicker to find where its days
    are known."""
    days = _days_pattern(dates) if dates else "/transaction_date=*"
    return _read(spark, path, PROCESSED, f"{days}/load_id={load_id}")


def read_channel_category_summary(
    spark: SparkSession, curated: str, dates: Sequence[date] | None = None
) -> DataFrame | None:
    path = f"{curated}/channel_category_summary"
    return _read_days(spark, path, CHANNEL_CATEGORY_SUMMARY, dates)


def read_account_summary(
    spark: SparkSession, curated: str, dates: Sequence[date] | None = None
) -> DataFrame | None:
    return _read_days(spark, f"{curated}/account_summary", ACCOUNT_SUMMARY, dates)


def _read(spark, path, schema, below="") -> DataFrame | None:
    if not exists(spark, path + below):
        return None
    return spark.read.schema(schema).option("basePath", path).parquet(path + below)


def _days_pattern(dates: Sequence[date]) -> str:
    return f"/transaction_date={{{','.join(sorted(d.isoformat() for d in dates))}}}"


def _read_days(spark, path, schema, dates) -> DataFrame | None:
    if dates is None:
        return _read(spark, path, schema)
    if not dates:
        return None
    # The pattern keeps Spark from listing the files of all other days.
    df = _read(spark, path, schema, _days_pattern(dates))
    return df if df is None else df.filter(F.col("transaction_date").isin(list(dates)))
