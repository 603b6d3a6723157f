"""Raw → processed: select new files, transform, write, enter them in the ledger."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import derived, is_valid, processed, typed
from ..operators.keys import dedupe_transactions, not_seen_in
from ..schemas import PROCESSED
from ..settings import Rules
from ..sinks.zones import write_processed
from ..sources.files import exists
from ..sources.ledger import enter, next_load, read_ledger
from ..sources.live import begin_load, end_loads, take_out
from ..sources.marks import EPOCH, read_mark, write_mark
from ..sources.seen import keep_ids, kept_ids, loaded_before, write_ids
from ..sources.zones import (
    bad_text,
    list_raw,
    read_load,
    read_processed,
    read_raw,
    split_bad,
)
from .partials import drop_partials, write_partials

# How far a transaction must be unique
LOAD, DAY, TABLE = "load", "day", "table"
# A load takes at most so many files, the oldest; the next load goes on with the rest.
FILES_PER_LOAD = 100_000


@dataclass(frozen=True)
class LoadResult:
    """What a load read and wrote. All numbers are counted from finished output."""

    files: int = 0
    raw_rows: int = 0
    bad_rows: int = 0
    rows_by_day: dict[date, int] = field(default_factory=dict)

    @property
    def written_rows(self) -> int:
        return sum(self.rows_by_day.values())

    @property
    def dropped_rows(self) -> int:
        """Bad lines, invalid rows and repeats."""
        return self.raw_rows - self.written_rows

    def frame(self, spark: SparkSession) -> DataFrame:
        """The totals as one row."""
        names = ("files", "raw_rows", "bad_rows", "written_rows", "dropped_rows")
        row = tuple(getattr(self, n) for n in names)
        return spark.createDataFrame([row], ", ".join(f"{n} bigint" for n in names))


@contextmanager
def parsed_once(raw: DataFrame) -> Iterator[DataFrame]:
    """``raw`` (or other rows) kept on the executors' disks while it is read several times."""
    raw = raw.persist(StorageLevel.DISK_ONLY)
    try:
        yield raw
    finally:
        raw.unpersist()


@dataclass(frozen=True)
class BatchSummary:
    """What a batch of raw rows holds: rows, those that can't be read, days of valid ones."""

    rows: int
    bad: int
    days: list[date]


def summarise(raw: DataFrame, rules: Rules = Rules()) -> BatchSummary:
    """One pass over ``raw``. The days are not more than the calendar has."""
    typed_rows = derived(typed(raw.withColumn("_bad", bad_text(raw).isNotNull())), rules)
    day = F.when(~F.col("_bad") & is_valid(typed_rows), F.col("transaction_date"))
    row = typed_rows.agg(
        F.count("*").alias("rows"), F.count_if("_bad").alias("bad"), F.collect_set(day).alias("days")
    ).first()
    return BatchSummary(row["rows"], row["bad"], row["days"])


def load_batch(
    raw: DataFrame,
    processed_path: str,
    load_id: str,
    rules: Rules = Rules(),
    unique_within: str = LOAD,
    days: list[date] | None = None,
    partials_path: str | None = None,
) -> dict[date, int]:
    """Write one batch of raw rows as load ``load_id``; returns its rows per day.

    ``unique_within`` says how far a transaction is looked for: in this ``load``
    only, in earlier loads on the same ``day`` too, or in the whole ``table``. A
    delivery that is repeated has the same time, so ``day`` finds it, and reads the
    days of the batch. ``table`` keeps the ids of all loads by bucket, and reads those of the
    buckets that the batch's ids are in. ``days`` are those of the batch's valid rows, if they
    are known; else ``raw`` is read once more. With ``partials_path`` the load leaves there what
    it adds to the summaries of its days.
    """
    if unique_within not in (LOAD, DAY, TABLE):
        raise ValueError(f"unique_within: {unique_within}")
    spark = raw.sparkSession
    days = summarise(raw, rules).days if days is None else days
    again = not begin_load(spark, processed_path, load_id)
    if again:
        # Before earlier rows are listed: its own are not among them.
        take_out(spark, processed_path, "transaction_date", load_id)
    rows = dedupe_transactions(processed(split_bad(raw)[0], rules))
    if unique_within == TABLE:
        keep_ids(spark, processed_path)
        with parsed_once(rows) as rows:
            repeats = loaded_before(rows, processed_path, load_id)
            write_processed(rows if repeats is None else not_seen_in(rows, repeats), processed_path, load_id, False)
    else:
        if unique_within == DAY:
            earlier = read_processed(spark, processed_path, days)
            rows = _new_rows(rows, earlier, load_id, "transaction_date")
        write_processed(rows, processed_path, load_id, False)
    written = read_load(spark, processed_path, load_id, days)
    if kept_ids(spark, processed_path):
        ids = written if written is not None else spark.createDataFrame([], PROCESSED)
        write_ids(ids, processed_path, load_id, again)
    if written is None:
        if partials_path:
            drop_partials(spark, partials_path, load_id, again)
        return {}
    if partials_path:
        write_partials(written, partials_path, load_id, again)
    # Counted from the footers of this load's files; as many rows as it has days.
    counts = written.groupBy("transaction_date").count()
    return {r["transaction_date"]: r["count"] for r in counts.collect()}


def _new_rows(rows: DataFrame, earlier: DataFrame | None, load_id: str, *also: str) -> DataFrame:
    if earlier is None:
        return rows
    # A load that runs again does not count as earlier than itself.
    return not_seen_in(rows, earlier.filter(F.col("load_id") != load_id), "transaction_id", *also)


def new_files(
    spark: SparkSession, raw_path: str, ledger_path: str, until: datetime, after: datetime | None
) -> DataFrame:
    """``path`` and ``modified`` of the files that no load has entered yet."""
    listed = list_raw(spark, raw_path, after).filter(F.col("modified") <= F.lit(until))
    return listed.join(read_ledger(spark, ledger_path, after).select("path"), "path", "left_anti")


def run_load(
    spark: SparkSession,
    raw_path: str,
    processed_path: str,
    mark_path: str,
    rules: Rules = Rules(),
    unique_within: str = LOAD,
    now: datetime | None = None,
    lag: timedelta | None = None,
    quarantine_path: str | None = None,
    most_files: int = FILES_PER_LOAD,
    partials_path: str | None = None,
) -> LoadResult:
    """Load the files that no earlier load has loaded.

    What was loaded is in a ledger beside the mark (``<mark_path>_ledger``), so a file that
    appears late, in an old directory or with an old time, is found all the same. A load
    is entered there at its end; one that died before is run again under its number and
    replaces what it wrote. The mark is the start of the last run or, if that took as many
    files as it may, just before the last of them. With a ``lag``, files
    and ledger entries older than the mark by more than that are not looked at; it must be
    longer than any file takes to appear. Without new rows the mark stays and nothing is
    written but the ledger, so that files without rows aren't taken again. Bad lines go to ``quarantine_path``.
    """
    started = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    started = started.replace(microsecond=started.microsecond // 1000 * 1000)
    ledger_path = f"{mark_path}_ledger"
    if not exists(spark, raw_path):
        return LoadResult()
    mark = read_mark(spark, mark_path)
    after = mark - lag if lag is not None and mark > EPOCH else None
    files = new_files(spark, raw_path, ledger_path, started, after)
    files = files.orderBy("modified", "path").limit(most_files).collect()
    if not files:
        return LoadResult()
    number = next_load(spark, ledger_path)
    with parsed_once(read_raw(spark, [r.path for r in files])) as raw:
        batch = summarise(raw, rules)
        if not batch.rows:
            enter(spark.createDataFrame(files), ledger_path, number)
            return LoadResult(len(files))
        days = load_batch(
            raw, processed_path, f"m{number}", rules, unique_within, batch.days, partials_path
        )
        if quarantine_path and batch.bad:
            split_bad(raw)[1].write.mode("overwrite").parquet(f"{quarantine_path}/load={number}")
    enter(spark.createDataFrame(files), ledger_path, number)
    end_loads(spark, processed_path, [f"m{number}"])
    # What was left over is not older than the last file taken, but may be as old.
    left_over = len(files) == most_files
    read_until = files[-1].modified.astimezone(timezone.utc) - timedelta(milliseconds=1)
    write_mark(spark, mark_path, read_until if left_over else started)
    return LoadResult(len(files), batch.rows, batch.bad, days)


def raw_metrics(raw: DataFrame) -> DataFrame:
    """One row: rows and files of a raw read."""
    return raw.agg(
        F.count("*").alias("raw_rows"), F.count_distinct("_file").alias("files_processed")
    )
