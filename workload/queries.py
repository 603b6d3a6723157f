"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.operators.alerts import (
    ALERT_COLUMNS,
    alert_events,
    alert_metrics,
    ok_events,
    unmatched_events,
)
from tillstream.operators.balances import current_balance
from tillstream.operators.cleaning import derived, processed, typed, valid_only
from tillstream.operators.keys import dedupe_transactions, keep_first, not_seen_in
from tillstream.operators.messages import with_messages
from tillstream.operators.summaries import account_summary, channel_category_summary
from tillstream.plans.catalog import register_tables
from tillstream.plans.curate import build_curated
from tillstream.plans.compact import compact_days
from tillstream.plans.dirty import curate_dirty
from tillstream.plans.load import load_batch, parsed_once, raw_metrics, run_load
from tillstream.plans.redeliver import redeliver
from tillstream.schemas import CORRUPT, PROCESSED, RAW
from tillstream.session import scratch
from tillstream.sources.codec import decode, encode, good, quarantine
from tillstream.sources.live import read_loads
from tillstream.sources.master import latest_per_account, read_master, save_master
from tillstream.sources.zones import (
    list_raw,
    read_account_summary,
    read_channel_category_summary,
    read_processed,
    read_raw,
    split_bad,
)
from tillstream.streaming.alerting import alerting
from tillstream.streaming.balances import balances, balances_in_state, read_balances
from tillstream.streaming.event_balances import event_balances
from tillstream.streaming.ingest import ingest
from tillstream.streaming.loading import loading
from tillstream.streaming.progress import ProgressLog, read_progress
from tillstream.streaming.start import stop_when_idle

from .adapter import (
    EVENT_ORDER,
    master,
    master_rows,
    opening_cents,
    table,
    transactions,
    transactions_with_balance,
)

Query = Callable[[SparkSession, str], DataFrame]


def n() -> Column:
    """The number of an event."""
    return F.col("_kafka_offset")


def shown_time(name: str = "transaction_timestamp") -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def with_shown_time(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_timestamp", shown_time())


# --- raw → processed -------------------------------------------------------

PROCESSED_SHOWN = (
    "transaction_id",
    "account_id",
    "amount",
    "channel",
    "transaction_timestamp",
    "_kafka_offset",
    "transaction_date",
    "transaction_hour",
    "transaction_day_of_week",
    "is_high_value",
    "is_failed",
    "is_debit",
    "amount_bucket",
)


def messy(df: DataFrame) -> DataFrame:
    """Transactions as text, as they come out of JSON, with the usual faults."""
    return df.withColumns(
        {
            "transaction_id": F.when(n() % 29 != 0, F.col("transaction_id")),
            "account_id": F.when(n() % 31 != 0, F.col("account_id")),
            "amount": F.when(n() % 11 == 0, None)
            .when(n() % 13 == 0, "NaN")
            .when(n() % 17 == 0, "abc")
            .otherwise(F.col("amount").cast("string")),
            "channel": F.when(n() % 7 != 0, F.col("channel")),
            "transaction_type": F.when(n() % 41 != 0, F.col("transaction_type")),
            "transaction_status": F.when(n() % 19 == 0, None)
            .when(n() % 37 == 0, F.lower("transaction_status"))
            .otherwise(F.col("transaction_status")),
            "transaction_timestamp": F.when(n() % 23 == 0, "notatime").otherwise(
                F.date_format("transaction_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            ),
            "_kafka_offset": n().cast("string"),
        }
    )


def txn_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = processed(messy(transactions(spark, sf_dir)))
    return rows.select(*PROCESSED_SHOWN).transform(with_shown_time)


def txn_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts and derived columns of all rows, the invalid ones included."""
    rows = derived(typed(messy(transactions(spark, sf_dir))))
    rows = rows.withColumn("amount", F.when(~F.isnan("amount"), F.col("amount")))
    return rows.select(*PROCESSED_SHOWN).transform(with_shown_time)


def txn_valid_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir).withColumns(
        {
            "amount": F.when(n() % 11 == 0, None)
            .when(n() % 13 == 0, F.lit(float("nan")))
            .otherwise(F.col("amount")),
            "channel": F.when(n() % 7 != 0, F.col("channel")),
        }
    )
    return valid_only(rows).select("transaction_id", "amount", "channel")


def dedupe_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    return keep_first(items, ["l_orderkey", "l_linenumber"], [F.col(c) for c in items.columns])


def redelivered(df: DataFrame) -> DataFrame:
    """All events, a first copy without an amount of some and a late copy of others."""
    broken = df.filter(n() % 3 == 0).withColumns(
        {"amount": F.lit(None).cast("double"), "_kafka_partition": F.lit(-1)}
    )
    again = df.filter(n() % 4 == 0).withColumns(
        {"amount": F.col("amount") + 1, "_kafka_partition": F.lit(1)}
    )
    return df.unionByName(broken).unionByName(again)


def txn_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid_only(redelivered(transactions(spark, sf_dir)))
    return dedupe_transactions(rows).select(
        "transaction_id", "account_id", "amount", "_kafka_partition", "_kafka_offset"
    )


def txn_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-duplication against an earlier load, which here held two of three events."""
    rows = transactions(spark, sf_dir)
    return not_seen_in(rows, rows.filter(n() % 3 != 0)).select("transaction_id", "amount")


SOURCE_COLUMNS = ("_kafka_partition", "_kafka_offset")


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish and decode again; messages carry one field the schema does not know."""
    rows = transactions(spark, sf_dir).withColumn("risk", n() % 10)
    back = decode(encode(rows, keep=SOURCE_COLUMNS))
    return typed(good(back)).select(
        "key",
        "transaction_id",
        "account_id",
        "transaction_type",
        "amount",
        shown_time(),
        "merchant_name",
        "transaction_status",
        "_extra",
    )


def malformed(text: Column, number: Column) -> Column:
    """Some objects run together, followed by a word, in a list, or split over lists."""
    return (
        F.when(number % 17 == 0, F.concat(text, text))
        .when(number % 19 == 0, F.concat(text, F.lit(" x")))
        .when(number % 23 == 0, F.concat(F.lit("["), text, F.lit("]")))
        .when(number % 29 == 0, F.concat(text, F.lit("],["), text))
        .when(number % 31 == 0, F.concat(text, F.lit(","), text))
    )


def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that are not exactly one JSON object."""
    messages = encode(transactions(spark, sf_dir), keep=SOURCE_COLUMNS)
    short = F.concat(F.lit('{"transaction_id":"'), n().cast("string"), F.lit('"}'))
    broken = messages.withColumn(
        "value",
        F.when(n() % 7 == 0, F.concat(F.lit("{bad "), n().cast("string")))
        .when(n() % 11 == 0, n().cast("string"))
        .when(n() % 13 == 0, F.lit(""))
        .otherwise(F.coalesce(malformed(short, n()), F.col("value"))),
    )
    return quarantine(decode(broken)).select(
        n().alias("message"), F.col("_bad_value").alias("bad_value")
    )


# --- summaries and balances ------------------------------------------------


def q_channel_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return channel_category_summary(processed(transactions(spark, sf_dir)))


def q_account_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return account_summary(processed(transactions_with_balance(spark, sf_dir)))


def account_running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_with_balance(spark, sf_dir).select(
        "transaction_id", "account_id", "balance_after_transaction"
    )


def account_running_balance_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with accounts of over 80 events summed in slices."""
    return transactions_with_balance(spark, sf_dir, split_rows=80).select(
        "transaction_id", "account_id", "balance_after_transaction"
    )


def account_current_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_balance(transactions(spark, sf_dir), opening_cents(F.col("account_id")))


# --- alerts ----------------------------------------------------------------

ALERT_SHOWN = (
    "transaction_id",
    "account_id",
    "user_name",
    "user_email",
    "alert_type",
    "amount",
    "balance_after_transaction",
    "transaction_status",
)


def with_third_status(df: DataFrame) -> DataFrame:
    """Some events are pending, and some have their status in lower case."""
    return df.withColumn(
        "transaction_status",
        F.when(n() % 8 == 0, "PENDING")
        .when(n() % 9 == 0, F.lower("transaction_status"))
        .otherwise(F.col("transaction_status")),
    )


def q_alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = transactions_with_balance(spark, sf_dir)
    return alert_events(events, master(spark, sf_dir)).select(*ALERT_SHOWN)


def alert_events_large_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where the master is too large to broadcast and some accounts are hot."""
    events = transactions_with_balance(spark, sf_dir)
    return alert_events(
        events, master(spark, sf_dir), broadcast_bytes=0, hot_rows=60
    ).select(*ALERT_SHOWN)


def alert_events_bucketed_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a master kept as a table with a bucket for each shuffle partition."""
    events = transactions_with_balance(spark, sf_dir)
    name = "master_" + scratch(spark, "master")[-12:]
    save_master(master(spark, sf_dir), name, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = alert_events(events, spark.table(name), broadcast_bytes=0, hot_rows=60)
    result = scratch(spark, "alerts")
    found.select(*ALERT_SHOWN).write.parquet(result)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(found.select(*ALERT_SHOWN).schema).parquet(result)


def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_third_status(transactions_with_balance(spark, sf_dir))
    alerts = alert_events(events, master(spark, sf_dir)).select(*ALERT_COLUMNS)
    return with_messages(alerts).select("transaction_id", "alert_type", "subject", "body")


def alert_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = transactions_with_balance(spark, sf_dir)
    return unmatched_events(events, master(spark, sf_dir)).select(
        "transaction_id", "account_id", "amount", "status"
    )


def alert_unmatched_large_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = transactions_with_balance(spark, sf_dir)
    return unmatched_events(
        events, master(spark, sf_dir), broadcast_bytes=0, hot_rows=80
    ).select("transaction_id", "account_id", "amount", "status")


def alert_ok_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_third_status(transactions_with_balance(spark, sf_dir))
    return ok_events(events, master(spark, sf_dir)).select(
        "transaction_id", "account_id", "amount", "status", "balance_after_transaction"
    )


def alert_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = transactions_with_balance(spark, sf_dir)
    return alert_metrics(events, alert_events(events, master(spark, sf_dir)))


# --- master ----------------------------------------------------------------


def two_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, and a newer row of every third."""
    rows = master_rows(spark, sf_dir).withColumn("version", F.lit(1))
    newer = rows.filter("number % 3 = 0").withColumns(
        {"user_name": F.concat("user_name", F.lit(" (new)")), "version": F.lit(2)}
    )
    return rows.unionByName(newer)


def master_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_account(two_versions(spark, sf_dir), [F.col("version")])


def master_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through CSV files, written in two goes with different columns; some names
    hold a line break."""
    path = scratch(spark, "master")
    name = F.when(F.col("number") % 4 == 0, F.concat("user_name", F.lit("\nJr"))).otherwise(F.col("user_name"))
    rows = two_versions(spark, sf_dir).withColumn("user_name", name)
    orders = {1: ("user_email", "number", "account_id", "user_name"), 2: ("user_name", "account_id", "user_email")}
    for version, columns in orders.items():
        part = rows.filter(F.col("version") == version).select(*columns)
        part.write.mode("append").option("header", "true").csv(path)
    return read_master(spark, path)


# --- layers ----------------------------------------------------------------

def as_raw(df: DataFrame) -> DataFrame:
    """Transactions as raw rows: text, with an ingest time."""
    ts = F.date_format("transaction_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rows = df.withColumns({"transaction_timestamp": ts, "_ingestion_timestamp": ts})
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast("string").alias(f.name)
            for f in RAW.fields
        ]
    )


def load_days(df: DataFrame, path: str, load_id: str, partials: str | None = None) -> list[date]:
    with parsed_once(as_raw(df)) as raw:
        return list(load_batch(raw, path, load_id, partials_path=partials))


def curated_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build all days, rebuild one of them, read all."""
    processed_path, curated = scratch(spark, "processed"), scratch(spark, "curated")
    days = load_days(transactions(spark, sf_dir), processed_path, "0")
    build_curated(spark, processed_path, curated, days)
    build_curated(spark, processed_path, curated, [min(days)])
    return read_channel_category_summary(spark, curated)


def curate_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a rebuild of all days says it wrote."""
    processed_path, curated = scratch(spark, "processed"), scratch(spark, "curated")
    days = load_days(transactions(spark, sf_dir), processed_path, "0")
    result = build_curated(spark, processed_path, curated, days)
    return spark.createDataFrame([result], "records bigint, channel_category_rows bigint, account_rows bigint")


def compacted_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded in three goes, and every second day merged. Then a late load comes, one
    that was merged runs again with fewer rows, and every third day is merged."""
    out = scratch(spark, "processed")
    events = transactions(spark, sf_dir)
    late = n() % 10 == 0
    for part in range(3):
        days = load_days(events.filter((n() % 3 == part) & ~late), out, str(part))
    compact_days(spark, out, sorted(days)[::2])
    load_days(events.filter(late), out, "late")
    load_days(events.filter((n() % 3 == 1) & ~late & (n() % 2 == 0)), out, "1")
    compact_days(spark, out, sorted(days)[::3])
    rows = read_loads(spark, out, PROCESSED, "transaction_date", origin=True)
    return rows.select(
        "transaction_id",
        "amount",
        "transaction_date",
        F.coalesce("_origin", "load_id").alias("load_id"),
        F.col("load_id").startswith("c-").alias("merged"),
    )


def replayed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load runs again and no longer has rows for some of its days."""
    out = scratch(spark, "processed")
    events = transactions(spark, sf_dir)
    load_days(events.filter(n() % 2 == 0), out, "0")
    load_days(events, out, "1")
    odd_days = F.dayofmonth("transaction_timestamp") % 2 == 1
    load_days(events.filter((n() % 2 == 1) & odd_days), out, "1")
    return read_processed(spark, out).select("transaction_id", "load_id", "transaction_date")


def late_day_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth event arrives in a second load; the days it touches are rebuilt from what
    both loads left for the summaries."""
    processed_path, curated, partials = (scratch(spark, n) for n in ("processed", "curated", "partials"))
    events = transactions(spark, sf_dir)
    on_time = load_days(events.filter(n() % 10 != 0), processed_path, "0", partials)
    build_curated(spark, processed_path, curated, on_time, partials)
    touched = load_days(events.filter(n() % 10 == 0), processed_path, "1", partials)
    build_curated(spark, processed_path, curated, touched, partials)
    return read_channel_category_summary(spark, curated)


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files arrive in two goes, the second repeating some events of the first;
    a third run finds nothing."""
    raw, out, mark = (scratch(spark, n) for n in ("raw", "processed", "mark"))
    events = transactions(spark, sf_dir)
    for part in (events.filter(n() % 2 == 0), events.filter((n() % 2 == 1) | (n() % 5 == 0))):
        as_raw(part).write.mode("append").json(f"{raw}/transactions")
        run_load(spark, raw, out, mark, unique_within="day")
    run_load(spark, raw, out, mark, unique_within="day")
    return read_processed(spark, out).select(
        "transaction_id", "account_id", "amount", shown_time(), "transaction_date", "amount_bucket"
    )


def incremental_load_unique_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, the second repeating some events of the first with another day."""
    raw, out, mark = (scratch(spark, n) for n in ("raw", "processed", "mark"))
    events = transactions(spark, sf_dir)
    later = F.when(n() % 10 == 0, F.col("transaction_timestamp") + F.expr("INTERVAL 40 DAYS"))
    again = events.filter((n() % 2 == 1) | (n() % 5 == 0)).withColumn(
        "transaction_timestamp", F.coalesce(later, "transaction_timestamp")
    )
    for part in (events.filter(n() % 2 == 0), again):
        as_raw(part).write.mode("append").json(f"{raw}/transactions")
        run_load(spark, raw, out, mark, unique_within="table")
    return read_processed(spark, out).select("transaction_id", "amount", "transaction_date", "load_id")


def incremental_load_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A streamed raw layer, loaded; then a second batch of the stream whose files look old,
    and files of a batch that was never committed, which are no data."""
    path, raw, checkpoint = (scratch(spark, n) for n in ("topic", "raw", "checkpoint"))
    out, mark = scratch(spark, "processed"), scratch(spark, "mark")
    events = transactions(spark, sf_dir)
    ingest(topic(spark, events.filter(n() % 2 == 0), path), raw, checkpoint).awaitTermination()
    orphan = as_raw(events.filter(n() % 7 == 0)).withColumn("transaction_id", F.lit("orphan"))
    orphan.write.json(f"{raw}/year=2020/month=01/day=01/hour=00")
    run_load(spark, raw, out, mark)
    ingest(topic(spark, events.filter(n() % 2 == 1), path), raw, checkpoint).awaitTermination()
    hadoop = spark._jvm.org.apache.hadoop.fs
    for row in list_raw(spark, raw).select("path").collect():
        file = hadoop.Path(row.path)
        file.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(file, 1_000_000_000, -1)
    run_load(spark, raw, out, mark)
    return read_processed(spark, out).select("transaction_id", "amount", "load_id")


def load_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load says of itself, over faulty rows and lines that can't be read."""
    raw, out, mark = (scratch(spark, name) for name in ("raw", "processed", "mark"))
    rows = messy(transactions(spark, sf_dir))
    lines = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"), n().cast("long").alias("n"))
    value = F.coalesce(malformed(F.col("value"), F.col("n")), F.col("value"))
    lines.select(value.alias("value")).write.text(raw)
    for file in spark.read.text(raw).select("_metadata.file_path").distinct().collect():
        old = spark._jvm.org.apache.hadoop.fs.Path(file[0])
        new = spark._jvm.org.apache.hadoop.fs.Path(file[0].removesuffix(".txt") + ".json")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(raw).select("path").count()
    result = run_load(spark, raw, out, mark).frame(spark)
    return result.withColumn("all_files", F.col("files") == listed).drop("files")


def raw_files_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a raw read, and whether its file count is that of a plain listing."""
    raw = scratch(spark, "raw")
    as_raw(transactions(spark, sf_dir)).write.json(raw)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(raw)
    files = listed.select("path").count()
    return raw_metrics(read_raw(spark, raw)).select(
        "raw_rows", (F.col("files_processed") == files).alias("all_files")
    )


def raw_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of raw files that are not one JSON object: cut short, or malformed."""
    raw = scratch(spark, "raw")
    value, number = F.col("value"), F.col("_kafka_offset")
    cut = F.when(value.contains('"channel":"ATM"'), F.substring_index(value, ",", 3))
    lines = encode(transactions(spark, sf_dir), keep=("_kafka_offset",))
    short = F.concat(F.lit('{"transaction_id":"'), number.cast("string"), F.lit('"}'))
    lines.select(F.coalesce(cut, malformed(short, number), value).alias("value")).write.text(raw)
    return split_bad(read_raw(spark, raw, suffix="*.txt"))[1].select("bad_value")


# --- streams ---------------------------------------------------------------


def topic(spark: SparkSession, events: DataFrame, path: str) -> DataFrame:
    """Publish events as messages into ``path`` and open it as a stream."""
    messages = encode(events, keep=SOURCE_COLUMNS).withColumnsRenamed(
        {"_kafka_partition": "partition", "_kafka_offset": "offset"}
    )
    messages.write.mode("append").parquet(path)
    return spark.readStream.schema(messages.schema).parquet(path)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the ingest stream, the second finding only new messages."""
    path, raw, checkpoint = (scratch(spark, n) for n in ("topic", "raw", "checkpoint"))
    events = transactions(spark, sf_dir)
    for part in (events.filter(n() % 2 == 0), events.filter(n() % 2 == 1)):
        ingest(topic(spark, part, path), raw, checkpoint).awaitTermination()
    rows = typed(split_bad(read_raw(spark, raw))[0])
    return rows.select(
        "transaction_id",
        "account_id",
        "amount",
        shown_time(),
        "merchant_name",
        "_kafka_offset",
        "_kafka_partition",
    )


def stream_ingest_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event: written within the run, in the directory of that hour, in a small file."""
    path, raw, checkpoint = (scratch(spark, n) for n in ("topic", "raw", "checkpoint"))
    before = datetime.now(timezone.utc)
    events = topic(spark, transactions(spark, sf_dir), path)
    ingest(events, raw, checkpoint, max_records_per_file=50).awaitTermination()
    after = datetime.now(timezone.utc)
    rows = read_raw(spark, raw)
    rows = typed(rows.drop(CORRUPT, "_bad_value"))
    stamp = F.col("_ingestion_timestamp")
    folder = F.date_format(stamp, "'/year='yyyy'/month='MM'/day='dd'/hour='HH'/'")
    return rows.select(
        "transaction_id",
        stamp.between(F.lit(before - timedelta(seconds=1)), F.lit(after)).alias("in_run"),
        F.col("_file").contains(folder).alias("in_its_hour"),
        (F.count("*").over(Window.partitionBy("_file")) <= 50).alias("in_small_file"),
    )


def stream_ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an ingest stream counted while it wrote, some messages being malformed."""
    path, raw, checkpoint, log = (scratch(spark, n) for n in ("topic", "raw", "checkpoint", "progress"))
    listener = ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        for k in range(2):
            messages = topic(spark, transactions(spark, sf_dir).filter(n() % 2 == k), path)
            value = F.coalesce(malformed(F.col("value"), F.col("offset")), F.col("value"))
            ingest(messages.withColumn("value", value), raw, checkpoint).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    counts = F.col("observed")["ingest"]
    return read_progress(spark, log).agg(
        F.count("*").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum(counts["rows"]).alias("rows"),
        F.sum(counts["bad_rows"]).alias("bad_rows"),
    )


def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files as a stream, in two runs, then the days that changed rebuilt."""
    raw, out, curated, dirty, partials, checkpoint = (
        scratch(spark, n) for n in ("raw", "processed", "curated", "dirty", "partials", "checkpoint")
    )
    events = transactions_with_balance(spark, sf_dir)
    for part in (events.filter(n() % 10 != 0), events.filter(n() % 10 == 0)):
        as_raw(part).write.mode("append").json(raw)
        loading(spark, raw, out, checkpoint, dirty_path=dirty, partials_path=partials).awaitTermination()
    curate_dirty(spark, out, curated, dirty, partials)
    return read_account_summary(spark, curated)


def two_streams_one_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raw layers, two streams, one processed layer; then the first starts anew."""
    out, checkpoint = scratch(spark, "processed"), scratch(spark, "checkpoint")
    events = transactions(spark, sf_dir)
    raws = [scratch(spark, "raw") for _ in range(2)]
    for k, raw in enumerate(raws):
        as_raw(events.filter(n() % 2 == k)).write.json(raw)
        loading(spark, raw, out, f"{checkpoint}-{k}").awaitTermination()
    loading(spark, raws[0], out, f"{checkpoint}-2", unique_within="day").awaitTermination()
    return read_processed(spark, out).select("transaction_id", "account_id", "amount")


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, outbox, checkpoint = (scratch(spark, n) for n in ("topic", "outbox", "checkpoint"))
    stream = topic(spark, transactions_with_balance(spark, sf_dir), path)
    alerting(stream, lambda: master(spark, sf_dir), outbox, checkpoint).awaitTermination()
    return spark.read.parquet(outbox).select(*ALERT_SHOWN, "subject", "body")


def alert_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of an alert stream with malformed messages and a delivery that fails at times."""
    path, outbox, checkpoint, bad, metrics = (
        scratch(spark, n) for n in ("topic", "outbox", "checkpoint", "bad", "metrics")
    )
    messages = encode(transactions_with_balance(spark, sf_dir), keep=("_kafka_offset",))
    value = F.coalesce(malformed(F.col("value"), n()), F.col("value"))
    messages.select(value.alias("value")).write.parquet(path)

    def deliver(alerts: DataFrame) -> DataFrame:
        return alerts.withColumn("delivered", F.col("alert_type") != "LOW_BALANCE")

    alerting(
        spark.readStream.schema("value string").parquet(path),
        lambda: master(spark, sf_dir),
        outbox,
        checkpoint,
        bad=bad,
        metrics=metrics,
        deliver=deliver,
    ).awaitTermination()
    kept = spark.read.parquet(bad).select(F.count("*").alias("quarantined"))
    sums = spark.read.parquet(metrics).drop("query_id", "batch_id")
    return sums.agg(*[F.sum(c).alias(c) for c in sums.columns]).join(kept)


def stream_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances after two runs over the message stream."""
    path, out, checkpoint = (scratch(spark, n) for n in ("topic", "balances", "checkpoint"))
    events = transactions(spark, sf_dir)
    for part in (events.filter(n() % 2 == 0), events.filter(n() % 2 == 1)):
        decoded = typed(good(decode(topic(spark, part, path).select("value"))))
        balances(decoded, opening_cents(F.col("account_id")), out, checkpoint).awaitTermination()
    return read_balances(spark, out)


def stream_balance_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the stream's state; no update is written."""
    path, checkpoint = scratch(spark, "topic"), scratch(spark, "checkpoint")
    opening = opening_cents(F.col("account_id"))
    events = transactions(spark, sf_dir)
    for part in (events.filter(n() % 2 == 0), events.filter(n() % 2 == 1)):
        decoded = typed(good(decode(topic(spark, part, path).select("value"))))
        balances(decoded, opening, None, checkpoint).awaitTermination()
    return balances_in_state(spark, checkpoint, opening)


def stream_event_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's balance over three micro-batches, accounts of over 30 events in slices."""
    path, out, checkpoint = (scratch(spark, n) for n in ("topic", "balances", "checkpoint"))
    events = transactions(spark, sf_dir)
    third = F.least(F.floor((F.dayofmonth("transaction_timestamp") - 1) / 10), F.lit(2))
    for part in range(3):
        messages = topic(spark, events.filter(third == part), path)
        decoded = decode(messages.select("value", "partition", "offset"))
        rows = typed(good(decoded).withColumnsRenamed({"partition": "_kafka_partition", "offset": "_kafka_offset"}))
        opening = opening_cents(F.col("account_id"))
        event_balances(rows, opening, out, checkpoint, EVENT_ORDER, split_rows=30).awaitTermination()
    return spark.read.parquet(f"{out}/events").select("transaction_id", "account_id", "balance_after_transaction")


def stream_idle_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ingest stream that gets messages in two more goes while it runs, and ends some time
    after the last."""
    path, raw, checkpoint = (scratch(spark, n) for n in ("topic", "raw", "checkpoint"))
    events = transactions(spark, sf_dir)
    query = ingest(topic(spark, events.filter(n() % 3 == 0), path), raw, checkpoint, every="200 milliseconds")
    late = [threading.Timer(1.5 * k, topic, (spark, events.filter(n() % 3 == k), path)) for k in (1, 2)]
    for push in late:
        push.start()
    rows = stop_when_idle(query, timedelta(seconds=4))
    for push in late:
        push.join()
    return read_raw(spark, raw).select("transaction_id", F.lit(rows).cast("long").alias("rows"))


def alert_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each alert was tried and sent, where some are sent at the second or third try."""
    path, outbox, checkpoint = (scratch(spark, n) for n in ("topic", "outbox", "checkpoint"))
    odd = F.col("transaction_id").cast("bigint") % 2 == 1

    def sent_if(condition: Column) -> Callable[[DataFrame], DataFrame]:
        return lambda alerts: alerts.withColumn("delivered", condition)

    stream = topic(spark, transactions_with_balance(spark, sf_dir), path)
    low = F.col("alert_type") == "LOW_BALANCE"
    alerting(stream, lambda: master(spark, sf_dir), outbox, checkpoint, deliver=sent_if(~low)).awaitTermination()
    for condition in (odd, F.lit(True), F.lit(True)):
        redeliver(spark, outbox, sent_if(condition))
    return spark.read.parquet(outbox).groupBy("transaction_id", "alert_type").agg(
        F.count("*").alias("tried"), F.count_if("delivered").alias("sent")
    )


def sql_over_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed_path, curated = scratch(spark, "processed"), scratch(spark, "curated")
    days = load_days(transactions_with_balance(spark, sf_dir), processed_path, "0")
    build_curated(spark, processed_path, curated, days)
    database = "curated_" + curated[-12:]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch(spark, database)}'")
    register_tables(spark, curated, database, days)
    out = spark.sql(
        f"""
        SELECT c.transaction_date, c.channel, c.transactions, c.failed, a.accounts
        FROM (SELECT transaction_date, channel, sum(total_transactions) AS transactions,
                     sum(failed_count) AS failed
              FROM {database}.channel_category_summary GROUP BY transaction_date, channel) c
        JOIN (SELECT transaction_date, count(*) AS accounts
              FROM {database}.account_summary GROUP BY transaction_date) a
          ON a.transaction_date = c.transaction_date
        """
    )
    result = scratch(spark, "result")
    out.write.parquet(result)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.schema(out.schema).parquet(result)


QUERIES: dict[str, Query] = {
    "txn_processed": txn_processed,
    "txn_typed": txn_typed,
    "txn_valid_only": txn_valid_only,
    "dedupe_lineitem": dedupe_lineitem,
    "txn_dedupe": txn_dedupe,
    "txn_new_only": txn_new_only,
    "json_roundtrip": json_roundtrip,
    "json_quarantine": json_quarantine,
    "channel_category_summary": q_channel_category_summary,
    "account_summary": q_account_summary,
    "account_running_balance": account_running_balance,
    "account_running_balance_split": account_running_balance_split,
    "account_current_balance": account_current_balance,
    "alert_events": q_alert_events,
    "alert_events_large_master": alert_events_large_master,
    "alert_events_bucketed_master": alert_events_bucketed_master,
    "alert_messages": alert_messages,
    "alert_unmatched": alert_unmatched,
    "alert_unmatched_large_master": alert_unmatched_large_master,
    "alert_ok_events": alert_ok_events,
    "alert_run_metrics": alert_run_metrics,
    "master_latest": master_latest,
    "master_csv": master_csv,
    "curated_day": curated_day,
    "late_day_rebuild": late_day_rebuild,
    "curate_run_metrics": curate_run_metrics,
    "compacted_day": compacted_day,
    "replayed_load": replayed_load,
    "incremental_load": incremental_load,
    "incremental_load_unique_table": incremental_load_unique_table,
    "incremental_load_late_files": incremental_load_late_files,
    "load_run_metrics": load_run_metrics,
    "raw_files_read": raw_files_read,
    "raw_quarantine": raw_quarantine,
    "stream_ingest": stream_ingest,
    "stream_ingest_layout": stream_ingest_layout,
    "stream_ingest_metrics": stream_ingest_metrics,
    "stream_load": stream_load,
    "two_streams_one_table": two_streams_one_table,
    "stream_alerts": stream_alerts,
    "alert_quarantine": alert_quarantine,
    "alert_redelivery": alert_redelivery,
    "stream_balance": stream_balance,
    "stream_balance_state": stream_balance_state,
    "stream_event_balances": stream_event_balances,
    "stream_idle_stop": stream_idle_stop,
    "sql_over_curated": sql_over_curated,
}
