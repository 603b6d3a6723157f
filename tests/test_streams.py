from __future__ import annotations

import glob
import json
import os
import re
import threading
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.rows import messages, raw, txn, write_lines
from tillstream.operators.balances import current_balance, running_balance
from tillstream.operators.cleaning import processed, typed
from tillstream.operators.keys import dedupe_transactions
from tillstream.operators.summaries import account_summary
from tillstream.sinks.outbox import read_batches
from tillstream.sources.codec import decode, good
from tillstream.sources.zones import (
    read_account_summary,
    read_processed,
    read_raw,
    split_bad,
)
from tillstream.streaming.alerting import alerting
from tillstream.streaming import event_balances as event_balances_module
from tillstream.streaming.balances import BALANCE, balances, balances_in_state, compact_balances, read_balances
from tillstream.streaming.event_balances import event_balances
from tillstream.streaming.ingest import ingest
from tillstream.streaming.loading import loading
from tillstream.streaming.start import stop_when_idle


@pytest.fixture
def topic(spark, path):
    """``publish(values)`` adds messages; ``open()`` streams them, a file per batch."""

    class Topic:
        count = 0

        def publish(self, *values):
            df = messages(spark, list(values), self.count).coalesce(1)
            df.write.mode("append").parquet(path("topic"))
            self.count += len(values)

        def open(self, per_batch=1):
            schema = "value string, partition int, offset bigint"
            reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch)
            return reader.parquet(path("topic"))

    return Topic()


def test_ingest_writes_hourly_json_once(spark, path, topic):
    topic.publish(txn(transaction_id="a", channel=None, extra=1), "{bad")
    topic.publish(txn(transaction_id="b"))

    def run():
        ingest(topic.open(), path("raw"), path("ck"), max_records_per_file=1).awaitTermination()
        return read_raw(spark, path("raw"))

    before = datetime.now(timezone.utc)
    rows = run()
    assert rows.count() == 3
    files = glob.glob(path("raw") + "/year=*/month=*/day=*/hour=*/*.json")
    assert len(files) == 3
    assert all(re.search(r"/year=\d{4}/month=\d\d/day=\d\d/hour=\d\d/", f) for f in files)
    assert before.strftime("/year=%Y/month=%m/day=%d/") in files[0]

    sound, bad = split_bad(rows)
    assert [r.bad_value for r in bad.collect()] == ["{bad"]
    by_id = {r.transaction_id: r for r in typed(sound).collect()}
    assert (by_id["a"]._kafka_offset, by_id["b"]._kafka_offset) == (0, 2)
    assert by_id["a"]._extra == '{"extra":1}' and by_id["a"].amount == 100.0
    lines = [json.loads(line) for f in files for line in open(f, encoding="utf-8")]
    assert all("channel" in x for x in lines)  # NULLs are written
    stamp = {r.transaction_id: r._ingestion_timestamp for r in typed(sound).collect()}["b"]
    assert abs((stamp.replace(tzinfo=timezone.utc) - before).total_seconds()) < 300

    assert run().count() == 3
    topic.publish(txn(transaction_id="c"))
    assert run().count() == 4


def test_raw_files_on_local_disks_have_no_checksum_files(spark, path, topic):
    """Each would take Hadoop a process more; no setting stays behind."""
    topic.publish(*[txn(transaction_id=str(k)) for k in range(5)])
    ingest(topic.open(), path("raw"), path("ck"), max_records_per_file=2).awaitTermination()
    assert len(glob.glob(path("raw") + "/year=*/month=*/day=*/hour=*/*.json")) >= 3
    assert glob.glob(path("raw") + "/year=*/month=*/day=*/hour=*/.*.crc") == []
    assert {r.transaction_id for r in read_raw(spark, path("raw")).collect()} == set("01234")
    assert spark.conf.get("fs.file.impl", None) is None and spark.conf.get("fs.file.impl.disable.cache", None) is None


def test_alert_stream_equals_the_batch_and_replays_in_place(spark, path, topic):
    master = spark.createDataFrame(
        [("AC100001", "Asha", "a@example.com")], "account_id string, user_name string, user_email string"
    )
    topic.publish(txn(transaction_id="a", amount=9500, transaction_status="FAILED"), "{bad")
    topic.publish(txn(transaction_id="b", balance_after_transaction=1), txn(account_id="AC2"))

    def run():
        alerting(
            topic.open(),
            lambda: master,
            path("outbox"),
            path("ck"),
            unmatched=path("unmatched"),
            metrics=path("metrics"),
            bad=path("bad"),
            deliver=lambda alerts: alerts.withColumn("delivered", F.col("alert_type") == "HIGH_VALUE"),
        ).awaitTermination()
        rows = spark.read.parquet(path("outbox")).collect()
        return sorted((r.batch_id, r.transaction_id, r.alert_type) for r in rows)

    expected = [(0, "a", "FAILED_TXN"), (0, "a", "HIGH_VALUE"), (1, "b", "LOW_BALANCE")]
    assert run() == expected
    assert spark.read.parquet(path("unmatched")).select("account_id").collect()[0][0] == "AC2"
    metrics = spark.read.parquet(path("metrics")).orderBy("batch_id").collect()
    counts = [(r.events_total, r.alerts_sent, r.bad_messages, r.alerts_delivered) for r in metrics]
    assert counts == [(1, 2, 1, 1), (2, 1, 0, 0)]
    assert [r.bad_value for r in spark.read.parquet(path("bad")).collect()] == ["{bad"]

    # The last batch was written but not committed: it runs again, into its own place.
    os.unlink(path("ck") + "/commits/1")
    crc = path("ck") + "/commits/.1.crc"
    if os.path.exists(crc):
        os.unlink(crc)
    assert run() == expected


def test_balance_stream_keeps_its_state(spark, path, topic):
    moves = [
        txn(transaction_id=str(i), account_id=f"A{i % 3}", amount=i + 0.5, transaction_status=s)
        for i, s in enumerate(["SUCCESS", "SUCCESS", "FAILED"] * 4)
    ]
    for part in (moves[:5], moves[5:8], moves[8:]):
        topic.publish(*part)
        stream = typed(good(decode(topic.open().select("value"))))
        balances(stream, F.lit(100_00), path("out"), path("ck")).awaitTermination()
    batch = current_balance(typed(good(decode(messages(spark, moves)))), F.lit(100_00))
    got = read_balances(spark, path("out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert read_batches(spark, path("out"), BALANCE).select("batch_id").distinct().count() == 3


def test_balances_of_two_streams_and_their_compaction(spark, path, topic):
    def run(checkpoint, **options):
        stream = typed(good(decode(topic.open().select("value"))))
        balances(stream, F.lit(0), path("out"), checkpoint, **options).awaitTermination()
        return {r.account_id: r.balance for r in read_balances(spark, path("out")).collect()}

    topic.publish(txn(transaction_id="a", account_id="A", amount=1), txn(transaction_id="x", account_id=None))
    assert run(path("ck1")) == {"A": -1.0}
    topic.publish(txn(transaction_id="b", account_id="B", amount=2))
    assert run(path("ck2")) == {"A": -1.0, "B": -2.0}
    assert run(path("ck1")) == {"A": -1.0, "B": -2.0}
    for _ in range(2):
        compact_balances(spark, path("out"))
        got = {r.account_id: r.balance for r in read_balances(spark, path("out")).collect()}
        assert got == {"A": -1.0, "B": -2.0}
    topic.publish(txn(transaction_id="c", account_id="A", amount=5))
    assert run(path("ck1")) == {"A": -6.0, "B": -2.0}


def test_a_repeated_delivery_moves_a_balance_once_on_request(spark, path, topic):
    topic.publish(txn(transaction_id="a"), txn(transaction_id="a"))
    topic.publish(txn(transaction_id="a"), txn(transaction_id="b"))
    for name, expected, options in (("x", -400.0, {}), ("y", -200.0, {"unique_within": "1 hour"})):
        stream = typed(good(decode(topic.open().select("value"))))
        balances(stream, F.lit(0), path(name), path("ck" + name), **options).awaitTermination()
        assert read_balances(spark, path(name)).first().balance == expected


def test_two_loaders_and_a_new_checkpoint_overwrite_nothing(spark, path):
    for name in "ab":
        write_lines(path("raw-" + name), "1.json", [raw(transaction_id=name)])
        loading(spark, path("raw-" + name), path("p"), path("ck-" + name)).awaitTermination()
    loading(spark, path("raw-a"), path("p"), path("ck-new"), unique_within="table").awaitTermination()
    assert sorted(r.transaction_id for r in read_processed(spark, path("p")).collect()) == ["a", "b"]


def test_batches_before_the_first(spark, path):
    assert read_balances(spark, path("nothing")).count() == 0


def test_load_stream_reads_each_file_once_and_refreshes_old_days(spark, path):
    args = dict(
        curated_path=path("curated"), quarantine_path=path("bad"), metrics_path=path("metrics")
    )

    def run():
        loading(spark, path("raw"), path("processed"), path("ck"), **args).awaitTermination()
        rows = read_processed(spark, path("processed"))
        return sorted((r.transaction_id, "s" + r.load_id.split("-")[-1]) for r in rows.collect())

    write_lines(path("raw"), "1.json", [raw(0, transaction_id="a"), raw(1, transaction_id="a"), "{bad"])
    write_lines(path("raw"), "2.json", [raw(2, transaction_id="b", transaction_timestamp="2026-01-05T00:00:00")])
    assert run() == [("a", "s0"), ("b", "s0")]
    assert run() == [("a", "s0"), ("b", "s0")]
    write_lines(path("raw"), "3.json", [raw(3, transaction_id="late", amount=7)])
    assert run() == [("a", "s0"), ("b", "s0"), ("late", "s1")]
    totals = {
        str(r.transaction_date): r.total_amount
        for r in read_account_summary(spark, path("curated")).collect()
    }
    assert totals == {"2026-01-02": 107.0, "2026-01-05": 100.0}
    assert [r.bad_value for r in spark.read.parquet(path("bad")).collect()] == ["{bad"]
    metrics = spark.read.parquet(path("metrics")).orderBy("batch_id").collect()
    assert [(r.raw_rows, r.written_rows, r.dropped_rows) for r in metrics] == [(4, 2, 2), (1, 1, 0)]


def test_load_stream_of_invalid_rows_only(spark, path):
    write_lines(path("raw"), "1.json", [raw(amount=None), "{bad"])
    loading(
        spark, path("raw"), path("p"), path("ck"), curated_path=path("c"), metrics_path=path("m")
    ).awaitTermination()
    row = spark.read.parquet(path("m")).first()
    assert (row.raw_rows, row.written_rows, row.dropped_rows) == (2, 0, 2)
    assert not os.path.exists(path("c"))


def test_load_stream_equals_the_batch_over_the_same_files(spark, path):
    for i in range(3):
        rows = [raw(i * 10 + j, transaction_id=f"{i}-{j}", amount=j) for j in range(10)]
        write_lines(path("raw"), f"{i}.json", rows)
    loading(spark, path("raw"), path("s"), path("ck"), max_files=1).awaitTermination()
    from tillstream.plans.load import run_load

    run_load(spark, path("raw"), path("b"), path("mark"))
    stream, batch = (read_processed(spark, path(p)).drop("load_id") for p in "sb")
    assert stream.exceptAll(batch).count() == batch.exceptAll(stream).count() == 0
    assert stream.count() == 30


def test_repeats_across_micro_batches(spark, path):
    write_lines(path("raw"), "1.json", [raw(transaction_id="a")])
    write_lines(path("raw"), "2.json", [raw(transaction_id="a"), raw(transaction_id="b")])
    loading(
        spark, path("raw"), path("p"), path("ck"), max_files=1, unique_within="table"
    ).awaitTermination()
    rows = read_processed(spark, path("p")).collect()
    assert sorted(r.transaction_id for r in rows) == ["a", "b"]


def test_messages_reach_the_curated_layer(spark, path, topic):
    """Topic → raw → processed → curated gives what the operators give in one step."""
    sent = [
        txn(
            transaction_id=str(i % 40),  # every event twice
            account_id=f"A{i % 7}",
            amount=i % 40 * 100 + 0.25,
            channel=["UPI", None][i % 2],
            transaction_timestamp=f"2026-01-0{i % 4 + 1}T10:00:0{i % 10}.5",
        )
        for i in range(80)
    ]
    topic.publish(*sent[:30], "{bad")
    topic.publish(*sent[30:])
    ingest(topic.open(), path("raw"), path("ck1")).awaitTermination()
    loading(
        spark, path("raw"), path("processed"), path("ck2"), curated_path=path("curated")
    ).awaitTermination()

    events = good(decode(messages(spark, sent).withColumnsRenamed(
        {"partition": "_kafka_partition", "offset": "_kafka_offset"}
    )))
    expected = account_summary(dedupe_transactions(processed(events)))
    got = read_account_summary(spark, path("curated")).select(*expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert read_processed(spark, path("processed")).count() == 40


# --- balances from state and per event, idle streams -------------------------


@pytest.mark.parametrize("options", [{}, {"unique_within": "1 hour"}])
def test_balances_are_read_from_the_state(spark, path, topic, options):
    for part in ([("a", "A", 1), ("b", "B", 2)], [("c", "A", 5), ("d", None, 9)]):
        topic.publish(*[txn(transaction_id=t, account_id=a, amount=x) for t, a, x in part])
        stream = typed(good(decode(topic.open().select("value"))))
        balances(stream, F.lit(10_00), None, path("ck"), **options).awaitTermination()
    got = {r.account_id: r.balance for r in balances_in_state(spark, path("ck"), F.lit(10_00)).collect()}
    assert got == {"A": 4.0, "B": 8.0}


def rows_with_order(df):
    decoded = good(decode(df.select("value", "partition", "offset")))
    return typed(decoded.withColumnsRenamed({"partition": "_kafka_partition", "offset": "_kafka_offset"}))


def test_balances_per_event_equal_the_batch_over_many_micro_batches(spark, path, topic, monkeypatch):
    monkeypatch.setattr(event_balances_module, "SNAPSHOT_EVERY", 2)
    moves = [
        txn(
            transaction_id=str(i),
            account_id=["A", "A", "B", f"C{i}", None][i % 5],
            amount=i + 0.25,
            transaction_type=["DEBIT", "CREDIT"][i % 2],
            transaction_status=["SUCCESS", "SUCCESS", "FAILED"][i % 3],
            transaction_timestamp=f"2026-01-02T00:00:{i:02d}",
        )
        for i in range(42)
    ]
    for k in range(0, 42, 7):
        topic.publish(*moves[k : k + 7])

    def run():
        event_balances(rows_with_order(topic.open()), F.lit(500), path("out"), path("ck"), split_rows=2).awaitTermination()
        return sorted(map(str, spark.read.parquet(path("out") + "/events").select(*shown).collect()))

    shown = ["transaction_id", "account_id", "balance_after_transaction"]
    batch = rows_with_order(messages(spark, moves)).filter("account_id is not null")
    expected = sorted(map(str, running_balance(batch, F.lit(500)).select(*shown).collect()))
    assert run() == expected
    # Old states are dropped, and a micro-batch that runs again gives the same.
    assert len(glob.glob(path("out") + "/state/query_id=*/batch_id=*")) <= 4
    for name in ("5", ".5.crc"):
        if os.path.exists(f"{path('ck')}/commits/{name}"):
            os.unlink(f"{path('ck')}/commits/{name}")
    assert run() == expected


def test_a_stream_stops_when_no_message_comes(spark, path, topic):
    topic.publish(txn(transaction_id="a"))
    query = ingest(topic.open(), path("raw"), path("ck"), every="100 milliseconds")
    late = [threading.Timer(k, topic.publish, [txn(transaction_id=str(k))]) for k in (1.0, 2.5)]
    began = time.monotonic()
    for push in late:
        push.start()
    assert stop_when_idle(query, timedelta(seconds=3)) == 3
    assert time.monotonic() - began >= 5.0 and not query.isActive
    assert read_raw(spark, path("raw")).count() == 3


def test_waiting_for_a_stream_that_fails_raises(spark, path):
    spark.range(1).write.parquet(path("t"))
    stream = spark.readStream.schema("id long").parquet(path("t"))

    def fail(batch, batch_id):
        raise RuntimeError("no")

    query = stream.writeStream.foreachBatch(fail).option("checkpointLocation", path("ck")).start()
    with pytest.raises(Exception):
        stop_when_idle(query, timedelta(seconds=5))
