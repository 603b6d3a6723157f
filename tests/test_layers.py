from __future__ import annotations

import glob
import json
import os
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.rows import raw, write_lines
from tillstream.plans.catalog import register_tables, register_views
from tillstream.plans.curate import build_curated
from tillstream.plans.dirty import curate_dirty, enter_days
from tillstream.plans.load import load_batch, raw_metrics, run_load
from tillstream.sinks.zones import write_processed
from tillstream.sources.marks import EPOCH, read_mark, write_mark
from tillstream.sources.master import read_master
from tillstream.sources.zones import (
    read_account_summary,
    read_channel_category_summary,
    read_processed,
    read_raw,
    split_bad,
)

DAY1, DAY2 = date(2026, 1, 2), date(2026, 1, 3)
T1, T2 = "2026-01-02T03:04:05", "2026-01-03T03:04:05"


def ids(df):
    return sorted(r.transaction_id for r in df.collect())


# --- raw -------------------------------------------------------------------


def test_raw_read_ignores_directories_suffixes_and_types(spark, path):
    hour = path("raw") + "/year=2026/month=01/day=02/hour=03"
    write_lines(hour, "a.json", [raw(amount=1), raw(amount="x"), "{bad", "", raw(amount=None)])
    write_lines(hour, "b.txt", [raw()])
    df = read_raw(spark, path("raw"))
    assert "year" not in df.columns
    rows, bad = split_bad(df)
    assert [r.amount for r in rows.collect()] == ["1", "x", None]
    assert [r.bad_value for r in bad.collect()] == ["{bad"]
    assert tuple(raw_metrics(df).first()) == (4, 1)  # a blank line is no row


def test_raw_read_of_a_list_of_files(spark, path):
    files = [write_lines(path("raw"), f"{n}.json", [raw(transaction_id=n)]) for n in "abc"]
    assert ids(read_raw(spark, files[:2])) == ["a", "b"]


def test_raw_read_between_two_times(spark, path):
    for n, at in (("a", 100.4), ("b", 100.5), ("c", 100.6)):
        os.utime(write_lines(path("raw"), f"{n}.json", [raw(transaction_id=n)]), (at, at))

    def at(ms):
        return EPOCH + timedelta(milliseconds=ms)

    assert ids(read_raw(spark, path("raw"), after=at(100_400))) == ["b", "c"]
    assert ids(read_raw(spark, path("raw"), after=at(100_400), until=at(100_500))) == ["b"]
    assert ids(read_raw(spark, path("raw"), until=at(100_499))) == ["a"]
    assert ids(read_raw(spark, path("raw"), after=at(100_600))) == []


# --- marks and loads -------------------------------------------------------


def test_mark(spark, path):
    assert read_mark(spark, path("mark")) == EPOCH
    early, late = (datetime(2026, 1, d, 1, 2, 3, 4, tzinfo=timezone.utc) for d in (1, 2))
    write_mark(spark, path("mark"), late)
    write_mark(spark, path("mark"), early)
    assert read_mark(spark, path("mark")) == late


def test_unreadable_mark_raises(spark, path):
    write_lines(path("mark"), "m.json", ["{bad"])
    with pytest.raises(Exception):
        read_mark(spark, path("mark"))


@pytest.fixture
def load(spark, path):
    def run(**options):
        return run_load(spark, path("raw"), path("processed"), path("mark"), **options)

    return run


def test_load_counts_and_advances(spark, path, load):
    lines = [
        raw(0, transaction_id="a"),
        raw(1, transaction_id="a"),
        raw(2, transaction_id="b", transaction_timestamp=T2),
        raw(3, transaction_id=None),
        "{bad",
    ]
    write_lines(path("raw"), "1.json", lines)
    result = load()
    assert (result.files, result.raw_rows, result.written_rows, result.dropped_rows) == (1, 5, 2, 3)
    assert result.rows_by_day == {DAY1: 1, DAY2: 1}
    mark = read_mark(spark, path("mark"))
    assert mark > EPOCH

    again = load()
    assert (again.raw_rows, again.written_rows) == (0, 0)
    assert read_mark(spark, path("mark")) == mark

    write_lines(path("raw"), "2.json", [raw(4, transaction_id="c")])
    assert load().written_rows == 1
    assert ids(read_processed(spark, path("processed"))) == ["a", "b", "c"]


def test_load_without_any_file_writes_nothing(spark, path, load):
    os.makedirs(path("raw"))
    write_lines(path("raw"), "empty.json", [])
    assert load().raw_rows == 0
    assert not os.path.exists(path("processed")) and not os.path.exists(path("mark"))


def test_files_from_after_the_start_wait_for_the_next_run(spark, path, load):
    start = datetime.now(timezone.utc)
    for name, at in (("a", start.timestamp() - 60), ("b", start.timestamp() + 60)):
        os.utime(write_lines(path("raw"), f"{name}.json", [raw(transaction_id=name)]), (at, at))
    load(now=start)
    assert ids(read_processed(spark, path("processed"))) == ["a"]
    load(now=start + timedelta(minutes=2))
    assert ids(read_processed(spark, path("processed"))) == ["a", "b"]


def test_files_are_found_by_what_was_loaded_not_by_time(spark, path, load):
    def put(name, folder, days_ago):
        at = (datetime.now(timezone.utc) - timedelta(days=days_ago)).timestamp()
        os.utime(write_lines(f"{path('raw')}/{folder}", f"{name}.json", [raw(transaction_id=name)]), (at, at))

    put("a", "year=2026/month=01/day=05/hour=00", 0)
    load()
    put("old-time", "year=2026/month=01/day=05/hour=01", 900)
    put("old-directory", "year=2020/month=01/day=01/hour=00", 0)
    assert load().files == 2
    assert ids(read_processed(spark, path("processed"))) == ["a", "old-directory", "old-time"]
    put("too-old", "year=2026/month=01/day=05/hour=01", 900)
    assert load(lag=timedelta(days=30)).files == 0  # as was asked for
    assert load().files == 1


def test_what_a_stream_did_not_commit_is_not_loaded(spark, path, load):
    spark.range(1).select(F.lit(json.dumps(raw(transaction_id="a"))).alias("value")).write.parquet(path("t"))
    lines = spark.readStream.schema("value string").parquet(path("t"))
    lines = lines.selectExpr("get_json_object(value, '$.transaction_id') AS transaction_id",
                             "get_json_object(value, '$.account_id') AS account_id",
                             "get_json_object(value, '$.amount') AS amount",
                             "get_json_object(value, '$.transaction_status') AS transaction_status",
                             "get_json_object(value, '$.transaction_timestamp') AS transaction_timestamp")
    query = lines.writeStream.format("json").option("path", path("raw")).option("checkpointLocation", path("ck"))
    query.trigger(availableNow=True).start().awaitTermination()
    write_lines(path("raw") + "/year=2026/month=01/day=01/hour=00", "orphan.json", [raw(transaction_id="orphan")])
    assert load().raw_rows == 1
    assert ids(read_processed(spark, path("processed"))) == ["a"]


def test_a_load_takes_the_oldest_files_and_the_next_goes_on(spark, path, load):
    for k, name in enumerate("cab"):
        os.utime(write_lines(path("raw"), f"{name}.json", [raw(transaction_id=name)]), (1000 + k, 1000 + k))
    assert [load(most_files=2).files, load(most_files=2).files, load().files] == [2, 1, 0]
    rows = read_processed(spark, path("processed")).collect()
    assert {r.transaction_id: r.load_id for r in rows} == {"c": "m0", "a": "m0", "b": "m1"}


@pytest.mark.parametrize("lag", [timedelta(0), timedelta(hours=1)])
def test_what_a_load_with_a_lag_leaves_over_is_loaded_next(spark, path, load, lag):
    now = datetime.now(timezone.utc).timestamp()
    for name, days_ago in (("a", 900), ("b", 800), ("c", 800), ("d", 800), ("e", 10), ("f", 9)):
        at = int(now) - days_ago * 86_400
        os.utime(write_lines(path("raw"), f"{name}.json", [raw(transaction_id=name)]), (at, at))
    assert [load(most_files=2, lag=lag).files for _ in range(4)] == [2, 2, 2, 0]
    assert ids(read_processed(spark, path("processed"))) == list("abcdef")
    start = datetime.now(timezone.utc) + timedelta(seconds=1)
    write_lines(path("raw"), "g.json", [raw(transaction_id="g")])
    assert load(most_files=2, lag=timedelta(hours=1), now=start).files == 1
    assert abs(read_mark(spark, path("mark")) - start) < timedelta(milliseconds=1)


def test_files_without_rows_do_not_hold_up_newer_ones(spark, path, load):
    for k, lines in enumerate((["", ""], [" "], [" ", ""], [raw(transaction_id="a")], ["", "", ""])):
        os.utime(write_lines(path("raw"), f"{k}.json", lines), (1000 + k, 1000 + k))
    got = [load(most_files=2) for _ in range(4)]
    assert [(r.files, r.written_rows) for r in got] == [(2, 0), (2, 1), (1, 0), (0, 0)]
    assert ids(read_processed(spark, path("processed"))) == ["a"]


def test_bad_lines_of_a_load_are_kept(spark, path, load):
    good, other = json.dumps(raw(transaction_id="a")), json.dumps(raw(transaction_id="b"))
    bad = [good + other, good + " x", f"[{good}]", f"{good}],[{other}", f"{good},{other}", "{bad", "7"]
    write_lines(path("raw"), "1.json", [good, *bad])
    result = load(quarantine_path=path("bad"))
    assert (result.raw_rows, result.bad_rows, result.written_rows) == (8, 7, 1)
    assert sorted(r.bad_value for r in spark.read.parquet(path("bad")).collect()) == sorted(bad)


def test_a_replayed_load_keeps_no_stale_day(spark, path):
    write_lines(path("raw"), "1.json", [raw(transaction_id="a"), raw(transaction_id="b", transaction_timestamp=T2)])
    load_batch(read_raw(spark, path("raw")), path("p"), "x")
    write_lines(path("raw2"), "1.json", [raw(transaction_id="a", transaction_timestamp=T2)])
    load_batch(read_raw(spark, path("raw2")), path("p"), "x")
    assert [(r.transaction_id, r.transaction_date) for r in read_processed(spark, path("p")).collect()] == [("a", DAY2)]


def test_dirty_days_are_rebuilt_once(spark, path):
    write_lines(path("raw"), "1.json", [raw(transaction_id="a"), raw(transaction_id="b", transaction_timestamp=T2)])
    days = list(load_batch(read_raw(spark, path("raw")), path("p"), "x"))
    enter_days(spark, path("dirty"), days)
    enter_days(spark, path("dirty"), days[:1])
    assert curate_dirty(spark, path("p"), path("c"), path("dirty")).records == 2
    assert curate_dirty(spark, path("p"), path("c"), path("dirty")) is None


def test_a_load_of_invalid_rows_only(spark, path, load):
    write_lines(path("raw"), "1.json", [raw(amount=None), "{bad"])
    for scope in ("load", "day", "table"):
        result = load(unique_within=scope)
        assert (result.raw_rows, result.written_rows) == (2, 0)
        write_lines(path("raw"), f"{scope}.json", [raw(amount=None), "{bad"])


def test_a_load_that_died_before_its_mark_is_replaced(spark, path, load):
    write_lines(path("raw"), "1.json", [raw(transaction_id="a")])
    load_batch(read_raw(spark, path("raw")), path("processed"), "m0")  # no ledger entry follows
    write_lines(path("raw"), "2.json", [raw(transaction_id="b")])
    load()
    assert ids(read_processed(spark, path("processed"))) == ["a", "b"]


def test_repeats_across_loads(spark, path, load):
    write_lines(path("raw"), "1.json", [raw(transaction_id="a")])
    load()
    write_lines(path("raw"), "2.json", [raw(transaction_id="a"), raw(transaction_id="b")])
    load()
    assert ids(read_processed(spark, path("processed"))) == ["a", "a", "b"]


@pytest.mark.parametrize("scope,extra", [("day", ["a"]), ("table", [])])
def test_no_repeats_across_loads_on_request(spark, path, load, scope, extra):
    write_lines(path("raw"), "1.json", [raw(transaction_id="a")])
    load(unique_within=scope)
    lines = [
        raw(transaction_id="a"),
        raw(transaction_id="b"),
        raw(transaction_id="b", transaction_timestamp=T2),
    ]
    write_lines(path("raw"), "2.json", lines)
    assert load(unique_within=scope).written_rows == 1
    # The same id on another day is a repeat for the table only.
    write_lines(path("raw"), "3.json", [raw(transaction_id="a", transaction_timestamp=T2)])
    load(unique_within=scope)
    assert ids(read_processed(spark, path("processed"))) == sorted(["a", "b", *extra])


@pytest.mark.parametrize("scope", ["day", "table"])
def test_a_repeated_load_is_not_its_own_repeat(spark, path, scope):
    write_lines(path("raw"), "1.json", [raw(transaction_id="a")])
    for _ in range(2):
        rows = load_batch(read_raw(spark, path("raw")), path("p"), "x", unique_within=scope)
        assert rows == {DAY1: 1}
    assert load_batch(read_raw(spark, path("raw")), path("p"), "y", unique_within=scope) == {}


def test_unknown_scope(spark, path):
    with pytest.raises(ValueError):
        load_batch(read_raw(spark, [path("")]), path("p"), "x", unique_within="week")


def test_processed_layout(spark, path, load):
    write_lines(path("raw"), "1.json", [raw(transaction_id="a", note="kept")])
    load()
    (file,) = glob.glob(path("processed") + "/transaction_date=2026-01-02/load_id=m0/*.parquet")
    assert file.endswith(".snappy.parquet")
    (row,) = read_processed(spark, path("processed")).collect()
    assert (row.transaction_date, row.load_id) == (DAY1, "m0")


def test_a_big_day_is_written_by_many_tasks_and_small_days_by_few(spark, path):
    n = F.col("id")
    day = F.when(n % 3 == 0, F.lit("2026-01-01")).otherwise(F.date_add(F.lit("2026-02-01"), (n % 8).cast("int")))
    rows = spark.range(60_000).select(
        F.sha2(n.cast("string"), 256).alias("transaction_id"), F.to_date(day).alias("transaction_date")
    )
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "400k",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        write_processed(rows.repartition(8), path("p"), "x")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

    def files(day):
        return len(glob.glob(f"{path('p')}/transaction_date={day}/*/*.parquet"))

    assert files("2026-01-01") >= 3
    assert all(files(f"2026-02-0{d}") == 1 for d in range(1, 9))
    assert read_processed(spark, path("p")).count() == 60_000


# --- curated ---------------------------------------------------------------


@pytest.fixture
def two_days(spark, path):
    write_lines(path("raw"), "1.json", [
        raw(0, transaction_id="a", amount=1), raw(1, transaction_id="b", amount=2, transaction_timestamp=T2),
    ])
    return list(load_batch(read_raw(spark, path("raw")), path("processed"), "0"))


def test_rebuilding_one_day_leaves_the_other(spark, path, two_days):
    args = spark, path("processed"), path("curated")
    result = build_curated(*args, two_days)
    assert (result.records, result.channel_category_rows, result.account_rows) == (2, 2, 2)
    write_lines(path("late"), "2.json", [raw(2, transaction_id="c", amount=10)])
    touched = load_batch(read_raw(spark, path("late")), path("processed"), "1")
    assert list(touched) == [DAY1]
    assert build_curated(*args, [DAY1]).records == 2
    for _ in range(2):
        totals = {
            r.transaction_date: r.total_amount
            for r in read_account_summary(spark, path("curated")).collect()
        }
        assert totals == {DAY1: 11.0, DAY2: 2.0}
        build_curated(*args, [DAY1])


def test_a_day_without_rows_is_not_written(spark, path, two_days):
    args = spark, path("processed"), path("curated")
    assert build_curated(*args, [date(2020, 1, 1)]) is None
    assert build_curated(spark, path("nowhere"), path("curated"), two_days) is None
    assert not os.path.exists(path("curated"))
    # So is a day whose files hold no rows.
    empty = path("empty")
    days = read_processed(spark, path("processed")).filter("false").drop("transaction_date", "load_id")
    days.write.parquet(f"{empty}/transaction_date=2026-01-02/load_id=0")
    assert build_curated(spark, empty, path("curated2"), [DAY1]) is None
    # A missing day beside an existing one is no problem.
    assert build_curated(*args, [DAY1, date(2020, 1, 1)]).records == 1


def test_one_day_read_lists_and_reads_that_day_only(spark, path, two_days):
    df = read_processed(spark, path("processed"), [DAY2])
    assert ids(df) == ["b"]
    assert len(df.inputFiles()) == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "transaction_date" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_sql_tables_and_views(spark, path, two_days):
    args = spark, path("processed"), path("curated")
    build_curated(*args, [DAY1])
    spark.sql("CREATE DATABASE IF NOT EXISTS bank")
    register_tables(spark, path("curated"), "bank")
    register_views(spark, path("curated"), "v_")

    def days(table):
        return [r[0] for r in spark.sql(f"SELECT transaction_date FROM {table} ORDER BY 1").collect()]

    assert days("bank.account_summary") == days("v_account_summary") == [DAY1]
    build_curated(*args, [DAY2])
    register_tables(spark, path("curated"), "bank")
    assert days("bank.account_summary") == days("bank.channel_category_summary") == [DAY1, DAY2]
    spark.sql("DROP DATABASE bank CASCADE")
    assert read_channel_category_summary(spark, path("curated")).count() == 2


# --- master ----------------------------------------------------------------


def test_last_row_of_an_account_wins(spark, path):
    lines = ["user_email,plan,account_id,user_name"]
    lines += [f"{i}@example.com,x,A{i % 50},N{i}" for i in range(1000)]
    write_lines(path("m"), "m.csv", lines)
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # many blocks per file
    try:
        master = read_master(spark, path("m"), multiline=False)
        assert master.columns == ["account_id", "user_name", "user_email"]
        got = {r.account_id: r.user_name for r in master.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert got == {f"A{i % 50}": f"N{i}" for i in range(950, 1000)}


def test_master_files_with_different_columns(spark, path):
    write_lines(path("m"), "1.csv", ["account_id,user_name,user_email", "A,Ann,a@x"])
    write_lines(path("m"), "2.csv", ["user_email,plan,user_name,account_id", 'b@x,gold,"Bo\nJr",B'])
    got = sorted(tuple(r) for r in read_master(spark, path("m")).collect())
    assert got == [("A", "Ann", "a@x"), ("B", "Bo\nJr", "b@x")]
    write_lines(path("m"), "3.csv", ["account_id,user_name", "C,Cy"])
    with pytest.raises(Exception):
        read_master(spark, path("m"))


def test_master_quoting(spark, path):
    write_lines(path("m"), "m.csv", ["account_id,user_name,user_email", 'A,"Rao, ""R""",r@example.com'])
    assert read_master(spark, path("m")).first().user_name == 'Rao, "R"'
