"""Summaries from what each load left, against summaries of all rows."""

from __future__ import annotations

import random
import shutil

import pytest
from pyspark.sql import functions as F

from tests.rows import frame, raw, write_lines
from tillstream.operators.cleaning import processed
from tillstream.operators.partials import (
    MEMBERS,
    account_partials,
    group_partials,
    member_bits,
    member_values,
    merged_accounts,
    merged_groups,
)
from tillstream.operators.summaries import account_summary, channel_category_summary
from tillstream.plans.curate import build_curated
from tillstream.plans.load import load_batch
from tillstream.plans.partials import TABLES, compact_partials, read_partials, summaries
from tillstream.sources.numbers import numbered, read_numbers
from tillstream.sources.zones import read_account_summary, read_channel_category_summary, read_processed, read_raw
from tillstream.streaming.loading import loading


def events(seed, n):
    draw = random.Random(seed)
    amounts = [0.01, 10, 99.99, 500, 8000, 9500.5, 1e15, -2.5]
    return [
        raw(
            i,
            transaction_id=f"{seed}-{i}",
            account_id=draw.choice(["A", "A", "A", *(f"B{k}" for k in range(40))]),
            merchant_name=draw.choice([None, "M1", "M2", f"X{draw.randint(0, 30)}"]),
            channel=draw.choice(["UPI", "ATM", None]),
            amount=draw.choice(amounts),
            balance_after_transaction=draw.choice([None, 5, -1.255, 1000.5]),
            transaction_type=draw.choice(["DEBIT", "CREDIT"]),
            transaction_status=draw.choice(["SUCCESS", "FAILED"]),
            transaction_timestamp=f"2026-01-0{draw.randint(1, 2)}T00:00:0{draw.randint(0, 3)}",
            _kafka_partition=draw.randint(0, 2),
        )
        for i in range(n)
    ]


def same(got, expected):
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))


def test_merged_parts_equal_summaries_of_all_rows(spark, path):
    parts = [processed(frame(spark, events(seed, 120))) for seed in range(3)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    groups = group_partials(parts[0]).unionByName(group_partials(parts[1])).unionByName(group_partials(parts[2]))
    accounts = account_partials(parts[0]).unionByName(account_partials(parts[1])).unionByName(account_partials(parts[2]))
    for part in parts:
        for member in MEMBERS:
            values = member_values(part, member)
            found = member_bits(values.join(numbered(values, path(member), parts=3), "value"), member)
            # Not united unwritten: Spark takes two reads of a path in one plan for the same.
            found.write.mode("append").parquet(path("bits"))
    same(merged_groups(groups, spark.read.parquet(path("bits"))), channel_category_summary(whole))
    same(merged_accounts(accounts), account_summary(whole))


def test_cents_that_do_not_fit_fall_back_to_doubles_as_in_one_go(spark):
    rows = [raw(k, transaction_id=str(k), amount=6e16 + k * 128) for k in range(4)]
    parts = [processed(frame(spark, rows[:2])), processed(frame(spark, rows[2:])), processed(frame(spark, [raw(9, amount=1.5)]))]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    accounts = account_partials(parts[0]).unionByName(account_partials(parts[1])).unionByName(account_partials(parts[2]))
    got, expected = (df.select("total_amount").first()[0] for df in (merged_accounts(accounts), account_summary(whole)))
    assert abs(got - expected) <= 1e-12 * expected


def test_values_keep_their_numbers(spark, path):
    def number(values):
        rows = numbered(spark.createDataFrame([(v,) for v in values], "value string"), path("n"), parts=2)
        return {r.value: (r.part, r.number) for r in rows.collect()}

    first = number(["a", "b", None, "a", "c"])
    assert set(first) == {"a", "b", "c"} and len(set(first.values())) == 3
    assert number([]) == first
    more = number(["d", "a", "e", "f", "g"])
    assert {k: more[k] for k in first} == first and len(set(more.values())) == len(more) == 7
    # Dense in each part.
    for part in {p for p, _ in more.values()}:
        numbers = sorted(n for p, n in more.values() if p == part)
        assert numbers == list(range(1, len(numbers) + 1))
    assert read_numbers(spark, path("nothing")).collect() == []


@pytest.fixture
def load(spark, path):
    def run(load_id, rows):
        write_lines(path(f"raw-{load_id}"), f"{len(rows)}.json", rows)
        return list(load_batch(read_raw(spark, path(f"raw-{load_id}")), path("p"), load_id, partials_path=path("parts")))

    return run


def rebuilt(spark, path, days):
    return build_curated(spark, path("p"), path("c"), days, path("parts"))


def test_a_second_load_reads_no_row_of_the_first(spark, path, load):
    first, late = events(1, 150), events(2, 40)
    days = load("0", first)
    rebuilt(spark, path, days)
    rows = read_processed(spark, path("p")).collect()
    # The first load's rows are gone altogether.
    shutil.rmtree(path("p"))
    touched = load("1", late)
    result = rebuilt(spark, path, touched)
    whole = spark.createDataFrame(rows, read_processed(spark, path("p")).schema).unionByName(read_processed(spark, path("p")))
    same(read_channel_category_summary(spark, path("c")), channel_category_summary(whole))
    same(read_account_summary(spark, path("c")), account_summary(whole))
    assert result.records == 190


def test_a_load_that_runs_again_replaces_its_part(spark, path, load):
    load("0", events(1, 30))
    load("1", events(2, 30))
    again = [r for r in events(3, 20) if r["transaction_timestamp"] < "2026-01-02"]
    shutil.rmtree(path("raw-1"))
    load("1", again)
    days = sorted({r.transaction_date for r in read_processed(spark, path("p")).collect()})
    rebuilt(spark, path, days)
    same(read_account_summary(spark, path("c")), account_summary(read_processed(spark, path("p"))))
    # Without any valid row it leaves no part.
    shutil.rmtree(path("raw-1"))
    load("1", [raw(amount=None)])
    parts = read_partials(spark, path("parts"), days)
    assert {r.load_id for r in parts["groups"].collect()} == {"0"}


def test_parts_of_many_loads_merge_into_few_files(spark, path, load):
    for k in range(3):
        days = load(str(k), events(k, 40))
    before = [sorted(map(str, df.collect())) for df in summaries(read_partials(spark, path("parts"), days))]
    compact_partials(spark, path("parts"), days)
    parts = read_partials(spark, path("parts"), days)
    assert [sorted(map(str, df.collect())) for df in summaries(parts)] == before
    assert all(len(parts[n].inputFiles()) <= 2 * len(days) for n in TABLES)


def test_days_without_parts(spark, path, load):
    assert read_partials(spark, path("parts"), [__import__("datetime").date(2020, 1, 1)]) is None
    days = load("0", [raw(merchant_name=None)])
    assert rebuilt(spark, path, days).records == 1
    row = read_channel_category_summary(spark, path("c")).first()
    assert (row.unique_accounts, row.unique_merchants) == (1, 0)
    assert build_curated(spark, path("p"), path("c"), [__import__("datetime").date(2020, 1, 1)], path("parts")) is None


def test_a_stream_rebuilds_from_parts(spark, path):
    for k in range(2):
        write_lines(path("raw"), f"{k}.json", events(k, 30))
        loading(
            spark, path("raw"), path("p"), path("ck"), curated_path=path("c"), partials_path=path("parts")
        ).awaitTermination()
    same(read_account_summary(spark, path("c")), account_summary(read_processed(spark, path("p"))))
    assert read_processed(spark, path("p")).agg(F.count("*")).first()[0] == 60
