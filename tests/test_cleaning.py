from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.rows import frame, raw
from tillstream.operators.cleaning import processed
from tillstream.operators.keys import dedupe_transactions, hot_keys, keep_first, not_seen_in, split_hot


def one(spark, **changes):
    rows = processed(frame(spark, [raw(**changes)])).collect()
    return rows[0] if rows else None


@pytest.mark.parametrize(
    "amount,bucket,high",
    [
        (499.99, "LOW", False),
        (500, "MEDIUM", False),
        (2999.99, "MEDIUM", False),
        (3000, "HIGH", False),
        (7999.99, "HIGH", False),
        (8000, "VERY_HIGH", False),
        (8000.01, "VERY_HIGH", True),
    ],
)
def test_amount_edges(spark, amount, bucket, high):
    row = one(spark, amount=amount)
    assert (row.amount_bucket, row.is_high_value) == (bucket, high)
    assert isinstance(row.amount, float)


@pytest.mark.parametrize(
    "changes",
    [
        {"amount": None},
        {"amount": "NaN"},
        {"amount": "abc"},
        {"transaction_timestamp": "notatime"},
        {"transaction_timestamp": None},
        {"transaction_id": None},
        {"account_id": None},
        {"transaction_status": None},
    ],
)
def test_invalid_rows_are_dropped(spark, changes):
    assert one(spark, **changes) is None


def test_optional_columns_may_be_null(spark):
    row = one(spark, channel=None, balance_after_transaction=None, transaction_type=None)
    assert row.channel is None and row.balance_after_transaction is None
    assert row.is_debit is False


def test_failed_flag_minds_case(spark):
    assert one(spark, transaction_status="FAILED").is_failed is True
    assert one(spark, transaction_status="failed").is_failed is False


def test_time_without_fraction(spark):
    row = one(spark, transaction_timestamp="2026-01-04T23:04:05")
    assert str(row.transaction_date) == "2026-01-04"
    assert row.transaction_hour == 23
    assert row.transaction_day_of_week == 1  # a Sunday


def test_bad_offsets_are_null(spark):
    assert one(spark, _kafka_offset="x")._kafka_offset is None


def test_invalid_copy_does_not_shadow_a_valid_one(spark):
    rows = [raw(0, transaction_id="a", amount=None), raw(1, transaction_id="a", amount=7)]
    kept = dedupe_transactions(processed(frame(spark, rows))).collect()
    assert [(r.transaction_id, r.amount) for r in kept] == [("a", 7.0)]


def test_first_delivery_survives(spark):
    rows = [raw(offset=o, transaction_id="a", amount=o + 1) for o in (5, 3, 11)]
    kept = dedupe_transactions(processed(frame(spark, rows))).collect()
    assert [r._kafka_offset for r in kept] == [3]


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = keep_first(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_validity_reaches_the_scan(spark, path):
    df = processed(frame(spark, [raw()]))
    df.write.parquet(path("p"))
    from tillstream.operators.cleaning import valid_only

    plan = valid_only(spark.read.parquet(path("p")))._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(account_id)" in plan.split("PushedFilters")[1]


def test_not_seen_in(spark):
    new = spark.createDataFrame([("a",), ("b",)], "transaction_id string")
    old = spark.createDataFrame([("a",), ("a",)], "transaction_id string")
    assert [r[0] for r in not_seen_in(new, old).collect()] == ["b"]


def test_split_hot_keeps_every_row(spark):
    keys = ["x"] * 6 + [None] * 4 + ["y", "z"]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    hot = hot_keys(df, "k", 3)
    assert [(r["k"], r["n"]) for r in hot] == [("x", 6), (None, 4)]
    many, few = split_hot(df, "k", hot)
    assert many.count() == 10
    assert sorted(r["k"] for r in few.collect()) == ["y", "z"]
