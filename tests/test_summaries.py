from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tests.rows import frame, raw
from tillstream.functions import exact_mean, exact_sum, money_parts, money_text
from tillstream.operators.cleaning import processed
from tillstream.operators.summaries import account_summary, channel_category_summary


def money(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    parts = df.agg(*money_parts(F.col("x"), "m"))
    return parts.select(exact_sum("m").alias("s"), exact_mean("m").alias("m")).first()


@pytest.mark.parametrize(
    "amounts,total,mean",
    [
        ([1.0, 1.01], 2.01, 1.01),  # 1.005 up
        ([-1.0, -1.01], -2.01, -1.01),  # away from zero
        ([0.1] * 10, 1.0, 0.1),
        ([None, 2.0], 2.0, 2.0),
        ([0.001, 0.002], 0.0, 0.0),  # not whole cents
        ([1.005, 1.005], 2.01, 1.01),
        ([None], None, None),
        ([9e300, 1.0], 9e300, 4.5e300),
        ([float("inf"), 1.0], float("inf"), float("inf")),
    ],
)
def test_exact_money(spark, amounts, total, mean):
    assert tuple(money(spark, amounts)) == (total, mean)


def test_exact_money_equals_decimal(spark):
    rng = random.Random(7)
    for _ in range(5):
        cents = [rng.randint(-10_000, 1_000_000) for _ in range(rng.randint(1, 60))]
        got = money(spark, [c / 100 for c in cents])
        total = Decimal(sum(cents)) / 100
        mean = (total / len(cents)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert (got.s, got.m) == (float(total), float(mean))


def test_money_text(spark):
    values = [0.0, 9876543.215, -2406.58, 1234.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(money_text(F.col("x"), "₹")).collect()]
    assert got == [f"₹{v:,.2f}" for v in values]


def test_null_keys_form_a_group_and_nulls_are_not_counted(spark):
    rows = [
        raw(0, transaction_id="a", channel=None, merchant_name=None),
        raw(1, transaction_id="b", channel=None, merchant_name="M"),
    ]
    (row,) = channel_category_summary(processed(frame(spark, rows))).collect()
    assert row.channel is None
    assert (row.total_transactions, row.unique_merchants, row.unique_accounts) == (2, 1, 1)


def test_latest_balance_breaks_ties_by_partition_then_offset(spark):
    late = "2026-01-02T23:00:00.000001"
    rows = [
        raw(9, transaction_id="a", balance_after_transaction=1, _kafka_partition=1),
        raw(7, transaction_id="b", balance_after_transaction=2, transaction_timestamp=late),
        raw(8, transaction_id="c", balance_after_transaction=3, transaction_timestamp=late),
        raw(
            2,
            transaction_id="d",
            balance_after_transaction=4,
            transaction_timestamp=late,
            _kafka_partition=3,
        ),
        raw(None, transaction_id="e", balance_after_transaction=5, transaction_timestamp=late),
    ]
    (row,) = account_summary(processed(frame(spark, rows))).collect()
    assert (row.latest_balance, row.min_balance, row.max_balance) == (4.0, 1.0, 5.0)


def test_largest_order_parts_do_not_overlap(spark):
    at = "2026-01-02T23:59:59.999999"
    rows = [
        raw(2**63 - 2, transaction_id="a", balance_after_transaction=1,
            transaction_timestamp=at, _kafka_partition=99_999_997),
        raw(0, transaction_id="b", balance_after_transaction=2,
            transaction_timestamp=at, _kafka_partition=99_999_998),
    ]
    (row,) = account_summary(processed(frame(spark, rows))).collect()
    assert row.latest_balance == 2.0


def test_failed_amount_and_its_namesake(spark):
    rows = [
        raw(0, transaction_id="a", amount=10.5, transaction_status="FAILED"),
        raw(1, transaction_id="b", amount=1.25, transaction_status="FAILED"),
        raw(2, transaction_id="c", amount=5, balance_after_transaction=None),
    ]
    (row,) = account_summary(processed(frame(spark, rows))).collect()
    assert (row.failed_count, row.total_failed_amount, row.failed_amount) == (2, 2, 11.75)
    assert row.total_amount == 16.75


@pytest.mark.parametrize("summary", [account_summary, channel_category_summary])
def test_summaries_hash_and_combine_before_the_shuffle(spark, summary):
    plan = summary(processed(frame(spark, [raw()])))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert plan.rindex("Exchange") < plan.rindex("partial_")
