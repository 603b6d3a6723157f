from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.rows import frame, raw
from tillstream.operators import balances
from tillstream.operators.balances import current_balance, running_balance
from tillstream.operators.cleaning import typed

ORDER = ("transaction_timestamp", "_kafka_offset")


def events(spark, seed=3, n=400):
    """Half of the rows belong to one account, many of them at the same time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append(
            raw(
                i,
                transaction_id=str(i),
                account_id=rng.choice(["A", "A", "A", "B", "C", None]),
                amount=rng.randint(1, 10**6) / 100,
                transaction_type=rng.choice(["DEBIT", "CREDIT", "OTHER"]),
                transaction_status=rng.choice(["SUCCESS", "SUCCESS", "FAILED", None]),
                transaction_timestamp=f"2026-01-0{rng.randint(1, 3)}T00:00:0{rng.randint(0, 2)}",
            )
        )
    return rows


def expected(rows, opening):
    out, balance = {}, {}
    for r in sorted(rows, key=lambda r: (r["transaction_timestamp"], r["_kafka_offset"])):
        a = r["account_id"]
        cents = balance.get(a, opening)
        if r["transaction_status"] == "SUCCESS":
            move = round(r["amount"] * 100)
            cents += -move if r["transaction_type"] == "DEBIT" else move
        balance[a] = cents
        out[r["transaction_id"]] = cents / 100
    return out, balance


@pytest.mark.parametrize("split_rows", [1, 7, 60, 150, 10_000])
def test_running_balance_equals_a_loop(spark, split_rows):
    rows = events(spark)
    df = typed(frame(spark, rows))
    got = running_balance(df, F.lit(500_00), ORDER, split_rows=split_rows)
    assert got.columns == df.columns
    result = {r.transaction_id: r.balance_after_transaction for r in got.collect()}
    assert result == expected(rows, 500_00)[0]


def test_current_balance_is_the_last_running_one(spark):
    rows = events(spark)
    got = current_balance(typed(frame(spark, rows)), F.lit(500_00)).collect()
    assert {r.account_id: r.balance for r in got} == {
        k: v / 100 for k, v in expected(rows, 500_00)[1].items()
    }


def test_balance_may_go_negative(spark):
    rows = [raw(0, amount=100.25), raw(1, amount=1, transaction_status="FAILED")]
    got = running_balance(typed(frame(spark, rows)), F.lit(1), ORDER).collect()
    assert [r.balance_after_transaction for r in got] == [-100.24, -100.24]


def test_slices_survive_in_the_shared_folder(spark):
    import glob

    running_balance(typed(frame(spark, events(spark))), F.lit(0), ORDER, split_rows=50).count()
    assert glob.glob(spark.conf.get("spark.checkpoint.dir") + "/balance-slices-*/*.parquet")


@pytest.mark.parametrize("range_rows,files", [(1_000_000, 1), (40, None)])
def test_small_slices_share_a_task_and_a_file(spark, monkeypatch, range_rows, files):
    import glob

    monkeypatch.setattr(balances, "RANGE_ROWS", range_rows)
    found = spark.conf.get("spark.checkpoint.dir") + "/balance-slices-*"
    rows, old = events(spark), set(glob.glob(found))
    got = running_balance(typed(frame(spark, rows)), F.lit(500_00), ORDER, split_rows=3)
    result = {r.transaction_id: r.balance_after_transaction for r in got.collect()}
    assert result == expected(rows, 500_00)[0]
    (folder,) = set(glob.glob(found)) - old
    sizes = [r["count"] for r in spark.read.parquet(folder).groupBy("_slice").count().collect()]
    assert max(sizes) == 3 and len(sizes) >= sum(sizes) / 3 > 10
    written = len(glob.glob(folder + "/*.parquet"))
    assert written == files if files else 1 < written < len(sizes)
