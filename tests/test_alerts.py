from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.rows import frame, messages, raw, txn
from tillstream.operators.alerts import (
    ALERT_COLUMNS,
    alert_events,
    alert_metrics,
    ok_events,
    unmatched_events,
)
from tillstream.operators.lookups import lookup, size_in_bytes
from tillstream.operators.messages import with_messages
from tillstream.settings import Rules, Sender
from tillstream.sources.codec import decode, encode, good, quarantine


@pytest.fixture(scope="module")
def master(spark):
    return spark.createDataFrame(
        [("AC100001", "Asha", "asha@example.com")], "account_id string, user_name string, user_email string"
    )


def kinds(spark, master, **changes):
    event = decode(messages(spark, [txn(**changes)]))
    return [r.alert_type for r in alert_events(event, master).collect()]


def is_ok(spark, master, **changes):
    return ok_events(decode(messages(spark, [txn(**changes)])), master).count() == 1


@pytest.mark.parametrize(
    "changes,expected,ok",
    [
        ({"amount": 9000}, [], True),
        ({"amount": 9000.01}, ["HIGH_VALUE"], False),
        ({"balance_after_transaction": 100}, [], True),
        ({"balance_after_transaction": 99.99}, ["LOW_BALANCE"], False),
        ({"amount": 9500, "transaction_status": "FAILED"}, ["HIGH_VALUE", "FAILED_TXN"], False),
        ({"amount": 9500, "balance_after_transaction": 50}, ["HIGH_VALUE", "LOW_BALANCE"], False),
        (
            {"transaction_type": "CREDIT", "balance_after_transaction": 50, "amount": 60},
            [],
            True,
        ),
        (
            {"transaction_status": "PENDING", "balance_after_transaction": 50, "amount": 60},
            [],
            False,
        ),
        ({"transaction_status": "failed"}, ["FAILED_TXN"], False),
        ({"transaction_status": "Success", "balance_after_transaction": 5}, ["LOW_BALANCE"], False),
        ({"transaction_type": "debit", "balance_after_transaction": 5}, [], True),
        ({"amount": None}, [], True),
        ({"amount": "9500"}, ["HIGH_VALUE"], False),
        ({"amount": float("nan")}, [], False),
        ({"amount": float("inf")}, ["HIGH_VALUE"], False),
        ({"balance_after_transaction": None}, ["LOW_BALANCE"], False),
        ({"transaction_status": None}, [], True),
        ({"account_id": "AC999999", "amount": 9500}, [], False),
        ({"account_id": None, "amount": 9500}, [], False),
    ],
)
def test_rules(spark, master, changes, expected, ok):
    assert kinds(spark, master, **changes) == expected
    assert is_ok(spark, master, **changes) == ok


def test_missing_fields_count_as_zero_or_empty(spark, master):
    event = {"account_id": "AC100001", "transaction_type": "DEBIT", "transaction_status": "SUCCESS"}
    alerts = alert_events(decode(messages(spark, [event])), master).select(*ALERT_COLUMNS)
    (row,) = with_messages(alerts).collect()
    assert (row.alert_type, row.amount) == ("LOW_BALANCE", 0.0)
    assert "₹0.00" in row.subject and row.body.startswith("Dear Asha,\n")


def test_thresholds_are_parameters(spark, master):
    event = decode(messages(spark, [txn(amount=60, balance_after_transaction=400)]))
    rules = Rules(alert_high_value=50, alert_low_balance=500)
    alerts = alert_events(event, master, rules).select(*ALERT_COLUMNS)
    rows = with_messages(alerts, rules, Sender(bank="B", currency_sign="$")).collect()
    assert [r.alert_type for r in rows] == ["HIGH_VALUE", "LOW_BALANCE"]
    assert rows[0].subject == "🚨 B Alert: Large Transaction of $60.00 on your account"
    assert "has dropped below $500.00." in rows[1].body


def test_message_keeps_the_status_and_time_as_sent(spark, master):
    event = txn(amount=12345.5, transaction_status="Success", transaction_timestamp="2026-01-02T03:04:05")
    alerts = alert_events(decode(messages(spark, [event])), master).select(*ALERT_COLUMNS)
    (row,) = with_messages(alerts).collect()
    lines = row.body.split("\n")
    pad = " " * 16
    assert lines[1] == pad
    assert pad + "  Status              : Success" in lines
    assert pad + "  Timestamp           : 2026-01-02T03:04:05 UTC" in lines
    assert pad + "  Amount              : ₹12,345.50" in lines
    assert lines[-1] == pad + "Example Bank Fraud & Alerts Team"


def test_unmatched(spark, master):
    events = decode(
        messages(spark, [txn(), txn(account_id="AC9"), txn(account_id=None), txn(account_id="AC9")])
    )
    assert sorted(str(r.account_id) for r in unmatched_events(events, master).collect()) == [
        "AC9",
        "AC9",
        "None",
    ]


def test_metrics(spark, master):
    events = decode(messages(spark, [txn(amount=9500, transaction_status="FAILED"), txn(), txn()]))
    row = alert_metrics(events, alert_events(events, master)).first()
    assert tuple(row) == (3, 2, 1, 1, 0)


def test_metrics_of_nothing(spark, master):
    events = decode(messages(spark, [txn()])).limit(0)
    assert tuple(alert_metrics(events, alert_events(events, master)).first()) == (0, 0, 0, 0, 0)


# --- lookups ---------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to one account, a sixth to none."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 6 == 1, None).otherwise(F.concat(F.lit("k"), n % 20))
    return spark.range(600).select("id", key.alias("k"))


@pytest.mark.parametrize("how", ["inner", "left_anti"])
@pytest.mark.parametrize("dim_keys", [["hot", "k1", "k2", "k5"], ["k2", "k4"], []])
def test_all_ways_agree(spark, skewed, how, dim_keys):
    dim = spark.createDataFrame([(k, k.upper()) for k in dim_keys], "k string, v string")

    def rows(**options):
        return sorted(map(str, lookup(skewed, dim, "k", how, **options).collect()))

    small = rows()
    assert small == sorted(map(str, skewed.join(dim if how == "inner" else dim.select("k"), "k", how).collect()))
    assert rows(broadcast_bytes=-1, hot_rows=50) == small
    assert rows(broadcast_bytes=-1, hot_rows=10_000) == small


def test_only_a_measured_side_is_broadcast(spark, skewed):
    dim = spark.range(5).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("x").alias("v"))
    assert size_in_bytes(dim) == 5 * (64 + 2 + 1)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        def plan(**o):
            return lookup(skewed, dim, "k", **o)._jdf.queryExecution().executedPlan().toString()

        assert "BroadcastHashJoin" in plan()
        assert "BroadcastHashJoin" not in plan(broadcast_bytes=100)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


# --- codec -----------------------------------------------------------------


def test_decode_sorts_out_bad_messages(spark):
    bad = [
        "{bad",
        "5",
        "[1]",
        "[{}]",
        "",
        '"text"',
        "null",
        '{"amount": 1} x',
        '{"amount": 1}{"amount": 2}',
        '{"amount": 1},{"amount": 2}',
        "{'amount': 1}",
    ]
    decoded = decode(messages(spark, [txn(), {}, ' {"amount":\n1} ', None, *bad]))
    assert good(decoded).count() == 3
    assert sorted(r._bad_value for r in quarantine(decoded).collect()) == sorted(["", *bad])
    assert quarantine(decoded).filter("coalesce(amount, _extra) is not null").count() == 0


def test_decode_is_lenient_about_types_and_keeps_unknown_fields(spark):
    event = txn(amount="12.5", balance_after_transaction=7, risk={"score": [1, 2.5]}, note=None)
    (row,) = good(decode(messages(spark, [event]))).collect()
    assert (row.amount, row.balance_after_transaction) == ("12.5", "7")
    assert row._extra == '{"risk":{"score":[1,2.5]},"note":null}'
    assert good(decode(messages(spark, [txn()]))).first()._extra is None
    event = txn(amount=float("nan"), risk=1)
    assert good(decode(messages(spark, [event]))).first()._extra == '{"risk":1}'


def test_encode_keeps_nulls_and_microseconds(spark):
    rows = frame(spark, [raw(channel=None)]).withColumn(
        "transaction_timestamp", F.to_timestamp("transaction_timestamp")
    )
    row = encode(rows, keep=["_kafka_offset"]).first()
    assert row.key == "AC100001" and row._kafka_offset == "0"
    assert '"channel":null' in row.value and "_kafka_offset" not in row.value
    assert '"transaction_timestamp":"2026-01-02T03:04:05.000006"' in row.value


def test_a_message_is_parsed_once(spark, master):
    events = good(decode(messages(spark, [txn()]).select("value")))
    alerts = alert_events(events, master).select(*ALERT_COLUMNS)
    plan = alerts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_a_bucketed_master_is_not_shuffled(spark):
    from tillstream.operators.lookups import lookup
    from tillstream.sources.master import save_master

    rows = [(f"A{i}", f"N{i}", f"{i}@x") for i in range(200)]
    save_master(spark.createDataFrame(rows, "account_id string, user_name string, user_email string"), "big_master", 8)
    events = spark.createDataFrame([(i, f"A{i % 300}") for i in range(900)] + [(901, None)], "n int, account_id string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a large one
    try:
        for how, expected in (("inner", 600), ("left_anti", 301)):
            found = lookup(events, spark.table("big_master"), "account_id", how, broadcast_bytes=0, hot_rows=10**6)
            plan = found._jdf.queryExecution().executedPlan().toString()
            scan = next(i for i, line in enumerate(plan.splitlines()) if "big_master" in line)
            exchanges = [i for i, line in enumerate(plan.splitlines()) if "Exchange" in line]
            # One exchange, on the side of the events, above which the master's scan does not lie.
            assert len(exchanges) == 1 and exchanges[0] < scan and "Bucketed: true" in plan, plan
            assert "SortMergeJoin" in plan and found.count() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP TABLE big_master")
