"""Alerts whose delivery failed, sent again until it succeeds.

The outbox has one row for each time an alert was tried. A run takes the alerts that failed in
micro-batches that no run has seen, and those that failed in the run before, and writes how it
went as a batch of its own. What each run has seen is a small file beside the outbox, so a
run reads new micro-batches and open alerts, not the whole outbox.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import keep_first
from ..sources.files import exists, found_paths, write_text

RUNS = "redelivery"
MOST_ATTEMPTS = 5


@dataclass(frozen=True)
class RedeliveryResult:
    tried: int
    delivered: int
    given_up: int


def alert_id() -> Column:
    """The same for each try of an alert, and for the alert of a message that came twice."""
    parts = [F.coalesce(c, F.lit("")) for c in ("transaction_id", "account_id", "alert_type")]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def _seen(spark: SparkSession, outbox: str) -> tuple[int, dict[str, int]]:
    """The last run that ended, and the last micro-batch of each stream that it knew."""
    files = sorted(found_paths(spark, f"{outbox}/_redelivered/*.json"))
    if not files:
        return -1, {}
    text = spark.read.text(files[-1], wholetext=True).first()[0]
    return int(files[-1].rsplit("/", 1)[1].removesuffix(".json")), json.loads(text)


def _new_batches(spark: SparkSession, outbox: str, seen: dict[str, int]) -> tuple[list[str], dict[str, int]]:
    """Micro-batches that are whole and were not seen, and the last one of each stream."""
    new, last = [], dict(seen)
    for file in found_paths(spark, f"{outbox}/query_id=*/batch_id=*/_SUCCESS"):
        folder = file.rsplit("/", 1)[0]
        query, batch = (part.split("=", 1)[1] for part in folder.rsplit("/", 2)[1:])
        if query != RUNS and int(batch) > seen.get(query, -1):
            new.append(folder)
            last[query] = max(last.get(query, -1), int(batch))
    return new, last


def open_alerts(spark: SparkSession, outbox: str) -> DataFrame | None:
    """Alerts to send again, one row for each, with ``alert_id`` and ``attempts`` so far."""
    run, seen = _seen(spark, outbox)
    new, _ = _new_batches(spark, outbox, seen)
    frames = []
    if new:
        rows = spark.read.parquet(*new).filter("delivered is not null")
        frames.append(rows.withColumns({"alert_id": alert_id(), "attempts": F.lit(1)}))
    last = f"{outbox}/query_id={RUNS}/batch_id={run}"
    if run >= 0 and exists(spark, f"{last}/*.parquet"):
        frames.append(spark.read.parquet(last).filter("not delivered"))
    if not frames:
        return None
    rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)
    failed = keep_first(rows.filter("not delivered"), ["alert_id"], [F.desc("attempts"), F.col("transaction_timestamp")])
    # A message that came twice may have been sent all the same.
    return failed.join(rows.filter("delivered").select("alert_id").distinct(), "alert_id", "left_anti")


def redeliver(
    spark: SparkSession,
    outbox: str,
    deliver: Callable[[DataFrame], DataFrame],
    most_attempts: int = MOST_ATTEMPTS,
) -> RedeliveryResult:
    """Try once more what failed so far; call it at intervals, one run at a time.

    ``deliver`` is given the alerts and returns them with ``delivered`` set, like that of
    ``alerting``. ``alert_id`` is the same each time, so that a receiver can tell a repeat: a run
    that dies after it sent something sends it again. Alerts that failed ``most_attempts`` times
    are given up and stay in the outbox as not delivered.
    """
    run, seen = _seen(spark, outbox)
    _, last = _new_batches(spark, outbox, seen)
    rows = open_alerts(spark, outbox)
    if rows is None:
        return RedeliveryResult(0, 0, 0)
    folder = f"{outbox}/query_id={RUNS}/batch_id={run + 1}"
    todo = rows.filter(F.col("attempts") < most_attempts)
    sent = deliver(todo.withColumn("attempts", F.col("attempts") + 1)).persist(StorageLevel.DISK_ONLY)
    try:
        # Written from what was kept, so that nothing is sent twice by a second reading.
        sent.write.mode("overwrite").parquet(folder)
    finally:
        sent.unpersist()
    write_text(spark, f"{outbox}/_redelivered/{run + 1:010d}.json", json.dumps(last))
    done = spark.read.schema(sent.schema).parquet(folder)
    tried, delivered, given_up = done.agg(
        F.count("*"),
        F.count_if("delivered"),
        F.count_if(~F.col("delivered") & (F.col("attempts") >= most_attempts)),
    ).first()
    return RedeliveryResult(tried, delivered, given_up)
