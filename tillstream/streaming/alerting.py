"""Messages → alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.alerts import ALERT_COLUMNS, alert_events, alert_metrics, unmatched_events
from ..operators.messages import with_messages
from ..settings import Rules, Sender
from ..sinks.outbox import batch_path, write_batch
from ..sources.codec import decode, good, quarantine
from .start import start


def alerting(
    messages: DataFrame,
    load_master: Callable[[], DataFrame],
    outbox: str,
    checkpoint: str,
    unmatched: str | None = None,
    metrics: str | None = None,
    bad: str | None = None,
    deliver: Callable[[DataFrame], DataFrame] | None = None,
    every: str | None = None,
    rules: Rules = Rules(),
    sender: Sender = Sender(),
    large_master: bool = False,
) -> StreamingQuery:
    """Write one outbox row, with its message, per alert.

    ``load_master`` is called for every micro-batch, so changes to the master are
    seen. With ``large_master`` it is neither measured nor kept meanwhile; where it reads a table
    that ``save_master`` wrote, it is not shuffled either. ``unmatched`` receives the events of unknown accounts, ``bad`` the messages
    that are no JSON objects, ``metrics`` one row of counts per micro-batch.

    ``deliver`` is given the alerts and returns them with ``delivered``, true where the
    message went out; without it nothing is sent and ``delivered`` is NULL. A replayed
    micro-batch is delivered again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        messages = decode(batch.select("value")).persist(StorageLevel.DISK_ONLY)
        master, options = load_master(), {"broadcast_bytes": 0} if large_master else {}
        if not large_master:
            master = master.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events, poison = good(messages), quarantine(messages)
            alerts = alert_events(events, master, rules, **options).select(*ALERT_COLUMNS)
            alerts = with_messages(alerts, rules, sender)
            if deliver:
                alerts = deliver(alerts)
            else:
                alerts = alerts.withColumn("delivered", F.lit(None).cast("boolean"))
            write_batch(alerts, outbox, batch_id)
            if unmatched:
                write_batch(unmatched_events(events, master, **options), unmatched, batch_id)
            if bad:
                write_batch(poison.select(F.col("_bad_value").alias("bad_value")), bad, batch_id)
            if metrics:
                # What was sent is what the outbox now holds.
                sent = spark.read.parquet(batch_path(spark, outbox, batch_id))
                write_batch(alert_metrics(events, sent, poison), metrics, batch_id)
        finally:
            messages.unpersist()
            if not large_master:
                master.unpersist()

    return start(messages.writeStream.foreachBatch(write), checkpoint, every)
