"""Starting streaming queries, and stopping those that have nothing left to do."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# A file sink takes its Hadoop settings from the session when it is started. The tasks would
# else get the file system that their executor has cached.
PLAIN_LOCAL_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}
_settings = threading.Lock()


@contextmanager
def plain_local_files(spark: SparkSession) -> Iterator[None]:
    """File sinks started meanwhile write files on local disks without a checksum file each.

    Without its native library Hadoop starts a process to set the mode of each local file that
    it creates, which takes far longer than writing a small one, and does so twice where it has
    a checksum file. Other stores are not concerned, nor is what is read or written elsewhere.
    A file must not replace one that has a checksum file; those of a sink have new names.
    """
    with _settings:
        before = {k: spark.conf.get(k, None) for k in PLAIN_LOCAL_FILES}
        try:
            for k, v in PLAIN_LOCAL_FILES.items():
                spark.conf.set(k, v)
            yield
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run continuously ``every`` interval, or drain what is there and stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stop_when_idle(
    query: StreamingQuery, idle: timedelta = timedelta(seconds=60), check_every: float = 0.5
) -> int:
    """Wait until no message came for ``idle``, then stop ``query``; returns its rows so far.

    For queries that run at an interval. Time counts from the end of the last micro-batch
    that had rows; while there is data, a micro-batch is never interrupted. Failures raise.
    """
    rows, batches, since = 0, set(), time.monotonic()
    while not query.awaitTermination(check_every):
        for progress in query.recentProgress:
            if progress.numInputRows and progress.batchId not in batches:
                batches.add(progress.batchId)
                rows += progress.numInputRows
                since = time.monotonic()
        if query.status["isDataAvailable"]:
            since = time.monotonic()
        elif time.monotonic() - since >= idle.total_seconds():
            query.stop()
    return rows
