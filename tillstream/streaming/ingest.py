"""Messages → raw layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import EVENT
from ..sources.codec import decode
from .start import plain_local_files, start

# The name of what an ingest stream counts while it writes; see ``streaming.progress``.
OBSERVED = "ingest"
HOUR_KEYS = ("year", "month", "day", "hour")


def raw_rows(messages: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """Decoded messages with ingest time, offset, partition and the hour they go to.

    The ingest time is that of the micro-batch; a replayed batch keeps it, and
    with it its directory. Messages that are no JSON objects stay, as ``_bad_value``.
    """
    now = F.current_timestamp()
    # JSON files hold the time as naive UTC text, like the messages themselves.
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.to_timestamp_ntz(now))
    parts = dict(zip(HOUR_KEYS, ("yyyy", "MM", "dd", "HH")))
    rows = decode(messages.select("value", "partition", "offset"), schema)
    return rows.select(
        *schema.fieldNames(),
        F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_ingestion_timestamp"),
        F.col("offset").alias("_kafka_offset"),
        F.col("partition").alias("_kafka_partition"),
        "_extra",
        "_bad_value",
        *[F.date_format(utc, pattern).alias(name) for name, pattern in parts.items()],
    )


def ingest(
    messages: DataFrame,
    raw_path: str,
    checkpoint: str,
    every: str | None = None,
    max_records_per_file: int | None = None,
    schema: T.StructType = EVENT,
) -> StreamingQuery:
    """Append a message stream to the raw layer as JSON lines in hourly directories.

    The size of a micro-batch is an option of the source; the last, smaller one is
    written like any other. Rows and unreadable messages are observed as ``OBSERVED``.
    Files on local disks get no checksum files; see ``plain_local_files``.
    """
    counts = F.count("*").alias("rows"), F.count("_bad_value").alias("bad_rows")
    writer = (
        raw_rows(messages, schema)
        .observe(OBSERVED, *counts)
        .writeStream.format("json")
        .outputMode("append")
        .partitionBy(*HOUR_KEYS)
        .option("path", raw_path)
        .option("ignoreNullFields", "false")
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with plain_local_files(messages.sparkSession):
        return start(writer, checkpoint, every)
