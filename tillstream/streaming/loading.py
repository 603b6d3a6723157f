"""Raw layer → processed layer, as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.curate import build_curated
from ..plans.dirty import enter_days
from ..plans.load import LOAD, LoadResult, load_batch, parsed_once, summarise
from ..settings import Rules
from ..sinks.outbox import query_id, write_batch
from ..sources.live import end_loads, open_loads
from ..sources.zones import split_bad, stream_raw
from .start import start


def loading(
    spark: SparkSession,
    raw_path: str,
    processed_path: str,
    checkpoint: str,
    curated_path: str | None = None,
    dirty_path: str | None = None,
    quarantine_path: str | None = None,
    metrics_path: str | None = None,
    max_files: int | None = None,
    every: str | None = None,
    rules: Rules = Rules(),
    unique_within: str = LOAD,
    partials_path: str | None = None,
) -> StreamingQuery:
    """Load every raw file once. With ``curated_path``, rebuild each day a load
    touched, however old it is; with ``dirty_path``, only enter it there, for
    ``curate_dirty`` at a time of its own, which is what short intervals need. With
    ``metrics_path``, write one row of counts per micro-batch.

    Loads are named after the stream and its batch, so several streams can feed one
    table, and a new checkpoint replaces nothing.

    Transactions are de-duplicated within a micro-batch, which holds all new files
    unless ``max_files`` is set; ``unique_within`` extends that to earlier ones. With
    ``partials_path`` days are rebuilt from what each load left there, not from their rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prefix = f"s{query_id(spark)}-"
        load_id = f"{prefix}{batch_id}"
        # A micro-batch begins when those before it are committed.
        begun = open_loads(spark, processed_path, prefix)
        end_loads(spark, processed_path, [x for x in begun if x != load_id])
        with parsed_once(batch) as raw:
            seen = summarise(raw, rules)
            days = load_batch(
                raw, processed_path, load_id, rules, unique_within, seen.days, partials_path
            )
            if quarantine_path:
                write_batch(split_bad(raw)[1], quarantine_path, batch_id)
            files = raw.select("_file").distinct().count() if metrics_path else 0
        if days and dirty_path:
            enter_days(spark, dirty_path, list(days))
        elif days and curated_path:
            build_curated(spark, processed_path, curated_path, list(days), partials_path)
        if metrics_path:
            write_batch(LoadResult(files, seen.rows, seen.bad, days).frame(spark), metrics_path, batch_id)

    stream = stream_raw(spark, raw_path, max_files)
    return start(stream.writeStream.foreachBatch(write), checkpoint, every)
