"""What each micro-batch did, as the run itself counts it.

Streams observe their rows while they write them (``observe``); Spark reports the numbers with
the progress of the micro-batch, and a listener writes each report as one small file. So
counting takes no pass of its own, and a micro-batch that runs again replaces its report.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sources.files import exists, write_text

SCHEMA = (
    "query_id string, batch_id bigint, at string, input_rows bigint, start_offset string, "
    "end_offset string, observed map<string,map<string,bigint>>"
)


class ProgressLog(StreamingQueryListener):
    """Writes a file ``<path>/<query id>/<batch id>.json`` for each micro-batch with rows.

    Add it with ``spark.streams.addListener``; it hears all queries of the session. Reports come
    after the micro-batch is committed, so one that dies in between leaves none.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        row = {
            "query_id": str(p.id),
            "batch_id": p.batchId,
            "at": p.timestamp,
            "input_rows": p.numInputRows,
            "start_offset": json.dumps([s.startOffset for s in p.sources]),
            "end_offset": json.dumps([s.endOffset for s in p.sources]),
            "observed": {name: row.asDict() for name, row in p.observedMetrics.items()},
        }
        write_text(self.spark, f"{self.path}/{p.id}/{p.batchId:010d}.json", json.dumps(row))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All reports so far, a row for each micro-batch."""
    if not exists(spark, f"{path}/*/*.json"):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(f"{path}/*/*.json")
