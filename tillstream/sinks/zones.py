"""Writing the processed and curated layers.

Every write replaces exactly the partitions it owns, so a repeated run leaves the
same files as a single one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PROCESSED
from ..sources.live import begin_load, take_out


def _overwrite_partitions(df: DataFrame, path: str, by: list[str], **options: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .options(**options)
        .partitionBy(*by)
        .parquet(path)
    )


def write_load(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    column: str,
    load_id: str,
    again: bool | None = None,
    sort: tuple[str, ...] = (),
    **options: str,
) -> None:
    """Add one load to a table of loads. A load that runs again replaces its own rows only, all
    of them: what it wrote the first time and has no rows for now is dropped too.

    ``again`` says whether it may have run before; without it the table's own mark tells.
    ``sort`` orders the rows of each file.
    """
    spark = df.sparkSession
    if again is None:
        again = not begin_load(spark, path, load_id)
    if again:
        take_out(spark, path, column, load_id)
    missing = [f for f in schema.fields if f.name not in df.columns]
    rows = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df
    # Rebalancing gathers a directory's rows into few files and splits a big one over
    # many tasks; without it every task would leave a file in every directory.
    rows = rows.withColumn("load_id", F.lit(load_id)).select(*schema.fieldNames()).hint("rebalance", column)
    if sort:
        rows = rows.sortWithinPartitions(column, "load_id", *sort)
    _overwrite_partitions(rows, path, [column, "load_id"], **options)


def write_processed(df: DataFrame, path: str, load_id: str, again: bool | None = None) -> None:
    """Append one load to the processed layer, by day."""
    write_load(df, path, PROCESSED, "transaction_date", load_id, again)


def write_days(df: DataFrame, path: str) -> None:
    """Replace the days in ``df`` and leave all others."""
    _overwrite_partitions(df.hint("rebalance", "transaction_date"), path, ["transaction_date"])
