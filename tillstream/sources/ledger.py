"""The ledger: which raw files were loaded, by which load.

A directory ``loads=<first>-<last>`` has the entries of these loads and counts once it is
whole (Spark's success file is there). A hundred directories of one size become one, so after
any number of loads there are a few hundred of them, and an entry is rewritten as often as
the number of loads has pairs of digits.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LEDGER
from .files import drop_path, found_paths

MERGE = 100


def _ranges(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The directories that count, in order; those inside another one don't."""
    found = []
    for file in found_paths(spark, f"{path}/loads=*/_SUCCESS"):
        first, last = file.split("/")[-2].removeprefix("loads=").split("-")
        found.append((int(first), int(last)))
    found.sort(key=lambda r: (r[0], -r[1]))
    out: list[tuple[int, int]] = []
    for r in found:
        if not out or r[1] > out[-1][1]:
            out.append(r)
    return out


def _read(spark: SparkSession, path: str, ranges: list[tuple[int, int]]) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(*[f"{path}/loads={a}-{b}" for a, b in ranges])


def read_ledger(spark: SparkSession, path: str, after: datetime | None = None) -> DataFrame:
    """``path``, ``modified``, ``load`` of the files loaded, with ``after`` only those modified later."""
    ranges = _ranges(spark, path)
    if not ranges:
        return spark.createDataFrame([], LEDGER)
    rows = _read(spark, path, ranges)
    return rows if after is None else rows.filter(F.col("modified") > F.lit(after))


def next_load(spark: SparkSession, path: str) -> int:
    """The number of the next load, from the directories' names; one that was not entered is not
    counted, so a load that died is run again under its number."""
    return max((last for _, last in _ranges(spark, path)), default=-1) + 1


def enter(files: DataFrame, path: str, load: int) -> None:
    """Enter ``files`` as loaded."""
    rows = files.select("path", "modified", F.lit(load).cast("long").alias("load"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/loads={load}-{load}")
    _merge(files.sparkSession, path)


def _merge(spark: SparkSession, path: str) -> None:
    size = 1
    while True:
        ranges = _ranges(spark, path)
        same = [r for r in ranges if r[1] - r[0] + 1 == size]
        if len(same) < MERGE:
            if size > max(b - a + 1 for a, b in ranges):
                break
            size *= MERGE
            continue
        taken = same[:MERGE]
        _read(spark, path, taken).write.mode("overwrite").parquet(f"{path}/loads={taken[0][0]}-{taken[-1][1]}")
        size *= MERGE
    # What is inside another directory, also of a run that died before it got here.
    live = set(_ranges(spark, path))
    for folder in found_paths(spark, f"{path}/loads=*"):
        first, last = folder.rsplit("=", 1)[1].split("-")
        if (int(first), int(last)) not in live and any(a <= int(first) and int(last) <= b for a, b in live):
            drop_path(spark, folder)
