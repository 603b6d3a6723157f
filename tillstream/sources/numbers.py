"""Numbers for values, for good: each value keeps the number it first got.

Values are dealt to parts by their hash and numbered 1, 2, … within a part, so numbers are
dense, which bitmaps need, and new values of all parts are numbered at once. A file of the
table is whole once it is seen and never changed, so a run that dies between two files loses
nothing: the values it wrote have their numbers. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .files import exists

SCHEMA = "value string, number bigint, part int"
PARTS = 64


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``value``, ``number``, ``part``; empty before the first."""
    if not exists(spark, f"{path}/part=*"):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def numbered(values: DataFrame, path: str, parts: int = PARTS) -> DataFrame:
    """Number the values of column ``value`` that have none yet; returns all numbers.

    NULL gets none. ``parts`` may change later: a value keeps its part and number.
    """
    spark = values.sparkSession
    known = read_numbers(spark, path)
    new = values.select("value").filter("value is not null").distinct().join(known, "value", "left_anti")
    part = F.pmod(F.xxhash64("value"), F.lit(parts)).cast("int")
    # As many rows as there are parts.
    last = known.groupBy("part").agg(F.max("number").alias("last"))
    order = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    rows = (
        new.withColumn("part", part)
        .withColumn("order", order)
        .join(F.broadcast(last), "part", "left")
        .select("value", (F.coalesce("last", F.lit(0)) + F.col("order")).cast("bigint").alias("number"), "part")
    )
    rows.write.mode("append").partitionBy("part").parquet(path)
    return read_numbers(spark, path)
