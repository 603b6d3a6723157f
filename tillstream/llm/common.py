"""What the operators of this package share: tables, scratch tables, words of byte blocks."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import scratch
from tillstream.sources.files import drop_path

# Broadcasts are only asked for below this many rows of a few numbers each.
BROADCAST_ROWS = 500_000

# Rows of texts that go to Python together.
_BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Bytes that part words: of text in general, and of what is matched by letters and digits.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
# The same, after A-Z became a-z.
LOWERED_PUNCTUATION = PUNCTUATION[LOWER]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared scratch folder and read back, and where it is."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage ends there."""
    return written(df, name)[0]


def dropped(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        drop_path(spark, path)


def released(spark: SparkSession) -> None:
    """Let Spark drop the shuffles and broadcasts of plans that are done.

    Its cleaner does so when the driver's JVM collects the plans, which a driver with memory
    left puts off: after many small jobs they would add up there and on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bounded_batches(spark: SparkSession) -> None:
    """Send texts to Python ``BATCH_ROWS`` rows at a time where the session has Spark's default.

    Spark bounds a batch by rows only; with 10,000 whole texts, both its copy and Python's would
    hold as many for each task at a time.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows; counts no further than that."""
    return df.limit(limit + 1).count() <= limit


def even_keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers, one for each of ``n`` partitions that Spark's hash deals them to."""
    tried = spark.range(n * 20).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("part"))
    first = {r.part: r.id for r in tried.groupBy("part").agg(F.min("id").alias("id")).collect()}
    spare = iter(set(range(2 * n)) - set(first.values()))
    return [first[p] if p in first else next(spare) for p in range(n)]


def anti(left: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``left`` whose ``on`` is not in ``ids``; broadcasts ``ids`` if few, else shuffles."""
    return left.join(F.broadcast(ids) if small(ids) else ids, on, "left_anti")


def repeats(df: DataFrame, key: str) -> bool:
    """Whether ``key`` is null somewhere or occurs twice."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return not counts.filter(F.col(key).isNull() | (F.col("n") > 1)).isEmpty()


def one_row_per_id(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and ``text`` with one row for each key that is not null.

    Rows that repeat a key are one document; its smallest text that is not null counts.
    The rows of keys that occur once, as they should, are not shuffled.
    """
    rows = df.select(key, text).filter(F.col(key).isNotNull())
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    repeated = kept(counts.filter("n > 1").select(key), "repeated-keys")
    if repeated.isEmpty():
        return rows
    few = small(repeated)
    hint = F.broadcast(repeated) if few else repeated
    again = rows.join(hint, key, "left_semi").groupBy(key).agg(F.min(text).alias(text))
    return rows.join(hint, key, "left_anti").unionByName(again)


def row_key() -> list[Column]:
    """``id`` and ``h``: they name a row's text, also where ids are null or repeat."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(F.col("doc_id").isNull(), "text").alias("h"),
    ]


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*row_key(), "text")


def blocks(
    batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 19
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut into runs of rows with at most ``most`` bytes of text, or one row.

    Yields the rows, the bytes of their texts one after another, and the offset of each
    text in them, with the end of the last. A null text has no bytes.
    """
    for batch in batches:
        texts = pc.fill_null(batch.column(text), "").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
            last = min(max(last, first + 1), len(texts))
            own = offsets[first : last + 1]
            yield batch.slice(first, last - first), data[own[0] : own[-1]], own - own[0]
            first = last


def word_spans(
    data: np.ndarray, offsets: np.ndarray, parts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and each text's first word (and an end).

    ``parts`` says which bytes part words; the end of a text does so too.
    """
    word = ~parts[data]
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] = word[edges]
    ends[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3, on unsigned numbers."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_POWERS = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and do not overlap."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    from_start = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = from_start + np.repeat(starts, lengths)
    weights = _POWERS[from_start & 0xFFFF] + (from_start >> 16).astype(np.uint64)
    weights *= data[at].astype(np.uint64) + np.uint64(1)
    return mixed(np.add.reduceat(weights, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))
