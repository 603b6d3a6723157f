"""Event → dimension lookups, safe for a large dimension and for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import hot_keys, split_hot

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 5_000_000


def size_in_bytes(df: DataFrame) -> int:
    """Size of the data as text plus a fixed cost per row."""
    row = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(64))
    return df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("b")).first()["b"]


def lookup(
    events: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join events to a dimension with one row per key (``inner`` or ``left_anti``).

    The dimension is broadcast when its measured size allows (0 means never, and then it is not
    measured). Otherwise rows of
    hot keys join a broadcast of just those dimension rows (fewer than events /
    ``hot_rows``), NULL keys skip the join, and the rest is shuffled by key. A dimension that is
    a table bucketed by the key stays where it is; only events are shuffled to its buckets.
    """
    if how not in ("inner", "left_anti"):
        raise ValueError(f"unsupported lookup: {how}")
    if how == "left_anti":
        dim = dim.select(key)
    if broadcast_bytes > 0 and size_in_bytes(dim) <= broadcast_bytes:
        return events.join(F.broadcast(dim), key, how)

    keyed = events.filter(F.col(key).isNotNull())
    hot = hot_keys(keyed, key, hot_rows)
    if hot:
        hot_events, other = split_hot(keyed, key, hot)
        hot_dim, _ = split_hot(dim, key, hot)
        out = other.join(dim, key, how).unionByName(
            hot_events.join(F.broadcast(hot_dim), key, how)
        )
    else:
        out = keyed.join(dim, key, how)
    if how == "left_anti":
        out = out.unionByName(events.filter(F.col(key).isNull()).select(*out.columns))
    return out
