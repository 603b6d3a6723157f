"""Fixity audit of WARC replicas by Merkle trees over ordered offset ranges.

A record's leaf is the digest of its bytes at its file and offset. Records are grouped
by ranges of ``RANGE`` bytes of their file; a range's hash covers its records in order
of their offsets, and a node above covers ``FANOUT`` neighbouring ranges. Ranges, not
counts, make the tree, so a large file is spread over many groups, and a lost record
changes one branch only. Replicas are compared at the roots; children are looked up only
below nodes that differ, and records only in ranges that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.llm.common import kept

RANGE = 1 << 16
FANOUT = 16
PAGES_PER_FILE = 1_000


def record_bytes(url: Column, payload: Column, name: Column, date: str = "2026-01-01T00:00:00Z") -> Column:
    """A WARC/1.1 resource record around ``payload``; nulls are empty."""
    payload = F.coalesce(payload, F.lit(""))
    lines = [
        F.lit("WARC/1.1"),
        F.lit("WARC-Type: resource"),
        F.concat(F.lit("WARC-Record-ID: <urn:md5:"), F.md5(name), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.coalesce(url, F.lit(""))),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def page_records(pages: DataFrame, stored: Column | None = None, per_file: int = PAGES_PER_FILE) -> DataFrame:
    """``file``, ``offset``, ``length``, ``record``, ``digest`` of the pages laid out as WARC files.

    Files hold the pages of ``per_file`` ids in a row (null ids: file -1), in order of id, url
    and digest. ``stored`` is the payload that a replica holds, of the same length, or null
    if it has lost the record; offsets are those of the layout. Pages are hashed where they
    are read; only digests and lengths are shuffled.
    """
    name = F.concat_ws(" ", F.col("page_id").cast("string"), "url")
    whole = record_bytes(F.col("url"), F.col("html"), name)
    rows = pages.select(
        F.coalesce(F.floor(F.col("page_id") / per_file), F.lit(-1)).alias("file"),
        F.col("page_id").alias("record"),
        "url",
        F.octet_length(whole).cast("long").alias("length"),
        F.sha2(whole, 256).alias("original"),
        F.sha2(record_bytes(F.col("url"), stored, name), 256).alias("digest")
        if stored is not None
        else F.sha2(whole, 256).alias("digest"),
        F.lit(False).alias("lost") if stored is None else (stored.isNull() & F.col("html").isNotNull()).alias("lost"),
    )
    before = Window.partitionBy("file").orderBy("record", "url", "original").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
        .filter(~F.col("lost"))
        .select("file", "offset", "length", "record", "digest")
    )


def _node(children: Column) -> Column:
    return F.sha2(F.array_join(F.transform(F.array_sort(children), lambda c: F.concat_ws(":", *[c[k] for k in ("at", "hash")])), ","), 256)


def range_hashes(records: DataFrame, width: int = RANGE) -> DataFrame:
    """``file``, ``node``, ``hash`` of each range that holds the start of a record.

    A range holds at most as many records as fit in its bytes.
    """
    leaf = F.struct(F.col("offset").alias("at"), F.concat_ws("+", "length", "digest").alias("hash"))
    return (
        records.groupBy("file", F.floor(F.col("offset") / width).alias("node"))
        .agg(F.collect_list(leaf).alias("leaves"))
        .select("file", "node", _node(F.col("leaves")).alias("hash"))
    )


def parents(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The level above: at most ``fanout`` children make a node."""
    child = F.struct(F.col("node").alias("at"), "hash")
    return (
        nodes.groupBy("file", F.floor(F.col("node") / fanout).alias("up"))
        .agg(F.collect_list(child).alias("children"))
        .select("file", F.col("up").alias("node"), _node(F.col("children")).alias("hash"))
    )


def _tree(records: DataFrame, levels: int, width: int, fanout: int) -> list[DataFrame]:
    tree = [kept(range_hashes(records, width), "ranges")]
    for _ in range(levels):
        tree.append(kept(parents(tree[-1], fanout), "nodes"))
    return tree


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    one = a.select("file", "node", F.col("hash").alias("one"))
    two = b.select("file", "node", F.col("hash").alias("two"))
    return one.join(two, ["file", "node"], "full").filter(~F.col("one").eqNullSafe(F.col("two"))).select("file", "node")


def audit(
    first: DataFrame, second: DataFrame, width: int = RANGE, fanout: int = FANOUT
) -> DataFrame:
    """``file``, ``offset``, ``record``, ``status`` of every record that the replicas don't share.

    Both are tables of ``file`` (not null), ``offset``, ``length``, ``record``, ``digest``; an offset holds
    one record of a file. ``status`` is ``corrupt`` (other bytes or length), ``missing`` (only
    in the first) or ``extra`` (only in the second); a null digest is a value of its own. Equal
    replicas, also empty ones, give no rows. Other columns are not looked at.
    """
    first, second = kept(first, "records"), kept(second, "records")
    last = first.unionByName(second).agg(F.max("offset").alias("at")).first()["at"] or 0
    levels, span = 0, width
    while span <= last:
        levels, span = levels + 1, span * fanout
    one, two = (_tree(x, levels, width, fanout) for x in (first, second))
    differing = kept(_differing(one[-1], two[-1]), "differing")
    for level in range(levels - 1, -1, -1):
        below = [
            tree[level]
            .withColumn("up", F.floor(F.col("node") / fanout))
            .join(differing.select("file", F.col("node").alias("up")), ["file", "up"], "left_semi")
            for tree in (one, two)
        ]
        differing = kept(_differing(*below), "differing")
    a, b = (
        x.withColumn("node", F.floor(F.col("offset") / width))
        .join(differing, ["file", "node"], "left_semi")
        .select("file", "offset", F.struct("length", "digest").alias(f"is_{k}"), F.col("record").alias(f"record_{k}"))
        for k, x in (("a", first), ("b", second))
    )
    status = (
        F.when(F.col("is_b").isNull(), "missing").when(F.col("is_a").isNull(), "extra").otherwise("corrupt")
    )
    return (
        a.join(b, ["file", "offset"], "full")
        .filter(~F.col("is_a").eqNullSafe(F.col("is_b")))
        .select("file", "offset", F.coalesce("record_a", "record_b").alias("record"), status.alias("status"))
    )
