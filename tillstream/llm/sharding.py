"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``CELLS`` equal cells. Each shard stands on it at ``virtual`` places;
a row belongs to the first place clockwise from its hash. A shard takes no more rows than
its capacity, which is an equal share (shares differ by one where they don't divide);
rows that find it full continue clockwise to the next shard with room. So counts are at
most one apart, and a change in the number of shards moves the rows of a changed arc and
the overflow only.

Walking the ring needs the number of rows in each cell, a table whose size is fixed, not
the rows. It yields cuts of the ring's order, at most one for each place and shard; rows
find theirs by their cell and their rank in it. DataFrame operations only.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CELLS = 1 << 16
VIRTUAL = 100
SHARDS = 40


def places(spark, shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise; ties go to the smaller shard.

    One more shard adds nodes of its own and moves none.
    """
    nodes = spark.range(shards * virtual).select(
        F.pmod(F.xxhash64(F.lit("node"), "id"), F.lit(CELLS)).alias("cell"),
        F.floor(F.col("id") / virtual).alias("shard"),
    )
    return sorted((r.cell, r.shard) for r in nodes.collect())


def walk(
    counts: dict[int, int], nodes: list[tuple[int, int]], shards: int
) -> list[tuple[int, int, int]]:
    """Cuts of the ring's order of rows: (first rank, rank after the last, shard).

    ``counts`` has the rows of each cell; ranks count rows clockwise from cell 0. An arc is
    the cells up to a node, from after the one before; the last arc wraps round, so it is
    two stretches of ranks.
    """
    total = sum(counts.values())
    room = {s: total // shards + (s < total % shards) for s in range(shards)}
    before = [0] * (CELLS + 1)
    for cell in range(CELLS):
        before[cell + 1] = before[cell] + counts.get(cell, 0)
    arcs: list[list[list[int]]] = []
    last = 0
    for cell, _ in nodes:
        arcs.append([[before[last], before[cell + 1]]])
        last = cell + 1
    arcs[0].insert(0, [before[last], total])
    cuts: list[tuple[int, int, int]] = []

    def take(arc: list[list[int]], shard: int) -> None:
        for stretch in arc:
            n = min(stretch[1] - stretch[0], room[shard])
            if n:
                cuts.append((stretch[0], stretch[0] + n, shard))
                stretch[0] += n
                room[shard] -= n

    for arc, (_, shard) in zip(arcs, nodes, strict=True):
        take(arc, shard)
    # What a full shard could not take goes on clockwise.
    for k, arc in enumerate(arcs):
        step = 1
        while any(a < b for a, b in arc):
            take(arc, nodes[(k + step) % len(nodes)][1])
            step += 1
    return sorted(cuts)


def shard_rows(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    The law is ``rows``: the shards' counts are at most one apart. ``size`` is the text's
    bytes (a null text has none) plus 16, ``text_crc32`` its checksum (null: of no bytes).
    A row's place on the ring is a hash of its id, or of its text if the id is null. Rows
    with equal places are ordered by id, then text; rows that repeat get places of their
    own. ``slot`` numbers a shard's rows from 0 in that order. ``grown_shard`` is null, as
    capacities, and with them shards, depend on all rows. Other columns are not looked at;
    an empty table gives an empty one.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64(F.lit("text"), text)).alias("h"),
        F.xxhash64(text).alias("tie"),
    ).withColumn("cell", F.pmod("h", F.lit(CELLS)).cast("int"))
    counts = {r.cell: r.n for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    cuts = walk(counts, places(spark, shards, virtual), shards) if counts else []

    # For each cell the cuts that its ranks fall into, with the slot of the cut's first row.
    taken: dict[int, int] = defaultdict(int)
    slots = []
    for a, b, shard in cuts:
        slots.append((a, b, shard, taken[shard]))
        taken[shard] += b - a
    pieces, k, at = [], 0, 0
    for cell in sorted(counts):
        end = at + counts[cell]
        while k < len(slots) and slots[k][1] <= at:
            k += 1
        j = k
        while j < len(slots) and slots[j][0] < end:
            a, b, shard, slot = slots[j]
            pieces.append((cell, max(a, at) - at, min(b, end) - at, shard, slot + max(a, at) - a))
            j += 1
        at = end
    # At most CELLS rows and one more for each cut: a size that the data don't change.
    table = spark.createDataFrame(pieces, "cell int, lo long, hi long, shard int, slot_from long")
    order = Window.partitionBy("cell").orderBy("h", F.col("doc_id").asc_nulls_first(), "tie", "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    return ranked.join(F.broadcast(table), "cell").filter("rank >= lo and rank < hi").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("slot_from") + F.col("rank") - F.col("lo")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
