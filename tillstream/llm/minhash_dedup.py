"""Near-duplicate documents by b-bit MinHash.

Each document's distinct shingles are hashed and reduced to ``bands * rows`` minima.
Whole minima make the band keys that propose candidates; only their low ``BITS`` bits
are kept beside that, packed into a few numbers, and a candidate's similarity is
estimated from them by XOR and bit counts, corrected for lanes that agree by chance.
What passes the estimate is confirmed on the full shingle sets.

No bucket's pairs are ever all emitted. Documents with equal sets are one vertex from
the start. In each bucket a document is compared with the first or the last member, and
tried against the one that its estimates like best among all its buckets: one pair per
document, which settles large groups of copies in a few rounds. A bucket then matters
only if its members lie in different components. Links between those must share one of
the rarest shingles of both ends (prefix filtering: a set of n that must share o has one
of the shared ones among its n - o + 1 rarest), so members are joined on these alone.
Nearly all of them are in one document or one component only, so few pairs are left to
estimate and confirm, and none that could be a link is passed over. Minima of four per
band in 32 bands miss a pair of similarity 0.75 with probability 5e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillstream.llm.common import (
    LOWER,
    SPACE,
    blocks,
    kept,
    mixed,
    one_row_per_id,
    released,
    small,
    word_hashes,
    word_spans,
)
from tillstream.llm.components import merged

WORDS = 5
PERCENT = 75
BANDS, ROWS = 32, 4
BITS = 4
# An estimate may lie this far (five standard deviations) below the similarity asked for.
MARGIN = 0.2
# Rounds in which each document is tried once.
ROUNDS = 3
# Pairs that one copy of a document's text confirms.
PER_PART = 64
# Texts are asked for by broadcast up to this many rows of three numbers.
MOST_WANTED = 200_000
# A shingle that more members hold is hot: its rows are spread by document.
HOT_HOLDERS = 1_000

_LANES = 64 // BITS
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, SPACE)
    hashes = word_hashes(data, starts, ends)
    count = max(len(hashes) - words + 1, 0)
    rolled = np.full(count, words, np.uint64)
    for k in range(words):
        rolled = rolled * _STEP + hashes[k : k + count]
    rolled = mixed(rolled)
    out = []
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        if hi - lo >= words:
            out.append(np.unique(rolled[lo : hi - words + 1]))
        elif hi > lo:
            whole = np.uint64(hi - lo)
            with np.errstate(over="ignore"):
                for h in hashes[lo:hi]:
                    whole = whole * _STEP + h
            out.append(mixed(np.array([whole], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * _STEP)
    return (seeds[:count] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (
        seeds[count:] >> np.uint64(32)
    ).astype(np.uint32)


def minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each permutation over a set that is not empty."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 1024):
        values = a[:, None] * x[None, k : k + 1024]
        values += b[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of each minimum, ``_LANES`` to a 64-bit number."""
    low = mixed(least.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
    shifts = np.arange(_LANES, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low.reshape(-1, _LANES) << shifts, axis=1)


_SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("sig", T.ArrayType(T.LongType())),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _permutations(BANDS * ROWS)
        salts = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
        for rows, data, offsets in blocks(batches, "text"):
            counts, digests, sigs, keys = [], [], [], []
            for own in shingles(data, offsets, words):
                counts.append(len(own))
                if not len(own):
                    digests.append(None), sigs.append(None), keys.append(None)
                    continue
                least = minima(own, a, b)
                band = salts.copy()
                for part in least.reshape(BANDS, ROWS).T:
                    band = mixed(band * _STEP + part)
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                sigs.append(packed(least).view(np.int64))
                keys.append(band.view(np.int64))
            yield pa.record_batch(
                [
                    rows.column("doc_id").cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sigs, pa.list_(pa.int64())),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=_SIGNED.fieldNames(),
            )

    return run


def estimate(a: Column, b: Column) -> Column:
    """The similarity that two packed signatures tell, corrected for chance agreement."""
    lows = int("0" * (BITS - 1) + "1", 2)
    for _ in range(_LANES - 1):
        lows = lows << BITS | 1

    def differing(x: Column, y: Column) -> Column:
        xor = x.bitwiseXOR(y)
        any_bit = xor
        for k in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(xor, k))
        return F.bit_count(any_bit.bitwiseAND(F.lit(lows)))

    lanes = BANDS * ROWS
    off = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    chance = 1 / (1 << BITS)
    return ((lanes - off) / F.lit(float(lanes)) - chance) / (1 - chance)


def _confirm(words: int, percent: int):
    """Pairs whose full sets are similar enough; a hub's row comes before those it is compared with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.empty(0, np.uint64)
        for batch in batches:
            for rows, data, offsets in blocks(iter([batch]), "text"):
                names = zip(rows.column("hub").to_pylist(), rows.column("id").to_pylist(), strict=True)
                found = []
                for (at, doc_id), other in zip(names, shingles(data, offsets, words), strict=True):
                    if at == doc_id:
                        hub, own = at, other
                        continue
                    if at != hub:
                        raise ValueError(f"document {at} has no text")
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    if both and 100 * both >= percent * (len(own) + len(other) - both):
                        found.append((min(at, doc_id), max(at, doc_id)))
                pairs = np.array(found, np.int64).reshape(-1, 2)
                yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def _wanted(pairs: DataFrame) -> DataFrame:
    """``hub``, ``part``, ``id``: the texts that confirming ``pairs`` takes, a hub's once a part.

    The end with more pairs is the pair's hub. Its pairs are dealt to parts of about
    ``PER_PART``, so its text is sent once for so many, and no part grows with a group.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("end"))
    hubs = ends.groupBy("end").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PER_PART)
    hubs = F.broadcast(hubs) if small(hubs) else hubs
    for x in "ab":
        pairs = pairs.join(hubs.select(F.col("end").alias(x), F.col("n").alias(f"n_{x}")), x, "left")
    n_a, n_b = (F.coalesce(f"n_{x}", F.lit(0)) for x in "ab")
    sides = pairs.select(
        F.when(n_a >= n_b, F.col("a")).otherwise(F.col("b")).alias("hub"),
        F.when(n_a >= n_b, F.col("b")).otherwise(F.col("a")).alias("id"),
        F.ceil(F.greatest(n_a, n_b, F.lit(1)) / PER_PART).alias("parts"),
    )
    others = sides.select("hub", F.pmod(F.xxhash64("id"), "parts").alias("part"), "id")
    return others.unionByName(others.select("hub", "part", F.col("hub").alias("id")).distinct())


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Of the distinct pairs ``a``, ``b``, those that are linked on their full sets."""
    wanted = _wanted(pairs)
    few = F.broadcast(wanted) if small(wanted, MOST_WANTED) else wanted
    texts = docs.withColumnRenamed("doc_id", "id").join(few, "id")
    first = (F.col("id") != F.col("hub")).alias("other")
    return (
        texts.repartition("hub", "part")
        .sortWithinPartitions("hub", "part", first)
        .select("hub", "id", "text")
        .mapInArrow(_confirm(words, percent), "a long, b long")
    )


def _exploded(words: int):
    """A row for each distinct shingle of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, "text"):
            sets = shingles(data, offsets, words)
            sizes = [len(x) for x in sets]
            hashes = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
            own = [np.repeat(np.asarray(rows.column(c)), sizes) for c in ("doc_id", "component")]
            yield pa.record_batch(
                [pa.array(hashes), *map(pa.array, own)], names=["shingle", "doc_id", "component"]
            )

    return run


def _sharing(members: DataFrame, sets: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` of members of different components that share a rare enough shingle.

    A link of a set of n with one of at least ``least`` shares at least ``o`` shingles. In one
    order for all, from the shingles that the fewest members hold, the sets' first n - o + 1
    meet if the sets share so many.
    """
    sized = members.join(sets.select("doc_id", "n_shingles"), "doc_id")
    least = sized.groupBy("key").agg(F.min("n_shingles").alias("least"))

    def prefix(n: Column, other: Column) -> Column:
        return n - F.ceil(percent * (n + other) / (100 + percent)) + 1

    of_doc = kept(
        sized.join(least, "key")
        .groupBy("doc_id", "component", "n_shingles")
        .agg(F.max(prefix(F.col("n_shingles"), F.col("least"))).alias("prefix")),
        "members",
    )
    few = F.broadcast(of_doc) if small(of_doc) else of_doc
    grams = docs.join(few.select("doc_id", "component"), "doc_id").mapInArrow(
        _exploded(words), "shingle long, doc_id long, component long"
    )
    # Written out, so that the join has a plain shuffle on both sides and Spark can split a
    # shingle that very many members hold.
    holders = kept(grams.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")), "holders")
    order = Window.partitionBy("doc_id").orderBy("holders", "shingle")
    rarest = kept(
        _with_holders(grams, holders)
        .withColumn("rank", F.row_number().over(order))
        .join(few.select("doc_id", "n_shingles", "prefix"), "doc_id")
        .filter("rank <= prefix and holders > 1")
        .select("shingle", "doc_id", "component", "n_shingles", "rank"),
        "rarest",
    )
    across = _across(rarest, "shingle")
    one, two = (
        across.select(
            "shingle",
            F.col("doc_id").alias(x),
            F.col("component").alias(f"c{x}"),
            F.col("n_shingles").alias(f"n{x}"),
            F.col("rank").alias(f"r{x}"),
        )
        for x in "ab"
    )
    # The two sets' own sizes allow a shorter prefix than the least in their buckets.
    near = (F.col("ra") <= prefix(F.col("na"), F.col("nb"))) & (
        F.col("rb") <= prefix(F.col("nb"), F.col("na"))
    )
    return one.join(two, "shingle").filter("a < b and ca <> cb").filter(near).select("a", "b").distinct()


def _with_holders(grams: DataFrame, holders: DataFrame) -> DataFrame:
    """``grams`` with ``holders``, the number of members that hold the shingle.

    Those of hot shingles are broadcast, one row for at least ``HOT_HOLDERS`` of ``grams``, and
    the rows of hot shingles go through the join's shuffle by document.
    """
    hot = holders.filter(F.col("holders") > HOT_HOLDERS).withColumnRenamed("holders", "many")
    if not small(hot):
        return grams.join(holders, "shingle")
    salted = grams.join(F.broadcast(hot), "shingle", "left").withColumn(
        "salt", F.when(F.col("many").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) + 1)
    )
    others = holders.filter(F.col("holders") <= HOT_HOLDERS).withColumn("salt", F.lit(0).cast("long"))
    return (
        salted.join(others, ["shingle", "salt"], "left")
        .withColumn("holders", F.coalesce("many", "holders"))
        .drop("salt", "many")
    )


def _across(rows: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose ``key`` occurs in more than one component."""
    spread = rows.groupBy(key).agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return rows.join(spread.filter("lo < hi").select(key), key)


def _likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs ``a``, ``b``, those whose set sizes and signatures allow a link."""
    sigs = sets.select("doc_id", "n_shingles", "sig")
    one, two = (
        sigs.select(
            F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")
        )
        for x in "ab"
    )
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .withColumn("estimate", estimate(F.col("sig_a"), F.col("sig_b")))
        .filter(F.col("estimate") >= percent / 100 - MARGIN)
        .select(*pairs.columns, "estimate")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for each document.

    Lower-cases A-Z, splits at ASCII white space. A text of fewer than ``words`` words is
    one shingle; one without words (empty, blank or null) has none and is linked with
    nothing. Documents are linked if 100 * intersection >= ``percent`` * union.
    ``component_id`` is the smallest id reachable and ``kept`` tells whether it is the
    document's own. Texts are taken whole, however long. Rows that repeat an id are one
    document (see ``one_row_per_id``); each row with a null id comes back with a null
    ``component_id``, kept. Ties go to the smaller id. An empty table gives an empty one;
    other columns are not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    named = one_row_per_id(docs, "doc_id", "text")
    signed = kept(named.mapInArrow(_sign(words), _SIGNED), "signed")
    sets = kept(
        signed.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "n_shingles", "sig", "bands")).alias("rep"))
        .select("digest", "rep.*"),
        "sets",
    )
    buckets = sets.select(F.explode("bands").alias("key"), "doc_id")
    label = tried = None

    def with_component(members: DataFrame) -> DataFrame:
        if label is None:
            return members.withColumn("component", F.col("doc_id"))
        named_by = label.select(F.col("v").alias("doc_id"), F.col("component").alias("found"))
        return members.join(named_by, "doc_id", "left").select(
            *members.columns, F.coalesce("found", "doc_id").alias("component")
        )

    def link(pairs: DataFrame, best_of: bool = False) -> bool:
        """Adds the links among ``pairs`` that were not tried before; whether there are any.

        With ``best_of``, only the likeliest pair of each ``own`` document is tried.
        """
        nonlocal label, tried
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = _likely(pairs, sets, percent)
        if best_of:
            pairs = pairs.groupBy("own").agg(
                F.max(F.struct("estimate", (-F.col("a")).alias("a"), (-F.col("b")).alias("b"))).alias("best")
            ).select((-F.col("best.a")).alias("a"), (-F.col("best.b")).alias("b")).distinct()
        pairs = kept(pairs.select("a", "b"), "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = kept(confirmed(pairs, named, words, percent), "links")
        if found.isEmpty():
            return False
        label = merged(label, found)
        return True

    members = kept(_across(with_component(buckets)), "members")
    for _ in range(ROUNDS):
        ends = members.groupBy("key").agg(
            F.min(F.struct("doc_id", "component")).alias("lo"), F.max(F.struct("doc_id", "component")).alias("hi")
        )
        end = F.when(F.col("lo.component") != F.col("component"), F.col("lo.doc_id")).when(
            F.col("hi.component") != F.col("component"), F.col("hi.doc_id")
        )
        pairs = (
            members.join(ends, "key")
            .select(end.alias("end"), F.col("doc_id").alias("own"))
            .filter("end is not null")
            .select(F.least("end", "own").alias("a"), F.greatest("end", "own").alias("b"), "own")
            .distinct()
        )
        if not link(pairs, best_of=True):
            break
        members = kept(_across(with_component(members.drop("component"))), "members")
    if not members.isEmpty():
        link(_sharing(members, sets, named, words, percent))
    released(docs.sparkSession)

    of_set = with_component(sets.select("digest", "doc_id")).select(
        "digest", F.col("component").alias("component_id")
    )
    out = signed.select("doc_id", "n_shingles", "digest").join(of_set, "digest", "left")
    out = out.select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    # Rows without an id are nobody's copy.
    nameless = (
        docs.filter("doc_id is null")
        .mapInArrow(_sign(words), _SIGNED)
        .select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    )
    return out.unionByName(nameless).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
