"""Document fingerprints by content-defined chunking.

A rolling gear hash of the last 16 bytes says where a chunk may end: seldom while a
chunk is shorter than ``NORMAL`` bytes, often beyond, never before ``LEAST`` and always
at ``MOST`` (normalised chunking). So an insertion moves the boundaries near it only,
and the digests of all other chunks stay. A fingerprint is the set of a text's chunk
digests with their lengths; containment is the share of the bytes of one set's chunks
that the other set holds too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.llm.common import bounded_batches, even_keys, mixed, word_hashes

LEAST, NORMAL, MOST = 8, 24, 96
_SPAN = 16  # bytes that a 16-bit gear hash remembers
# A boundary's hash is below these: one of 64 places, and one of 16.
_SELDOM, _OFTEN = 1 << 10, 1 << 12
_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)

ROWS_PER_PART = 5_000
MOST_PARTS = 10_000

Print = tuple[np.ndarray, np.ndarray]  # sorted distinct chunk digests, and chunk lengths


def chunk_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Starts, ends and owning texts of all chunks, in order, and the bytes they refer to."""
    gap = bytes(_SPAN)
    joined = gap.join([b"", *texts])
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + _SPAN)
    starts = ends - sizes
    rolling = _GEAR[data]
    # Gaps count as nothing, so a text's boundaries don't depend on its neighbours.
    gaps = (starts[:, None] - _SPAN + np.arange(_SPAN)).ravel()
    rolling[gaps] = 0
    for k in (1, 2, 4, 8):
        before = np.zeros_like(rolling)
        before[k:] = rolling[:-k] << np.uint16(k)
        rolling += before
    beyond = len(data) + MOST
    often = np.flatnonzero(rolling < _OFTEN)
    seldom = np.append(often[rolling[often] < _SELDOM], beyond)
    often = np.append(often, beyond)

    owner = np.flatnonzero(sizes)
    at, end = starts[owner], ends[owner]
    found = []
    while len(owner):
        early = seldom[np.searchsorted(seldom, at + LEAST - 1)]
        late = often[np.searchsorted(often, at + NORMAL - 1)]
        stop = np.where(early < at + NORMAL - 1, early, late) + 1
        stop = np.minimum(np.minimum(stop, at + MOST), end)
        found.append((at, stop, owner))
        more = stop < end
        at, end, owner = stop[more], end[more], owner[more]
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, joined
    at, stop, owner = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(at)
    return at[order], stop[order], owner[order], joined


def prints(texts: list[bytes]) -> list[Print]:
    """The fingerprint of each text, as sorted distinct 48-bit digests and lengths."""
    starts, ends, owner, joined = chunk_spans(texts)
    digests = word_hashes(np.frombuffer(joined, np.uint8), starts, ends) >> np.uint64(16)
    lengths = ends - starts
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        own, first = np.unique(digests[lo:hi], return_index=True)
        out.append((own, lengths[lo:hi][first]))
    return out


def as_text(found: Print) -> str:
    """Hex: twelve digits of digest and two of length for each chunk, in order of digest."""
    digests, lengths = found
    raw = np.empty((len(digests), 7), np.uint8)
    raw[:, :6] = digests.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    raw[:, 6] = lengths
    return raw.tobytes().hex()


def containment(a: Print, b: Print) -> float:
    """The share of the bytes in a's chunks that are in b's; an empty a is only in an empty b."""
    if not len(a[0]):
        return float(not len(b[0]))
    _, mine, _ = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    return float(a[1][mine].sum() / a[1].sum())


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``following``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


_RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def _compared(rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
    """The result rows of (id, text, following text)."""
    edits = [edited(text, following) for _, text, following in rows]
    raw = [x.encode() for x in edits]
    # A row's following text is usually the next row's own.
    own = prints([text.encode() for _, text, _ in rows])
    changed = prints(raw)
    odd = [
        i
        for i, row in enumerate(rows)
        if i + 1 == len(rows) or rows[i + 1][1] is not row[2]
    ]
    after = dict(zip(odd, prints([rows[i][2].encode() for i in odd]), strict=True))
    return pa.record_batch(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([len(r[1]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in raw]),
            pa.array([as_text(x) for x in own]),
            pa.array([as_text(x) for x in changed]),
            pa.array([containment(a, b) for a, b in zip(own, changed, strict=True)], pa.float64()),
            pa.array(
                [
                    containment(a, after[i] if i in after else own[i + 1])
                    for i, a in enumerate(own)
                ],
                pa.float64(),
            ),
        ],
        names=_RESULT.fieldNames(),
    )


def _batched(pairs: Iterator[tuple[int | None, str, str]], most: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in pairs:
        held.append(row)
        size += len(row[1])
        if size >= most:
            yield _compared(held)
            held, size = [], 0
    if held:
        yield _compared(held)


def _in_order(most: int):
    """Rows of sorted parts, each with the text of the row after it."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
        part, last = None, None  # last: id and text of a row that waits for the next
        for batch in batches:
            columns = (batch.column(c) for c in ("part", "guest", "doc_id", "text"))
            for p, guest, doc_id, text in zip(*(c.to_pylist() for c in columns), strict=True):
                if p != part:
                    part, last = p, None
                text = text or ""
                if last is not None:
                    yield (*last, text)
                last = None if guest else (doc_id, text)

    return lambda batches: _batched(pairs(batches), most)


def _alone(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield from _batched(((None, t or "", "") for t in texts), most)

    return run


def fingerprints(docs: DataFrame, most: int = 1 << 20) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how much of it others hold.

    Returns ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next`` for every row. The next
    document is the one with the next id; rows that repeat an id follow each other in
    order of their text; after the last comes the first. A null text is empty. A row
    without an id has no place in the order: its following text is empty. Texts are
    taken whole. An empty table gives an empty one; other columns are not looked at.

    Ids are cut into parts of about ``ROWS_PER_PART`` rows, at most ``MOST_PARTS`` of
    them. A part is read in order as a stream, so memory is bounded by a block of ``most``
    characters or one text. Each part is a task of its own. Each part's first row is also
    sent to the part before it; that is the only text that is moved twice.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = rows.filter("doc_id is not null")
    alone = rows.filter("doc_id is null").mapInArrow(_alone(most), _RESULT)
    ids = named.select("doc_id")
    parts = min(MOST_PARTS, -(-ids.count() // ROWS_PER_PART))
    if not parts:
        return alone
    steps = [k / parts for k in range(1, parts)]
    bounds = ids.approxQuantile("doc_id", steps, 0.1 / parts) if steps else []
    bounds = np.unique(np.array(bounds, np.float64).astype(np.int64))

    @F.arrow_udf("int")
    def part_of(doc_id: pa.Array) -> pa.Array:
        found = np.searchsorted(bounds, doc_id.to_numpy(zero_copy_only=False), "right")
        return pa.array(found.astype(np.int32))

    heads = (
        ids.select("doc_id", part_of("doc_id").alias("part"))
        .groupBy("part")
        .agg(F.min("doc_id").alias("head"))
        .orderBy("part")
        .collect()
    )
    head_ids = np.array([r["head"] for r in heads], np.int64)
    head_parts = np.array([r["part"] for r in heads], np.int32)
    # By part, a number that Spark's hash deals to a partition of its own.
    numbers = np.zeros(head_parts.max() + 1, np.int64)
    numbers[head_parts] = even_keys(docs.sparkSession, len(heads))

    @F.arrow_udf("long")
    def home(doc_id: pa.Array) -> pa.Array:
        found = np.searchsorted(bounds, doc_id.to_numpy(zero_copy_only=False), "right")
        return pa.array(numbers[found])

    @F.arrow_udf("long")
    def guest_in(doc_id: pa.Array) -> pa.Array:
        """The part that needs this row as the one after its last; none for most rows."""
        wanted = doc_id.to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(head_ids, wanted), len(head_ids) - 1)
        return pa.array(numbers[head_parts[at - 1]], mask=head_ids[at] != wanted)

    routed = named.select(
        "doc_id", "text", home("doc_id").alias("part"), guest_in("doc_id").alias("guest_in")
    )
    places = F.array(
        F.struct(F.col("part"), F.lit(0).alias("guest")),
        F.struct(F.col("guest_in").alias("part"), F.lit(1).alias("guest")),
    )
    routed = (
        routed.select("doc_id", "text", F.explode(places).alias("to"))
        .select("doc_id", "text", "to.part", "to.guest")
        .filter("part is not null")
    )
    ordered = routed.repartition(len(heads), "part").sortWithinPartitions(
        "part", "guest", "doc_id", "text"
    )
    return ordered.mapInArrow(_in_order(most), _RESULT).unionByName(alone)
