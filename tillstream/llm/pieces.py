"""SentencePiece encoding and decoding as a relational lattice.

Texts are cut into units wherever no piece of the vocabulary has the two characters side by
side (told by the last byte of the one and the first of the other), so no piece spans a cut:
before spaces, around line feeds, mostly between letters and marks. Units that are long all the same are cut on their best path, which a
task finds by itself, once a text. For each distinct unit, all substrings up to the length
of the longest piece are exploded and joined to the piece table; the edges found are
grouped by unit and a higher-order ``aggregate`` folds them into the best-scored path
(Viterbi). A character in no piece is spelled by its bytes.

Most occurrences are of few units, so the units of a bounded sample are encoded first
and their pieces are sent to all tasks as three sorted arrays (at most ``FREQUENT``
units). Texts are dealt to blocks and moved once, compressed by runs. Each block names the units
it has beside the frequent ones, once each and by number; these are encoded, and the pieces of
all numbers of a block come back to it, packed by the tasks that encoded them.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.common import blocks, bounded_batches, even_keys, kept, mixed, released, row_key

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Units longer than this many bytes are cut, between pieces of their best path, into units of
# at most so many (or of one piece).
LONGEST = 256
SAMPLE_ROWS = 20_000
# Units of a task that are grouped in memory.
IN_MEMORY, MOST_GROUPS = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", 200_000
# Up to so many blocks, each is a task of its own; more are dealt to tasks by hash.
MOST_NAMED = 20_000
FREQUENT = 150_000
# A block has about as many documents, and gets them in runs of so many.
ROWS_PER_BLOCK = 4_000
RUN = 200
# A character that is in no piece costs so much more than the worst piece.
UNKNOWN_COST = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as text (a space for the space mark), their scores, and the 256 byte pieces."""

    pieces: tuple[str, ...]  # by id; empty for ids that stand for no text of their own
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]

    @property
    def unknown_score(self) -> float:
        return min(self.scores) - UNKNOWN_COST

    def joined(self) -> np.ndarray:
        """For the last byte of a character and the first of the next: whether a piece joins them."""
        out = np.zeros((256, 256), bool)
        for piece in self.pieces:
            raw = np.frombuffer(piece.encode(), np.uint8)
            first = np.flatnonzero(raw[1:] & 0xC0 != 0x80) + 1
            out[raw[first - 1], raw[first]] = True
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """``piece``, ``id``, ``score``; its size is fixed by the vocabulary file."""
        rows = [(p, i, s) for i, (p, s) in enumerate(zip(self.pieces, self.scores, strict=True)) if p]
        return spark.createDataFrame(rows, "piece string, id int, score double")

    def lattice(self) -> tuple[dict[str, float], dict[str, int], float]:
        """Scores by piece, lengths of the longest pieces by their first ``_HEAD`` characters, and
        the score of a character in no piece."""
        scores = {p: s for p, s in zip(self.pieces, self.scores, strict=True) if p}
        reach: dict[str, int] = {}
        for p in scores:
            if len(p) >= _HEAD:
                reach[p[:_HEAD]] = max(reach.get(p[:_HEAD], 0), len(p))
        return scores, reach, self.unknown_score

    def hex_by_id(self) -> list[str]:
        """The bytes of each id, as hex."""
        of_byte = {i: f"{b:02X}" for b, i in enumerate(self.byte_ids)}
        return [of_byte.get(i) or p.encode().hex().upper() for i, p in enumerate(self.pieces)]


def load_vocabulary(model: str = MODEL) -> Vocabulary:
    """The pieces of a SentencePiece model file with byte fallback, read on the driver."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = range(sp.get_piece_size())
    plain = [
        "" if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
        else sp.id_to_piece(i).replace("▁", " ")
        for i in ids
    ]
    byte_ids = tuple(sp.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    return Vocabulary(tuple(plain), tuple(float(sp.get_score(i)) for i in ids), byte_ids)


# --- the lattice ---


# An edge is one number: where it stops, where it starts, and its piece's id plus one (0 for a
# character that is spelled), which sorts it and keeps what is grouped small.
_STOP, _START = 40, 20
_FIELD = (1 << 20) - 1


# Substrings are as long as the longest piece that begins with the same characters, this many.
_HEAD = 3


def encode_units(units: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``unit`` and ``ids`` of the best path for each row of ``units`` (distinct, not empty).

    Of paths with one score the one whose last differing piece starts earliest is taken.
    Rows that come partitioned by ``unit`` are not shuffled.
    """
    table = vocabulary.table(units.sparkSession)
    head = F.substring("piece", F.lit(1), F.lit(_HEAD))
    reach = table.filter(F.length("piece") >= _HEAD).groupBy(head.alias("head")).agg(
        F.max(F.length("piece")).alias("reach")
    )
    starts = (
        units.select("unit", F.length("unit").alias("size"))
        .select("unit", "size", F.explode(F.sequence(F.lit(1), F.col("size"))).alias("start"))
        .select("unit", "size", "start", F.substring("unit", F.col("start"), F.lit(_HEAD)).alias("head"))
        .join(F.broadcast(reach), "head", "left")
    )
    most = F.least(F.coalesce("reach", F.lit(_HEAD - 1)), F.col("size") - F.col("start") + 1)
    spans = starts.select("unit", "start", F.explode(F.sequence(F.lit(1), most)).alias("n")).select(
        "unit", "start", "n", F.substring("unit", F.col("start"), F.col("n")).alias("piece")
    )
    table = F.broadcast(table)
    start = F.col("start").cast("long") - 1
    edge = (
        F.shiftleft(start + F.col("n"), _STOP)
        + F.shiftleft(start, _START)
        + F.coalesce(F.col("id") + 1, F.lit(0))
    )
    edges = spans.join(table, "piece", "left").filter("id is not null or n = 1")
    lattice = edges.groupBy("unit").agg(F.sort_array(F.collect_list(edge)).alias("edges"))

    # By id plus one; a text that is split is folded into an array once, as it is constant.
    listed = ",".join(map(repr, (vocabulary.unknown_score, *vocabulary.scores)))
    scores = F.split(F.lit(listed), ",").cast("array<double>")

    # best[i] is the score of the best path to position i and its last edge; edges come
    # sorted by where they stop, so what they start from is settled.
    def extend(best: Column, e: Column) -> Column:
        stop = F.shiftright(e, _STOP).cast("int")
        before = F.get(best, F.shiftright(e, _START).bitwiseAND(F.lit(_FIELD)).cast("int"))
        score = before["score"] + F.get(scores, e.bitwiseAND(F.lit(_FIELD)).cast("int"))
        here = F.struct(score.alias("score"), e.alias("edge"))
        return (
            F.when(F.size(best) <= stop, F.concat(best, F.array(here)))
            .when(score > F.get(best, stop)["score"], F.concat(F.slice(best, F.lit(1), stop), F.array(here)))
            .otherwise(best)
        )

    # Back from the end: each step puts the edge before the path found so far.
    bytes_of = F.split(F.lit(",".join(map(str, vocabulary.byte_ids))), ",").cast("array<int>")

    def spelled(position: Column) -> Column:
        digits = F.hex(F.encode(F.substring("unit", position + 1, F.lit(1)), "UTF-8"))
        return F.transform(
            F.sequence(F.lit(0), (F.length(digits) / 2).cast("int") - 1),
            lambda k: F.get(bytes_of, F.conv(F.substring(digits, k * 2 + 1, F.lit(2)), 16, 10).cast("int")),
        )

    def step(state: Column, i: Column) -> Column:
        e = F.get("best", i)["edge"]
        start = F.shiftright(e, _START).bitwiseAND(F.lit(_FIELD)).cast("int")
        id_ = e.bitwiseAND(F.lit(_FIELD)).cast("int")
        ids = F.when(id_ == 0, spelled(start)).otherwise(F.array(id_ - 1))
        return F.when(
            state["at"] == i, F.struct(start.alias("at"), F.concat(ids, state["ids"]).alias("ids"))
        ).otherwise(state)

    nothing = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("edge")))
    found = lattice.select("unit", F.aggregate("edges", nothing, extend).alias("best"))
    end = F.struct((F.size("best") - 1).alias("at"), F.array().cast("array<int>").alias("ids"))
    steps = F.sequence(F.size("best") - 1, F.lit(1), F.lit(-1))
    return found.select("unit", F.aggregate(steps, end, step, lambda s: s["ids"]).alias("ids"))


# --- documents ---


def long_cuts(unit: str, scores: dict[str, float], reach: dict[str, int], unknown: float) -> list[int]:
    """Where to cut a long unit, in bytes: between pieces of its best path, so that the best paths
    of the parts are that of the whole (ties are settled as in ``encode_units``)."""
    size = len(unit)
    # Scores are carried only as far as a piece reaches; of each position's best path only the
    # length of its last piece is kept.
    ring = 1 + max([_HEAD - 1, *reach.values()])
    ahead: list[float | None] = [None] * ring
    ahead[0] = 0.0
    back = array("L", [0]) * (size + 1)
    for i in range(size):
        here, ahead[i % ring] = ahead[i % ring], None
        for n in range(1, min(reach.get(unit[i : i + _HEAD], _HEAD - 1), size - i) + 1):
            score = scores.get(unit[i : i + n], unknown if n == 1 else None)
            if score is not None:
                best = ahead[(i + n) % ring]
                if best is None or here + score > best:
                    ahead[(i + n) % ring], back[i + n] = here + score, n
    cuts, at, stop, taken = [], len(unit.encode()), size, 0
    while stop:
        n = len(unit[stop - back[stop] : stop].encode())
        if taken and taken + n > LONGEST:
            cuts.append(at)
            taken = 0
        stop, at, taken = stop - back[stop], at - n, taken + n
    return cuts[::-1]


def unit_starts(
    data: np.ndarray, offsets: np.ndarray, joined: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a block with a space before each text that is not empty, the offset of each
    text in them, and the starts of units, of which some may be long."""
    sizes = np.diff(offsets)
    data = np.insert(data, offsets[:-1][sizes > 0], 32)
    offsets = offsets + np.concatenate([[0], np.cumsum(sizes > 0)])
    if not len(data):
        return data, offsets, np.empty(0, np.int64)
    begins = np.zeros(len(data), bool)
    pair = (data[:-1].astype(np.uint16) << 8) | data[1:]
    begins[1:] = ~joined.ravel()[pair] & (data[1:] & 0xC0 != 0x80)
    begins[offsets[:-1][sizes > 0]] = True
    return data, offsets, np.flatnonzero(begins)


def cuts_of(data: np.ndarray, starts: np.ndarray, lattice) -> np.ndarray:
    """Where the long units of a block are cut. ``lattice`` is the broadcast
    ``Vocabulary.lattice``, which is read only if there are such units."""
    lengths = np.diff(np.append(starts, len(data)))
    cuts = []
    for at, n in zip(starts[lengths > LONGEST], lengths[lengths > LONGEST], strict=True):
        cuts += [at + c for c in long_cuts(data[at : at + n].tobytes().decode(), *lattice.value)]
    return np.array(cuts, np.int64)


def with_cuts(
    data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, cuts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of units, and each text's first unit (and an end)."""
    if len(cuts):
        starts = np.sort(np.concatenate([starts, cuts]))
    return starts, np.append(starts[1:], len(data)) if len(starts) else starts, np.searchsorted(starts, offsets)


_FACTOR = 0x9E3779B97F4A7C15
_SPAN = 1 << 18
# Powers of the factor and of its inverse; made in each process, as functions are sent with what
# they refer to.
_TABLES: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        _TABLES["inverses"] = np.cumprod(np.full(_SPAN, pow(_FACTOR, -1, 1 << 64), np.uint64))
        _TABLES["powers"] = np.cumprod(np.full(_SPAN, _FACTOR, np.uint64))
    return _TABLES["powers"], _TABLES["inverses"]


def unit_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and do not overlap.

    Sums of bytes times powers are taken over the whole block; a span's difference of sums is
    divided by the power at its start.
    """
    table, inverses = _powers()
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        # As many spans as the powers reach; one that is longer is a part of its own.
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + len(table), "right")))
        base, end = int(starts[a]), int(ends[b - 1])
        powers = table if end - base <= len(table) else np.cumprod(np.full(end - base, _FACTOR, np.uint64))
        sums = np.zeros(end - base + 1, np.uint64)
        np.cumsum((data[base:end].astype(np.uint64) + np.uint64(1)) * powers[: end - base], out=sums[1:])
        own = sums[ends[a:b] - base] - sums[starts[a:b] - base]
        out[a:b] = own * inverses[starts[a:b] - base] + (ends[a:b] - starts[a:b]).astype(np.uint64)
        a = b
    return mixed(out)


class Encoded:
    """Pieces of units by the units' sorted hashes."""

    def __init__(self, hashes: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> None:
        self.hashes, self.offsets, self.ids = hashes, offsets, ids
        # Where hashes with the same leading bits begin; few share them.
        bits = max(1, min(22, int(len(hashes)).bit_length() + 2))
        self.shift = np.uint64(64 - bits)
        lead = (hashes >> self.shift).astype(np.int64)
        self.begin = np.searchsorted(lead, np.arange((1 << bits) + 1))
        self.most = int(np.diff(self.begin).max(initial=0))

    @staticmethod
    def of(rows: pa.Table) -> Encoded:
        """From columns ``hash`` and ``ids``."""
        hashes = np.asarray(rows["hash"]).view(np.uint64)
        order = np.argsort(hashes)
        lists = rows["ids"].combine_chunks().take(pa.array(order))
        sizes = np.asarray(pc.list_value_length(lists), np.int64)
        ids = np.asarray(lists.flatten(), np.int32)
        return Encoded(hashes[order], np.concatenate([[0], np.cumsum(sizes)]), ids)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int32)
        if not len(self.hashes):
            return out
        lead = (hashes >> self.shift).astype(np.int64)
        at, end = self.begin[lead], self.begin[lead + 1]
        for _ in range(self.most):
            open_ = at < end
            hit = open_ & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes)
            out[hit] = at[hit]
            at = at + 1
        return out


def _unit_hash(units: pa.Array) -> pa.Array:
    raw = pc.fill_null(units, "").cast(pa.large_string())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    return pa.array(unit_hashes(data, offsets[:-1], offsets[1:]).view(np.int64))


def _counted(joined: np.ndarray, lattice):
    """The distinct units of each block, with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in blocks(batches, "text"):
            data, offsets, starts = unit_starts(data, offsets, joined)
            starts, ends, _ = with_cuts(data, offsets, starts, cuts_of(data, starts, lattice))
            hashes = unit_hashes(data, starts, ends)
            _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
            raw = data.tobytes()
            spans = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
            units = pa.array([raw[a:b].decode() for a, b in spans], pa.string())
            yield pa.record_batch([units, pa.array(counts, pa.int64())], names=["unit", "n"])

    return run


def frequent_units(
    texts: DataFrame, joined: np.ndarray, lattice, most: int = FREQUENT, sample: int | None = None
) -> DataFrame:
    """The units that occur at least twice, or more often if that gives more than ``most``, in
    a sample of about ``sample`` rows. The sample only says which units are sent to all tasks."""
    total, sample = max(texts.count(), 1), sample or SAMPLE_ROWS
    drawn = texts.filter(
        F.pmod(F.xxhash64("id", "h"), F.lit(1_000_000)) < int(min(1.0, sample / total) * 1_000_000)
    )
    counts = kept(
        drawn.select("text").mapInArrow(_counted(joined, lattice), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n")),
        "unit-counts",
    )
    spread = counts.filter("n > 1").groupBy(F.least("n", F.lit(10_000)).alias("n")).agg(F.count(F.lit(1)).alias("units"))
    least, units = 2, 0
    for row in sorted(spread.collect(), reverse=True):
        units += row.units
        if units > most:
            least = row.n + 1
            break
    return counts.filter(F.col("n") >= least).select("unit")


RUNS = "block long, doc_ids array<long>, sizes array<int>, packed binary, cuts array<int>"


def _packed(joined: np.ndarray, lattice):
    """Runs of rows of one block: their texts, compressed together, and where long units are cut,
    from the start of the run's units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for rows, raw, offsets in blocks(batches, "text"):
            data, spaced, starts = unit_starts(raw, offsets, joined)
            cuts = cuts_of(data, starts, lattice)
            block = np.asarray(rows.column("block"))
            ids = rows.column("doc_id")
            edges = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
            at = np.searchsorted(cuts, spaced[edges])
            relative = cuts - np.repeat(spaced[edges[:-1]], np.diff(at))
            texts = [raw[offsets[a] : offsets[b]].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            lists = pa.array(edges, pa.int32())
            yield pa.record_batch(
                [
                    pa.array(block[edges[:-1]]),
                    pa.ListArray.from_arrays(lists, ids),
                    pa.ListArray.from_arrays(lists, pa.array(np.diff(offsets), pa.int32())),
                    pa.array([squeeze.compress(t) for t in texts], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(relative, pa.int32())),
                ],
                names=[c.split()[0] for c in RUNS.split(", ")],
            )

    return run


def _runs(batches: Iterator[pa.RecordBatch], joined: np.ndarray):
    """Of each run: its block and ids, the bytes of its units, starts and ends of these, and each
    text's first unit (and an end)."""
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        for k in range(len(batch)):
            block, ids, sizes, packed, cuts = (batch.column(i)[k] for i in range(5))
            raw = np.frombuffer(expand.decompress(packed.as_py()), np.uint8)
            offsets = np.concatenate([[0], np.cumsum(np.asarray(sizes.values, np.int64))])
            data, offsets, starts = unit_starts(raw, offsets, joined)
            yield block.as_py(), ids.values, data, *with_cuts(data, offsets, starts, np.asarray(cuts.values, np.int64))


def _rare(frequent, joined: np.ndarray):
    """The units of each block that are not frequent, numbered in the order of their hashes. A
    task has whole blocks and keeps their units' hashes and texts until their end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Encoded(*frequent.value)
        found: dict[int, tuple[np.ndarray, list[str]]] = {}
        for block, _, data, starts, ends, _ in _runs(batches, joined):
            hashes = unit_hashes(data, starts, ends)
            rare = np.flatnonzero(known.find(hashes) < 0)
            own, once = np.unique(hashes[rare], return_index=True)
            seen, units = found.get(block, (np.empty(0, np.uint64), []))
            new = ~np.isin(own, seen, assume_unique=True)
            places, raw = rare[once[new]], data.tobytes()
            units += [raw[a:b].decode() for a, b in zip(starts[places].tolist(), ends[places].tolist(), strict=True)]
            found[block] = np.concatenate([seen, own[new]]), units
        for block, (hashes, units) in found.items():
            number = np.empty(len(hashes), np.int32)
            number[np.argsort(hashes)] = np.arange(len(hashes))
            texts = pa.array(units, pa.string())
            # In alphabetical order the shuffle's compression finds more.
            order = pc.sort_indices(texts)
            columns = [texts.take(order), pa.array(np.full(len(units), block)), pa.array(number).take(order)]
            yield pa.record_batch(columns, names=["unit", "block", "number"])

    return run


# Rows that are packed together at most.
PACKED_ROWS = 1 << 20


def _pack(blocks_: np.ndarray, numbers: np.ndarray, lists: pa.ListArray) -> pa.RecordBatch:
    """Rows of (block, number, ids) as one value for each block."""
    squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True)
    order = np.lexsort((numbers, blocks_))
    lists = lists.take(pa.array(order))
    blocks_, numbers = blocks_[order], numbers[order].astype(np.int32)
    sizes = np.asarray(pc.list_value_length(lists), np.int32)
    ids, ends = np.asarray(lists.flatten(), np.int32), np.concatenate([[0], np.cumsum(sizes)])
    edges = np.concatenate([[0], np.flatnonzero(np.diff(blocks_)) + 1, [len(blocks_)]]) if len(blocks_) else np.zeros(1, int)
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        steps = np.diff(numbers[a:b], prepend=np.int32(0))
        out.append(squeeze.compress(np.concatenate([[b - a], steps, sizes[a:b], ids[ends[a] : ends[b]]]).astype(np.int32).tobytes()))
    return pa.record_batch([pa.array(blocks_[edges[:-1]], pa.int64()), pa.array(out, pa.binary())], names=["block", "units"])


def _unpack(values: list[bytes], hashes: np.ndarray) -> Encoded:
    """The pieces of a block's units, of which ``hashes`` are those, by number."""
    expand = zstandard.ZstdDecompressor()
    numbers, sizes, ids = [], [], []
    for value in values:
        row = np.frombuffer(expand.decompress(value), np.int32)
        n = int(row[0])
        numbers.append(np.cumsum(row[1 : n + 1]))
        sizes.append(row[n + 1 : 2 * n + 1])
        ids.append(row[2 * n + 1 :])
    none = [np.empty(0, np.int32)]
    number, size, flat = (np.concatenate(none + x).astype(np.int64) for x in (numbers, sizes, ids))
    order = np.argsort(number)
    if not np.array_equal(number[order], np.arange(len(hashes))):
        raise ValueError("not all units of a block were encoded")
    lo, n = (np.cumsum(size) - size)[order], size[order]
    end = np.cumsum(n)
    index = np.arange(int(end[-1]) if len(end) else 0) - np.repeat(end - n, n) + np.repeat(lo, n)
    return Encoded(hashes, np.concatenate([[0], end]), flat[index].astype(np.int32))


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task encoded, as one value for each block that asked."""
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        ids = rows["ids"].combine_chunks()
        return _pack(np.asarray(rows["block"]), np.asarray(rows["number"]), ids)

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= PACKED_ROWS:
            yield flush()
    if held:
        yield flush()


def _assembled(frequent, joined: np.ndarray):
    """The pieces of each text of a block, from the frequent units and the block's own."""

    def run(texts: pa.Table, units: pa.Table) -> pa.Table:
        known = Encoded(*frequent.value)
        runs, rare = [], [np.empty(0, np.uint64)]
        for _, ids, data, starts, ends, first in _runs(iter(texts.to_batches()), joined):
            hashes = unit_hashes(data, starts, ends)
            at = known.find(hashes)
            runs.append((ids, at, first))
            rare.append(hashes[at < 0])
        own = _unpack(units["units"].to_pylist(), np.unique(np.concatenate(rare)))
        pieces = np.concatenate([known.ids, own.ids])
        # Both tables' places, one after the other.
        lo = np.concatenate([known.offsets[:-1], own.offsets[:-1] + len(known.ids)])
        size = np.concatenate([np.diff(known.offsets), np.diff(own.offsets)])
        out = [pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32()))})]
        for (ids, at, first), hashes in zip(runs, rare[1:], strict=True):
            at[at < 0] = own.find(hashes) + len(known.hashes)
            end = np.cumsum(size[at])
            total = int(end[-1]) if len(end) else 0
            index = np.arange(total) - np.repeat(end - size[at], size[at]) + np.repeat(lo[at], size[at])
            bounds = np.concatenate([[0], end])[first]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(pieces[index], pa.int32()))
            out.append(pa.table({"doc_id": ids, "ids": lists}))
        return pa.concat_tables(out)

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id`` and ``ids`` of each row's whole text.

    A space is put before a text that is not empty; nothing else is changed, so decoding
    gives the text back. A null or empty text has no ids. Equal texts get equal ids; ids
    of rows may be null or repeat, and each row is encoded. Long units are cut only between
    pieces of their best path, so the ids are those of the whole text's best path. Other
    columns are not looked at. A block of texts and its units are one task's, whatever they are.
    """
    spark, joined = docs.sparkSession, vocabulary.joined()
    bounded_batches(spark)
    lattice = spark.sparkContext.broadcast(vocabulary.lattice())
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = docs.select(*row_key(), "text")
    hashed = encode_units(frequent_units(sample, joined, lattice), vocabulary)
    # At most FREQUENT rows of a hash and a few numbers.
    known = Encoded.of(hashed.select(F.arrow_udf(_unit_hash, "long")("unit").alias("hash"), "ids").toArrow())
    frequent = spark.sparkContext.broadcast((known.hashes, known.offsets, known.ids))
    del known
    pa.default_memory_pool().release_unused()
    released(spark)

    # A task has the units of one block or so, so they can be grouped in memory; by default Spark
    # sorts their edges when there are more than 128 of them.
    if spark.conf.get(IN_MEMORY) == "128":
        spark.conf.set(IN_MEMORY, str(MOST_GROUPS))
    # Runs of rows are dealt to blocks by their place, so rows that repeat are spread too.
    blocks_ = max(2, docs.count() // ROWS_PER_BLOCK)
    place = F.floor(F.monotonically_increasing_id() / RUN)
    block = F.pmod(F.xxhash64(place), F.lit(blocks_)).cast("int")
    if blocks_ <= MOST_NAMED:
        block = F.get(F.array(*map(F.lit, even_keys(spark, blocks_))), block)
    texts = docs.withColumn("block", block.cast("long")).mapInArrow(_packed(joined, lattice), RUNS)
    texts = texts.repartition(blocks_, "block")
    # The units once each, their encoding and the join all use this one shuffle. The units are
    # told apart with all columns, and the filter is what the join would add on its side only:
    # with other columns or filters Spark would shuffle twice.
    wanted = texts.mapInArrow(_rare(frequent, joined), "unit string, block long, number int")
    wanted = wanted.filter("unit is not null").repartition(blocks_, "unit")
    distinct = wanted.groupBy("unit").agg(F.max("block").alias("b"), F.max("number").alias("n"))
    distinct = distinct.filter("b is not null or n is not null").select("unit")
    coded = encode_units(distinct, vocabulary).hint("shuffle_hash")
    own = wanted.join(coded, "unit").select("block", "number", "ids").mapInArrow(_returned, "block long, units binary")
    both = texts.groupBy("block").cogroup(own.groupBy("block"))
    return both.applyInArrow(_assembled(frequent, joined), "doc_id long, ids array<int>")


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The text of ``ids``: their bytes put together, without the space before the text."""
    table = F.split(F.lit(",".join(vocabulary.hex_by_id())), ",")
    digits = F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")
    return F.substring(F.decode(F.unhex(digits), "UTF-8"), F.lit(2), F.length(digits))
