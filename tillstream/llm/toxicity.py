"""Toxicity by the nearest labelled examples.

A bounded sample of the labelled documents is the set of examples. The terms are the words
that are significantly more frequent in examples with label 1 than in those with label 0
(chi-square); their document frequencies are counted over all documents. Texts are compared
by the cosine of their TF-IDF vectors over these terms, with ``1 + ln(tf)`` and smoothed idf.

Examples are numbered so that similar ones are neighbours and cut into blocks. The inverted
index keeps, by block and term, the postings and their largest weight. For a query the
largest weights bound what any example of a block can score; blocks are taken in descending
order of that bound, a few and then more at a time, until it is below what the nearest examples
found reach. The queries that want a block are multiplied with its postings together, in single
precision; examples that may be among the nearest by that get their exact cosine. Bounds are
widened beyond rounding and ties go to the lower number, so the result is that of comparing
with every example.

How many terms there are is chosen by how well examples are judged by the others. The nearest
examples vote with weights that fall with their distance, each for as many labelled documents
as it stands for. How often votes are right is learned from the examples too, each judged by
the others, and maps a vote to the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import LOWER, LOWERED_PUNCTUATION, blocks, kept, mixed, word_hashes, word_spans

# At most so many examples of each label.
EXAMPLES = 5_000
# Numbers of terms that are tried; the one that judges examples best by the others is taken.
TERMS = (32, 128, 512)
# Examples that are judged for that.
TRIED = 2_000
# Chi-square of a term with one degree of freedom, at one in a thousand.
SIGNIFICANT = 10.83
NEIGHBOURS = 25
# Examples of a block of the index.
BLOCK = 64
# Blocks that a query is compared with at first, and how many times as many each time after.
FIRST, WIDER = 2, 8
# Of so many examples only the best counts for what the nearest reach at least.
GROUP = 16
# What votes fall to at distance 1 is about this share of what they are at distance 0.
FLOOR = 0.05
# Votes of the labelled documents' mean that every text has beside its neighbours'.
PRIOR = 1.0
EVIDENCE = 5
# Examples are drawn by so many buckets of their ids.
BUCKETS = 1 << 14
# Queries are searched for together, as many as need so many numbers.
CELLS = 1 << 22


def held_out(key: str = "doc_id") -> Column:
    """One in five, by id; rows without an id are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(True))


# --- the index ---


@dataclass(frozen=True)
class Vectors:
    """Sparse rows: terms ascending, weights of unit length, and each row's first place."""

    first: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of(rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray, size: int) -> Vectors:
        """From (row, term, count) triples, sorted by row and term."""
        weights = (1 + np.log(counts)) * idf[terms]
        lengths = np.sqrt(np.bincount(rows, weights * weights, minlength=size))
        return Vectors(np.searchsorted(rows, np.arange(size + 1)), terms, weights / lengths[rows])

    @staticmethod
    def joined(parts: list[Vectors]) -> Vectors:
        """The rows of all, one after another."""
        sizes = np.concatenate([np.diff(p.first) for p in parts])
        terms, weights = (np.concatenate(x) for x in zip(*[(p.terms, p.weights) for p in parts], strict=True))
        return Vectors(np.concatenate([[0], np.cumsum(sizes)]), terms, weights)

    def __len__(self) -> int:
        return len(self.first) - 1


def _ragged(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``lo[0], lo[0] + 1, … (n[0] of them), lo[1], …``"""
    end = np.cumsum(n)
    return np.arange(int(end[-1]) if len(end) else 0) + np.repeat(lo - (end - n), n)


class BlockMaxIndex:
    """The inverted index over example vectors."""

    def __init__(self, examples: Vectors, terms: int) -> None:
        self.examples, self.size, self.terms = examples, len(examples), terms
        self.blocks = -(-self.size // BLOCK)
        self.scored = 0  # pairs of a query and a block that were scored, for tests and figures
        self.owner = np.repeat(np.arange(self.size), np.diff(examples.first))
        self.most = np.zeros((terms, self.blocks), np.float32)
        np.maximum.at(self.most, (examples.terms, self.owner // BLOCK), examples.weights.astype(np.float32))
        # A product of two rows in single precision differs by less than this share of it.
        self.error = (terms + 4) * 2.0**-23

    def nearest(self, queries: Vectors, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the ``k`` nearest examples of each query, the nearest first;
        where the cosine is 0 there is none."""
        numbers = np.full((len(queries), k), self.size)
        cosines = np.zeros((len(queries), k))
        rows = np.flatnonzero(np.diff(queries.first))
        step = max(1, CELLS // (self.terms + self.blocks * BLOCK))
        if self.size:
            for at in range(0, len(rows), step):
                self._search(queries, rows[at : at + step], numbers, cosines)
        return numbers, cosines

    def _postings(self, block: int) -> np.ndarray:
        """The weights of a block by term and example."""
        examples = np.arange(block * BLOCK, min((block + 1) * BLOCK, self.size) + 1)
        a, b = self.examples.first[examples[[0, -1]]]
        weights = np.zeros((self.terms, BLOCK), np.float32)
        weights[self.examples.terms[a:b], self.owner[a:b] % BLOCK] = self.examples.weights[a:b]
        return weights

    def _search(self, queries: Vectors, rows: np.ndarray, numbers: np.ndarray, cosines: np.ndarray) -> None:
        k = numbers.shape[1]
        sizes = queries.first[rows + 1] - queries.first[rows]
        entry = _ragged(queries.first[rows], sizes)
        cell = np.repeat(np.arange(len(rows)) * self.terms, sizes) + queries.terms[entry]
        exact = np.zeros(len(rows) * self.terms)
        exact[cell] = queries.weights[entry]
        dense = exact.reshape(len(rows), -1).astype(np.float32)
        bounds = dense @ self.most * np.float32(1 + 4 * self.error)
        rank = np.argsort(np.argsort(-bounds, axis=1, kind="stable"), axis=1)
        found = np.zeros((len(rows), self.blocks * BLOCK), np.float32)
        least = np.zeros(len(rows), np.float32)
        first, last = 0, FIRST
        while first < self.blocks:
            # An equal score may still win by a lower number.
            wanted = (rank >= first) & (rank < last) & (bounds > 0) & (bounds >= least[:, None])
            if not wanted.any():
                break
            self.scored += int(wanted.sum())
            for block in np.flatnonzero(wanted.any(axis=0)):
                at = np.flatnonzero(wanted[:, block])
                found[at, block * BLOCK : (block + 1) * BLOCK] = dense[at] @ self._postings(block)
            # The k-th largest of the groups' best scores: so many examples reach it. Neighbours
            # in the index, which are alike, are of different groups.
            best = found.reshape(len(rows), GROUP, -1).max(axis=1)
            if best.shape[1] >= k:
                least = np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k]
            first, last = last, last * WIDER
        enough = np.maximum(least * np.float32(1 - 4 * self.error), np.finfo(np.float32).tiny)
        query, number = np.divmod(np.flatnonzero(found >= enough[:, None]), found.shape[1])
        score = self._cosines(exact, query, number)
        order = np.lexsort((number, -score, query))
        query, number, score = query[order], number[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, np.arange(len(rows)))[query]
        near = place < k
        numbers[rows[query[near]], place[near]] = number[near]
        cosines[rows[query[near]], place[near]] = score[near]

    def _cosines(self, exact: np.ndarray, query: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The cosines of pairs of a query and an example, summed by ascending term."""
        score = np.zeros(len(query))
        lo, n = self.examples.first[number], self.examples.first[number + 1] - self.examples.first[number]
        end = np.cumsum(n)
        cut = np.searchsorted(end, np.arange(0, int(end[-1]) if len(end) else 0, CELLS), "right")
        for a, b in zip(cut, [*cut[1:], len(query)]):
            posting = _ragged(lo[a:b], n[a:b])
            pair = np.repeat(np.arange(b - a), n[a:b])
            product = exact[query[a:b][pair] * self.terms + self.examples.terms[posting]] * self.examples.weights[posting]
            score[a:b] = np.bincount(pair, product, minlength=b - a)
        return score


# --- what is learned ---


@dataclass(frozen=True)
class Toxicity:
    """Terms by sorted hash with their idf, the index, what examples say, and the calibration."""

    vocabulary: np.ndarray
    idf: np.ndarray
    index: BlockMaxIndex
    ids: np.ndarray
    labels: np.ndarray
    stands_for: np.ndarray
    mean: float
    slope: float = 1.0
    shift: float = 0.0

    def votes(self, numbers: np.ndarray, cosines: np.ndarray) -> np.ndarray:
        """The share of label 1 among the neighbours, by distance and by what they stand for."""
        safe = np.minimum(numbers, max(len(self.ids) - 1, 0))
        nearness = FLOOR / (FLOOR + np.clip(1 - cosines, 0, 1))
        weight = np.where(cosines > 0, nearness, 0.0)
        if len(self.ids):
            weight = weight * self.stands_for[safe]
            for_one = (weight * self.labels[safe]).sum(axis=1)
        else:
            for_one = np.zeros(len(numbers))
        prior = PRIOR * (self.stands_for.mean() if len(self.ids) else 1.0)
        return (for_one + prior * self.mean) / (weight.sum(axis=1) + prior)

    def scores(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * logit(votes) + self.shift)))

    def queries(self, data: np.ndarray, offsets: np.ndarray) -> Vectors:
        """The texts of a block as vectors."""
        rows, terms, counts = term_counts(data, offsets, self.vocabulary)
        return Vectors.of(rows, terms, counts, self.idf, len(offsets) - 1)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def calibrated(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of the logistic curve of ``y`` over ``x``, by Newton's method."""
    slope, shift = 1.0, 0.0
    design = np.stack([x, np.ones_like(x)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
        # A little ridge towards (1, 0) keeps separable votes finite.
        gradient = design @ (weights * (y - p)) - np.array([slope - 1, shift])
        curve = (design * (weights * p * (1 - p))) @ design.T + np.eye(2)
        step = np.linalg.solve(curve, gradient)
        slope, shift = slope + float(np.clip(step[0], -2, 2)), shift + float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-9:
            break
    return max(slope, 0.0), shift


def term_counts(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray | None = None):
    """(text, term, count) of a block's lower-cased words, sorted by text and term. Terms are
    numbers in the sorted ``vocabulary`` and other words left out, or without it the hashes."""
    starts, ends, first = word_spans(data, offsets, LOWERED_PUNCTUATION)
    hashes = word_hashes(LOWER[data], starts, ends)
    owner = np.searchsorted(first, np.arange(len(hashes)), "right") - 1
    if vocabulary is None:
        order = np.lexsort((hashes, owner))
        owner, terms = owner[order], hashes[order]
    else:
        at = np.searchsorted(vocabulary, hashes)
        known = np.flatnonzero(at < len(vocabulary))
        known = known[vocabulary[at[known]] == hashes[known]]
        cell = np.sort(owner[known] * max(len(vocabulary), 1) + at[known])
        owner, terms = np.divmod(cell, max(len(vocabulary), 1))
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (terms[1:] != terms[:-1])
    at = np.flatnonzero(new)
    return owner[at], terms[at], np.diff(np.append(at, len(owner)))


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each example's words with their counts, and a row without a word for the example itself."""
    for batch, data, offsets in blocks(batches, "text"):
        rows, terms, counts = term_counts(data, offsets)
        every = pa.array(np.concatenate([np.arange(len(batch)), rows]))
        none = pa.nulls(len(batch), pa.int64())
        yield pa.record_batch(
            [
                batch.column("id").take(every),
                batch.column("label").take(every),
                pa.concat_arrays([none, pa.array(terms.view(np.int64))]),
                pa.array(np.concatenate([np.zeros(len(batch), np.int64), counts])),
            ],
            names=["id", "label", "term", "n"],
        )


def _holders(vocabulary: np.ndarray):
    """In how many texts each term stands; the number of texts comes last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary) + 1, np.int64)
        for batch, data, offsets in blocks(batches, "text"):
            _, terms, _ = term_counts(data, offsets, vocabulary)
            total[:-1] += np.bincount(terms, minlength=len(vocabulary))
            total[-1] += len(batch)
        yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], names=["term", "n"])

    return run


def examples(docs: DataFrame, labels: DataFrame, key: str, label: str, most: int) -> tuple[DataFrame, dict[int, int]]:
    """``id``, ``label`` and ``text`` of at most ``most`` documents of each label, and how many
    documents have it.

    They are drawn by hashes of their ids; where there are more, a few less than ``most`` may be
    drawn, as a bucket of ids is taken whole or not at all. Labels other than 0 and 1 don't
    count, and an id whose rows name both equally often has none. The choice reads no text;
    of rows that repeat an id the smallest text counts.
    """
    named = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).cast("long").alias("id"))
    voted = named.agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(-1)).alias("sum")).filter("sum <> 0")
    voted = kept(voted.select("id", (F.col("sum") > 0).cast("int").alias("label")), "labels")
    totals = {r.label: r["count"] for r in voted.groupBy("label").count().collect()}
    # About twice as many as are needed are dealt to fine buckets, of which the first are taken.
    share = F.lit(0.0)
    for value, total in totals.items():
        share = F.when(F.col("label") == value, min(1.0, (2 * most + 100) / total)).otherwise(share)
    drawn = voted.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * (1 << 30))
    dealt = drawn.withColumn("bucket", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(BUCKETS)).cast("int"))
    room, limit = {v: most for v in totals}, {v: 0 for v in totals}
    for r in sorted(dealt.groupBy("bucket", "label").count().collect()):
        room[r.label] -= r["count"]
        if room[r.label] >= 0:
            limit[r.label] = r.bucket + 1
    taken = F.lit(False)
    for value, end in limit.items():
        taken = taken | (F.col("label") == value) & (F.col("bucket") < end)
    chosen = dealt.filter(taken).select("id", "label")
    texts = docs.select(F.col(key).cast("long").alias("id"), "text").join(F.broadcast(chosen), "id")
    return texts.groupBy("id", "label").agg(F.min("text").alias("text")), totals


@dataclass(frozen=True)
class Fitted:
    """Examples as rows (example, term, count), with terms from the one with the largest chi-square
    on; their ids and labels; how many examples of label 0 and 1 there are, and for how many
    documents each stands."""

    owner: np.ndarray
    term: np.ndarray
    count: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    found: np.ndarray
    stands: np.ndarray
    mean: float

    def model(self, hashes: np.ndarray, idf: np.ndarray) -> tuple[Toxicity, Vectors]:
        """The index over the examples that hold one of these terms, not yet calibrated."""
        by_hash = np.argsort(hashes)
        place = np.empty(len(hashes), np.int64)
        place[by_hash] = np.arange(len(hashes))
        held = self.term < len(hashes)
        term, count = place[self.term[held]], self.count[held]
        there, owner = np.unique(self.owner[held], return_inverse=True)
        ids, labels, idf = self.ids[there], self.labels[there], idf[by_hash]
        # Examples with the same heaviest term stand together, within it in an order by hash.
        weights = (1 + np.log(count)) * idf[term]
        order = np.lexsort((term, -weights, owner))
        heaviest = term[order[np.searchsorted(owner[order], np.arange(len(ids)))]]
        ranked = np.lexsort((mixed(ids.astype(np.uint64)), heaviest))
        number = np.empty(len(ids), np.int64)
        number[ranked] = np.arange(len(ids))
        ids, labels, owner = ids[ranked], labels[ranked], number[owner]
        order = np.lexsort((term, owner))
        vectors = Vectors.of(owner[order], term[order], count[order], idf, len(ids))
        index = BlockMaxIndex(vectors, max(len(hashes), 1))
        return Toxicity(hashes[by_hash], idf, index, ids, labels, self.stands[labels], self.mean), vectors

    def judged(self, model: Toxicity, vectors: Vectors, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Votes (as logits), labels and weights of at most ``most`` of the model's examples, each
        judged by the others, and of all examples without a term, which have one vote."""
        n = len(model.ids)
        rows = np.arange(0, n, max(1, -(-n // most)))
        first, last = vectors.first[rows], vectors.first[rows + 1]
        at = _ragged(first, last - first)
        queries = Vectors(np.concatenate([[0], np.cumsum(last - first)]), vectors.terms[at], vectors.weights[at])
        numbers, cosines = model.index.nearest(queries, NEIGHBOURS + 1)
        itself = numbers == rows[:, None]
        itself[~itself.any(axis=1), -1] = True
        numbers, cosines = numbers[~itself].reshape(len(rows), NEIGHBOURS), cosines[~itself].reshape(len(rows), NEIGHBOURS)
        without = np.maximum(self.found - np.bincount(model.labels, minlength=2), 0) * self.stands
        none = model.votes(np.full((2, 1), n), np.zeros((2, 1)))
        return (
            logit(np.concatenate([model.votes(numbers, cosines), none])),
            np.concatenate([model.labels[rows], [0, 1]]).astype(float),
            np.concatenate([model.stands_for[rows] * (n / max(1, len(rows))), without]),
        )


def learn(
    docs: DataFrame,
    labels: DataFrame,
    corpus: DataFrame | None = None,
    key: str = "doc_id",
    label: str = "toxic",
    most_examples: int = EXAMPLES,
    most_terms: tuple[int, ...] = TERMS,
) -> Toxicity:
    """What ``labels`` say of ``docs``; document frequencies are those of ``corpus``, all texts.

    At most ``most_examples`` documents of each label are fitted on; of the terms those with the
    largest chi-square are used, as many of ``most_terms`` as judge the examples best. Both bound
    what is sent to all tasks. Without labels, or with one label only, there are no terms and
    every text gets the mean label (0 without any).
    """
    chosen, totals = examples(docs, labels, key, label, most_examples)
    words = kept(chosen.mapInArrow(_example_terms, "id long, label int, term long, n long"), "example-terms")
    found = {r.label: r["count"] for r in words.filter("term is null").groupBy("label").count().collect()}
    ones, zeros = found.get(1, 0), found.get(0, 0)
    mean = totals.get(1, 0) / max(1, sum(totals.values()))

    a, b = F.sum("label").cast("double"), F.sum(1 - F.col("label")).cast("double")
    held = words.filter("term is not null").groupBy("term").agg(a.alias("a"), b.alias("b"))
    a, b, c, d = F.col("a"), F.col("b"), ones - F.col("a"), zeros - F.col("b")
    ratio = (ones + zeros) * F.pow(a * d - b * c, F.lit(2.0)) / F.greatest((a + b) * (c + d) * ones * zeros, F.lit(1.0))
    marked = held.withColumn("chi", ratio).filter((F.col("chi") >= SIGNIFICANT) & (a * zeros > b * ones))
    terms = marked.orderBy(F.desc("chi"), "term").limit(max(most_terms)).select("term").collect()
    hashes = np.array([r.term for r in terms], np.int64).view(np.uint64)

    by_hash = np.argsort(hashes)
    holders = (corpus if corpus is not None else docs).select("text")
    holders = holders.mapInArrow(_holders(hashes[by_hash]), "term long, n long")
    counts = np.zeros(len(hashes) + 1, np.int64)
    for row in holders.groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row.term] = row.n
    idf = np.empty(len(hashes))
    idf[by_hash] = np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1

    few = docs.sparkSession.createDataFrame([(int(t), i) for i, t in enumerate(hashes.view(np.int64))], "term long, rank long")
    # At most 2 * most_examples * max(most_terms) rows.
    rows = words.join(F.broadcast(few), "term").select("id", "label", "rank", "n").toArrow()
    ids, owner = np.unique(np.asarray(rows["id"]), return_inverse=True)
    said = np.zeros(len(ids), np.int64)
    said[owner] = np.asarray(rows["label"])
    stands = np.array([totals.get(v, 0) / max(1, found.get(v, 0)) for v in (0, 1)])
    term, count = np.asarray(rows["rank"]), np.asarray(rows["n"])
    fitted = Fitted(owner, term, count, ids, said, np.array([zeros, ones]), stands, mean)

    if not len(ids):
        return fitted.model(hashes[:0], idf[:0])[0]
    losses = {}
    for n in sorted({min(n, len(hashes)) for n in most_terms}):
        model, vectors = fitted.model(hashes[:n], idf[:n])
        x, y, weights = fitted.judged(model, vectors, TRIED)
        slope, shift = calibrated(x, y, weights)
        p = 1 / (1 + np.exp(-(slope * x + shift)))
        losses[n] = -np.average(np.log(np.maximum(np.where(y > 0, p, 1 - p), 1e-9)), weights=weights)
    n = min(losses, key=losses.get)
    model, vectors = fitted.model(hashes[:n], idf[:n])
    slope, shift = calibrated(*fitted.judged(model, vectors, len(ids)))
    return replace(model, slope=slope, shift=shift)


def _scored(broadcast, neighbours: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for batch in batches:
            # A block's few hundred texts are too few to search for together.
            texts = [model.queries(data, offsets) for _, data, offsets in blocks(iter([batch]), "text")]
            if not texts:
                continue
            numbers, cosines = model.index.nearest(Vectors.joined(texts), neighbours)
            votes = model.votes(numbers, cosines)
            scores = model.scores(votes) if len(model.ids) else np.full(len(batch), model.mean)
            shown = cosines[:, :EVIDENCE] > 0
            at = numbers[:, :EVIDENCE][shown]
            evidence = pa.StructArray.from_arrays(
                [pa.array(model.ids[at]), pa.array(cosines[:, :EVIDENCE][shown]), pa.array(model.labels[at].astype(np.int32))],
                names=["example", "cosine", "label"],
            )
            bounds = np.concatenate([[0], np.cumsum(shown.sum(axis=1))])
            yield pa.record_batch(
                [
                    *[batch.column(c) for c in batch.schema.names if c != "text"],
                    pa.array(scores),
                    pa.array((scores >= 0.5).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), evidence),
                ],
                names=[*[c for c in batch.schema.names if c != "text"], "score", "predicted", "evidence"],
            )

    return run


def score(docs: DataFrame, model: Toxicity, key: str = "doc_id", neighbours: int = NEIGHBOURS) -> DataFrame:
    """``key``, ``score``, ``predicted`` and ``evidence`` of each row's whole text.

    ``score`` is the calibrated vote of the ``neighbours`` nearest examples, ``predicted`` whether
    it is at least 0.5, ``evidence`` the nearest of them with cosine and label. A text without any
    of the terms, an empty one and null get the vote of the mean label and no evidence. Equal
    texts get equal scores; nulls and repeats in ``key`` are kept, other columns not read. A
    text of any length is read whole; it is one row of a block.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()
    evidence = "array<struct<example:long,cosine:double,label:int>>"
    return docs.select(key, "text").mapInArrow(
        _scored(broadcast, neighbours), f"`{key}` {kind}, score double, predicted int, evidence {evidence}"
    )
