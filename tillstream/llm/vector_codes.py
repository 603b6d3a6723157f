"""Vector code compression: each part of a vector as the number of its nearest codebook entry.

The entries of a part position are searched with a geometric near-neighbour access tree
(GNAT). A node has a few entries as split points; each other entry belongs to the nearest of
them. For every pair of a split point and a child the node keeps the smallest and largest
distance from the point to the child's entries. Once the distance q of a query to a split
point is known and the best distance so far is r, a child whose range lies wholly above
q + r or below q - r holds nothing as near, and is left out with all below it.

Distances in these tests are rounded such that nothing is left out that might be as near;
what remains is compared by exact integer squared distances, ties to the lower index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import small, written
from tillstream.llm.exact_vectors import (
    added_up,
    decimals,
    floored,
    matrix,
    slots,
    sound,
    sums_by,
)

# Nodes with at most this many entries keep them as a list.
LEAF = 3
SPLIT_POINTS = 4
# Far above the relative error of a square root and a difference of doubles.
SLACK = 1e-12
# Rows of one label are spread over so many tasks where labels are too many to broadcast.
SALTS = 32


def squared(q: np.ndarray, point: np.ndarray) -> np.ndarray:
    apart = q - point
    return (apart * apart).sum(axis=-1)


@dataclass(frozen=True)
class Node:
    """``ids`` are the entries of a leaf, or the split points of a node with ``children``.

    ``least`` and ``most`` hold, by split point and child, the range of distances from the
    point to the child's own split point and all entries below it.
    """

    ids: np.ndarray
    children: tuple[Node | None, ...] = ()
    least: np.ndarray | None = None
    most: np.ndarray | None = None


class Gnat:
    """The tree over the rows of ``entries``, and its search."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.compared = 0  # distances computed, for tests and figures
        self.root = self._node(np.arange(len(entries)))

    def _node(self, ids: np.ndarray) -> Node:
        if len(ids) <= max(LEAF, SPLIT_POINTS):
            return Node(ids)
        # Split points far apart: each next one is farthest from those before it.
        points = [int(ids[0])]
        away = squared(self.entries[ids], self.entries[points[0]])
        while len(points) < SPLIT_POINTS:
            away[np.isin(ids, points)] = -1
            points.append(int(ids[np.argmax(away)]))
            away = np.minimum(away, squared(self.entries[ids], self.entries[points[-1]]))
        apart = np.stack([squared(self.entries[ids], self.entries[p]) for p in points])
        owner = np.argmin(apart, axis=0)
        owner[[int(np.flatnonzero(ids == p)[0]) for p in points]] = np.arange(len(points))
        far = np.sqrt(apart.astype(float))
        ranges = [(far[:, owner == j].min(axis=1), far[:, owner == j].max(axis=1)) for j in range(len(points))]
        below = [ids[(owner == j) & ~np.isin(ids, points)] for j in range(len(points))]
        return Node(
            np.array(points),
            tuple(self._node(b) if len(b) else None for b in below),
            np.stack([r[0] for r in ranges], axis=1) * (1 - SLACK),
            np.stack([r[1] for r in ranges], axis=1) * (1 + SLACK),
        )

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each query (ties: the lower index), and its squared distance."""
        best = np.full(len(queries), len(self.entries))
        distance = np.full(len(queries), np.iinfo(np.int64).max)
        self._search(self.root, queries, np.arange(len(queries)), best, distance)
        return best, distance

    def _compare(self, entry: int, q: np.ndarray, rows: np.ndarray, best: np.ndarray, distance: np.ndarray) -> np.ndarray:
        found = squared(q[rows], self.entries[entry])
        self.compared += len(rows)
        nearer = (found < distance[rows]) | (found == distance[rows]) & (entry < best[rows])
        best[rows[nearer]], distance[rows[nearer]] = entry, found[nearer]
        return found

    def _search(self, node: Node, q: np.ndarray, rows: np.ndarray, best: np.ndarray, distance: np.ndarray) -> None:
        if not node.children:
            for entry in node.ids.tolist():
                self._compare(entry, q, rows, best, distance)
            return
        # to[i, r]: from split point i to query r; not a number where it was left out.
        to = np.full((len(node.ids), len(rows)), np.nan)
        alive = np.ones((len(node.ids), len(rows)), bool)
        for i, entry in enumerate(node.ids.tolist()):
            at = np.flatnonzero(alive[i])
            if len(at):
                to[i, at] = np.sqrt(self._compare(entry, q, rows[at], best, distance).astype(float))
                reach = np.sqrt(distance[rows[at]].astype(float)) * (1 + SLACK)
                self._leave_out(alive, node, i, at, to[i, at], reach)
        # The best distance may have become smaller since.
        reach = np.sqrt(distance[rows].astype(float)) * (1 + SLACK)
        for i in range(len(node.ids)):
            known = np.flatnonzero(~np.isnan(to[i]))
            self._leave_out(alive, node, i, known, to[i, known], reach[known])
        for j, child in enumerate(node.children):
            at = np.flatnonzero(alive[j])
            if child is not None and len(at):
                self._search(child, q, rows[at], best, distance)

    @staticmethod
    def _leave_out(alive: np.ndarray, node: Node, i: int, at: np.ndarray, to: np.ndarray, reach: np.ndarray) -> None:
        low, high = to * (1 - SLACK), to * (1 + SLACK)
        for j in range(len(node.ids)):
            out = (low - node.most[i, j] > reach) | (node.least[i, j] - high > reach)
            alive[j, at[out]] = False


def _coded(trees: list[Gnat], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each vector's parts, and their squared distances."""
    found = [tree.nearest(part) for tree, part in zip(trees, np.split(x, len(trees), axis=1), strict=True)]
    return np.stack([c for c, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _entry_sums(books: np.ndarray):
    """Sums and numbers of the parts that each entry is nearest to."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), parts * width)
            codes, _ = _coded(trees, x)
            for p, part in enumerate(np.split(x, parts, axis=1)):
                total[p] += sums_by(codes[:, p], part, entries)
        yield slots(total)

    return run


_HEX = np.array([f"{i:02x}" for i in range(256)], "S2")


def _codes(books: np.ndarray):
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch in batches:
            codes, distances = _coded(trees, matrix(batch.column("x"), parts * width))
            text = np.ascontiguousarray(_HEX[codes]).view(f"S{2 * parts}").ravel().astype(str)
            yield pa.record_batch(
                [batch.column("vec_id"), batch.column("label"), pa.array(text.tolist(), pa.string()), pa.array(distances.sum(axis=1))],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def compressed(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    Null vectors and those with a null or non-finite component are left out. A component x
    becomes ``floor(scale * x)``, a vector ``parts`` equal parts. The codebook of each part
    position starts as that part of the vectors with the ``entries`` (at most 256) smallest ids,
    fewer where there are fewer. Each round assigns every part to the nearest entry (ties: the
    lower index) and replaces each entry that is used by the floor of its parts' mean; the
    last assignment gives the codes (two hex digits a part), ``error`` sums its squared
    distances and ``label_error`` the errors of an equal label, null labels being equal.

    All vectors must be as long as the one with the smallest id, and so long that they can be
    cut into equal parts; vectors of another length are left out, as no code fits them, and a
    length that ``parts`` does not divide raises ``ValueError``. Rows are vectors of their own
    where ids repeat (then ordered by components); null ids come last and stay in the result.
    No vector gives an empty result. Other columns are not read. Components so large that a
    squared distance might not fit 64 bits raise ``OverflowError``.

    Each round reads the vectors once; what tasks send is added up before the shuffle, and
    the driver gets the sums of the entries. The vectors are written once, as integers.
    """
    spark = vectors.sparkSession
    if not 0 < entries <= 256:
        raise ValueError(f"entries: {entries}")
    kind = vectors.schema[label].dataType
    ints, _ = written(
        vectors.filter(sound(vector) & (F.size(vector) > 0)).select(
            F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), floored(vector, scale).alias("x")
        ),
        "integers",
    )
    order = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    smallest = ints.orderBy(*order).select("x").limit(1).collect()
    if not smallest:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    dims = len(smallest[0].x)
    if dims % parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {parts} equal parts")
    ints = ints.filter(F.size("x") == dims)
    start = np.array([r.x for r in ints.orderBy(*order).select("x").limit(entries).collect()], np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), parts, dims // parts).transpose(1, 0, 2))
    for _ in range(rounds):
        sums = ints.select("x").mapInArrow(_entry_sums(books), "slot long, amount long")
        totals = added_up(sums, (*books.shape[:2], books.shape[2] + 1))
        moved, used = books.copy(), totals[..., -1] > 0
        moved[used] = totals[used][:, :-1] // totals[used][:, -1:]
        if np.array_equal(moved, books):  # all further rounds would be the same
            break
        books = moved
    schema = f"vec_id long, label {kind.simpleString()}, code string, error long"
    coded, _ = written(ints.mapInArrow(_codes(books), schema), "codes")
    digest = F.lit(hashlib.sha256(decimals(books).encode()).hexdigest())
    return _with_label_errors(coded).select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def _with_label_errors(coded: DataFrame, limit: int | None = None) -> DataFrame:
    """``label_error`` beside each row; no task gets all rows of a label."""
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    if small(totals, *([] if limit is None else [limit])):
        return coded.join(F.broadcast(totals), F.col("label").eqNullSafe(F.col("of")))
    salted = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = coded.withColumn("own", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    same = F.col("label").eqNullSafe(F.col("of")) & (F.col("own") == F.col("salt"))
    return dealt.join(salted, same)
