"""Language identification by a small convolutional network over bytes, in numpy.

Bytes (A-Z lower-cased) are embedded, convolved with filters of several widths, pooled
by their maximum over a fixed-length window, and classified by softmax. It is trained on
the driver on a bounded sample of labelled texts. Applied, every text is cut into
windows of the trained length that cover it from its first byte to its last; the
windows of many texts are scored in one matrix product, and a text's class is the one
with the largest mean probability.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillstream.llm.common import LOWER, blocks

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
# At most so many texts of each language are learned from,
SAMPLE_PER_LANGUAGE = 800
# and at most so many in all: of many languages fewer of each, and of more languages than this
# the most frequent ones.
SAMPLE = 40_000
# So many probabilities are held at once.
PROBABILITIES = 5_000_000
EPOCHS = 12
UNKNOWN = "und"


@dataclass(frozen=True)
class Network:
    """The weights: byte embedding, all filters as one matrix, and the output layer."""

    labels: tuple[str, ...]
    embedding: np.ndarray  # 257 x EMBEDDING; row 256 stands for "no byte"
    filters: np.ndarray  # max(WIDTHS) * EMBEDDING x filters, zero beyond a filter's width
    bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray


NO_BYTE = 256


def _mask() -> np.ndarray:
    """Which weights of the filter matrix a filter of each width may use."""
    wide = max(WIDTHS)
    return np.concatenate(
        [np.repeat(np.arange(wide) < w, EMBEDDING)[:, None].repeat(FILTERS, 1) for w in WIDTHS],
        axis=1,
    ).astype(np.float32)


def _unrolled(net: Network, windows: np.ndarray) -> np.ndarray:
    """The embedded bytes below each filter position: windows x positions x inputs."""
    wide = max(WIDTHS)
    n, length = windows.shape
    padded = np.full((n, length + wide - 1), NO_BYTE, windows.dtype)
    padded[:, :length] = windows
    embedded = net.embedding[padded]
    out = np.empty((n, length, wide * EMBEDDING), np.float32)
    for k in range(wide):
        out[:, :, k * EMBEDDING : (k + 1) * EMBEDDING] = embedded[:, k : k + length]
    return out


def _pooled(net: Network, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    below = _unrolled(net, windows)
    n, length, width = below.shape
    maps = (below.reshape(-1, width) @ net.filters).reshape(n, length, -1)
    at = maps.argmax(axis=1)
    top = np.take_along_axis(maps, at[:, None, :], 1)[:, 0, :] + net.bias
    return below, at, top


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(net: Network, windows: np.ndarray, step: int = 128) -> np.ndarray:
    """Softmax output for each window of bytes; ``step`` windows are held unrolled at once."""
    out = np.empty((len(windows), len(net.labels)), np.float32)
    wide = max(WIDTHS)
    for lo in range(0, len(windows), step):
        below = _unrolled(net, windows[lo : lo + step])
        n, length, _ = below.shape
        maps = (below.reshape(-1, wide * EMBEDDING) @ net.filters).reshape(n, length, -1)
        hidden = np.maximum(maps.max(axis=1) + net.bias, 0)
        out[lo : lo + n] = _softmax(hidden @ net.output + net.output_bias)
    return out


def cut(data: np.ndarray, offsets: np.ndarray, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Windows that cover each text, and the text that each belongs to.

    A text of at least ``length`` bytes is covered by full windows, the last of which ends
    at its end; a shorter one is one padded window; an empty one has none.
    """
    sizes = np.diff(offsets)
    counts = -(-sizes // length)
    owner = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.minimum(nth * length, np.maximum(sizes[owner] - length, 0))
    at = start[:, None] + np.arange(length)
    inside = at < sizes[owner][:, None]
    at = np.where(inside, at + offsets[:-1][owner][:, None], 0)
    if not len(data):
        return np.empty((0, length), np.uint16), owner
    return np.where(inside, LOWER[data[at]].astype(np.uint16), np.uint16(NO_BYTE)), owner


def train(texts: list[str], langs: list[str], seed: int = 7) -> Network:
    """A network fitted to labelled texts by Adam on the cross entropy.

    Each epoch takes one window of each text, at a place that changes. Labels are sorted,
    so ties between classes go to the first. Without texts the network knows no label.
    """
    rng = np.random.default_rng(seed)
    labels = tuple(sorted(set(langs)))
    inputs, units = max(WIDTHS) * EMBEDDING, FILTERS * len(WIDTHS)
    mask = _mask()
    net = Network(
        labels,
        rng.normal(0, 0.5, (257, EMBEDDING)).astype(np.float32),
        rng.normal(0, 0.2, (inputs, units)).astype(np.float32) * mask,
        np.zeros(units, np.float32),
        rng.normal(0, 0.2, (units, len(labels))).astype(np.float32),
        np.zeros(len(labels), np.float32),
    )
    raw = [LOWER[np.frombuffer(t.encode(), np.uint8)] for t in texts]
    number = {x: k for k, x in enumerate(labels)}
    wanted = np.array([number[x] for x in langs], int)
    weights = [net.embedding, net.filters, net.bias, net.output, net.output_bias]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    # Rare languages count as much as frequent ones.
    share = len(wanted) / np.maximum(np.bincount(wanted, minlength=len(labels)), 1) / max(len(labels), 1)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(raw))
        for lo in range(0, len(order), 64):
            chosen = order[lo : lo + 64]
            windows = np.full((len(chosen), WINDOW), NO_BYTE, np.uint16)
            for i, k in enumerate(chosen):
                most = max(len(raw[k]) - WINDOW, 0)
                # Short windows are learned too, as short texts have to be told apart.
                size = WINDOW if rng.random() < 0.7 else int(rng.integers(16, WINDOW))
                start = int(rng.integers(0, most + 1))
                own = raw[k][start : start + size]
                windows[i, : len(own)] = own
            below, at, top = _pooled(net, windows)
            hidden = np.maximum(top, 0)
            out = _softmax(hidden @ net.output + net.output_bias)
            out[np.arange(len(chosen)), wanted[chosen]] -= 1
            out *= (share[wanted[chosen]] / len(chosen))[:, None].astype(np.float32)
            back = (out @ net.output.T) * (top > 0)
            picked = below[np.arange(len(chosen))[:, None], at]  # windows x units x inputs
            filters = np.einsum("nu,nui->iu", back, picked) * mask
            into = back[:, :, None] * net.filters.T[None]  # gradient of the picked inputs
            embedding = np.zeros_like(net.embedding)
            for k in range(max(WIDTHS)):
                where = np.minimum(at + k, WINDOW)
                byte = np.where(
                    at + k < WINDOW,
                    np.take_along_axis(windows, np.minimum(where, WINDOW - 1), 1),
                    NO_BYTE,
                )
                np.add.at(embedding, byte, into[:, :, k * EMBEDDING : (k + 1) * EMBEDDING])
            step += 1
            slopes = [embedding, filters, back.sum(0), hidden.T @ out, out.sum(0)]
            for w, g, (m, v) in zip(weights, slopes, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                w -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return net


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Network:
    """A network trained on a bounded sample of the rows of ``docs`` that have both values.

    Languages are counted over all rows. Of each the rows with the smallest hashes of id and
    text are drawn, ``SAMPLE_PER_LANGUAGE`` of them or, where all would be more than ``SAMPLE``,
    equally fewer; beyond ``SAMPLE`` languages only the most frequent ones are learned. Of each
    text drawn, 4,000 characters from a place that the hash tells go to the driver. These
    numbers bound what is fitted, and what the driver holds; ids may be null or repeat.
    """
    hashed = F.xxhash64("doc_id", "text")
    rows = docs.select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), "doc_id"
    ).filter("text is not null and text <> '' and lang is not null")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.lang: r.n for r in counts.orderBy(F.desc("n"), "lang").limit(SAMPLE).collect()}
    if not counts:
        return train([], [])
    wanted = min(SAMPLE_PER_LANGUAGE, max(1, SAMPLE // len(counts)))
    start = F.pmod(F.shiftright("hash", 30), F.greatest(F.length("text") - 4000, F.lit(1))) + 1
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))

    def drawn(rates: list[tuple[str, float]]) -> list:
        """The first rows of these languages, of those that have a hash below the rate."""
        those = F.broadcast(docs.sparkSession.createDataFrame(rates, "lang string, rate double"))
        few = rows.withColumn("hash", hashed).join(those, "lang")
        few = few.filter(F.pmod("hash", F.lit(1 << 30)) < F.col("rate") * F.lit(float(1 << 30)))
        few = few.select("lang", "hash", F.substring("text", start.cast("int"), F.lit(4000)).alias("text"))
        return few.withColumn("rank", rank).filter(F.col("rank") <= wanted).select("lang", "text").collect()

    # Most rows are left out before they are ranked; where few are left, as rows repeat, none is.
    sample = drawn([(k, min(1.0, (2 * wanted + 50) / n)) for k, n in sorted(counts.items())])
    seen = Counter(r.lang for r in sample)
    short = {k for k, n in counts.items() if 2 * seen[k] < min(wanted, n)}
    if short:
        sample = [r for r in sample if r.lang not in short] + drawn([(k, 1.0) for k in sorted(short)])
    found = sorted((r.text, r.lang) for r in sample)
    return train([t for t, _ in found], [x for _, x in found])


_RESULT = T.StructType(
    [T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]
)


def _classify(net: Network):
    def run(texts: pa.Array) -> pa.Array:
        langs: list[str | None] = []
        scores: list[float] = []
        batch = pa.record_batch([texts], names=["text"])
        few = max(PROBABILITIES // max(len(net.labels), 1), 1)
        batches = (batch.slice(k, few) for k in range(0, len(batch), few))
        for _, data, offsets in blocks(batches, "text", min(1 << 20, few * WINDOW)):
            windows, owner = cut(data, offsets)
            total = np.zeros((len(offsets) - 1, len(net.labels)))
            if len(windows) and net.labels:
                np.add.at(total, owner, probabilities(net, windows))
            counts = np.bincount(owner, minlength=len(total))
            for row, n in zip(total, counts, strict=True):
                best = int(row.argmax()) if n and len(row) else -1
                langs.append(net.labels[best] if best >= 0 else UNKNOWN)
                scores.append(min(1.0, float(row[best] / n)) if best >= 0 else 0.0)
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"]
        )

    return run


def identify(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    A null or empty text, or one without a letter, is ``und`` with score 0; so is every
    text if the network knows no label. Other texts are judged whole. Equal texts are
    judged alike; rows are neither moved nor merged. Columns that are already called
    ``lang_pred`` or ``score`` are replaced.
    """
    classify = F.arrow_udf(_classify(net), _RESULT)
    own = [c for c in docs.columns if c not in ("lang_pred", "score")]
    judged = docs.select(
        F.struct(*own).alias("row"),
        classify(F.coalesce(F.col(text_col), F.lit(""))).alias("guess"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    return judged.select(
        "row.*",
        F.when(F.col("letters"), F.col("guess.lang")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("letters"), F.col("guess.score")).otherwise(F.lit(0.0)).alias("score"),
    )


def held_out(doc_id="doc_id"):
    """Rows that are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
