from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents
from tillstream.llm.common import table
from tillstream.llm.language_id import (
    NO_BYTE,
    UNKNOWN,
    WINDOW,
    cut,
    held_out,
    identify,
    learn,
    probabilities,
    train,
)


@pytest.fixture(scope="module")
def learned(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    return docs, learn(docs.filter(~held_out()))


def test_held_out_accuracy(spark, learned):
    docs, net = learned
    got = identify(docs.select("doc_id", "text", F.col("lang").alias("truth")).filter(held_out()), net)
    rows = got.collect()
    assert len(rows) > 200
    assert sum(r.lang_pred == r.truth for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_is_the_remainder_of_the_checksum(spark):
    ids = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", held_out().alias("out"))
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in ids.collect())


def test_odd_rows(spark, learned):
    docs, net = learned
    one = docs.filter("lang = 'fr'").orderBy("doc_id").first().text
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "a"), (5, one * 60), (6, one), (7, one), (None, one)]
    got = identify(documents(spark, rows, "lang_pred score row guess letters"), net)
    assert got.columns.count("lang_pred") == got.columns.count("score") == 1
    found = [(r.doc_id, r.lang_pred, r.score) for r in got.collect()]
    assert [x[1] for x in found[:3]] == [UNKNOWN] * 3 and [x[2] for x in found[:3]] == [0.0] * 3
    assert found[3][1] in net.labels
    assert {x[1] for x in found[4:]} == {"fr"} and len({x[2] for x in found[5:]}) == 1


def test_nothing_to_learn(spark):
    docs = documents(spark, [(1, "some text")]).withColumn("lang", F.lit(None).cast("string"))
    net = learn(docs)
    assert [(r.lang_pred, r.score) for r in identify(docs, net).collect()] == [(UNKNOWN, 0.0)]
    assert identify(documents(spark, []), net).collect() == []


def test_windows_cover_whole_texts():
    sizes = [0, 1, WINDOW - 1, WINDOW, WINDOW + 1, 3 * WINDOW + 7]
    data = np.concatenate([np.full(n, 65 + k, np.uint8) for k, n in enumerate(sizes)])
    windows, owner = cut(data, np.cumsum([0, *sizes]))
    assert np.bincount(owner, minlength=len(sizes)).tolist() == [0, 1, 1, 1, 2, 4]
    for k, n in enumerate(sizes):
        mine = windows[owner == k]
        assert ((mine == 97 + k) | (mine == NO_BYTE)).all()
        assert (mine != NO_BYTE).sum() >= n


def test_blocks_of_windows_do_not_matter():
    net = train(["the cat and the dog", "le chat et le chien"] * 20, ["en", "fr"] * 20)
    windows, _ = cut(np.frombuffer(b"the dog le chien" * 200, np.uint8), np.array([0, 3200]))
    assert np.allclose(probabilities(net, windows, 1), probabilities(net, windows, 64), atol=1e-5)
    assert np.allclose(probabilities(net, windows).sum(1), 1, atol=1e-5)


def test_the_sample_draws_on_all_languages(spark):
    rows = [(i, "le chat noir " * 3) for i in range(5)] + [(i, "the black cat " * 3) for i in range(5, 3000)]
    docs = documents(spark, rows).withColumn("lang", F.when(F.col("doc_id") < 5, "fr").otherwise("en"))
    net = learn(docs)
    assert net.labels == ("en", "fr")
    got = identify(docs.filter("doc_id < 10"), net).collect()
    assert all(r.lang_pred == r.lang for r in got)


def test_every_label_is_learned(spark, monkeypatch):
    docs = documents(spark, [(i, f"text {i} " * 3) for i in range(520)]).withColumn("lang", F.concat(F.lit("l"), "doc_id"))
    net = learn(docs)
    assert set(net.labels) == {f"l{i}" for i in range(520)}
    monkeypatch.setattr("tillstream.llm.language_id.SAMPLE", 100)
    more = documents(spark, [(i, f"text {i}") for i in range(1500)]).withColumn("lang", (F.col("doc_id") % 30).cast("string"))
    assert len(learn(more).labels) == 30


def test_slices_of_many_labels_do_not_matter(spark, monkeypatch, learned):
    docs, net = learned
    docs = docs.select("doc_id", "text").filter("doc_id < 40")
    whole = sorted(tuple(r) for r in identify(docs, net).collect())
    monkeypatch.setattr("tillstream.llm.language_id.PROBABILITIES", 12)
    found = sorted(tuple(r) for r in identify(docs, net).collect())
    assert [r[:3] for r in found] == [r[:3] for r in whole]
    assert np.allclose([r[3] for r in found], [r[3] for r in whole], atol=1e-5)


def test_the_sample_is_bounded_and_ids_do_not_matter(spark, monkeypatch):
    taken = []
    monkeypatch.setattr("tillstream.llm.language_id.train", lambda texts, langs: taken.append(sorted(langs)))
    monkeypatch.setattr("tillstream.llm.language_id.SAMPLE", 40)
    lang = (F.col("n") % 4).cast("string")
    rows = spark.range(4000).select(F.col("id").alias("n"), F.lit(None).cast("long").alias("doc_id"))
    rows = rows.select("doc_id", lang.alias("lang"), F.format_string("text %05d", "n").alias("text"))
    learn(rows)  # null ids and one length
    learn(rows.withColumn("doc_id", F.lit(7)).withColumn("text", F.lit("same")))  # copies of one row
    assert taken == [sorted("0123" * 10)] * 2
    many = spark.range(300).select("id", F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    learn(many.withColumn("lang", F.when(F.col("id") < 20, "often").otherwise(F.col("id").cast("string"))))
    assert len(taken[2]) == 40 and "often" in taken[2]


def test_a_forward_pass_equals_loops():
    """Embedding, filters of three widths, maximum, ReLU and softmax, one number at a time."""
    net = train(["abcd efgh", "ijkl mnop", "qrst uvwx"] * 4, ["a", "b", "c"] * 4)
    windows, _ = cut(np.frombuffer(b"abc mnop" + b"qrst", np.uint8), np.array([0, 8, 12]), 8)
    for window, got in zip(windows, probabilities(net, windows), strict=True):
        padded = [*window.tolist(), *[NO_BYTE] * 3]
        hidden = []
        for f in range(net.filters.shape[1]):
            best = -np.inf
            for at in range(len(window)):
                total = 0.0
                for k in range(4):
                    for e in range(net.embedding.shape[1]):
                        total += float(net.embedding[padded[at + k], e]) * float(net.filters[k * net.embedding.shape[1] + e, f])
                best = max(best, total)
            hidden.append(max(best + float(net.bias[f]), 0.0))
        out = [sum(h * float(net.output[i, c]) for i, h in enumerate(hidden)) + float(net.output_bias[c]) for c in range(3)]
        whole = sum(np.exp(o - max(out)) for o in out)
        assert np.allclose(got, [np.exp(o - max(out)) / whole for o in out], atol=1e-4)
