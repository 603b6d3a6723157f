from __future__ import annotations

import base64
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents
from tillstream.llm import pieces
from tillstream.llm.common import table
from tillstream.llm.pieces import Vocabulary, decode, encode, encode_units, load_vocabulary

BYTES = tuple(range(1, 257))


def small_vocabulary(**scores) -> Vocabulary:
    names = ["", *[""] * 256, *scores]
    return Vocabulary(tuple(names), (0.0, *[0.0] * 256, *map(float, scores.values())), BYTES)


def score_of(ids, vocabulary, unit):
    """The path's score; a spelled character counts once."""
    total, k, at = 0.0, 0, 0
    while k < len(ids):
        if ids[k] in vocabulary.byte_ids:
            total, k, at = total + vocabulary.unknown_score, k + len(unit[at].encode()), at + 1
        else:
            total, at, k = total + vocabulary.scores[ids[k]], at + len(vocabulary.pieces[ids[k]]), k + 1
    return total


def best_score(unit, vocabulary):
    best = [0.0] + [float("-inf")] * len(unit)
    of = {p: s for p, s in zip(vocabulary.pieces, vocabulary.scores, strict=True) if p}
    for end in range(1, len(unit) + 1):
        for start in range(max(0, end - 16), end):
            s = of.get(unit[start:end], vocabulary.unknown_score if end - start == 1 else None)
            if s is not None:
                best[end] = max(best[end], best[start] + s)
    return best[-1]


def encoded(spark, units, vocabulary):
    frame = spark.createDataFrame([(u,) for u in units], "unit string")
    return {r.unit: r.ids for r in encode_units(frame, vocabulary).collect()}


def test_best_paths_of_a_small_lattice(spark):
    vocabulary = small_vocabulary(a=-3, b=-3, ab=-4, ba=-2, aab=-9, é=-1)
    units = ["".join(x) for n in range(1, 6) for x in itertools.product("abé", repeat=n)]
    units += ["x", "axb", "日本", "a" * 200]
    got = encoded(spark, units, vocabulary)
    assert set(got) == set(units)
    for unit, ids in got.items():
        text = b"".join(bytes.fromhex(vocabulary.hex_by_id()[i]) for i in ids).decode()
        assert text == unit
        assert score_of(ids, vocabulary, unit) == best_score(unit, vocabulary)


def test_ties_are_settled(spark):
    vocabulary = small_vocabulary(a=-1, b=-1, c=-1, ab=-2, bc=-2)
    first = encoded(spark, ["abc", "ab"], vocabulary)
    assert first == encoded(spark, ["ab", "abc"], vocabulary)


def test_scores_equal_the_library_in_unigram_mode(spark, sf_dir):
    """The same pieces and scores, loaded as a unigram model."""
    sentencepiece = pytest.importorskip("sentencepiece")
    model_pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    vocabulary = load_vocabulary()
    texts = [r.text for r in table(spark, sf_dir, "documents").select("text").limit(40).collect()]
    units = sorted({" " + w for t in texts for w in t.split()})
    for unit, ids in encoded(spark, units, vocabulary).items():
        theirs = library.nbest_encode_as_ids(unit[1:], 2)[0]  # searches the whole lattice
        assert score_of(ids, vocabulary, unit) == score_of(theirs, vocabulary, unit), unit


def best_path(text, vocabulary):
    """The ids of the best path of a text that is not cut at all."""
    of = {p: (i, s) for i, (p, s) in enumerate(zip(vocabulary.pieces, vocabulary.scores, strict=True)) if p}
    longest = max(map(len, of))
    best = [(0.0, 0, [])]
    for end in range(1, len(text) + 1):
        paths = []
        for start in range(max(0, end - longest), end):
            id_, score = of.get(text[start:end], (None, vocabulary.unknown_score if end - start == 1 else None))
            if score is not None:
                spelled = [vocabulary.byte_ids[b] for b in text[start:end].encode()]
                paths.append((best[start][0] + score, -start, spelled if id_ is None else [id_]))
        best.append(max(paths, key=lambda p: p[:2]))
    ids, end = [], len(text)
    while end:
        ids, end = best[end][2] + ids, -best[end][1]
    return ids


@pytest.mark.parametrize("sample", [1, 20_000])
def test_long_units_equal_an_uncut_lattice(spark, monkeypatch, sample):
    monkeypatch.setattr(pieces, "SAMPLE_ROWS", sample)
    draw = random.Random(5)
    vocabulary = load_vocabulary()
    letters = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшыэюя", "的一是不了人我在有他這中大來上國", "aé🙂ж日ÿ"]
    texts = ["".join(draw.choices(a, k=600)) for a in letters for _ in range(8)]
    texts += [base64.b64encode(draw.randbytes(900)).decode(), "x" * 5000, " " * 700 + "end", "🙂" * 300, "the" * 400]
    texts += [f"short {texts[0]} and\n{texts[9]}.", "a" * 255, "a" * 256, "é" * 128, "information" * 24]
    got = encode(documents(spark, list(enumerate(texts))), vocabulary).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == best_path(" " + texts[r.doc_id], vocabulary), texts[r.doc_id][:40]


def test_long_pieces_and_ties():
    """Parts are at most so long unless one piece is longer, and cut only between best pieces."""
    vocabulary = small_vocabulary(**{"a": -1, "b": -1, "aa": -2, "ab": -1, "b" * 300: -1})
    for unit in ("a" * 1000, "ab" * 500, "a" * 400 + "b" * 300 + "a" * 400, "b" * 299 + "é" * 300):
        cuts = pieces.long_cuts(unit, *vocabulary.lattice())
        parts = [unit.encode()[a:b].decode() for a, b in zip([0, *cuts], [*cuts, None], strict=True)]
        assert sum((best_path(p, vocabulary) for p in parts), []) == best_path(unit, vocabulary)
        assert all(len(p.encode()) <= pieces.LONGEST or p == "b" * 300 for p in parts)


@pytest.mark.parametrize("sample,named", [(1, 20_000), (20_000, 20_000), (1, 1)])
def test_round_trip(spark, sf_dir, monkeypatch, sample, named):
    """Exact, whether units are sent to all tasks or looked up, in many blocks; ``named`` is 1
    where tasks have several blocks."""
    monkeypatch.setattr(pieces, "SAMPLE_ROWS", sample)
    monkeypatch.setattr(pieces, "ROWS_PER_BLOCK", 20)
    monkeypatch.setattr(pieces, "RUN", 7)
    monkeypatch.setattr(pieces, "MOST_NAMED", named)
    monkeypatch.setattr(pieces, "PACKED_ROWS", 500)
    vocabulary = load_vocabulary()
    odd = [
        (1, None), (2, ""), (3, " "), (4, "\n"), (5, "  two  spaces \n\n and lines\n"), (6, "▁ literal mark ▁"),
        (7, "日本語 🙂 é"), (8, "\x00\t\r<0x41><s>"), (9, "x" * 5000 + " " + "é🙂" * 900), (10, " " * 700 + "end"),
        (11, "same"), (12, "same"), (None, "no id"), (None, None), (13, "one"), (13, "two"),
    ]
    rows = odd + [(100 + r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    coded = encode(documents(spark, rows, "ids own h id unit"), vocabulary)
    got = coded.select("doc_id", "ids", decode(F.col("ids"), vocabulary).alias("text")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got), key=key) == sorted(((d, t or "") for d, t in rows), key=key)
    by_id = {r.doc_id: r.ids for r in got}
    assert by_id[11] == by_id[12] and by_id[1] == by_id[2] == []


def test_empty_table(spark):
    assert encode(documents(spark, []), load_vocabulary()).collect() == []
