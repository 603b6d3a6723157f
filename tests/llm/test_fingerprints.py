from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, syllables
from tillstream.llm import fingerprints as fp
from tillstream.llm.fingerprints import as_text, chunk_spans, containment, edited, fingerprints, prints


def sequential(text: bytes) -> list[tuple[int, int]]:
    """Chunk lengths by one step per byte."""
    spans, start, h = [], 0, 0
    for i, b in enumerate(text):
        h = (h << 1) + int(fp._GEAR[b]) & 0xFFFF
        size = i - start + 1
        if size >= fp.MOST or size >= fp.LEAST and h < (fp._SELDOM if size < fp.NORMAL else fp._OFTEN):
            spans.append((start, i + 1))
            start = i + 1
    return spans + ([(start, len(text))] if start < len(text) else [])


def test_chunks_equal_a_sequential_scan():
    texts = [b"", b"a", "é".encode() * 50, bytes(range(256)) * 3, b"\x00" * 300, " ".join(syllables(1, 3000)).encode(), b"z" * 15]
    starts, ends, owner, joined = chunk_spans(texts)
    for k, text in enumerate(texts):
        mine = owner == k
        lengths = list(zip(starts[mine].tolist(), ends[mine].tolist(), strict=True))
        base = lengths[0][0] if lengths else 0
        assert [(a - base, b - base) for a, b in lengths] == sequential(text)
        assert b"".join(joined[a:b] for a, b in lengths) == text


def test_fingerprints_do_not_depend_on_neighbours_and_resist_shifts():
    text = " ".join(syllables(3, 2000)).encode()
    together = prints([b"x", text, b"", text])
    assert as_text(together[1]) == as_text(together[3]) == as_text(prints([text])[0])
    shifted = prints([b"some new words in front " + text])[0]
    assert containment(together[1], shifted) > 0.98
    assert containment(together[0], together[1]) == 0.0
    assert containment(together[2], together[2]) == 1.0


def brute(rows):
    """Rows of (id, text) → result rows, in the order of ids and texts."""
    named = sorted(((d, t or "") for d, t in rows if d is not None))
    following = [t for _, t in named[1:] + named[:1]]
    items = [(d, t, f) for (d, t), f in zip(named, following, strict=True)]
    items += [(None, t or "", "") for d, t in rows if d is None]
    out = []
    for d, t, f in items:
        e = edited(t, f)
        a, b, c = (prints([x.encode()])[0] for x in (t, e, f))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), as_text(a), as_text(b), containment(a, b), containment(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_per_part,most", [(5000, 1 << 20), (3, 50), (1, 1)])
def test_equals_brute_force(spark, monkeypatch, rows_per_part, most):
    monkeypatch.setattr(fp, "ROWS_PER_PART", rows_per_part)
    rows = [(i * 7 - 20, " ".join(syllables(i, 1 + i * 3))) for i in range(25)]
    rows += [(1000, None), (1001, ""), (1002, "é🙂é🙂é🙂é🙂"), (1003, "abc"), (2**60, " ".join(syllables(99, 9000)))]
    rows += [(None, "no id at all"), (None, None), (5, "five b"), (5, "five a"), (5, "five a"), (1004, rows[3][1])]
    got = fingerprints(documents(spark, rows, "part guest n_chars fingerprint"), most).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, "alone in the table")], [(None, "x")], [(1, None), (2, None)]])
def test_few_rows(spark, rows):
    got = fingerprints(documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_each_part_is_a_task_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_PART", 50)
    got = fingerprints(documents(spark, [(i, f"text {i} of many") for i in range(1500)]))
    rows = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(rows) == 30 and sum(rows) == 1500 and max(rows) <= 100


def test_edited():
    assert edited("abcdefgh", "XYZ") == "abcdefXY"
    assert edited("abcdefgh", "X") == "abcdefX"
    assert edited("abc", "X") == "abc" and edited("", "X") == ""
    assert np.all(np.diff(prints([b"some text here"])[0][0].astype(np.int64)) > 0)
