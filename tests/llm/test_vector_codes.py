from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tests.oracle import connect, spark_rows, sql_rows
from tillstream.llm import vector_codes
from tillstream.llm.registry import LLM_ORACLES, LLM_QUERIES
from tillstream.llm.vector_codes import Gnat, compressed, squared

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "e", "x") for r in rows], SCHEMA)


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """One distance at a time, with Python's integers."""
    sound = [
        (i, label, [math.floor(scale * x) for x in v])
        for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted(sound, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    dims = len(first[0][2])
    sound, first = ([r for r in rs if len(r[2]) == dims] for rs in (sound, first))
    width = dims // parts

    def cut(x):
        return [x[p * width : (p + 1) * width] for p in range(parts)]

    books = [[cut(x)[p] for _, _, x in first[:entries]] for p in range(parts)]

    def nearest(p, part):
        distances = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in books[p]]
        return distances.index(min(distances)), min(distances)

    for _ in range(rounds):
        used = [[[] for _ in book] for book in books]
        for _, _, x in sound:
            for p, part in enumerate(cut(x)):
                used[p][nearest(p, part)[0]].append(part)
        books = [
            [[sum(c) // len(mine) for c in zip(*mine, strict=True)] if mine else entry for mine, entry in zip(u, book, strict=True)]
            for u, book in zip(used, books, strict=True)
        ]
    digest = hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()
    coded = []
    for i, label, x in sound:
        found = [nearest(p, part) for p, part in enumerate(cut(x))]
        coded.append((str(i), label, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found)))
    return sorted((i, code, error, sum(e for _, own, _, e in coded if own == label), digest) for i, label, code, error in coded)


def result(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def points(seed, n, dims=16):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in rng.normal(size=dims) * 0.3], int(rng.integers(4)) or None) for i in range(n)]


def test_query_equals_sql(spark, sf_dir):
    columns, rows = spark_rows(LLM_QUERIES["op13_vector_codes"](spark, sf_dir))
    sql_columns, expected = sql_rows(connect(sf_dir), LLM_ORACLES["op13_vector_codes"])
    assert columns == sql_columns and rows == expected and rows


@pytest.mark.parametrize("n,rounds", [(150, 6), (40, 0), (40, 1), (17, 6), (10, 6), (1, 6)])
def test_equals_brute_force(spark, n, rounds):
    rows = points(n, n)
    got = compressed(frame(spark, rows), rounds=rounds)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert result(got) == brute(rows, rounds=rounds)


def test_odd_rows_repeats_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = points(1, 50, 8)
    rows += [(100, None, 1), (101, [], 1), (102, [1.0] * 4, 2), (103, [1.0] * 9, 2), (104, [1.0] * 7 + [None], 1)]
    rows += [(105, [nan] + [1.0] * 7, 1), (106, [inf] + [1.0] * 7, 1), (None, [0.5] * 8, 3), (None, [0.5] * 8, None)]
    rows += [(0, [9.0] * 8, 3), (0, [-9.0] * 8, 3), (-5, [0.0] * 8, 1)]
    rows += [(200 + i, [0.25, -0.75] * 4, None) for i in range(40)]  # copies, with one label
    assert result(compressed(frame(spark, rows))) == brute(rows)


def test_many_labels_are_joined_by_shuffle(spark, monkeypatch):
    rows = points(3, 60)
    few = result(compressed(frame(spark, rows)))
    monkeypatch.setattr(vector_codes, "small", lambda *_: False)
    assert result(compressed(frame(spark, rows))) == few == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], 1)]])
def test_no_vector(spark, rows):
    assert compressed(frame(spark, rows)).collect() == []


def test_lengths_that_have_no_equal_parts_raise(spark):
    with pytest.raises(ValueError, match="equal parts"):
        compressed(frame(spark, points(1, 3, 9)))


@pytest.mark.parametrize("m,width,spread", [(1, 2, 9), (4, 2, 9), (16, 8, 900), (16, 2, 2), (100, 3, 5), (256, 4, 60)])
def test_tree_search_equals_a_scan_also_at_ties(m, width, spread):
    rng = np.random.default_rng(m)
    entries = rng.integers(-spread, spread + 1, (m, width))
    queries = np.concatenate([rng.integers(-spread, spread + 1, (500, width)), entries])
    code, distance = Gnat(entries).nearest(queries)
    plain = np.stack([squared(queries, e) for e in entries], axis=1)
    assert np.array_equal(code, plain.argmin(axis=1)) and np.array_equal(distance, plain.min(axis=1))


def test_subtrees_are_left_out():
    rng = np.random.default_rng(0)
    homes = rng.integers(-4000, 4000, (16, 8))
    entries = np.concatenate([homes + rng.integers(-50, 50, (16, 8)) for _ in range(8)])
    queries = homes[rng.integers(16, size=2000)] + rng.integers(-50, 50, (2000, 8))
    tree = Gnat(entries)
    tree.nearest(queries)
    assert tree.compared < 0.35 * len(entries) * len(queries)


def test_large_numbers_are_exact():
    base = 2**28
    entries = np.array([[base, base], [base + 1, base], [base, base + 1], [-base, -base], [base, base]] * 4)
    queries = np.array([[base, base], [base + 1, base + 1], [-base, base], [0, 0]])
    code, distance = Gnat(entries).nearest(queries)
    plain = np.stack([squared(queries, e) for e in entries], axis=1)
    assert np.array_equal(code, plain.argmin(axis=1)) and np.array_equal(distance, plain.min(axis=1))
