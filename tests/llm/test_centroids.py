from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tests.oracle import connect, spark_rows, sql_rows
from tillstream.llm.centroids import centroid_clusters, nearest, updated
from tillstream.llm.registry import LLM_ORACLES, LLM_QUERIES

SCHEMA = "vec_id long, embedding array<float>, label string, cluster string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "l", "c", "x") for i, v in rows], SCHEMA)


def brute(rows, dims, scale=1024, k=8, rounds=10, seed="3"):
    """One distance at a time, with Python's integers."""
    sound = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    def name(r):
        return (r[0] is None, "" if r[0] is None else hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])

    centroids = [x for _, x in sorted(sound, key=name)[:k]]

    def assigned():
        out = []
        for _, x in sound:
            distances = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centroids]
            out.append((distances.index(min(distances)), min(distances)))
        return out

    for _ in range(rounds):
        found = assigned()
        for c in range(len(centroids)):
            mine = [x for (_, x), (own, _) in zip(sound, found, strict=True) if own == c]
            if mine:
                centroids[c] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    found = assigned()
    total = sum(d for _, d in found)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        (str(i), c, d, sum(e for own, e in found if own == c), total, digests[c])
        for (i, _), (c, d) in zip(sound, found, strict=True)
    )


def result(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def points(seed, n, dims, spread=3.0):
    rng = np.random.default_rng(seed)
    homes = rng.normal(size=(5, dims)) * spread
    return [(i, [float(np.float32(x)) for x in homes[i % 5] + rng.normal(size=dims)]) for i in range(n)]


def test_query_equals_sql(spark, sf_dir):
    columns, rows = spark_rows(LLM_QUERIES["op12_centroid_clusters"](spark, sf_dir))
    sql_columns, expected = sql_rows(connect(sf_dir), LLM_ORACLES["op12_centroid_clusters"])
    assert columns == sql_columns and rows == expected and rows


@pytest.mark.parametrize("n,rounds", [(200, 10), (60, 0), (60, 1), (9, 10), (5, 10), (1, 3)])
def test_equals_brute_force(spark, n, rounds):
    rows = points(n, n, 6)
    got = centroid_clusters(frame(spark, rows), dims=6, rounds=rounds)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert result(got) == brute(rows, 6, rounds=rounds)


def test_odd_rows_repeats_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = points(1, 40, 4)
    rows += [(100, None), (101, []), (102, [1.0] * 3), (103, [1.0] * 5), (104, [1.0, None, 1.0, 1.0])]
    rows += [(105, [nan, 1.0, 1.0, 1.0]), (106, [1.0, inf, 1.0, 1.0]), (107, [1.0, -inf, 1.0, 1.0])]
    rows += [(None, [0.5, 0.5, 0.5, 0.5]), (None, [0.5, 0.5, 0.5, 0.5]), (3, [9.0, 9.0, 9.0, 9.0]), (3, [-9.0, 9.0, 9.0, 9.0])]
    # A third of all rows is one vector.
    rows += [(200 + i, [0.25, -0.75, 0.0, 1e-9]) for i in range(30)]
    assert result(centroid_clusters(frame(spark, rows), dims=4)) == brute(rows, 4)


def test_equal_vectors_leave_centroids_without_any(spark):
    rows = [(i, [1.0, -1.0]) for i in range(20)]
    got = result(centroid_clusters(frame(spark, rows), dims=2))
    assert got == brute(rows, 2)
    assert {r[1] for r in got} == {0} and {r[4] for r in got} == {0}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0])]])
def test_no_vector(spark, rows):
    assert centroid_clusters(frame(spark, rows)).collect() == []


def test_components_beyond_exact_distances_raise(spark):
    with pytest.raises(Exception, match="would not fit 64 bits"):
        centroid_clusters(frame(spark, [(1, [1e30, 0.0]), (2, [0.0, 0.0])]), dims=2).collect()


def test_dot_products_are_updated_by_what_changed():
    rng = np.random.default_rng(5)
    x, old = rng.integers(-900, 900, (50, 7)), rng.integers(-900, 900, (4, 7))
    new = old.copy()
    new[1, 3] += 17
    new[2] -= 5
    dots = updated(x @ old.T, x, new - old)
    assert np.array_equal(dots, x @ new.T)
    cluster, distance = nearest((x * x).sum(axis=1), dots, (new * new).sum(axis=1))
    plain = ((x[:, None] - new[None]) ** 2).sum(axis=2)
    assert np.array_equal(cluster, plain.argmin(axis=1)) and np.array_equal(distance, plain.min(axis=1))


def test_tables_of_earlier_rounds_are_dropped(spark):
    import glob

    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(glob.glob(folder + "/*"))
    centroid_clusters(frame(spark, points(2, 50, 3)), dims=3).collect()
    left = set(glob.glob(folder + "/*")) - before
    assert len(left) == 1 and "dot-products" in left.pop()
