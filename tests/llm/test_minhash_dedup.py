from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tests.llm.helpers import documents, lowered, syllables
from tillstream.llm import minhash_dedup
from tillstream.llm.common import LOWER, table
from tillstream.llm.components import components, merged
from tillstream.llm.minhash_dedup import near_duplicates, packed, shingles


def sets_of(rows, words=5):
    out = {}
    for doc_id, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        grams = {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}
        out[doc_id] = grams or ({tuple(found)} if found else set())
    return out


def brute(rows, percent=75):
    sets = sets_of(rows)
    label = {d: d for d in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {(d, len(sets[d]), root(d), root(d) == d) for d in ids}


def result(df):
    return {tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()}


def test_equals_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(near_duplicates(docs)) == brute(rows)


def edited(words, changes, draw):
    words = list(words)
    for at in draw.sample(range(len(words)), changes):
        words[at] = f"new{draw.randrange(10**6)}"
    return words


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_groups_at_the_threshold(spark, monkeypatch, rounds):
    """Families whose members are near 0.75 of each other, chains and exact copies among them."""
    monkeypatch.setattr(minhash_dedup, "ROUNDS", rounds)
    draw = random.Random(5)
    rows = []
    for family in range(6):
        base = syllables(family, 120)
        for _ in range(18):
            rows.append(" ".join(edited(base, draw.randint(0, 4), draw)))
        chain = base
        for _ in range(8):
            chain = edited(chain, 3, draw)
            rows.append(" ".join(chain))
        rows += [" ".join(base)] * 5
    draw.shuffle(rows)
    rows = list(enumerate(rows))
    assert result(near_duplicates(documents(spark, rows))) == brute(rows)


@pytest.mark.parametrize("asked", [0, 200_000])
def test_hubs_are_confirmed_in_parts(spark, monkeypatch, asked):
    """One text in most pairs, at either end of them, and pairs that are no links."""
    monkeypatch.setattr(minhash_dedup, "PER_PART", 4)
    monkeypatch.setattr(minhash_dedup, "MOST_WANTED", asked)
    draw = random.Random(9)
    base = syllables(3, 80)
    rows = [(0, " ".join(base)), (99, " ".join(base))]
    rows += [(k, " ".join(edited(base, draw.randint(0, 3), draw))) for k in range(1, 40)]
    pairs = {(0, k) for k in range(1, 40)} | {(k, 99) for k in range(30)} | {(5, 6), (7, 9)}
    frame = spark.createDataFrame(sorted(pairs), "a long, b long")
    wanted = minhash_dedup._wanted(frame).collect()
    texts = [(r.hub, r.part) for r in wanted if r.id == r.hub]
    assert len(texts) == len(set(texts)) and len(wanted) - len(texts) == len(pairs)
    assert 10 <= sum(hub == 0 for hub, _ in texts) <= 11
    got = minhash_dedup.confirmed(frame, documents(spark, rows).select("doc_id", "text"), 5, 75).collect()
    sets = sets_of(rows)
    expected = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert expected < pairs
    assert sorted(map(tuple, got)) == sorted(expected)


def test_hot_shingles_keep_their_counts(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "HOT_HOLDERS", 5)
    rows = [(1, k, 0) for k in range(30)] + [(2, k, 0) for k in range(5)] + [(3, 1, 0), (4, 2, 0), (4, 3, 0)]
    grams = spark.createDataFrame(rows, "shingle long, doc_id long, component long")
    holders = grams.groupBy("shingle").count().withColumnRenamed("count", "holders")
    got = minhash_dedup._with_holders(grams, holders).select(*grams.columns, "holders").collect()
    n = {1: 30, 2: 5, 3: 1, 4: 2}
    assert sorted(map(tuple, got)) == sorted((*r, n[r[0]]) for r in rows)


def test_labels_grow_with_links(spark):
    draw = random.Random(11)
    links = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)]
    label = None
    for k in range(0, 60, 15):
        label = merged(label, spark.createDataFrame(links[k : k + 15], "a long, b long"))
    whole = components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, label.collect())) == sorted(map(tuple, whole.collect()))


def test_odd_rows(spark):
    long = " ".join(syllables(1, 30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one two three four five"),
        (7, "ONE two three four five"), (8, long), (9, long + " x"), (10, "É a b c d"), (11, "é a b c d"),
    ]
    got = near_duplicates(documents(spark, rows, "component_id kept n_shingles lang"))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(got) == brute(rows)


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (2, None), (None, "a b c d e f"), (None, None)]
    got = sorted(near_duplicates(documents(spark, rows)).collect(), key=str)
    assert [tuple(r) for r in got if r.doc_id is not None] == [(1, 2, 1, True), (2, 2, 1, False)]
    assert sorted(tuple(r) for r in got if r.doc_id is None) == [(None, 0, None, True), (None, 2, None, True)]


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).collect() == []


def test_estimate_follows_similarity(spark):
    from pyspark.sql import functions as F

    a, b = minhash_dedup._permutations(minhash_dedup.BANDS * minhash_dedup.ROWS)
    for same in (0, 500, 750, 1000):
        one = np.arange(1000, dtype=np.uint64)
        two = np.concatenate([one[:same], np.arange(5000, 6000 - same, dtype=np.uint64)])
        sigs = [packed(minhash_dedup.minima(minhash_dedup.mixed(x), a, b)).view(np.int64).tolist() for x in (one, two)]
        df = spark.createDataFrame([tuple(sigs)], "a array<long>, b array<long>")
        got = df.select(minhash_dedup.estimate(F.col("a"), F.col("b"))).first()[0]
        assert abs(got - same / (2000 - same)) < 0.17


def test_shingles_do_not_depend_on_neighbours():
    texts = ["a b c d e f", "", "x", "a  b\tc d e F"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0] + [len(r) for r in raw])
    together = shingles(data, offsets)
    alone = [shingles(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0] for r in raw]
    assert [x.tolist() for x in together] == [x.tolist() for x in alone]
    assert together[0].tolist() == together[3].tolist()
    assert LOWER[ord("Z")] == ord("z")


def test_components_of_paths_stars_and_rings(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)]  # a path
    edges += [(200, 200 + i) for i in range(1, 50)]  # a star
    edges += [(300 + i, 300 + (i + 1) % 40) for i in range(40)]  # a ring
    edges += [(400, 400), (500, 501), (501, 500)]
    ids = list(range(100, 600))
    draw.shuffle(ids)
    name = dict(zip(range(100, 600), ids, strict=True))
    named = [(name[a], name[b]) for a, b in edges]
    got = {r.v: r.component for r in components(spark.createDataFrame(named, "a long, b long")).collect()}
    groups = [range(100, 161), range(200, 250), range(300, 340), (500, 501)]
    assert got == {name[i]: min(name[k] for k in g) for g in groups for i in g}
