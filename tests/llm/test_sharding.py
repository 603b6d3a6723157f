from __future__ import annotations

import zlib
from collections import Counter

import pytest

from tests.llm.helpers import documents
from tillstream.llm.sharding import CELLS, places, shard_rows, walk


def check_law(rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for shard in range(shards):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))


@pytest.mark.parametrize("count,shards", [(0, 40), (1, 40), (39, 40), (40, 40), (1003, 40), (500, 7)])
def test_counts_are_at_most_one_apart(spark, count, shards):
    texts = {i: ("é" * (i % 5) + "x") for i in range(count)}
    rows = shard_rows(documents(spark, list(texts.items()), "shard slot size cell h"), shards).collect()
    assert sorted(r.doc_id for r in rows) == list(range(count))
    check_law(rows, shards)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


def test_odd_rows(spark):
    rows = [(None, None)] * 30 + [(None, "a")] * 30 + [(7, "same")] * 100 + [(8, ""), (9, None), (10, "y" * 100_000)]
    got = shard_rows(documents(spark, rows), 8).collect()
    key = lambda x: (x is None, x or 0)
    assert sorted((r.doc_id for r in got), key=key) == sorted((d for d, _ in rows), key=key)
    check_law(got, 8)
    assert {(r.size, r.text_crc32) for r in got if r.doc_id == 9} == {(16, 0)}


def test_assignment_does_not_depend_on_partitions_and_moves_little(spark):
    docs = documents(spark, [(i, str(i)) for i in range(4000)])
    one = {r.doc_id: (r.shard, r.slot) for r in shard_rows(docs.repartition(7), 40).collect()}
    assert one == {r.doc_id: (r.shard, r.slot) for r in shard_rows(docs.coalesce(1), 40).collect()}
    grown = {r.doc_id: r.shard for r in shard_rows(docs, 41).collect()}
    # A 41st of the rows has to move; hashing by remainder would move 40 of 41.
    assert sum(one[i][0] != grown[i] for i in one) < 0.1 * len(one)


def test_full_shards_pass_rows_on_clockwise(spark):
    """Against a walk that places one row at a time."""
    nodes = places(spark, 5, 4)
    counts = {c: (c * 7919) % 11 for c in range(0, CELLS, 97)}
    rows = [c for c in sorted(counts) for _ in range(counts[c])]
    cuts = walk(dict(counts), nodes, 5)
    assert [c[0] for c in cuts] == [0, *[c[1] for c in cuts[:-1]]] and cuts[-1][1] == len(rows)
    total = len(rows)
    room = {s: total // 5 + (s < total % 5) for s in range(5)}
    ring = [cell for cell, _ in nodes]

    def arc(cell):
        return next((k for k, at in enumerate(ring) if cell <= at), 0)

    # Arcs in order, the one that wraps from its start; own rows first, then the overflow.
    order = sorted(range(total), key=lambda r: (arc(rows[r]), rows[r] <= ring[-1], r))
    shard, late = {}, []
    for r in order:
        own = nodes[arc(rows[r])][1]
        if room[own]:
            shard[r], room[own] = own, room[own] - 1
        else:
            late.append(r)
    for r in late:
        k = arc(rows[r])
        while not room[nodes[k % len(nodes)][1]]:
            k += 1
        own = nodes[k % len(nodes)][1]
        shard[r], room[own] = own, room[own] - 1
    assert {r: s for a, b, s in cuts for r in range(a, b)} == shard
