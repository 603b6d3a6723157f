"""Repeats over the whole table, found by the buckets of the ids."""

from __future__ import annotations

import glob
import re

import pytest

from tests.rows import raw, write_lines
from tillstream.plans.load import load_batch
from tillstream.sources import seen
from tillstream.sources.live import merge_loads
from tillstream.sources.seen import BUCKETS, bucket_of, ids_path, keep_ids, loaded_before, read_ids
from tillstream.sources.zones import read_processed, read_raw
from tillstream.schemas import LOADED_IDS

T2 = "2026-03-03T03:04:05"


@pytest.fixture
def load(spark, path):
    def run(load_id, names, scope="table", at=None):
        more = {"transaction_timestamp": at} if at else {}
        write_lines(path(f"raw-{load_id}"), "1.json", [raw(i, transaction_id=n, **more) for i, n in enumerate(names)])
        return sum(load_batch(read_raw(spark, path(f"raw-{load_id}")), path("p"), load_id, unique_within=scope).values())

    return run


def rows(spark, path):
    return sorted((r.transaction_id, r.load_id) for r in read_processed(spark, path("p")).collect())


def opened(df):
    """The buckets whose files a read opens."""
    return {int(re.search(r"bucket=(\d+)", f).group(1)) for f in df.inputFiles()}


def test_a_load_opens_only_the_buckets_that_its_ids_are_in(spark, path, load):
    names = [f"t{i}" for i in range(300)]
    assert load("0", names) == 300
    assert len(opened(read_ids(spark, path("p"), list(range(BUCKETS))))) > 50
    new = spark.createDataFrame([("t7",), ("t8",), ("new",)], "transaction_id string")
    touched = {r.bucket for r in new.select(bucket_of()).collect()}
    found = loaded_before(new, path("p"), "1")
    assert opened(found) <= touched and len(opened(found)) <= 3
    assert sorted(r[0] for r in found.collect()) == ["t7", "t8"]
    # The few names reach the Parquet filter.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(transaction_id" in plan
    assert load("1", ["t7", "new", "t8", "new"], at=T2) == 1
    assert load("2", ["new", "t9"], at="2026-05-05T00:00:00") == 0


@pytest.mark.parametrize("few,broadcast", [(0, 10**6), (0, 0)])
def test_many_new_ids(spark, path, load, monkeypatch, few, broadcast):
    monkeypatch.setattr(seen, "FEW_IDS", few)
    monkeypatch.setattr(seen, "BROADCAST_IDS", broadcast)
    load("0", list("abcdef"))
    assert load("1", list("efgh"), at=T2) == 2
    assert rows(spark, path) == [*[(c, "0") for c in "abcdef"], ("g", "1"), ("h", "1")]


def test_loads_of_all_scopes_count(spark, path, load):
    load("0", ["a"], "load")
    load("1", ["a", "b"], "day")
    assert not glob.glob(ids_path(path("p")))
    load("2", ["a", "b", "c"], at=T2)
    load("3", ["d"], "load")
    assert load("4", ["a", "b", "c", "d", "e"], at="2026-04-04T00:00:00") == 1
    assert rows(spark, path) == [("a", "0"), ("b", "1"), ("c", "2"), ("d", "3"), ("e", "4")]


def test_a_load_that_runs_again_keeps_its_rows_and_ids(spark, path, load):
    load("0", ["a", "b"])
    assert load("0", ["a", "c"]) == 2
    assert load("1", ["b", "c"], at=T2) == 1
    assert rows(spark, path) == [("a", "0"), ("b", "1"), ("c", "0")]


def test_buckets_can_be_merged(spark, path, load):
    for k in range(3):
        load(str(k), [f"{k}-{i}" for i in range(5)])
    buckets = [str(b) for b in range(BUCKETS)]
    merge_loads(spark, ids_path(path("p")), LOADED_IDS, "bucket", buckets)
    assert load("3", ["0-1", "1-1", "2-4", "x"], at=T2) == 1
    assert load("1", ["1-0"]) == 1  # again, after it was merged
    assert load("4", ["1-0", "1-1"], at=T2) == 1


def test_ids_are_written_anew_after_a_run_that_died(spark, path, load):
    load("0", ["a"], "load")
    spark.range(1).write.parquet(ids_path(path("p")) + "/bucket=0/load_id=broken")
    keep_ids(spark, path("p"))
    assert [r.transaction_id for r in read_ids(spark, path("p"), list(range(BUCKETS))).collect()] == ["a"]
