"""Which directories of a table of loads are live: merging, late loads, loads that run again."""

from __future__ import annotations

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.rows import raw, write_lines
from tillstream.plans import load as load_module
from tillstream.plans.compact import compact_days
from tillstream.plans.load import load_batch, run_load
from tillstream.schemas import PROCESSED
from tillstream.sinks.zones import write_processed
from tillstream.sources import live
from tillstream.sources.files import found_paths
from tillstream.sources.ledger import MERGE, enter, next_load, read_ledger
from tillstream.sources.live import Manifest, end_loads, manifests, publish, read_loads
from tillstream.sources.marks import MOST_MARKS, read_mark, write_mark
from tillstream.sources.zones import read_processed, read_raw

DAY1, DAY2 = date(2026, 1, 2), date(2026, 1, 3)
T2 = "2026-01-03T03:04:05"


@pytest.fixture
def put(spark, path):
    """``put("x", "a", "b!")`` writes load x with events a (day 1) and b (day 2)."""

    def run(load_id, *names):
        rows = [raw(transaction_id=n.rstrip("!"), **({"transaction_timestamp": T2} if n.endswith("!") else {})) for n in names]
        folder = path(f"raw-{load_id}-{len(glob.glob(path('raw-*')))}")
        write_lines(folder, "1.json", rows)
        return load_batch(read_raw(spark, folder), path("p"), load_id)

    return run


def ids(spark, path, days=None):
    rows = read_processed(spark, path("p"), days)
    return sorted(f"{r.transaction_id}:{r.load_id}" for r in rows.collect())


def directories(path, day):
    return sorted(os.path.basename(d).removeprefix("load_id=")[:2] for d in glob.glob(f"{path('p')}/transaction_date={day}/load_id=*"))


def test_merged_loads_read_as_before(spark, path, put):
    for load in "012":
        put(load, f"a{load}", f"b{load}!")
    before = ids(spark, path)
    compact_days(spark, path("p"), [DAY1])
    assert directories(path, DAY1) == ["c-"] and directories(path, DAY2) == ["0", "1", "2"]
    assert ids(spark, path) == before and ids(spark, path, [DAY1]) == ["a0:0", "a1:1", "a2:2"]
    # Again, with one more load; a day that is one directory is left alone.
    put("late", "l")
    compact_days(spark, path("p"), [DAY1, DAY2])
    assert directories(path, DAY1) == directories(path, DAY2) == ["c-"]
    (file,) = glob.glob(f"{path('p')}/transaction_date=2026-01-02/*/*.parquet")
    compact_days(spark, path("p"), [DAY1, DAY2, date(2020, 1, 1)])
    assert os.path.exists(file)
    assert ids(spark, path) == sorted([*before, "l:late"])


def test_a_load_that_comes_after_a_run_died_is_not_lost(spark, path, put, monkeypatch):
    """A run that staged one day and died; a late load into it; another day merged."""
    for load in "01":
        put(load, f"a{load}", f"b{load}!")

    def die(*_):
        raise RuntimeError("lost driver")

    for step in ("move", "publish"):
        monkeypatch.setattr(live, step, die)
        with pytest.raises(RuntimeError):
            compact_days(spark, path("p"), [DAY1])
        monkeypatch.undo()
        assert ids(spark, path, [DAY1]) == ["a0:0", "a1:1", *[f"late{s}:{s}" for s in (["move"] if step == "publish" else [])]]
        put(step, f"late{step}")
    compact_days(spark, path("p"), [DAY2])
    assert ids(spark, path) == ["a0:0", "a1:1", "b0:0", "b1:1", "latemove:move", "latepublish:publish"]
    assert not os.path.exists(f"{path('p')}/_merging") and "c-" not in directories(path, DAY1)


def test_a_load_that_was_merged_and_runs_again_is_there_once(spark, path, monkeypatch):
    """A load that dies before its ledger entry, is merged, and is loaded again."""
    write_lines(path("raw"), "1.json", [raw(transaction_id="a")])
    with monkeypatch.context() as m:
        m.setattr(load_module, "enter", lambda *_: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            run_load(spark, path("raw"), path("p"), path("mark"))
    write_processed(read_processed(spark, path("p")).withColumn("transaction_id", F.lit("other")), path("p"), "x")
    compact_days(spark, path("p"), [DAY1])
    assert directories(path, DAY1) == ["c-"]
    run_load(spark, path("raw"), path("p"), path("mark"))
    assert ids(spark, path) == ["a:m0", "other:x"]
    # Also when it is merged once more.
    compact_days(spark, path("p"), [DAY1])
    assert directories(path, DAY1) == ["c-"] and ids(spark, path) == ["a:m0", "other:x"]


def test_a_load_that_runs_again_leaves_merged_days_that_it_has_no_rows_for(spark, path, put):
    put("0", "a", "b!")
    put("1", "c", "d!")
    compact_days(spark, path("p"), [DAY1, DAY2])
    put("1", "e!")
    assert ids(spark, path) == ["a:0", "b:0", "e:1"]
    assert ids(spark, path, [DAY1]) == ["a:0"]


def test_dead_directories_may_stay_for_readers(spark, path, put):
    put("0", "a")
    put("1", "b")
    merged = read_processed(spark, path("p"))
    before = merged.inputFiles()
    args = spark, path("p"), PROCESSED, "transaction_date", [DAY1.isoformat()]
    assert live.merge_loads(*args, keep_merged=True) == ["transaction_date=2026-01-02"]
    assert len(directories(path, DAY1)) == 3 and all(os.path.exists(f.removeprefix("file://")) for f in before)
    assert ids(spark, path) == ["a:0", "b:1"]
    # Dead directories are not opened.
    plan = read_processed(spark, path("p"))._jdf.queryExecution().executedPlan().toString()
    assert "load_id" in plan.split("PartitionFilters:")[1].split("DataFilters")[0].split("PushedFilters")[0]
    assert live.merge_loads(*args) == [] and len(directories(path, DAY1)) == 1
    assert ids(spark, path) == ["a:0", "b:1"]


def test_a_value_whose_loads_ran_again_meanwhile_is_left(spark, path, put, monkeypatch):
    put("0", "a")
    put("1", "b")
    sources = live._sources

    def meanwhile(*args):
        out = sources(*args)
        monkeypatch.setattr(live, "_sources", sources)
        put("1", "b again")
        return out

    monkeypatch.setattr(live, "_sources", meanwhile)
    # The run reads directories it has listed; the load replaced one of them.
    try:
        compact_days(spark, path("p"), [DAY1])
    except Exception as lost:
        assert "FILE_NOT_EXIST" in str(lost) or "does not exist" in str(lost)
    assert ids(spark, path) == ["a:0", "b again:1"]


def test_manifests(spark, path):
    assert manifests(spark, path("t")) == {} == manifests(spark, path("t"), [])
    m = Manifest("day=1", folder="c-1", loads=("a", "b"))
    for _ in range(4):
        m = m.next(swept=False)
        publish(spark, path("t"), m)
    with pytest.raises(FileExistsError):
        publish(spark, path("t"), m)
    other = Manifest("day=2").next(folder="c-2", replaced=("x",))
    publish(spark, path("t"), other)
    assert manifests(spark, path("t")) == {"day=1": m, "day=2": other}
    assert manifests(spark, path("t"), ["day=2", "day=3"]) == {"day=2": other}
    assert len(found_paths(spark, f"{path('t')}/_live/day=1/*.json")) == 2


def test_only_loads_that_may_have_run_look_for_their_rows(spark, path, put, monkeypatch):
    looked = []
    monkeypatch.setattr("tillstream.plans.load.take_out", lambda s, p, c, load: looked.append(load))
    put("0", "a")
    assert not looked
    put("0", "a")
    assert looked == ["0"]
    end_loads(spark, path("p"), ["0", "never"])
    assert live.open_loads(spark, path("p"), "") == []
    with pytest.raises(ValueError):
        put("c-0", "a")


def test_a_table_without_anything(spark, path):
    assert read_loads(spark, path("none"), PROCESSED, "transaction_date") is None
    assert read_loads(spark, path("none"), PROCESSED, "transaction_date", []) is None
    compact_days(spark, path("none"), [DAY1])
    compact_days(spark, path("none"), [])


def test_the_ledger_stays_small(spark, path, monkeypatch):
    monkeypatch.setattr("tillstream.sources.ledger.MERGE", 3)
    now = "2026-01-02 03:04:05"
    for k in range(11):
        assert next_load(spark, path("ledger")) == k
        files = spark.createDataFrame([(f"f{k}", now)], "path string, modified string")
        enter(files.withColumn("modified", F.to_timestamp("modified")), path("ledger"), k)
    names = sorted(os.path.basename(d) for d in glob.glob(path("ledger") + "/loads=*"))
    assert names == ["loads=0-8", "loads=10-10", "loads=9-9"]
    rows = read_ledger(spark, path("ledger")).collect()
    assert sorted((r.path, r.load) for r in rows) == sorted((f"f{k}", k) for k in range(11))
    assert MERGE == 100


def test_an_entry_that_is_not_whole_does_not_count(spark, path):
    os.makedirs(path("ledger") + "/loads=0-0")
    assert next_load(spark, path("ledger")) == 0 and read_ledger(spark, path("ledger")).count() == 0


def test_old_marks_are_deleted(spark, path):
    from datetime import datetime, timezone

    at = [datetime(2026, 1, 1, 0, 0, s, tzinfo=timezone.utc) for s in range(MOST_MARKS + 2)]
    for t in at[1:]:
        write_mark(spark, path("mark"), t)
    write_mark(spark, path("mark"), at[0])  # an older one deletes nothing
    assert read_mark(spark, path("mark")) == at[-1]
    assert len(glob.glob(path("mark") + "/*.json")) <= 2
