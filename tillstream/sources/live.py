"""Tables of loads, and which of their directories are live.

Such a table has a directory for each value of one column and in it one for each load,
``<path>/<column>=<value>/load_id=<load>``. A load is live once it is written. Merging copies
the rows of several loads into one directory ``load_id=c-<run>``, in which a row keeps the
load it came from as ``_origin``. The value's manifest says which merged directory is live
and which loads are in it; their own directories are dead from then on, and so is a merged
directory that no manifest names. Loads that come later, late ones too, are not in the
manifest and hence live.

A manifest is a small file, numbered; the highest number counts. It appears by one rename, so
a reader sees the loads as before a merge or as after it, never both and never neither.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import drop_path, exists, found_paths, move, write_text

MERGED = "c-"
ORIGIN = "_origin"
MANIFESTS = "_live"
WRITING = "_writing"

_SCHEMA = "value string, version bigint, folder string, loads array<string>, replaced array<string>, swept boolean"


@dataclass(frozen=True)
class Manifest:
    """What is merged of one value, named like its directory (``transaction_date=2026-01-02``).

    ``loads`` are in ``folder`` and live there. ``replaced`` are in it too, but were taken out
    as they ran again. ``swept`` says that the dead directories are gone.
    """

    value: str
    version: int = 0
    folder: str | None = None
    loads: tuple[str, ...] = ()
    replaced: tuple[str, ...] = ()
    swept: bool = True

    def next(self, **changes) -> Manifest:
        return replace(self, version=self.version + 1, **changes)


def _among(names: Iterable[str]) -> str:
    return "{" + ",".join(sorted(names)) + "}"


def manifests(spark: SparkSession, path: str, values: Sequence[str] | None = None) -> dict[str, Manifest]:
    """The manifests of some or all values, by value; as many as values that were merged."""
    if values is not None and not values:
        return {}
    root = f"{path}/{MANIFESTS}"
    which = "*" if values is None else _among(values)
    latest: dict[str, str] = {}
    if exists(spark, root):
        for file in sorted(found_paths(spark, f"{root}/{which}/*.json")):
            latest[file.rsplit("/", 2)[1]] = file
    if not latest:
        return {}
    rows = spark.read.schema(_SCHEMA).json(list(latest.values())).collect()
    return {r.value: Manifest(r.value, r.version, r.folder, tuple(r.loads), tuple(r.replaced), r.swept) for r in rows}


def publish(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make ``manifest`` the one that counts. Of two that are published with one number the
    second raises; older ones than the last two are deleted."""
    folder = f"{path}/{MANIFESTS}/{manifest.value}"
    part = f"{folder}/.{uuid.uuid4().hex}"
    write_text(spark, part, json.dumps(asdict(manifest)))
    move(spark, part, f"{folder}/{manifest.version:010d}.json")
    for old in sorted(found_paths(spark, f"{folder}/*.json"))[:-2]:
        drop_path(spark, old)


def _directory(column: str, *more: str) -> Column:
    parts: list = [F.lit(f"{column}="), F.col(column).cast("string")]
    for name in more:
        parts += [F.lit("/"), F.col(name)]
    return F.concat(*parts)


def _live_directories(column: str, found: dict[str, Manifest]) -> Column:
    """A condition on the partition columns alone, so dead directories are not opened."""
    place = _directory(column, "load_id")
    merged = F.col("load_id").startswith(MERGED)
    folders = [f"{m.value}/{m.folder}" for m in found.values() if m.folder]
    live = ~merged | place.isin(folders) if folders else ~merged
    dead = [f"{m.value}/{load}" for m in found.values() if not m.swept for load in m.loads]
    return live & ~place.isin(dead) if dead else live


def read_loads(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    column: str,
    values: Sequence[str] | None = None,
    origin: bool = False,
) -> DataFrame | None:
    """The live rows of a table of loads; None where there is nothing.

    With ``values``, only their directories are listed. ``load_id`` is the load that wrote a
    row, also where it was merged; with ``origin`` it is that of the directory, and ``_origin``
    stays.
    """
    below = "" if values is None else f"/{column}={_among(values)}"
    if values is not None and not values or not exists(spark, path + below):
        return None
    found = manifests(spark, path, None if values is None else [f"{column}={v}" for v in values])
    full = T.StructType([*schema.fields, T.StructField(ORIGIN, T.StringType())])
    rows = spark.read.schema(full).option("basePath", path).parquet(path + below)
    rows = rows.filter(_live_directories(column, found))
    gone = [f"{m.value}/{m.folder}/{load}" for m in found.values() for load in m.replaced]
    if gone:
        rows = rows.filter(~F.coalesce(_directory(column, "load_id", ORIGIN).isin(gone), F.lit(False)))
    if origin:
        return rows
    return rows.withColumn("load_id", F.coalesce(ORIGIN, "load_id")).select(*schema.fieldNames())


# --- writing ---


def begin_load(spark: SparkSession, path: str, load_id: str) -> bool:
    """Mark ``load_id`` as being written; False if it was so already, and so may have left rows.

    One small file beside the table tells, so a load that is new, as nearly all are, need not
    look for rows of its own in every directory.
    """
    if load_id.startswith(MERGED):
        raise ValueError(f"load ids can't begin with {MERGED}: {load_id}")
    marker = f"{path}/{WRITING}/{load_id}"
    if exists(spark, marker):
        return False
    write_text(spark, marker, "")
    return True


def end_loads(spark: SparkSession, path: str, load_ids: Iterable[str]) -> None:
    """These loads are entered or committed and will not run again."""
    for load_id in load_ids:
        drop_path(spark, f"{path}/{WRITING}/{load_id}")


def open_loads(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Loads that began and didn't end, with ids that begin with ``prefix``."""
    return [p.rsplit("/", 1)[1] for p in found_paths(spark, f"{path}/{WRITING}/{prefix}*")]


def take_out(spark: SparkSession, path: str, column: str, load_id: str) -> None:
    """Remove a load that runs again: from the merged directories it is in, then its own."""
    for m in manifests(spark, path).values():
        if load_id in m.loads:
            left = tuple(x for x in m.loads if x != load_id)
            publish(spark, path, m.next(loads=left, replaced=(*m.replaced, load_id)))
    drop_path(spark, f"{path}/{column}=*/load_id={load_id}")


# --- merging ---


def _sources(
    spark: SparkSession, path: str, column: str, values: Sequence[str], found: dict[str, Manifest]
) -> dict[str, dict[str, tuple[str, ...]]]:
    """Of each value: its live directories and their files."""
    out: dict[str, dict[str, tuple[str, ...]]] = {}
    for file in sorted(found_paths(spark, f"{path}/{column}={_among(values)}/load_id=*/*.parquet")):
        _, value, load, name = file.rsplit("/", 3)
        load, m = load.removeprefix("load_id="), found.get(value)
        if load.startswith(MERGED):
            live = m is not None and m.folder == load
        else:
            live = m is None or load not in m.loads
        if live:
            own = out.setdefault(value, {})
            own[load] = (*own.get(load, ()), name)
    return out


def merge_loads(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    column: str,
    values: Sequence[str],
    keep_merged: bool = False,
) -> list[str]:
    """Merge all loads of each of ``values`` into one directory; returns the values merged.

    The merged rows are written beside the table and moved into it, where nobody reads them
    until the manifest names them. A run that dies before leaves the loads as they are. Loads
    that are written meanwhile are not touched; a value whose merged loads ran again meanwhile
    is left for the next time. Loads that may still run again can be merged too, as a row
    keeps its load. With ``keep_merged`` the dead directories stay until the next run, for
    readers that have listed them. One run at a time.
    """
    sweep(spark, path, column)
    if not values:
        return []
    names = [f"{column}={v}" for v in values]
    before = manifests(spark, path, names)
    sources = {
        v: loads
        for v, loads in _sources(spark, path, column, values, before).items()
        if len(loads) > 1 or v in before and before[v].replaced
    }
    if not sources:
        return []
    folder, staged = f"{MERGED}{uuid.uuid4().hex[:12]}", f"{path}/_merging"
    rows = read_loads(spark, path, schema, column, values, origin=True)
    taken = [f"{v}/{load}" for v, loads in sources.items() for load in loads]
    (
        rows.filter(_directory(column, "load_id").isin(taken))
        .withColumn(ORIGIN, F.coalesce(ORIGIN, "load_id"))
        .withColumn("load_id", F.lit(folder))
        .hint("rebalance", column)
        .write.option("compression", "snappy")
        .partitionBy(column, "load_id")
        .parquet(staged)
    )
    after = manifests(spark, path, names)
    again = _sources(spark, path, column, values, after)
    merged = []
    for value, loads in sources.items():
        same = after.get(value) == before.get(value)
        same = same and all(again.get(value, {}).get(load) == files for load, files in loads.items())
        if same and exists(spark, f"{staged}/{value}/load_id={folder}"):
            move(spark, f"{staged}/{value}/load_id={folder}", f"{path}/{value}/load_id={folder}")
            old = before.get(value, Manifest(value))
            own = {load for load in loads if not load.startswith(MERGED)} | set(old.loads)
            publish(spark, path, old.next(folder=folder, loads=tuple(sorted(own)), replaced=(), swept=False))
            merged.append(value)
    drop_path(spark, staged)
    if not keep_merged:
        sweep(spark, path, column)
    return merged


def sweep(spark: SparkSession, path: str, column: str) -> None:
    """Delete what is dead: loads that were merged, merged directories that no manifest names,
    and what a run that died had staged."""
    drop_path(spark, f"{path}/_merging")
    if not exists(spark, f"{path}/{MANIFESTS}"):
        found = {}
    else:
        found = manifests(spark, path)
    for folder in found_paths(spark, f"{path}/{column}=*/load_id={MERGED}*"):
        _, value, load = folder.rsplit("/", 2)
        if value not in found or found[value].folder != load.removeprefix("load_id="):
            drop_path(spark, folder)
    for m in found.values():
        if not m.swept:
            dead = _among(m.loads)
            if m.loads:
                drop_path(spark, f"{path}/{m.value}/load_id={dead}")
            publish(spark, path, m.next(swept=True))
