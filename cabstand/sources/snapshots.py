"""Month tables that change in one step: folders that are never rewritten, and a numbered list of those that count.

A write fills folders of its own (``version=<id>/part_month=<month>``) that no reader knows. What makes them part
of the table is a list, written last under the next number: the folders of every month, the columns, and marks that have to
change together with the rows (positions of a topic, say). A reader takes the list with the highest number once; the
files it names stay until :func:`vacuum`, so a read that began before a switch ends with the old rows and one
that begins after it has the new ones, never a mixture. A write that dies before its list leaves folders that
nobody reads. Two writers that work on the same list are told apart by the number: the second one finds it taken
and applies its change to the list of the first.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cabstand.functions import clock
from cabstand.sources import storage, tables
from cabstand.sources.tables import PART, Written

LISTS = "_lists"
VERSION = "version"
#: How often a writer that finds its number taken tries the next one.
ATTEMPTS = 20


class Conflict(Exception):
    """Other writers kept taking the number."""


@dataclass(frozen=True)
class Snapshot:
    """One state of a table: its folders by month, its columns as a JSON schema, and marks."""

    number: int = 0
    folders: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    schema: str = ""
    marks: Mapping[str, int] = field(default_factory=dict)

    def text(self) -> str:
        folders = {month: list(of) for month, of in sorted(self.folders.items())}
        return json.dumps({"folders": folders, "schema": self.schema, "marks": dict(self.marks)})

    @classmethod
    def parsed(cls, number: int, text: str) -> Snapshot:
        body = json.loads(text)
        return cls(number, {m: tuple(of) for m, of in body["folders"].items()}, body["schema"], body["marks"])

    def without(self, months: Sequence[str]) -> Snapshot:
        return replace(self, folders={m: of for m, of in self.folders.items() if m not in set(months)})

    def appended(self, months: Mapping[str, str]) -> Snapshot:
        return replace(self, folders={**self.folders, **{m: (*self.folders.get(m, ()), new) for m, new in months.items()}})


def _list_path(path: str, number: int) -> str:
    return f"{path}/{LISTS}/{number:012d}"


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the lists that are there, in order."""
    return sorted(int(name) for name in storage.names(spark, f"{path}/{LISTS}") if name.isdigit())


def present(spark: SparkSession, path: str, number: int | None = None) -> Snapshot:
    """The state with the highest number, or the named one; the empty state 0 where there is none."""
    if number is None:
        found = numbers(spark, path)
        number = found[-1] if found else 0
    return Snapshot.parsed(number, storage.read_text(spark, _list_path(path, number))) if number else Snapshot()


def is_versioned(spark: SparkSession, path: str) -> bool:
    return storage.exists(spark, f"{path}/{LISTS}")


def switch(spark: SparkSession, path: str, change: Callable[[Snapshot], Snapshot | None]) -> Snapshot:
    """Apply a change to the present state and publish the result. ``None`` from ``change`` leaves everything as it is."""
    for _ in range(ATTEMPTS):
        now = present(spark, path)
        wanted = change(now)
        if wanted is None:
            return now
        wanted = replace(wanted, number=now.number + 1)
        if storage.create_text(spark, _list_path(path, wanted.number), wanted.text()):
            return wanted
    raise Conflict(f"{path}: the number was taken {ATTEMPTS} times")


def _schema(df: DataFrame, parts: Sequence[str]) -> str:
    """The stored columns; those that are folder names come last, as text, in folder order."""
    plain = [field for field in df.schema.fields if field.name not in (*parts, VERSION)]
    plain = [T.StructField(f.name, f.dataType, True, f.metadata) for f in plain]
    return T.StructType(plain + [T.StructField(name, T.StringType()) for name in parts]).json()


def stage(
    df: DataFrame, path: str, date_column: str, cluster: Sequence[str] = (), label: str | None = None,
    extra_partitions: Sequence[str] = (), version: str | None = None, gathered: bool = False,
) -> tuple[Written, dict[str, str], str]:
    """Write rows into folders that no list names yet: (what was written, folder by month, schema). The same ``version`` is overwritten."""
    version = version or uuid.uuid4().hex
    written = tables.overwrite_months(df, f"{path}/{VERSION}={version}", date_column, cluster, label, extra_partitions, gathered)
    months = {folder.split("/")[0].split("=", 1)[1] for folder in written.partitions}
    parts = (PART, *extra_partitions)
    return written, {m: f"{VERSION}={version}/{PART}={m}" for m in months}, _schema(df, parts)


def replace_all(
    df: DataFrame, path: str, date_column: str, cluster: Sequence[str] = (), label: str | None = None,
    extra_partitions: Sequence[str] = (),
) -> Written:
    """The whole table anew, in one step."""
    written, months, schema = stage(df, path, date_column, cluster, label, extra_partitions)
    switch(df.sparkSession, path, lambda now: Snapshot(folders={m: (new,) for m, new in months.items()}, schema=schema, marks=now.marks))
    return written


def replace_months(
    df: DataFrame, path: str, date_column: str, cluster: Sequence[str] = (), label: str | None = None,
    extra_partitions: Sequence[str] = (), months: Sequence[str] = (),
) -> Written:
    """The months of ``df``, and the named ones even where ``df`` has no row of them, anew in one step; others stay."""
    written, staged, schema = stage(df, path, date_column, cluster, label, extra_partitions)
    switch(df.sparkSession, path, lambda now: replace(now.without([*months, *staged]).appended(staged), schema=schema))
    return written


def read(
    spark: SparkSession, path: str, date_column: str | None = None, start: clock.Moment | None = None, end: clock.Moment | None = None,
    snapshot: Snapshot | None = None,
) -> DataFrame:
    """The present state (or the given one), optionally for ``[start, end)``. Months outside the range aren't even listed."""
    state = snapshot or present(spark, path)
    if not state.number:
        raise FileNotFoundError(f"{path} has no state yet")
    low = f"{clock.as_datetime(start):%Y%m}" if start is not None else None
    high = f"{clock.as_datetime(end) - dt.timedelta(microseconds=1):%Y%m}" if end is not None else None
    folders = [
        f"{path}/{folder}"
        for month, of in sorted(state.folders.items())
        if (low is None or month >= low) and (high is None or month <= high)
        for folder in of
    ]
    schema = T.StructType.fromJson(json.loads(state.schema))
    if not folders:
        return spark.createDataFrame([], schema)
    listed = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    df = spark.read.option("basePath", path).schema(listed).parquet(*folders).select(*schema.names)
    if start is not None:
        df = df.where(F.col(date_column) >= clock.instant(clock.as_datetime(start), clock.field_type(df, date_column)))
    if end is not None:
        df = df.where(F.col(date_column) < clock.instant(clock.as_datetime(end), clock.field_type(df, date_column)))
    return df


def expire(spark: SparkSession, path: str, as_of: clock.Moment | None, days: int) -> list[str]:
    """Take expired months out of the table; their files go with the next :func:`vacuum`."""
    gone: list[str] = []

    def change(now: Snapshot) -> Snapshot | None:
        gone[:] = tables.expired_months(sorted(now.folders), as_of, days)
        return now.without(gone) if gone else None

    switch(spark, path, change)
    return gone


#: Bytes of stored files that one task of a merge copies.
BYTES_PER_TASK = 32 << 20
#: Groups of months that are copied at the same time.
COPIES_AT_ONCE = 8


def month_groups(sizes: Mapping[str, int], tasks: int) -> list[tuple[list[str], int]]:
    """Months put together for about so many tasks, a task's bytes at most: (months, tasks to read them in)."""
    per = min(BYTES_PER_TASK, max(1, sum(sizes.values()) // tasks))
    groups: list[tuple[list[str], int]] = []
    group, held = [], 0
    for month in sorted(sizes):
        group, held = [*group, month], held + sizes[month]
        if held >= per:
            groups.append((group, max(1, -(-held // BYTES_PER_TASK))))
            group, held = [], 0
    return [*groups, (group, 1)] if group else groups


def _copied(spark: SparkSession, path: str, state: Snapshot, date_column: str, cluster: Sequence[str], extra_partitions: Sequence[str]) -> dict[str, str]:
    """Copy the months of a state into a folder each: {month: folder}.

    The files of a month hold nothing else, so tasks that read whole months need no exchange: each group of months is
    a scan and a write of its own, of few tasks, and several groups run at the same time.
    """
    sizes = {m: sum(storage.size(spark, f"{path}/{folder}") for folder in of) for m, of in state.folders.items()}

    @inheritable_thread_target(spark)
    def copy(group: tuple[list[str], int]) -> dict[str, str]:
        months, tasks = group
        rows = read(spark, path, snapshot=replace(state, folders={m: state.folders[m] for m in months})).coalesce(tasks)
        return stage(rows.drop(PART), path, date_column, cluster, "merge", extra_partitions, gathered=True)[1]

    with ThreadPool(COPIES_AT_ONCE) as pool:
        found = pool.map(copy, month_groups(sizes, spark.sparkContext.defaultParallelism), chunksize=1)
    return {month: folder for copies in found for month, folder in copies.items()}


def merge(
    spark: SparkSession, path: str, date_column: str, cluster: Sequence[str] = (), extra_partitions: Sequence[str] = (),
    least: int = 2, months: Sequence[str] | None = None,
) -> dict[str, int]:
    """Bring months that lie in ``least`` folders or more into one folder each: {month: folders merged}.

    The rows are copied first; one switch then exchanges exactly the folders that were copied for the copy. Folders
    that a stream has added meanwhile stay in the list, so nothing is lost or repeated, and if the job dies before the
    switch nothing has changed. If someone else has replaced one of the folders, the copy is dropped.
    """
    state = present(spark, path)
    crowded = {m: of for m, of in state.folders.items() if len(of) >= least and (months is None or m in months)}
    if not crowded:
        return {}
    copies = _copied(spark, path, replace(state, folders=crowded), date_column, cluster, extra_partitions)
    merged: dict[str, int] = {}

    def change(now: Snapshot) -> Snapshot | None:
        merged.clear()
        folders = dict(now.folders)
        for month, old in crowded.items():
            if not set(old) <= set(now.folders.get(month, ())):
                continue
            rest = tuple(f for f in now.folders[month] if f not in old)
            folders[month] = (*([copies[month]] if month in copies else []), *rest)
            merged[month] = len(old)
        return replace(now, folders=folders) if merged else None

    switch(spark, path, change)
    return merged


def vacuum(spark: SparkSession, path: str, keep: int = 2, grace_seconds: float = 86_400) -> list[str]:
    """Delete lists but the last ``keep``, and month folders that none of those names. Returns the folders deleted.

    ``keep`` bounds how long a read may go on after its state was replaced. Folders younger than the grace time
    may belong to a write that has not switched yet; they stay.
    """
    found = numbers(spark, path)
    old, kept = found[: max(0, len(found) - keep)], found[max(0, len(found) - keep) :]
    used = {folder for number in kept for of in present(spark, path, number).folders.values() for folder in of}
    gone = []
    for version in storage.partition_values(spark, path, VERSION):
        months = [f"{VERSION}={version}/{PART}={m}" for m in storage.partition_values(spark, f"{path}/{VERSION}={version}", PART)]
        for folder in months:
            if folder not in used and storage.age_seconds(spark, f"{path}/{folder}") >= grace_seconds:
                storage.delete(spark, f"{path}/{folder}")
                gone.append(folder)
        if not set(months) - set(gone) and storage.age_seconds(spark, f"{path}/{VERSION}={version}") >= grace_seconds:
            storage.delete(spark, f"{path}/{VERSION}={version}")
    for number in old:
        storage.delete(spark, _list_path(path, number))
    return gone
