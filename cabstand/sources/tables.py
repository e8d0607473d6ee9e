"""Month-partitioned parquet tables: idempotent writes, layout, reads, retention, DDL."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cabstand.functions import clock
from cabstand.operators.columns import conform
from cabstand.sources import storage

PART = "part_month"
NO_MONTH = "none"


@contextmanager
def labelled(spark: SparkSession, label: str | None):
    """Tag the jobs of a block, so that their cost can be told apart afterwards."""
    if not label:
        yield
        return
    spark.addTag(label)
    spark.sparkContext.setJobDescription(label)
    try:
        yield
    finally:
        spark.removeTag(label)
        spark.sparkContext.setJobDescription(None)


@dataclass(frozen=True)
class Written:
    """What one write put into a table: its rows and the partition folders that got some."""

    rows: int
    partitions: frozenset[str]


def with_month(df: DataFrame, date_column: str) -> DataFrame:
    """Add the partition id; rows without a date share one partition of their own."""
    return df.withColumn(PART, F.coalesce(clock.month_id(F.col(date_column)), F.lit(NO_MONTH)))


def laid_out(
    df: DataFrame, cluster: Sequence[str] = (), counter: Observation | None = None, parts: Sequence[str] = (PART,), gathered: bool = False,
) -> DataFrame:
    """Rows gathered by month and sorted by the cluster columns within each file.

    The rebalance hint lets AQE split a month that is larger than the advisory size (one month may
    be all there is) and merge small ones, so files stay even; sorting narrows the min/max range of
    pages and row groups, which is what lets later scans skip them. ``counter`` fills in during the write
    with the rows and partitions written, without another pass. Rows that come ``gathered`` by month stay in their tasks.
    """
    rows = df if gathered else df.hint("rebalance", F.col(PART))
    if counter is not None:
        folder = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.col(p)) for p in parts])
        rows = rows.observe(counter, F.count("*").alias("rows"), F.collect_set(folder).alias("partitions"))
    return rows.sortWithinPartitions(*parts, *cluster)


def _write(df: DataFrame, path: str, mode: str, date_column: str, cluster, label, extra_partitions, gathered: bool = False) -> Written:
    parts = (PART, *extra_partitions)
    counter = Observation(f"{label or 'write'}-{uuid.uuid4().hex}")
    table = laid_out(with_month(df, date_column), cluster, counter, parts, gathered)
    with labelled(df.sparkSession, label):
        (
            table.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts)
            .parquet(path)
        )
    found = counter.get
    return Written(found["rows"], frozenset(found["partitions"]))


def overwrite_months(
    df: DataFrame, path: str, date_column: str, cluster: Sequence[str] = (), label: str | None = None,
    extra_partitions: Sequence[str] = (), gathered: bool = False,
) -> Written:
    """Replace exactly the months present in ``df``; other months stay.

    Files are staged and moved at commit, so a failed run leaves the old month in place and a rerun
    gives the same table.
    """
    return _write(df, path, "overwrite", date_column, cluster, label, extra_partitions, gathered)


def append_months(
    df: DataFrame, path: str, date_column: str, cluster: Sequence[str] = (), label: str | None = None
) -> Written:
    """Append rows. A rerun repeats them: prefer :func:`overwrite_months`."""
    return _write(df, path, "append", date_column, cluster, label, ())


def drop_stale(spark: SparkSession, path: str, written: Written, months: Sequence[str], extra_partition: str | None = None) -> list[str]:
    """Drop the folders of ``months`` that the last write did not fill.

    An overwrite replaces only partitions it has rows for; a month (or route) that came out empty
    this time would otherwise keep its old rows.
    """
    if extra_partition is None:
        folders = [f"{PART}={month}" for month in months]
    else:
        folders = [
            f"{PART}={month}/{extra_partition}={value}"
            for month in months
            for value in storage.partition_values(spark, f"{path}/{PART}={month}", extra_partition)
        ]
    stale = [folder for folder in folders if folder not in written.partitions]
    for folder in stale:
        storage.delete(spark, f"{path}/{folder}")
    return stale


def replace_table(
    df: DataFrame, path: str, date_column: str, cluster: Sequence[str] = (), label: str | None = None,
    extra_partition: str | None = None,
) -> Written:
    """Full refresh: write the new months, then drop what the new data does not have.

    In this order no reader finds an empty table in between.
    """
    spark = df.sparkSession
    before = storage.partition_values(spark, path, PART)
    written = overwrite_months(df, path, date_column, cluster, label, (extra_partition,) if extra_partition else ())
    drop_stale(spark, path, written, before, extra_partition)
    return written


def read_months(
    spark: SparkSession, path: str, date_column: str | None = None,
    start: clock.Moment | None = None, end: clock.Moment | None = None,
) -> DataFrame:
    """A month table, optionally for ``[start, end)``.

    The range is stated twice: on the partition id, which skips folders, and on the column.
    """
    df = spark.read.option("basePath", path).parquet(path)
    df = df.withColumn(PART, F.col(PART).cast("string"))
    if start is not None:
        first = clock.as_datetime(start)
        df = df.where(F.col(PART) >= f"{first:%Y%m}")
        df = df.where(F.col(date_column) >= clock.instant(first, clock.field_type(df, date_column)))
    if end is not None:
        last = clock.as_datetime(end)
        df = df.where((F.col(PART) <= f"{last:%Y%m}"))
        df = df.where(F.col(date_column) < clock.instant(last, clock.field_type(df, date_column)))
    return df


def expired_months(months: Sequence[str], as_of: clock.Moment | None, days: int) -> list[str]:
    """Months that ended ``days`` or more before ``as_of``; a month still partly young is kept."""
    limit = clock.as_datetime(as_of) - dt.timedelta(days=days)
    dated = [m for m in months if len(m) == 6 and m.isdigit()]
    return [m for m in dated if clock.month_bounds(dt.datetime(int(m[:4]), int(m[4:]), 1))[1] <= limit]


def expire(spark: SparkSession, path: str, as_of: clock.Moment | None, days: int) -> list[str]:
    """Drop expired months as whole folders; no data is read. Returns the months dropped."""
    gone = expired_months(storage.partition_values(spark, path, PART), as_of, days)
    for month in gone:
        storage.delete(spark, f"{path}/{PART}={month}")
    return gone


def commented(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column descriptions; parquet writes keep them with the schema."""
    for name, text in comments.items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": text})
    return df


def descriptions(df: DataFrame) -> DataFrame:
    """``(column, comment)`` as stored with the schema."""
    pairs = [
        F.struct(F.lit(f.name).alias("column"), F.lit(f.metadata.get("comment")).cast("string").alias("comment"))
        for f in df.schema.fields
    ]
    return df.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*pairs)))


def create_table_sql(
    table: str, columns: Mapping[str, str], comments: Mapping[str, str] | None = None,
    location: str | None = None, description: str | None = None,
) -> str:
    """DDL of a month-partitioned parquet table with its descriptions."""
    comments = comments or {}

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    lines = [
        f"  `{name}` {kind.upper()}" + (f" COMMENT {quoted(comments[name])}" if name in comments else "")
        for name, kind in columns.items()
    ]
    lines.append(f"  `{PART}` STRING")
    ddl = f"CREATE TABLE IF NOT EXISTS {table} (\n" + ",\n".join(lines) + f"\n) USING parquet\nPARTITIONED BY ({PART})"
    if description:
        ddl += f"\nCOMMENT {quoted(description)}"
    if location:
        ddl += f"\nLOCATION {quoted(location)}"
    return ddl


def enforced(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The declared columns in declared order; an undeclared column is an error."""
    declared = {name.lower() for name in columns}
    unknown = [name for name in df.columns if name.lower() not in declared]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    return conform(df, columns)


def declared(df: DataFrame, columns: Mapping[str, str], comments: Mapping[str, str], also: Sequence[str] = ()) -> DataFrame:
    """What a load writes: the declared columns in declared order and type, then those named in ``also``, all with their descriptions.

    A column that is neither is an error, before anything is written.
    """
    present = {name.lower(): name for name in df.columns}
    unknown = sorted(set(present) - {name.lower() for name in (*columns, *also)})
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    typed = [
        (F.col(present[name.lower()]).try_cast(kind) if name.lower() in present else F.lit(None).cast(kind)).alias(name)
        for name, kind in columns.items()
    ]
    return commented(df.select(*typed, *[F.col(name) for name in also]), comments)


def bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a catalog table whose files are split by a hash of ``keys`` and sorted by them (then by ``sort``).

    Two tables with the same number of buckets over keys of the same types join on those keys, and one groups by them,
    without an exchange: the shuffle is paid once, here. Rows are gathered by bucket first, so a bucket is one file.
    """
    rows = df.repartition(buckets, *keys)
    rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, *sort).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a frame as a view; nothing is stored, readers always see the current result."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
