"""What footers tell before any row is read: ranges of a column per row group, and which files one read can take together.

Both come as tables, made on the executors; what reaches the driver is one entry per distinct schema and the
file names that Spark's reader takes as arguments.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cabstand.functions import clock
from cabstand.operators.columns import conform
from cabstand.operators.joins import concat
from cabstand.sources import files as file_sources

RANGES = "link string, row_group int, rows long, low timestamp_ntz, high timestamp_ntz, known boolean"


def _ranges(batches: Iterator[pa.RecordBatch], column: str, options: Mapping[str, str]) -> Iterator[pa.RecordBatch]:
    import datetime as dt

    import pyarrow.parquet as pq

    def bound(value):
        if isinstance(value, dt.datetime):
            return value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value
        return dt.datetime(value.year, value.month, value.day) if isinstance(value, dt.date) else None

    names = ["link", "row_group", "rows", "low", "high", "known"]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.timestamp("us"), pa.timestamp("us"), pa.bool_()]
    for batch in batches:
        rows = []
        for link in batch.column("path").to_pylist():
            filesystem, path = file_sources.arrow_store(link, options)
            with filesystem.open_input_file(path) as handle:
                footer = pq.read_metadata(handle)
            at = next((i for i in range(footer.num_columns) if footer.schema.column(i).path.lower() == column.lower()), None)
            for number in range(footer.num_row_groups):
                group = footer.row_group(number)
                stats = group.column(at).statistics if at is not None else None
                if at is None or (stats is not None and stats.null_count == group.num_rows):
                    # No row of the group has a value.
                    rows.append((link, number, group.num_rows, None, None, True))
                    continue
                low, high = (bound(stats.min), bound(stats.max)) if stats is not None and stats.has_min_max else (None, None)
                rows.append((link, number, group.num_rows, low, high, low is not None and high is not None))
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def row_group_ranges(files: DataFrame, column: str, tasks: int | None = None) -> DataFrame:
    """Least and greatest time of a column per row group. ``known`` is false where the footer doesn't say; a group
    without any value is known and has no range."""
    tasks = tasks or files.sparkSession.sparkContext.defaultParallelism
    options = file_sources.store_options(files.sparkSession)
    return files.select("path").repartition(tasks, "path").mapInArrow(lambda batches: _ranges(batches, column, options), RANGES)


def files_between(ranges: DataFrame, start: clock.Moment | None = None, end: clock.Moment | None = None) -> DataFrame:
    """(link) of the files that may hold a time in ``[start, end)``: those with a row group whose range meets it, or whose range isn't known."""
    may = F.lit(True)
    if start is not None:
        may = may & (F.col("high") >= clock.instant(clock.as_datetime(start), T.TimestampNTZType()))
    if end is not None:
        may = may & (F.col("low") < clock.instant(clock.as_datetime(end), T.TimestampNTZType()))
    return ranges.where(~F.col("known") | F.coalesce(may, F.lit(False))).select("link").distinct()


@contextmanager
def _footer_reader(spark: SparkSession) -> Iterator[None]:
    """The second parquet reader, which answers counts and extremes from footers; it is off by default."""
    plain = spark.conf.get("spark.sql.sources.useV1SourceList")
    before = {name: spark.conf.get(name) for name in ("spark.sql.parquet.aggregatePushdown", "spark.sql.sources.useV1SourceList")}
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(name for name in plain.split(",") if name != "parquet"))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


#: Types whose extremes the reader takes from footers; others would be read row by row.
PUSHED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)


def extremes(spark: SparkSession, links: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, str]:
    """Number of rows, and values, least and greatest of each column as one row; and the plan that gave them.

    Numbers, days and truth values come out of the footers, without a row being read; columns of other types are read.
    The result is computed here, one row, since the reader's settings hold for this query alone.
    """
    with _footer_reader(spark):
        files = spark.read.parquet(*links)
        measures = [F.count("*").alias("rows")]
        for name in columns:
            measures += [F.count(name).alias(f"n_{name}"), F.min(name).alias(f"low_{name}"), F.max(name).alias(f"high_{name}")]
        found = files.agg(*measures)
        plan = found._jdf.queryExecution().toString()
        row = found.first()
    return spark.createDataFrame([row], found.schema), plan


# Stored types and the type that a read gives them.
READ_AS = {
    "bool": "boolean", "int8": "int", "int16": "int", "int32": "int", "int64": "bigint", "float": "float", "double": "double",
    "string": "string", "large_string": "string", "date32[day]": "date", "timestamp[ms]": "timestamp_ntz",
    "timestamp[us]": "timestamp_ntz",
}

#: Types that one read can widen to a common one, for each pair, in the order of their names.
WIDENED = {
    ("bigint", "int"): "bigint",
    ("double", "int"): "double",
    ("double", "float"): "double",
    ("float", "int"): "double",
}


def read_type(stored: str) -> str | None:
    """The type of a stored column in a read; None for types that are only read as they are."""
    if re.fullmatch(r"timestamp\[(ms|us), tz=.*\]", stored):
        return "timestamp"
    return READ_AS.get(stored)


def joined_type(a: str, b: str) -> str | None:
    """The least type that one read can give both; None for a conflict."""
    return a if a == b else WIDENED.get(tuple(sorted((a, b))))


def _compatible(types: Mapping[str, str], others: Mapping[str, str]) -> dict[str, str] | None:
    """Both column lists under common types, or None. Three types may each widen in pairs and not together, so types are joined as they grow."""
    out = dict(others)
    for name, kind in types.items():
        joined = joined_type(kind, out[name]) if name in out else kind
        if joined is None:
            return None
        out[name] = joined
    return out


@dataclass(frozen=True)
class FileGroup:
    """Files that one read takes together; ``types`` by lower-case column name, None where the reader has to find out."""

    links: tuple[str, ...]
    types: Mapping[str, str] | None


def merged_schemas(schemas: Sequence[Mapping[str, str]]) -> list[tuple[dict[str, str], list[int]]]:
    """Column lists put together first fit, the widest first: (common types, numbers of the lists)."""
    merged: list[tuple[dict[str, str], list[int]]] = []
    for number in sorted(range(len(schemas)), key=lambda i: (-len(schemas[i]), sorted(schemas[i].items()), i)):
        for k, (types, members) in enumerate(merged):
            joined = _compatible(schemas[number], types)
            # A group that is widened further must still be readable from each member's own types.
            if joined is not None and all(_readable(schemas[m], joined) for m in [*members, number]):
                merged[k] = (joined, [*members, number])
                break
        else:
            merged.append((dict(schemas[number]), [number]))
    return merged


def _readable(types: Mapping[str, str], target: Mapping[str, str]) -> bool:
    return all(joined_type(kind, target[name]) == target[name] for name, kind in types.items())


def compatible_groups(files: DataFrame, columns: Sequence[str]) -> list[FileGroup]:
    """The files of a manifest in few groups: a column that some lack, or that is narrower in some, doesn't part them.

    Only ``columns`` count, without regard to letter case. Files with a type among them that can't be named in a read
    stay with those of exactly the same fields.
    """
    wanted = {name.lower() for name in columns}
    footers = file_sources.footer_schemas(file_sources.require_files(files))
    fields = footers.groupBy("link").agg(F.sort_array(F.collect_list(F.struct(F.lower("column").alias("column"), "type"))).alias("fields"))
    chosen = fields.withColumn("fields", F.filter("fields", lambda f: f["column"].isin(sorted(wanted))))
    by_schema: dict[tuple, list[str]] = {}
    # One name per file, as the reader needs them; distinct schemas are few.
    for row in chosen.toLocalIterator(prefetchPartitions=True):
        by_schema.setdefault(tuple((f["column"], f["type"]) for f in row["fields"]), []).append(row["link"])
    named, groups = [], []
    for schema, links in sorted(by_schema.items()):
        types = {name: read_type(stored) for name, stored in schema}
        if None in types.values() or len(types) < len(schema):
            groups.append(FileGroup(tuple(sorted(links)), None))
        else:
            named.append((types, links))
    for types, members in merged_schemas([types for types, _ in named]):
        groups.append(FileGroup(tuple(sorted(link for m in members for link in named[m][1])), types))
    return sorted(groups, key=lambda group: group.links)


def only_files(groups: Sequence[FileGroup], links: DataFrame) -> list[FileGroup]:
    """The groups without the files that ``links`` doesn't name."""
    kept = {row["link"] for row in links.toLocalIterator(prefetchPartitions=True)}
    cut = [FileGroup(tuple(link for link in group.links if link in kept), group.types) for group in groups]
    return [group for group in cut if group.links]


def read_group(spark: SparkSession, group: FileGroup) -> DataFrame:
    """One scan of a group, its columns under their common types."""
    if group.types is None:
        return file_sources.read_parquet(spark, list(group.links))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in group.types.items())
    return spark.read.schema(schema).parquet(*group.links)


def read_compatible(spark: SparkSession, groups: Sequence[FileGroup], types: Mapping[str, str], keep=None) -> DataFrame:
    """All groups as one frame of the declared columns. ``keep`` filters each scan before the cast."""
    if not groups:
        return spark.createDataFrame([], ", ".join(f"`{name}` {kind}" for name, kind in types.items()))
    scans = [read_group(spark, group) for group in groups]
    return concat([conform(keep(scan) if keep else scan, types) for scan in scans])
