"""Monthly batch and full refresh: files -> summary table and routed trip table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cabstand import quality
from cabstand.functions import clock
from cabstand.operators import columns, filters, routing, summary
from cabstand.quality.rules import Suite
from cabstand.sources import files as file_sources, footers, snapshots, tables
from cabstand.specs import ROUTE_COMMENTS, SUMMARY_COLUMNS, SUMMARY_COMMENTS, DatasetSpec


@dataclass(frozen=True)
class Outputs:
    """Table folders of a pipeline. With ``snapshots`` every load becomes visible in one step
    (:mod:`cabstand.sources.snapshots`); otherwise months are overwritten in place."""

    summary: str
    trips: str
    snapshots: bool = False


@dataclass(frozen=True)
class LoadReport:
    summary_rows: int
    trip_rows: int


def _has_times(df: DataFrame, name: str) -> bool:
    present = columns.by_name(df)
    return name.lower() in present and isinstance(
        df.schema[present[name.lower()]].dataType, (T.TimestampType, T.TimestampNTZType)
    )


def month_input(df: DataFrame, spec: DatasetSpec, month: clock.Moment, inclusive_end: bool = False) -> DataFrame:
    """Typed rows of one month. A time column that is already one is filtered before the cast, where
    the filter still reaches the file scan."""
    if _has_times(df, spec.start):
        return columns.cast_columns(filters.in_month(df, spec.start, month, inclusive_end), spec.columns)
    return filters.in_month(columns.cast_columns(df, spec.columns), spec.start, month, inclusive_end)


def validate(
    df: DataFrame, suite: Suite, threshold: str | float, as_of: clock.Moment | None = None,
    results_path: str | None = None, run: str | None = None,
) -> DataFrame:
    """The gate before a load: evaluate, optionally keep the results, raise below the threshold."""
    results = quality.evaluate(df, suite, as_of)
    if results_path:
        results = quality.run.save_results(results, results_path, run or quality.run.run_id(suite.name, as_of))
    quality.gate(results, threshold)
    return results


def summary_table(rows: DataFrame, spec: DatasetSpec, busiest_scope: str) -> DataFrame:
    """The summary as it is stored: declared columns with their descriptions."""
    return tables.declared(summary.monthly_summary(rows, spec, busiest_scope), SUMMARY_COLUMNS, SUMMARY_COMMENTS)


def trip_table(rows: DataFrame, spec: DatasetSpec, as_of: clock.Moment | None, null_policy: str) -> DataFrame:
    """The trips as they are stored: declared columns and the route, with their descriptions."""
    marked = routing.with_route(rows, spec.rules(as_of), null_policy)
    comments = {**spec.comments, **ROUTE_COMMENTS}
    return tables.declared(marked, spec.columns, comments, (routing.ROUTE, routing.REASONS))


def run_month(
    spark: SparkSession,
    spec: DatasetSpec,
    source: list[str],
    month: clock.Moment,
    out: Outputs,
    as_of: clock.Moment | None = None,
    busiest_scope: str = "group",
    null_policy: str = "triage",
    suite: Suite | None = None,
    threshold: str | float = "100%",
    results_path: str | None = None,
) -> LoadReport:
    """Load one month; running it again gives the same tables.

    With a ``suite`` the source is validated first, and nothing is written below the ``threshold``.

    The source is scanned twice: once narrow for the summary, once in full for clean and triage
    together (one write, partitioned by route), instead of once per output. Nothing is cached, so a
    lost executor costs only its own tasks.
    """
    if suite is not None:
        validate(file_sources.read_parquet(spark, source), suite, threshold, as_of, results_path)
    rows = month_input(file_sources.read_parquet(spark, source), spec, month)
    month_folder = f"{clock.month_bounds(month)[0]:%Y%m}"
    table = summary_table(rows, spec, busiest_scope)
    summary_sink = (out.summary, "first_day_of_month", spec.cluster_summary, f"summary-{month_folder}")
    marked = trip_table(rows, spec, as_of, null_policy)
    trips_sink = (out.trips, spec.start, spec.cluster_rows, f"trips-{month_folder}", (routing.ROUTE,))
    if out.snapshots:
        wrote_summary = snapshots.replace_months(table, *summary_sink, months=[month_folder])
        wrote_trips = snapshots.replace_months(marked, *trips_sink, months=[month_folder])
        return LoadReport(wrote_summary.rows, wrote_trips.rows)
    wrote_summary = tables.overwrite_months(table, *summary_sink)
    tables.drop_stale(spark, out.summary, wrote_summary, [month_folder])
    wrote_trips = tables.overwrite_months(marked, *trips_sink)
    tables.drop_stale(spark, out.trips, wrote_trips, [month_folder], routing.ROUTE)
    return LoadReport(wrote_summary.rows, wrote_trips.rows)


def run_full(
    spark: SparkSession,
    spec: DatasetSpec,
    manifest: DataFrame,
    out: Outputs,
    as_of: clock.Moment | None = None,
    busiest_scope: str = "group",
    null_policy: str = "triage",
    suite: Suite | None = None,
    threshold: str | float = "100%",
    results_path: str | None = None,
) -> LoadReport:
    """Rebuild both tables from all files of a manifest.

    With a ``suite`` all rows are validated first, and nothing is written below the ``threshold``.

    Files whose schemas one read can widen to a common one are one scan. All scans are united first and summarised once,
    so a key and month that spans them is one row. The summary covers everything; trips are kept for the recent
    months, and of files that the ranges in their footers place before those, none is opened.
    """
    groups = footers.compatible_groups(manifest, list(spec.columns))
    rows = footers.read_compatible(spark, groups, spec.columns)
    if suite is not None:
        validate(rows, suite, threshold, as_of, results_path)
    table = summary_table(rows, spec, busiest_scope)
    summary_sink = (out.summary, "first_day_of_month", spec.cluster_summary, f"summary-{spec.name}-full")
    wrote_summary = snapshots.replace_all(table, *summary_sink) if out.snapshots else tables.replace_table(table, *summary_sink)

    def recent_files(df: DataFrame) -> DataFrame:
        return filters.in_recent_months(df, spec.start, spec.recent_months, as_of) if _has_times(df, spec.start) else df

    # Files whose footers rule the recent months out are not opened; the first of the month is early enough for any day of it.
    oldest = clock.month_bounds(as_of)[0]
    for _ in range(spec.recent_months):
        oldest = clock.month_bounds(oldest - dt.timedelta(days=1))[0]
    may_be_recent = footers.files_between(footers.row_group_ranges(manifest, spec.start), oldest)
    recent = footers.read_compatible(spark, footers.only_files(groups, may_be_recent), spec.columns, keep=recent_files)
    recent = filters.in_recent_months(recent, spec.start, spec.recent_months, as_of)
    marked = trip_table(recent, spec, as_of, null_policy)
    trips_sink = (out.trips, spec.start, spec.cluster_rows, f"trips-{spec.name}-full")
    if out.snapshots:
        wrote_trips = snapshots.replace_all(marked, *trips_sink, (routing.ROUTE,))
    else:
        wrote_trips = tables.replace_table(marked, *trips_sink, routing.ROUTE)
    return LoadReport(wrote_summary.rows, wrote_trips.rows)


def read_table(spark: SparkSession, path: str, *window) -> DataFrame:
    """A table of either kind, optionally ``(date column, start, end)``."""
    read = snapshots.read if snapshots.is_versioned(spark, path) else tables.read_months
    return read(spark, path, *window)


def trips(spark: SparkSession, path: str, spec: DatasetSpec, route: str = routing.CLEAN) -> DataFrame:
    """Clean (or triage) rows of the trip table with the declared columns and the month id."""
    rows = read_table(spark, path).where(F.col(routing.ROUTE) == route)
    extra = [routing.REASONS] if route == routing.TRIAGE else []
    return rows.select(*spec.columns, *extra, tables.PART)


def retain(spark: SparkSession, path: str, spec: DatasetSpec, as_of: clock.Moment | None = None) -> list[str]:
    """Drop months older than the dataset's retention."""
    drop = snapshots.expire if snapshots.is_versioned(spark, path) else tables.expire
    return drop(spark, path, as_of, spec.retention_days)
