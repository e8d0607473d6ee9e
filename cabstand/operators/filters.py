"""Time windows, sampling predicates and drill-down filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from cabstand.functions import clock

ALL = "All"


def in_month(df: DataFrame, column: str, moment: clock.Moment, inclusive_end: bool = False) -> DataFrame:
    """Rows of one calendar month.

    Half-open, so the first midnight of the next month belongs to the next month only;
    ``inclusive_end`` keeps it in both. The bounds are literals of the column's own type and reach
    the file scan.
    """
    kind = clock.field_type(df, column)
    start, end = clock.month_bounds(moment)
    value = F.col(column)
    last = value <= clock.instant(end, kind) if inclusive_end else value < clock.instant(end, kind)
    return df.where((value >= clock.instant(start, kind)) & last)


def in_recent_months(df: DataFrame, column: str, months: int, as_of: clock.Moment | None = None) -> DataFrame:
    """Rows strictly later than ``as_of`` minus whole months."""
    kind = clock.field_type(df, column)
    return df.where(F.col(column) > clock.months_before(as_of, months, kind))


def in_years(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """Rows of whole years, written as a range on the column itself so that files can be skipped."""
    kind = clock.field_type(df, column)
    value = F.col(column)
    return df.where((value >= clock.instant(f"{first:04d}-01-01", kind)) & (value < clock.instant(f"{last + 1:04d}-01-01", kind)))


def since_day(df: DataFrame, column: str, day: clock.Moment) -> DataFrame:
    """Rows on or after a day (the incremental predicate)."""
    start = clock.as_datetime(day).replace(hour=0, minute=0, second=0, microsecond=0)
    return df.where(F.col(column) >= clock.instant(start, clock.field_type(df, column)))


def random_share(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Independent random rows."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def keyed_share(df: DataFrame, keys: Iterable[str], fraction: float, seed: int = 0) -> DataFrame:
    """Random rows chosen by key, so that a rerun or a lost task picks the same ones."""
    return df.where(keyed_fraction(keys, seed) < fraction)


def keyed_fraction(keys: Iterable[str], seed: int = 0) -> Column:
    """A number in [0, 1) fixed by the keys and the seed: the first 32 bits of an MD5 that SQL can state too."""
    joined = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def choose(df: DataFrame, column: str, values: str | Iterable[str]) -> DataFrame:
    """Dashboard filter: one or many values, where "All" keeps everything."""
    chosen = [values] if isinstance(values, str) else list(values)
    return df if ALL in chosen else df.where(F.col(column).isin(chosen))


def drill_down(dim: DataFrame, parent: str, value: str, child: str) -> DataFrame:
    """Distinct child values below one parent value (or below all)."""
    return choose(dim, parent, value).select(child).distinct()
