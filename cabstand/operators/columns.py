"""Projections: casts, renames, drops, label/feature split."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def by_name(df: DataFrame) -> dict[str, str]:
    """Lower-case name -> actual name."""
    return {name.lower(): name for name in df.columns}


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast mapped columns in place and pass the rest through.

    A value that does not fit becomes NULL (count them with :func:`cast_failures`). Names match
    without regard to case and come out spelled as in the mapping; column order is kept.
    """
    wanted = {name.lower(): (name, kind) for name, kind in types.items()}
    out = []
    for name in df.columns:
        if name.lower() in wanted:
            spelled, kind = wanted[name.lower()]
            out.append(F.col(name).try_cast(kind).alias(spelled))
        else:
            out.append(F.col(name))
    return df.select(*out)


def missing_columns(df: DataFrame, types: Mapping[str, str]) -> list[str]:
    """Mapped columns the frame does not have."""
    present = by_name(df)
    return [name for name in types if name.lower() not in present]


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Rows per mapped column that hold a value the declared type cannot take, in one pass."""
    present = by_name(df)
    names = [name for name in types if name.lower() in present]

    def failures(name: str) -> Column:
        source = F.col(present[name.lower()])
        return F.count_if(source.isNotNull() & source.try_cast(types[name]).isNull())

    counts = df.agg(*[failures(name).alias(f"n{i}") for i, name in enumerate(names)])
    pairs = [F.struct(F.lit(name).alias("column"), F.col(f"n{i}").alias("failed")) for i, name in enumerate(names)]
    return counts.select(F.inline(F.array(*pairs)))


def conform(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Exactly the declared columns, typed, in declared order; absent ones are NULL."""
    present = by_name(df)
    return df.select(
        *[
            (F.col(present[name.lower()]).try_cast(kind) if name.lower() in present else F.lit(None).cast(kind)).alias(name)
            for name, kind in types.items()
        ]
    )


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def prefix_columns(df: DataFrame, prefix: str, names: Mapping[str, str]) -> DataFrame:
    """Keep ``names`` (source -> suffix), each renamed to ``prefix + suffix``."""
    return df.select(*[F.col(source).alias(prefix + suffix) for source, suffix in names.items()])


def all_except(df: DataFrame, *names: str) -> DataFrame:
    """``SELECT * EXCEPT (...)``."""
    return df.drop(*names)


def label_and_features(df: DataFrame, target: str, drop: tuple[str, ...] = ()) -> tuple[str, list[str]]:
    """The target column and every other column, in order."""
    skip = {target.lower(), *(d.lower() for d in drop)}
    if target.lower() not in by_name(df):
        raise ValueError(f"no target column {target!r}")
    return by_name(df)[target.lower()], [c for c in df.columns if c.lower() not in skip]
