"""Dimension joins, existence filters, unions.

No operator forces a broadcast. Spark broadcasts a side whose size it knows to be below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles (with AQE skew splitting), so a
dimension that grows past the bound changes the join, not the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def unique_dimension(dim: DataFrame, key: str, policy: str = "mean") -> DataFrame:
    """A dimension with one row per key, so that a join on it cannot multiply facts.

    ``"mean"`` averages numbers and takes the smallest text; ``"strict"`` raises inside the query
    when a key repeats; ``"as_is"`` leaves the dimension alone.
    """
    if policy == "as_is":
        return dim
    if policy not in ("mean", "strict"):
        raise ValueError("policy is 'mean', 'strict' or 'as_is'")
    measures: list[Column] = []
    for field in dim.schema.fields:
        if field.name == key:
            continue
        fold = F.avg if policy == "mean" and field.dataType.typeName() in ("double", "float") else F.min
        measures.append(fold(field.name).cast(field.dataType).alias(field.name))
    folded = dim.where(F.col(key).isNotNull()).groupBy(key).agg(*measures, F.count("*").alias("_copies"))
    if policy == "strict":
        complaint = F.raise_error(F.concat(F.lit(f"repeated {key}: "), F.col(key).cast("string")))
        folded = folded.withColumn(key, F.when(F.col("_copies") == 1, F.col(key)).otherwise(complaint))
    return folded.select(*dim.columns)


def with_roles(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    roles: Mapping[str, str],
    attributes: Mapping[str, str],
    how: str = "inner",
) -> DataFrame:
    """Join one dimension once per role.

    ``roles`` maps a prefix to the fact's key column, ``attributes`` maps a dimension column to the
    suffix of its output name. ``inner`` drops facts with an unknown key in any role; ``left`` keeps
    them with NULL attributes.
    """
    result = fact
    for prefix, fact_key in roles.items():
        role_key = f"_{prefix}key"
        side = dim.select(
            F.col(key).alias(role_key),
            *[F.col(source).alias(prefix + suffix) for source, suffix in attributes.items()],
        )
        result = result.join(side, F.col(fact_key) == F.col(role_key), how).drop(role_key)
    return result


def unmatched(fact: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, str]) -> DataFrame:
    """Facts per role whose key the dimension does not know (NULL keys included), in one row."""
    marked = fact
    for prefix, fact_key in roles.items():
        side = dim.select(F.col(key).alias(f"_{prefix}k")).distinct()
        marked = marked.join(side, F.col(fact_key) == F.col(f"_{prefix}k"), "left")
    return marked.agg(
        *[F.count_if(F.col(f"_{prefix}k").isNull()).alias(f"{prefix}unmatched") for prefix in roles],
        F.count("*").alias("facts"),
    )


def existing(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows with a partner in ``other``; ``on`` maps own column to the other's."""
    return _by_existence(df, other, on, "left_semi")


def missing(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows without a partner in ``other``."""
    return _by_existence(df, other, on, "left_anti")


def _by_existence(df: DataFrame, other: DataFrame, on: Mapping[str, str], how: str) -> DataFrame:
    # The keys are made distinct first: a key that fills a third of `other` collapses on the map
    # side instead of landing whole in one join task.
    keys = other.select(*[F.col(theirs).alias(f"_k{i}") for i, theirs in enumerate(on.values())]).distinct()
    match = reduce(lambda a, b: a & b, (F.col(mine) == F.col(f"_k{i}") for i, mine in enumerate(on)))
    return df.join(keys, match, how)


def with_scalar(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Add the only value of a one-row, one-column frame to every row (a scalar subquery)."""
    return df.withColumn(name, one_row.scalar())


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; a column a frame lacks is NULL there."""
    if not frames:
        raise ValueError("nothing to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def difference_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """How often rows occur more in one frame than in the other; 0 and 0 for equal frames.

    Every row counts +1 or -1 and the balance is taken per distinct row: one aggregation that
    pre-aggregates on the map side, where two ``exceptAll`` would shuffle both frames twice.
    """
    names = left.columns
    marked = left.withColumn("_w", F.lit(1)).unionByName(right.withColumn("_w", F.lit(-1)))
    balance = marked.groupBy(*names).agg(F.sum("_w").alias("_w"))
    return balance.agg(
        F.coalesce(F.sum(F.greatest("_w", F.lit(0))), F.lit(0)).cast("bigint").alias("only_left"),
        F.coalesce(F.sum(F.greatest(-F.col("_w"), F.lit(0))), F.lit(0)).cast("bigint").alias("only_right"),
    )
