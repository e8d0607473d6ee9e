"""Clean / triage routing by named rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cabstand.specs import NamedRule

ROUTE = "route"
REASONS = "failed_rules"
CLEAN = "clean"
TRIAGE = "triage"


def all_met(rules: Sequence[NamedRule]) -> Column:
    """Every rule holds; NULL when that cannot be told."""
    return reduce(lambda a, b: a & b, (rule.condition for rule in rules), F.lit(True))


def with_route(df: DataFrame, rules: Sequence[NamedRule], null_policy: str = "triage") -> DataFrame:
    """Mark each row clean or triage and name the rules it failed, in one pass.

    ``null_policy="triage"``: a rule that yields NULL counts as failed, so clean and triage together
    are the input. ``"drop"``: rows for which the rules as a whole yield NULL are in neither, the
    result of ``WHERE rules`` plus ``WHERE NOT (rules)``.
    """
    if null_policy not in ("triage", "drop"):
        raise ValueError("null_policy is 'triage' or 'drop'")
    met = all_met(rules)
    failed = F.array_compact(
        F.array(*[F.when(~F.coalesce(rule.condition, F.lit(False)), F.lit(rule.name)) for rule in rules])
    )
    clean = F.coalesce(met, F.lit(False))
    routed = df if null_policy == "triage" else df.where(met.isNotNull())
    return routed.withColumns(
        {
            ROUTE: F.when(clean, F.lit(CLEAN)).otherwise(F.lit(TRIAGE)),
            REASONS: F.when(clean, F.array().cast("array<string>")).otherwise(failed),
        }
    )


def split(df: DataFrame, rules: Sequence[NamedRule], null_policy: str = "triage") -> tuple[DataFrame, DataFrame]:
    """Clean rows and triage rows as two lazy frames with the input's columns."""
    met = all_met(rules)
    rejected = ~F.coalesce(met, F.lit(False)) if null_policy == "triage" else ~met
    return df.where(met), df.where(rejected)


def reasons(routed: DataFrame) -> DataFrame:
    """Rows per failed rule, most frequent first."""
    failed = routed.where(F.col(ROUTE) == TRIAGE).select(F.explode(REASONS).alias("rule"))
    return failed.groupBy("rule").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "rule")
