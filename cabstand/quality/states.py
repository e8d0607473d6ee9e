"""Suites over a table that grows by months: what a month contributes is kept, so a run reads only new months.

Three small tables hold the contributions, one folder per month. ``counters`` has, per rule on single rows, how many rows count and
fail, and for a rule on the greatest value that value. ``values`` has, per column that a rule on distinct values or on
deviations names, how often each value occurs: sums over months are exact, and from them so are distinct values, mean,
deviation and the rows beyond it. ``latest`` has the latest time per group of a recency rule. A month that is loaded again
replaces its contributions. Results have the form of :func:`cabstand.quality.evaluate` and equal those of a full run.

A column of ``values`` costs its distinct values per month: a few thousand for amounts, all rows for a key that has to be unique.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cabstand.functions import clock
from cabstand.operators.columns import by_name
from cabstand.quality import run
from cabstand.quality.rules import Rule, Suite
from cabstand.sources import storage
from cabstand.sources.tables import PART

PARTS = ("counters", "values", "latest")
SINGLE = tuple(kind for kind in run.ROW_KINDS if kind != "within_stdevs")

COUNTERS = f"{PART} string, number int, total bigint, failing bigint, greatest double"
VALUES = f"{PART} string, column string, text string, number double, n bigint"
LATEST = f"{PART} string, number int, key string, latest timestamp"


def _present(df: DataFrame, rule: Rule) -> bool:
    known = by_name(df)
    named = [rule.column] if rule.column else []
    return all(name.lower() in known for name in [*named, *[rule.params[k] for k in ("a", "b") if k in rule.params]])


def _numbered(df: DataFrame, suite: Suite, kinds: Sequence[str]) -> list[tuple[int, Rule]]:
    return [(i, rule) for i, rule in enumerate(suite.rules) if rule.kind in kinds and _present(df, rule)]


def counters(df: DataFrame, suite: Suite) -> DataFrame:
    """All rules on single rows of all months, in one pass over the frame."""
    measures, entries = [], []
    for i, rule in _numbered(df, suite, (*SINGLE, "max_between")):
        if rule.kind == "max_between":
            measures.append(F.max(run._resolve(df, rule.column)).cast("double").alias(f"m{i}"))
            total, failing, greatest = F.col("rows"), F.lit(0).cast("long"), F.col(f"m{i}")
        else:
            counted, fails = run._row_test(df, rule, lambda name: None)
            measures += [F.count_if(counted).alias(f"c{i}"), F.count_if(fails).alias(f"f{i}")]
            total, failing, greatest = F.col(f"c{i}"), F.col(f"f{i}"), F.lit(None).cast("double")
        entries.append(F.struct(F.lit(i).alias("number"), total.alias("total"), failing.alias("failing"), greatest.alias("greatest")))
    if not entries:
        return df.sparkSession.createDataFrame([], COUNTERS)
    by_month = df.groupBy(PART).agg(F.count("*").alias("rows"), *measures)
    return by_month.select(PART, F.inline(F.array(*entries)))


def values(df: DataFrame, suite: Suite) -> DataFrame:
    """How often each value of a column occurs in a month; NULLs are left out."""
    columns = sorted({run._resolve(df, r.column) for _, r in _numbered(df, suite, (*run.DISTINCT_KINDS, "within_stdevs"))})
    parts = []
    for name in columns:
        number = F.col("value").cast("double") if isinstance(df.schema[name].dataType, T.NumericType) else F.lit(None).cast("double")
        counted = df.where(F.col(name).isNotNull()).groupBy(PART, F.col(name).alias("value")).agg(F.count("*").alias("n"))
        parts.append(counted.select(PART, F.lit(name.lower()).alias("column"), F.col("value").cast("string").alias("text"), number.alias("number"), "n"))
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], VALUES)


def latest(df: DataFrame, suite: Suite) -> DataFrame:
    """The latest time of each group of each recency rule."""
    parts = []
    for i, rule in _numbered(df, suite, ("recent",)):
        keys = list(rule.params.get("keys", []))
        named = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit("")
        found = df.groupBy(PART, *keys).agg(F.max(run._resolve(df, rule.column)).cast("timestamp").alias("latest"))
        parts.append(found.select(PART, F.lit(i).alias("number"), named.alias("key"), "latest"))
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], LATEST)


def keep(df: DataFrame, suite: Suite, path: str) -> None:
    """Store what the months of ``df`` contribute; months that are there already are replaced, others stay.

    ``df`` has the month id in a column ``part_month`` and holds its months whole.
    """
    for name, made in zip(PARTS, (counters(df, suite), values(df, suite), latest(df, suite))):
        (
            made.hint("rebalance", PART)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PART)
            .parquet(f"{path}/{name}")
        )


def missing_months(spark: SparkSession, path: str, months: Sequence[str]) -> list[str]:
    """Those of ``months`` that have not contributed yet."""
    return sorted(set(months) - set(storage.partition_values(spark, f"{path}/counters", PART)))


def forget(spark: SparkSession, path: str, months: Sequence[str]) -> None:
    """Take months out that retention has dropped."""
    for name in PARTS:
        for month in months:
            storage.delete(spark, f"{path}/{name}/{PART}={month}")


@dataclass(frozen=True)
class States:
    counters: DataFrame
    values: DataFrame
    latest: DataFrame


def read(spark: SparkSession, path: str) -> States:
    schemas = (COUNTERS, VALUES, LATEST)
    there = [storage.exists(spark, f"{path}/{name}") for name in PARTS]
    tables = [
        spark.read.schema(schema).parquet(f"{path}/{name}") if exists else spark.createDataFrame([], schema)
        for name, schema, exists in zip(PARTS, schemas, there)
    ]
    return States(*tables)


def merged(states: States, like: DataFrame, suite: Suite, as_of: clock.Moment | None = None) -> DataFrame:
    """The results of the suite over all months that have contributed. ``like`` is a frame with the table's columns; no row of it is read."""
    spark, outcomes, parts = like.sparkSession, [], []
    for rule in suite.rules:
        if rule.kind in run.SCHEMA_KINDS:
            ok, seen = run._schema_outcome(like, rule)
            outcomes.append(run._outcome(rule, "NULL", "0" if ok else "1", run._literal(seen), run._literal(ok)))
        elif not _present(like, rule):
            outcomes.append(run._outcome(rule, "NULL", "1", "NULL", "false"))
    if outcomes:
        parts.append(run._unstacked(spark.range(0, 1, 1, 1), outcomes))

    single = _numbered(like, suite, (*SINGLE, "max_between"))
    if single:
        sums, lines = [], []
        for i, rule in single:
            own = F.col("number") == i
            sums += [F.coalesce(F.sum(F.when(own, F.col(c))), F.lit(0)).alias(f"{c}{i}") for c in ("total", "failing")]
            sums.append(F.max(F.when(own, F.col("greatest"))).alias(f"greatest{i}"))
            if rule.kind == "max_between":
                lines.append(run._range_outcome(rule, f"total{i}", f"greatest{i}"))
                continue
            share = f"try_divide(total{i} - failing{i}, total{i})"
            success = f"failing{i} = 0" if rule.mostly >= 1 else f"{share} >= {run._literal(rule.mostly)}"
            lines.append(run._outcome(rule, f"total{i}", f"failing{i}", share, success))
        parts.append(run._unstacked(states.counters.agg(*sums), lines))

    of_values: dict[str, list[Rule]] = {}
    for _, rule in _numbered(like, suite, (*run.DISTINCT_KINDS, "within_stdevs")):
        of_values.setdefault(rule.column.lower(), []).append(rule)
    for name, rules in of_values.items():
        parts.append(_from_values(states.values.where(F.col("column") == name), rules))

    for i, rule in _numbered(like, suite, ("recent",)):
        unit = rule.params["unit"].rstrip("s").upper()
        oldest = clock.instant(as_of, T.TimestampType()) - F.expr(f"INTERVAL {int(rule.params['interval'])} {unit}")
        # Without keys the table is one group, even where it has no row.
        keys = ["key"] if rule.params.get("keys") else []
        groups = states.latest.where(F.col("number") == i).groupBy(*keys).agg(F.max("latest").alias("latest"))
        row = groups.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(F.col("latest") >= oldest, F.lit(False))).alias("stale"))
        parts.append(run._unstacked(row, [run._outcome(rule, "n", "stale", "try_divide(n - stale, n)", "stale = 0")]))

    graded = run.severity(F.col("failing"), suite)
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumns({"suite": F.lit(suite.name), "severity": graded}).select(*run.RESULT_COLUMNS)


def _from_values(found: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rules on the values of one column: months are added up per value, then values once more."""
    value = found.groupBy("text").agg(F.first("number").alias("number"), F.sum("n").alias("n"))
    sigmas = [r for r in rules if r.kind == "within_stdevs"]
    sums = [F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("different"), F.count_if(F.col("n") > 1).alias("repeated")]
    if sigmas:
        mean = value.agg((F.sum(F.col("number") * F.col("n")) / F.sum("n")).alias("mean")).scalar()
        square = F.sum(F.pow(F.col("number") - mean, F.lit(2)) * F.col("n"))
        deviation = value.agg(F.sqrt(F.try_divide(square, F.sum("n") - 1)).alias("deviation")).scalar()
        away = F.abs(F.col("number") - mean) / F.nullif(deviation, F.lit(0.0))
        sums += [F.coalesce(F.sum(F.when(away > r.params["sigmas"], F.col("n"))), F.lit(0)).alias(f"away{k}") for k, r in enumerate(sigmas)]
    share, lines = "try_divide(different, n)", []
    for rule in rules:
        if rule.kind == "unique":
            lines.append(run._outcome(rule, "n", "repeated", share, "repeated = 0"))
        elif rule.kind == "unique_share":
            lines.append(run._range_outcome(rule, "n", share))
        else:
            away = f"away{sigmas.index(rule)}"
            inside = f"try_divide(n - {away}, n)"
            lines.append(run._outcome(rule, "n", away, inside, f"{away} = 0" if rule.mostly >= 1 else f"{inside} >= {run._literal(rule.mostly)}"))
    return run._unstacked(value.agg(*sums), lines)


def update(
    spark: SparkSession, df: DataFrame, suite: Suite, path: str, as_of: clock.Moment | None = None, again: Sequence[str] = ()
) -> DataFrame:
    """Read the months of a table that have not contributed yet (and those named in ``again``), keep them, and give the results over all months."""
    months = [row[PART] for row in df.select(PART).distinct().collect()]
    new = sorted({*missing_months(spark, path, months), *(set(again) & set(months))})
    if new:
        keep(df.where(F.col(PART).isin(new)), suite, path)
    gone = sorted(set(storage.partition_values(spark, f"{path}/counters", PART)) - set(months))
    forget(spark, path, gone)
    return merged(read(spark, path), df, suite, as_of)
