"""Evaluate a suite.

How often the data is read: all row rules of a suite are counters of ONE aggregation. Rules about
distinct values need a shuffle by that value, so each such column is one narrow extra scan (a single
column, pre-aggregated on the map side) rather than a multi-distinct plan that would copy every row
once per column; a share with an ``approximate`` error (0.01, say) joins the one pass instead. Deviation rules add one narrow pass for mean and deviation. Schema rules read nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cabstand.functions import clock
from cabstand.operators.columns import by_name
from cabstand.quality.rules import Rule, Suite

RESULT_COLUMNS = ("suite", "rule_id", "kind", "target", "total", "failing", "observed", "success", "severity")

SCHEMA_KINDS = ("columns_ordered", "columns_set", "column_count", "column_exists", "column_type", "type_list")
ROW_KINDS = ("not_null", "in_set", "between", "pair_greater", "within_stdevs")
DISTINCT_KINDS = ("unique", "unique_share")

# Names a Spark type goes by in type lists.
TYPE_NAMES = {
    "byte": {"ByteType", "int8", "TINYINT", "tinyint", "BYTEINT"},
    "short": {"ShortType", "int16", "SMALLINT", "smallint"},
    "integer": {"IntegerType", "int32", "int", "integer", "INT", "INTEGER"},
    "long": {"LongType", "int64", "bigint", "BIGINT"},
    "float": {"FloatType", "float32", "float", "FLOAT"},
    "double": {"DoubleType", "float64", "double", "DOUBLE"},
    "decimal": {"DecimalType", "decimal", "DECIMAL"},
    "string": {"StringType", "string", "STRING", "VARCHAR"},
    "boolean": {"BooleanType", "bool", "boolean", "BOOLEAN"},
    "date": {"DateType", "date", "DATE"},
    "timestamp": {"TimestampType", "timestamp", "TIMESTAMP"},
    "timestamp_ntz": {"TimestampNTZType", "timestamp_ntz", "TIMESTAMP_NTZ"},
}

# Spark types within each logical family.
TYPE_FAMILIES = {
    "integer": {"byte", "short", "integer", "long"},
    "float": {"float", "double"},
    "timestamp": {"timestamp", "timestamp_ntz"},
    "string": {"string"},
    "date": {"date"},
    "boolean": {"boolean"},
}


class ValidationFailed(Exception):
    """The suite's share of passed rules is below the threshold."""


def _type_name(kind: T.DataType) -> str:
    return "decimal" if isinstance(kind, T.DecimalType) else kind.typeName()


def _resolve(df: DataFrame, name: str) -> str:
    present = by_name(df)
    if name.lower() not in present:
        raise ValueError(f"no column {name!r}")
    return present[name.lower()]


def _holds(value: Column, params, strict: bool) -> Column:
    checks = []
    if params.get("low") is not None:
        checks.append(value > params["low"] if strict else value >= params["low"])
    if params.get("high") is not None:
        checks.append(value < params["high"] if strict else value <= params["high"])
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def _schema_outcome(df: DataFrame, rule: Rule) -> tuple[bool, float | None]:
    names = df.columns
    lowered = by_name(df)
    params = rule.params
    if rule.kind == "columns_ordered":
        return names == list(params["columns"]), float(len(names))
    if rule.kind == "columns_set":
        return set(lowered) == {c.lower() for c in params["columns"]}, float(len(names))
    if rule.kind == "column_count":
        return len(names) == int(params["count"]), float(len(names))
    if rule.column.lower() not in lowered:
        return False, None
    if rule.kind == "column_exists":
        return True, None
    kind = _type_name(clock.field_type(df, rule.column))
    if rule.kind == "column_type":
        return kind in TYPE_FAMILIES.get(params["type"], {params["type"]}), None
    return bool(TYPE_NAMES.get(kind, {kind}) & set(params["types"])), None


def _row_test(df: DataFrame, rule: Rule, moments: Callable[[str], Column]) -> tuple[Column, Column]:
    """(row counts towards the rule, row fails it); neither is ever NULL."""
    params = rule.params
    if rule.kind == "not_null":
        value = F.col(_resolve(df, rule.column))
        return F.lit(True), value.isNull()
    if rule.kind == "pair_greater":
        a, b = F.col(_resolve(df, params["a"])), F.col(_resolve(df, params["b"]))
        counted = a.isNotNull() & b.isNotNull()
        return counted, counted & ~(a >= b if params.get("or_equal") else a > b)
    value = F.col(_resolve(df, rule.column))
    counted = value.isNotNull()
    if rule.kind == "in_set":
        passes = value.isin(list(params["values"]))
    elif rule.kind == "between":
        passes = _holds(value, params, bool(params.get("strict")))
    else:
        stats = moments(rule.column)
        sigmas = F.abs(value - stats["mean"]) / F.nullif(stats["deviation"], F.lit(0.0))
        passes = sigmas <= params["sigmas"]
    return counted, counted & ~F.coalesce(passes, F.lit(True))


def _moments(df: DataFrame, rules: list[Rule]) -> Callable[[str], Column]:
    """Mean and deviation of every column a deviation rule names: one pass, one scalar subquery."""
    names = sorted({_resolve(df, r.column) for r in rules if r.kind == "within_stdevs"})
    if not names:
        return lambda name: None
    stats = df.agg(
        F.struct(
            *[F.struct(F.avg(n).alias("mean"), F.stddev_samp(n).alias("deviation")).alias(f"s{i}") for i, n in enumerate(names)]
        ).alias("stats")
    ).scalar()
    return lambda name: stats[f"s{names.index(_resolve(df, name))}"]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _inside(value: str, params) -> str:
    strict = bool(params.get("strict"))
    checks = []
    if params.get("low") is not None:
        checks.append(f"{value} {'>' if strict else '>='} {_literal(params['low'])}")
    if params.get("high") is not None:
        checks.append(f"{value} {'<' if strict else '<='} {_literal(params['high'])}")
    return " AND ".join(checks) or "true"


def _outcome(rule: Rule, total: str, failing: str, observed: str, success: str) -> str:
    """One result row as SQL over the counters; a suite has dozens, and text is far quicker to hand
    to Spark than as many column objects."""
    return (
        f"named_struct('rule_id', {_literal(rule.rule_id)}, 'kind', {_literal(rule.kind)}, "
        f"'target', CAST({_literal(rule.column)} AS STRING), 'total', CAST({total} AS BIGINT), "
        f"'failing', CAST({failing} AS BIGINT), 'observed', CAST({observed} AS DOUBLE), "
        f"'success', coalesce({success}, true))"
    )


def _range_outcome(rule: Rule, total: str, value: str) -> str:
    """Outcome of a rule that is one number in a range; it fails at most once."""
    inside = _inside(value, rule.params)
    return _outcome(rule, total, f"CASE WHEN coalesce({inside}, true) THEN 0 ELSE 1 END", value, inside)


def _unstacked(one_row: DataFrame, outcomes: list[str]) -> DataFrame:
    return one_row.selectExpr(f"inline(array({', '.join(outcomes)}))")


def _one_pass(df: DataFrame, rules: list[Rule]) -> DataFrame:
    moments = _moments(df, rules)
    counters: list[Column] = [F.count("*").alias("n")]
    outcomes = []
    for i, rule in enumerate(rules):
        if rule.kind == "max_between":
            counters.append(F.max(_resolve(df, rule.column)).alias(f"v{i}"))
            outcomes.append(_range_outcome(rule, "n", f"v{i}"))
            continue
        if rule.kind == "unique_share":
            name = _resolve(df, rule.column)
            counters.append(F.approx_count_distinct(name, rule.params["approximate"]).alias(f"d{i}"))
            counters.append(F.count(name).alias(f"c{i}"))
            outcomes.append(_range_outcome(rule, f"c{i}", f"try_divide(d{i}, c{i})"))
            continue
        counted, fails = _row_test(df, rule, moments)
        counters.append(F.count_if(fails).alias(f"f{i}"))
        total = "n"
        if rule.kind != "not_null":
            counters.append(F.count_if(counted).alias(f"c{i}"))
            total = f"c{i}"
        share = f"try_divide({total} - f{i}, {total})"
        success = f"f{i} = 0" if rule.mostly >= 1 else f"{share} >= {_literal(rule.mostly)}"
        outcomes.append(_outcome(rule, total, f"f{i}", share, success))
    return _unstacked(df.agg(*counters), outcomes)


def _distinct_pass(df: DataFrame, column: str, rules: list[Rule]) -> DataFrame:
    name = _resolve(df, column)
    values = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("copies"))
    row = values.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n"),
        F.count("*").alias("different"),
        F.count_if(F.col("copies") > 1).alias("repeated"),
    )
    share = "try_divide(different, n)"
    return _unstacked(
        row,
        [
            _outcome(rule, "n", "repeated", share, "repeated = 0")
            if rule.kind == "unique"
            else _range_outcome(rule, "n", share)
            for rule in rules
        ],
    )


def group_recency(df: DataFrame, rule: Rule, as_of: clock.Moment | None) -> DataFrame:
    """Latest time per group (or of the whole table without keys) and whether it is recent."""
    column = _resolve(df, rule.column)
    kind = clock.field_type(df, column)
    unit = rule.params["unit"].rstrip("s").upper()
    oldest = clock.instant(as_of, kind) - F.expr(f"INTERVAL {int(rule.params['interval'])} {unit}")
    latest = df.groupBy(*rule.params.get("keys", [])).agg(F.max(column).alias("latest"))
    return latest.withColumn("recent", F.coalesce(F.col("latest") >= oldest, F.lit(False)))


def _recency_pass(df: DataFrame, rule: Rule, as_of: clock.Moment | None) -> DataFrame:
    row = group_recency(df, rule, as_of).agg(
        F.count("*").alias("n"), F.count_if(~F.col("recent")).alias("stale")
    )
    return _unstacked(row, [_outcome(rule, "n", "stale", "try_divide(n - stale, n)", "stale = 0")])


def severity(failing: Column, suite: Suite) -> Column:
    """Grade of a number of failing rows: pass, warn or error."""
    return F.when(failing > suite.error_above, "error").when(failing > suite.warn_above, "warn").otherwise("pass")


def evaluate(df: DataFrame, suite: Suite, as_of: clock.Moment | None = None) -> DataFrame:
    """One row per rule: what was looked at, what failed, success and severity.

    ``success`` is the rule's own verdict (with ``mostly``); ``severity`` grades the number of
    failures by the suite's limits. A rule on a column the frame lacks fails.
    """
    present = by_name(df)

    def absent(rule: Rule) -> bool:
        named = [rule.column] if rule.column else []
        named += [rule.params[k] for k in ("a", "b") if k in rule.params]
        return any(name.lower() not in present for name in named)

    data_rules = [r for r in suite.rules if r.kind not in SCHEMA_KINDS]
    fixed = [
        _outcome(r, "NULL", "0" if ok else "1", _literal(seen), _literal(ok))
        for r in suite.rules
        if r.kind in SCHEMA_KINDS
        for ok, seen in [_schema_outcome(df, r)]
    ]
    fixed += [_outcome(r, "NULL", "1", "NULL", "false") for r in data_rules if absent(r)]
    data_rules = [r for r in data_rules if not absent(r)]

    parts = []
    if fixed:
        parts.append(_unstacked(df.sparkSession.range(0, 1, 1, 1), fixed))
    estimated = [r for r in data_rules if r.kind == "unique_share" and r.params.get("approximate")]
    single = [r for r in data_rules if r.kind in ROW_KINDS or r.kind == "max_between"] + estimated
    if single:
        parts.append(_one_pass(df, single))
    distinct: dict[str, list[Rule]] = {}
    for rule in data_rules:
        if rule.kind in DISTINCT_KINDS and rule not in estimated:
            distinct.setdefault(rule.column.lower(), []).append(rule)
    parts += [_distinct_pass(df, rules[0].column, rules) for rules in distinct.values()]
    parts += [_recency_pass(df, r, as_of) for r in data_rules if r.kind == "recent"]
    known = {*SCHEMA_KINDS, *ROW_KINDS, *DISTINCT_KINDS, "max_between", "recent"}
    unknown = [r.kind for r in suite.rules if r.kind not in known]
    if unknown:
        raise ValueError(f"unknown rule kinds {unknown}")
    outcomes = reduce(DataFrame.unionByName, parts)
    graded = severity(F.col("failing"), suite)
    return outcomes.withColumns({"suite": F.lit(suite.name), "severity": graded}).select(*RESULT_COLUMNS)


def failing_rows(df: DataFrame, suite: Suite, as_of: clock.Moment | None = None) -> DataFrame:
    """What to keep of the failures: ``(suite, rule_id, record)`` with the record as JSON.

    A row appears once per row rule it fails; for rules about distinct values the record is the
    repeated value with its number of copies, for recency the stale group.
    """
    rules = [r for r in suite.rules if r.kind in ROW_KINDS]
    parts = []
    if rules:
        moments = _moments(df, rules)
        failed = F.array_compact(F.array(*[F.when(_row_test(df, r, moments)[1], F.lit(r.rule_id)) for r in rules]))
        marked = df.select(failed.alias("_failed"), F.struct(*df.columns).alias("_row"))
        marked = marked.where(F.size("_failed") > 0)
        parts.append(marked.select(F.explode("_failed").alias("rule_id"), F.to_json("_row").alias("record")))
    for rule in suite.rules:
        if rule.kind == "unique":
            name = _resolve(df, rule.column)
            repeated = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("copies")).where("copies > 1")
            parts.append(repeated.select(F.lit(rule.rule_id).alias("rule_id"), F.to_json(F.struct("*")).alias("record")))
        elif rule.kind == "recent":
            stale = group_recency(df, rule, as_of).where(~F.col("recent"))
            parts.append(stale.select(F.lit(rule.rule_id).alias("rule_id"), F.to_json(F.struct("*")).alias("record")))
    if not parts:
        return df.sparkSession.range(0).select(
            F.lit(suite.name).alias("suite"), F.lit("").alias("rule_id"), F.lit("").alias("record")
        )
    return reduce(DataFrame.unionByName, parts).select(F.lit(suite.name).alias("suite"), "rule_id", "record")


def save_failures(failures: DataFrame, path: str, run_id: str) -> None:
    """Keep failing records by run and rule. A rerun of the run replaces them; a rule with most of
    the failures is split over several files by the rebalance."""
    (
        failures.withColumn("run_id", F.lit(run_id))
        .hint("rebalance", F.col("rule_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "rule_id")
        .parquet(path)
    )


def run_id(category: str, as_of: clock.Moment | None = None) -> str:
    """Run name: time and category."""
    return f"{clock.as_datetime(as_of):%Y%m%d-%H%M%S}-{category}"


def save_results(results: DataFrame, path: str, run: str) -> DataFrame:
    """Keep the results of a run and return them as read back, so nothing is evaluated twice."""
    (
        results.withColumn("run_id", F.lit(run))
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )
    stored = results.sparkSession.read.parquet(path)
    return stored.where(F.col("run_id").cast("string") == run).select(F.lit(run).alias("run_id"), *RESULT_COLUMNS)


def verdict(results: DataFrame) -> DataFrame:
    """Rules evaluated and passed, and the percentage passed, as one row."""
    return results.agg(
        F.count("*").alias("rules"),
        F.count_if("success").alias("passed"),
        (F.avg(F.col("success").cast("int")) * 100).alias("success_percent"),
    )


def parse_percent(threshold: str | float) -> float:
    """``"10%"`` or ``10`` as 10.0: the unit of ``success_percent``."""
    return float(str(threshold).strip().removesuffix("%"))


def gate(results: DataFrame, threshold: str | float) -> float:
    """The percentage passed; raises when it is below the threshold (both in percent)."""
    percent = verdict(results).first()["success_percent"]
    if percent is not None and percent < parse_percent(threshold):
        raise ValidationFailed(f"{percent:.2f}% of the rules passed, {parse_percent(threshold):g}% are required")
    return percent
