"""Monthly rollup, mode by count, cumulative histograms, distinct lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cabstand.functions import clock
from cabstand.specs import DatasetSpec

def busiest(df: DataFrame, value: Column, name: str) -> DataFrame:
    """The most frequent value as one row; the lowest of several equally frequent ones."""
    counted = df.groupBy(value.alias(name)).agg(F.count("*").alias("_n"))
    return counted.orderBy(F.desc("_n"), F.asc(name)).limit(1).select(name)


def monthly_summary(df: DataFrame, spec: DatasetSpec, busiest_scope: str = "group") -> DataFrame:
    """Sums, averages, counts, durations and busiest hour per key and month.

    ``busiest_scope``: ``"group"`` finds the busiest hour of each output row; ``"global"`` finds one
    hour for the whole input and repeats it on every row.
    """
    if busiest_scope not in ("group", "global"):
        raise ValueError("busiest_scope is 'group' or 'global'")
    start, end = F.col(spec.start), F.col(spec.end)
    seconds = clock.seconds_between(start, end)
    keys = [F.col(source).alias(name) for name, source in spec.summary.keys.items()]
    keys.append(clock.month_start(start).alias("first_day_of_month"))
    names = [*spec.summary.keys, "first_day_of_month"]
    sums = {**spec.summary.sums, **{f"_sum_{name}": source for name, source in spec.summary.averages.items()}}
    counts = {f"_count_{name}": source for name, source in spec.summary.averages.items()}
    measures = [F.sum(source).alias(name) for name, source in sums.items()]
    measures += [F.count(source).alias(name) for name, source in counts.items()]
    measures += [
        F.count("*").alias("trip_count"),
        F.sum(seconds).alias("total_duration_seconds"),
        F.count(seconds).alias("_timed"),
    ]
    if busiest_scope == "group":
        table = _with_busiest_hour(df, keys, names, start, measures)
        hour = F.col("busiest_hour_of_day")
    else:
        table = df.groupBy(*keys).agg(*measures)
        hour = busiest(df, F.hour(start), "hour").scalar()
    averages = [
        F.try_divide(F.col(f"_sum_{name}"), F.col(f"_count_{name}")).alias(name) for name in spec.summary.averages
    ]
    return table.select(
        *names,
        *spec.summary.sums,
        *averages,
        "trip_count",
        F.try_divide(F.col("total_duration_seconds") / 60, F.col("_timed")).alias("avg_duration_minutes"),
        "total_duration_seconds",
        (F.col("total_duration_seconds") / 3600).alias("total_duration_hours"),
        hour.alias("busiest_hour_of_day"),
    )


def _with_busiest_hour(df: DataFrame, keys: list[Column], names: list[str], start: Column, measures: list[Column]) -> DataFrame:
    """Roll up per key and hour, then per key, keeping the hour with most rows (lowest on ties).

    The count and the hour are packed into one long, so that the maximum is a plain number: both
    steps stay hash aggregates with map-side combine, which a mode or a struct maximum would not.
    """
    hourly = df.groupBy(*keys, F.hour(start).alias("_hour")).agg(*measures)
    added = [name for name in hourly.columns if name not in (*names, "_hour")]
    packed = F.max(F.col("trip_count") * 32 + (31 - F.col("_hour"))).alias("_packed")
    rolled = hourly.groupBy(*names).agg(*[F.sum(name).alias(name) for name in added], packed)
    return rolled.withColumn("busiest_hour_of_day", (31 - F.col("_packed") % 32).cast("int"))


def mode_per_group(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Most frequent value per group, lowest on ties, for values of any number.

    Two-step aggregation: a hot group is first counted per value on the map side, so only one row
    per (group, value) and map task is shuffled.
    """
    counted = df.groupBy(*keys, value.alias(name)).agg(F.count("*").alias("_n"))
    best = F.min_by(F.struct(name, "_n"), F.struct((-F.col("_n")).alias("n"), F.col(name).alias("v")))
    return counted.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, F.col(f"_best.{name}").alias(name), F.col("_best._n").alias("rows")
    )


def histogram(df: DataFrame, keys: Sequence[str], value: Column, bounds: Sequence[float], name: str = "value") -> DataFrame:
    """Per group: sum, count, upper bounds, and rows at or below each bound.

    One aggregation pass; the rows are not multiplied by the bounds, and the arrays are ordered by
    bound.
    """
    counters = [F.count_if(value <= F.lit(b)).alias(f"_le{i}") for i, b in enumerate(bounds)]
    table = df.groupBy(*keys).agg(F.sum(value).alias(f"{name}_sum"), F.count("*").alias(f"{name}_count"), *counters)
    return table.select(
        *keys,
        f"{name}_sum",
        f"{name}_count",
        F.array(*[F.lit(b) for b in bounds]).alias(name),
        F.array(*[F.col(f"_le{i}") for i in range(len(bounds))]).alias(f"{name}_bucket"),
    )


def histogram_rows(table: DataFrame, keys: Sequence[str], name: str = "value") -> DataFrame:
    """A histogram as one row per group and bound."""
    pair = F.explode(F.arrays_zip(F.col(name).alias("le"), F.col(f"{name}_bucket").alias("bucket"))).alias("_p")
    return table.select(*keys, pair).select(*keys, F.col("_p.le").alias("le"), F.col("_p.bucket").alias("bucket"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Ordered value list of one column."""
    return df.select(column).distinct().orderBy(column)


def top_one(df: DataFrame, *order: Column) -> DataFrame:
    """First row in an order."""
    return df.orderBy(*order).limit(1)


def best_run(trials: DataFrame, metric: str = "rmse") -> DataFrame:
    """The run with the lowest error; its parent's id where it has one."""
    best = top_one(trials.where(F.col(metric).isNotNull()), F.asc(metric), F.asc("run_id"))
    return best.withColumn("chosen_run_id", F.coalesce("parent_run_id", "run_id"))


def rmse(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Root mean squared error as one row."""
    miss = F.col(actual) - F.col(predicted)
    return df.agg(F.sqrt(F.avg(miss * miss)).alias("rmse"))


