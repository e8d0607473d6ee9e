"""What the jobs under a label have cost, from the figures that the session keeps about its stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

COST_SCHEMA = (
    "label string, jobs int, stages int, tasks long, run_ms long, cpu_ms long, rows_read long, bytes_read long, rows_written long, "
    "bytes_written long, bytes_shuffled long, bytes_spilled long"
)


def _all(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def costs(spark: SparkSession, *labels: str) -> DataFrame:
    """One row per label given to :func:`cabstand.sources.tables.labelled`, batch and stream alike.

    A stage that several jobs share counts once per label. The session keeps its latest stages
    (``spark.ui.retainedStages``, with or without the web page): take the figures after each load and
    keep them with :func:`save_costs`.
    """
    store = spark.sparkContext._jsc.sc().statusStore()
    stages: dict[str, set[int]] = {label: set() for label in labels}
    jobs = dict.fromkeys(labels, 0)
    for job in _all(store.jobsList(None)):
        tags = [str(tag) for tag in _all(job.jobTags().toSeq())]
        for label in labels:
            if any(tag == label or tag.endswith(f"-{label}") for tag in tags):
                jobs[label] += 1
                stages[label].update(int(stage) for stage in _all(job.stageIds()))
    rows = [(label, jobs[label], *_sums(spark, store, stages[label])) for label in labels]
    return spark.createDataFrame(rows, COST_SCHEMA)


def _sums(spark: SparkSession, store, stages: set[int]) -> tuple[int, ...]:
    none, quantiles = spark._jvm.java.util.ArrayList(), spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    ran, sums = 0, [0] * 9
    for stage in sorted(stages):
        for attempt in _all(store.stageData(stage, False, none, False, quantiles)):
            if not attempt.numCompleteTasks():
                continue
            ran += 1
            figures = (
                attempt.numCompleteTasks(), attempt.executorRunTime(), attempt.executorCpuTime() // 1_000_000, attempt.inputRecords(),
                attempt.inputBytes(), attempt.outputRecords(), attempt.outputBytes(), attempt.shuffleWriteBytes(), attempt.diskBytesSpilled(),
            )
            sums = [a + b for a, b in zip(sums, figures)]
    return ran, *sums


def save_costs(found: DataFrame, path: str, run: str) -> None:
    """Keep the figures of a run; a rerun under the same name replaces them. One row per label, so one file."""
    (
        found.withColumn("run_id", F.lit(run))
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )
