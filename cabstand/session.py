"""Session defaults, lineage cuts and scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(app: str = "cabstand", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    On a cluster this is ``spark.checkpoint.dir``, or the checkpoint folder of the context. Only on one machine
    (a local master) a temporary folder is made where neither is set, and remembered for the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        named = context.getCheckpointDir()
        if not named and not context.master.split("[")[0] == "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        if not named:
            named = tempfile.mkdtemp(prefix="cabstand-")
            context.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_dir`; nothing exists there yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so a lost executor never forces the whole history to run again."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
