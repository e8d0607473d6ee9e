"""File-system calls (list, exists, delete) through Hadoop, so any Spark path works."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove one table partition or folder."""
    fs, hadoop_path = _fs(spark, path)
    return fs.delete(hadoop_path, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none where it isn't there."""
    fs, hadoop_path = _fs(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []


def age_seconds(spark: SparkSession, path: str) -> float:
    """Time since a file or folder was changed."""
    fs, hadoop_path = _fs(spark, path)
    return time.time() - fs.getFileStatus(hadoop_path).getModificationTime() / 1000


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder."""
    fs, hadoop_path = _fs(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    """The contents of a small file."""
    fs, hadoop_path = _fs(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Publish a small file under a name that is free; False where the name is taken.

    The contents are complete under a hidden name before a rename, which does not replace, makes them visible.
    """
    fs, hadoop_path = _fs(spark, path)
    if fs.exists(hadoop_path):
        return False
    hidden = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    _, hidden_path = _fs(spark, hidden)
    stream = fs.create(hidden_path, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(hidden_path.toUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    never[0] = hadoop.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(hidden_path), fs.makeQualified(hadoop_path), never)
    except Py4JJavaError as error:
        fs.delete(hidden_path, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the ``column=value`` folders directly below a path. One entry per partition."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    prefix = f"{column}="
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path) if status.isDirectory()]
    return sorted(name[len(prefix):] for name in names if name.startswith(prefix))
