"""File manifests, footer schemas, schema groups and the drift-safe load."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cabstand.functions import paths
from cabstand.operators.columns import conform
from cabstand.operators.joins import concat, existing, missing

FOOTER_SCHEMA = "link string, pos int, column string, type string"


def read_parquet(spark: SparkSession, files: Sequence[str], base: str | None = None) -> DataFrame:
    """Files of one schema as one frame. Folder names below ``base`` become columns."""
    if isinstance(files, str) or not files:
        raise ValueError("give a non-empty list of paths")
    reader = spark.read.option("basePath", base) if base else spark.read
    return reader.parquet(*files)


def manifest(spark: SparkSession, folder: str, pattern: str = "*.parquet", prefix: str = "") -> DataFrame:
    """One row per file below a folder: path, length, modification time and parts of the path.

    Only the listing is read; the file contents column is pruned.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length", "modificationTime")
    )
    files = listing.withColumns(paths.path_parts(F.col("path")))
    return files.where(F.col("filename").startswith(prefix)) if prefix else files


def require_files(files: DataFrame) -> DataFrame:
    """The manifest itself, or an error when it lists nothing."""
    if files.isEmpty():
        raise ValueError("no files found")
    return files


def select_files(
    files: DataFrame,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    ledger: DataFrame | None = None,
    fail_if_present: bool = False,
) -> DataFrame:
    """Files to ingest: named by an included prefix, by no excluded one, and not in the ledger.

    ``ledger`` has a ``path`` column. With ``fail_if_present`` a file already in it is an error.
    """
    name = F.col("filename")
    if include:
        files = files.where(_any_prefix(name, include))
    if exclude:
        files = files.where(~_any_prefix(name, exclude))
    if ledger is None:
        return files
    if fail_if_present and not existing(files, ledger, {"path": "path"}).isEmpty():
        raise FileExistsError("some of the files were ingested before")
    return missing(files, ledger, {"path": "path"})


def _any_prefix(name, prefixes: Sequence[str]):
    found = F.lit(False)
    for prefix in prefixes:
        found = found | name.startswith(prefix)
    return found


#: Session options that a footer reader needs to open the same stores as Spark does.
_STORE_OPTIONS = (
    "fs.defaultFS", "fs.s3a.access.key", "fs.s3a.secret.key", "fs.s3a.session.token", "fs.s3a.endpoint",
    "fs.s3a.endpoint.region", "fs.s3a.connection.ssl.enabled",
)


def store_options(spark: SparkSession) -> dict[str, str]:
    """The session's Hadoop options for object stores, to be shipped to the tasks."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {name: conf.get(name) for name in _STORE_OPTIONS}
    prefix = "fs.azure.account.key."
    found |= {prefix + host: key for host, key in dict(conf.getPropsWithPrefix(prefix)).items()}
    return {name: value for name, value in found.items() if value}


def arrow_store(link: str, options: Mapping[str, str]):
    """``(file system, path)`` with which pyarrow opens a link that Spark has listed."""
    import pyarrow.fs as pafs

    if "://" not in link:
        return pafs.LocalFileSystem(), "/" + link.removeprefix("file:").lstrip("/")
    scheme, rest = link.split("://", 1)
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme in ("s3", "s3a", "s3n"):
        endpoint = options.get("fs.s3a.endpoint")
        given = {
            "access_key": options.get("fs.s3a.access.key"),
            "secret_key": options.get("fs.s3a.secret.key"),
            "session_token": options.get("fs.s3a.session.token"),
            "region": options.get("fs.s3a.endpoint.region"),
            "endpoint_override": endpoint.split("://")[-1] if endpoint else None,
            "scheme": "http" if options.get("fs.s3a.connection.ssl.enabled") == "false" else "https",
        }
        return pafs.S3FileSystem(**{k: v for k, v in given.items() if v}), rest
    if scheme in ("abfs", "abfss"):
        container, _, host = rest.partition("/")[0].partition("@")
        account = host.split(".")[0]
        key = options.get(f"fs.azure.account.key.{host}")
        return pafs.AzureFileSystem(account, account_key=key), f"{container}/{rest.partition('/')[2]}"
    if scheme == "gs":
        return pafs.GcsFileSystem(), rest
    if scheme == "hdfs":
        authority = rest.partition("/")[0] or options.get("fs.defaultFS", "").split("://")[-1].strip("/")
        return pafs.HadoopFileSystem.from_uri(f"hdfs://{authority or 'default'}"), "/" + rest.partition("/")[2]
    raise ValueError(f"footers can't be read from {scheme}:// paths: {link}")


def _footers(batches: Iterator[pa.RecordBatch], options: Mapping[str, str]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    for batch in batches:
        rows = []
        for link in batch.column("path").to_pylist():
            filesystem, name = arrow_store(link, options)
            with filesystem.open_input_file(name) as handle:
                schema = pq.read_schema(handle)
            rows += [(link, pos, column.name, str(column.type)) for pos, column in enumerate(schema)]
        links, positions, columns, types = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(links, pa.string()),
                pa.array(positions, pa.int32()),
                pa.array(columns, pa.string()),
                pa.array(types, pa.string()),
            ],
            names=["link", "pos", "column", "type"],
        )


def footer_schemas(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per file and field, from the file footers, read in parallel on the executors."""
    tasks = tasks or files.sparkSession.sparkContext.defaultParallelism
    options = store_options(files.sparkSession)
    return files.select("path").repartition(tasks, "path").mapInArrow(lambda batches: _footers(batches, options), FOOTER_SCHEMA)


def wide_schemas(footers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per file with the type of each named column (NULL where the file lacks it)."""
    return footers.groupBy("link").pivot("column", list(columns)).agg(F.first("type"))


def with_schema_id(footers: DataFrame) -> DataFrame:
    """``(link, schema_id)``: files with the same fields of the same types share an id.

    The id ignores the order of the fields, as does reading by name.
    """
    fields = F.sort_array(F.collect_list(F.struct("column", "type")))
    return footers.groupBy("link").agg(F.sha2(F.to_json(fields), 256).alias("schema_id"))


def schema_groups(assigned: DataFrame, bundle: int = 1000) -> DataFrame:
    """Lists of files that can be read together: ``(schema_id, part, links)``, links sorted.

    A list holds about ``bundle`` files; a schema shared by more files yields several lists, so no
    task ever collects all files of a common schema.
    """
    sizes = assigned.groupBy("schema_id").agg(F.ceil(F.count("*") / bundle).alias("parts"))
    split = assigned.join(sizes, "schema_id").withColumn("part", F.pmod(F.xxhash64("link"), F.col("parts")))
    lists = split.groupBy("schema_id", "part").agg(F.sort_array(F.collect_list("link")).alias("links"))
    return lists.select("schema_id", "part", "links")


def drift_groups(files: DataFrame) -> list[list[str]]:
    """The paths of a manifest, one list per schema, lists and paths in path order.

    Spark's reader takes paths as arguments, so the file names, never rows, come to the driver.
    """
    lists = schema_groups(with_schema_id(footer_schemas(require_files(files))))
    links: dict[str, list[str]] = {}
    for row in lists.toLocalIterator(prefetchPartitions=True):
        links.setdefault(row["schema_id"], []).extend(row["links"])
    return sorted(sorted(group) for group in links.values())


def read_groups(
    spark: SparkSession, groups: Sequence[Sequence[str]], types: Mapping[str, str],
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """All groups as one frame of the declared columns: one scan per schema, cast by name, united.

    ``keep`` filters each scan before the cast, where the filter still reaches the files.
    """
    scans = [read_parquet(spark, list(group)) for group in groups]
    return concat([conform(keep(scan) if keep else scan, types) for scan in scans])


def read_drifting(spark: SparkSession, files: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """All files of a manifest as one typed frame, whatever their footers say.

    Files whose types cannot be merged in one read (whole numbers in one, doubles in another) end up
    in different groups.
    """
    return read_groups(spark, drift_groups(files), types)
