"""Sinks: replace a Parquet dataset and read it back, or cut lineage via a written table.

A dataset that is replaced (``replace_table``) is a folder of versions and a
pointer, a small file that names the current one.  A new version is written
beside the old one and becomes current when the pointer is exchanged, in one
rename, so readers see the old rows or the new rows and a job that fails
leaves the old ones.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from runway.session import delete_path, shared_path

POINTER = "_current"     # names the current version; Spark's readers skip names with an underscore


def write_replace(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                  max_records_per_file: int | None = None, bucket_by: tuple[str, int, str] | None = None) -> None:
    """Write ``df`` as the dataset at ``path`` (overwrite, optionally partitioned).

    Rows are rebalanced by the partition columns first, so a partition is written by
    few tasks and a large one by several.  Spark's overwrite removes the old
    dataset before it writes, so this is for fresh folders; results that are
    replaced go through ``replace_table``.  ``bucket_by`` names a column, a number of buckets
    and the catalog table that describes them.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        by, buckets, table = bucket_by
        writer.bucketBy(buckets, by).option("path", path).format("parquet").saveAsTable(table)
    else:
        writer.parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop's objects."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version of a replaced dataset; None where there is no pointer."""
    fs, pointer = _hadoop(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path.rstrip('/')}/{name.strip()}"


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the current one: the pointer is written aside and renamed over the old one."""
    jvm, base = spark._jvm, path.rstrip("/")
    fs, aside = _hadoop(spark, f"{base}/{POINTER}-{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(version.encode("utf-8")))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    qualified = fs.makeQualified(aside)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(qualified, fs.makeQualified(_hadoop(spark, f"{base}/{POINTER}")[1]), options)


def replace_table(spark: SparkSession, df: DataFrame, path: str, partition_by: tuple[str, ...] = (), keep_old: bool = False) -> str:
    """Replace the dataset at ``path`` with ``df``; the folder of the new version.

    The old version stays readable until the new one is written whole and the pointer
    names it; if the write fails, what it left is removed and the old version stays
    current.  So ``df`` may read the version it replaces.  The old version is
    then removed, unless ``keep_old`` (for readers that still use it).  Of two jobs that
    replace at once the last one to finish is current.  Read with ``read_current``.
    """
    name = f"version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    version = f"{path.rstrip('/')}/{name}"
    old = current_version(spark, path)
    try:
        write_replace(df, version, partition_by)
        _point_to(spark, path, name)
    except BaseException:
        delete_path(spark, version)
        raise
    if old and not keep_old:
        delete_path(spark, old)
    return version


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a replaced dataset, or a plain Parquet dataset."""
    return spark.read.parquet(current_version(spark, path) or path)


def replace_and_reload(spark: SparkSession, df: DataFrame, path: str,
                       partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Replace the dataset at ``path`` and return a fresh scan of what was written."""
    return spark.read.parquet(replace_table(spark, df, path, partition_by))


def materialise(spark: SparkSession, df: DataFrame, name: str,
                partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back.

    Cuts lineage durably: losing an executor later never recomputes the plan
    behind ``df``.
    """
    path = shared_path(spark, name)
    write_replace(df, path, partition_by)
    return spark.read.parquet(path)


def materialise_buckets(spark: SparkSession, df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """``materialise`` with the rows in ``buckets`` by the hash of a column, so that a join on it need not shuffle them.

    A task writes a file for each bucket that its rows belong to, all at the same
    time instead of sorted, so ``by`` should take few values in a task.  The table's name is
    dropped at once; its files are those of the returned scan.
    """
    path = shared_path(spark, name)
    table = f"`{path.rpartition('/')[2].replace('-', '_')}`"
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(buckets))
    try:
        write_replace(df, path, bucket_by=(by, buckets, table))
    finally:
        spark.conf.set(key, before)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows
