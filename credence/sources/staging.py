"""Tables written once per application into the shared work folder and read back by later jobs.

Multi-pass work reads such a table instead of repeating joins and parsing, and survives lost
executors because nothing but files holds it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from credence.session import settings, work_folder


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) handles for a location, whatever store it lives in."""
    handle = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), handle


def path_exists(spark: SparkSession, path: str) -> bool:
    files, handle = hadoop_path(spark, path)
    return files.exists(handle)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders a path or glob names, in order."""
    files, handle = hadoop_path(spark, pattern)
    return sorted(str(status.getPath()) for status in files.globStatus(handle) or [])


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none where it does not exist."""
    files, handle = hadoop_path(spark, path)
    if not files.exists(handle):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(handle) if s.isDirectory())


def drop_folder(spark: SparkSession, path: str) -> None:
    files, handle = hadoop_path(spark, path)
    files.delete(handle, True)


def drop_files(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        files, handle = hadoop_path(spark, path)
        files.delete(handle, False)

#: Bytes of input for each shuffle partition of a staged table's job; adaptive execution joins
#: small ones again.
TASK_BYTES = 8 << 20
STAGING = {
    # A task sorts its wide rows by partition before it writes them; so many do not spill.
    "spark.sql.files.maxPartitionBytes": "32m",
    # HotSpot never compiles a method above 8000 bytes, which wide loan rows reach.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
#: Shuffle files go when their job ends, not when the driver happens to collect its garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


class WorkTables:
    """Tables in a folder of their own that goes when the block ends; nothing lazy may outlive it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{work_folder(spark)}/credence-work/{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def parts(self, name: str, most: int) -> list[list[str]]:
        """The files of a table in groups of ``most`` bytes, or of one larger file."""
        files, handle = hadoop_path(self.spark, f"{self.folder}/{name}")
        groups, room = [], 0
        for status in files.listStatus(handle):
            if status.getPath().getName().startswith(("_", ".")):
                continue
            if not groups or status.getLen() > room:
                groups.append([])
                room = most
            groups[-1].append(str(status.getPath()))
            room -= status.getLen()
        return groups

    def __enter__(self) -> WorkTables:
        return self

    def __exit__(self, *_):
        drop_folder(self.spark, self.folder)


def input_fingerprint(spark: SparkSession, *paths: str) -> str:
    """Changes when an input is replaced or grows."""
    marks = []
    for path in paths:
        files, handle = hadoop_path(spark, path)
        summary = files.getContentSummary(handle)
        marks.append(f"{path}:{summary.getLength()}:{summary.getFileCount()}:"
                     f"{files.getFileStatus(handle).getModificationTime()}")
    return hashlib.sha256("\n".join(marks).encode()).hexdigest()[:16]


def input_size(spark: SparkSession, *paths: str) -> int:
    """Bytes of the inputs."""
    sizes = 0
    for path in paths:
        files, handle = hadoop_path(spark, path)
        sizes += files.getContentSummary(handle).getLength()
    return sizes


def stage_path(spark: SparkSession, name: str, fingerprint: str) -> str:
    application = spark.sparkContext.applicationId
    return f"{work_folder(spark)}/credence/{application}/{fingerprint}/{name}"


def staging_settings(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Settings of a staged table's job that shuffles so many bytes of input."""
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                     -(-input_bytes // TASK_BYTES))
    return {**STAGING, "spark.sql.shuffle.partitions": str(partitions)}


def write_parts(spark: SparkSession, parts: Iterable[DataFrame], path: str,
                write: Callable[[DataFrame], DataFrameWriter], save: str) -> None:
    """Writes tables one after the other into one folder, in the format ``save`` names.

    Each is a job of its own whose shuffle files go with it, so disk holds one part's at a time. The
    folder is marked as whole after the last part, and goes if one fails.
    """
    drop_folder(spark, path)
    try:
        with settings(spark, TIDY):
            for part in parts:
                write(part).mode("append").format(save).option(
                    "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").save(path)
    except BaseException:
        drop_folder(spark, path)
        raise
    files, handle = hadoop_path(spark, f"{path}/_SUCCESS")
    files.create(handle).close()


def staged(spark: SparkSession, name: str, fingerprint: str, build: Callable[[], DataFrame],
           partition_by: tuple[str, ...] = (), input_bytes: int = 0) -> DataFrame:
    """The table ``build`` describes, written on first use and scanned afterwards.

    Shuffles have at least a partition for each ``TASK_BYTES`` of input, so that a task's share does
    not grow with it.
    """
    path = stage_path(spark, name, fingerprint)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        with settings(spark, staging_settings(spark, input_bytes)):
            build().write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.parquet(path)


class StagedTables:
    """Tables staged under names of their own, for lazy results that outlive the call."""

    def __init__(self, spark: SparkSession, prefix: str, fingerprint: str, input_bytes: int = 0):
        self.spark, self.prefix = spark, prefix
        self.fingerprint, self.input_bytes = fingerprint, input_bytes

    def table(self, df: DataFrame, name: str) -> DataFrame:
        return staged(self.spark, f"{self.prefix}_{name}", self.fingerprint, lambda: df,
                      input_bytes=self.input_bytes)
