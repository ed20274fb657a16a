"""Helpers shared by the operators: work tables, inputs, column expressions."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.session import work_folder
from credence.sources.staging import hadoop_path

BLANK = r"[\x20\x09-\x0D]"
#: Lists of ids up to this length are broadcast (up to 140 bytes a row, so 140 MB); longer ones are
#: joined by shuffles.
BROADCAST_IDS = 1_000_000


def new_folder(spark) -> str:
    """A folder of its own in the shared folder the cluster names."""
    return f"{work_folder(spark)}/credence-llm/{uuid.uuid4().hex}"


def table(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts lineage at files that survive lost executors, and lets the planner know the size of what
    follows.
    """
    spark = df.sparkSession
    path = f"{folder or new_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark, rows: int = 1000):
    """Jobs run inside send at most so many rows at a time to Python: less memory for long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Workspace:
    """Tables that go when the block ends; nothing lazy may outlive them."""

    def __init__(self, spark):
        self.spark, self.folder, self.made = spark, new_folder(spark), 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        return table(df, f"{self.made}-{name}", self.folder)

    def id_list(self, ids: DataFrame, name: str, at_most: int | None = None) -> DataFrame:
        """A table of ids, marked for broadcast if its counted length allows.

        Where they are known to be so few, ``at_most``, they are broadcast without a table.
        """
        if at_most is not None and at_most <= BROADCAST_IDS:
            return F.broadcast(ids)
        ids = self.table(ids, name)
        return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_):
        files, path = hadoop_path(self.spark, self.folder)
        files.delete(path, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the runs of characters other than ASCII blanks."""
    return F.filter(F.split(text, BLANK + "+"), lambda w: w != "")


def key_of(column: str) -> Column:
    """A join key in which null is a value like any other."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("null"))


def row_of(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct, safe from names the operator uses itself."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(df: DataFrame, columns: list[str], packed: str = "row") -> DataFrame:
    return df.select(*[F.col(f"{packed}.`{c}`").alias(c) for c in columns])
