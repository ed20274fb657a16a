"""Spark session settings and the shared work folder."""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a method above 8000 bytes; wide loan rows reach that, and run far
    # faster as several smaller methods than as one interpreted one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """Session for tests and benches; a cluster brings its own."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("credence")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]):
    """Session settings for the jobs run inside."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, else one in the warehouse.

    Both are reachable from every executor, whatever the master.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else (
        f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work")
