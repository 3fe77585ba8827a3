"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the one that the cluster names in spark.checkpoint.dir. Where that is unset, a local session gets
    one under /tmp, and a cluster an error: its machines wouldn't see each other's folders."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file:///tmp/loomgraph-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written once and read back, for plans that use it several times; survives lost executors. What is written
    in a ``folder`` of ``scratch`` goes with it; what is returned lazily to a caller has to stay."""
    spark = df.sparkSession
    path = f"{folder}/{uuid.uuid4().hex}" if folder else scratch_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run in here drop their shuffle files when they end, instead of when the driver's memory is cleaned. For
    tables that are written and read back: their plans don't run twice."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediate tables of a run, which is emptied after it."""
    folder = scratch_dir(spark)
    try:
        yield folder
    finally:
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a local folder. Other stores have expiry rules, or ``hdfs dfs -rm``: a session has no public call for it."""
    import shutil

    if folder.startswith("file:"):
        shutil.rmtree(Path(folder.removeprefix("file:").replace("//", "/", 1)), ignore_errors=True)
