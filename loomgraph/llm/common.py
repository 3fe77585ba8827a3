"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One run of the six ASCII white-space characters; words are what lies between such runs.
SPACES = r"[\x20\x09-\x0D]+"

#: Bytes of an Arrow batch on its way to Python, of which the JVM holds several copies beyond its heap; and what Spark would take.
BATCH, SPARKS = "4m", "67108864b"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the one that the cluster names in spark.checkpoint.dir.

    Where the setting is absent, a session on one machine (tests) gets a temporary folder, and a cluster an error: its
    machines wouldn't see each other's folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="loomgraph-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session sends ``BATCH`` bytes at a time to Python from now on, however long the texts are. A session that
    names a size of its own keeps it."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, SPARKS) == SPARKS:
        conf.set(key, BATCH)
    return df


_MADE: list[list[str]] = []


def materialize(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: it cuts the lineage, and any
    executor that is lost later costs only the tasks that were running on it. What a caller still reads
    lazily has to stay; within ``scratch`` it goes at the end."""
    path = shared_dir(df.sparkSession)
    if _MADE:
        _MADE[-1].append(path)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch() -> Iterator[None]:
    """Removes, at its end, what ``materialize`` has written within it. Results have to be written by then."""
    _MADE.append([])
    try:
        yield
    finally:
        for path in _MADE.pop():
            remove(path)


def remove(path: str) -> None:
    """Deletes a folder that the driver reaches; one in a store that it doesn't know is left to the store's expiry."""
    try:
        store, where = fs.FileSystem.from_uri(path)
        store.delete_dir(where)
    except (OSError, pa.ArrowException):
        pass


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, whatever the optimizer merges."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that do not clash with the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
