"""The versioned store: append-only Parquet tables under one folder.

Nothing is ever updated in place. A run writes its outcomes, quads, lineage, validation report and record first, then the
pointer, and its line in the commit log last. A crash before the pointer leaves history that no pointer names and never half a
graph; one before the log leaves a run that is done anew under a later number. Snapshots of the pointer, of committed runs
only, keep its reading short: a reader takes the last one whose line is in the snapshot log, and the pointers of later runs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state

TABLES = {
    "quads_history": "graph_key string, s string, p string, o_kind string, o_value string, o_datatype string, run_id string, map_id string",
    "lineage": "graph_key string, quad_hash string, var string, is_constant boolean, constraint_id string, source_version string, pair_hash string, run_id string",
    "outcomes": "resource_key string, version string, map_id string, outcome string, reasons array<string>, graph_key string, run_id string, effective string, issued string, last_updated string",
    "validation": "graph_key string, s string, violation string, run_id string",
    "run_record": "run_id string, run_seq long, resource_key string, source_version string, source_digest string, map_id string, pair_hash string, ontology string, terminology string, engine string, policy string, activity_time timestamp, graph_key string, validation_digest string, output_digest string, evidence string, snapshots string",
    "current_pointer": "resource_key string, seq long, graph_key string, run_id string, outcome string, run_seq long",
    "commit_log": "run_id string, run_seq long, committed timestamp",
    "pointer_snapshot": "resource_key string, seq long, run_seq long, graph_key string, run_id string, outcome string, upto long",
    "snapshot_log": "upto long",
}
BY = {"quads_history": ("map_id",), "current_pointer": ("run_seq",), "pointer_snapshot": ("upto",)}
POINTER = ("resource_key", "seq", "run_seq", "graph_key", "run_id", "outcome")
#: Quads that follow from a record's graph are in a graph of their own, named after it.
INFERRED = "#inferred"


class GraphStore:
    """The tables of ``TABLES``; those that aren't there are made empty."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        for name, schema in TABLES.items():
            try:
                self.table(name)
            except AnalysisException:
                spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*BY.get(name, ())).parquet(f"{self.folder}/{name}")

    def append(self, name: str, df: DataFrame) -> None:
        """Adds rows of exactly the table's columns."""
        fields = self.table(name).schema.fields
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]).write.mode("append").partitionBy(*BY.get(name, ())).parquet(f"{self.folder}/{name}")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}")

    def append_graph(self, quads: DataFrame, run_id: str, map_id: str) -> None:
        """A graph is a set: repeated quads are written once."""
        keys = ["graph_key", "s", "p", "o_kind", "o_value", "o_datatype"]
        self.append("quads_history", quads.select(*keys).distinct().withColumns({"run_id": F.lit(run_id), "map_id": F.lit(map_id)}))

    def switch(self, outcomes: DataFrame, run_id: str, run_seq: int) -> None:
        """The pointers of a run (outcomes: resource_key, seq, graph_key, outcome)."""
        self.append("current_pointer", state.replace(self.pointer(), outcomes, run_id, run_seq))

    def retract(self, keys: DataFrame, run_id: str, run_seq: int) -> None:
        self.append("current_pointer", state.retract(self.pointer(), keys, run_id, run_seq))

    def commit(self, run_id: str, run_seq: int) -> None:
        """The last write of a run."""
        self.append("commit_log", self.spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(run_seq).alias("run_seq"), F.current_timestamp().alias("committed")))

    def committed(self) -> DataFrame:
        return state.committed(self.table("run_record"), self.table("commit_log"))

    def pointer(self) -> DataFrame:
        """The last snapshot and the pointers of later runs: only their folders are read."""
        last = self.table("snapshot_log").agg(F.max("upto")).first()[0]
        tail = self.table("current_pointer").select(*POINTER)
        if last is None:
            return tail
        return self.table("pointer_snapshot").where(F.col("upto") == last).select(*POINTER).unionByName(tail.where(F.col("run_seq") > last))

    def snapshot(self) -> int | None:
        """Writes the last pointer of every resource as of the last committed run, and then its line in the log, in as few
        files as Spark's partitions after grouping. Returns the run's number, or None if there is nothing new. A snapshot that
        died is not in the log; the rows that it left are those that the next one writes again, and latest() counts them once."""
        upto = self.table("commit_log").agg(F.max("run_seq")).first()[0]
        last = self.table("snapshot_log").agg(F.max("upto")).first()[0]
        if upto is None or last is not None and last >= upto:
            return None
        rows = state.latest(self.pointer().where(F.col("run_seq") <= upto), "resource_key", *state.ORDER)
        self.append("pointer_snapshot", rows.withColumn("upto", F.lit(upto)))
        self.append("snapshot_log", self.spark.range(1).select(F.lit(upto).alias("upto")))
        return upto

    def current(self) -> DataFrame:
        return state.current_graph(self.table("quads_history"), self.pointer())

    def inferred(self) -> DataFrame:
        """What follows from the current graphs, each in the graph named after its record's."""
        history = self.table("quads_history").where("map_id = 'inferred'").withColumn("graph_key", F.regexp_replace("graph_key", INFERRED + "$", ""))
        return state.current_graph(history, self.pointer()).withColumn("graph_key", F.concat("graph_key", F.lit(INFERRED)))
