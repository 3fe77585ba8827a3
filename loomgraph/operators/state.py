"""Versions, replacement, retraction and replay over append-only tables.

Graphs are only ever appended; ``current_pointer`` says which (graph_key, run_id) of a resource holds, or that none
does. It is written last, so a crash leaves unused history and never half a graph. Plain Parquet is enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN_KEY = ("source_digest", "pair_hash", "ontology", "terminology", "policy", "engine")


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key by numeric or time order, as a grouped maximum (no sort of a key's history)."""
    names = rows.columns
    last = rows.groupBy(F.col(key).alias("latest_key")).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("row"))
    return last.select("row.*")


ORDER = ("seq", "run_seq")  #: of pointers: the version's order, then that of runs over one version


def current_graph(history: DataFrame, pointer: DataFrame) -> DataFrame:
    now = latest(pointer, "resource_key", *ORDER).where("graph_key is not null")
    return history.join(now.select(F.col("graph_key").alias("g"), F.col("run_id").alias("r")), (F.col("graph_key") == F.col("g")) & (F.col("run_id") == F.col("r")), "left_semi")


def replace(pointer: DataFrame, outcomes: DataFrame, run_id: str, run_seq: int) -> DataFrame:
    """Pointer rows to append for a run (outcomes: resource_key, seq, graph_key, outcome): a mapped version points to its
    graph; any other outcome retracts. A later run of the current version replaces it (a new map, a new policy); an
    earlier version, and a run that isn't later, change nothing. Of versions in one run the last counts."""
    now = latest(pointer, "resource_key", *ORDER).select(F.col("resource_key").alias("k"), *[F.col(c).alias(f"now_{c}") for c in ORDER])
    news = latest(outcomes.withColumn("run_seq", F.lit(run_seq).cast("long")), "resource_key", "seq", "graph_key").join(now, F.col("resource_key") == F.col("k"), "left")
    news = news.where("k is null or seq > now_seq or (seq = now_seq and run_seq > now_run_seq)")
    return news.select("resource_key", "seq", "run_seq", F.when(F.col("outcome") == "mapped", F.col("graph_key")).alias("graph_key"), F.lit(run_id).alias("run_id"), "outcome")


def retract(pointer: DataFrame, keys: DataFrame, run_id: str, run_seq: int) -> DataFrame:
    """Pointer rows that take the graphs of ``keys`` (resource_key) away: a later run over the same version, so that the
    next version of the record isn't taken for an old one."""
    now = latest(pointer, "resource_key", *ORDER).join(keys, "resource_key", "left_semi").where(F.col("run_seq") < run_seq)
    return now.select("resource_key", "seq", F.lit(run_seq).cast("long").alias("run_seq"), F.lit(None).cast("string").alias("graph_key"), F.lit(run_id).alias("run_id"), F.lit("source-only").alias("outcome"))


def committed(run_record: DataFrame, commit_log: DataFrame) -> DataFrame:
    """Records of runs that the log names. The log is written after the pointer, so a run that died before has no part in it,
    and a record counts as done whatever its run made of it: mapped, late, ambiguous or retracted since."""
    return run_record.join(commit_log.select("run_id").distinct(), "run_id", "left_semi")


def pending(contexts: DataFrame, committed: DataFrame) -> DataFrame:
    """Contexts whose full run key no committed run has."""
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"done_{c}")) for c in RUN_KEY])
    done = committed.select(*[F.col(c).alias(f"done_{c}") for c in RUN_KEY]).distinct()
    return contexts.join(done, on, "left_anti")


def provenance(runs: DataFrame) -> DataFrame:
    """Activity and derivation quads of runs (run_id, graph_key, source_version, pair_hash), in one graph for each run."""
    activity = F.concat(F.lit("ex:run-"), F.col("run_id"))
    say = lambda s, p, kind, o: F.struct(s.alias("s"), F.lit(p).alias("p"), F.lit(kind).alias("o_kind"), o.alias("o_value"), F.lit(None).cast("string").alias("o_datatype"))
    quads = F.explode(F.array(
        say(activity, "rdf:type", "iri", F.lit("prov:Activity")), say(activity, "prov:used", "iri", F.col("source_version")), say(activity, "prov:used", "literal", F.col("pair_hash")),
        say(F.col("graph_key"), "prov:wasGeneratedBy", "iri", activity), say(F.col("graph_key"), "prov:wasDerivedFrom", "iri", F.col("source_version")),
    ))
    return runs.select(F.concat(F.lit("graph:provenance-"), F.col("run_id")).alias("graph_key"), quads.alias("q")).select("graph_key", "q.*").distinct()
