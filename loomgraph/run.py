"""One run: records, rules and maps to the versioned store, and the trial at a given number of records."""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import maps
from .functions.terms import content_hash
from .operators import elements, graph, routing, state
from .operators.closure import closure
from .plans import forward
from .plans.compiler import bind
from .plans.contract import MapContract, MapError, check, check_manifest
from .sources import records
from .sources.scratch import scratch, stored
from .sources.store import INFERRED, GraphStore

ENGINE = "loomgraph 3"
KINDS = ("Observation", "Encounter", "MedicationAdministration")
#: Elements outside the pinned schemas that a run's report names, the most frequent first.
REPORTED = 100
#: The axiom that holds without an ontology: who has a role of a process takes part in it.
PARTICIPATION = ("chain", "sulo:hasParticipant", "sulo:isFeatureOf", "sulo:hasParticipant")
#: Every reason that a record may have, so that a run counts them while it writes.
REASONS = (
    None, "policy", "several-types", "status", "code", "modifier-extension", "absent-value", "comparator", "identity", "unit", "value", "time", "component-modifier", "shape", "target", "profile",
    "nested-modifier", "map",
)


def _version_order() -> Column:
    """Versions by their number, or by the time of the update where they have none; never by their text."""
    return F.coalesce(F.col("meta.versionId").try_cast("long"), F.unix_micros(F.try_to_timestamp("meta.lastUpdated")), F.lit(1).cast("long"))


def _outcomes(m: MapContract, rows: DataFrame, rules: dict[str, DataFrame]) -> DataFrame:
    identity, units, policy = rules["identity_map"], rules["unit_rule"], rules["status_policy"]
    if m.map_id == "egfr":
        return forward.observation_outcomes(rows, identity, units, policy, [c for _, c in m.spec["codes"]])
    if m.map_id == "bp":
        return forward.panel_outcomes(rows, identity, units, policy)
    if m.map_id == "encounter":
        return forward.encounter_outcomes(rows, identity, policy)
    return forward.medication_outcomes(rows, identity, units, policy)


GRAPHS = {"egfr": forward.observation_graph, "bp": forward.panel_graph, "encounter": forward.encounter_graph, "medication": forward.medication_graph}


def record_elements(spark: SparkSession, input_path: str, folder: str) -> DataFrame:
    """(kind, record, path): the elements that each record has at any level, from one reading of the input."""
    raw = records.read_raw(spark, input_path)
    raw = raw.select("raw", F.get_json_object("raw", "$.resourceType").alias("kind"), F.get_json_object("raw", "$.id").alias("record")).where(F.col("kind").isin(*KINDS))
    return stored(elements.elements(raw, "raw", "kind", "record"), folder)


def unknown_elements(found: DataFrame) -> list[dict]:
    """The most frequent elements, at any level, that the pinned schemas don't have: Spark's reader drops them silently."""
    allowed = [f"{kind}:{p}" for kind in KINDS for p in elements.schema_paths(found.sparkSession.createDataFrame([], records.SCHEMAS[kind]).schema)]
    rows = elements.inventory(found, allowed).where("finding = 'unknown'").select("kind", F.col("path").alias("element"), "n")
    return [r.asDict() for r in rows.orderBy(F.desc("n"), "kind", "element").limit(REPORTED).collect()]


def nested_modifiers(found: DataFrame) -> DataFrame:
    """(m_kind, m_record) of records with a modifier extension below an element that no guard of a map looks at."""
    guarded = ("modifierExtension", "component.modifierExtension")
    deep = F.col("path").endswith("modifierExtension") & ~F.col("path").isin(*guarded) & ~F.col("path").startswith("contained.")
    return found.where(deep).select(F.col("kind").alias("m_kind"), F.col("record").alias("m_record")).distinct()


def profile(spark: SparkSession, rules_path: str) -> list[dict]:
    """The host's constraints on elements, profiles.json, if it has any: as few as the elements of its profiles."""
    try:
        return [r.asDict() for r in spark.read.schema(elements.CONSTRAINTS).json(f"{rules_path.rstrip('/')}/profiles.json").collect()]
    except AnalysisException:
        return []


def _conforming(rows: DataFrame) -> DataFrame:
    """``rows`` with what the profile and the nested modifiers say added to outcome and reasons."""
    bad, deep = F.size("issues") > 0, F.col("m_record").isNotNull()
    reasons = F.concat("reasons", F.when(bad, F.array(F.lit("profile"))).otherwise(F.array()), F.when(deep, F.array(F.lit("nested-modifier"))).otherwise(F.array()))
    outcome = F.when(bad, routing.REJECTED).when(deep & (F.col("outcome") == routing.MAPPED), routing.SOURCE_ONLY).otherwise(F.col("outcome"))
    return rows.withColumns({"outcome": outcome, "reasons": reasons}).drop("issues", "m_kind", "m_record")


def run(
    spark: SparkSession, input_path: str, rules_path: str, store_path: str, run_seq: int | None = None, ontology: str = "1", terminology: str = "1", policy: str = "1", axioms_path: str | None = None
) -> dict:
    """Transforms the records of ``input_path`` (JSON lines) that no committed run has done under the same map, ontology,
    terminology, policy and engine; returns counts by map, outcome and reason, and the run's id.

    Maps are checked before any data is read. Order of writes: outcomes, quads, lineage, validation, provenance, run
    record, then the pointer, and the line in the commit log last: a run that dies is done anew, and one that repeats adds no
    row to any table. Lines that repeat a record are one. A record that breaks the constraints of ``profiles.json`` in
    ``rules_path`` is rejected, one with a modifier extension that no map looks at is source-only. What follows from a graph by
    the chain and inverse axioms of ``axioms_path``, and by participation in any case, is stored in a graph of its own. A graph
    with violations of its map's target, or of the classes that the axioms say exclude each other, is stored and not pointed to:
    its record becomes rejected. The report names elements outside the pinned schemas, at any level."""
    contracts = [maps.egfr(), maps.blood_pressure(), maps.encounter(), maps.medication()]
    for m in contracts:
        if errors := [*check(m), *check_manifest(m)]:
            raise MapError(f"{m.map_id}: " + "; ".join(errors))
    store, rules = GraphStore(spark, store_path), records.read_rules(spark, rules_path)
    run_id = uuid.uuid4().hex
    if run_seq is None:
        run_seq = 1 + (store.table("run_record").agg(F.max("run_seq")).first()[0] or 0)
    result: dict = {"run_id": run_id, "outcomes": []}
    axioms = spark.createDataFrame([PARTICIPATION], "kind string, a string, b string, c string")
    if axioms_path:
        axioms = axioms.unionByName(records.read_axioms(spark, axioms_path))
    # the ontology's pairs of classes, as few as its axioms
    disjoint = [(r.a, r.b) for r in axioms.where("kind = 'disjoint'").collect()] if axioms_path else []
    constraints = profile(spark, rules_path)
    names = [rules[x].select("snapshot") for x in ("unit_rule", "code_rule")]
    snapshots = reduce(DataFrame.unionByName, names).agg(F.array_join(F.array_sort(F.collect_set("snapshot")), ",")).first()[0]  # as few as the host's tables
    switches: list[DataFrame] = []
    with scratch(spark) as folder:
        found = record_elements(spark, input_path, folder)
        result["unknown"] = unknown_elements(found)
        deep = nested_modifiers(found)
        for kind in KINDS:
            read = records.read_json(spark, input_path, kind)
            own_issues = elements.issues(read.schema, [c for c in constraints if c["kind"] == kind])
            read = read.withColumns({"source_digest": content_hash(F.to_json(F.struct(*read.columns), {"ignoreNullFields": "false"})), "resource_key": F.concat_ws("/", F.lit(forward.SERVER), F.lit(kind), "id"), "seq": _version_order(), "issues": own_issues})
            read = read.dropDuplicates(["resource_key", "source_digest"])  # a line given twice is one record
            own = [m for m in contracts if m.spec["source_shape"] == kind]
            chosen = forward.select_map(read, own)
            if kind == "Observation":  # what no code selects is an observation of another kind, routed by the numeric map
                chosen = chosen.withColumn("map_id", F.when(F.size("alternatives") == 0, "egfr").otherwise(F.col("map_id")))
            else:
                chosen = chosen.withColumn("map_id", F.coalesce("map_id", F.lit(own[0].map_id)))
            keyed = chosen.withColumns({"ontology": F.lit(ontology), "terminology": F.lit(terminology), "policy": F.lit(policy), "engine": F.lit(ENGINE)})
            hashes = F.create_map(*[F.lit(x) for m in own for x in (m.map_id, m.pair_hash)])
            news = state.pending(keyed.withColumn("pair_hash", F.element_at(hashes, F.col("map_id"))), store.committed())
            news = stored(news.join(deep, (F.col("m_kind") == kind) & (F.col("id") == F.col("m_record")), "left"), folder)
            named = {r.map_id for r in news.select("map_id").distinct().collect()}  # as few as the maps
            if None in named:  # several maps fit: kept for inspection, and out of the graph
                rows = news.where("map_id is null").withColumns({"outcome": F.lit(routing.REJECTED), "reasons": F.array(F.lit("map")), "graph_key": F.lit(None).cast("string")})
                store.append("outcomes", rows.select("resource_key", forward.version_of(rows).alias("version"), "map_id", "outcome", "reasons", "graph_key", F.lit(run_id).alias("run_id"), *_clocks(rows)))
                blank = {c: F.lit(None).cast("string") for c in ("source_version", "validation_digest", "output_digest", "evidence")}
                store.append("run_record", rows.withColumns({**blank, "run_id": F.lit(run_id), "run_seq": F.lit(run_seq), "activity_time": F.current_timestamp(), "snapshots": F.lit(snapshots)}))
                switches.append(rows.select("resource_key", "seq", "graph_key", "outcome"))
            for m in (m for m in own if m.map_id in named):
                done = stored(_conforming(_outcomes(m, news.where(F.col("map_id") == m.map_id), rules)), folder)
                switches.append(_write(store, m, done.withColumn("snapshots", F.lit(snapshots)), run_id, run_seq, folder, result, disjoint, axioms))
        if switches:
            store.switch(reduce(DataFrame.unionByName, switches), run_id, run_seq)
            store.commit(run_id, run_seq)
    return result


def _counts() -> dict[str, Column]:
    """Counts of outcomes and reasons, as metrics of whatever plan writes them."""
    has = lambda r: F.size("reasons") == 0 if r is None else F.array_contains("reasons", r)
    return {f"{o}|{r or ''}": F.count_if((F.col("outcome") == o) & has(r)) for o in (routing.MAPPED, routing.REJECTED, routing.SOURCE_ONLY) for r in REASONS}


def _clocks(rows: DataFrame) -> list[Column]:
    """Three clocks, kept apart: only the first one enters the graph."""
    effective = F.col("period.start") if "period" in rows.columns else F.col("effectiveDateTime")
    issued = F.col("issued") if "issued" in rows.columns else F.lit(None).cast("string")
    return [effective.alias("effective"), issued.alias("issued"), F.col("meta.lastUpdated").alias("last_updated")]


def _write(store: GraphStore, m: MapContract, done: DataFrame, run_id: str, run_seq: int, folder: str, result: dict, disjoint: list[tuple[str, str]], axioms: DataFrame) -> DataFrame:
    """Writes what a run has for one map; returns the rows for the pointer."""
    quads = stored(GRAPHS[m.map_id](done), folder)
    bad = graph.validate_target(quads, m).unionByName(graph.invariants(quads, m.types).select("graph_key", "s", "violation"))
    if disjoint:
        bad = bad.unionByName(graph.inconsistencies(quads, disjoint).withColumnRenamed("axiom", "violation"))
    bad = stored(bad, folder)
    failed = bad.select(F.col("graph_key").alias("bad_key")).distinct()
    final = done.join(failed, F.col("graph_key") == F.col("bad_key"), "left").withColumns({
        "outcome": F.when(F.col("bad_key").isNotNull(), routing.REJECTED).otherwise(F.col("outcome")),
        "reasons": F.when(F.col("bad_key").isNotNull(), F.array(F.lit("target"))).otherwise(F.col("reasons")),
    })
    version = forward.version_of(final).alias("version")
    slim = final.select("resource_key", "seq", "graph_key", "outcome", "reasons", "source", "source_digest", version, *_clocks(final), *state.RUN_KEY[1:], "evidence", "snapshots")
    counted = Observation()
    slim = stored(slim.observe(counted, *[c.alias(k) for k, c in _counts().items()]), folder)
    store.append("outcomes", slim.withColumns({"map_id": F.lit(m.map_id), "run_id": F.lit(run_id)}))
    store.append_graph(quads, run_id, m.map_id)
    # a source version and its map's hash are the same for all quads of a graph
    runs = slim.where(F.col("outcome") == routing.MAPPED).select("graph_key", F.lit(run_id).alias("run_id"), F.col("source").alias("source_version"), "pair_hash")
    lines = graph.trace(quads.withColumn("quad_hash", F.sha2(graph.quad_text(), 256)), runs)
    store.append("lineage", lines.where("run_id is not null"))
    store.append("validation", bad.withColumn("run_id", F.lit(run_id)))
    store.append_graph(state.provenance(runs), run_id, "provenance")
    iris = quads.where("o_kind = 'iri'").select("graph_key", "s", "p", F.col("o_value").alias("o"))
    said = closure(iris, axioms, ("graph_key",), folder)
    none = F.lit(None).cast("string")
    store.append_graph(said.select(F.concat("graph_key", F.lit(INFERRED)).alias("graph_key"), "s", "p", F.lit("iri").alias("o_kind"), F.col("o").alias("o_value"), none.alias("o_datatype")), run_id, "inferred")
    hashes = graph.graph_hash(quads).withColumnsRenamed({"graph_key": "h_key", "hash": "output_digest"})
    record = slim.join(hashes, F.col("graph_key") == F.col("h_key"), "left").withColumns({
        "run_id": F.lit(run_id), "run_seq": F.lit(run_seq), "source_version": F.col("source"), "map_id": F.lit(m.map_id), "activity_time": F.current_timestamp(), "validation_digest": F.lit(graph.validation_digest(bad)),
    })
    store.append("run_record", record)
    result["outcomes"] += [{"map": m.map_id, "outcome": k.split("|")[0], "reason": k.split("|")[1] or None, "n": n} for k, n in sorted(counted.get.items()) if n]
    return slim.select("resource_key", "seq", "graph_key", "outcome")


def cardinality_report(m: MapContract, outcomes: DataFrame) -> DataFrame:
    """Variables of mapped records that lack a value that the map declares: empty."""
    return graph.cardinality(bind(m, outcomes.where(F.col("outcome") == routing.MAPPED), ("graph_key",)), m)


def trial(spark: SparkSession, folder: str, n: int = 10_000) -> dict:
    """``n`` generated records through a run, and the same again, which has to change nothing: seconds, records per second,
    outcomes and current quads."""
    base = folder.rstrip("/")
    records.generate(spark, n).write.mode("overwrite").text(f"{base}/input")
    for name, rows in records.generate_rules().items():
        spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/rules/{name}.json")
    began = time.time()
    first = run(spark, f"{base}/input", f"{base}/rules", f"{base}/store")
    took = time.time() - began
    store = GraphStore(spark, f"{base}/store")
    quads = store.current().count()
    again = run(spark, f"{base}/input", f"{base}/rules", f"{base}/store")
    return {"records": n, "seconds": round(took, 1), "records_per_second": round(n / took, 1), "quads": quads, "quads_after_replay": store.current().count(), "replayed": len(again["outcomes"]), "outcomes": first["outcomes"]}


def main(args: list[str]) -> None:
    usage = "python -m loomgraph run INPUT RULES STORE | python -m loomgraph trial FOLDER [N]"
    if len(args) < 2 or args[0] not in ("run", "trial"):
        raise SystemExit(usage)
    spark = SparkSession.builder.appName("loomgraph").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    uri = lambda x: x if "://" in x else "file://" + str(Path(x).resolve())
    out = run(spark, *map(uri, args[1:4])) if args[0] == "run" else trial(spark, uri(args[1]), int(args[2]) if len(args) > 2 else 10_000)
    print(json.dumps(out))
    spark.stop()
