"""The registered queries: driver tables stand in for records and go through the same operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import maps
from .functions.terms import norm_ref, time_precision
from .operators import elements, graph, routing, state
from .operators.closure import closure
from .plans import compiler, forward
from .sources import records
from .sources.scratch import stored

QUAD = ["s", "p", "o_kind", "o_value", "o_datatype"]


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _text(c: str):
    return F.col(c).cast("string")


#: Records for one task. Each becomes 20 to 40 quads, of which a task may hold all to find the different ones, so that its memory
#: must not grow with the table.
TASK_ROWS = 50_000


def _tasks(table: DataFrame) -> int:
    """As many tasks as a table's records need, and as the session has cores. The count is in the files' footers."""
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-table.count() // TASK_ROWS))


def _spread(df: DataFrame) -> DataFrame:
    """A table of fewer partitions than its records need tasks, dealt out evenly. A table of many files is read as it is, without
    an exchange."""
    n = _tasks(df)
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def _dealt(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows``, made of those of ``table`` by joins, dealt out by ``key`` if there are more than the cores' shares of them: an
    exchange in a join may gather far more records in a task."""
    n = _tasks(table)
    return rows.repartition(n, key) if n > rows.sparkSession.sparkContext.defaultParallelism else rows


def _orders_lines(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """``orders`` and ``lineitem``, both dealt out by the order, in so many tasks that each has few orders."""
    o = _read(spark, d, "orders")
    n = _tasks(o)
    return o.repartition(n, "o_orderkey"), _read(spark, d, "lineitem").repartition(n, "l_orderkey")


# --- the tables as records ------------------------------------------------------------------------------


def observations(spark: SparkSession, d: str) -> DataFrame:
    """``events`` as numeric observations; values in hundredths, so that both sides print them alike."""
    none = F.lit(None)
    e = _spread(_read(spark, d, "events"))
    return e.select(
        F.concat(F.lit("egfr-"), _text("event_id")).alias("id"), F.col("event_id").alias("seq"), F.struct(F.lit("1").alias("versionId")).alias("meta"),
        F.when(F.col("event_type") == "error", "entered-in-error").otherwise("final").alias("status"),
        F.struct(F.array(F.struct(F.lit(maps.LOINC).alias("system"), F.when(F.col("event_type") == "view", "view").otherwise(maps.EGFR_CODE).alias("code"))).alias("coding")).alias("code"),
        F.struct(F.concat(F.lit("Patient/"), _text("user_id")).alias("reference")).alias("subject"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("effectiveDateTime"),
        F.struct(F.round(F.col("value") * 100).cast("long").cast("string").alias("value"), none.cast("string").alias("comparator"), F.lit(maps.UCUM).alias("system"), F.concat(F.lit("u-"), F.col("event_type")).alias("code")).alias("valueQuantity"),
        none.cast("struct<coding:array<string>>").alias("dataAbsentReason"), none.cast("array<string>").alias("modifierExtension"), "user_id", "event_type",
    )


def identities(spark: SparkSession, d: str) -> DataFrame:
    """``customer`` as identity table: keys divisible by 7 are unknown, those divisible by 11 have two candidates."""
    c = _read(spark, d, "customer").where("c_custkey % 7 <> 0")
    ref, person = F.concat(F.lit("Patient/"), _text("c_custkey")), F.concat(F.lit("ex:person-"), _text("c_custkey"))
    one = c.select(ref.alias("source_ref"), person.alias("person_iri"))
    return one.unionByName(c.where("c_custkey % 11 = 0").select(ref.alias("source_ref"), F.concat(person, F.lit("b")).alias("person_iri")))


def unit_rules(spark: SparkSession) -> DataFrame:
    """``signup`` has no recognised unit."""
    return spark.createDataFrame([(maps.UCUM, f"u-{x}", f"ex:unit-{x}") for x in ("click", "view", "purchase", "error")], "system string, code string, unit_iri string")


def policy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("Observation", "final", "mapped"), ("Observation", "amended", "mapped"), ("Observation", "entered-in-error", "source-only"), ("Encounter", "finished", "mapped"), ("Encounter", "in-progress", "source-only")], "resource_type string, status string, outcome string")


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    return forward.observation_outcomes(observations(spark, d), identities(spark, d), unit_rules(spark), policy(spark), [maps.EGFR_CODE])


def quads(spark: SparkSession, d: str) -> DataFrame:
    """The graph with lineage, in the plan of the query that reads it once."""
    return forward.observation_graph(_dealt(outcomes(spark, d), _read(spark, d, "events"), "graph_key"), ("graph_key", "id"))


def stored_quads(spark: SparkSession, d: str) -> DataFrame:
    """Written once, without lineage, for queries that read the graph several times, as they would the store's."""
    return stored(quads(spark, d).select("graph_key", "id", *QUAD))


def encounters(spark: SparkSession, d: str) -> DataFrame:
    """``orders`` as encounters: F finished, O open (finished without an end), P in progress."""
    start = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return _spread(_read(spark, d, "orders")).select(
        F.concat(F.lit("enc-"), _text("o_orderkey")).alias("id"), F.struct(F.lit("1").alias("versionId")).alias("meta"), F.when(F.col("o_orderstatus") == "P", "in-progress").otherwise("finished").alias("status"),
        F.struct(start.alias("start"), F.when(F.col("o_orderstatus") == "F", start).alias("end")).alias("period"),
        F.concat(F.lit("ex:person-"), _text("o_custkey")).alias("person"), F.concat(F.lit("ex:clinician-"), (F.col("o_custkey") % 10).cast("string")).alias("clinician"),
    )


def panels(spark: SparkSession, d: str) -> DataFrame:
    """``orders`` as panels with their ``lineitem`` rows as components, orders without any included. A component's key
    is its content and its rank among equals, never its place."""
    o, li = _orders_lines(spark, d)
    li = li.select("l_orderkey", F.when(F.col("l_returnflag") == "A", "sys").when(F.col("l_returnflag") == "N", "dia").otherwise("other").alias("kind"), F.col("l_quantity").cast("long").cast("string").alias("value"))
    each = li.groupBy("l_orderkey", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    key = F.concat(_text("l_orderkey"), F.lit("-"), F.col("kind"), F.lit("-"), F.col("value"), F.lit("-"), F.col("i").cast("string"))
    each = each.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    parts = each.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("kind", key.alias("key"), F.concat(F.lit("ex:quality-"), key).alias("quality"), "value", F.lit("ex:unit-piece").alias("unit")))).alias("component"))
    o = o.join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    ident = _text("o_orderkey")
    return o.select(ident.alias("id"), F.concat(F.lit("graph:bp-"), ident).alias("graph_key"), F.lit("final").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("effectiveDateTime"),
                    F.coalesce("component", F.array().cast(parts.schema["component"].dataType)).alias("component"), F.concat(F.lit("ex:person-"), _text("o_custkey")).alias("person"), F.concat(F.lit("ex:src-"), ident).alias("source"))


# --- queries --------------------------------------------------------------------------------------------


def eligibility_routing(spark, d):
    return routing.outcome_counts(outcomes(spark, d))


def identity_resolution(spark, d):
    rows = routing.resolve_identity(observations(spark, d).withColumn("reference", F.col("subject.reference")), "reference", identities(spark, d))
    return rows.select("id", "person_iri", F.col("n_candidates").cast("long").alias("n_candidates"))


def identity_ambiguous(spark, d):
    rows = routing.resolve_identity(observations(spark, d).withColumn("reference", F.col("subject.reference")), "reference", identities(spark, d))
    return rows.where("n_candidates > 1").groupBy("reference").agg(F.count(F.lit(1)).alias("n"))


def reference_resolution(spark, d):
    """Relative, absolute and versioned references to the same records."""
    o = _read(spark, d, "orders")
    base = F.lit("https://records.example")
    ref = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Patient/"), _text("o_custkey"))).when(F.col("o_orderkey") % 3 == 1, F.concat(base, F.lit("/Patient/"), _text("o_custkey"))).otherwise(F.concat(F.lit("Patient/"), _text("o_custkey"), F.lit("/_history/2")))
    targets = _read(spark, d, "customer").where("c_custkey % 5 <> 0").select(F.concat(base, F.lit("/Patient/"), _text("c_custkey")).alias("key"))
    return routing.resolve_refs(o.withColumn("ref", ref), norm_ref(F.col("ref"), base), targets, "key").select("o_orderkey", "target_key")


def code_typing(spark, d):
    rules = spark.createDataFrame([("events", "click", "ex:Click", "m1"), ("events", "purchase", "ex:Purchase", "m2")], "system string, code string, target_class string, map_id string")
    return routing.type_by_code(_read(spark, d, "events"), F.lit("events"), F.col("event_type"), rules).select("event_id", "target_class", "map_id")


def unit_resolution(spark, d):
    o = observations(spark, d)
    return routing.unit_node(o, F.col("valueQuantity.system"), F.col("valueQuantity.code"), unit_rules(spark)).groupBy("event_type", "unit_iri").agg(F.count(F.lit(1)).alias("n"))


def materialize_quads(spark, d):
    return quads(spark, d).select("id", *QUAD)


def _traced(spark, d):
    """The quads with their runs, both dealt out by their graph before the join where there are many."""
    o = _dealt(outcomes(spark, d).where("outcome = 'mapped'"), _read(spark, d, "events"), "graph_key")
    runs = o.select("graph_key", F.lit("run-1").alias("run_id"), F.col("source").alias("source_version"), F.lit(maps.egfr().pair_hash).alias("pair_hash"))
    return graph.trace(quads(spark, d), runs)


def lineage_trace(spark, d):
    """Quads by predicate and by whether a binding or a constant made them; all have a source."""
    return _traced(spark, d).groupBy("p", "is_constant").agg(F.count(F.lit(1)).alias("n"), F.count("source_version").alias("traced"), F.count_distinct("source_version").alias("sources"))


def graph_hash(spark, d):
    q = quads(spark, d).withColumn("graph_key", F.col("id"))
    return graph.graph_hash(q).select(F.col("graph_key").alias("id"), "hash")


def result_for_person(spark, d):
    return graph.results(quads(spark, d), "ex:EGFRResult")


def pivot_round_trip(spark, d):
    """Bindings read back from the graph."""
    back = compiler.invert(maps.egfr(), quads(spark, d).withColumn("graph_key", F.col("id")))
    return back.where("var <> 'egfr:local'").select(F.col("graph_key").alias("id"), "var", "value")


def scoped_components(spark, d):
    """Pairs within a panel, with the counts that show absent and ambiguous components."""
    m = maps.blood_pressure()
    bound = compiler.bind(m, panels(spark, d), ("id",))
    return graph.scoped_pairs(bound, "scope_component", "kind", "value", "sys", "dia").select("id", F.col("left_value").alias("systolic"), F.col("right_value").alias("diastolic"), F.col("left_n").cast("long").alias("n_systolic"), F.col("right_n").cast("long").alias("n_diastolic"))


def pair_multiset(spark, d):
    m = maps.blood_pressure()
    pairs = graph.scoped_pairs(compiler.bind(m, panels(spark, d), ("id",)), "scope_component", "kind", "value", "sys", "dia").where("left_n = 1 and right_n = 1")
    return graph.tuple_multiset(pairs, "left_value", "right_value")


def panel_quads(spark, d):
    # dealt out by their subjects before they are counted, so that no task holds those of more than its share of panels
    q = forward.panel_graph(panels(spark, d)).select("s", "p", "o_kind").repartition(_tasks(_read(spark, d, "orders")), "s")
    return q.groupBy("p", "o_kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("s").alias("subjects"))


def pair_by_time(spark, d):
    """Systolic and diastolic values per panel and time, from the graph alone."""
    q = stored(forward.panel_graph(panels(spark, d)))
    parts = q.where("p in ('ex:componentKind', 'sulo:hasValue')").groupBy("graph_key", "s").agg(F.max(F.when(F.col("p") == "ex:componentKind", F.col("o_value"))).alias("kind"), F.max(F.when(F.col("p") == "sulo:hasValue", F.col("o_value"))).alias("value"))
    times = parts.where("kind is null").select(F.col("graph_key").alias("g"), F.col("value").alias("time"))
    pairs = parts.where("kind is not null").groupBy("graph_key").agg(*[F.when(F.count(F.when(F.col("kind") == k, 1)) == 1, F.max(F.when(F.col("kind") == k, F.col("value")))).alias(n) for k, n in (("sys", "systolic"), ("dia", "diastolic"))])
    return pairs.join(times, F.col("graph_key") == F.col("g")).where("systolic is not null and diastolic is not null").select(F.col("graph_key").alias("panel"), "time", "systolic", "diastolic")


def _encounter_quads(spark, d):
    """Made anew for each use, in tasks of few records: files would be read in tasks of any number."""
    rows = _dealt(forward.encounter_rows(encounters(spark, d)), _read(spark, d, "orders"), "graph_key")
    return forward.encounter_graph(rows, ("graph_key", "id"))


def interval_open_end(spark, d):
    q = _encounter_quads(spark, d)
    return q.where("o_value in ('sulo:TimeInterval', 'sulo:StartTime', 'sulo:EndTime') or p = 'sulo:hasPart' or p = 'sulo:hasValue'").select("id", *QUAD)


def pro_participants(spark, d):
    return graph.pro_entail(_encounter_quads(spark, d)).select("s", "p", "o_value")


def participants(spark, d):
    return graph.participants(_encounter_quads(spark, d))


def latest_version(spark, d):
    e = _read(spark, d, "events").select("user_id", "event_id", "event_type")
    return state.latest(e, "user_id", "event_id")


def _pointer(spark, d):
    """Events as versions of their user's record; an error retracts."""
    return _read(spark, d, "events").select(_text("user_id").alias("resource_key"), F.col("event_id").alias("seq"), F.when(F.col("event_type") != "error", F.concat(F.lit("g-"), _text("event_id"))).alias("graph_key"), F.lit("r1").alias("run_id"), F.lit("mapped").alias("outcome"), F.lit(1).cast("long").alias("run_seq"))


def _history(spark, d):
    return _read(spark, d, "events").select(F.concat(F.lit("g-"), _text("event_id")).alias("graph_key"), F.lit("r1").alias("run_id"), F.concat(F.lit("ex:user-"), _text("user_id")).alias("s"), F.lit("sulo:hasValue").alias("p"), F.lit("literal").alias("o_kind"), F.col("event_type").alias("o_value"), F.lit("xsd:string").alias("o_datatype"))


def current_graph(spark, d):
    return state.current_graph(_history(spark, d), _pointer(spark, d)).select("graph_key", "s", "o_value")


def graph_diff(spark, d):
    """From the state after the first half of the events, by their ids, to the state after all."""
    h, p = _history(spark, d), _pointer(spark, d)
    half = p.join(F.broadcast(p.agg(F.max("seq").alias("last"))), F.col("seq") * 2 < F.col("last")).drop("last")  # one row
    removed, added = graph.graph_diff(state.current_graph(h, half), state.current_graph(h, p))
    return removed.withColumn("change", F.lit("removed")).unionByName(added.withColumn("change", F.lit("added"))).groupBy("change", "o_value").agg(F.count(F.lit(1)).alias("n"))


def replay_pending(spark, d):
    e = _read(spark, d, "events")
    keyed = e.select("event_id", _text("value").alias("source_digest"), *[F.lit("v1").alias(c) for c in state.RUN_KEY[1:]]).withColumn("source_digest", F.concat(_text("event_id"), F.lit("/"), F.lit("a")))
    done = keyed.where("event_id % 3 = 0").withColumn("policy", F.when(F.col("event_id") % 2 == 0, "v1").otherwise("v0"))
    return state.pending(keyed, done).select("event_id")


def orphan_check(spark, d):
    """Units whose only reference was taken away show up."""
    q = stored_quads(spark, d)
    broken = q.where("not (p = 'sulo:hasPart' and cast(substring(id, 6) as bigint) % 10 = 1)")
    return graph.orphans(broken, "sulo:Unit").groupBy(F.col("s").alias("unit")).agg(F.count(F.lit(1)).alias("n"))


def cross_patient_check(spark, d):
    q, o = stored_quads(spark, d), outcomes(spark, d)
    wrong = o.select("graph_key", F.when(F.col("seq") % 9 == 4, "ex:person-x").otherwise(F.col("person_iri")).alias("person_iri"))
    return graph.cross_patient(q, wrong).select("s", "person", "person_iri")


def erroneous_check(spark, d):
    q, o = quads(spark, d), outcomes(spark, d)
    wrong = o.select("graph_key", F.when(F.col("seq") % 8 == 2, "entered-in-error").otherwise(F.col("status")).alias("status"))
    return graph.erroneous(q, wrong).groupBy("p").agg(F.count(F.lit(1)).alias("n"))


def exactly_one_check(spark, d):
    q = stored_quads(spark, d)
    broken = q.where("not (p = 'sulo:hasValue' and cast(substring(id, 6) as bigint) % 10 = 3)")
    return graph.exactly_one(broken, "sulo:Quantity", "sulo:hasValue").select("s", "n")


def invariant_check(spark, d):
    q = quads(spark, d).withColumn("p", F.when((F.col("p") == "sulo:hasFeature") & F.col("s").endswith("3"), "sulo:hasPatient").otherwise(F.col("p")))
    declared = sorted(set(maps.egfr().types) - {"sulo:Unit"})
    return graph.invariants(q, declared).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


def time_forms(spark, d):
    e = _read(spark, d, "events")
    cut = F.when(F.col("event_id") % 4 == 0, 4).when(F.col("event_id") % 4 == 1, 7).when(F.col("event_id") % 4 == 2, 10).otherwise(20)
    return e.select("event_id", time_precision(F.substring(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(1), cut)).alias("precision"))


def nquads(spark, d):
    return graph.to_nquads(quads(spark, d), maps.PREFIXES)


def code_guard(spark, d):
    """The same code of another system is another meaning: every third event has one."""
    o = observations(spark, d)
    other = F.transform("code.coding", lambda c: F.struct(F.when(F.col("seq") % 3 == 0, "urn:other").otherwise(c["system"]).alias("system"), c["code"].alias("code")))
    o = o.withColumn("code", F.struct(other.alias("coding")))
    return forward.observation_outcomes(o, identities(spark, d), unit_rules(spark), policy(spark), [maps.EGFR_CODE]).select("id", "outcome", F.array_join("reasons", " ").alias("reasons"))


def ambiguous_rules(spark, d):
    """Two unit rules that disagree reject, repeated ones count once, and none of them multiplies records."""
    units = unit_rules(spark)
    units = units.unionByName(units).unionByName(spark.createDataFrame([(maps.UCUM, "u-purchase", "ex:unit-other")], units.schema))
    return routing.outcome_counts(forward.observation_outcomes(observations(spark, d), identities(spark, d), units, policy(spark), [maps.EGFR_CODE]))


def shape_outcomes(spark, d):
    """A status that the policy allows and the map doesn't know is an outcome of its own, not a row that vanishes."""
    o = observations(spark, d).withColumn("status", F.when(F.col("event_type") == "purchase", "preliminary").otherwise(F.col("status")))
    allowed = policy(spark).unionByName(spark.createDataFrame([("Observation", "preliminary", "mapped")], "resource_type string, status string, outcome string"))
    rows = stored(forward.observation_outcomes(o, identities(spark, d), unit_rules(spark), allowed, [maps.EGFR_CODE]))
    graphs = forward.observation_graph(rows).select("graph_key").distinct().withColumnRenamed("graph_key", "g")
    rows = rows.join(graphs, F.col("graph_key") == F.col("g"), "left").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.count("g").alias("graphs"), F.count_if(F.array_contains("reasons", "shape")).alias("shapes"))
    return rows


def _versions(spark, d):
    e = _read(spark, d, "events")
    return e.select(_text("user_id").alias("resource_key"), "user_id", F.col("event_id").alias("seq"), F.concat(F.lit("g-"), _text("event_id")).alias("graph_key"), F.when(F.col("event_type") == "error", "source-only").otherwise("mapped").alias("outcome"))


def _first_run(spark, d):
    empty = spark.createDataFrame([], "resource_key string, seq long, run_seq long, graph_key string, run_id string, outcome string")
    return stored(state.replace(empty, _versions(spark, d), "r1", 1))


def store_replay(spark, d):
    """A second run over the same versions, under a new map, replaces; one over older versions changes nothing."""
    p, v = _first_run(spark, d), _versions(spark, d)
    p = stored(p.unionByName(state.replace(p, v.where("user_id % 3 = 0"), "r2", 2)))
    old = v.join(p.select(F.col("resource_key").alias("k"), F.col("seq").alias("now")), (F.col("resource_key") == F.col("k")) & (F.col("seq") < F.col("now"))).drop("k", "now")
    p = p.unionByName(state.replace(p, old, "r3", 3))
    return state.latest(p, "resource_key", *state.ORDER).select("resource_key", "seq", "graph_key", "run_id")


def store_retract(spark, d):
    """A retraction takes a graph away, and the record's next version, whatever its number, brings one back."""
    p = _first_run(spark, d)
    p = stored(p.unionByName(state.retract(p, p.where("cast(resource_key as bigint) % 5 = 0").select("resource_key"), "r2", 2)))
    last = state.latest(p, "resource_key", *state.ORDER).where("cast(resource_key as bigint) % 10 = 0")
    news = last.select("resource_key", (F.col("seq") + 1).alias("seq"), F.concat(F.lit("n-"), "resource_key").alias("graph_key"), F.lit("mapped").alias("outcome"))
    p = p.unionByName(state.replace(p, news, "r3", 3))
    return state.latest(p, "resource_key", *state.ORDER).select("resource_key", "seq", "graph_key", "run_id")


def panel_graph_quads(spark, d):
    return forward.panel_graph(panels(spark, d), ("graph_key", "id")).select("id", *QUAD)


def lineage_quads(spark, d):
    """Every quad with the variable or constant that made it, its source version, map and run."""
    return _traced(spark, d).select("id", "s", "p", "o_value", "is_constant", F.col("var").isNull().alias("no_variable"), "source_version", "pair_hash", "run_id")


def target_validation(spark, d):
    """Results without a value, and values of another datatype, are found against the map's target."""
    q = quads(spark, d)
    n = F.expr("cast(substring(id, 6) as bigint)")
    broken = q.where(~((F.col("p") == "sulo:hasValue") & F.col("s").startswith("ex:egfr-result-") & (n % 10 == 3)))
    broken = broken.withColumn("o_datatype", F.when((F.col("o_datatype") == "xsd:decimal") & (n % 10 == 5), "xsd:string").otherwise(F.col("o_datatype")))
    return graph.validate_target(broken, maps.egfr()).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


def encounter_records(spark: SparkSession, d: str) -> DataFrame:
    """``encounters`` in the schema that records are read with."""
    return encounters(spark, d).withColumns({
        "resourceType": F.lit("Encounter"), "subject": F.struct(F.regexp_replace("person", "^ex:person-", "Patient/").alias("reference")),
        "participant": F.array(F.struct(F.struct(F.regexp_replace("clinician", "^ex:clinician-", "Practitioner/").alias("reference")).alias("individual"))), "modifierExtension": F.lit(None).cast("array<struct<url:string>>"),
    }).drop("person", "clinician")


def encounter_routing(spark, d):
    """Outcomes of encounters; practitioner 9 is unknown."""
    people = identities(spark, d).unionByName(spark.range(9).select(F.concat(F.lit("Practitioner/"), _text("id")).alias("source_ref"), F.concat(F.lit("ex:clinician-"), _text("id")).alias("person_iri")))
    return forward.encounter_outcomes(encounter_records(spark, d), people, policy(spark)).select("id", "outcome", F.array_join("reasons", " ").alias("reasons"))


def _panel_records(spark, d):
    o, li = _orders_lines(spark, d)
    code = F.when(F.col("l_returnflag") == "A", maps.SYSTOLIC).when(F.col("l_returnflag") == "N", maps.DIASTOLIC).otherwise("x")
    unit = F.when(F.col("l_quantity") > 45, "?").otherwise("u-click")
    concept = F.struct(F.array(F.struct(F.lit(maps.LOINC).alias("system"), code.alias("code"))).alias("coding"))
    quantity = F.struct(F.col("l_quantity").cast("long").cast("string").alias("value"), F.lit(None).cast("string").alias("comparator"), F.lit(maps.UCUM).alias("system"), unit.alias("code"))
    part = F.struct(concept.alias("code"), quantity.alias("valueQuantity"), F.lit(None).cast("struct<coding:array<string>>").alias("dataAbsentReason"), F.lit(None).cast("array<string>").alias("modifierExtension"))
    parts = li.groupBy("l_orderkey").agg(F.collect_list(part).alias("component"))
    o = o.join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.select(
        _text("o_orderkey").alias("id"), F.struct(F.lit("1").alias("versionId")).alias("meta"), F.lit("final").alias("status"), F.struct(F.concat(F.lit("Patient/"), _text("o_custkey")).alias("reference")).alias("subject"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("effectiveDateTime"), "component", F.lit(None).cast("array<string>").alias("modifierExtension"),
    )


def _panel_report(out):
    return out.select("id", "outcome", F.coalesce(F.size("component"), F.lit(0)).cast("long").alias("n_parts"), F.coalesce(F.size("diagnostics"), F.lit(0)).cast("long").alias("n_issues"))


def panel_routing(spark, d):
    """Outcomes of panels whose components are read in the order of the table, with what is wrong with single components:
    quantities over 45 have an unknown unit, and a third kind of component has no code that the map knows."""
    return _panel_report(forward.panel_outcomes(_panel_records(spark, d), identities(spark, d), unit_rules(spark), policy(spark)))


def ledger_pending(spark, d):
    """What is left to do after four runs of which the log names three: whatever came of a record, it is done if its run is."""
    keyed = _read(spark, d, "events").select("event_id", F.concat(F.lit("d-"), _text("event_id")).alias("source_digest"), *[F.lit("v1").alias(c) for c in state.RUN_KEY[1:]])
    record = keyed.withColumns({"run_id": F.concat(F.lit("r"), (F.col("event_id") % 4).cast("string")), "policy": F.when(F.col("event_id") % 5 == 0, "v0").otherwise(F.col("policy"))})
    log = spark.createDataFrame([("r0", 1), ("r1", 2), ("r2", 3), ("r2", 3)], "run_id string, run_seq long")
    return state.pending(keyed, state.committed(record, log)).select("event_id")


AXIOMS = [
    ("chain", "sulo:hasParticipant", "sulo:isFeatureOf", "sulo:hasParticipant"), ("chain", "sulo:hasParticipant", "ex:memberOf", "ex:involves"), ("chain", "ex:involves", "ex:partOf", "ex:locatedIn"),
    ("inverse", "ex:locatedIn", "ex:siteOf", None),
]


def axiom_closure(spark, d):
    """Where encounters took place, through their roles, who has them, and the nations and regions of those."""
    # not dealt out as quads: the closure deals out those that it uses, before any task holds them
    q = forward.encounter_graph(forward.encounter_rows(encounters(spark, d))).where("o_kind = 'iri'").select("s", "p", F.col("o_value").alias("o"))
    say = lambda s, p, o: [s.alias("s"), F.lit(p).alias("p"), o.alias("o")]
    members = _read(spark, d, "customer").select(*say(F.concat(F.lit("ex:person-"), _text("c_custkey")), "ex:memberOf", F.concat(F.lit("ex:nation-"), _text("c_nationkey"))))
    parts = _read(spark, d, "nation").select(*say(F.concat(F.lit("ex:nation-"), _text("n_nationkey")), "ex:partOf", F.concat(F.lit("ex:region-"), _text("n_regionkey"))))
    return closure(q.unionByName(members).unionByName(parts), spark.createDataFrame(AXIOMS, "kind string, a string, b string, c string"))


def nested_elements(spark, d):
    """Elements of panels as JSON that the pinned schema lacks, and modifiers, at any level, with the numbers of records."""
    part = F.struct(
        F.struct(F.array(F.struct(F.lit(maps.LOINC).alias("system"), F.when(F.col("l_linenumber") == 1, True).alias("userSelected"))).alias("coding")).alias("code"), F.struct(_text("l_quantity").alias("value")).alias("valueQuantity"),
        F.when(F.col("l_quantity") > 45, F.array(F.struct(F.lit("urn:m").alias("url")))).alias("modifierExtension"),
        F.when(F.col("l_returnflag") == "R", F.array(F.struct(F.lit("x").alias("text"), F.when(F.col("l_linenumber") == 2, F.array(F.struct(F.lit("urn:m").alias("url")))).alias("modifierExtension")))).alias("note"),
    )
    o, li = _orders_lines(spark, d)
    parts = li.groupBy("l_orderkey").agg(F.collect_list(part).alias("component"))
    o = o.join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    raw = o.select(_text("o_orderkey").alias("record"), F.lit("Observation").alias("kind"), F.to_json(F.struct(F.lit("Observation").alias("resourceType"), _text("o_orderkey").alias("id"), "component")).alias("raw"))
    allowed = elements.schema_paths(spark.createDataFrame([], records.SCHEMAS["Observation"]).schema)
    return elements.inventory(elements.elements(raw, "raw", "kind", "record"), [f"Observation:{p}" for p in allowed]).select("kind", "path", "finding", "n")


PROFILE = [
    {"path": "id", "least": 1, "most": 1, "type": "id"}, {"path": "component", "least": 1, "most": 4}, {"path": "component.code.coding", "least": 1}, {"path": "component.valueQuantity.value", "least": 1, "type": "decimal"},
    {"path": "component.valueQuantity.code", "values": ["u-click"]},
]


def conformance_issues(spark, d):
    """What panels lack or have too much of, in any repetition, against constraints of their elements."""
    coding = F.when(F.col("l_returnflag") == "R", F.array().cast("array<struct<system:string,code:string>>")).otherwise(F.array(F.struct(F.lit(maps.LOINC).alias("system"), F.lit("x").alias("code"))))
    value = F.when(F.col("l_linenumber") == 3, "some").when(F.col("l_linenumber") < 6, _text("l_partkey"))
    part = F.struct(F.struct(coding.alias("coding")).alias("code"), F.struct(value.alias("value"), F.when(F.col("l_quantity") > 45, "?").otherwise("u-click").alias("code")).alias("valueQuantity"))
    o, li = _orders_lines(spark, d)
    parts = li.groupBy("l_orderkey").agg(F.collect_list(part).alias("component"))
    rows = o.join(parts, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.concat(F.when(F.col("o_orderstatus") == "P", "order ").otherwise("order-"), _text("o_orderkey")).alias("id"), "component")
    return rows.select("id", F.array_join(elements.issues(rows.schema, PROFILE), "; ").alias("issues"))


def graph_diff_by_hash(spark, d):
    """From the first half of the events to all but the errors, in one graph for each user: only graphs that differ are read."""
    e = _read(spark, d, "events")
    q = e.select(F.concat(F.lit("graph:"), _text("user_id")).alias("graph_key"), F.concat(F.lit("ex:event-"), _text("event_id")).alias("s"), F.lit("sulo:hasValue").alias("p"), F.lit("literal").alias("o_kind"), F.col("event_type").alias("o_value"), F.lit("xsd:string").alias("o_datatype"), "event_id")
    half = q.join(F.broadcast(e.agg(F.max("event_id").alias("last"))), F.col("event_id") * 2 < F.col("last"))  # one row
    removed, added = graph.graph_diff_by_hash(half, q.where("o_value <> 'error'"))
    return removed.withColumn("change", F.lit("removed")).unionByName(added.withColumn("change", F.lit("added"))).select("change", "graph_key", "s", "o_value")


def graph_set_hash(spark, d):
    """A hash of every graph that its order, its repetitions and its split don't change."""
    q = quads(spark, d).withColumn("graph_key", F.col("id"))
    return graph.set_hashes(q.unionByName(q)).select(F.col("graph_key").alias("id"), "h")


def doubled_panels(spark, d):
    """Panels that were given twice have the components of one."""
    rows = _panel_records(spark, d)
    out = forward.panel_outcomes(rows.unionByName(rows), identities(spark, d), unit_rules(spark), policy(spark))
    return _panel_report(out).groupBy("id", "outcome", "n_parts", "n_issues").agg(F.count(F.lit(1)).alias("n"))


def injective_keys(spark, d):
    """Nodes of results whose records' ids differ by a prefix alone."""
    o = observations(spark, d)
    both = o.unionByName(o.withColumn("id", F.regexp_replace("id", "^egfr-", "")))
    q = forward.observation_graph(forward.observation_outcomes(both, identities(spark, d), unit_rules(spark), policy(spark), [maps.EGFR_CODE]), ("graph_key", "id"))
    results = q.where("p = 'rdf:type' and o_value = 'ex:EGFRResult'").groupBy(F.col("s").alias("node")).agg(F.count_distinct("id").alias("records"))
    return results.join(graph.key_collisions(q, "id", ["ex:EGFRResult", "ex:ObservationRecord"]), "node", "left").select("node", "records", F.coalesce("n", F.lit(0)).cast("long").alias("collisions"))


def normalised_identity(spark, d):
    """Outcomes of records that name their subject by a relative, an absolute or a versioned reference."""
    ref = F.col("subject.reference")
    form = F.when(F.col("seq") % 3 == 0, ref).when(F.col("seq") % 3 == 1, F.concat(F.lit(forward.SERVER + "/"), ref)).otherwise(F.concat(ref, F.lit("/_history/4")))
    o = observations(spark, d).withColumn("subject", F.struct(form.alias("reference")))
    return forward.observation_outcomes(o, identities(spark, d), unit_rules(spark), policy(spark), [maps.EGFR_CODE]).select("id", "outcome", "person_iri")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        eligibility_routing, identity_resolution, identity_ambiguous, reference_resolution, code_typing, unit_resolution, materialize_quads, lineage_trace, graph_hash, result_for_person, pivot_round_trip,
        scoped_components, pair_multiset, panel_quads, pair_by_time, interval_open_end, pro_participants, participants, latest_version, current_graph, graph_diff, replay_pending, orphan_check, cross_patient_check,
        erroneous_check, exactly_one_check, invariant_check, time_forms, nquads, code_guard, ambiguous_rules, shape_outcomes, store_replay, store_retract, panel_graph_quads, lineage_quads, target_validation, encounter_routing,
        panel_routing, ledger_pending, axiom_closure, nested_elements, conformance_issues, graph_diff_by_hash, graph_set_hash, doubled_panels, injective_keys, normalised_identity)}


# --- the same in SQL, computed from the tables directly ----------------------------------------------------

_B = """
WITH b AS (
  SELECT event_id, 'egfr-' || event_id AS id, user_id, event_type, cast(cast(round(value * 100) AS BIGINT) AS VARCHAR) AS v, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS t,
         CASE WHEN user_id % 7 = 0 THEN 0 WHEN user_id % 11 = 0 THEN 2 ELSE 1 END AS nc FROM events),
o AS (
  SELECT *, list_filter([CASE WHEN event_type = 'error' THEN 'status' END, CASE WHEN event_type = 'view' THEN 'code' END, CASE WHEN nc <> 1 THEN 'identity' END, CASE WHEN event_type = 'signup' THEN 'unit' END], lambda x: x IS NOT NULL) AS reasons,
         CASE WHEN nc <> 1 OR event_type = 'signup' THEN 'rejected' WHEN event_type IN ('error', 'view') THEN 'source-only' ELSE 'mapped' END AS outcome FROM b),
m AS (
  SELECT *, event_id AS k, 'ex:person-' || user_id AS person, 'ex:renal-quality-' || user_id AS quality, 'ex:egfr-result-' || event_id AS result, 'ex:unit-' || event_type AS unit, 'ex:time-egfr-' || event_id AS tm,
         'ex:egfr-record-' || event_id AS rec, 'https://records.example/Observation/egfr-' || event_id || '/_history/1' AS src FROM o WHERE outcome = 'mapped'),
"""
_iri = [
    ("person", "rdf:type", "'ex:Person'"), ("person", "sulo:hasFeature", "quality"), ("quality", "rdf:type", "'sulo:Feature'"), ("quality", "rdf:type", "'ex:RenalFiltrationQuality'"), ("quality", "sulo:isFeatureOf", "person"),
    ("result", "rdf:type", "'sulo:Quantity'"), ("result", "rdf:type", "'ex:EGFRResult'"), ("result", "sulo:hasPart", "unit"), ("result", "sulo:refersTo", "quality"), ("result", "sulo:atTime", "tm"), ("result", "prov:wasDerivedFrom", "src"),
    ("unit", "rdf:type", "'sulo:Unit'"), ("tm", "rdf:type", "'sulo:TimeInstant'"), ("rec", "rdf:type", "'sulo:InformationObject'"), ("rec", "rdf:type", "'ex:ObservationRecord'"), ("rec", "sulo:refersTo", "result"), ("rec", "prov:wasDerivedFrom", "src"),
]
_lit = [("result", "v", "xsd:decimal"), ("unit", "'u-' || event_type", "xsd:string"), ("tm", "t", "xsd:dateTimeStamp")]
_Q = _B + "q AS (" + " UNION ALL ".join(
    [f"SELECT id, k, {s} AS s, '{p}' AS p, 'iri' AS o_kind, {o} AS o_value, NULL::VARCHAR AS o_datatype, {str(o[0] == chr(39)).lower()} AS is_constant FROM m" for s, p, o in _iri]
    + [f"SELECT id, k, {s}, 'sulo:hasValue', 'literal', {o}, '{t}', false FROM m" for s, o, t in _lit]) + ")\n"
_LINE = "s || ' ' || p || ' ' || CASE WHEN o_kind = 'literal' THEN '\"' || o_value || '\"' || CASE WHEN o_datatype = 'xsd:string' THEN '' ELSE '^^' || o_datatype END ELSE o_value END"
_L = """
WITH c AS (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'sys' WHEN 'N' THEN 'dia' ELSE 'other' END AS kind, cast(cast(l_quantity AS BIGINT) AS VARCHAR) AS value FROM lineitem),
p AS (
  SELECT cast(o_orderkey AS VARCHAR) AS id, any_value(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')) AS time, count(*) FILTER (kind = 'sys') AS n_systolic, count(*) FILTER (kind = 'dia') AS n_diastolic,
         CASE WHEN count(*) FILTER (kind = 'sys') = 1 THEN max(value) FILTER (kind = 'sys') END AS systolic, CASE WHEN count(*) FILTER (kind = 'dia') = 1 THEN max(value) FILTER (kind = 'dia') END AS diastolic, count(kind) AS n
  FROM orders LEFT JOIN c ON o_orderkey = l_orderkey GROUP BY o_orderkey)
"""
_E = "WITH e AS (SELECT 'enc-' || o_orderkey AS id, o_orderkey AS k, o_orderstatus AS st, o_custkey AS c, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS t FROM orders WHERE o_orderstatus <> 'P')\n"
_S = """
WITH p AS (SELECT user_id, max(event_id) AS seq FROM events {} GROUP BY user_id)
"""
_V = """
WITH r AS (SELECT user_id, max(event_id) AS seq FROM events GROUP BY user_id),
v AS (SELECT r.user_id, cast(r.user_id AS VARCHAR) AS resource_key, seq, CASE WHEN event_type <> 'error' THEN 'g-' || event_id END AS graph_key FROM r JOIN events ON event_id = seq)
"""
_P = """
WITH c AS (
  SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'sys' WHEN 'N' THEN 'dia' ELSE 'other' END AS kind, cast(cast(l_quantity AS BIGINT) AS VARCHAR) AS value FROM lineitem),
k AS (
  SELECT *, l_orderkey || '-' || kind || '-' || value || '-' || row_number() OVER (PARTITION BY l_orderkey, kind, value) AS key FROM c),
o AS (
  SELECT cast(o_orderkey AS VARCHAR) AS id, o_orderkey, 'ex:person-' || o_custkey AS person, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS t FROM orders),
j AS (SELECT id, person, kind, value, key FROM o JOIN k ON o_orderkey = l_orderkey)
""" + " UNION ALL ".join(
    f"SELECT id, {s} AS s, '{p}' AS p, '{'literal' if t else 'iri'}' AS o_kind, {o} AS o_value, {repr(t) if t else 'NULL::VARCHAR'} AS o_datatype FROM {table}"
    for table, s, p, o, t in (
        ("o", "'ex:bp-record-' || id", "rdf:type", "'sulo:InformationObject'", None), ("o", "'ex:bp-record-' || id", "rdf:type", "'ex:BloodPressurePanel'", None), ("o", "'ex:bp-record-' || id", "sulo:atTime", "'ex:time-bp-' || id", None),
        ("o", "'ex:bp-record-' || id", "prov:wasDerivedFrom", "'ex:src-' || id", None), ("o", "'ex:time-bp-' || id", "rdf:type", "'sulo:TimeInstant'", None), ("o", "'ex:time-bp-' || id", "sulo:hasValue", "t", "xsd:dateTimeStamp"),
        ("j", "'ex:bp-record-' || id", "sulo:refersTo", "'ex:bp-part-' || key", None), ("j", "'ex:bp-part-' || key", "rdf:type", "'ex:ComponentRecord'", None), ("j", "'ex:bp-part-' || key", "ex:componentKind", "kind", "xsd:string"),
        ("j", "'ex:bp-part-' || key", "sulo:hasValue", "value", "xsd:decimal"), ("j", "'ex:bp-part-' || key", "sulo:hasPart", "'ex:unit-piece'", None), ("j", "'ex:bp-part-' || key", "sulo:refersTo", "'ex:quality-' || key", None),
        ("j", "'ex:quality-' || key", "rdf:type", "'sulo:Feature'", None), ("j", "'ex:quality-' || key", "rdf:type", "'ex:PressureQuality'", None), ("j", "'ex:quality-' || key", "sulo:isFeatureOf", "person", None),
    ))


_PANELS = """WITH c AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_quantity > 45) AS bad FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY l_orderkey)
    SELECT cast(o_orderkey AS VARCHAR) AS id, CASE WHEN o_custkey % 7 = 0 OR o_custkey % 11 = 0 THEN 'rejected' WHEN n IS NULL THEN 'source-only' ELSE 'mapped' END AS outcome, coalesce(n, 0)::BIGINT AS n_parts, coalesce(bad, 0)::BIGINT AS n_issues
    FROM orders LEFT JOIN c ON o_orderkey = l_orderkey"""


def _nq(x: str) -> str:
    """The IRI of a prefixed name in SQL."""
    cases = " ".join(f"WHEN starts_with({x}, '{k}:') THEN '{v}' || substr({x}, {len(k) + 2})" for k, v in maps.PREFIXES.items())
    return f"('<' || CASE {cases} ELSE {x} END || '>')"


def oracle_sql() -> dict[str, str]:
    span = lambda where: f"SELECT 'g-' || event_id AS graph_key, 'ex:user-' || user_id AS s, event_type AS o_value FROM events WHERE event_type <> 'error' AND event_id IN (SELECT max(event_id) FROM events {where} GROUP BY user_id)"
    return {
        "eligibility_routing": _B + "r AS (SELECT outcome, unnest(CASE WHEN len(reasons) = 0 THEN [NULL] ELSE reasons END) AS reason FROM o) SELECT outcome, reason, count(*) AS n FROM r GROUP BY ALL",
        "identity_resolution": _B + "x AS (SELECT 1) SELECT id, CASE WHEN nc = 1 THEN 'ex:person-' || user_id END AS person_iri, nc::BIGINT AS n_candidates FROM b",
        "identity_ambiguous": _B + "x AS (SELECT 1) SELECT 'Patient/' || user_id AS reference, count(*) AS n FROM b WHERE nc > 1 GROUP BY user_id",
        "reference_resolution": "SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN 'https://records.example/Patient/' || c_custkey END AS target_key FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0) ON o_custkey = c_custkey",
        "code_typing": "SELECT event_id, CASE event_type WHEN 'click' THEN 'ex:Click' WHEN 'purchase' THEN 'ex:Purchase' END AS target_class, CASE event_type WHEN 'click' THEN 'm1' WHEN 'purchase' THEN 'm2' END AS map_id FROM events",
        "unit_resolution": "SELECT event_type, CASE WHEN event_type <> 'signup' THEN 'ex:unit-' || event_type END AS unit_iri, count(*) AS n FROM events GROUP BY ALL",
        "materialize_quads": _Q + "SELECT id, s, p, o_kind, o_value, o_datatype FROM q",
        "lineage_trace": _Q + "SELECT p, is_constant, count(*) AS n, count(*) AS traced, count(DISTINCT id) AS sources FROM q GROUP BY ALL",
        "graph_hash": _Q + f", l AS (SELECT DISTINCT id, {_LINE} AS line FROM q) SELECT id, sha256(string_agg(line, chr(10) ORDER BY line)) AS hash FROM l GROUP BY id",
        "result_for_person": _B + "x AS (SELECT 1) SELECT person, result, v AS value, 'u-' || event_type AS unit, t AS time FROM m",
        "pivot_round_trip": _B + "x AS (SELECT 1) SELECT id, unnest(['egfr:value', 'egfr:unitCode', 'egfr:effective']) AS var, unnest([v, 'u-' || event_type, t]) AS value FROM m",
        "scoped_components": _L + "SELECT id, systolic, diastolic, n_systolic, n_diastolic FROM p",
        "pair_multiset": _L + "SELECT systolic AS left_value, diastolic AS right_value, count(*) AS n FROM p WHERE n_systolic = 1 AND n_diastolic = 1 GROUP BY ALL",
        "panel_quads": _L + """, n AS (SELECT count(*) AS panels, sum(n)::BIGINT AS parts, count(*) FILTER (n > 0) AS used FROM p)
            SELECT 'rdf:type' AS p, 'iri' AS o_kind, 3 * panels + 3 * parts AS n, 2 * panels + 2 * parts AS subjects FROM n
            UNION ALL SELECT 'sulo:refersTo', 'iri', 2 * parts, parts + used FROM n UNION ALL SELECT 'sulo:atTime', 'iri', panels, panels FROM n UNION ALL SELECT 'prov:wasDerivedFrom', 'iri', panels, panels FROM n
            UNION ALL SELECT 'sulo:hasValue', 'literal', panels + parts, panels + parts FROM n UNION ALL SELECT 'ex:componentKind', 'literal', parts, parts FROM n
            UNION ALL SELECT 'sulo:hasPart', 'iri', parts, parts FROM n UNION ALL SELECT 'sulo:isFeatureOf', 'iri', parts, parts FROM n""",
        "pair_by_time": _L + "SELECT 'graph:bp-' || id AS panel, time, systolic, diastolic FROM p WHERE systolic IS NOT NULL AND diastolic IS NOT NULL",
        "interval_open_end": _E + """
            SELECT id, 'ex:interval-' || id AS s, 'rdf:type' AS p, 'iri' AS o_kind, 'sulo:TimeInterval' AS o_value, NULL AS o_datatype FROM e UNION ALL SELECT id, 'ex:interval-' || id, 'sulo:hasPart', 'iri', 'ex:start-' || id, NULL FROM e
            UNION ALL SELECT id, 'ex:start-' || id, 'rdf:type', 'iri', 'sulo:StartTime', NULL FROM e UNION ALL SELECT id, 'ex:start-' || id, 'sulo:hasValue', 'literal', t, 'xsd:dateTimeStamp' FROM e
            UNION ALL SELECT id, 'ex:interval-' || id, 'sulo:hasPart', 'iri', 'ex:end-' || id, NULL FROM e WHERE st = 'F' UNION ALL SELECT id, 'ex:end-' || id, 'rdf:type', 'iri', 'sulo:EndTime', NULL FROM e WHERE st = 'F'
            UNION ALL SELECT id, 'ex:end-' || id, 'sulo:hasValue', 'literal', t, 'xsd:dateTimeStamp' FROM e WHERE st = 'F'""",
        "pro_participants": _E + "SELECT 'ex:encounter-' || k AS s, 'sulo:hasParticipant' AS p, 'ex:person-' || c AS o_value FROM e UNION ALL SELECT 'ex:encounter-' || k, 'sulo:hasParticipant', 'ex:clinician-' || (c % 10) FROM e",
        "participants": _E + "SELECT 'ex:encounter-' || k AS process, 'ex:PatientRole' AS role_type, 'ex:person-' || c AS person FROM e UNION ALL SELECT 'ex:encounter-' || k, 'ex:ClinicianRole', 'ex:clinician-' || (c % 10) FROM e",
        "latest_version": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1",
        "current_graph": span(""),
        "graph_diff": f"WITH a AS ({span('WHERE event_id * 2 < (SELECT max(event_id) FROM events)')}), b AS ({span('')}), d AS (SELECT 'removed' AS change, o_value FROM (FROM a EXCEPT FROM b) UNION ALL SELECT 'added', o_value FROM (FROM b EXCEPT FROM a)) SELECT change, o_value, count(*) AS n FROM d GROUP BY ALL",
        "replay_pending": "SELECT event_id FROM events WHERE NOT (event_id % 3 = 0 AND event_id % 2 = 0)",
        "orphan_check": _B + "x AS (SELECT 1) SELECT unit, count(*) AS n FROM m WHERE k % 10 = 1 GROUP BY unit",
        "cross_patient_check": _B + "x AS (SELECT 1) SELECT result AS s, person, 'ex:person-x' AS person_iri FROM m WHERE k % 9 = 4",
        "erroneous_check": _Q + "SELECT p, count(*) AS n FROM q WHERE k % 8 = 2 GROUP BY p",
        "exactly_one_check": _B + "x AS (SELECT 1) SELECT result AS s, 0::BIGINT AS n FROM m WHERE k % 10 = 3",
        "invariant_check": _B + "x AS (SELECT 1) SELECT 'forbidden-predicate' AS violation, count(*) AS n FROM m WHERE person LIKE '%3' UNION ALL SELECT 'undeclared-class', count(*) FROM m",
        "nquads": _Q + f"SELECT {_nq('s')} || ' ' || {_nq('p')} || ' ' || CASE WHEN o_kind = 'iri' THEN {_nq('o_value')} ELSE '\"' || o_value || '\"' || CASE WHEN o_datatype = 'xsd:string' THEN '' ELSE '^^' || {_nq('o_datatype')} END END || ' <urn:graph:' || sha256('[\"https://records.example\",\"Observation\",\"' || id || '\",\"1\",\"egfr\"]') || '> .' AS value FROM q",
        "code_guard": _B + """x AS (SELECT id, nc, event_type, list_filter([CASE WHEN event_type = 'error' THEN 'status' END, CASE WHEN event_type = 'view' OR event_id % 3 = 0 THEN 'code' END, CASE WHEN nc <> 1 THEN 'identity' END,
            CASE WHEN event_type = 'signup' THEN 'unit' END], lambda x: x IS NOT NULL) AS r FROM b)
            SELECT id, CASE WHEN nc <> 1 OR event_type = 'signup' THEN 'rejected' WHEN len(r) > 0 THEN 'source-only' ELSE 'mapped' END AS outcome, array_to_string(r, ' ') AS reasons FROM x""",
        "ambiguous_rules": _B + """x AS (SELECT nc, event_type, list_filter([CASE WHEN event_type = 'error' THEN 'status' END, CASE WHEN event_type = 'view' THEN 'code' END, CASE WHEN nc <> 1 THEN 'identity' END,
            CASE WHEN event_type IN ('signup', 'purchase') THEN 'unit' END], lambda x: x IS NOT NULL) AS r FROM b),
            y AS (SELECT CASE WHEN nc <> 1 OR event_type IN ('signup', 'purchase') THEN 'rejected' WHEN len(r) > 0 THEN 'source-only' ELSE 'mapped' END AS outcome, unnest(CASE WHEN len(r) = 0 THEN [NULL] ELSE r END) AS reason FROM x)
            SELECT outcome, reason, count(*) AS n FROM y GROUP BY ALL""",
        "shape_outcomes": _B + """x AS (SELECT CASE WHEN nc <> 1 OR event_type = 'signup' THEN 'rejected' WHEN event_type IN ('error', 'view', 'purchase') THEN 'source-only' ELSE 'mapped' END AS outcome, event_type FROM b)
            SELECT outcome, count(*) AS n, count(*) FILTER (outcome = 'mapped') AS graphs, count(*) FILTER (outcome = 'source-only' AND event_type = 'purchase') AS shapes FROM x GROUP BY outcome""",
        "store_replay": _V + "SELECT resource_key, seq, graph_key, CASE WHEN user_id % 3 = 0 THEN 'r2' ELSE 'r1' END AS run_id FROM v",
        "store_retract": _V + """SELECT resource_key, CASE WHEN user_id % 10 = 0 THEN seq + 1 ELSE seq END AS seq, CASE WHEN user_id % 10 = 0 THEN 'n-' || resource_key WHEN user_id % 5 <> 0 THEN graph_key END AS graph_key,
            CASE WHEN user_id % 10 = 0 THEN 'r3' WHEN user_id % 5 = 0 THEN 'r2' ELSE 'r1' END AS run_id FROM v""",
        "panel_graph_quads": _P,
        "lineage_quads": _Q + f"SELECT id, s, p, o_value, is_constant, is_constant AS no_variable, 'https://records.example/Observation/' || id || '/_history/1' AS source_version, '{maps.egfr().pair_hash}' AS pair_hash, 'run-1' AS run_id FROM q",
        "target_validation": _B + "x AS (SELECT 1) SELECT 'Result: sulo:hasValue isn''t there 1 times' AS violation, count(*) AS n FROM m WHERE k % 10 = 3 UNION ALL SELECT 'Result: sulo:hasValue isn''t xsd:decimal', count(*) FROM m WHERE k % 10 = 5",
        "encounter_routing": """WITH x AS (SELECT 'enc-' || o_orderkey AS id, o_orderstatus = 'P' AS s, o_custkey % 7 = 0 OR o_custkey % 11 = 0 OR o_custkey % 10 = 9 AS i FROM orders)
            SELECT id, CASE WHEN i THEN 'rejected' WHEN s THEN 'source-only' ELSE 'mapped' END AS outcome, concat_ws(' ', CASE WHEN s THEN 'status' END, CASE WHEN i THEN 'identity' END) AS reasons FROM x""",
        "panel_routing": _PANELS,
        "doubled_panels": "SELECT *, 2::BIGINT AS n FROM (" + _PANELS + ")",
        "ledger_pending": "SELECT event_id FROM events WHERE event_id % 4 = 3 OR event_id % 5 = 0",
        "axiom_closure": _E.replace("WITH e AS", "WITH RECURSIVE e AS", 1) + """, ax(a, b, c) AS (VALUES """ + ", ".join(f"('{a}', '{b}', '{c}')" for k, a, b, c in AXIOMS if k == "chain") + """),
            base AS (
              SELECT 'ex:encounter-' || k AS s, 'sulo:hasParticipant' AS p, 'ex:patient-role-enc-' || k AS o FROM e UNION SELECT 'ex:encounter-' || k, 'sulo:hasParticipant', 'ex:clinician-role-enc-' || k FROM e
              UNION SELECT 'ex:patient-role-enc-' || k, 'sulo:isFeatureOf', 'ex:person-' || c FROM e UNION SELECT 'ex:clinician-role-enc-' || k, 'sulo:isFeatureOf', 'ex:clinician-' || (c % 10) FROM e
              UNION SELECT 'ex:person-' || c_custkey, 'ex:memberOf', 'ex:nation-' || c_nationkey FROM customer UNION SELECT 'ex:nation-' || n_nationkey, 'ex:partOf', 'ex:region-' || n_regionkey FROM nation),
            f AS (SELECT s, p, o FROM base UNION SELECT f.s, ax.c, b.o FROM f JOIN ax ON f.p = ax.a JOIN base b ON b.p = ax.b AND b.s = f.o),
            x AS (FROM f EXCEPT FROM base)
            SELECT s, p, o FROM x UNION SELECT o, 'ex:siteOf', s FROM x WHERE p = 'ex:locatedIn'""",
        "nested_elements": """WITH l AS (SELECT l.* FROM lineitem l JOIN orders ON o_orderkey = l_orderkey)
            SELECT 'Observation' AS kind, 'component.code.coding.userSelected' AS path, 'unknown' AS finding, count(DISTINCT l_orderkey) AS n FROM l WHERE l_linenumber = 1
            UNION ALL SELECT 'Observation', 'component.note', 'unknown', count(DISTINCT l_orderkey) FROM l WHERE l_returnflag = 'R' UNION ALL SELECT 'Observation', 'component.modifierExtension', 'modifier', count(DISTINCT l_orderkey) FROM l WHERE l_quantity > 45
            UNION ALL SELECT 'Observation', 'component.note.modifierExtension', 'modifier', count(DISTINCT l_orderkey) FROM l WHERE l_returnflag = 'R' AND l_linenumber = 2""",
        "conformance_issues": """WITH c AS (SELECT l_orderkey, count(*) AS n, bool_or(l_returnflag = 'R') AS r, bool_or(l_linenumber >= 6) AS no, bool_or(l_linenumber = 3) AS w, bool_or(l_quantity > 45) AS q FROM lineitem GROUP BY l_orderkey)
            SELECT CASE WHEN o_orderstatus = 'P' THEN 'order ' ELSE 'order-' END || o_orderkey AS id, concat_ws('; ', CASE WHEN o_orderstatus = 'P' THEN 'id: type' END, CASE WHEN n IS NULL OR n > 4 THEN 'component: number' END,
            CASE WHEN r THEN 'component.code.coding: number' END, CASE WHEN no THEN 'component.valueQuantity.value: number' END, CASE WHEN w THEN 'component.valueQuantity.value: type' END, CASE WHEN q THEN 'component.valueQuantity.code: value' END) AS issues
            FROM orders LEFT JOIN c ON o_orderkey = l_orderkey""",
        "graph_diff_by_hash": """WITH q AS (SELECT 'graph:' || user_id AS graph_key, 'ex:event-' || event_id AS s, event_type AS o_value, event_id FROM events),
            a AS (SELECT graph_key, s, o_value FROM q WHERE event_id * 2 < (SELECT max(event_id) FROM events)), b AS (SELECT graph_key, s, o_value FROM q WHERE o_value <> 'error')
            SELECT 'removed' AS change, * FROM (FROM a EXCEPT FROM b) UNION ALL SELECT 'added', * FROM (FROM b EXCEPT FROM a)""",
        "graph_set_hash": _Q + """, l AS (SELECT DISTINCT id, '{"s":"' || s || '","p":"' || p || '","o_kind":"' || o_kind || '","o_value":"' || o_value || '","o_datatype":' || coalesce('"' || o_datatype || '"', 'null') || '}' AS line FROM q),
            h AS (SELECT id, sha256(line) AS h FROM l)
            SELECT id, count(*) || '-' || sum(('0x' || substr(h, 1, 15))::BIGINT)::HUGEINT || '-' || sum(('0x' || substr(h, 16, 15))::BIGINT)::HUGEINT AS h FROM h GROUP BY id""",
        "injective_keys": _B + "x AS (SELECT unnest(['ex:egfr-result-' || event_id, 'ex:egfr-result-~.' || event_id]) AS node FROM m) SELECT node, 1::BIGINT AS records, 0::BIGINT AS collisions FROM x",
        "normalised_identity": _B + "x AS (SELECT 1) SELECT id, outcome, CASE WHEN nc = 1 THEN 'ex:person-' || user_id END AS person_iri FROM o",
        "time_forms": "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'year' WHEN 1 THEN 'month' WHEN 2 THEN 'day' ELSE 'instant' END AS precision FROM events",
    }
