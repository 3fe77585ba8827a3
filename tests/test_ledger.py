"""The run ledger, repeated and version-less records, snapshots, entailment, nested elements, profiles, diffs and keys."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from loomgraph import maps, queries
from loomgraph import run as running
from loomgraph.functions import terms
from loomgraph.operators import elements, graph, routing, state
from loomgraph.operators.closure import closure
from loomgraph.plans import forward
from loomgraph.plans.contract import MapContract
from loomgraph.sources import records
from loomgraph.sources.scratch import stored
from loomgraph.sources.store import TABLES, GraphStore

from test_records import FIXTURES, QUADS, RULES

AXIOMS = "kind string, a string, b string, c string"


def lines(name):
    return [json.loads(x) for x in (FIXTURES / "r4" / f"{name}.json").read_text().splitlines()]


@pytest.fixture
def place(spark, tmp_path):
    """An input folder, rules and a store."""
    (tmp_path / "in").mkdir()
    (tmp_path / "rules").mkdir()
    for name, rows in RULES.items():
        columns = [c.split()[0] for c in records.RULES[name].split(", ")]
        said = [dict(zip(columns, r, strict=False)) | ({"evidence": "seen"} if name == "identity_map" else {"snapshot": "s1"} if name.endswith("_rule") else {}) for r in rows]
        (tmp_path / "rules" / f"{name}.json").write_text("\n".join(map(json.dumps, said)))

    class Place:
        source, rules, folder = tmp_path / "in", tmp_path / "rules", f"file://{tmp_path}/store"

        def put(self, name, *rows):
            (self.source / name).write_text("\n".join(map(json.dumps, rows)))

        def run(self, **more):
            return running.run(spark, f"file://{self.source}", f"file://{self.rules}", self.folder, **more)

        @property
        def store(self):
            return GraphStore(spark, self.folder)

        def sizes(self):
            return {name: self.store.table(name).count() for name in TABLES}

    return Place()


def test_a_second_run_adds_no_row(place, monkeypatch):
    """Late old versions, repeated lines, records that several maps fit, and retracted ones."""
    first = lines("egfr")[0]
    version = lambda v, x: first | {"meta": {"versionId": v}, "valueQuantity": first["valueQuantity"] | {"value": x}}
    enc = lines("encounter")[0]
    place.put("a.json", version("2", 60.0), version("2", 60.0), enc)
    place.run()
    value = lambda: [r.o_value for r in place.store.current().where("s = 'ex:egfr-result-456' and p = 'sulo:hasValue'").collect()]
    assert value() == ["60.0"] and place.store.table("run_record").count() == 2
    record = place.store.table("run_record").where("map_id = 'egfr'").first()
    assert record.evidence == "seen" and record.snapshots == "s1"
    place.put("b.json", version("1", 50.0))
    late = place.run()
    assert late["outcomes"] and value() == ["60.0"]
    sizes = place.sizes()
    assert sizes["commit_log"] == 2 and sizes["run_record"] == 3
    assert place.run()["outcomes"] == [] and place.sizes() == sizes
    # a retraction stands, and isn't undone by the same input
    place.store.retract(place.store.pointer().where("resource_key like '%egfr-456'").select("resource_key"), "r", 99)
    sizes = place.sizes()
    place.run()
    assert value() == [] and place.sizes() == sizes
    both = MapContract("bp", maps.blood_pressure().spec | {"codes": maps.egfr().spec["codes"]}, "other")
    monkeypatch.setattr(maps, "blood_pressure", lambda: both)
    place.put("c.json", lines("egfr")[0] | {"id": "egfr-two-maps"})
    place.run(run_seq=100)
    assert [r.reasons for r in place.store.table("outcomes").where("resource_key like '%two-maps'").collect()] == [["map"]]
    sizes = place.sizes()
    assert place.run(run_seq=101)["outcomes"] == [] and place.sizes() == sizes


@pytest.mark.parametrize("n", [5, 8])
def test_a_run_that_dies_between_two_writes_is_done_anew(place, monkeypatch, n):
    place.put("e.json", lines("encounter")[0])
    append, calls = GraphStore.append, []

    def failing(self, name, df):
        if len(calls) == n:
            raise ZeroDivisionError
        calls.append(name)
        append(self, name, df)

    with monkeypatch.context() as m:
        m.setattr(GraphStore, "append", failing)
        with pytest.raises(ZeroDivisionError):
            place.run()
    assert n < 8 or calls[-1] == "current_pointer"
    assert place.store.committed().count() == 0
    place.run()
    assert place.store.current().count() == 18 and place.store.committed().count() == 1
    sizes = place.sizes()
    place.run()
    assert place.sizes() == sizes and sizes["commit_log"] == 1
    assert {(r.p, r.o_value) for r in place.store.inferred().collect()} == {("sulo:hasParticipant", "ex:person-p123"), ("sulo:hasParticipant", "ex:clinician-c7")}


def test_snapshots_of_the_pointer(spark, tmp_path, monkeypatch):
    store = GraphStore(spark, f"file://{tmp_path}/store")
    say = lambda seq, key, outcome="mapped": spark.createDataFrame([("r", seq, key, outcome), (f"r{seq}", seq, f"x{key}", outcome)], "resource_key string, seq long, graph_key string, outcome string")
    now = lambda: sorted((r.resource_key, r.graph_key) for r in state.latest(store.pointer(), "resource_key", *state.ORDER).collect())
    assert store.snapshot() is None
    for i in (1, 2):
        store.switch(say(i, f"g{i}"), f"run{i}", i)
        store.commit(f"run{i}", i)
    want = now()
    assert store.snapshot() == 2 and store.snapshot() is None and now() == want
    tail = store.pointer().where("run_seq > 2")
    assert tail.count() == 0 and store.pointer().count() == 3  # the snapshot alone
    store.switch(say(3, "g3"), "run3", 3)  # not yet in the log: no part of a snapshot, and read from the tail
    assert store.snapshot() is None and ("r", "g3") in now()
    store.commit("run3", 3)
    want, append = now(), GraphStore.append

    def failing(self, name, df):
        if name == "snapshot_log":
            raise ZeroDivisionError
        append(self, name, df)

    with monkeypatch.context() as m:
        m.setattr(GraphStore, "append", failing)
        with pytest.raises(ZeroDivisionError):
            store.snapshot()
    assert now() == want and store.table("pointer_snapshot").where("upto = 3").count() == 4
    assert store.snapshot() == 3 and now() == want


def test_records_without_a_version_keep_their_own_components(spark, place):
    panel = lines("bp")[0]
    bare = {k: v for k, v in panel.items() if k != "meta"}
    other = json.loads(json.dumps(bare))
    other["component"][0]["valueQuantity"]["value"] = 99
    place.put("a.json", bare, bare, other)
    place.run()
    graphs = place.store.table("quads_history").where("map_id = 'bp'").groupBy("graph_key").count().collect()
    assert [r["count"] for r in graphs] == [24, 24]
    assert place.store.current().where("map_id = 'bp'").count() == 24 and place.store.table("run_record").count() == 2
    tables = records.read_rules(spark, f"file://{place.rules}")
    rows = records.read_json(spark, f"file://{place.source}", "Observation")
    out = forward.panel_outcomes(rows, tables["identity_map"], tables["unit_rule"], tables["status_policy"]).select("component.key").collect()
    assert len(out) == 3 and all(sorted(r.key) == ["bp-1-diastolic", "bp-1-systolic"] for r in out)


def test_components_may_come_in_another_order_each_time(spark, place):
    panel = lines("bp")[0]
    panels = [json.loads(json.dumps(panel)) | {"id": f"bp-{i}"} for i in range(40)]
    for x in panels:
        x["component"] *= 3
    place.put("a.json", *panels)
    tables = records.read_rules(spark, f"file://{place.rules}")
    rows = records.read_json(spark, f"file://{place.source}", "Observation")
    mixed = F.udf(lambda c: random.sample(c, len(c)), rows.schema["component"].dataType).asNondeterministic()
    out = forward.panel_outcomes(rows.withColumn("component", mixed("component")), tables["identity_map"], tables["unit_rule"], tables["status_policy"])
    assert [r.n for r in out.select(F.size("component").alias("n")).collect()] == [6] * 40


def test_profiles_and_nested_elements_decide(place):
    first = lines("egfr")[0]
    sly = json.loads(json.dumps(first)) | {"id": "egfr-sly"}
    sly["valueQuantity"]["modifierExtension"] = [{"url": "urn:m"}]
    odd = json.loads(json.dumps(first)) | {"id": "egfr-odd"}
    odd["code"]["coding"][0]["userSelected"] = True
    far = json.loads(json.dumps(first)) | {"id": "egfr-far", "subject": {"reference": f"{forward.SERVER}/Patient/p123/_history/7"}}
    place.put("a.json", first, sly, odd, far, first | {"id": "egfr-no", "issued": "soon"})
    constraints = [{"kind": "Observation", "path": "issued", "least": 0, "most": 1, "type": "time"}, {"kind": "Observation", "path": "code.coding.system", "least": 1, "most": 1, "values": [maps.LOINC]}]
    (place.rules / "profiles.json").write_text("\n".join(map(json.dumps, constraints)))
    out = place.run()
    assert {(x["element"], x["n"]) for x in out["unknown"]} == {("code.coding.userSelected", 1), ("valueQuantity.modifierExtension", 1)}
    got = {r.resource_key.split("/")[-1]: (r.outcome, r.reasons) for r in place.store.table("outcomes").collect()}
    assert got == {
        "egfr-456": ("mapped", []), "egfr-odd": ("mapped", []), "egfr-far": ("mapped", []), "egfr-sly": ("source-only", ["nested-modifier"]), "egfr-no": ("rejected", ["profile"]),
    }
    counts = {(r.outcome, r.reason): r.n for r in routing.outcome_counts(place.store.table("outcomes")).collect()}
    assert {(x["outcome"], x["reason"]): x["n"] for x in out["outcomes"]} == counts


def test_conformance_looks_into_every_repetition(spark):
    schema = "id string, tag array<string>, part array<struct<code:struct<coding:array<struct<system:string>>>,value:string>>, one struct<x:string>"
    rows = [
        ("ok", ["a"], [(([("s",)],), "1.0")], ("a",)), ("no list", None, None, None), ("empty", [], [], (None,)), ("second", ["a", "b", "c"], [(([("s",)],), "1"), (([("s",), ("t",)],), "x"), (None, None)], ("b",)), ("null part", ["z"], [None], None),
        (None, [None], [((None,), "2")], ("a",)),
    ]
    df = spark.createDataFrame(rows, schema)
    rules = [
        {"path": "id", "least": 1, "most": 1}, {"path": "tag", "least": 1, "most": 2, "values": ["a", "b"]}, {"path": "part.value", "least": 1, "type": "decimal"}, {"path": "part.code.coding", "least": 1}, {"path": "part.code.coding.system", "values": ["s"]},
        {"path": "one.x", "least": 1, "values": ["a"]},
    ]
    got = {r.id: r.i for r in df.select("id", elements.issues(df.schema, rules).alias("i")).collect()}
    assert got == {
        "ok": [], "no list": ["tag: number"], "empty": ["tag: number", "one.x: number"], "null part": ["tag: value"], None: ["id: number", "part.code.coding: number"],
        "second": ["tag: number", "tag: value", "part.value: number", "part.value: type", "part.code.coding.system: value", "one.x: value"],
    }
    assert df.select(elements.issues(df.schema, [])).first()[0] == []
    with pytest.raises(Exception, match="nothing"):
        elements.issues(df.schema, [{"path": "part.nothing", "least": 1}])


def test_elements_at_any_level(spark):
    rows = [("1", '{"a":{"b":[{"c":1},{"c":2,"d":[]}]},"e":null}'), ("2", '{"a":[]}'), ("3", "not json"), ("4", None), ("5", '{"x":{"x":{"x":{"x":1}}}}'), ("6", '[{"modifierExtension":[{"url":"u"}]},{"contained":[{"q":1}]}]')]
    df = spark.createDataFrame(rows, "id string, raw string").withColumn("kind", F.lit("k"))
    found = elements.elements(df, "raw", "kind", "id", depth=4)
    got = {}
    for r in found.collect():
        got.setdefault(r.id, set()).add(r.path)
    assert got == {"1": {"a", "a.b", "a.b.c", "a.b.d", "e"}, "2": {"a"}, "5": {"x", "x.x", "x.x.x", "x.x.x.x"}, "6": {"modifierExtension", "modifierExtension.url", "contained", "contained.q"}}
    deep = {r.path for r in elements.elements(df.where("id = '5'"), "raw", "id", depth=2).collect()}
    assert deep == {"x", "x.x", f"x.x.{elements.DEEPER}"}
    report = elements.inventory(found, ["k:a", "k:a.b", "k:e", "k:contained"])
    assert {(r.path, r.finding, r.n) for r in report.collect()} == {("a.b.c", "unknown", 1), ("a.b.d", "unknown", 1), ("x", "unknown", 1), ("modifierExtension", "unknown", 1), ("modifierExtension", "modifier", 1)}
    assert elements.schema_paths(records.read_json(spark, f"file://{FIXTURES}/r4/bp.json", "Observation").schema)[:3] == ["resourceType", "id", "meta"]


def test_closure_is_a_fixpoint(spark):
    n = 20
    facts = [(g, f"n{i}", "next", f"n{i + 1}") for g in ("g", "h") for i in range(n if g == "g" else 2)] + [("g", "n20", "next", "n0"), ("h", "n9", "next", "n0"), ("g", "q", "other", "z"), ("g", None, "next", "n0")]
    df = spark.createDataFrame(facts, "graph_key string, s string, p string, o string")
    axioms = spark.createDataFrame([("chain", "next", "next", "next"), ("inverse", "next", "back", None), ("inverse", "next", "back", None), ("disjoint", "next", "back", None), ("chain", "next", None, "x")], AXIOMS)
    out = {tuple(r) for r in closure(df.unionByName(df), axioms, ("graph_key",)).collect()}

    def brute():
        known = {f for f in facts if f[1]}
        while True:
            new = {(g, a, "next", d) for g, a, p, b in known if p == "next" for h, c, q, d in known if g == h and b == c and q == "next"}
            new |= {(g, o, {"next": "back", "back": "next"}[p], s) for g, s, p, o in known if p in ("next", "back")}
            if new <= known:
                return known - set(facts)
            known |= new

    assert out == brute()
    assert closure(df, spark.createDataFrame([], AXIOMS), ("graph_key",)).count() == 0 and closure(df.limit(0), axioms, ("graph_key",)).count() == 0


@pytest.mark.parametrize("hub", [0, 2])
def test_closure_with_things_that_many_facts_point_to(spark, monkeypatch, hub):
    monkeypatch.setattr("loomgraph.operators.closure.HUB", hub)
    facts = [(f"x{i}", "a", f"y{i % 3}") for i in range(20)] + [(f"y{i}", "b", f"z{j}") for i in range(2) for j in range(3)] + [("x1", "k", "z1"), ("z1", "q", "x0")]
    axioms = [("chain", "a", "b", "k"), ("chain", "k", "q", "said"), ("inverse", "k", "l", None)]
    found = closure(spark.createDataFrame([*facts, ("x1", "said", "x0")], "s string, p string, o string"), spark.createDataFrame(axioms, "kind string, a string, b string, c string")).collect()
    k = {(s, o) for s, p, m in facts if p == "a" for n, q, o in facts if q == "b" and n == m} | {("x1", "z1")}
    want = {(s, "k", o) for s, o in k} | {(o, "l", s) for s, o in k} | {(s, "said", "x0") for s, o in k if o == "z1"}
    assert sorted(tuple(r) for r in found) == sorted(want - {("x1", "k", "z1"), ("x1", "said", "x0")})


def _shuffled(spark):
    """Bytes that the session has shuffled so far, and the shuffle files that are still there."""
    jsc, env = spark._jsc.sc(), spark._jvm.org.apache.spark.SparkEnv.get()
    spark.range(1).collect()
    time.sleep(1)
    jsc.listenerBus().waitUntilEmpty()
    return jsc.statusStore().executorList(True).head().totalShuffleWrite(), sum(f.getName().startswith("shuffle_") for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(env.blockManager().diskBlockManager().getAllFiles()))


def test_closure_shuffles_few_facts_and_keeps_none(spark, monkeypatch):
    """What is shuffled must not grow with the rounds: each joins what is new, and none of it stays when it ends."""
    monkeypatch.setattr("loomgraph.operators.closure.HUB", 500)
    n = 6000
    many = spark.range(n).select(F.explode(F.array(*[F.struct(*[F.format_string(x, "id").alias(k) for k, x in zip("spo", each, strict=True)]) for each in (
        ("e-%s", "has", "role-%s"), ("role-%s", "of", "who-%s"), ("who-%s", "member", "nation"))])).alias("x")).select("x.*")
    facts = stored(many.unionByName(spark.createDataFrame([("nation", "part", "region")], "s string, p string, o string")))
    axioms = spark.createDataFrame([("chain", "has", "of", "has"), ("chain", "has", "member", "involves"), ("chain", "involves", "part", "in"), ("inverse", "in", "site", None)], "kind string, a string, b string, c string")
    start = _shuffled(spark)[0]
    facts.repartition("s", "p", "o").distinct().write.format("noop").mode("overwrite").save()
    (before, files), want = _shuffled(spark), set()
    found = closure(facts, axioms)
    after, left = _shuffled(spark)
    for i in range(n):
        want |= {(f"e-{i}", "has", f"who-{i}"), (f"e-{i}", "involves", "nation"), (f"e-{i}", "in", "region"), ("region", "site", f"e-{i}")}
    assert {tuple(r) for r in found.collect()} == want and found.count() == len(want)
    assert 0 < after - before < 8 * (before - start) and left <= files, (start, before, after, files, left)


@pytest.mark.parametrize("hub", [0, 3, 20_000])
def test_closure_of_mixed_axioms_equals_brute_force(spark, monkeypatch, hub):
    """Things of any names, chains over predicates that others say, inverses of inverses, symmetric ones, and facts that are known."""
    monkeypatch.setattr("loomgraph.operators.closure.HUB", hub)
    draw = random.Random(hub + 7)
    facts = {(draw.choice("gh"), f"{draw.choice('az')}{draw.randrange(6)}", draw.choice(["p", "q", "r", "t", "other"]), f"{draw.choice('ak')}{draw.randrange(6)}") for _ in range(60)}
    axioms = [("chain", "p", "q", "r"), ("chain", "r", "u", "t"), ("chain", "t", "t", "v"), ("inverse", "q", "u", None), ("inverse", "u", "w", None), ("inverse", "v", "v", None), ("chain", "p", "none", "p")]
    turns = {x for k, a, b, _ in axioms if k == "inverse" for x in ((a, b), (b, a))}
    known = set(facts)
    while True:
        new = {(g, s, c, z) for g, s, p, o in known for h, y, q, z in known if g == h and o == y for k, a, b, c in axioms if k == "chain" and (a, b) == (p, q)}
        new |= {(g, o, b, s) for g, s, p, o in known for a, b in turns if a == p}
        if new <= known:
            break
        known |= new
    df = spark.createDataFrame(sorted(facts) * 2, "graph_key string, s string, p string, o string")
    out = [tuple(r) for r in closure(df, spark.createDataFrame(axioms, "kind string, a string, b string, c string"), ("graph_key",)).collect()]
    assert sorted(out) == sorted(known - facts)


def test_tasks_have_few_records(spark, monkeypatch):
    """However many there are: what a task holds must not grow with the tables."""
    monkeypatch.setattr("loomgraph.queries.TASK_ROWS", 500)
    d = "/root/testdata/sf0.01"
    rows = {"outcomes": queries.quads(spark, d), "encounters": queries._encounter_quads(spark, d), "panels": queries.panels(spark, d)}
    for name, df in rows.items():
        most = df.groupBy(F.spark_partition_id()).agg(F.count_distinct("id").alias("n")).agg(F.max("n")).first()[0]
        assert most <= 700, name


def test_two_level_diff_and_hashes(spark):
    quad = lambda g, o: (g, "s", "p", "literal", o, None)
    old = spark.createDataFrame([quad("same", "1"), quad("same", "2"), quad("less", "1"), quad("less", "2"), quad("gone", "1"), quad("twice", "1"), quad("twice", "1")], QUADS)
    new = spark.createDataFrame([quad("same", "2"), quad("same", "1"), quad("less", "1"), quad("new", "1"), quad("twice", "1")], QUADS)
    rows = lambda pair: [sorted((r.graph_key, r.o_value) for r in x.collect()) for x in pair]
    assert rows(graph.graph_diff_by_hash(old, new)) == rows(graph.graph_diff(old, new)) == [[("gone", "1"), ("less", "2")], [("new", "1")]]
    plan = graph.graph_diff_by_hash(old, new)[0]
    assert plan.count() == 2
    bad = spark.createDataFrame([("g", f"s{i}", "v") for i in range(50)] + [("g", "s1", "v"), (None, "s", "v")], "graph_key string, s string, violation string")
    digest = graph.validation_digest(bad)
    assert digest == graph.validation_digest(bad.orderBy(F.desc("s")).repartition(7)) and digest != graph.validation_digest(bad.distinct()) and len(digest) == 64
    assert digest != graph.validation_digest(bad.withColumn("s", F.regexp_replace("s", "^s7$", "s8"))) and graph.validation_digest(bad.limit(0)) != digest


def test_keys_are_injective(spark):
    ids = ["egfr-1", "1", "egfr-", "", "egfr-egfr-1", "~.1", "egfr-~.1", "~~.1", "a-b", "egfr-a-b", "egfr-~~.1", "~.~.1", None]
    rows = spark.createDataFrame([(i,) for i in ids], "id string").select("id", terms.local_id(F.col("id"), "egfr-").alias("k")).collect()
    assert {r.id: r.k for r in rows}["egfr-1"] == "1" and len({r.k for r in rows if r.id is not None}) == len(ids) - 1 and {r.k for r in rows if r.id is None} == {None}
    refs = spark.createDataFrame([("Patient/a",), ("https://h/Patient/a",), ("Patient/a/_history/2",), ("https://h/Patient/a/_history/2",), ("#p",), ("https://other/Patient/a",), (None,)], "r string").select(terms.relative_ref(F.col("r"), "https://h"))
    assert [r[0] for r in refs.collect()] == ["Patient/a"] * 4 + ["#p", "https://other/Patient/a", None]


def test_maps_with_two_codes_keep_their_other_guards(spark):
    m = MapContract("egfr", maps.egfr().spec | {"codes": [*maps.egfr().spec["codes"], [maps.LOINC, "other"]], "source_release": "R4"}, "")
    df = records.read_json(spark, f"file://{FIXTURES}/r4/egfr.json", "Observation").where("id = 'egfr-456'")
    other = df.withColumn("code", F.struct(F.array(F.struct(F.lit(maps.LOINC).alias("system"), F.lit("other").alias("code"), F.lit(None).cast("string").alias("display"))).alias("coding"), F.lit(None).cast("string").alias("text")))
    fits = lambda rows, release: forward.select_map(rows, [m], release).first().map_id
    assert fits(other, "R4") == "egfr" and fits(df, "R4") == "egfr" and fits(other, "R5") is None


def test_exported_iris_stay_different(spark):
    rows = [("ex:g", f"urn:a{c}b", "ex:p", "iri", "ex:o", None) for c in ("", "\t", "\x01", "\x7f")]
    out = {r.value for r in graph.to_nquads(spark.createDataFrame(rows, QUADS), {"ex": "http://e/"}).collect()}
    assert len(out) == 4 and "<urn:a%09b> <http://e/p> <http://e/o> <http://e/g> ." in out
