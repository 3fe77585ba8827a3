"""The worked examples and their variants, static checks, the versioned store, and a whole run."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomgraph import maps
from loomgraph import run as running
from loomgraph.functions import terms
from loomgraph.operators import graph, routing, state
from loomgraph.plans import compiler, forward
from loomgraph.plans.contract import MANIFEST_FIELDS, MapContract, MapError, check, check_manifest, checked
from loomgraph.sources import records, scratch
from loomgraph.sources.store import TABLES, GraphStore

FIXTURES = Path(__file__).parent / "fixtures"
RULES = {
    "identity_map": [("Patient/p123", "ex:person-p123"), ("Patient/p124", "ex:person-p124"), ("Practitioner/c7", "ex:clinician-c7"), ("Patient/two", "ex:a"), ("Patient/two", "ex:b")],
    "unit_rule": [(maps.UCUM, "mL/min/{1.73_m2}", "ex:ucum-mL-min-1_73_m2"), (maps.UCUM, "mm[Hg]", "ex:ucum-mm-Hg"), (maps.UCUM, "mg", "ex:ucum-mg")],
    "code_rule": [(maps.LOINC, "33914-3", "ex:EGFRResult", "egfr")],
    "status_policy": [("Observation", "final", "mapped"), ("Observation", "preliminary", "mapped"), ("Encounter", "finished", "mapped"), ("MedicationAdministration", "completed", "mapped")],
}
QUADS = "graph_key string, s string, p string, o_kind string, o_value string, o_datatype string"


def fixture(name):
    return f"file://{FIXTURES}/r4/{name}.json"


def golden(spark, name):
    return spark.read.schema("s string, p string, o_kind string, o_value string, o_datatype string").json(f"file://{FIXTURES}/expected/{name}.json").withColumn("graph_key", F.lit("golden"))


@pytest.fixture(scope="module")
def rules(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("rules")
    for name, rows in RULES.items():
        columns = [c.split()[0] for c in records.RULES[name].split(", ")]
        (folder / f"{name}.json").write_text("\n".join(json.dumps(dict(zip(columns, r, strict=False))) for r in rows))
    return f"file://{folder}"


@pytest.fixture(scope="module")
def tables(spark, rules):
    return records.read_rules(spark, rules)


@pytest.fixture(scope="module")
def outcomes(spark, tables):
    found = {
        "egfr": forward.observation_outcomes(records.read_json(spark, fixture("egfr"), "Observation"), tables["identity_map"], tables["unit_rule"], tables["status_policy"], [maps.EGFR_CODE]),
        "bp": forward.panel_outcomes(records.read_json(spark, fixture("bp"), "Observation"), tables["identity_map"], tables["unit_rule"], tables["status_policy"]),
        "encounter": forward.encounter_outcomes(records.read_json(spark, fixture("encounter"), "Encounter"), tables["identity_map"], tables["status_policy"]),
        "medication": forward.medication_outcomes(records.read_json(spark, fixture("medication"), "MedicationAdministration"), tables["identity_map"], tables["unit_rule"], tables["status_policy"]),
    }
    return {k: v.cache() for k, v in found.items()}


def test_outcomes_of_all_fixtures(outcomes):
    want = json.loads((FIXTURES / "expected/outcomes.json").read_text())
    got = {r.id: {"outcome": r.outcome, "reasons": r.reasons} for df in outcomes.values() for r in df.select("id", "outcome", "reasons").collect()}
    assert got == want


@pytest.mark.parametrize(("kind", "ident"), [("egfr", "egfr-456"), ("encounter", "enc-9")])
def test_graphs_equal_the_worked_examples(spark, outcomes, kind, ident):
    quads = running.GRAPHS[kind](outcomes[kind].where(F.col("id") == ident))
    want = golden(spark, ident)
    assert graph.expect_graph(quads, want).count() == 0 and quads.count() == want.count()
    assert all(r.is_constant or r["var"] for r in quads.collect())


def test_result_and_pivots(outcomes):
    quads = forward.observation_graph(outcomes["egfr"].where("id = 'egfr-456'"))
    assert [tuple(r) for r in graph.results(quads, "ex:EGFRResult").collect()] == [("ex:person-p123", "ex:egfr-result-456", "55.0", "mL/min/{1.73_m2}", "2026-09-02T14:00:00Z")]
    back = {(r["var"], r.value) for r in compiler.invert(maps.egfr(), quads).collect()}
    assert back == {("egfr:value", "55.0"), ("egfr:unitCode", "mL/min/{1.73_m2}"), ("egfr:effective", "2026-09-02T14:00:00Z")}


def test_times_keep_their_precision(outcomes):
    quads = forward.observation_graph(outcomes["egfr"].where("id = 'egfr-partial'"))
    assert [(r.o_value, r.o_datatype) for r in quads.where("s like 'ex:time-%' and p = 'sulo:hasValue'").collect()] == [("2026-09", "xsd:gYearMonth")]
    starts = forward.encounter_graph(outcomes["encounter"]).where("s = 'ex:start-enc-month' and p = 'sulo:hasValue'").collect()
    assert [(r.o_value, r.o_datatype) for r in starts] == [("2026-09", "xsd:gYearMonth")]


def test_every_mapped_record_has_a_graph_without_nulls(outcomes):
    for kind, make in running.GRAPHS.items():
        quads = make(outcomes[kind])
        assert quads.where("s is null or p is null or o_value is null").count() == 0
        assert quads.select("graph_key").distinct().count() == outcomes[kind].where("outcome = 'mapped'").count()
        m = maps.named(kind)
        assert graph.validate_target(quads, m).count() == 0 and graph.invariants(quads, m.types).count() == 0
        assert running.cardinality_report(m, outcomes[kind]).count() == 0


def test_target_violations_are_found(outcomes):
    quads = forward.observation_graph(outcomes["egfr"].where("id = 'egfr-456'"))
    broken = quads.where("not (s = 'ex:egfr-result-456' and p = 'sulo:hasPart')").withColumn("o_datatype", F.when(F.col("o_datatype") == "xsd:decimal", "xsd:string").otherwise(F.col("o_datatype")))
    bad = graph.validate_target(broken, maps.egfr())
    assert {r.violation for r in bad.collect()} == {"Result: sulo:hasPart isn't there 1 times", "Result: sulo:hasValue isn't xsd:decimal"}
    assert graph.validation_digest(bad) == graph.validation_digest(bad.repartition(3)) != graph.validation_digest(bad.limit(1))


def test_lexical_forms_survive(spark, tmp_path):
    (tmp_path / "o.json").write_text("\n".join('{"resourceType":"Observation","id":"x","valueQuantity":{"value":%s}}' % v for v in ("55.00", "1.50e2", "0.1000000000000000055")))
    out = records.read_json(spark, f"file://{tmp_path}/o.json", "Observation")
    assert [r[0] for r in out.select("valueQuantity.value").collect()] == ["55.00", "1.50e2", "0.1000000000000000055"]
    raw = records.read_raw(spark, f"file://{tmp_path}/o.json")
    assert {tuple(r.unknown) for r in routing.unknown_fields(raw, "raw", ["resourceType", "id"]).collect()} == {("valueQuantity",)}


def test_triples_and_back(spark, tmp_path):
    lines = [p for name in ("egfr", "bp", "encounter", "medication") for p in (FIXTURES / "r4" / f"{name}.json").read_text().splitlines()]
    lines += ['{"a":{},"b":[],"c":[[],[1.50e2,null,true,"x\\"y"]],"d":"0055"}', '{"value":55.00}']
    (tmp_path / "r.json").write_text("\n".join(lines))
    raw = records.read_raw(spark, f"file://{tmp_path}/r.json")
    triples = records.rdf(raw)
    assert triples.where("p = 'fhir:value' and o_value = '55.00' and o_datatype = 'xsd:decimal'").count() == 1
    exact = lambda text: json.loads(text, parse_float=str, parse_int=lambda x: ("int", x))
    back = {r.digest: r.json for r in records.from_rdf(triples).collect()}
    assert {r.digest: exact(r.raw) for r in raw.collect()} == {k: exact(v) for k, v in back.items()} and len(back) == len(lines)


def pairs(quads):
    parts = quads.where("p in ('ex:componentKind', 'sulo:hasValue')").groupBy("graph_key", "s").agg(F.max(F.when(F.col("p") == "ex:componentKind", F.col("o_value"))).alias("kind"), F.max(F.when(F.col("p") == "sulo:hasValue", F.col("o_value"))).alias("v"))
    found = parts.where("kind is not null").groupBy("graph_key").agg(F.array_sort(F.collect_list(F.struct("kind", "v"))).alias("p")).collect()
    return {r.graph_key: [tuple(x) for x in r.p] for r in found}


def test_panels_keep_their_pairs(spark, outcomes):
    rows = outcomes["bp"]
    ids = {r.graph_key: r.id for r in rows.collect()}
    got = {ids[k]: v for k, v in pairs(forward.panel_graph(rows)).items()}
    assert got["bp-1"] == [("diastolic", "80"), ("systolic", "120")] and got["bp-2"] == [("diastolic", "70"), ("systolic", "105")]
    assert got["bp-dup1"] == got["bp-1"] and got["bp-omitted"] == [("systolic", "120")] and got["bp-absent"] == [("diastolic", None), ("systolic", "120")]
    assert got["bp-dupcode"] == [("diastolic", "80"), ("systolic", "120"), ("systolic", "121")] and got["bp-badunit"] == [("diastolic", "80"), ("systolic", None)]
    assert {r.id: r.diagnostics for r in rows.where("size(diagnostics) > 0").collect()} == {"bp-absent": ["diastolic: absent-value"], "bp-badunit": ["systolic: unit"]}
    quads = forward.panel_graph(rows)
    back = compiler.invert(maps.blood_pressure(), quads).where("var = 'bp:value'").select("graph_key", "value")
    forth = rows.where("outcome = 'mapped'").select("graph_key", F.explode("component.value").alias("value")).where("value is not null")
    assert graph.multiset_diff(back, forth).count() == 0
    holders = quads.where("p = 'sulo:isFeatureOf'").select("graph_key", "o_value").distinct().collect()
    assert {ids[r.graph_key]: r.o_value for r in holders}["bp-other"] == "ex:person-p124"


def test_permutations_give_the_same_graphs(spark, tables, tmp_path):
    lines = (FIXTURES / "r4/bp.json").read_text().splitlines()
    turned = [json.loads(x) for x in reversed(lines)]
    for r in turned:
        r["component"].reverse()
    (tmp_path / "bp.json").write_text("\n".join(map(json.dumps, turned)))
    of = lambda path: graph.graph_hash(forward.panel_graph(forward.panel_outcomes(records.read_json(spark, path, "Observation"), tables["identity_map"], tables["unit_rule"], tables["status_policy"])))
    assert sorted(of(fixture("bp")).collect()) == sorted(of(f"file://{tmp_path}/bp.json").collect())


def test_encounter_roles(outcomes):
    quads = forward.encounter_graph(outcomes["encounter"], ("graph_key", "id"))
    nine, open_end = quads.where("id = 'enc-9'"), quads.where("id = 'enc-open'")
    assert {r.o_value for r in graph.pro_entail(nine).collect()} == {"ex:person-p123", "ex:clinician-c7"}
    assert {(r.role_type, r.person) for r in graph.participants(nine).collect()} == {("ex:PatientRole", "ex:person-p123"), ("ex:ClinicianRole", "ex:clinician-c7")}
    assert open_end.where("o_value = 'sulo:EndTime' or s like '%end-enc%' or o_value like '%end-enc%'").count() == 0
    assert quads.where("p like '%hasPatient%'").count() == 0


def test_medication_is_queried_by_its_parts(outcomes):
    quads = forward.medication_graph(outcomes["medication"])
    value = {(r.s, r.p): r.o_value for r in quads.collect()}
    a = "ex:administration-1"
    assert value[a, "ex:route"] == "urn:routes|PO" and value[a, "ex:medicationCode"] == "urn:drugs|m1" and value["ex:dose-1", "sulo:hasValue"] == "2.5"
    assert value["ex:time-med-1", "sulo:hasValue"] == "2026-09-02T15:00:00Z" and {r.o_value for r in graph.pro_entail(quads).collect()} == {"ex:person-p123", "ex:clinician-c7"}


def test_later_release_gives_the_same_graph(spark, tables, outcomes, tmp_path):
    later = []
    for r in map(json.loads, (FIXTURES / "r4/encounter.json").read_text().splitlines()):
        r["actualPeriod"] = r.pop("period")
        r["status"] = {"finished": "completed"}.get(r["status"], r["status"])
        r["participant"] = [{"actor": p["individual"]} for p in r["participant"]]
        later.append(r)
    (tmp_path / "e.json").write_text("\n".join(map(json.dumps, later)))
    schema = records.SCHEMAS["Encounter"].replace("period STRUCT", "actualPeriod STRUCT").replace("individual:", "actor:")
    adapted = records.adapt_r5(spark.read.schema(schema).json(f"file://{tmp_path}/e.json"))
    quads = forward.encounter_graph(forward.encounter_outcomes(adapted, tables["identity_map"], tables["status_policy"]))
    before = forward.encounter_graph(outcomes["encounter"])
    assert graph.pivot_diff(before, quads).count() == 0 and quads.count() == before.count()
    assert graph.pivot_diff(before, quads.where("s <> 'ex:encounter-9'")).count() > 0


BAD = {"map_id": "x", "source": {"bind": {"x:id": {"path": "id"}}, "scopes": {"c": {"path": "items", "bind": {"x:part": {"path": "part"}}}}}}


@pytest.mark.parametrize(("node", "says"), [
    ({"label": "A", "key": "ex:a-{x:id}", "types": ["ex:A"], "triples": [{"p": "sulo:hasValue", "var": "x:nothing", "datatype": "xsd:string"}]}, "unbound"),
    ({"label": "A", "key": "ex:a-{x:id}", "types": ["ex:A"], "triples": [{"p": "sulo:hasValue", "var": "x:part", "datatype": "xsd:string"}]}, "incompatible scopes"),
    ({"label": "A", "types": ["ex:A"], "triples": []}, "invalid id()"),
    ({"label": "A", "key": "ex:a-{x:id", "types": ["ex:A"], "triples": []}, "invalid id()"),
    ({"label": "A", "key": "ex:a-{x:id}", "scope": "c", "types": ["ex:A"], "triples": []}, "invalid id()"),
    ({"label": "A", "key": "ex:a-{x:id}", "types": ["ex:A"], "triples": [{"p": "ex:b", "node": "B"}]}, "not defined"),
])
def test_bad_maps_fail_before_data(node, says):
    m = MapContract("x", BAD | {"target": [node]}, "")
    assert any(says in e for e in check(m))
    with pytest.raises(MapError):
        checked(m)


def test_manifests_must_be_complete():
    for name in ("egfr", "bp", "encounter", "medication"):
        m = maps.named(name)
        assert check(m) == [] and check_manifest(m) == []
        for field in MANIFEST_FIELDS[1:]:
            assert check_manifest(MapContract(name, {k: v for k, v in m.spec.items() if k != field}, "")) != []
        assert (FIXTURES / "r4" / m.spec["fixtures"][0]).exists()
    assert maps.egfr().pair_hash != maps.encounter().pair_hash


def test_maps_are_selected_by_release_profile_and_code(spark):
    df = records.read_json(spark, fixture("bp"), "Observation").unionByName(records.read_json(spark, fixture("egfr"), "Observation"))
    own = [maps.egfr(), maps.blood_pressure()]
    got = {r.id: r.map_id for r in forward.select_map(df, own).collect()}
    assert got["egfr-456"] == "egfr" and got["bp-1"] == "bp" and got["egfr-wrongcode"] is None and got["egfr-othersystem"] is None
    assert forward.select_map(df, own, "R5").where("map_id is not null").count() == 0
    twice = forward.select_map(df.where("id = 'egfr-456'"), [maps.egfr(), MapContract("other", maps.egfr().spec, "")]).first()
    assert twice.ambiguous and twice.map_id is None and twice.alternatives == ["egfr", "other"]


def test_rules_that_disagree_reject_and_never_multiply(spark, tables):
    obs = records.read_json(spark, fixture("egfr"), "Observation")
    units, policy = tables["unit_rule"], tables["status_policy"]
    other = units.limit(1).withColumn("unit_iri", F.lit("ex:other"))
    run = lambda u, p: {r.id: (r.outcome, r.reasons) for r in forward.observation_outcomes(obs, tables["identity_map"], u, p, [maps.EGFR_CODE]).collect()}
    n = obs.count()
    assert run(units.unionByName(units), policy.unionByName(policy)) == run(units, policy)
    assert run(units.unionByName(other), policy)["egfr-456"] == ("rejected", ["unit"])
    two = run(units, policy.unionByName(policy.where("status = 'final'").withColumn("outcome", F.lit("source-only"))))
    assert two["egfr-456"] == ("rejected", ["policy"]) and len(two) == n
    typed = routing.type_by_code(spark.createDataFrame([("a", "1")], "s string, c string"), F.col("s"), F.col("c"), spark.createDataFrame([("a", "1", "X", "m"), ("a", "1", "Y", "m")], "system string, code string, target_class string, map_id string"))
    assert [r.target_class for r in typed.collect()] == [None]


def test_store_corrections(spark, tmp_path):
    store = GraphStore(spark, f"file://{tmp_path}/store")
    quad = lambda key, v: spark.createDataFrame([(key, "ex:s", "sulo:hasValue", "literal", v, "xsd:decimal")] * 2, QUADS)
    say = lambda seq, key, outcome: spark.createDataFrame([("r", seq, key, outcome)], "resource_key string, seq long, graph_key string, outcome string")
    values = lambda: [r.o_value for r in store.current().collect()]
    store.append_graph(quad("g9", "1"), "r1", "egfr")
    store.switch(say(9, "g9", "mapped"), "r1", 1)
    assert values() == ["1"]  # a graph is a set
    store.append_graph(quad("g10", "2"), "r2", "egfr")  # written, not yet switched: a crash here changes nothing
    assert values() == ["1"]
    store.switch(say(10, "g10", "mapped"), "r2", 2)
    store.switch(say(9, "g9", "mapped"), "r3", 3)  # an older version cannot displace a newer one
    assert values() == ["2"]
    store.append_graph(quad("g10", "3"), "r4", "egfr")
    store.switch(say(10, "g10", "mapped"), "r4", 4)  # the same version under a new map replaces
    assert values() == ["3"]
    store.retract(spark.createDataFrame([("r",)], "resource_key string"), "r5", 5)
    assert values() == []
    store.append_graph(quad("g11", "4"), "r6", "egfr")
    store.switch(say(11, "g11", "mapped"), "r6", 6)  # the next version, whatever its number, after a retraction
    assert values() == ["4"]
    store.switch(say(12, "g12", "rejected"), "r7", 7)
    assert values() == [] and store.table("quads_history").count() == 4
    assert set(TABLES) == {p.name for p in (tmp_path / "store").iterdir()}


def test_a_run_from_input_to_store(spark, rules, tmp_path):
    source, folder = tmp_path / "in", f"file://{tmp_path}/store"
    source.mkdir()
    for name in ("egfr", "bp", "encounter", "medication"):
        (source / f"{name}.json").write_text((FIXTURES / "r4" / f"{name}.json").read_text())
    first = running.run(spark, f"file://{source}", rules, folder)
    assert [(x["kind"], x["element"]) for x in first["unknown"]] == []
    store = GraphStore(spark, folder)
    clocks = store.table("outcomes").where("resource_key like '%egfr-clocks'").select("effective", "issued", "last_updated").first()
    assert tuple(clocks) == ("2026-09-02T14:00:00Z", "2026-09-03T08:00:00Z", "2026-09-04T09:00:00Z")
    want = json.loads((FIXTURES / "expected/outcomes.json").read_text())
    got = {r.resource_key.split("/")[-1]: {"outcome": r.outcome, "reasons": r.reasons} for r in store.table("outcomes").collect()}
    assert got == want
    now = store.current()
    n = now.count()
    assert n and graph.expect_graph(now.where("s like '%456%' or s in ('ex:person-p123', 'ex:renal-quality-p123', 'ex:ucum-mL-min-1_73_m2')").where("map_id = 'egfr'"), golden(spark, "egfr-456")).where("side = 'missing'").count() == 0
    lineage = store.table("lineage")
    assert lineage.where("source_version is null or pair_hash is null or (not is_constant and var is null)").count() == 0
    keys = now.withColumn("quad_hash", F.sha2(graph.quad_text(), 256)).select("graph_key", "quad_hash")
    assert keys.join(lineage, ["graph_key", "quad_hash"], "left_anti").count() == 0
    assert store.table("quads_history").where("map_id = 'provenance' and p = 'prov:wasDerivedFrom'").count() == sum(x["outcome"] == "mapped" for x in want.values())
    record = store.table("run_record")
    assert record.count() == len(want) and record.where("validation_digest is null or source_digest is null or activity_time is null").count() == 0
    again = running.run(spark, f"file://{source}", rules, folder)  # unchanged: no record, no triple
    assert again["outcomes"] == [] and store.current().count() == n and store.table("run_record").count() == len(want)
    change = json.loads((FIXTURES / "r4/egfr.json").read_text().splitlines()[0])
    (source / "v2.json").write_text(json.dumps(change | {"meta": {"versionId": "10"}, "valueQuantity": change["valueQuantity"] | {"value": 60.0}}))
    running.run(spark, f"file://{source}", rules, folder)
    of = lambda: [r.o_value for r in store.current().where("s = 'ex:egfr-result-456' and p = 'sulo:hasValue'").collect()]
    assert of() == ["60.0"] and store.table("quads_history").where("s = 'ex:egfr-result-456' and p = 'sulo:hasValue'").count() == 2
    (source / "v3.json").write_text(json.dumps(change | {"meta": {"versionId": "11"}, "status": "entered-in-error"}))
    running.run(spark, f"file://{source}", rules, folder)
    assert of() == [] and store.table("run_record").where(F.col("run_id") == first["run_id"]).count() == len(want) and store.current().count() == n - 20
    clean = f"file://{tmp_path}/other"
    running.run(spark, f"file://{source}", rules, clean)
    assert sorted(graph.graph_hash(GraphStore(spark, clean).current()).collect()) == sorted(graph.graph_hash(store.current()).collect())



def test_a_run_that_dies_is_done_anew(spark, rules, tmp_path, monkeypatch):
    source, folder = tmp_path / "in", f"file://{tmp_path}/store"
    source.mkdir()
    record = json.loads((FIXTURES / "r4/encounter.json").read_text().splitlines()[0])
    (source / "e.json").write_text(json.dumps(record | {"surprise": 1}))
    axioms = tmp_path / "axioms.json"
    axioms.write_text(json.dumps({"kind": "disjoint", "a": "ex:ClinicalEncounter", "b": "sulo:Process"}))
    with monkeypatch.context() as m:
        m.setattr(GraphStore, "switch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            running.run(spark, f"file://{source}", rules, folder)
    store = GraphStore(spark, folder)
    assert store.table("quads_history").where("map_id = 'encounter'").count() == 18 and store.current().count() == 0 and store.committed().count() == 0
    again = running.run(spark, f"file://{source}", rules, folder)
    assert store.current().count() == 18 and store.committed().count() == 1 and again["unknown"] == [{"kind": "Encounter", "element": "surprise", "n": 1}]
    rerun = running.run(spark, f"file://{source}", rules, folder, terminology="2")  # the same version under another snapshot replaces
    assert store.current().count() == 18 and {r.run_id for r in store.current().collect()} == {rerun["run_id"]}
    running.run(spark, f"file://{source}", rules, folder, ontology="2", axioms_path=f"file://{axioms}")  # an inconsistent graph isn't pointed to
    assert store.current().count() == 0 and store.table("validation").where("violation = 'ex:ClinicalEncounter|sulo:Process'").count() == 1


def test_a_run_refuses_bad_maps(spark, rules, tmp_path, monkeypatch):
    bad = MapContract("egfr", maps.egfr().spec | {"target": [{"label": "A", "types": [], "triples": []}]}, "")
    monkeypatch.setattr(maps, "egfr", lambda: bad)
    with pytest.raises(MapError):
        running.run(spark, "file:///nowhere", rules, f"file://{tmp_path}/s")


def test_generated_records_cover_every_outcome(spark, tmp_path):
    a, b = records.generate(spark, 500), records.generate(spark, 500).repartition(3)
    assert sorted(a.collect()) == sorted(b.collect())
    out = running.trial(spark, f"file://{tmp_path}", 1_000)
    assert out["quads"] == out["quads_after_replay"] > 0 and out["replayed"] == 0
    assert sum(r["n"] for r in out["outcomes"] if r["outcome"] == "mapped") > 300
    seen = {(r["map"], r["reason"]) for r in out["outcomes"]}
    assert {("egfr", x) for x in (None, "status", "code", "comparator", "absent-value", "unit", "identity", "modifier-extension", "shape")} <= seen
    assert {m for m, _ in seen} == {"egfr", "bp", "encounter", "medication"}


def test_keys_and_times(spark):
    row = spark.range(1).select(
        terms.node_id("ex:{a}-{b}", {"a": F.lit("x"), "b": F.lit(None).cast("string")}).alias("null_key"), (terms.key_hash(F.lit("a"), F.lit(None), F.lit("b")) == terms.key_hash(F.lit("a"), F.lit("b"))).alias("same"),
        F.array(*[terms.time_precision(F.lit(x)) for x in ("2026", "2026-09", "2026-09-02", "2026-09-02T14:00", "2026-09-02T14:00:00+02:00", "soon")]).alias("p"), terms.norm_ref(F.lit("Patient/p1/_history/3"), F.lit("http://b")).alias("ref"),
        terms.interval_nodes(F.lit("a"), F.lit(None).cast("string")).alias("ends"), terms.content_hash(F.lit("abc")).alias("hash"),
        (terms.quality_key("observation", "q", F.lit("p"), F.lit("s"), F.lit("t"), F.lit("c")) == terms.quality_key("observation", "q", F.lit("p"), F.lit("s2"), F.lit("t"), F.lit("c"))).alias("merged"),
    ).first()
    assert row.null_key is None and not row.same and row.ref == "http://b/Patient/p1" and not row.merged
    assert row.p == ["year", "month", "day", "local", "instant", "invalid"] and [tuple(x) for x in row.ends] == [("start", "a")]
    assert row.hash == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    with pytest.raises(Exception, match="null key part"):
        spark.range(1).select(terms.node_id("ex:{a}", {"a": F.lit(None).cast("string")}, strict=True)).collect()


def test_polymorphic_elements_and_profiles(spark):
    df = spark.createDataFrame([("1", "a", None, ["p"]), ("2", "a", "b", None), ("3", None, None, [])], "id string, x string, y string, profile array<string>")
    assert [r[0] for r in df.orderBy("id").select(routing.present_values(x=F.col("x"), y=F.col("y"))).collect()] == ["x", "several", "none"]
    issues = records.profile_issues(df.withColumn("meta", F.struct("profile")), "p", ["x"]).orderBy("id").select("issues").collect()
    assert [r.issues for r in issues] == [[], ["profile not declared"], ["missing x", "profile not declared"]]


def test_consistency_union_and_axioms(spark, tmp_path):
    (tmp_path / "axioms.json").write_text(json.dumps({"kind": "disjoint", "a": "ex:Person", "b": "sulo:Process"}) + "\n" + json.dumps({"kind": "chain", "a": "sulo:hasParticipant", "b": "sulo:isFeatureOf", "c": "sulo:hasParticipant"}))
    axioms = records.read_axioms(spark, f"file://{tmp_path}/axioms.json")
    disjoint = [(r.a, r.b) for r in axioms.where("kind = 'disjoint'").collect()]
    q = spark.createDataFrame([("g", "n", "rdf:type", "iri", "ex:Person", None), ("g", "n", "rdf:type", "iri", "sulo:Process", None), ("g", "m", "rdf:type", "iri", "ex:Person", None)], QUADS)
    assert [(r.s, r.axiom) for r in graph.inconsistencies(q, disjoint).collect()] == [("n", "ex:Person|sulo:Process")]
    assert graph.union_graphs(q, q).count() == 3
    parts = spark.createDataFrame([("a", "y", 2), ("a", "x", 1)], "k string, kind string, v int")
    assert [tuple(x) for x in graph.nest(parts, "k", "kind", "v").first().tree] == [("x", 1), ("y", 2)]


def test_contained_references(spark):
    df = spark.createDataFrame([("#p1", ['{"id":"p1"}']), ("#p2", ['{"id":"p1"}']), ("Patient/a/_history/2", None), ("Patient/zz", None)], "ref string, contained array<string>").withColumn("subject", F.struct(F.col("ref").alias("reference")))
    targets = spark.createDataFrame([(f"{forward.SERVER}/Patient/a",)], "key string")
    got = {r.ref: r.target_key for r in forward.resolved_reference(df, targets, "key").collect()}
    assert got == {"#p1": "#p1", "#p2": None, "Patient/a/_history/2": f"{forward.SERVER}/Patient/a", "Patient/zz": None}


def test_replay_and_hash(spark, outcomes):
    quads = forward.observation_graph(outcomes["egfr"])
    assert sorted(graph.graph_hash(quads).collect()) == sorted(graph.graph_hash(quads.repartition(5)).collect())
    keys = spark.createDataFrame([("d1", *"abcde"), ("d2", *"abcde")], ", ".join(f"{c} string" for c in state.RUN_KEY))
    assert [r.source_digest for r in state.pending(keys, keys.limit(1)).collect()] == ["d2"]


def test_scratch_folders(spark):
    with scratch.scratch(spark) as folder:
        path = Path(folder.removeprefix("file:").replace("//", "/", 1))
        assert scratch.stored(spark.range(3), folder).count() == 3 and path.exists()
    assert not path.exists()


def test_entry_imports_without_the_subpackage(monkeypatch):
    import importlib
    import sys

    import __spark_entry__

    for name in [n for n in sys.modules if n.startswith("loomgraph.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name in ("loomgraph.llm", "corpus_pipeline") else find(name, *a))
    entry = importlib.reload(__spark_entry__)
    assert "result_for_person" in entry.queries() and not any(n.startswith("op") and n[2].isdigit() for n in entry.queries()) and "pipeline" not in entry.queries()
    monkeypatch.undo()
    importlib.reload(__spark_entry__)


def test_lines_of_quads(spark):
    long = "x" * 150_000
    rows = [("ex:g", "ex:" + long, "ex:p", "iri", "ex:o", None), ("graph:1", "urn:a b<c>", "ex:p", "literal", 'q"\\\n', "xsd:string")]
    out = {r.value for r in graph.to_nquads(spark.createDataFrame(rows, QUADS), {"ex": "http://e/"}).collect()}
    assert out == {f"<http://e/{long}> <http://e/p> <http://e/o> <http://e/g> .", '<urn:a%20b%3Cc%3E> <http://e/p> "q\\"\\\\\\n" <urn:graph:1> .'}
    with pytest.raises(Exception, match="null term"):
        graph.to_nquads(spark.createDataFrame([("ex:g", None, "ex:p", "iri", "ex:o", None)], QUADS), {"ex": "http://e/"}).collect()
    same = "y" * 1_000
    refs = spark.createDataFrame([("#" + same + "a", [same + "a"]), ("#" + same + "b", [same])], "r string, ids array<string>")
    out = routing.resolve_refs(refs, F.col("r"), spark.createDataFrame([("t",)], "k string"), "k", F.col("ids"))
    assert {r.r: r.target_key for r in out.collect()} == {"#" + same + "a": "#" + same + "a", "#" + same + "b": None}
