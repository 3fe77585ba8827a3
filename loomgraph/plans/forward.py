"""The forward transform: records to contexts, outcomes, bindings and quads, one function of outcomes for each kind.

Every record gets one outcome with all its reasons, and only mapped ones enter the graph. Guards that mean "this meaning
isn't supported" keep the source only; failures of identity, unit, value or time reject.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import maps
from ..functions.terms import coding_key, graph_key, has_code, is_decimal, local_id, norm_ref, quality_key, relative_ref, time_precision, version_iri
from ..operators import graph, routing
from .compiler import bind, complete, materialize_graph
from .contract import MapContract

SERVER = "https://records.example"
#: The kinds of the components of a panel.
KINDS = {maps.SYSTOLIC: "systolic", maps.DIASTOLIC: "diastolic"}


def _bad_time(lexical: Column) -> Column:
    return F.coalesce(time_precision(lexical), F.lit("none")).isin("none", "invalid")


def select_map(records: DataFrame, contracts: list[MapContract], release: str = "R4") -> DataFrame:
    """``records`` of one release with map_id, alternatives and ambiguous: a map fits by resource type, release, declared
    profile and code. The maps are a handful, so that this is one expression and no join."""

    def fits(m: MapContract) -> Column:
        ok = F.lit(m.spec["source_release"] == release) & (F.col("resourceType") == m.spec["source_shape"])
        if m.spec.get("source_profile"):
            ok = ok & F.array_contains("meta.profile", m.spec["source_profile"])
        if m.spec["codes"]:
            ok = ok & reduce(lambda a, b: a | b, [has_code(F.col("code"), system, code) for system, code in m.spec["codes"]])
        return ok

    return routing.alternatives(records, {m.map_id: fits(m) for m in contracts})


def version_of(records: DataFrame) -> Column:
    """A record's version: its number, or the time of its update, or else its content (column ``source_digest``, where a run
    has added it), so that two records without a version are never taken for one."""
    last = [F.concat(F.lit("h"), F.substring("source_digest", 1, 16))] if "source_digest" in records.columns else []
    updated = [F.col("meta.lastUpdated")] if "lastUpdated" in records.select("meta.*").columns else []
    return F.coalesce(F.col("meta.versionId"), *updated, *last, F.lit("1"))


def _context(records: DataFrame, kind: str, map_id: str, identity_map: DataFrame, policy: DataFrame) -> DataFrame:
    """``records`` with person and n_candidates, status_outcome, source (version IRI) and graph key. The resource's clocks
    stay apart: only the clinically relevant time enters the graph."""
    rows = records.withColumn("reference", relative_ref(F.col("subject.reference"), SERVER))
    rows = routing.resolve_identity(rows, "reference", identity_map)
    rows = routing.eligibility(rows, F.col("status"), policy, kind)
    version = version_of(records)
    return rows.withColumns({
        "source": version_iri(F.lit(SERVER), F.lit(kind), F.col("id"), version), "person": F.col("person_iri"),
        "graph_key": graph_key(F.lit(SERVER), F.lit(kind), F.col("id"), version, F.lit(map_id)),
    })


def _common() -> dict[str, tuple[Column, str]]:
    return {
        "policy": (F.col("status_outcome") == routing.REJECTED, routing.REJECTED),
        "status": (F.col("status_outcome") == routing.SOURCE_ONLY, routing.SOURCE_ONLY),
        "modifier-extension": (routing.has_modifier(F.col("modifierExtension")), routing.SOURCE_ONLY),
        "identity": (F.col("n_candidates") != 1, routing.REJECTED),
    }


def observation_outcomes(
    records: DataFrame, identity_map: DataFrame, unit_rules: DataFrame, policy: DataFrame, codes: list[str], quality_policy: str = "persistent", system: str = maps.LOINC
) -> DataFrame:
    """``records`` (the observation schema) with identity, unit, graph key, outcome and reasons."""
    value = F.col("valueQuantity")
    rows = _context(records, "Observation", "egfr", identity_map, policy).withColumn("local", local_id(F.col("id"), "egfr-"))
    rows = routing.unit_node(rows, value["system"], value["code"], unit_rules)
    rows = rows.withColumns({"unit": F.col("unit_iri"), "quality": quality_key(quality_policy, "renal-quality", F.col("person_iri"), F.col("id"), F.col("effectiveDateTime"), F.lit(codes[0]))})
    known = F.lit(False)
    for code in codes:
        known = known | has_code(F.col("code"), system, code)
    common = _common()
    # one type of value and one of time, if the schema has several: none is chosen silently
    several = F.lit(False)
    for variants in (("valueQuantity", "valueString"), ("effectiveDateTime", "effectivePeriod")):
        if set(variants) <= set(records.columns):
            several = several | (routing.present_values(**{v: F.col(v) for v in variants}) == "several")
    return routing.route(rows, {
        "policy": common["policy"],
        "several-types": (several, routing.SOURCE_ONLY),
        "status": common["status"],
        "code": (~F.coalesce(known, F.lit(False)), routing.SOURCE_ONLY),
        "modifier-extension": common["modifier-extension"],
        "absent-value": (value["value"].isNull() | F.col("dataAbsentReason").isNotNull(), routing.SOURCE_ONLY),
        "comparator": (value["comparator"].isNotNull(), routing.SOURCE_ONLY),
        "identity": common["identity"],
        "unit": (value["value"].isNotNull() & F.col("unit_iri").isNull(), routing.REJECTED),
        "value": (value["value"].isNotNull() & ~is_decimal(value["value"]), routing.REJECTED),
        "time": (_bad_time(F.col("effectiveDateTime")), routing.REJECTED),
    }, complete(maps.egfr()))


def observation_graph(outcomes: DataFrame, keep: tuple[str, ...] = ("graph_key",)) -> DataFrame:
    """Quads with lineage of the mapped rows: only these enter the graph."""
    m = maps.egfr()
    return materialize_graph(m, bind(m, outcomes.where(F.col("outcome") == routing.MAPPED), keep), keep)


def panel_outcomes(records: DataFrame, identity_map: DataFrame, unit_rules: DataFrame, policy: DataFrame, system: str = maps.LOINC) -> DataFrame:
    """Panels (the observation schema, repeated components) with prepared components, outcome, reasons and
    ``diagnostics``: what is wrong with single components, which leaves the panel as it is.

    A component's key is its kind, or its kind, value and rank among equal ones where the kind occurs several times: never
    its place, so that permuted lists give the same graph. Components of an unknown code are no part of the map; one with
    an absent reason, a comparator or an unknown unit stays a component without a number; one with a modifier extension
    keeps the whole panel out of the graph."""
    rows = _context(records, "Observation", "bp", identity_map, policy)
    kinds = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    own = F.filter(F.transform(F.col("c.code.coding"), coding_key), lambda k: k["system"] == system)
    # trees are those of a record's content, so that rows that repeat a record, and two versions under one key, keep their own;
    # in any order of the components, as both sides of the join below read the records, and lists that a shuffle gathered may
    # come in another order each time
    rows = rows.withColumn("instance", F.sha2(F.to_json(F.struct("graph_key", F.array_sort("component").alias("component")), {"ignoreNullFields": "false"}), 256))
    parts = rows.select("instance", "component").dropDuplicates(["instance"]).select("instance", F.explode("component").alias("c")).withColumns({
        "kind": F.get(F.array_compact(F.transform(own, lambda k: F.try_element_at(kinds, k["code"]))), F.lit(0)), "value": F.col("c.valueQuantity.value"),
    })
    parts = routing.unit_node(parts, F.col("c.valueQuantity.system"), F.col("c.valueQuantity.code"), unit_rules)
    issue = (
        F.when(F.col("c.dataAbsentReason").isNotNull() | F.col("value").isNull(), "absent-value").when(F.col("c.valueQuantity.comparator").isNotNull(), "comparator")
        .when(~is_decimal(F.col("value")), "value").when(F.col("unit_iri").isNull(), "unit")
    )
    parts = parts.withColumn("issue", issue).where("kind is not null")
    number = F.when(F.col("issue").isNull(), F.col("value"))
    parts = parts.select("instance", F.col("kind"), number.alias("value"), F.when(F.col("issue").isNull(), F.col("unit_iri")).alias("unit"), "issue", routing.has_modifier(F.col("c.modifierExtension")).alias("modifier"))
    trees = graph.nest(parts.withColumnRenamed("instance", "part_of"), "part_of", "kind", "value", "unit", "issue", "modifier")
    rows = rows.join(trees, F.col("instance") == F.col("part_of"), "left").drop("part_of", "instance")

    def key(x: Column, i: Column) -> Column:
        same = F.size(F.filter("tree", lambda y: y["kind"] == x["kind"]))
        rank = F.size(F.filter("tree", lambda y, j: (y["kind"] == x["kind"]) & y["value"].eqNullSafe(x["value"]) & (j <= i)))
        return F.concat(F.col("id"), F.lit("-"), x["kind"], F.when(same > 1, F.concat(F.lit("-"), F.coalesce(x["value"], F.lit("absent")), F.lit("-"), rank.cast("string"))).otherwise(""))

    def prepared(x: Column, i: Column) -> Column:
        return F.struct(x["kind"].alias("kind"), key(x, i).alias("key"), F.concat(F.lit("ex:"), x["kind"], F.lit("-quality-"), key(x, i)).alias("quality"), x["value"].alias("value"), x["unit"].alias("unit"))

    rows = rows.withColumns({
        "component": F.transform("tree", prepared), "component_modifier": F.coalesce(F.exists("tree", lambda x: x["modifier"]), F.lit(False)),
        "diagnostics": F.transform(F.filter("tree", lambda x: x["issue"].isNotNull()), lambda x: F.concat(x["kind"], F.lit(": "), x["issue"])),
    })
    return routing.route(rows, _common() | {
        "code": (F.coalesce(F.size("component"), F.lit(0)) == 0, routing.SOURCE_ONLY),
        "component-modifier": (F.col("component_modifier"), routing.SOURCE_ONLY),
        "time": (_bad_time(F.col("effectiveDateTime")), routing.REJECTED),
    }, complete(maps.blood_pressure()))


def panel_graph(panels: DataFrame, keep: tuple[str, ...] = ("graph_key",)) -> DataFrame:
    """Quads of repeated components (``component``: structs of kind, key, quality, value, unit), paired by their record.
    Rows that lack something the map needs give none: ``panel_outcomes`` has named them before."""
    m = maps.blood_pressure()
    rows = panels.where(F.col("outcome") == routing.MAPPED) if "outcome" in panels.columns else panels
    return materialize_graph(m, bind(m, rows.where(complete(m)), keep), keep)


def encounter_rows(records: DataFrame) -> DataFrame:
    """Encounter records with the variables that the run supplies; an open period has no end node."""
    ident = F.col("id")
    return records.withColumns({
        "local": local_id(ident, "enc-"), "startNode": F.concat(F.lit("ex:start-"), ident),
        "endNode": F.when(F.col("period.end").isNotNull(), F.concat(F.lit("ex:end-"), ident)),
        "graph_key": graph_key(F.lit(SERVER), F.lit("Encounter"), ident, version_of(records), F.lit("encounter")),
    })


def encounter_outcomes(records: DataFrame, identity_map: DataFrame, policy: DataFrame) -> DataFrame:
    """Encounters (their schema) with patient and clinician resolved, outcome and reasons. Exactly one clinician has to be
    named, as the map has one role for it."""
    rows = _context(records, "Encounter", "encounter", identity_map, policy).withColumnsRenamed({"n_candidates": "n_patients", "person_iri": "patient_iri"})
    one = F.when(F.size("participant") == 1, F.get("participant", F.lit(0))["individual"]["reference"])
    rows = routing.resolve_identity(rows.withColumn("clinician_ref", relative_ref(one, SERVER)), "clinician_ref", identity_map)
    rows = encounter_rows(rows.withColumnsRenamed({"n_candidates": "n_clinicians", "person_iri": "clinician"}).withColumn("n_candidates", F.least("n_patients", "n_clinicians")))
    rows = rows.withColumn("n_candidates", F.when((F.col("n_patients") == 1) & (F.col("n_clinicians") == 1), 1).otherwise(0))
    bad = _bad_time(F.col("period.start")) | (F.col("period.end").isNotNull() & _bad_time(F.col("period.end")))
    return routing.route(rows, _common() | {"time": (bad, routing.REJECTED)}, complete(maps.encounter()))


def encounter_graph(rows: DataFrame, keep: tuple[str, ...] = ("graph_key",)) -> DataFrame:
    """Quads of finished encounters (``rows`` of ``encounter_outcomes``, or of ``encounter_rows`` with person and
    clinician)."""
    m = maps.encounter()
    rows = rows.where(F.col("outcome") == routing.MAPPED) if "outcome" in rows.columns else rows
    return materialize_graph(m, bind(m, rows.where(complete(m)), keep), keep)


def medication_outcomes(records: DataFrame, identity_map: DataFrame, unit_rules: DataFrame, policy: DataFrame) -> DataFrame:
    """Administrations (their schema) with patient and performer resolved, outcome and reasons. The medication's code stays
    a code: it isn't taken for a physical drug."""
    rows = _context(records, "MedicationAdministration", "medication", identity_map, policy).withColumnsRenamed({"n_candidates": "n_patients", "person_iri": "patient_iri"})
    one = F.when(F.size("performer") == 1, F.get("performer", F.lit(0))["actor"]["reference"])
    rows = routing.resolve_identity(rows.withColumn("performer_ref", relative_ref(one, SERVER)), "performer_ref", identity_map)
    dose = F.col("dosage.dose")
    code = lambda concept: F.transform(concept, lambda k: F.concat_ws("|", k["system"], k["code"]))
    rows = routing.unit_node(rows, dose["system"], dose["code"], unit_rules).withColumns({
        "performer": F.col("person_iri"), "n_candidates": F.when((F.col("n_patients") == 1) & (F.col("n_candidates") == 1), 1).otherwise(0), "unit": F.col("unit_iri"),
        "local": local_id(F.col("id"), "med-"), "code": F.get(code(F.col("medicationCodeableConcept.coding")), F.lit(0)), "route": F.get(code(F.col("dosage.route.coding")), F.lit(0)),
    })
    return routing.route(rows, _common() | {
        "code": (F.col("code").isNull(), routing.SOURCE_ONLY),
        "absent-value": (dose["value"].isNull(), routing.SOURCE_ONLY),
        "unit": (dose["value"].isNotNull() & F.col("unit_iri").isNull(), routing.REJECTED),
        "time": (_bad_time(F.col("effectiveDateTime")), routing.REJECTED),
    }, complete(maps.medication()))


def medication_graph(outcomes: DataFrame, keep: tuple[str, ...] = ("graph_key",)) -> DataFrame:
    m = maps.medication()
    return materialize_graph(m, bind(m, outcomes.where(F.col("outcome") == routing.MAPPED), keep), keep)


def resolved_reference(records: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """``records`` with target_key of their subject: relative, absolute, versioned and contained references."""
    contained = F.transform("contained", lambda c: F.get_json_object(c, "$.id")) if "contained" in records.columns else None
    return routing.resolve_refs(records, norm_ref(F.col("subject.reference"), F.lit(SERVER)), targets, key, contained)
