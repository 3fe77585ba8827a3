"""JSON records with their lexical forms kept, rendering to triples and back, rule tables, and a seeded generator.

Every leaf is read as a string straight from the file; numbers parsed on the way would lose ``55.00``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CODING = "ARRAY<STRUCT<system: STRING, code: STRING, display: STRING>>"
QUANTITY = "STRUCT<value: STRING, comparator: STRING, unit: STRING, system: STRING, code: STRING>"
META = "STRUCT<versionId: STRING, lastUpdated: STRING, profile: ARRAY<STRING>>"
#: Fixed schemas of the pinned release, by resource type.
SCHEMAS = {
    "Observation": f"""resourceType STRING, id STRING, meta {META}, status STRING, code STRUCT<coding: {CODING}, text: STRING>, subject STRUCT<reference: STRING>, effectiveDateTime STRING,
        effectivePeriod STRUCT<`start`: STRING, `end`: STRING>, issued STRING, method STRUCT<coding: {CODING}>, valueQuantity {QUANTITY}, valueString STRING, dataAbsentReason STRUCT<coding: {CODING}>,
        component ARRAY<STRUCT<code: STRUCT<coding: {CODING}>, valueQuantity: {QUANTITY}, dataAbsentReason: STRUCT<coding: {CODING}>, modifierExtension: ARRAY<STRUCT<url: STRING>>>>,
        contained ARRAY<STRING>, extension ARRAY<STRUCT<url: STRING>>, modifierExtension ARRAY<STRUCT<url: STRING>>""",
    "Encounter": f"""resourceType STRING, id STRING, meta {META}, status STRING, subject STRUCT<reference: STRING>, participant ARRAY<STRUCT<individual: STRUCT<reference: STRING>>>,
        period STRUCT<`start`: STRING, `end`: STRING>, modifierExtension ARRAY<STRUCT<url: STRING>>""",
    "MedicationAdministration": f"""resourceType STRING, id STRING, meta {META}, status STRING, medicationCodeableConcept STRUCT<coding: {CODING}>, subject STRUCT<reference: STRING>,
        performer ARRAY<STRUCT<actor: STRUCT<reference: STRING>>>, effectiveDateTime STRING, effectivePeriod STRUCT<`start`: STRING, `end`: STRING>,
        dosage STRUCT<route: STRUCT<coding: {CODING}>, dose: STRUCT<value: STRING, unit: STRING, system: STRING, code: STRING>>, modifierExtension ARRAY<STRUCT<url: STRING>>""",
}

#: Schemas of the tables that the host supplies.
RULES = {
    "identity_map": "source_ref string, person_iri string, rule_id string, evidence string",
    "unit_rule": "system string, code string, unit_iri string, snapshot string",
    "code_rule": "system string, code string, target_class string, map_id string, snapshot string",
    "status_policy": "resource_type string, status string, outcome string, policy_version string",
}


def read_json(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Newline-delimited records of one type, all leaves strings."""
    return spark.read.schema(SCHEMAS[kind]).json(path).where(F.col("resourceType") == kind)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """raw (verbatim) and digest of each record."""
    return spark.read.text(path).where("trim(value) <> ''").select(F.col("value").alias("raw"), F.sha2("value", 256).alias("digest"))


def profile_issues(records: DataFrame, profile: str | None, required: Iterable[str]) -> DataFrame:
    """``records`` with the issues found against the pinned profile: its declaration and required elements."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    if profile:
        checks.append(F.when(~F.coalesce(F.array_contains("meta.profile", profile), F.lit(False)), F.lit("profile not declared")))
    return records.withColumn("issues", F.array_compact(F.array(*checks)))


def read_rules(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The host's tables, one file of JSON lines each: identity_map, unit_rule, code_rule, status_policy."""
    return {name: spark.read.schema(schema).json(f"{folder.rstrip('/')}/{name}.json") for name, schema in RULES.items()}


def read_axioms(spark: SparkSession, path: str) -> DataFrame:
    """Pinned axioms, JSON lines: kind (disjoint, chain or inverse) and the terms a, b and c."""
    return spark.read.schema("kind string, a string, b string, c string").json(path)


def rdf(raw: DataFrame) -> DataFrame:
    """Every record of ``raw`` (digest, raw) as triples: digest, s, p, o_kind, o_value, o_datatype.

    Elements are nodes named by their path, primitives are wrapped under fhir:value with the lexical form that they have in
    the file, items of lists carry their place, and empty objects and lists are nodes without parts. Spark's JSON functions
    lose lexical forms of values in columns, so each record is parsed in Python: this is for checking fidelity, and the
    transform doesn't read it."""

    def render(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []

            def walk(digest: str, s: str, x) -> None:
                say = lambda p, kind, o, t=None: rows.append((digest, s, p, kind, o, t))
                if isinstance(x, dict):
                    say("rdf:type", "iri", "fhir:Element")
                    for k, v in x.items():
                        say(f"fhir:{k}", "iri", f"{s}/{k}")
                        walk(digest, f"{s}/{k}", v)
                elif isinstance(x, list):
                    say("rdf:type", "iri", "rdf:List")
                    for i, v in enumerate(x):
                        say(f"rdf:_{i}", "iri", f"{s}/{i}")
                        walk(digest, f"{s}/{i}", v)
                elif isinstance(x, _Number):
                    say("fhir:value", "literal", x.text, "xsd:decimal")
                elif isinstance(x, bool) or x is None:
                    say("fhir:value", "literal", json.dumps(x), "xsd:boolean" if x is not None else "rdf:nil")
                else:
                    say("fhir:value", "literal", x, "xsd:string")

            for digest, text in zip(pdf["digest"], pdf["raw"], strict=True):
                walk(digest, f"urn:record:{digest}", json.loads(text, parse_float=_Number, parse_int=_Number))
            yield pd.DataFrame(rows, columns=["digest", "s", "p", "o_kind", "o_value", "o_datatype"])

    return raw.select("digest", "raw").mapInPandas(render, "digest string, s string, p string, o_kind string, o_value string, o_datatype string")


class _Number:
    """A JSON number by its lexical form."""

    def __init__(self, text: str):
        self.text = text


def from_rdf(triples: DataFrame) -> DataFrame:
    """(digest, json): the records back from ``rdf``, one group of triples each, with members in the order of their names."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        parts: dict[str, list[tuple]] = {}
        for s, p, o, t in zip(pdf["s"], pdf["p"], pdf["o_value"], pdf["o_datatype"], strict=True):
            parts.setdefault(s, []).append((p, o, t))

        def text(s: str) -> str:
            own = {p: (o, t) for p, o, t in parts[s]}
            if "fhir:value" in own and "rdf:type" not in own:
                o, t = own["fhir:value"]
                return json.dumps(o) if t == "xsd:string" else o
            if own["rdf:type"][0] == "rdf:List":
                items = sorted((int(p[5:]), o) for p, (o, _) in own.items() if p.startswith("rdf:_"))
                return "[" + ",".join(text(o) for _, o in items) + "]"
            members = sorted((p[5:], o) for p, (o, _) in own.items() if p != "rdf:type")
            return "{" + ",".join(f"{json.dumps(k)}:{text(o)}" for k, o in members) + "}"

        digest = pdf["digest"].iloc[0]
        return pd.DataFrame({"digest": [digest], "json": [text(f"urn:record:{digest}")]})

    return triples.groupBy("digest").applyInPandas(build, "digest string, json string")


def adapt_r5(records: DataFrame) -> DataFrame:
    """Encounters of the later release in the form of the pinned one: actualPeriod and participant.actor, and its status of
    an ended encounter."""
    ended = F.when(F.col("status") == "completed", "finished").otherwise(F.col("status"))
    return records.withColumnRenamed("actualPeriod", "period").withColumns({
        "participant": F.transform("participant", lambda p: F.struct(F.struct(p["actor"]["reference"].alias("reference")).alias("individual"))), "status": ended,
    })


def generate(spark: SparkSession, n: int) -> DataFrame:
    """``n`` seeded synthetic records as JSON lines (column ``value``) that cover every outcome of every kind; the same on
    any number of partitions."""
    h = lambda salt, m: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(m))
    kind, variant, ident = h(1, 20), h(2, 12), F.col("id").cast("string")
    when = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + h(5, 10_000_000)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    coding = lambda code, system=F.lit("http://loinc.org"): F.struct(F.array(F.struct(system.alias("system"), code.alias("code"))).alias("coding"))
    meta = F.struct(F.lit("1").alias("versionId"), when.alias("lastUpdated"))
    subject = F.struct(F.when(variant == 6, "Patient/none").when(variant == 7, "Patient/two").otherwise(F.concat(F.lit("Patient/p"), h(3, 997))).alias("reference"))
    modifier = F.when(variant == 8, F.array(F.struct(F.lit("https://example.org/modifier").alias("url"))))
    quantity = lambda v, code: F.struct(v.alias("value"), F.when(variant == 2, "<").alias("comparator"), F.lit("http://unitsofmeasure.org").alias("system"), F.when(variant == 3, "bad").when(variant != 4, code).alias("code"))
    part = lambda code, v: F.struct(coding(F.lit(code)).alias("code"), F.when(variant != 1, quantity(v, F.lit("mm[Hg]"))).alias("valueQuantity"))
    tenth = lambda salt, low, m: ((h(salt, m * 10) + low * 10) / 10).cast("decimal(6,1)")
    status = lambda good, other: F.when(variant == 9, "entered-in-error").when(variant == 10, other).otherwise(good).alias("status")
    at = F.when(variant == 11, F.substring(when, 1, 7)).otherwise(when)
    egfr = F.struct(
        F.lit("Observation").alias("resourceType"), F.concat(F.lit("egfr-"), ident).alias("id"), meta.alias("meta"), status("final", "preliminary"), coding(F.when(variant == 5, "0000-0").otherwise("33914-3")).alias("code"),
        subject.alias("subject"), at.alias("effectiveDateTime"), F.when(variant != 1, quantity(tenth(6, 10, 90), F.lit("mL/min/{1.73_m2}"))).alias("valueQuantity"), modifier.alias("modifierExtension"),
    )
    panel = F.struct(
        F.lit("Observation").alias("resourceType"), F.concat(F.lit("bp-"), ident).alias("id"), meta.alias("meta"), status("final", "preliminary"), coding(F.lit("85354-9")).alias("code"), subject.alias("subject"),
        at.alias("effectiveDateTime"), F.array(part("8480-6", tenth(7, 90, 60)), part("8462-4", tenth(8, 50, 40))).alias("component"), modifier.alias("modifierExtension"),
    )
    encounter = F.struct(
        F.lit("Encounter").alias("resourceType"), F.concat(F.lit("enc-"), ident).alias("id"), meta.alias("meta"), status("finished", "in-progress"), subject.alias("subject"),
        F.array(F.struct(F.struct(F.concat(F.lit("Practitioner/c"), h(9, 97)).alias("reference")).alias("individual"))).alias("participant"), F.struct(at.alias("start"), F.when(variant != 5, at).alias("end")).alias("period"), modifier.alias("modifierExtension"),
    )
    dose = F.struct(
        F.lit("MedicationAdministration").alias("resourceType"), F.concat(F.lit("med-"), ident).alias("id"), meta.alias("meta"), status("completed", "in-progress"), coding(F.concat(F.lit("m"), h(10, 50)), F.lit("https://example.org/drugs")).alias("medicationCodeableConcept"),
        subject.alias("subject"), F.array(F.struct(F.struct(F.concat(F.lit("Practitioner/c"), h(9, 97)).alias("reference")).alias("actor"))).alias("performer"), at.alias("effectiveDateTime"),
        F.struct(coding(F.lit("PO"), F.lit("https://example.org/routes")).alias("route"), F.struct(tenth(11, 1, 20).alias("value"), F.lit("http://unitsofmeasure.org").alias("system"), F.when(variant == 3, "bad").otherwise("mg").alias("code")).alias("dose")).alias("dosage"), modifier.alias("modifierExtension"),
    )
    return spark.range(n).select(F.when(kind < 10, F.to_json(egfr)).when(kind < 15, F.to_json(panel)).when(kind < 18, F.to_json(encounter)).otherwise(F.to_json(dose)).alias("value"))


def generate_rules() -> dict[str, list[dict]]:
    """The tables that go with ``generate``; one reference has two candidates."""
    people = [(f"Patient/p{i}", f"ex:person-p{i}") for i in range(997)] + [(f"Practitioner/c{i}", f"ex:clinician-c{i}") for i in range(97)] + [("Patient/two", "ex:a"), ("Patient/two", "ex:b")]
    units = [("mL/min/{1.73_m2}", "ex:ucum-mL-min-1_73_m2"), ("mm[Hg]", "ex:ucum-mm-Hg"), ("mg", "ex:ucum-mg")]
    policy = [("Observation", "final"), ("Observation", "amended"), ("Observation", "corrected"), ("Observation", "preliminary"), ("Encounter", "finished"), ("MedicationAdministration", "completed")]
    return {
        "identity_map": [{"source_ref": r, "person_iri": p, "rule_id": "synthetic", "evidence": "generated"} for r, p in people],
        "unit_rule": [{"system": "http://unitsofmeasure.org", "code": c, "unit_iri": u, "snapshot": "synthetic"} for c, u in units],
        "code_rule": [{"system": "http://loinc.org", "code": "33914-3", "target_class": "ex:EGFRResult", "map_id": "egfr", "snapshot": "synthetic"}],
        "status_policy": [{"resource_type": t, "status": s, "outcome": "mapped", "policy_version": "1"} for t, s in policy],
    }
