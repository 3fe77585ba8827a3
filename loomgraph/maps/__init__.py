"""The reviewed maps: one JSON file each, read by ``load``. Prefixed names stay as they are in terms; ``PREFIXES`` expands
them on export."""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

from ..plans.contract import MapContract, load

#: Namespaces and code systems of public vocabularies.
PREFIXES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "prov": "http://www.w3.org/ns/prov#",
    "sulo": "https://w3id.org/sulo/",
    "fhir": "http://hl7.org/fhir/",
    "ex": "https://example.org/graph/",
}
LOINC, UCUM = "http://loinc.org", "http://unitsofmeasure.org"
EGFR_CODE, PANEL_CODE, SYSTOLIC, DIASTOLIC = "33914-3", "85354-9", "8480-6", "8462-4"


@lru_cache
def named(name: str) -> MapContract:
    return load(Path(__file__).with_name(f"{name}.json").read_text("utf-8"))


def egfr() -> MapContract:
    return named("egfr")


def blood_pressure() -> MapContract:
    return named("bp")


def encounter() -> MapContract:
    return named("encounter")


def medication() -> MapContract:
    return named("medication")
