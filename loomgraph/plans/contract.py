"""Maps as data: what a map file says, and the checks that it passes before any data is read.

A map is a JSON object. ``source`` has the value sets of elements (``values``), the variables bound once per record
(``bind``: variable to path, datatype and least number) and repeated groups (``scopes``: name to path, ``least`` and the
variables bound in each repetition). ``static`` names the variables that the run supplies. ``target`` lists nodes: a key
template with ``{variables}``, the scope whose repetitions the node follows, its types, and its triples, each with one of
``var`` (a literal with its ``datatype``, or ``time`` for the narrowest one that fits), ``iri`` (a variable) or ``node``.
An ``optional`` triple or node is left out where a value is null. The other entries are the map's manifest.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

MANIFEST_FIELDS = (
    "map_id", "semver", "source_release", "source_profile", "source_shape", "target_shape", "terminology_deps", "status_eligibility",
    "expected_failures", "ontology_version", "fixtures", "nonmapped_fields",
)


class MapError(ValueError):
    """A map that must not run."""


@dataclass(frozen=True)
class MapContract:
    map_id: str
    spec: dict
    pair_hash: str

    @property
    def source(self) -> dict:
        return self.spec["source"]

    @property
    def target(self) -> list[dict]:
        return self.spec["target"]

    @property
    def static(self) -> list[str]:
        return self.spec.get("static", [])

    @property
    def types(self) -> list[str]:
        """The classes that the map may assert."""
        return sorted({t for node in self.target for t in node.get("types", [])})

    def node(self, label: str) -> dict:
        return next(n for n in self.target if n["label"] == label)

    def scope_of(self) -> dict[str, str | None]:
        """Each variable of the source and of the run with the scope that binds it (None: once per record)."""
        found: dict[str, str | None] = dict.fromkeys([*self.source.get("bind", {}), *self.static])
        for name, scope in self.source.get("scopes", {}).items():
            found |= dict.fromkeys(scope["bind"], name)
        return found

    def required(self) -> list[str]:
        """Variables bound once per record without which the target is incomplete."""
        used = {v for n in self.target if not n.get("scope") and not n.get("optional") for v in [*key_variables(n), *(t.get("var") or t.get("iri") for t in n["triples"] if not t.get("optional"))] if v}
        once = {v for v, scope in self.scope_of().items() if scope is None}
        return sorted((used | {v for v, b in self.source.get("bind", {}).items() if b.get("least", 1)}) & once - set(self.spec.get("optional_static", [])))


def key_variables(node: dict) -> list[str]:
    return re.findall(r"\{([^{}]+)\}", node.get("key") or "")


def load(text: str) -> MapContract:
    """A map from its file's text. Its hash is that of the content, whatever the spacing of the file."""
    spec = json.loads(text)
    return MapContract(spec["map_id"], spec, hashlib.sha256(json.dumps(spec, sort_keys=True).encode()).hexdigest())


def check(m: MapContract) -> list[str]:
    """What is wrong with a map; empty if it may run."""
    errors: list[str] = []
    bound = m.scope_of()
    names = [*m.source.get("bind", {}), *m.static, *(v for s in m.source.get("scopes", {}).values() for v in s["bind"])]
    errors += [f"{v} is bound twice" for v in sorted({v for v in names if names.count(v) > 1})]
    labels = {n["label"]: n for n in m.target}
    for node in m.target:
        label, key, scope = node["label"], node.get("key"), node.get("scope")
        if not key:
            errors.append(f"invalid id(): {label} has no node key")
            continue
        if key.count("{") != key.count("}") or re.search(r"\{\s*\}", key):
            errors.append(f"invalid id(): {key}")
        for v in [*key_variables(node), *(t.get("var") or t.get("iri") for t in node["triples"])]:
            if v and v not in bound:
                errors.append(f"unbound variable: {v} in {label}")
            elif v and bound[v] is not None and bound[v] != scope:
                errors.append(f"incompatible scopes: {v} repeats with {bound[v]}, {label} with {scope or 'its record'}")
        if scope and not any(bound.get(v) == scope for v in key_variables(node)):
            errors.append(f"invalid id(): the key of {label} is the same for every {scope}")
        for t in node["triples"]:
            other = labels.get(t["node"]) if t.get("node") else None
            if t.get("node") and other is None:
                errors.append(f"node {t['node']} is not defined")
            if other and other.get("scope") and other["scope"] != scope and not t.get("many"):
                errors.append(f"incompatible scopes: {label} refers once to {other['label']}, which repeats")
    return errors


def checked(m: MapContract) -> MapContract:
    if errors := check(m):
        raise MapError("; ".join(errors))
    return m


def check_manifest(m: MapContract) -> list[str]:
    """A manifest is complete if every entry is there and every element that the source binds, guards or leaves out is
    named once; every variable is used by the target or declared as lineage only."""
    errors = [f"missing: {f}" for f in MANIFEST_FIELDS if f not in m.spec]
    if set(m.source.get("values", {}).get("status", [])) - set(m.spec.get("status_eligibility", [])):
        errors.append("a status is mapped that isn't eligible")
    if not m.spec.get("fixtures"):
        errors.append("no fixture")
    used = {v for n in m.target for v in [*key_variables(n), *(t.get("var") or t.get("iri") for t in n["triples"])] if v}
    errors += [f"variable without a rule: {v}" for v in sorted(set(m.scope_of()) - used - set(m.spec.get("lineage_only", [])) - {f"{m.map_id}:id"})]
    paths = {b["path"].split(".")[0] for b in m.source.get("bind", {}).values()} | set(m.source.get("values", {}))
    errors += [f"{p} is mapped and declared as not mapped" for p in sorted(paths & set(m.spec.get("nonmapped_fields", [])))]
    return errors
