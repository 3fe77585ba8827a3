"""Deterministic identities, literals, references and time forms, all as built-in column expressions.

A key with a null part is null, never a shortened key: rows with null keys are routed away before any
graph is made.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def node_id(template: str, parts: Mapping[str, Column], strict: bool = False) -> Column:
    """``id(...)``: the template with each ``{name}`` filled in; null (``strict``: an error) if one is null."""
    pieces = re.split(r"\{([^}]+)\}", template)
    out = F.concat(*[parts[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(pieces) if p])
    if strict:
        out = F.when(out.isNull(), F.raise_error(F.lit(f"null key part in {template}")).cast("string")).otherwise(out)
    return out


def content_hash(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def key_hash(*parts: Column) -> Column:
    """A hash of several parts in an encoding that no two different lists of parts share."""
    return F.sha2(F.to_json(F.struct(*[p.cast("string").alias(f"k{i}") for i, p in enumerate(parts)]), {"ignoreNullFields": "false"}), 256)


def version_iri(base: Column, kind: Column, ident: Column, version: Column) -> Column:
    return F.concat(base, F.lit("/"), kind, F.lit("/"), ident, F.lit("/_history/"), version)


def graph_key(server: Column, kind: Column, ident: Column, version: Column, map_id: Column) -> Column:
    """One per source version and map; a map's hash isn't part of it, so a new build of the map replaces."""
    return F.concat(F.lit("graph:"), F.sha2(F.to_json(F.array(server, kind, ident, version, map_id)), 256))


def norm_ref(reference: Column, base: Column) -> Column:
    """Relative and absolute references as absolute keys without a version; contained ones (#id) unchanged."""
    plain = F.regexp_replace(reference, r"/_history/[^/]*$", "")
    return F.when(F.startswith(plain, F.lit("#")), plain).when(F.rlike(plain, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")), plain).when(F.rlike(plain, F.lit("^[A-Za-z]+/[^/]+$")), F.concat(base, F.lit("/"), plain))


def relative_ref(reference: Column, base: str) -> Column:
    """A reference as identity tables have it: relative, and without the version that it names. Only those that need it pay."""
    longer = F.contains(reference, F.lit("/_history/")) | F.startswith(reference, F.lit(base + "/"))
    return F.when(longer, F.regexp_replace(F.replace(reference, F.lit(base + "/"), F.lit("")), r"/_history/[^/]*$", "")).otherwise(reference)


def local_id(ident: Column, prefix: str) -> Column:
    """The part of an id that node keys take: without the prefix that ids of its kind have, and marked where an id has none, so
    that no two ids share a key."""
    rest = F.substring(ident, F.lit(len(prefix) + 1), F.length(ident))
    plain = F.when(F.startswith(ident, F.lit(prefix)), rest).otherwise(F.concat(F.lit("~."), ident))
    return F.when(F.contains(ident, F.lit("~")), F.when(F.startswith(ident, F.lit(prefix)), F.replace(rest, F.lit("~"), F.lit("~~"))).otherwise(F.concat(F.lit("~."), F.replace(ident, F.lit("~"), F.lit("~~"))))).otherwise(plain)


def quality_key(policy: str, name: str, person: Column, source: Column, time: Column, code: Column) -> Column:
    """``persistent``: one quality per person; ``observation``: one per observation, time and code."""
    if policy == "persistent":
        return F.concat(F.lit(f"ex:{name}-"), F.regexp_replace(person, "^ex:person-", ""))
    if policy == "observation":
        return F.concat(F.lit(f"ex:{name}-"), F.substring(key_hash(person, source, time, code), 1, 32))
    raise ValueError(f"unknown quality policy {policy}")


def coding_key(coding: Column) -> Column:
    return F.struct(coding["system"].alias("system"), coding["code"].alias("code"))


def has_code(concept: Column, system: str, code: str) -> Column:
    return F.coalesce(F.exists(concept["coding"], lambda c: (c["system"] == system) & (c["code"] == code)), F.lit(False))


def time_precision(lexical: Column) -> Column:
    """The precision that a time was given with; never a cast, which would invent the missing parts."""
    forms = (
        ("instant", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"), ("local", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"),
        ("day", r"^\d{4}-\d{2}-\d{2}$"), ("month", r"^\d{4}-\d{2}$"), ("year", r"^\d{4}$"),
    )
    out = F.when(lexical.isNull(), F.lit(None).cast("string"))
    for name, form in forms:
        out = out.when(F.rlike(lexical, F.lit(form)), name)
    return out.otherwise("invalid")


def time_datatype(lexical: Column) -> Column:
    """The narrowest datatype that says no more than the value does."""
    kinds = {"instant": "xsd:dateTimeStamp", "local": "xsd:dateTime", "day": "xsd:date", "month": "xsd:gYearMonth", "year": "xsd:gYear"}
    p = time_precision(lexical)
    out = F.when(p.isNull(), F.lit(None).cast("string"))
    for k, v in kinds.items():
        out = out.when(p == k, v)
    return out


def interval_nodes(start: Column, end: Column) -> Column:
    """The ends that an interval has, as an array of (kind, value): an open one has no end, and none is made up."""
    ends = F.array(F.struct(F.lit("start").alias("kind"), start.alias("value")), F.struct(F.lit("end").alias("kind"), end.alias("value")))
    return F.filter(ends, lambda x: x["value"].isNotNull())


def is_decimal(lexical: Column) -> Column:
    return F.rlike(lexical, F.lit(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"))
