"""The elements that records have at any level: inventory, elements without a rule, modifiers; and conformance to constraints.

Both are built-in expressions. The inventory walks the JSON itself, since readers drop what their schema doesn't have;
conformance is generated from the schema and a table of constraints, so that repetitions at any level are checked within
the record's row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from ..functions.terms import is_decimal, time_precision

#: Levels that the walk follows; what lies deeper is reported under DEEPER, not lost.
DEPTH = 12
DEEPER = "(deeper)"
#: Elements whose content is kept as it is: nothing below them needs a rule.
OPAQUE = ("contained",)


def walk(rows: DataFrame, raw: str, *keep: str, depth: int = DEPTH) -> DataFrame:
    """``keep`` and ``path``, an array of names, for every element without parts of the JSON in ``raw``. Positions in lists are
    erased. One pass, one generator per level, no shuffle; malformed and null JSON has no element."""
    tvf = rows.sparkSession.tvf
    out = rows.select(*keep, F.try_parse_json(F.col(raw)).alias("v"), F.array().cast("array<string>").alias("path"))
    for _ in range(depth):
        each = tvf.variant_explode_outer(F.col("v").outer())
        longer = F.when(F.col("key").isNotNull(), F.concat("path", F.array("key"))).otherwise(F.col("path"))
        out = out.lateralJoin(each).select(*keep, longer.alias("path"), F.col("value").alias("v"))
    kind = F.schema_of_variant("v")
    more = F.coalesce(kind.rlike("^(OBJECT|ARRAY)<.+>$") & (kind != "ARRAY<VOID>"), F.lit(False))  # something is left below
    return out.select(*keep, F.when(more, F.concat("path", F.array(F.lit(DEEPER)))).otherwise(F.col("path")).alias("path"))


def elements(rows: DataFrame, raw: str, *keep: str, depth: int = DEPTH) -> DataFrame:
    """``keep`` and ``path`` (names joined by dots) of every element of each row, once each row."""
    paths = walk(rows, raw, *keep, depth=depth)
    every = F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.array_join(F.slice("path", F.lit(1), n), "."))
    return paths.where(F.size("path") > 0).select(*keep, F.explode(every).alias("path")).distinct()


def schema_paths(schema: DataType, before: str = "") -> list[str]:
    """The paths of a schema's elements, without positions in lists."""
    if isinstance(schema, ArrayType):
        return schema_paths(schema.elementType, before)
    if not isinstance(schema, StructType):
        return []
    return [p for f in schema.fields for p in (f"{before}{f.name}", *schema_paths(f.dataType, f"{before}{f.name}."))]


def inventory(found: DataFrame, allowed: Iterable[str], kind: str = "kind") -> DataFrame:
    """(kind, path, finding, n): how many records have an element that no rule names (``unknown``: only the outermost of
    nested ones), and a modifier extension at any level (``modifier``). ``found``: kind and path of every record's elements;
    ``allowed``: "kind:path", as few as the schemas' elements."""
    known = F.array(*[F.lit(x) for x in sorted(set(allowed))])
    at = F.concat_ws(":", F.col(kind), F.col("path"))
    parent = F.regexp_replace("path", r"\.?[^.]*$", "")
    is_known = lambda c: F.array_contains(known, c)
    opaque = F.split_part("path", F.lit("."), F.lit(1)).isin(*OPAQUE)
    new = ~is_known(at) & ((parent == "") | is_known(F.concat_ws(":", F.col(kind), parent))) & ~opaque
    modifier = F.element_at(F.split("path", r"\."), -1) == "modifierExtension"
    counts = found.groupBy(kind, "path").agg(F.count(F.lit(1)).alias("n"))  # as few rows as there are paths
    findings = F.array_compact(F.array(F.when(new, F.lit("unknown")), F.when(modifier, F.lit("modifier"))))
    return counts.select(kind, "path", F.explode(findings).alias("finding"), "n")


# --- conformance ---------------------------------------------------------------------------------------------

CONSTRAINTS = "kind string, path string, least int, most int, type string, values array<string>"
#: What values of a type look like, by the type's name.
TYPES: dict[str, Callable[[Column], Column]] = {
    "decimal": is_decimal,
    "time": lambda c: time_precision(c) != "invalid",
    "id": lambda c: F.rlike(c, F.lit(r"^[A-Za-z0-9.-]{1,64}$")),
    "reference": lambda c: F.rlike(c, F.lit(r"^(#.+|[A-Za-z]+/[^/]+(/_history/[^/]+)?|[A-Za-z][A-Za-z0-9+.-]*:.+)$")),
}


def _checks(value: Column, kind: DataType, c: dict) -> dict[str, Column]:
    """What may be wrong with one occurrence of an element's parent: its number, type and value."""
    repeated = isinstance(kind, ArrayType)
    n = F.coalesce(F.size(value), F.lit(0)) if repeated else F.when(value.isNull(), 0).otherwise(1)
    any_of = lambda bad: F.coalesce(F.exists(value, lambda x: x.isNotNull() & bad(x)) if repeated else value.isNotNull() & bad(value), F.lit(False))
    out = {}
    if c.get("least") or c.get("most") is not None:
        out["number"] = (n < (c.get("least") or 0)) | (n > c["most"] if c.get("most") is not None else F.lit(False))
    if c.get("type") in TYPES:
        out["type"] = any_of(lambda x: ~TYPES[c["type"]](x))
    if c.get("values"):
        out["value"] = any_of(lambda x: ~x.isin(*c["values"]))
    return out


def _within(value: Column, kind: DataType, steps: list[str], c: dict, check: str) -> Column:
    """Whether any occurrence of the parent, in whatever repetitions, fails a check."""
    if isinstance(kind, ArrayType):
        return F.coalesce(F.exists(value, lambda x: x.isNotNull() & _within(x, kind.elementType, steps, c, check)), F.lit(False))
    child, child_kind = value[steps[0]], kind[steps[0]].dataType
    bad = _checks(child, child_kind, c)[check] if len(steps) == 1 else _within(child, child_kind, steps[1:], c, check)
    return value.isNotNull() & bad


def issues(schema: StructType, constraints: Iterable[dict]) -> Column:
    """An array of what is wrong with a record of ``schema``: "path: number", "path: type" or "path: value", in the order of the
    constraints (path, least, most, type, values). Numbers are per parent: an element of a repeated group is counted in each
    repetition, and one whose parent isn't there isn't missing. A path that the schema lacks is an error before any data is read."""
    out = []
    for c in constraints:
        first, *rest = c["path"].split(".")
        kind = schema[first].dataType
        names = _checks(F.lit(None).cast("string"), _type_at(schema, c["path"]), c) if rest else _checks(F.col(first), kind, c)
        for check in names:
            bad = _within(F.col(first), kind, rest, c, check) if rest else names[check]
            out.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(f"{c['path']}: {check}")))
    return F.array_compact(F.array(*out)) if out else F.array().cast("array<string>")


def _type_at(schema: DataType, path: str) -> DataType:
    for name in path.split("."):
        while isinstance(schema, ArrayType):
            schema = schema.elementType
        schema = schema[name].dataType
    return schema
