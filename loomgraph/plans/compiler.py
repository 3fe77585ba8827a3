"""A checked map as column expressions: bindings, quads with lineage, and back.

Bindings stay in the row of their record (repeated ones as arrays of structs, one per repetition), so the join of source
and target on shared variables needs no shuffle: materialisation is one explode of an array of structs.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.terms import is_decimal, node_id, time_datatype
from .contract import MapContract, checked, key_variables

QUAD = ("s", "p", "o_kind", "o_value", "o_datatype")
TRIPLE = "struct<s:string,p:string,o_kind:string,o_value:string,o_datatype:string,var:string,is_constant:boolean,constraint_id:string,optional:boolean>"


def _name(var: str) -> str:
    return re.sub(r"\W", "_", var.split(":")[-1])


def _fits(binding: dict, value: Column) -> Column:
    """Whether a value is there, if it must be, and has its datatype."""
    ok = is_decimal(value) if binding.get("datatype") == "xsd:decimal" else F.lit(True)
    return F.coalesce(ok & value.isNotNull(), F.lit(False)) if binding.get("least", 1) else value.isNull() | F.coalesce(ok, F.lit(False))


def _at(row, path: str) -> Column:
    first, *rest = path.split(".")
    return reduce(lambda c, n: c[n], rest, row(first))


def conditions(m: MapContract, row=F.col) -> Column:
    """Whether the record has the value sets, datatypes and numbers that the source asks for, in every repetition too."""
    out = [F.coalesce(_at(row, path).isin(*values), F.lit(False)) for path, values in m.source.get("values", {}).items()]
    out += [_fits(b, _at(row, b["path"])) for b in m.source.get("bind", {}).values()]
    for scope in m.source.get("scopes", {}).values():
        group = _at(row, scope["path"])
        out.append(F.coalesce(F.size(group), F.lit(0)) >= scope.get("least", 0))
        each = lambda x: reduce(lambda a, b: a & b, [_fits(b, _at(lambda n: x[n], b["path"])) for b in scope["bind"].values()])  # noqa: E731, B023
        out.append(F.coalesce(F.forall(group, each), F.lit(True)))
    return reduce(lambda a, b: a & b, out, F.lit(True))


def complete(m: MapContract) -> Column:
    """Whether all variables that the target needs are there: those that the run supplies as well."""
    static = [F.col(_name(v)).isNotNull() for v in m.required() if v in m.static]
    return reduce(lambda a, b: a & b, static, conditions(m))


def bind(m: MapContract, records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and ``b`` (a struct of the variables once per record) and one array of structs per scope, in columns
    ``scope_<name>``. Null elements of a repeated group stay elements."""
    checked(m)
    once = {v: _at(F.col, b["path"]) for v, b in m.source.get("bind", {}).items()} | {v: F.col(_name(v)) for v in m.static}
    scopes = {}
    for name, scope in m.source.get("scopes", {}).items():
        element = lambda x: F.struct(*[_at(lambda n: x[n], b["path"]).cast("string").alias(_name(v)) for v, b in scope["bind"].items()])  # noqa: E731, B023
        scopes[name] = F.transform(_at(F.col, scope["path"]), element)
    return records.select(*keep, F.struct(*[v.cast("string").alias(_name(k)) for k, v in once.items()]).alias("b"), *[v.alias(f"scope_{k}") for k, v in scopes.items()])


def materialize_graph(m: MapContract, bound: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, the quad columns and the lineage of each (var, is_constant, constraint_id), from the rows of ``bind``.

    One explode per row. An optional triple whose key or value is null is left out; of others none is null if the record
    passed ``complete``."""
    scope_of = m.scope_of()

    def get(var: str, x: Column | None) -> Column:
        return x[_name(var)] if scope_of.get(var) is not None and x is not None else F.col(f"b.{_name(var)}")

    def key(node: dict, x: Column | None) -> Column:
        return node_id(node["key"], {v: get(v, x) for v in key_variables(node)})

    def say(node, i, s, p, kind, value, datatype, var, optional) -> Column:
        return F.struct(
            s.alias("s"), F.lit(p).alias("p"), F.lit(kind).alias("o_kind"), value.cast("string").alias("o_value"), datatype.cast("string").alias("o_datatype"),
            F.lit(var).cast("string").alias("var"), F.lit(var is None).alias("is_constant"), F.lit(f"{node['label']}#{i}").alias("constraint_id"), F.lit(bool(optional)).alias("optional"),
        )

    def triples(node: dict, x: Column | None) -> list[Column]:
        none, gone = F.lit(None), node.get("optional")
        out = [say(node, 0, key(node, x), "rdf:type", "iri", F.lit(t), none, None, gone) for t in node.get("types", [])]
        for i, t in enumerate(node["triples"], 1):
            optional = gone or t.get("optional")
            if "node" in t:
                other = m.node(t["node"])
                if other.get("scope") and other["scope"] != node.get("scope"):
                    continue  # stated from the repeated side
                out.append(say(node, i, key(node, x), t["p"], "iri", key(other, x), none, ",".join(key_variables(other)), optional))
            elif "iri" in t:
                out.append(say(node, i, key(node, x), t["p"], "iri", get(t["iri"], x), none, t["iri"], optional))
            else:
                value = get(t["var"], x)
                out.append(say(node, i, key(node, x), t["p"], "literal", value, time_datatype(value) if t["datatype"] == "time" else F.lit(t["datatype"]), t["var"], optional))
        return out

    def back_links(scope: str, x: Column) -> list[Column]:
        """Links of once-per-record nodes to the repeated ones."""
        return [
            say(node, i, key(node, None), t["p"], "iri", key(m.node(t["node"]), x), F.lit(None), ",".join(key_variables(m.node(t["node"]))), t.get("optional"))
            for node in m.target if not node.get("scope") for i, t in enumerate(node["triples"], 1) if "node" in t and m.node(t["node"]).get("scope") == scope
        ]

    arrays = [F.array(*[t for n in m.target if not n.get("scope") for t in triples(n, None)])]
    for scope in m.source.get("scopes", {}):
        each = lambda x: F.array(*[t for n in m.target if n.get("scope") == scope for t in triples(n, x)], *back_links(scope, x))  # noqa: E731, B023
        arrays.append(F.coalesce(F.flatten(F.transform(F.col(f"scope_{scope}"), each)), F.array().cast(f"array<{TRIPLE}>")))
    rows = bound.select(*keep, F.explode(F.concat(*arrays) if len(arrays) > 1 else arrays[0]).alias("t")).select(*keep, "t.*")
    return rows.where(~(F.col("optional") & (F.col("o_value").isNull() | F.col("s").isNull()))).drop("optional")


def invert(m: MapContract, quads: DataFrame, graph: str = "graph_key") -> DataFrame:
    """The shared variables back from the graph, along the target: (graph, node, scope, var, value).

    A literal's variable is the value of its predicate on nodes of the node's types; variables in node keys are read from
    the key by its template. One grouping by subject, whose triples are those of one record, and no join."""
    whole = quads.groupBy(graph, F.col("s").alias("node")).agg(F.collect_list(F.struct("p", "o_value")).alias("t"))
    types = F.transform(F.filter("t", lambda t: t["p"] == "rdf:type"), lambda t: t["o_value"])
    found = []
    for node in m.target:
        is_node = F.size(F.array_intersect(types, F.array(*[F.lit(t) for t in node["types"]]))) == len(set(node["types"]))
        say = lambda var, value: F.struct(F.lit(node.get("scope")).cast("string").alias("scope"), F.lit(var).alias("var"), value.alias("value"))  # noqa: E731, B023
        rows = []
        for p, var in {t["p"]: t["var"] for t in node["triples"] if t.get("var") and t["var"] not in m.static}.items():
            rows.append(F.transform(F.filter("t", lambda t: t["p"] == p), lambda t: say(var, t["o_value"])))  # noqa: B023
        pattern = "^" + "(.+)".join(re.escape(x) for x in re.split(r"\{[^}]+\}", node["key"])) + "$"
        if len(keys := key_variables(node)) == 1 and keys[0] not in m.static:
            rows.append(F.array(say(keys[0], F.regexp_extract("node", pattern, 1))))
        found += [F.when(is_node, r) for r in rows]
    pairs = F.flatten(F.array_compact(F.array(*found)))
    return whole.select(graph, "node", F.explode(pairs).alias("x")).select(graph, "node", "x.*")
