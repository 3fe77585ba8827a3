"""Operators on quads: hashes, set operations, entailment, integrity checks, competency queries, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("graph_key", "s", "p", "o_kind", "o_value", "o_datatype")
FORBIDDEN = ("hasPatient", "sulo:hasPatient", "owl:sameAs")


def quad_text() -> Column:
    """The canonical line of a quad without its graph; literals by their lexical form."""
    value = F.regexp_replace(F.regexp_replace(F.regexp_replace("o_value", r"\\", r"\\\\"), '"', r'\\"'), "\n", r"\\n")
    literal = F.concat(F.lit('"'), value, F.lit('"'), F.coalesce(F.concat(F.lit("^^"), F.nullif("o_datatype", F.lit("xsd:string"))), F.lit("")))
    return F.concat_ws(" ", "s", "p", F.when(F.col("o_kind") == "literal", literal).otherwise(F.col("o_value")))


def distinct_quads(quads: DataFrame) -> DataFrame:
    return quads.dropDuplicates(list(KEYS))


def graph_hash(quads: DataFrame) -> DataFrame:
    """(graph_key, hash) over the ordered distinct lines of each graph: a graph is one source version's. One exchange."""
    lines = F.array_sort(F.collect_set(quad_text()))
    return quads.groupBy("graph_key").agg(F.sha2(F.array_join(lines, "\n"), 256).alias("hash"))


def expect_graph(quads: DataFrame, golden: DataFrame) -> DataFrame:
    """Quads that only one side has, without regard to graphs: (s, p, o_kind, o_value, o_datatype, side). Empty if equal."""
    a, b = (q.select(*KEYS[1:]).distinct() for q in (quads, golden))
    return a.subtract(b).withColumn("side", F.lit("unexpected")).unionByName(b.subtract(a).withColumn("side", F.lit("missing")))


def cardinality(bound: DataFrame, m, key: str = "graph_key") -> DataFrame:
    """Violations of the numbers that a map declares, from its bindings: (key, var, n). A variable that must be there has
    to have a value in every repetition of its scope."""
    scope_of, out = m.scope_of(), []
    for var, b in [*m.source.get("bind", {}).items(), *(x for s in m.source.get("scopes", {}).values() for x in s["bind"].items())]:
        name = var.split(":")[-1]
        if b.get("least", 1):
            scope = scope_of[var]
            n = F.when(F.col(f"b.{name}").isNull(), 1).otherwise(0) if scope is None else F.coalesce(F.size(F.filter(f"scope_{scope}", lambda x: x[name].isNull())), F.lit(0))
            out.append(F.struct(F.lit(var).alias("var"), n.cast("long").alias("n")))
    return bound.select(key, F.explode(F.array(*out)).alias("x")).select(key, "x.*").where("n > 0")


def nest(parts: DataFrame, key: str, *fields: str) -> DataFrame:
    """(key, tree): the repetitions of each record in one array of structs, in the order of their content."""
    return parts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("tree"))


def pivot_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Triples that only one side has, apart from the source records that they were derived from, so that graphs of
    records of two releases compare: (s, p, o_kind, o_value, o_datatype, side)."""
    clean = lambda q: q.where("p <> 'prov:wasDerivedFrom'")
    return expect_graph(clean(a), clean(b))


def validate_target(quads: DataFrame, m) -> DataFrame:
    """Violations of the target that a map declares: (graph_key, s, violation). A node of one of its kinds has each triple
    that isn't optional, once unless it may repeat, and literals have the declared datatype. One exchange: a subject's
    triples are those of one record."""
    whole = quads.groupBy("graph_key", "s").agg(F.collect_set(F.struct("p", "o_value", "o_datatype")).alias("t"))
    types = F.transform(F.filter("t", lambda t: t["p"] == "rdf:type"), lambda t: t["o_value"])
    bad = []
    for node in m.target:
        own = [] if node.get("optional") else [t for t in node["triples"] if not t.get("optional")]
        is_node = F.size(F.array_intersect(types, F.array(*[F.lit(x) for x in node["types"]]))) == len(node["types"])
        for p in dict.fromkeys(t["p"] for t in own):
            if not any(t["p"] == p and (t.get("many") or t.get("optional")) for t in node["triples"]):
                n = sum(t["p"] == p for t in own)
                bad.append(F.when(is_node & (F.size(F.filter("t", lambda t: t["p"] == p)) != n), F.lit(f"{node['label']}: {p} isn't there {n} times")))  # noqa: B023
        for t in node["triples"]:
            if t.get("datatype") and t["datatype"] != "time":
                p, datatype = t["p"], t["datatype"]
                wrong = F.exists("t", lambda x: (x["p"] == p) & ~x["o_datatype"].eqNullSafe(F.lit(datatype)))  # noqa: B023
                bad.append(F.when(is_node & wrong, F.lit(f"{node['label']}: {p} isn't {datatype}")))
    return whole.select("graph_key", "s", F.explode(F.array_compact(F.array(*bad))).alias("violation"))


def multiset_hash(line: Column) -> Column:
    """An aggregate that is the same for the same lines in any order and split: their number, and two sums of 60 bits each of
    their SHA-256. Sums are decimals, which 10**19 lines don't fill; partial sums meet in any order."""
    return _summed(F.sha2(line.cast("binary"), 256))


def _summed(hexes: Column) -> Column:
    part = lambda at: F.sum(F.conv(F.substring(hexes, at, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").cast("string")
    return F.concat_ws("-", F.count(F.lit(1)).cast("string"), part(1), part(16))


def validation_digest(violations: DataFrame) -> str:
    """A digest of a validation report that doesn't depend on the order of its rows. Fields are parted so that none runs into
    the next."""
    line = F.to_json(F.struct("graph_key", "s", "violation"), {"ignoreNullFields": "false"})
    return violations.agg(F.sha2(multiset_hash(line).cast("binary"), 256)).first()[0]


def set_hashes(quads: DataFrame) -> DataFrame:
    """(graph_key, h): a hash of each graph as a set, by sums and so without its lines in one place. Lines are told apart by their
    SHA-256, which is shorter."""
    line = F.to_json(F.struct(*KEYS[1:]), {"ignoreNullFields": "false"})
    return quads.select("graph_key", F.unhex(F.sha2(line.cast("binary"), 256)).alias("digest")).distinct().groupBy("graph_key").agg(_summed(F.hex("digest")).alias("h"))


def graph_diff(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(removed, added) as sets."""
    a, b = old.select(*KEYS), new.select(*KEYS)
    return a.subtract(b), b.subtract(a)


def graph_diff_by_hash(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(removed, added) as sets, in two levels: graphs are compared by their hashes first, and the quads of those that differ,
    or that one side lacks, alone are compared. For stores of which most graphs stay as they are; where the hashes were kept
    from an earlier comparison, give them as ``set_hashes`` of both sides costs one grouping each."""
    a, b = set_hashes(old).withColumnsRenamed({"graph_key": "a_key", "h": "a_h"}), set_hashes(new).withColumnsRenamed({"graph_key": "b_key", "h": "b_h"})
    changed = a.join(b, F.col("a_key") == F.col("b_key"), "full").where(~F.col("a_h").eqNullSafe(F.col("b_h"))).select(F.coalesce("a_key", "b_key").alias("changed"))
    only = lambda q: q.select(*KEYS).join(changed, F.col("graph_key") == F.col("changed"), "left_semi")
    return graph_diff(only(old), only(new))


def key_collisions(quads: DataFrame, record: str, classes: list[str]) -> DataFrame:
    """(node, n): nodes of classes of which every record has its own, that come from several records (column ``record``)."""
    own = quads.where((F.col("p") == "rdf:type") & F.col("o_value").isin(*classes))
    return own.groupBy(F.col("s").alias("node")).agg(F.count_distinct(record).alias("n")).where("n > 1")


def union_graphs(*graphs: DataFrame) -> DataFrame:
    out = graphs[0]
    for g in graphs[1:]:
        out = out.unionByName(g)
    return distinct_quads(out)


def pro_entail(quads: DataFrame) -> DataFrame:
    """hasParticipant o isFeatureOf -> hasParticipant, one step: the inferred quads alone."""
    part = quads.where("p = 'sulo:hasParticipant'").select("graph_key", "s", F.col("o_value").alias("role"))
    holder = quads.where("p = 'sulo:isFeatureOf'").select(F.col("graph_key").alias("g"), F.col("s").alias("r"), F.col("o_value").alias("holder"))
    found = part.join(holder, (F.col("graph_key") == F.col("g")) & (F.col("role") == F.col("r")))
    return found.select("graph_key", "s", F.lit("sulo:hasParticipant").alias("p"), F.lit("iri").alias("o_kind"), F.col("holder").alias("o_value"), F.lit(None).cast("string").alias("o_datatype")).distinct()


def participants(quads: DataFrame) -> DataFrame:
    """(process, role_type, person): who took part, in which role."""
    part = quads.where("p = 'sulo:hasParticipant'").select("graph_key", F.col("s").alias("process"), F.col("o_value").alias("role"))
    roles = quads.where("p in ('rdf:type', 'sulo:isFeatureOf')").groupBy(F.col("graph_key").alias("g"), F.col("s").alias("r")).agg(
        F.max(F.when((F.col("p") == "rdf:type") & (F.col("o_value") != "sulo:Role"), F.col("o_value"))).alias("role_type"), F.max(F.when(F.col("p") == "sulo:isFeatureOf", F.col("o_value"))).alias("person"))
    return part.join(roles, (F.col("graph_key") == F.col("g")) & (F.col("role") == F.col("r"))).select("process", "role_type", "person")


def invariants(quads: DataFrame, classes: list[str]) -> DataFrame:
    """Violations: forbidden predicates, and types that no map declares."""
    bad = F.when(F.col("p").isin(*FORBIDDEN), "forbidden-predicate").when((F.col("p") == "rdf:type") & ~F.col("o_value").isin(*classes), "undeclared-class")
    return quads.withColumn("violation", bad).where("violation is not null").select("graph_key", "s", "p", "o_value", "violation")


def exactly_one(quads: DataFrame, cls: str, predicate: str) -> DataFrame:
    """Nodes of a class with none or several values of a predicate: (graph_key, s, n)."""
    nodes = quads.where((F.col("p") == "rdf:type") & (F.col("o_value") == cls)).select("graph_key", "s").distinct()
    n = quads.where(F.col("p") == predicate).groupBy(F.col("graph_key").alias("g"), F.col("s").alias("r")).agg(F.count_distinct("o_kind", "o_value").alias("n"))
    return nodes.join(n, (F.col("graph_key") == F.col("g")) & (F.col("s") == F.col("r")), "left").select("graph_key", "s", F.coalesce("n", F.lit(0)).cast("long").alias("n")).where("n <> 1")


def orphans(quads: DataFrame, cls: str) -> DataFrame:
    """Nodes of a class that no quad of their graph points to."""
    nodes = quads.where((F.col("p") == "rdf:type") & (F.col("o_value") == cls)).select("graph_key", "s").distinct()
    used = quads.where("o_kind = 'iri' and p <> 'rdf:type'").select(F.col("graph_key").alias("g"), F.col("o_value").alias("o"))
    return nodes.join(used, (F.col("graph_key") == F.col("g")) & (F.col("s") == F.col("o")), "left_anti")


def cross_patient(quads: DataFrame, contexts: DataFrame) -> DataFrame:
    """Results whose quality belongs to another person than their source's subject (contexts: graph_key, person_iri)."""
    refers = quads.where("p = 'sulo:refersTo'").select("graph_key", "s", F.col("o_value").alias("quality"))
    holder = quads.where("p = 'sulo:isFeatureOf'").select(F.col("graph_key").alias("g"), F.col("s").alias("q"), F.col("o_value").alias("person"))
    c = contexts.select(F.col("graph_key").alias("cg"), "person_iri")
    found = refers.join(holder, (F.col("graph_key") == F.col("g")) & (F.col("quality") == F.col("q"))).join(c, F.col("graph_key") == F.col("cg"))
    return found.where("person <> person_iri").select("graph_key", "s", "person", "person_iri")


def erroneous(quads: DataFrame, contexts: DataFrame, status: str = "entered-in-error") -> DataFrame:
    """Clinical quads of sources in error (contexts: graph_key, status)."""
    bad = contexts.where(F.col("status") == status).select(F.col("graph_key").alias("g"))
    return quads.join(bad, F.col("graph_key") == F.col("g"), "left_semi")


def results(quads: DataFrame, cls: str) -> DataFrame:
    """(person, result, value, unit, time) of every result of a class, by four hops within its graph: one grouping by graph
    and subject, then one by graph, which is a single record's and so small, without any join."""
    hops = ("sulo:hasValue", "sulo:hasPart", "sulo:refersTo", "sulo:isFeatureOf", "sulo:atTime")
    named = {p: p.split(":")[1] for p in hops}
    mine = quads.where(F.col("p").isin(*hops) | ((F.col("p") == "rdf:type") & (F.col("o_value") == cls)))
    one = [F.max(F.when(F.col("p") == p, F.col("o_value"))).alias(n) for p, n in named.items()]
    # one exchange: rows of a graph are in one place before the first grouping already
    nodes = mine.repartition("graph_key").groupBy("graph_key", "s").agg(F.max(F.col("p") == "rdf:type").alias("is_result"), *one)
    whole = nodes.groupBy("graph_key").agg(F.map_from_entries(F.collect_list(F.struct("s", F.struct("is_result", *named.values())))).alias("n"))
    found = whole.select("n", F.explode("n").alias("result", "r")).where("r.is_result")
    at = lambda c: F.try_element_at("n", c)
    out = found.select(at(F.col("r.refersTo"))["isFeatureOf"].alias("person"), "result", F.col("r.hasValue").alias("value"), at(F.col("r.hasPart"))["hasValue"].alias("unit"), at(F.col("r.atTime"))["hasValue"].alias("time"))
    return out.where("person is not null and value is not null and unit is not null and time is not null")


def scoped_pairs(bound: DataFrame, array: str, kind: str, value: str, left: str, right: str) -> DataFrame:
    """``bound`` with the values of two kinds of components of the same record: left_value, right_value, and their counts.
    A kind that occurs several times gives no value but its count, so that none is chosen silently."""
    of = lambda k: F.filter(F.col(array), lambda c: c[kind] == k)
    one = lambda k: F.when(F.size(of(k)) == 1, F.get(of(k), F.lit(0))[value])
    return bound.withColumns({"left_value": one(left), "right_value": one(right), "left_n": F.coalesce(F.size(of(left)), F.lit(0)), "right_n": F.coalesce(F.size(of(right)), F.lit(0))})


def tuple_multiset(rows: DataFrame, *names: str) -> DataFrame:
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, with ``side``."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def trace(quads: DataFrame, runs: DataFrame) -> DataFrame:
    """Each quad with its binding or constant, source version, map hash and run (runs: graph_key, run_id, source_version,
    pair_hash)."""
    r = runs.select(F.col("graph_key").alias("rg"), "run_id", "source_version", "pair_hash")
    return quads.join(r, F.col("graph_key") == F.col("rg"), "left").drop("rg")


def inconsistencies(quads: DataFrame, disjoint: list[tuple[str, str]]) -> DataFrame:
    """Nodes typed with two classes that exclude each other. A few axioms as aggregates; no general reasoner."""
    types = quads.where("p = 'rdf:type'").groupBy("graph_key", "s").agg(F.collect_set("o_value").alias("types"))
    hit = F.array_compact(F.array(*[F.when(F.array_contains("types", a) & F.array_contains("types", b), F.lit(f"{a}|{b}")) for a, b in disjoint]))
    return types.withColumn("axiom", F.explode(hit)).select("graph_key", "s", "axiom")


#: Characters that an IRI may not hold, apart from control characters: all are percent-encoded on export, so that none is lost.
NOT_IN_IRIS = {" ": "%20", "<": "%3C", ">": "%3E", '"': "%22", "{": "%7B", "}": "%7D", "|": "%7C", "^": "%5E", "`": "%60", "\\": "%5C"}


def to_nquads(quads: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """One line per quad: value STRING, with prefixed names expanded. A graph key becomes an absolute IRI (urn:graph:...).
    A quad with a null term is an error, never a shorter line."""
    table = F.create_map(*[F.lit(x) for kv in prefixes.items() for x in kv])

    def iri(c: Column) -> Column:
        prefix = F.split_part(c, F.lit(":"), F.lit(1))
        name = F.element_at(table, prefix)
        out = F.when(name.isNotNull(), F.concat(name, F.substring(c, F.length(prefix) + 2, F.length(c)))).otherwise(c)
        safe = out
        for character, code in (NOT_IN_IRIS | {chr(i): f"%{i:02X}" for i in (*range(1, 32), 127)}).items():
            safe = F.replace(safe, F.lit(character), F.lit(code))
        return F.concat(F.lit("<"), F.when(F.rlike(out, F.lit(r'[\x00-\x20\x7F<>"{}|^`\\]')), safe).otherwise(out), F.lit(">"))

    value = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("o_value", r"\\", r"\\\\"), '"', r'\\"'), "\n", r"\\n"), "\r", r"\\r")
    literal = F.concat(F.lit('"'), value, F.lit('"'), F.when(F.coalesce(F.col("o_datatype"), F.lit("xsd:string")) == "xsd:string", "").otherwise(F.concat(F.lit("^^"), iri(F.col("o_datatype")))))
    graph = F.when(F.col("graph_key").startswith("graph:"), F.concat(F.lit("<urn:"), F.col("graph_key"), F.lit(">"))).otherwise(iri(F.col("graph_key")))
    terms = [iri(F.col("s")), iri(F.col("p")), F.when(F.col("o_kind") == "iri", iri(F.col("o_value"))).otherwise(literal), graph, F.lit(".")]
    line = F.concat(*[x for t in terms for x in (t, F.lit(" "))][:-1])
    return quads.select(F.coalesce(line, F.raise_error(F.lit("a quad has a null term")).cast("string")).alias("value"))
