"""Entailment to a fixpoint: chain and inverse axioms over facts, each round joining only what the round before has found."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import shuffles_dropped, stored

#: Facts that point to one thing; with more, they are joined apart. A side of a join with no more facts goes to the other one.
HUB = 20_000


def closure(facts: DataFrame, axioms: DataFrame, within: tuple[str, ...] = (), folder: str | None = None) -> DataFrame:
    """The facts (``within``, s, p, o) that follow from ``facts`` by ``axioms`` and aren't among them.

    ``axioms`` has kind, a, b and c: ``chain`` (x a y and y b z say x c z) and ``inverse`` (x a y says y b x, and back). Facts
    chain if they agree in the columns of ``within``, such as their graph. Rounds are semi-naive: a chain needs a fact of the
    last round on one side at least, so that a chain of n links takes about log2(n) rounds, each of which is written, and whose
    shuffles are dropped then. Facts whose predicate no axiom has are left out from the start; repeated and circular facts and
    axioms change nothing. A round joins the facts of those predicates alone that an axiom joins to what is new, and of those only
    things that lie in the range of the other side's. The driver learns the axioms, which are as few as the ontology's
    predicates, and the number and range of the facts of each."""
    spark, keys = facts.sparkSession, [*within, "s", "p", "o"]
    rows = axioms.where("kind in ('chain', 'inverse') and a is not null and b is not null").select("kind", "a", "b", "c").distinct().collect()
    chains = sorted({(r.a, r.b, r.c) for r in rows if r.kind == "chain" and r.c is not None})
    turns = sorted({x for r in rows if r.kind == "inverse" for x in ((r.a, r.b), (r.b, r.a))})

    def of(parts: list[tuple[DataFrame, dict]], predicates: set[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, [df.where(F.col("p").isin(*predicates)) for df, kinds in parts if predicates & kinds.keys()])

    def chained(left: list[tuple[DataFrame, dict]], right: list[tuple[DataFrame, dict]]) -> list[tuple[DataFrame, set[str]]]:
        firsts, r = _merged(left), _merged(right)
        rules = [(*x, *r[x[1]][1:]) for x in chains if x[0] in firsts and x[1] in r]
        if not rules:
            return []
        table = F.broadcast(spark.createDataFrame(rules, "first string, second string, says string, least string, most string"))
        begun = of(left, {x[0] for x in rules}).join(table, (F.col("p") == F.col("first")) & F.col("o").between(F.col("least"), F.col("most"))).select(*within, "s", "o", "second", "says")
        seen = begun.groupBy("second", "says").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("least"), F.max("o").alias("most")).collect()
        seconds = {x.second for x in seen}
        few = {x for x in seconds if r[x][0] * len(seconds) <= HUB}
        return [(met(begun, right, own, sum(r[x][0] for x in {x.second for x in own})), {x.says for x in own}) for own in ([x for x in seen if x.second in few], [x for x in seen if x.second not in few]) if own]

    def met(begun: DataFrame, right: list[tuple[DataFrame, dict]], seen: list, n_ends: int) -> DataFrame:
        n_begun, seconds = sum(x.n for x in seen), {x.second for x in seen}
        spans = [(a, min(x.least for x in seen if x.second == a), max(x.most for x in seen if x.second == a)) for a in sorted(seconds)]
        table = F.broadcast(spark.createDataFrame(spans, "span string, least string, most string"))
        begun = begun.where(F.col("second").isin(*seconds))
        ends = of(right, seconds).join(table, (F.col("p") == F.col("span")) & F.col("s").between(F.col("least"), F.col("most"))).select(*[F.col(c).alias(f"r_{c}") for c in keys])
        same = reduce(lambda x, y: x & y, [F.col("o") == F.col("r_s"), F.col("second") == F.col("r_p"), *[F.col(c) == F.col(f"r_{c}") for c in within]])
        if n_ends <= HUB:
            out = begun.join(F.broadcast(ends), same)
        elif n_begun <= HUB:
            out = ends.join(F.broadcast(begun), same)
        else:
            # things that very many facts point to are few: their ends go to the facts, which one task would have to sort otherwise.
            # They are found by the numbers of facts in shares of the things, as these are shorter than the things
            shares = 4 * n_begun // max(HUB, 1) + 1
            share = lambda a, s, p: F.pmod(F.xxhash64(*[f"{a}{c}" for c in within], s, p), F.lit(shares)).cast("int")
            begun, ends = begun.withColumn("share", share("", "o", "second")), ends.withColumn("r_share", share("r_", "r_s", "r_p"))
            hubs = begun.groupBy("share").count().where(F.col("count") > HUB).select(F.col("share").alias("hub"))
            apart = lambda df, c, how: df.join(F.broadcast(hubs), F.col(c) == F.col("hub"), how)
            out = apart(begun, "share", "left_anti").join(ends, same)
            out = out.unionByName(apart(begun, "share", "left_semi").join(apart(ends, "r_share", "left_semi"), same))
        return out.select(*within, "s", F.col("says").alias("p"), F.col("r_o").alias("o"))

    def turned(part: tuple[DataFrame, dict]) -> list[tuple[DataFrame, set[str]]]:
        own = [x for x in turns if x[0] in part[1]]
        if not own:
            return []
        table = F.broadcast(spark.createDataFrame(own, "one string, other string"))
        return [(of([part], {x[0] for x in own}).join(table, F.col("p") == F.col("one")).select(*within, F.col("o").alias("s"), F.col("other").alias("p"), F.col("s").alias("o")), {x[1] for x in own})]

    def written(df: DataFrame) -> tuple[DataFrame, dict]:
        df = stored(df, folder)
        return df, _kinds(df)

    own = {x for rule in [*chains, *turns] for x in rule}
    with shuffles_dropped(spark):
        # facts are dealt out before the different ones are found, so that no task of a join or scan holds all that it makes
        known = [written(facts.select(*keys).dropna().where(F.col("p").isin(*own)).repartition(*keys).distinct())]
        while new := [*turned(known[-1]), *chained(known[-1:], known), *(chained(known[:-1], known[-1:]) if len(known) > 1 else [])]:
            says = {p for _, said in new for p in said}
            found = reduce(DataFrame.unionByName, [df for df, _ in new]).repartition(*keys).distinct()
            if says & _merged(known).keys():
                found = found.join(of(known, says), keys, "left_anti")
            known.append(written(found))
            if not known[-1][1]:
                break
    return reduce(DataFrame.unionByName, [df for df, _ in known[1:]], known[0][0].limit(0))


def _kinds(rows: DataFrame) -> dict[str, tuple]:
    """For each predicate the number of its facts, and the least and the greatest thing that they start from."""
    return {r.p: (r.n, r.least, r.most) for r in rows.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("least"), F.max("s").alias("most")).collect()}


def _merged(parts: list[tuple[DataFrame, dict]]) -> dict[str, tuple]:
    out: dict[str, tuple] = {}
    for p, (n, least, most) in (x for _, kinds in parts for x in kinds.items()):
        old = out.get(p, (0, least, most))
        out[p] = (old[0] + n, min(old[1], least), max(old[2], most))
    return out
