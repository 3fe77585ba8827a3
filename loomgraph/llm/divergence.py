"""Divergence of the sources of a language, by inclusion and exclusion over the supports of their counts.

A source has a count for few of its language's terms; all others have the same price, that of a count of zero. The sum over
all terms for two sources is then made of three parts: a constant for the terms that neither has, taken for all terms; what
the terms of either source add, had the other one none of them, priced from the histogram of its counts and not from its terms;
and a correction for the terms that both have, from a join of postings. Nothing is ever made for a term that a source lacks.

Defined cases: a null text, language or source is ''; a text without terms still makes its group occur; rows that repeat a
document or an id count each; a language of one source has no pair, one without kept terms has pairs of value 0 and no term;
texts may be of any length; an empty table gives no row; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Bytes that may stand in a term; others part terms, and A-Z become a-z. Bytes of 128 and more belong to other letters.
_MAP = bytes(32 if c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 if c <= 0x5A else c for c in range(256))
#: Different terms of groups that a task holds before it passes their counts on.
MOST_TERMS = 500_000
SCALE = 1_000_000_000


def _counting(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of what a task has read so far; a row with a null term for each group."""

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), own in held.items():
            column = [pa.array([x] * len(own), pa.string()) for x in (lang, source)]
            yield pa.record_batch([*column, pa.array(own, pa.binary()).cast(pa.string()), *(pa.array([v[i] for v in own.values()], pa.int64()) for i in (0, 1))], names=["lang", "source", "term", "n", "docs"])
        held.clear()

    held: dict[tuple, dict] = {}
    size = 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"], strict=True):
            own = held.setdefault((lang, source), {None: [0, 0]})
            size -= len(own)
            for term, n in Counter(text.as_buffer().to_pybytes().translate(_MAP).split()).items():
                if cell := own.get(term):
                    cell[0] += n
                    cell[1] += 1
                else:
                    own[term] = [n, 1]
            size += len(own)
            if size > MOST_TERMS:
                yield from flush()
                size = 0
    yield from flush()


def _price(count: Column | str, total: str, terms: str) -> Column:
    """The probability of a count among ``total`` in ``terms`` terms, smoothed, in units of 1 / SCALE; exact for any count."""
    wide = lambda c: f"cast({c} as decimal(19, 0))"
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * ({wide(count)} + 2)) div ({wide(total)} + 2 * {wide(terms)})")


def _gap(p: str, q: str) -> Column:
    """The divergence of two prices. Prices are at most SCALE + 1, so that their squares are longs."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def divergence(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has every other source of the language with the sum over all
    kept terms, part ``term`` the ``top`` terms that the source has more of than its language."""
    none = F.lit("")
    texts = docs.select(*[F.coalesce(c, none).alias(c) for c in ("lang", "source", "text")])
    counted = texts.mapInArrow(_counting, "lang string, source string, term string, n long, docs long")
    rows = materialize(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    of_lang = rows.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    terms = of_lang.where(F.col("docs") >= least).select(F.col("lang").alias("t_lang"), F.col("term").alias("t_term"), "lang_n")
    kept = materialize(rows.where("term is not null").join(terms, (F.col("lang") == F.col("t_lang")) & (F.col("term") == F.col("t_term"))).select("lang", "source", "term", "n", "lang_n"))

    # sizes of groups and languages; a kept term of a language is counted once, by its first posting's share
    groups = rows.where("term is null").select("lang", "source")
    totals = kept.groupBy(F.col("lang").alias("g_lang"), F.col("source").alias("g_source")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("support"))
    langs = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy(F.col("lang").alias("v_lang")).agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("v"))
    g = groups.join(totals, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source")), "left").join(langs, F.col("lang") == F.col("v_lang"), "left")
    g = g.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "support", "lang_total", "v")])
    g = materialize(g.withColumn("zero", F.when(F.col("v") > 0, _price("0", "total", "v"))))

    named = lambda side: g.select(*[F.col(c).alias(f"{side}_{c}") for c in ("lang", "source", "zero", "v", "total")])
    own = kept.join(g.withColumnsRenamed({"lang": "g_lang", "source": "g_source"}), (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source")))
    own = own.select("lang", "source", "term", _price("n", "total", "v").alias("p"), _price("lang_n", "lang_total", "v").alias("q"), "zero")
    own = materialize(own)

    # the histogram of a group's prices is that of its counts
    histogram = own.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("k"))
    side = histogram.join(named("o"), (F.col("lang") == F.col("o_lang")) & (F.col("source") != F.col("o_source"))).join(g.select(F.col("lang").alias("s_lang"), F.col("source").alias("s_source"), F.col("zero").alias("s_zero")), (F.col("lang") == F.col("s_lang")) & (F.col("source") == F.col("s_source")))
    one_sided = side.groupBy("lang", "source", F.col("o_source").alias("item")).agg(F.sum(F.col("k") * (_gap("p", "o_zero") - _gap("s_zero", "o_zero"))).alias("value"))
    one_sided = one_sided.unionByName(one_sided.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))

    a, b = own.select("lang", "term", "source", "p", "zero"), own.select(*[F.col(c).alias(f"b_{c}") for c in ("lang", "term", "source", "p", "zero")])
    both = a.join(b, (F.col("lang") == F.col("b_lang")) & (F.col("term") == F.col("b_term")) & (F.col("source") < F.col("b_source")))
    fix = _gap("p", "b_p") - _gap("p", "b_zero") - _gap("zero", "b_p") + _gap("zero", "b_zero")
    overlap = both.groupBy("lang", "source", F.col("b_source").alias("item")).agg(F.sum(fix).alias("value"))
    overlap = overlap.unionByName(overlap.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))

    pairs = named("a").join(named("b"), (F.col("a_lang") == F.col("b_lang")) & (F.col("a_source") != F.col("b_source")))
    constant = pairs.select(F.col("a_lang").alias("lang"), F.col("a_source").alias("source"), F.col("b_source").alias("item"), F.coalesce(F.col("a_v") * _gap("a_zero", "b_zero"), F.lit(0).cast("long")).alias("value"))
    value = constant.unionByName(one_sided).unionByName(overlap).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))

    more = own.where("p > q").select("lang", "source", F.col("term").alias("item"), _gap("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    best = more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    out = value.withColumn("rank", F.row_number().over(order)).unionByName(best)
    return out.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
v AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
lv AS (SELECT lang, count(*) AS v, sum(lang_n)::BIGINT AS lang_total FROM v GROUP BY lang),
c AS (SELECT t.lang, source, t.term, count(*) AS n FROM t JOIN v ON v.lang = t.lang AND v.term = t.term GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gt AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::BIGINT AS total FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (
  SELECT gt.lang, gt.source, v.term, coalesce(c.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (total + 2 * lv.v))::BIGINT AS p, (1 + 1000000000::HUGEINT * (lang_n + 2) // (lang_total + 2 * lv.v))::BIGINT AS q
  FROM gt JOIN v ON v.lang = gt.lang JOIN lv ON lv.lang = gt.lang LEFT JOIN c ON c.lang = gt.lang AND c.source = gt.source AND c.term = v.term),
pair AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(s.value, 0)::BIGINT AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) s
  ON s.lang = x.lang AND s.source = x.source AND s.item = y.source),
term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT 'pair' AS part, * FROM pair UNION ALL SELECT 'term', * FROM term),
k AS (SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r)
SELECT * FROM k WHERE part = 'pair' OR rank <= 10
"""
