"""Quality rules with risk-controlled thresholds, with DataFrame functions only.

Four ratios are measured on every text (symbols, repeated lines, words in repeated three-word windows,
mean word length). A rule rejects a text whose ratio exceeds a cutoff. Its cutoff is chosen separately
in each stratum (language) from a fixed grid, on the labelled texts of quality 1 that pass the base
rules: from the most lenient to the strictest, a cutoff stands while the exact binomial test rejects
"more than ``risk`` / rules of such texts would be rejected". Going on only while every test passes
needs no correction within a grid; over rules and strata the level is divided (Bonferroni), so with
probability 1 - ``level`` no stratum loses more than ``risk`` of its good texts. Where there are too few
labels to certify any cutoff, the rule is off in that stratum.

Defined cases: a null text has no words and fails the base rules; a null language is a stratum of its
own; without labels nothing but the base rules rejects; label rows repeated for one document count once
with their largest quality; repeated documents count each; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, let, materialize, words

RISK, LEVEL = 0.02, 0.05
#: Cutoffs in thousandths, lenient to strict; of mean word length in thousandths of a character.
GRIDS = {
    "symbols": (500, 400, 300, 250, 200, 150, 100, 80, 60, 40, 30, 20),
    "dup_lines": (900, 800, 700, 600, 500, 400, 300, 250, 200, 150, 100),
    "repeats": (480, 450, 400, 350, 300, 250, 200, 150, 100, 80),
    "length": (20000, 16000, 14000, 12000, 11000, 10000, 9000, 8500, 8000),
}
MEASURES = "n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words"


def _repeated(w: Column) -> Column:
    """Words in three-word windows that occur more than once, by 64-bit hashes of the windows: hashes and places are
    sorted once, equal neighbours are marked, and the words that their sorted places cover are counted, so that a text
    of n words takes n log n steps whatever it repeats."""

    def count(places: Column) -> Column:
        # a place covers three words, less those that the next one covers too; least() passes over the null after the last
        return F.aggregate(F.transform(places, lambda x, j: F.least(F.lit(3), F.get(places, j + 1) - x)), F.lit(0), lambda a, x: a + x)

    def of(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = lambda s: F.filter(s, lambda e, j: (e["h"] == F.get(s, j - 1)["h"]) | (e["h"] == F.get(s, j + 1)["h"]))
        places = F.sort_array(F.transform(let(pairs, again), lambda e: e["i"]))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(places, count))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(windows, of))


def measures(text: Column) -> Column:
    """The counts of a text as one struct of longs."""
    text = F.coalesce(text, F.lit(""))
    of_words = let(words(text), lambda w: F.struct(F.size(w).alias("n"), F.char_length(F.array_join(w, "")).alias("chars"), _repeated(w).alias("repeats")))
    of_lines = let(F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))), lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    symbols = F.regexp_count(text, F.lit(r"[#*$%&|<>]"))
    return let(of_words, lambda w: let(of_lines, lambda x: F.struct(*[
        v.cast("long").alias(k)
        for k, v in {"n_words": w["n"], "word_chars": w["chars"], "n_symbols": symbols, "n_lines": x["n"], "n_dup_lines": x["dup"], "n_repeat_words": w["repeats"]}.items()
    ])))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def exceeds(rule: str, cutoff: Column, m=F.col) -> Column:
    a, b = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"), "length": ("word_chars", "n_words")}[rule]
    return 1000 * m(a) > cutoff * m(b)


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, shifted by 8 so that small n are exact to 1e-11."""
    x = n + 9
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))) + 1 / (1260 * F.pow(x, F.lit(5)))
    shift = F.log(n + 1)
    for i in range(2, 9):
        shift = shift + F.log(n + i)
    return series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n) for k <= n p: the largest term times a falling series, which 40 standard deviations of
    the binomial and 1,000 terms exhaust to double precision for any n."""
    k, n = k.cast("double"), n.cast("double")
    largest = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p))
    step = lambda acc, i: F.struct((acc["t"] * (k - i + 1) / (n - k + i) * ((1 - p) / p)).alias("t"), (acc["s"] + acc["t"]).alias("s"))
    terms = F.sequence(F.lit(1), F.least(k + 1, 40 * F.sqrt(n * p * (1 - p)) + 1_000).cast("int"))
    return largest * F.aggregate(terms, F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")), step, lambda acc: acc["s"])


def certify(measured: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """One row: ``cutoffs``, a map from stratum to the certified cutoff of each rule (null: off).

    ``measured`` has doc_id, stratum and the measures. Counting is by partial sums per stratum; the
    labels are joined on doc_id in full.
    """
    good = labels.groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1").select("doc_id")
    held = measured.join(good, "doc_id").where(~base_failed())
    tests = [(rule, c) for rule, grid in GRIDS.items() for c in grid]
    sums = [F.sum(exceeds(rule, F.lit(c)).cast("long")).alias(f"{rule}_{c}") for rule, c in tests]
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *sums)
    counts = counts.withColumn("alpha", F.lit(level) / (len(GRIDS) * F.count(F.lit(1)).over(Window.partitionBy())))
    each = counts.select("stratum", "n", "alpha", F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"{rule}_{c}").alias("k")) for rule, c in tests])).alias("t")).select("stratum", "n", "alpha", "t.*")
    limit = risk / len(GRIDS)
    # lenient to strict, the number of rejected only grows, so those that pass come first
    passing = each.where((F.col("k") <= limit * F.col("n")) & (binomial_tail(F.col("k"), F.col("n"), limit) <= F.col("alpha")))
    return passing.groupBy("stratum").agg(F.struct(*[F.min(F.when(F.col("rule") == rule, F.col("cutoff"))).cast("long").alias(rule) for rule in GRIDS]).alias("cutoff"))


def verdict(cutoff: str, m=F.col) -> Column:
    """True unless a rule that has a cutoff is exceeded."""
    ok = F.lit(True)
    for rule in GRIDS:
        ok = ok & ~F.coalesce(exceeds(rule, F.col(f"{cutoff}.{rule}"), m), F.lit(False))
    return ok


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """Per row of ``docs``: doc_id, the measures, base_failed, kept."""
    measured = materialize(docs.select("doc_id", F.col(f"`{stratum}`").alias("stratum"), measures(F.col("text")).alias("m")).select("doc_id", "stratum", "m.*"))
    cut = materialize(certify(measured, labels, risk, level)).withColumnRenamed("stratum", "cut_stratum")
    out = measured.join(cut, F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left").withColumn("base_failed", base_failed())
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & verdict("cutoff")).alias("kept"), "n_lines")


def keep(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass. The texts are measured once and written with their measures, so
    that only the small table of cutoffs is joined to them."""
    m, s, c = fresh(docs, "rule_measures", "cut_stratum", "cutoff")
    measured = materialize(docs.withColumn(m, measures(F.col("text"))))
    narrow = measured.select("doc_id", F.col(f"`{stratum}`").alias("stratum"), f"{m}.*")
    cut = materialize(certify(narrow, labels)).withColumnsRenamed({"stratum": s, "cutoff": c})
    of = lambda name: F.col(f"{m}.{name}")
    failed = (of("n_words") < 50) | (100 * of("n_repeat_words") > 50 * of("n_words"))
    return measured.join(cut, F.col(f"`{stratum}`").eqNullSafe(F.col(s)), "left").where(~failed & verdict(c, of)).select(*[F.col(f"`{x}`") for x in docs.columns])


def sql(risk: float = RISK, level: float = LEVEL) -> str:
    """``judge`` over the tables documents and labels, in DuckDB's SQL."""
    sides = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"), "length": ("word_chars", "n_words")}
    tests = ", ".join(f"{{'rule': '{rule}', 'cutoff': {c}, 'k': count(*) FILTER (1000 * {sides[rule][0]} > {c} * {sides[rule][1]})}}" for rule, grid in GRIDS.items() for c in grid)
    limit = risk / len(GRIDS)
    tail = f"exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({limit!r}) + (n - i) * ln(1 - {limit!r}))"
    best = ", ".join(f"min(cutoff) FILTER (rule = '{rule}') AS cut_{rule}" for rule in GRIDS)
    bad = " OR ".join(f"coalesce(1000 * {a} > cut_{rule} * {b}, false)" for rule, (a, b) in sides.items())
    return rf"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
g AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: {{'p': i, 'g': concat(w[i], ' ', w[i + 1], ' ', w[i + 2])}})) AS x FROM w),
d AS (
  SELECT doc_id, x.p AS p, count(*) OVER (PARTITION BY doc_id, x.g) AS n FROM g),
r AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM d WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT l.doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM l LEFT JOIN r ON l.doc_id = r.doc_id),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m),
k AS (
  SELECT lang, count(*) AS n, [{tests}] AS tests FROM b
  WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1) GROUP BY lang),
e AS (
  SELECT lang, n, alpha, t.rule AS rule, t.cutoff AS cutoff, t.k AS k
  FROM (SELECT lang, n, {level!r} / ({len(GRIDS)} * count(*) OVER ()) AS alpha, unnest(tests) AS t FROM k)),
i AS (
  SELECT lang, alpha, rule, cutoff, sum({tail}) AS tail
  FROM (SELECT *, unnest(range(0, k + 1)) AS i FROM e WHERE k <= {limit!r} * n) GROUP BY ALL),
c AS (SELECT lang AS cut_lang, {best} FROM i WHERE tail <= alpha GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND NOT ({bad})) AS kept, n_lines
FROM b LEFT JOIN c ON lang IS NOT DISTINCT FROM cut_lang
"""


SQL = sql()
