"""Language identification by Bayesian fusion of evidence.

The posterior of a language is the product of four terms: the likelihood of the text under a byte-trigram
model (tempered, as trigrams are not independent), that of the declared markup language and that of the address
suffix (both measured: how often pages that read like language l declare d), and the prior of the host. Priors
come from grouped sums of the posteriors by text alone: a host's are smoothed towards its domain's, those towards
the whole crawl's, each without the page itself. Sums are taken per host, domain, suffix and declaration over
all rows and joined back; they are partial sums before their shuffle, and the joined rows are narrow.

The trigram model is fitted on at most ``SAMPLE`` documents per language, by the order of a hash. Every language
that a document names is kept; the model has 4 * ``BUCKETS`` bytes for each, on the driver and each executor.

Defined cases: empty and null texts have a flat likelihood, so the other terms decide; a missing or malformed
declaration, address or host is a value of its own; ties go to the language first by name; repeated rows get
equal answers; without documents of a known language the answer is null; other columns are left out. A long text weighs
more than a line, as its likelihood has more factors; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .html_text import extract

SAMPLE, BUCKETS = 1_000, 1 << 15
TEMPER = 0.25  #: of the logarithm of the likelihood, whatever the length of the text
STRENGTH = 4.0  #: pages that the level above counts for
SENT = 8 << 20  #: bytes of sums, as their counted rows have them, up to which a table of them is broadcast


def _trigrams(text: str | None) -> np.ndarray:
    raw = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    return ((raw[:-2] * np.uint32(961) + raw[1:-1] * np.uint32(31) + raw[2:]) * np.uint32(2654435761) >> np.uint32(17)) if len(raw) > 2 else np.empty(0, np.uint32)


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages by name and, per trigram bucket and language, the logarithm of its probability."""
    known = docs.where("lang is not null and text is not null")
    bucket = F.shiftright(F.xxhash64("doc_id"), 52)  # in the order of the hash
    sizes = known.groupBy("lang", bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    below = F.sum("n").over(Window.partitionBy("lang").orderBy("b")) - F.col("n")
    last = sizes.withColumn("below", below).where(F.col("below") < SAMPLE).groupBy("lang").agg(F.max("b").alias("last"))
    last = {r.lang: r["last"] for r in last.collect()}  # one row per language
    langs = sorted(last)
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    first = docs.sparkSession.createDataFrame(list(last.items()), "w_lang string, last long")
    few = known.select("doc_id", "lang").join(F.broadcast(first), F.col("lang") == F.col("w_lang")).where(bucket <= F.col("last"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    wanted = few.select("doc_id", "lang", rank.alias("rank")).where(F.col("rank") <= SAMPLE).select(F.col("doc_id").alias("w_id"), F.col("lang").alias("w_lang")).distinct()
    wanted = materialize(wanted)  # at most SAMPLE rows per language
    texts = known.join(F.broadcast(wanted), (F.col("doc_id") == F.col("w_id")) & (F.col("lang") == F.col("w_lang"))).select("lang", "text")
    place = {name: i for i, name in enumerate(langs)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[name] = sums.get(name, 0) + np.bincount(_trigrams(text), minlength=BUCKETS)
        for name, sum_ in sums.items():
            at = np.flatnonzero(sum_)
            yield pa.RecordBatch.from_pydict({"l": pa.array(np.full(len(at), place[name]), pa.int32()), "g": pa.array(at, pa.int32()), "n": pa.array(sum_[at], pa.int64())})

    counts = np.full((BUCKETS, len(langs)), 0.5)
    found = texts.mapInArrow(count, "l int, g int, n long").groupBy("l", "g").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS per language
    counts[found["g"].to_numpy(), found["l"].to_numpy()] += found["n"].to_numpy()
    return langs, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def evidence(rows: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """``rows`` (keys, address, declared, host, content, is_html) with ``p``: the posteriors by text alone."""
    langs, table = model
    shared = rows.sparkSession.sparkContext.broadcast(table)
    keys = [c for c in rows.columns if c not in ("content", "is_html")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema.fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, html in zip(batch.column("content").to_pylist(), batch.column("is_html").to_pylist(), strict=True):
                grams = _trigrams(extract(text) if html else text)
                # by distinct trigrams, so that a very long text takes no more memory than its trigrams
                seen = np.bincount(grams, minlength=BUCKETS)
                at = np.flatnonzero(seen)
                total = TEMPER * (seen[at].astype(np.float64) @ shared.value[at].astype(np.float64)) if langs else np.zeros(0)
                p = np.exp(total - total.max()) if langs else total
                out.append((p / p.sum() if langs else p).tolist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), pa.array(out, pa.list_(pa.float64()))], names=[*keys, "p"])

    return rows.mapInArrow(run, schema + ", p array<double>")


def _sums(rows: DataFrame, by: str, n: int) -> DataFrame:
    """The summed posteriors of each value of ``by``: (by_key, by_sum, by_total)."""
    each = rows.groupBy(by).agg(*[F.sum(F.get("p", F.lit(i))).alias(f"s{i}") for i in range(n)])
    each = each.select(F.col(by).alias(f"{by}_key"), F.array(*[f"s{i}" for i in range(n)]).alias(f"{by}_sum"))
    return each.withColumn(f"{by}_total", F.aggregate(f"{by}_sum", F.lit(0.0), lambda a, x: a + x))


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], keys: list[str]) -> DataFrame:
    """``keys`` with lang, probability, text_lang, declared, suffix, host."""
    langs = model[0]
    n = len(langs)
    labels = ("declared", "suffix", "host")
    if not n:
        return rows.select(*keys, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"), F.lit(None).cast("string").alias("text_lang"), *labels)
    seen = materialize(evidence(rows, model))
    whole = seen.agg(*[F.coalesce(F.sum(F.get("p", F.lit(i))), F.lit(0.0)) for i in range(n)]).first()  # one number per language
    out = seen.withColumn("all_sum", F.array(*[F.lit(x) for x in whole])).withColumn("all_total", F.lit(float(sum(whole))))
    values = ("host", "domain", "declared", "suffix")
    for by in values:
        sums = materialize(_sums(seen, by, n))
        # declarations and suffixes are few, and hot keys among them need no exchange then; a table that isn't small is joined
        # by a shuffle, where Spark splits partitions that are skewed
        sums = F.broadcast(sums) if sums.count() * (n + 8) * 8 <= SENT else sums
        out = out.join(sums, F.col(by).eqNullSafe(F.col(f"{by}_key")), "left")
    one = lambda name, i: F.get(name, i)

    def log(p: Column, i: Column) -> Column:
        """Of one language by its place; a function of the place, so that the plan doesn't grow with the languages."""
        without = lambda name: F.greatest(F.lit(0.0), one(name, i) - p)
        whole_prior = (one("all_sum", i) + 1) / (F.col("all_total") + n)
        domain_prior = (without("domain_sum") + STRENGTH * whole_prior) / (F.greatest(F.lit(0.0), F.col("domain_total") - 1) + STRENGTH)
        host_prior = (without("host_sum") + STRENGTH * domain_prior) / (F.greatest(F.lit(0.0), F.col("host_total") - 1) + STRENGTH)
        out = F.log(host_prior) + F.log(F.greatest(p, F.lit(1e-300)))
        for by in ("declared", "suffix"):
            # P(value | language), without the page itself, smoothed towards P(value)
            share = F.col(f"{by}_total") / F.col("all_total")
            likely = (without(f"{by}_sum") + STRENGTH * share) / (without("all_sum") + STRENGTH)
            out = out + F.when(F.col(by).isNull(), F.lit(0.0)).otherwise(F.log(F.greatest(likely, F.lit(1e-300))))
        return out

    out = out.withColumn("logs", F.transform("p", log)).withColumn("best", F.array_position("logs", F.array_max("logs")).cast("int"))
    names = F.array(*[F.lit(x) for x in langs])
    norm = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("logs")))
    return out.select(*keys, F.get(names, F.col("best") - 1).alias("lang"), (1 / norm).alias("probability"), F.get(names, F.array_position("p", F.array_max("p")).cast("int") - 1).alias("text_lang"), *labels)


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


def page_rows(pages: DataFrame) -> DataFrame:
    host = host_of(F.col("url"))
    declared = F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1)), F.lit(""))
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), declared.alias("declared"),
        F.nullif(F.regexp_extract(host, r"\.([a-z]{2,})$", 1), F.lit("")).alias("suffix"), host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"), F.col("html").alias("content"), F.lit(True).alias("is_html"),
    )


def document_rows(docs: DataFrame) -> DataFrame:
    """Documents carry no markup and no address; their source is their host."""
    none = F.lit(None).cast("string")
    host = F.concat(F.lit("source:"), F.col("source"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), none.alias("declared"), none.alias("suffix"), host.alias("host"), F.lit("").alias("domain"), F.col("text").alias("content"), F.lit(False).alias("is_html"))
