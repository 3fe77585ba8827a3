"""A quality classifier fitted as a Bradley-Terry model of preference pairs.

Features of a text are shares of kinds of words and characters, never its label, language, source or id.
Labels come only from rows whose crc32(doc_id) mod 3 is not 1, and all of these are used. Each text of quality 1
is paired with ``OPPONENTS`` of quality 0 at random places of its block; weights minimise the logistic loss of the
difference in features over the pairs. The threshold is a quantile of the scores: the one below which
lies the share of the labelled texts that is of quality 0; it
is shifted within the gap of the scores around it. ``score`` is the logistic function of the distance to
it, so 0.5 is the threshold.

Defined cases: null and empty texts have features 0 and a score like any other; without labels of both
classes all scores are 0.5; repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

OPPONENTS = 8
BLOCK, LEAST = 10_000, 50  #: rows of a block, and of a class in it at least
BINS = 4096  #: ranges of scores
STEPS, RIDGE = 60, 1e-3

_upper_words = re.compile(r"\b[^\W\d_a-zà-öø-ÿ]{2,}\b").findall
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def features(text: str | None) -> list[float]:
    """Shares in 0..1 (some by square root, to tell none from few) and logarithms of lengths."""
    text = text or ""
    words, raw = text.split(), text.encode("utf-8", "surrogatepass")
    n, size = max(1, len(words)), max(1, len(raw))
    lines = [x for x in text.split("\n") if x.strip()]
    counts = [raw.count(c) / size for c in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">", b"!", b"?", b".", b",", b"\n", b"@", b"/", b":", b";", b"{", b"=")]
    marks = (size - len(raw.translate(None, _SYMBOLS))) / size
    digits = (size - len(raw.translate(None, b"0123456789"))) / size
    upper = (size - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / size
    distinct = len(set(words)) / n
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, n - 1)
    return [
        *np.sqrt(counts).tolist(), np.sqrt(marks), np.sqrt(digits), np.sqrt(upper), distinct, pairs,
        len(_upper_words(text)) / n, len(set(lines)) / max(1, len(lines)), len(lines) / n,
        np.log1p(len(words)) / 10, min(1.0, size / n / 20), float(len(words) < 10), float(len(words) < 50),
        sum(heapq.nlargest(3, map(len, words))) / 3 / 50,
    ]


WIDTH = len(features("a"))


def fit(x: np.ndarray, y: np.ndarray, proportion: float) -> np.ndarray:
    """Weights of the standardised features and the threshold, as weights of the plain ones and an offset.
    ``proportion``: the share of quality 0 among all labels."""
    if not (y == 1).any() or not (y == 0).any():
        return np.zeros(WIDTH + 1)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = (x - mean) / scale
    good, bad = z[y == 1], z[y == 0]
    rng = np.random.default_rng(7)
    diff = good[np.repeat(np.arange(len(good)), OPPONENTS)] - bad[rng.integers(0, len(bad), len(good) * OPPONENTS)]
    w = np.zeros(WIDTH)
    for _ in range(STEPS):  # Newton's method; the ridge keeps it finite where the classes part
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        gradient = diff.T @ (1 - p) / len(diff) - RIDGE * w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + (RIDGE + 1e-6) * np.eye(WIDTH)
        step = np.linalg.solve(curve, gradient)
        w += step * min(1.0, 3 / (1e-9 + np.linalg.norm(step)))
    s = z @ w
    weight = np.where(y == 1, (1 - proportion) / (y == 1).sum(), proportion / (y == 0).sum())
    order = np.argsort(s, kind="stable")
    below = np.cumsum(weight[order])
    ranked, errors = s[order], np.cumsum(np.where(y[order] == 1, weight[order], -weight[order]))
    at = int(np.searchsorted(below, proportion))
    near = np.flatnonzero(np.abs(below - proportion) <= max(0.25 * proportion, 2 / len(s)))  # quantiles close to that share
    near = near if len(near) else np.array([min(at, len(s) - 1)])
    at = int(near[np.argmin(errors[near])])
    threshold = (ranked[at] + ranked[min(at + 1, len(s) - 1)]) / 2
    return np.concatenate([w / scale, [-(mean / scale) @ w - threshold]])


def _sum_blocks(blocks: DataFrame, of) -> np.ndarray:
    """The sum of ``of(good, bad, block)``, arrays of one length, over all blocks; one row from each task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.to_pylist():
                got = of(*(np.frombuffer(row[k]).reshape(-1, WIDTH) for k in ("good", "bad")), row["block"])
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    return np.sum([np.frombuffer(r.total) for r in blocks.mapInArrow(run, "total binary").collect()], axis=0)


def _blocks(rows: DataFrame, n: dict[int, int]) -> DataFrame:
    """All training rows (doc_id, value, quality) in blocks by a hash of the id: block, good and bad, their features as bytes.
    Where a class is so rare that blocks would lack it, its rows are in several blocks, all equally often."""
    count = -(-sum(n.values()) // BLOCK)
    copies = {q: min(count, -(-LEAST * count // n[q])) for q in n}
    times = F.when(F.col("quality") == 1, copies[1]).otherwise(copies[0])
    dealt = rows.withColumn("k", F.explode(F.sequence(F.lit(0), times - 1))).withColumn("block", F.pmod(F.xxhash64("doc_id") + F.col("k"), F.lit(count)))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        x, y = np.array(table["value"].to_pylist()).reshape(-1, WIDTH), np.array(table["quality"])
        return pa.table({"block": table["block"][:1], "good": pa.array([x[y == 1].tobytes()], pa.binary()), "bad": pa.array([x[y == 0].tobytes()], pa.binary())})

    return materialize(dealt.select("block", "doc_id", "value", "quality").groupBy("block").applyInArrow(pack, "block long, good binary, bad binary"))


def fit_all(rows: DataFrame) -> np.ndarray:
    """As ``fit``, from all of ``rows`` (doc_id, value, quality) and in their tasks: each Newton step is a sum over blocks, within
    which texts are paired, and the threshold is found among the scores of all. The driver has sums alone."""
    n = {r.quality: r.n for r in rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return np.zeros(WIDTH + 1)
    blocks, total = _blocks(rows, n), sum(n.values())
    both = lambda g, b: np.concatenate([g, b])
    first = _sum_blocks(blocks, lambda g, b, _: np.append(both(g, b).sum(axis=0), len(g) + len(b)))
    mean = first[:-1] / first[-1]
    scale = np.sqrt(_sum_blocks(blocks, lambda g, b, _: ((both(g, b) - mean) ** 2).sum(axis=0)) / first[-1]) + 1e-9
    w = np.zeros(WIDTH)
    for _ in range(STEPS):

        def sums(g: np.ndarray, b: np.ndarray, block: int, w: np.ndarray = w) -> np.ndarray:
            if not len(g) or not len(b):
                return np.zeros(WIDTH + WIDTH**2 + 1)
            at = np.random.default_rng(7 + block).integers(0, len(b), len(g) * OPPONENTS)
            diff = ((g - mean) / scale)[np.repeat(np.arange(len(g)), OPPONENTS)] - ((b - mean) / scale)[at]
            p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
            return np.concatenate([diff.T @ (1 - p), ((diff * (p * (1 - p))[:, None]).T @ diff).ravel(), [len(diff)]])

        got = _sum_blocks(blocks, sums)
        gradient = got[:WIDTH] / got[-1] - RIDGE * w
        step = np.linalg.solve(got[WIDTH:-1].reshape(WIDTH, WIDTH) / got[-1] + (RIDGE + 1e-6) * np.eye(WIDTH), gradient)
        w = w + step * min(1.0, 3 / (1e-9 + np.linalg.norm(step)))
        if np.linalg.norm(step) < 1e-8:
            break
    plain = w / scale
    offset = -(mean / scale) @ w

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(0).to_pylist()).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([pa.array(x @ plain + offset), batch.column(1)], names=["s", "quality"])

    scores = rows.select("value", "quality").mapInArrow(scored, "s double, quality int").groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("quality") == 1, 1).otherwise(-1)).alias("e"))
    scores = materialize(scores)
    spread = scores.agg(F.avg("s").alias("m"), F.coalesce(F.stddev_pop("s"), F.lit(0.0)).alias("d")).first()
    binned = scores.withColumn("bin", F.floor(BINS / (1 + F.exp((spread.m - F.col("s")) / (spread.d + 1e-9)))))
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # one row per bin
    bins = binned.groupBy("bin").agg(F.sum("n").alias("bn"), F.sum("e").alias("be")).select("bin", F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("be").over(before), F.lit(0)).alias("e0"))
    upto = Window.partitionBy("bin").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    ranked = binned.join(F.broadcast(bins), "bin").select("s", (F.col("n0") + F.sum("n").over(upto)).alias("below"), (F.col("e0") + F.sum("e").over(upto)).alias("errors"))
    off = F.abs(F.col("below") - n[0])
    near = off <= max(0.25 * n[0], 2)
    at = ranked.agg(F.min_by("s", F.struct(F.when(near, 0).otherwise(1), F.when(near, F.col("errors")).otherwise(off), "s"))).first()[0]
    above = scores.where(F.col("s") > at).agg(F.min("s")).first()[0]
    return np.append(plain, offset - (at if above is None else (at + above) / 2))


def _featured(of):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in batch.column(1).to_pylist()]).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([batch.column(0), of(x)], names=["doc_id", "value"])

    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted. Features are computed once, for the fit and the scores."""
    every = materialize(docs.select("doc_id", "text").mapInArrow(_featured(lambda x: pa.array(list(x), pa.list_(pa.float64()))), "doc_id long, value array<double>"))
    usable = labels.where("crc32(cast(doc_id as string)) % 3 <> 1 and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    w = fit_all(materialize(every.join(usable, "doc_id").groupBy("doc_id").agg(F.min("value").alias("value"), F.max("quality").alias("quality"))))

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist()).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))))], names=["doc_id", "value"])

    rows = every.mapInArrow(of, "doc_id long, value double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), F.col("value").alias("score"), (F.col("value") >= 0.5).cast("int").alias("predicted"))
