"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text and weighed against its length.

Folding lower-cases, turns letters of other scripts that look like Latin ones, and digits and signs that stand for letters
inside a word, into those letters, and drops invisible characters. A text is then its words, each with a mark at both ends,
and entries of the lexicon are beginnings of words or, with the mark, whole words: an entry that has only one continuation
is left to that continuation. Their weights are the logarithms of how much likelier toxic texts have them. An exception is
a word, or a phrase of two words, that holds an entry and is not toxic itself; of entries and exceptions that overlap, the
first and then the longest counts. A logistic function of the weights' sum, its rate by length, the number of different
entries and the length gives the score.

Labels come only from rows whose crc32(doc_id) mod 5 is not 0, at most ``SAMPLE`` texts per class by the order of a hash of
the id (a bound, not a share of the input); the lexicon has at most ``MOST_ENTRIES`` entries. All are parameters.

Defined cases: null and empty texts have no words and a score like any other text without a match; texts may be of any
length and count whole; without labels of both classes all scores are 0.5; an id with several labels is toxic if one of
them says so; rows that repeat a document score alike; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

SAMPLE, MOST_ENTRIES = 4_000, 5_000
#: An entry is in so many toxic texts of the sample at least, and so much likelier there (a logarithm), and still
#: this much likelier after two standard errors are taken off.
LEAST_TEXTS, LEAST_WEIGHT, SURE_WEIGHT = 5, 1.5, 1.0
#: Letters of a beginning at least and at most.
SHORTEST, LONGEST = 4, 24
#: Letters and what they look like.
LOOK_LIKE = str.maketrans(
    "аеорсухіјѕһԁԛԝѵкмтвнοανιρτυκεıɑɡℓ",
    "aeopcyxijshdqwvkmtbhoaviptukeiagl",
) | {0xFF41 + i: chr(97 + i) for i in range(26)}
INVISIBLE = "­​‌‍⁠﻿"
DIGITS = str.maketrans("0134578@$!", "oieastbasi")

_odd = re.compile("[" + INVISIBLE + "".join(map(chr, LOOK_LIKE)) + "]").search
_table = LOOK_LIKE | dict.fromkeys(map(ord, INVISIBLE))
_inside = re.compile(r"(?<=[^\W\d_])[0134578@$!]+(?=[^\W\d_])").sub
_ahead = re.compile(r"(?<![^\W_])[0134578@$](?=[^\W\d_]{2})").sub
_words = re.compile(r"[^\W\d_]+").findall


def fold(text: str | None) -> list[str]:
    """The words of a text after folding."""
    text = (text or "").lower()
    if _odd(text):
        text = text.translate(_table)
    letters = lambda m: m[0].translate(DIGITS)
    return _words(_ahead(letters, _inside(letters, text)))


def marked(words: list[str]) -> str:
    return "".join(f"^{w}$" for w in words)


class Lexicon:
    """Entries with their weights and exceptions, in one automaton."""

    def __init__(self, entries: dict[str, float], exceptions: Iterable[str] = ()):
        self.automaton = ahocorasick.Automaton()
        for entry, weight in (entries | dict.fromkeys(exceptions, 0.0)).items():
            self.automaton.add_word(entry, (len(entry), weight))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, weight) of the entries in a marked text; exceptions take the place of what they overlap."""
        if self.empty:
            return
        found = sorted((end - size + 1, -end, weight) for end, (size, weight) in self.automaton.iter(text))
        last = -1
        for start, end, weight in found:
            if start > last:
                last = -end
                if weight:
                    yield start, last, weight

    def features(self, text: str | None) -> list[float]:
        words = fold(text)
        whole = marked(words)
        found = [(whole[start:end], w) for start, end, w in self.matches(whole)]
        total, n = sum(w for _, w in found), len(words)
        return [np.log1p(total), np.log1p(len(found)), np.log1p(len(set(found))), np.log1p(1000 * total / (n + 20)), np.log1p(n), float(bool(found))]


WIDTH = 6


def _beginnings(word: str) -> Iterator[str]:
    whole = f"^{word}$"
    return (whole[:n] for n in range(1 + SHORTEST, min(len(whole), 1 + LONGEST) + 1))


def _counted(found: Callable[[str | None], set[str]]):
    """(entry, toxic, clean): in how many texts of each class an entry is found, as far as a task has read."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = Counter(), Counter()
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                n[1 - toxic].update(found(text))
            keys = list(n[0] | n[1])
            yield pa.record_batch([pa.array(keys, pa.string()), *(pa.array([x[k] for k in keys], pa.int64()) for x in n)], names=["entry", "toxic", "clean"])

    return run


def _counts(sample: DataFrame, found) -> DataFrame:
    rows = sample.select("text", "toxic").mapInArrow(_counted(found), "entry string, toxic long, clean long")
    return rows.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _weight(toxic: float, clean: float, n: tuple[int, int]) -> float:
    return float(np.log((toxic + 0.5) / (n[1] + 1)) - np.log((clean + 0.5) / (n[0] + 1)))


def learn(sample: DataFrame, n: tuple[int, int], phrases: Iterable[str] = ()) -> Lexicon:
    """The lexicon of a sample (doc_id, text, toxic) with ``n`` clean and toxic texts. ``phrases`` are further exceptions."""
    likelier = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    rows = _counts(sample, lambda text: {b for w in set(fold(text)) for b in _beginnings(w)}).where((F.col("toxic") >= LEAST_TEXTS) & (likelier >= LEAST_WEIGHT) & (likelier - 2 * error >= SURE_WEIGHT))
    counts = {r.entry: (r.toxic, r.clean) for r in rows.collect()}  # bounded by the sample
    single = {e[:-1] for e, (toxic, _) in counts.items() if e[:-1] in counts and toxic >= 0.9 * counts[e[:-1]][0]}
    best = sorted(((_weight(*c, n), c[0], e) for e, c in counts.items() if e not in single), key=lambda x: (-x[1] * x[0], x[2]))[:MOST_ENTRIES]
    entries = {e: w for w, _, e in best}
    plain = Lexicon(entries)

    def around(text: str | None) -> set[str]:
        """The words that hold an entry, and the phrases of two words that they are in."""
        whole, found = marked(fold(text)), set()
        for start, end, _ in plain.matches(whole):
            stop = whole.find("$", end - 1) + 1
            before = whole.rfind("^", 0, start)
            after = whole.find("$", stop) + 1
            found.add(whole[start:stop])
            found.update(x for x in (whole[before:stop] if start else "", whole[start:after] if after else "") if x)
        return found

    near = _counts(sample, around).where(F.col("clean") >= 3).collect()  # bounded by the sample
    exceptions = {r.entry for r in near if _weight(r.toxic, r.clean, n) < LEAST_WEIGHT / 2}
    return Lexicon(entries, exceptions | {marked(fold(p)) for p in phrases if fold(p)})


def fit(x: np.ndarray, y: np.ndarray, proportion: float) -> np.ndarray:
    """Weights of the features and an offset by logistic loss; classes count by their share among all labels."""
    z = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y == 1, proportion / max(1, (y == 1).sum()), (1 - proportion) / max(1, (y == 0).sum()))
    w = np.zeros(WIDTH + 1)
    for _ in range(60):  # Newton's method; the ridge keeps it finite where the classes part
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (y - p)) - 1e-4 * w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-4 * np.eye(WIDTH + 1)
        step = np.linalg.solve(curve, gradient)
        w += step * min(1.0, 3 / (1e-9 + np.linalg.norm(step)))
    return w


def model(docs: DataFrame, labels: DataFrame, phrases: Iterable[str] = ()) -> tuple[Lexicon, np.ndarray]:
    usable = labels.where("crc32(cast(doc_id as string)) % 5 <> 0 and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return Lexicon({}), np.zeros(WIDTH + 1)
    chosen = [usable.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for k in (0, 1)]
    wanted = docs.sparkSession.createDataFrame([tuple(r) for c in chosen for r in c.collect()], "doc_id long, toxic int")
    # at most 2 * SAMPLE rows are sent; rows that repeat a document are one
    sample = materialize(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"]))
    have = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(have) < 2:
        return Lexicon({}), np.zeros(WIDTH + 1)
    lexicon = learn(sample, (have[0], have[1]), phrases)
    rows = sample.select("doc_id", "text", "toxic").mapInArrow(_featured(lexicon, lambda x: pa.array(list(x), pa.list_(pa.float64())), "toxic"), "doc_id long, value array<double>, toxic int").orderBy("doc_id").collect()
    x, y = np.array([r.value for r in rows]).reshape(-1, WIDTH), np.array([r.toxic for r in rows])
    return lexicon, fit(x, y, n[1] / (n[0] + n[1]))


def _featured(lexicon: Lexicon, of, *keep: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([lexicon.features(t) for t in batch["text"].to_pylist()]).reshape(-1, WIDTH)
            yield pa.record_batch([batch["doc_id"], of(x), *(batch[k] for k in keep)], names=["doc_id", "value", *keep])

    return run


def score(docs: DataFrame, labels: DataFrame, phrases: Iterable[str] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    lexicon, w = model(docs, labels, phrases)
    say = _featured(lexicon, lambda x: pa.array(1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(say, "doc_id long, value double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), F.col("value").alias("score"), (F.col("value") >= 0.5).cast("int").alias("predicted"))
