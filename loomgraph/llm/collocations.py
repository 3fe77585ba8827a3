"""Collocations by contiguous pattern growth: occurrence pointers are projected per frequent prefix and extended to the right.

The texts are read twice. The first pass counts words, and counts pairs of neighbouring words by hash in a table of fixed
size (``BUCKETS`` counters that stop at the least frequency): a phrase can only be frequent if all its pairs are, so a pair
whose bucket stays below is in none, nor is one of a word that is found less often. The second pass projects pointers: one for every occurrence of a pair that may be
frequent, with what stands to its right, at most two more words and only as long as the pairs may be frequent; pointers of
one slice that agree are one with a number. Sorted by range, the pointers of a prefix stand together in the order of their
extensions, so that a task grows its prefixes depth first, reading its pointers once and holding one open phrase per
length, whatever the size of a group. A prefix with more pointers than a task takes goes on in the next task: what is open
at the edges of a task is passed on below the least frequency too and summed. Buckets that collide cost pointers, never
counts.

Defined cases: a null text is empty; a null language is ``und``, together with rows that say so; empty texts give nothing;
rows that repeat a text or an id count each; a text may be of any length; an empty table gives no row; other columns, whatever
their names, play no part. Ties are broken as the ranking says, so that reruns agree.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Counters for hashed pairs of words: 64 MB in a task, 8 MB of bits in a broadcast, whatever the corpus. Rare pairs that share a
#: counter pass for frequent ones, the more the larger the corpus: 70 million of them to 16 million counters is too many.
BUCKETS = 1 << 26
#: The hash's bits beyond those that number a counter.
_REST = np.uint64(64 - BUCKETS.bit_length() + 1)
BLOCK = 1 << 16
#: Sums that are made of each block before the last one.
PARTS = 8
#: Bits for the frequent words, in a broadcast.
WORD_BITS = 1 << 24
#: Bytes of text that a task works on at once, at least one text.
SLICE = 8 << 20
#: Different words that a task holds before it passes their counts on.
MOST_WORDS = 800_000
LONGEST = 4

_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_MAP = bytes(10 if c in _BREAKS else 32 if c in b"\x20\x09" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_COUNTS = "lang string, word string, n long, block int, counters binary"
_POINTERS = "lang string, prefix string, third string, fourth string, n long"


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language at a time, as bytes, in slices of bounded size."""
    for batch in batches:
        held: dict[str, tuple[list[bytes], int]] = {}
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            own, size = held.get(key := lang.as_py(), ([], 0))
            own.append(data := text.as_buffer().to_pybytes())
            held[key] = own, (size := size + len(data))
            if size >= SLICE:
                yield key, held.pop(key)[0]
        for key, (own, _) in held.items():
            yield key, own


class _Words:
    """The words of a slice: ``ids`` in text order, the ``dictionary`` that they are of, and whether each one and the next
    stand in one piece (``joined``)."""

    def __init__(self, texts: list[bytes]):
        a = np.frombuffer(b"\n".join(texts).translate(_MAP), np.uint8)
        inside = (a != 32) & (a != 10)
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        found = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(a[inside]))]).dictionary_encode()
        self.ids, self.dictionary = found.indices.to_numpy(), found.dictionary
        piece = np.cumsum(a == 10, dtype=np.int32)[starts]
        self.joined = piece[1:] == piece[:-1]

    def pairs(self, lang: str) -> np.ndarray:
        """The bucket of each word and the next, whether joined or not."""
        if len(self.ids) < 2:
            return np.zeros(0, np.uint32)
        own = _hash(self.dictionary.to_numpy(zero_copy_only=False))[self.ids]
        with np.errstate(over="ignore"):
            two = (own[:-1] * _ODD + (own[1:] ^ _hash([lang]))) * np.uint64(0xD6E8FEB86659FD93)
        return (two >> _REST).astype(np.uint32)

    def among(self, lang: str, bits: np.ndarray) -> np.ndarray:
        """Whether each word of the dictionary may be one of those that ``frequent_words`` has marked."""
        return _marked(bits, _places(self.dictionary.to_numpy(zero_copy_only=False), [lang]))


def _hash(texts) -> np.ndarray:
    return pd.util.hash_array(np.asarray(texts, object), categorize=False)


def _places(words, langs) -> np.ndarray:
    """The bit of each word of a language, among WORD_BITS."""
    return (((_hash(words) ^ _hash(langs)) * _ODD) >> np.uint64(40)).astype(np.int64)


def _marked(bits: np.ndarray, at: np.ndarray, first: int = 0) -> np.ndarray:
    """Which bits are set; ``first`` is the place within a byte's bits, 0 for the lowest, of number 0."""
    return (bits[at >> 3] >> ((at & 7) ^ first).astype(np.uint8)) & 1 == 1


def _counting(least: int):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def say(lang: list, word: list, n: list, block: list, counters: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64()), pa.array(block, pa.int32()), pa.array(counters, pa.binary())], names=["lang", "word", "n", "block", "counters"])

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, own in words.items():
                yield say([lang] * len(own), list(own), list(own.values()), [None] * len(own), [None] * len(own))
            words.clear()

        words: dict[str, Counter] = defaultdict(Counter)
        table = np.zeros(BUCKETS, np.uint8)
        for lang, texts in _slices(batches):
            w = _Words(texts)
            n = np.bincount(w.ids, minlength=len(w.dictionary))
            words[lang][None] += len(w.ids)
            words[lang].update(dict(zip(w.dictionary.to_pylist(), n.tolist(), strict=True)))
            at, n = np.unique(w.pairs(lang)[w.joined], return_counts=True)
            table[at] = np.minimum(table[at] + np.minimum(n, least), least)
            if sum(map(len, words.values())) > MOST_WORDS:
                yield from flush()
        yield from flush()
        for i, part in enumerate(table.reshape(-1, BLOCK)):
            if part.any():
                yield say([None], [None], [None], [i], [_packed(part)])

    return count


def _packed(counters: np.ndarray) -> bytes:
    """A block of counters, most of them 0: the gaps between the others, low bytes and high bytes apart, and their values."""
    at = np.flatnonzero(counters)
    gaps = np.diff(at, prepend=0).astype("<u2")
    return zlib.compress(gaps.view(np.uint8).reshape(-1, 2).T.tobytes() + counters[at].tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    low, high, values = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(3, -1)
    out = np.zeros(BLOCK, np.uint8)
    out[np.cumsum(low.astype(np.int64) + (high.astype(np.int64) << 8))] = values
    return out


def _summing(least: int, last: bool):
    """Adds up the counters of blocks that come one after the other; they stop at the least frequency. The last sums are given as
    bits, of those that reach it."""

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((b, c.as_buffer()) for batch in batches for b, c in zip(batch["block"].to_pylist(), batch["counters"], strict=True))
        for block, own in groupby(rows, itemgetter(0)):
            total = np.zeros(BLOCK, np.uint8)
            for _, c in own:
                total = np.minimum(total + _unpacked(c), least).astype(np.uint8)
            out = zlib.compress(np.packbits(total >= least)) if last else _packed(total)
            yield pa.record_batch([pa.array([block], pa.int32()), pa.array([out], pa.binary())], names=["block", "counters"])

    return fold


def frequent_buckets(counts: DataFrame, least: int) -> bytes:
    """The buckets that reach the least frequency, as bits: summed in parts first, so that no task reads what all tasks of
    the corpus have counted; what reaches the driver has a fixed size."""
    blocks = counts.where("block is not null").select("block", "counters", F.pmod(F.xxhash64("counters"), F.lit(PARTS)).alias("part"))
    some = blocks.repartition("block", "part").sortWithinPartitions("block", "part").select("block", "counters").mapInArrow(_summing(least, False), "block int, counters binary")
    full = some.repartition("block").sortWithinPartitions("block").mapInArrow(_summing(least, True), "block int, counters binary")
    bits = np.zeros((BUCKETS // BLOCK, BLOCK // 8), np.uint8)
    for r in full.collect():  # at most BUCKETS / BLOCK rows
        bits[r.block] = np.frombuffer(zlib.decompress(r.counters), np.uint8)
    return bits.tobytes()


def frequent_words(words: DataFrame) -> bytes:
    """The (lang, word) of ``words`` as bits; what reaches the driver has a fixed size."""

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch([pa.array(_places(batch["word"].to_pylist(), batch["lang"].to_pylist()))], names=["place"])

    places = words.select("lang", "word").mapInArrow(mark, "place long")
    bits = np.zeros((WORD_BITS >> 15, 4096), np.uint8)
    for r in places.groupBy(F.shiftright("place", 15).alias("block")).agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(32_767))).alias("bits")).collect():
        bits[r.block] = np.frombuffer(r.bits, np.uint8)
    return bits.tobytes()


def _projecting(bits: bytes, known: bytes):
    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = np.frombuffer(bits, np.uint8)
        for lang, texts in _slices(batches):
            w = _Words(texts)
            frequent = w.among(lang, np.frombuffer(known, np.uint8))[w.ids]
            ok = _marked(may, w.pairs(lang), 7) & w.joined & frequent[:-1] & frequent[1:]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            ids, ok = np.append(w.ids.astype(np.int64), [-1] * 3), np.append(ok, [False] * 3)
            columns = [ids[at], ids[at + 1], np.where(ok[at + 1], ids[at + 2], -1), np.where(ok[at + 1] & ok[at + 2], ids[at + 3], -1)]
            code, size = columns[0], len(w.dictionary) + 1
            for c in columns[1:]:  # pointers that agree get one number
                code = pd.factorize(code * size + c + 1)[0].astype(np.int64)
            first = np.zeros(code.max() + 1, np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            words = [w.dictionary.take(pa.array(c[first], mask=c[first] < 0)).cast(pa.string()) for c in columns]
            prefix = pc.binary_join_element_wise(words[0], words[1], " ")
            yield pa.record_batch([pa.array([lang] * len(first), pa.string()), prefix, words[2], words[3], pa.array(np.bincount(code))], names=["lang", "prefix", "third", "fourth", "n"])

    return project


def _growing(least: int):
    """Phrases with their numbers, from sorted pointers."""

    def grow(rows: Iterable[tuple], depth: int, phrase: tuple) -> Iterator[tuple]:
        """Extends one prefix to the right, depth first; its own number comes after those of its extensions."""
        total = 0
        for word, own in groupby(rows, itemgetter(depth)):
            if word is None or depth == LONGEST:
                total += sum(r[-1] for r in own)
            else:
                total += yield from grow(own, depth + 1, (*phrase, word))
        if depth > 1:
            yield phrase, total
        return total

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row is its language, its prefix, its third and fourth word, and how many pointers it stands for
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out, edge, opened = [], {}, set()
        for phrase, n in grow(rows, 0, ()):
            key = len(phrase)
            if said := n >= least or key not in opened:  # the first of a length may have begun in the task before
                out.append((phrase, n))
            edge[key] = None if said else (phrase, n)  # and the last one may go on in the next
            opened.add(key)
            if len(out) >= 10_000:
                yield _phrases(out)
                out = []
        out += [x for x in edge.values() if x]
        yield _phrases(out)

    return run


def _phrases(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([p[0] for p, _ in rows], pa.string()), pa.array([" ".join(p[1:]) for p, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], names=["lang", "phrase", "f"])


def _joined(words: Column, first: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def frequencies(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of one to four words that are found ``least`` times or more, and (lang, n), the
    number of words of each language."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    full = min(least, 127)  # counters are bytes: two of them have to add up
    counts = materialize(texts.mapInArrow(_counting(full), _COUNTS), "zstd")
    sums = counts.where("block is null").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    words = materialize(sums.where(F.col("word").isNull() | (F.col("f") >= least)))
    single = words.where("word is not null")
    bits, known = frequent_buckets(counts, full), frequent_words(single)
    pointers = materialize(texts.mapInArrow(_projecting(bits, known), _POINTERS), "zstd")
    order = ("lang", "prefix", "third", "fourth")
    grown = pointers.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_growing(least), "lang string, phrase string, f long")
    phrases = grown.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return materialize(single.select("lang", F.col("word").alias("phrase"), "f").unionByName(phrases)), words.where("word is null").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, within: int = 80) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of two to four words found ``a`` times is scored by its weakest cut, twice ``a`` by the sum of its parts'
    numbers in millionths; one that stands inside a longer phrase with at least ``within`` percent of its number is left to
    that one. Products are decimals, so that nothing overflows."""
    freq, sizes = frequencies(docs, least)
    found = freq.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w")).withColumn("m", F.size("w")).where("m > 1")

    cuts = found.select("lang", "phrase", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined(F.col("w"), F.lit(1), F.col("k")).alias("first"), _joined(F.col("w"), F.col("k") + 1, F.col("m") - F.col("k")).alias("rest"))
    part = lambda name, f: freq.select(F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(f"{name}_phrase"), F.col("f").alias(f))
    cuts = cuts.join(part("first", "l"), (F.col("lang") == F.col("first_lang")) & (F.col("first") == F.col("first_phrase")))
    cuts = cuts.join(part("rest", "r"), (F.col("lang") == F.col("rest_lang")) & (F.col("rest") == F.col("rest_phrase")))
    score = F.expr("cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0)) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))

    longer = found.where("m > 2").select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(2), F.col("m") - 1)).alias("size"))
    longer = longer.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("size") + 1)).alias("at"))
    longer = longer.groupBy(F.col("lang").alias("in_lang"), _joined(F.col("w"), F.col("at"), F.col("size")).alias("inside")).agg(F.max("a").alias("most"))
    own = scored.join(longer, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inside")), "left")
    percent = lambda c, x: F.col(c).cast("decimal(19,0)") * F.lit(x)
    own = own.where(F.col("most").isNull() | (percent("most", 100) < percent("a", within)))
    own = own.select("lang", "phrase", "a", "c.l", "c.r", "c.score")

    # the best of every part first: what meets in one task is a few times ``top`` rows per language
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    parts = own.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    best = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    out = best.join(sizes.withColumnRenamed("lang", "n_lang"), F.col("lang") == F.col("n_lang"))
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS w FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
freq AS (SELECT lang, k AS m, w, array_to_string(w, ' ') AS phrase, count(*) AS f FROM grams GROUP BY lang, k, w),
size AS (SELECT lang, sum(f)::BIGINT AS n FROM freq WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, w, phrase, f AS a FROM freq WHERE m > 1 AND f >= 30),
parts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:m], ' ') AS y FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
cut AS (
  SELECT p.lang, p.phrase, a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * a // (l.f + r.f))::BIGINT AS score
  FROM parts p JOIN freq l ON l.lang = p.lang AND l.phrase = x JOIN freq r ON r.lang = p.lang AND r.phrase = y),
scored AS (SELECT lang, phrase, a, l, r, score FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
subs AS (SELECT lang, a, unnest(list_transform(range(1, m - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM (SELECT *, unnest(range(2, m)) AS k FROM cand)),
longer AS (SELECT lang, phrase, max(a) AS most FROM subs GROUP BY lang, phrase),
inside AS (SELECT s.lang, s.phrase FROM cand s JOIN longer b ON b.lang = s.lang AND b.phrase = s.phrase WHERE 100 * most >= 80 * s.a),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored s ANTI JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN size USING (lang) WHERE rank <= 2000
"""
