"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

A first job counts the words of all texts and takes the most frequent ones (``lexicon_size``, a
parameter). They are merged once and compiled into a minimal acyclic automaton: words with a common
ending share states, each edge holds how many words come before it, and so the walk along a word gives
its number, under which its ids lie. The automaton is a few hundred kilobytes of flat arrays; each Python
worker maps it into memory from an unlinked file. Any other word is merged exactly by rank, so the size
of the lexicon changes the time taken and nothing else.

A worker takes texts by the megabyte: their words not met before are sorted by length into matrices of bytes,
which walk the automaton together, a column at a time, and those that it lacks are merged together, a merge of
each row at a time. What is kept of words met before is bounded in bytes.

Results equal those of the ``tokenizers`` library for the same vocabulary file, except where the Unicode tables of this Python
(15.1) and of the library differ: 1,526 characters below U+20000 that are unassigned here (as U+088F, U+1C89, U+A7CB) may part
words elsewhere, and marks that only one side knows may be ordered otherwise by NFC (U+089F before U+0596). Defined cases: a null
text is encoded as the empty one (no ids, empty text back); strings of special tokens inside a text
become the special ids; other columns, repeated rows and empty tables are passed through.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import mmap
import re
import struct
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, small_batches

LEXICON_SIZE = 32_768
#: Distinct pieces, and characters of texts, that a counting task gathers before it counts their words.
HELD, HELD_CHARS = 150_000, 32 << 20
#: Characters of texts that are encoded together, pieces of one long text, and bytes of what is kept of pieces.
CHUNK, SLICE, KEPT = 1 << 20, 150_000, 32 << 20
#: Bytes from which a word is merged with a heap; and marks of no merge and of a part merged away.
LONG, NEVER, GONE = 64, 1 << 30, -1


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """The parts of a tokenizer file that encoding needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: The rank of a pair of ids, and by rank the id of what it becomes.
        self.ranks = {(self.ids[a], self.ids[b]): i for i, (a, b) in enumerate(merges)}
        self.made = [self.ids[a + b] for a, b in merges]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(pattern).findall
        self.find_lines = regex.compile(pattern + "|\\n").findall  # no word holds white space
        self.split_special = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split
        #: The ids of a byte within a word and at its end.
        self.letter = [self.ids[c] for c in byte_letters()]
        self.last = [self.ids[c + end] for c in byte_letters()]
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        # the same as arrays: the ranks of pairs by a * width + b, and those of two bytes, the second of them plain or last
        self.width = max(self.tokens) + 1
        pairs = sorted((a * self.width + b, r) for (a, b), r in self.ranks.items())
        self.pair_keys, self.pair_ranks = (np.array(x, t) for x, t in zip(zip(*pairs, strict=True), (np.int64, np.int32), strict=True))
        self.letters, self.lasts, self.made_ids = (np.array(x, np.int32) for x in (self.letter, self.last, self.made))
        second = np.concatenate([self.letters, self.lasts])
        self.byte_ranks = self.rank_of(np.repeat(self.letters, 512), np.tile(second, 256)).reshape(256, 512)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) * self.width + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], np.int32(NEVER))

    def words_of(self, pieces: list[str]) -> list[list[str]]:
        """The words of each piece, by one search."""
        out: list[list[str]] = [[]]
        for word in self.find_lines("\n".join([p.replace("\n", " ") for p in pieces])):
            if word == "\n":
                out.append([])
            else:
                out[-1].append(word)
        return out if pieces else []

    def pieces(self, text: str) -> Iterator[tuple[bool, str | list[str]]]:
        """(True, special token) or (False, what lies between white space in ordinary text).

        A word of the pattern never crosses white space, so that each piece is split into words alone.
        """
        for k, part in enumerate(self.split_special(text) if "<|" in text else (text,)):
            if k % 2:
                yield True, part
            else:
                if not part.isascii():
                    # lower-casing goes letter by letter, so a capital sigma never becomes a final one
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                part = part.lower()
                # four control characters are white space to Python but not to the pattern
                yield False, [part] if any(c in part for c in "\x1c\x1d\x1e\x1f") else part.split()

    def merge(self, word: str) -> list[int]:
        """Ids of a word: the pair of the lowest rank is merged first, the leftmost of equal ones."""
        raw = word.encode("utf-8", "surrogatepass")
        parts = [self.letter[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        if len(parts) > LONG:
            return self._merge_long(parts)
        of, made = self.ranks.get, self.made
        ranks = list(map(of, zip(parts, parts[1:], strict=False), repeat(NEVER)))
        while ranks and (r := min(ranks)) < NEVER:
            i = ranks.index(r)
            del ranks[i], parts[i]
            parts[i] = made[r]
            if i:
                ranks[i - 1] = of((parts[i - 1], parts[i]), NEVER)
            if i < len(ranks):
                ranks[i] = of((parts[i], parts[i + 1]), NEVER)
        return parts

    def merge_rows(self, raw: np.ndarray) -> Iterator[tuple[np.ndarray, list[list[int]]]]:
        """``merge`` of words of one length, the rows of a matrix of bytes: the places of some rows and their ids, until
        all rows have come."""
        parts = self.letters[raw]
        parts[:, -1] = self.lasts[raw[:, -1]]
        after = raw[:, 1:].astype(np.int32)
        after[:, -1:] += 256
        ranks = self.byte_ranks[raw[:, :-1], after]
        rows = np.arange(len(raw))
        while len(rows):
            low = ranks.min(axis=1, initial=NEVER)
            if (done := low == NEVER).any():
                yield rows[done], parts[done].tolist()
                rows, parts, ranks, low = rows[~done], parts[~done], ranks[~done], low[~done]
                if not len(rows):
                    return
            i, k = ranks.argmin(axis=1), np.arange(len(rows))  # the leftmost of equal ones
            parts[k, i] = self.made_ids[low]
            stay = np.ones(parts.shape, bool)
            stay[k, i + 1] = False
            parts = parts[stay].reshape(len(rows), -1)
            stay = np.ones(ranks.shape, bool)
            stay[k, i] = False
            ranks = ranks[stay].reshape(len(rows), -1)
            for near in (i - 1, i):
                at = np.flatnonzero((near >= 0) & (near < ranks.shape[1]))
                ranks[at, near[at]] = self.rank_of(parts[at, near[at]], parts[at, near[at] + 1])

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same with a heap, so that a word of n bytes takes n log n steps."""
        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = self.made[r], GONE
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (r := self.ranks.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p != GONE]


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker, which serves many tasks."""
    return Vocabulary(path)


def compile_lexicon(entries: dict[str, list[int]]) -> bytes:
    """The minimal automaton of the words, built from them in sorted order, with their ids.

    Layout, little-endian: number of states, edges, words and ids; per state its first edge and whether
    it ends a word; per edge its byte, target and the words before it; per word its first id; the ids.
    """
    keys = sorted((w.encode("utf-8", "surrogatepass"), ids) for w, ids in entries.items())
    edges: list[list[tuple[int, int]]] = []  # of the finished states
    finals: list[bool] = []
    known: dict[tuple, int] = {}

    def finish(state: list) -> int:
        shape = (state[0], tuple(state[1]))
        if shape not in known:
            known[shape] = len(edges)
            finals.append(state[0])
            edges.append(state[1])
        return known[shape]

    path: list[list] = [[False, []]]  # the states along the last word: [ends a word, edges]
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            done = finish(path.pop())
            path[-1][1].append((last[len(path) - 1], done))

    for word, _ in keys:
        same = next((i for i, (a, b) in enumerate(zip(word, last, strict=False)) if a != b), min(len(word), len(last)))
        close(same)
        path += [[False, []] for _ in range(len(word) - same)]
        path[-1][0] = True
        last = word
    close(0)
    root = finish(path[0])
    below = [0] * len(edges)  # words that start at a state; children are finished before parents
    for s, out in enumerate(edges):
        below[s] = finals[s] + sum(below[t] for _, t in out)
    order = [root, *(s for s in range(len(edges)) if s != root)]
    place = {s: i for i, s in enumerate(order)}
    first, labels, targets, skips = [0], bytearray(), [], []
    for s in order:
        before = int(finals[s])
        for label, t in edges[s]:
            labels.append(label)
            targets.append(place[t])
            skips.append(before)
            before += below[t]
        first.append(len(targets))
    starts, flat = [0], []
    for _, ids in keys:
        flat += ids
        starts.append(len(flat))
    head = struct.pack("<4I", len(order), len(targets), len(keys), len(flat))
    ints = lambda xs: struct.pack(f"<{len(xs)}I", *xs)
    return head + ints(first) + ints(targets) + ints(skips) + ints(starts) + ints(flat) + bytes(finals[s] for s in order) + bytes(labels)


class Lexicon:
    """A compiled automaton, mapped into memory."""

    def __init__(self, data: bytes):
        file = tempfile.TemporaryFile()  # has no name: nothing is left behind
        file.write(data)
        file.flush()
        self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        file.close()
        states, edges, words, ids = struct.unpack_from("<4I", self.map)
        view, at = memoryview(self.map), 16
        parts = []
        for n in (states + 1, edges, edges, words + 1, ids):
            parts.append(view[at : at + 4 * n].cast("I"))
            at += 4 * n
        first, self.target, self.skip, self.start, self.ids = (np.frombuffer(p, np.uint32) for p in parts)
        self.final = np.frombuffer(view[at : at + states], np.uint8)
        labels = np.frombuffer(view[at + states : at + states + edges], np.uint8)
        # edges lie by state and byte, so that state and byte find one by bisection
        self.edge_keys = np.repeat(np.arange(states, dtype=np.int64), np.diff(first.astype(np.int64))) << 8 | labels

    def numbers(self, raw: np.ndarray) -> np.ndarray:
        """The number of each word among words of one length, the rows of a matrix of bytes; -1 if it isn't here."""
        out = np.full(len(raw), -1, np.int64)
        rows, state, number = np.arange(len(raw)), np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        for column in raw.T if len(self.edge_keys) else []:
            keys = state << 8 | column[rows]
            edge = np.minimum(np.searchsorted(self.edge_keys, keys), len(self.edge_keys) - 1)
            on = self.edge_keys[edge] == keys
            rows, edge = rows[on], edge[on]
            state, number = self.target[edge].astype(np.int64), number[on] + self.skip[edge]
        ends = self.final[state] == 1 if len(self.edge_keys) and raw.shape[1] else np.zeros(len(rows), bool)
        out[rows[ends]] = number[ends]
        return out

    def get(self, word: str) -> list[int] | None:
        number = self.numbers(np.frombuffer(word.encode("utf-8", "surrogatepass"), np.uint8)[None, :])[0]
        return self.of(number) if number >= 0 else None

    def of(self, number: int) -> list[int]:
        return self.ids[self.start[number] : self.start[number + 1]].tolist()


class Coder:
    """Encodes and decodes texts. The ids of a piece, and the text decoded from them, are kept as strings,
    so that a text costs one look-up per piece. Pieces come in two generations: the older one goes when the younger
    one has ``KEPT`` bytes, and frequent pieces outlive that."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None = None):
        self.v, self.lexicon = vocabulary, lexicon
        self.id_texts = {i: str(i) for i in vocabulary.tokens}
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.size = 0

    def texts_of(self, ids: Iterable[int]) -> tuple[str, str]:
        """The ids joined by one space, and the text decoded from them: the file names no decoder, so that tokens are
        joined by one space too."""
        ids = list(ids)
        return " ".join(map(self.id_texts.__getitem__, ids)), " ".join(map(self.v.tokens.__getitem__, ids))

    def words(self, words: Iterable[str]) -> dict[str, tuple[str, str]]:
        """The ids and decoded texts of distinct words."""
        names = list(words)
        out: list[tuple[str, str]] = [("", "")] * len(names)
        raw = np.frombuffer("\n".join(names).encode("utf-8", "surrogatepass"), np.uint8)
        ends = np.append(np.flatnonzero(raw == 10), len(raw))  # no word holds a line feed
        starts = np.append(0, ends[:-1] + 1)
        for n in np.unique(ends - starts).tolist() if names else ():
            which = np.flatnonzero(ends - starts == n)
            if n > LONG:
                for i in which.tolist():
                    out[i] = self.texts_of(self.v.merge(names[i]))
                continue
            rows = raw[starts[which][:, None] + np.arange(n)]
            numbers = self.lexicon.numbers(rows) if self.lexicon else np.full(len(rows), -1)
            for i, number in zip(which[numbers >= 0].tolist(), numbers[numbers >= 0].tolist(), strict=True):
                out[i] = self.texts_of(self.lexicon.of(number))
            others = which[numbers < 0]
            for at, ids in self.v.merge_rows(rows[numbers < 0]):
                for i, x in zip(others[at].tolist(), ids, strict=True):
                    out[i] = self.texts_of(x)
        return dict(zip(names, out, strict=True))

    def learn(self, pieces: set[str]) -> None:
        """Makes all ``pieces`` known."""
        if self.size > KEPT:
            self.older, self.known, self.size = self.known, {}, 0
        unknown = pieces.difference(self.known)
        again = unknown.intersection(self.older)
        self.known.update({p: self.older[p] for p in again})
        unknown -= again
        whole, mixed = [], []  # a piece of letters alone is one word
        for piece in unknown:
            (whole if piece.isalpha() else mixed).append(piece)
        split = self.v.words_of(mixed)
        of = self.words({*whole, *chain.from_iterable(split)})
        self.known.update(zip(whole, map(of.__getitem__, whole), strict=True))
        for piece, words in zip(mixed, split, strict=True):
            found = [of[w] for w in words]
            self.known[piece] = " ".join([f[0] for f in found]), " ".join([f[1] for f in found])
        # the ids and tokens of a word take some ten characters for each of its own
        self.size += 300 * (len(unknown) + len(again)) + 10 * (sum(map(len, unknown)) + sum(map(len, again)))
        gc.freeze()  # what is kept has no cycles, and the collector need not visit it

    def joined(self, parts: list[tuple[bool, str | list[str]]], slices: bool) -> tuple[int, str, str]:
        ids, decoded = [], []
        for special, part in parts:
            if special:
                found = [self.texts_of([self.v.special[part]])]
                ids.append(found[0][0])
                decoded.append(found[0][1])
                continue
            for at in range(0, len(part), SLICE):
                now = part[at : at + SLICE] if slices else part
                if slices:
                    self.learn(set(now))
                found = list(map(self.known.__getitem__, now))
                ids.append(" ".join([f[0] for f in found]))
                decoded.append(" ".join([f[1] for f in found]))
                if not slices:
                    break
        joined = " ".join(ids)
        return joined.count(" ") + bool(joined), joined, " ".join(decoded)

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[int, str, str]]:
        """Of each text in turn: number of ids, the ids joined by one space, the text decoded from the ids."""
        group, size = [], 0

        def flush() -> Iterator[tuple[int, str, str]]:
            split = [list(self.v.pieces(t)) for t in group]
            self.learn(set().union(*(part for parts in split for special, part in parts if not special)))
            for parts in split:
                yield self.joined(parts, slices=False)
            group.clear()

        for text in texts:
            if len(text) >= CHUNK:
                yield from flush()
                size = 0
                yield self.joined(list(self.v.pieces(text)), slices=True)
                continue
            group.append(text)
            size += len(text)
            if size >= CHUNK:
                yield from flush()
                size = 0
        yield from flush()


_CODERS: dict[tuple, Coder] = {}


def coder(path: str, lexicon: bytes) -> Coder:
    """One per Python worker, which serves many tasks."""
    key = (path, hashlib.sha256(lexicon).digest())
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(vocabulary(path), Lexicon(lexicon))
    return _CODERS[key]


def column_texts(column: pa.Array, step: int = 256) -> Iterator[str]:
    """The texts of a column, some at a time, so that a batch isn't held twice."""
    for at in range(0, len(column), step):
        for text in column.slice(at, step).to_pylist():
            yield text or ""


def frequent_words(docs: DataFrame, path: str, size: int = LEXICON_SIZE) -> DataFrame:
    """The most frequent words of all texts, ``size`` at most: word, n. Counts are summed per task, some
    ``HELD`` pieces at a time, then by word."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, pieces = vocabulary(path), Counter()
        _CODERS.clear()  # another lexicon is on its way

        def out() -> pa.RecordBatch:
            counts = Counter({p: n for p, n in pieces.items() if p.isalpha()})  # a piece of letters alone is one word
            mixed = [p for p in pieces if not p.isalpha()]
            for piece, words in zip(mixed, v.words_of(mixed), strict=True):
                for word in words:
                    counts[word] += pieces[piece]
            pieces.clear()
            batch = pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})
            return batch

        size = 0
        for batch in batches:
            for text in column_texts(batch.column(0)):
                for special, part in v.pieces(text):
                    if not special:
                        pieces.update(part)
                size += len(text)
                if len(pieces) >= HELD or size >= HELD_CHARS:
                    yield out()
                    size = 0
        yield out()

    partial = docs.select(F.col("text").alias("t")).mapInArrow(count, "word string, n long")
    counts = materialize(partial.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1").withColumn("step", F.floor(F.log2("n") * 16).cast("int")))
    # The lowest of some hundred steps of frequency above which there are at most ``size`` words. Sorting for the
    # exact top would send that many rows from every task to the driver.
    least, found = None, 0
    for r in sorted(counts.groupBy("step").count().collect(), reverse=True):
        found += r["count"]
        if found > size:
            break
        least = r.step
    return counts.where(F.col("step") >= least) if least is not None else counts.limit(0)


def build_lexicon(docs: DataFrame, path: str, size: int = LEXICON_SIZE) -> bytes:
    """Compiled on the driver from ``size`` words at most, a parameter and not a share of the input."""
    v = vocabulary(path)
    return compile_lexicon({r.word: v.merge(r.word) for r in frequent_words(docs, path, size).collect()})


def encode(docs: DataFrame, path: str, size: int = LEXICON_SIZE, digests: bool = True, carry: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of ``docs`` with n_tokens and, of the ids and the text decoded from them,
    either digests (ids_sha256, decoded_sha256) or the values (ids array<int>, decoded)."""
    docs = small_batches(docs)
    lexicon = docs.sparkSession.sparkContext.broadcast(build_lexicon(docs, path, size))
    carry = list(carry)
    text = fresh(docs, "bpe_text")[0]
    spark_type = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "n_tokens long, ids array<int>, decoded string"
    kept = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, lexicon.value)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            n, first, second = [], [], []
            for count, ids, decoded in code.encode(column_texts(batch.column(len(carry)))):
                n.append(count)
                first.append(sha(ids) if digests else [int(i) for i in ids.split()])
                second.append(sha(decoded) if digests else decoded)
            kinds = (pa.int64(), pa.string(), pa.string()) if digests else (pa.int64(), pa.list_(pa.int32()), pa.string())
            names = ("n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")))
            arrays = [*(batch.column(i) for i in range(len(carry))), *(pa.array(x, k) for x, k in zip((n, first, second), kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[: len(carry)], *names])

    return kept.mapInArrow(run, (fields + ", " if fields else "") + spark_type)
