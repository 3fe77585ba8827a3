"""The operators on phrases, toxicity and sources against brute force, held-out labels and odd tables; parsers on malformed pages."""

import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loomgraph.llm import collocations, divergence, html_text, language, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \n\t ", "en", "a", 5), (4, "one", "en", "a", 3), (5, "Ab cd. ab CD ab cd, ab cd", "en", "", 0), (6, "ab cd ab cd", None, None, 0), (6, "ab cd ab cd", None, None, 0),
    (7, "ÄÖ ß12x\x00y\x1fz ab cd", "und", "b", 0), (8, "ab cd " * 3000, "en", "b", 0), (9, "x" * 100_000 + " ab", "en", "a", 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    clash = ("phrase", "rank", "term", "p", "score", "toxic", "value", "item", "a", "n", "w")
    return spark.createDataFrame(ODD, DOCS).withColumns({c: F.lit(1) for c in clash})


@pytest.fixture
def spread(spark):
    """Small partitions stay apart, so that groups cross their edges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def brute_collocations(rows, least, top=2000, within=80):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= within * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("least", [3, 30])
def test_collocations_equal_brute_force(spark, spread, least):
    r = random.Random(least)
    vocabulary = ["a", "bb", "c", "Dé", "e", "ff", "g", "of", "the", "x\x1fy"]
    rows = [(i, "".join(r.choice(vocabulary) + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(r.randrange(60))), r.choice(["en", "en", "de", None]), "s", 0) for i in range(150)]
    rows += [(900 + i, "of the people by the people " * 3, "en", "s", 0) for i in range(40)]
    got = collocations.collocations(spark.createDataFrame(rows, DOCS).repartition(5), least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, least)


def test_collocations_project_no_pair_of_a_rare_word(spark):
    """However full the counters of pairs are, a word that is not frequent in its language is in no pointer."""
    import numpy as np
    import pyarrow as pa

    known = collocations.frequent_words(spark.createDataFrame([("en", w, 50) for w in "abc"] + [("de", "x", 50)], "lang string, word string, f long"))
    full = np.full(collocations.BUCKETS // 8, 255, np.uint8).tobytes()
    texts = pa.record_batch([pa.array(["en", "de"]), pa.array(["a b x c b a y a b c", "x a x x"])], names=["lang", "text"])
    got = Counter()
    for batch in collocations._projecting(full, known)([texts]):
        for r in batch.to_pylist():
            got[r["lang"], r["prefix"], r["third"], r["fourth"]] += r["n"]
    assert got == {("en", "a b", None, None): 1, ("en", "c b", "a", None): 1, ("en", "b a", None, None): 1, ("en", "a b", "c", None): 1, ("en", "b c", None, None): 1, ("de", "x x", None, None): 1}


def test_collocations_counters_keep_rare_pairs_apart():
    """Three million pairs, nearly all of them different: hardly any counter reaches three."""
    import numpy as np
    import pyarrow as pa

    words = np.array([f"w{i}" for i in range(20_000)])
    texts = pa.record_batch([pa.array(["en"] * 10), pa.array([" ".join(x) for x in words[np.random.default_rng(1).integers(0, len(words), (10, 300_000))]])], names=["lang", "text"])
    counters = [c for batch in collocations._counting(3)([texts]) for c in batch["counters"].to_pylist() if c]
    for block in (np.zeros(collocations.BLOCK, np.uint8), np.full(collocations.BLOCK, 127, np.uint8), np.arange(collocations.BLOCK).astype(np.uint8) // 254 * 9):
        assert (collocations._unpacked(collocations._packed(block)) == block).all()
    assert sum(int((collocations._unpacked(c) >= 3).sum()) for c in counters) < 3_000


def test_collocations_grow_across_the_edges_of_tasks():
    """A prefix that several tasks share is counted as one: whatever the cut, the sums are those of one task."""
    import pyarrow as pa

    r = random.Random(1)
    rows = sorted({(lang, p, t, f): r.randrange(1, 9) for lang in "ab" for p in ("x y", "x z") for t in ("", "k", "l") for f in (("",) if not t else ("", "m", "n"))}.items())
    rows = [(*(x or None for x in k), n) for k, n in rows]
    batch = lambda part: pa.record_batch([pa.array([x[i] for x in part], pa.string() if i < 4 else pa.int64()) for i in range(5)], names=["lang", "prefix", "third", "fourth", "n"])

    def sums(parts):
        out = Counter()
        for part in parts:
            for b in collocations._growing(12)([batch(part)] if part else []):
                for x in b.to_pylist():
                    out[x["lang"], x["phrase"]] += x["f"]
        return {k: v for k, v in out.items() if v >= 12}

    whole = sums([rows])
    assert whole
    for cuts in [(i, j) for i in range(len(rows)) for j in range(i, len(rows))]:
        assert sums([rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] :]]) == whole


def test_collocations_on_odd_tables(spark, odd):
    got = sorted(map(tuple, collocations.collocations(odd, 3).collect()))
    assert got == brute_collocations(ODD, 3)
    assert collocations.collocations(odd.limit(0)).count() == 0


def brute_divergence(rows, least, top=10):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        key = (lang or "", source or "")
        groups.add(key)
        terms = [lower(x) for x in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[key].update(terms)
        docs[key[0]].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: counts[x, s] for x, s in groups if x == lang}
        prices = {}
        for s, c in [*own.items(), (None, sum(own.values(), Counter()))]:
            total = sum(c[t] for t in kept)
            prices[s] = {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        gap = lambda p, q: (p - q) * (p - q) // (p + q)
        for s in own:
            pair = sorted((-sum(gap(prices[s][t], prices[x][t]) for t in kept), x.encode(), x) for x in own if x != s)
            term = sorted((-gap(prices[s][t], prices[None][t]), t.encode(), t) for t in kept if own[s][t] and prices[s][t] > prices[None][t])[:top]
            out += [(lang, s, part, item, -v, i) for part, found in (("pair", pair), ("term", term)) for i, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("least", [2, 10])
def test_divergence_equals_brute_force(spark, least):
    r = random.Random(least)
    vocabulary = [f"{x}{y}" for x in "abcdeÉ" for y in ("on", "ER", "ß", "1z")]
    rows = [(i, r.choice([" ", "-"]).join(r.choices(vocabulary, weights=[1 + 30 * (j % 7 == i % 7) for j in range(len(vocabulary))], k=r.randrange(40))), r.choice(["en", "de", None, ""]), r.choice(["s1", "s2", "é3", None, ""]), 0) for i in range(200)]
    rows += [(500, "only here", "fr", "lonely", 0), (501, None, "en", "empty", 0)]
    got = divergence.divergence(spark.createDataFrame(rows, DOCS).repartition(3), least)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute_divergence(rows, least)


def test_divergence_on_odd_tables_and_large_counts(spark, odd):
    for least in (1, 10):
        assert sorted(map(tuple, divergence.divergence(odd, least).collect())) == brute_divergence(ODD, least)
    assert divergence.divergence(odd.limit(0)).count() == 0
    big = spark.createDataFrame([(9 * 10**18, 9 * 10**18, 3)], "n long, total long, v long").select(divergence._price("n", "total", "v").alias("p")).first().p
    assert big == 1 + 10**9 * (9 * 10**18 + 2) // (9 * 10**18 + 6)


def words(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice("bcdfglmr") + r.choice(["ing", "er", "on", "th", "ly"]) + r.choice("xyzaw") for _ in range(n))


def test_toxicity_on_held_out_labels(spark):
    """Texts with three insults are toxic, in plain and in disguise; a phrase that holds one, and one that looks like one, aren't."""
    r = random.Random(5)
    disguise = [str.lower, str.upper, lambda w: w.replace("o", "0"), lambda w: w.replace("i", "1"), lambda w: w.replace("o", "о").replace("a", "а"), lambda w: "​".join(w), lambda w: w + "###"]
    bad, rows, labels = ["moronic", "idiotize", "scumbag", "trashoid"], [], []
    for i in range(1500):
        toxic, n = i % 6 == 0, r.randrange(20, 400)
        text = words(n, i).split()
        for _ in range(3 + n // 60 if toxic else 0):
            w = r.choice(bad) if i % 3 else f"zwork{r.choice(['er', 'on', 'ly', 'th'])}{r.choice('abc')}"
            text.insert(r.randrange(len(text)), r.choice(disguise)(w))
        if not toxic and i % 4 == 0:
            text.insert(5, r.choice(["clean scumbag award", "trashoids"]))
        rows.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {x.doc_id: x for x in toxicity.score(docs, marks).collect()}
    assert all(x.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for i, x in out.items())
    held = [i for i, x in out.items() if x.held_out]
    assert len(held) > 200 and sum(out[i].predicted == labels[i][2] for i in held) >= 0.98 * len(held)
    # labels of held-out rows play no part
    turned = marks.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {x.doc_id: x.score for x in toxicity.score(docs, turned).collect()} == {i: x.score for i, x in out.items()}


def test_folding_matches_and_exceptions():
    assert toxicity.fold("Sсum 1diоt m0r0n $cum v1@gra it's 5 3rd ｌｏｓｅｒ tra­sh Éà ha!!") == ["scum", "idiot", "moron", "scum", "viagra", "it", "s", "erd", "loser", "trash", "éà", "ha"]
    lexicon = toxicity.Lexicon({"^clown$": 2.0, "^scum": 3.0}, ["^clown$^fish$", "^scumble$"])
    found = lambda text: [w for _, _, w in lexicon.matches(toxicity.marked(toxicity.fold(text)))]
    assert found("clown clown fish") == [2.0] and found("scumbag scumble sCum clowns") == [3.0, 3.0] and found("") == [] and list(toxicity.Lexicon({}).matches("^a$")) == []


def test_toxicity_on_odd_tables(spark, odd):
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 10)], "doc_id long, quality int, toxic int")
    for l in (marks, marks.limit(0), marks.where("toxic = 0")):
        out = toxicity.score(odd, l).collect()
        assert len(out) == len(ODD) and all(0 <= x.score <= 1 for x in out) and len({x.score for x in out if x.doc_id == 6}) == 1
        assert toxicity.score(odd.limit(0), l).count() == 0
    assert {x.score for x in toxicity.score(odd, marks.limit(0)).collect()} == {0.5}


MALFORMED = {
    "unclosed tags": "<a " * 1_700_000, "unclosed end tags": "</a " * 1_200_000, "open divs": "<div>" * 1_000_000, "skipped articles": "<aside>" + "<article>x" * 500_000, "quotes": "<a \"<b '" * 600_000,
    "open quotes": "<p>a" * 10 + '<a href="' * 500_000, "paragraphs in a table": "<p><table>" + "<div>" * 500_000 + "<div>x</div>" * 200_000, "comments": "<!--" * 1_200_000, "lists": "<ul>" + "<div><li>" * 500_000,
    "angle brackets": "<" * 5_000_000, "forms": "<form>" * 300_000 + "<article>x" * 300_000, "inline": "<nav>" + "<b>x</i>" * 600_000, "html": "<html " * 800_000, "references": "&#" + "9" * 5_000_000, "half references": "&" * 5_000_000,
}


@pytest.mark.parametrize("name", MALFORMED)
def test_malformed_pages_take_linear_time(name):
    began = time.time()
    html_text.parse(MALFORMED[name])
    assert time.time() - began < 20


def test_malformed_pages_through_the_operators(spark):
    rows = [(i, "https://h.example/a", text[:200_000]) for i, text in enumerate(MALFORMED.values())]
    pages = spark.createDataFrame([*rows, (99, None, None)], "page_id long, url string, html string")
    began = time.time()
    assert html_text.main_text(pages).count() == len(rows) + 1
    assert language.page_rows(pages).select("declared").where("declared is not null").count() == 0
    assert time.time() - began < 120


def test_tags_of_odd_pages():
    of = lambda page: [(page[a:b], end, name, rest) for a, b, end, name, rest in html_text.tags(page)]
    assert of("<p class='>'>x</P >") == [("<p class='>'>", False, "p", " class='>'"), ("</P >", True, "p", " ")]
    assert of("a < b <!-- > --><br/> <script>if (a<b) '</p>'</SCRIPT >z<!-- end") == [("<!-- > -->", False, None, ""), ("<br/>", False, "br", "/"), ("<script>if (a<b) '</p>'</SCRIPT >", False, None, ""), ("<!-- end", False, None, "")]
    assert of('<a href="x>t<b>u</b>') == [("<b>", False, "b", ""), ("</b>", True, "b", "")] and of("<a <b>") == [("<a <b>", False, "a", " <b")] and of("<!doctype html></ x>") == [("<!doctype html>", False, None, ""), ("</ x>", False, None, "")]
    assert html_text.extract("<p>&#" + "0" * 5_000 + "65; &#" + "9" * 5_000 + "; &amp;</p>") == "A � &"
