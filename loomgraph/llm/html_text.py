"""Main text of web pages, by their structure and by the suffixes of their host.

1. A page is parsed with the implied end tags of HTML (a ``p`` ends where a block begins, an ``li`` at the next one).
   Elements that the contract names are gone at once: menus, footers, sidebars, forms, and parts whose class, id or role
   says no more than that they are adverts, notices, reader comments and the like. The rest are blocks of three kinds: of
   the declared main part (article, main, role="main"); outside it; and *contested* ones, which are those of a part whose
   name may mean chrome or article ("related-work", "post-header"), and all blocks of a page that declares no main part.
2. The host's suffix array: the token streams of all pages of a host, of every kind, with and without a main part. A page
   enters suffixes that start near a *sampled* window of ``GRAM`` tokens, the least hash of every ``STEP`` windows, which
   two other pages of the host have too. Any stretch of ``LONG`` tokens shared by ``PAGES`` pages has such a window in all, at
   the same place of the stretch, so that no repeat is missed, and text that one or two pages have isn't shuffled. The suffixes, cut to ``DEPTH`` tokens of 15 bits each, are sorted across the cluster by range; runs of
   neighbours with common prefixes of ``LONG`` tokens from ``PAGES`` distinct pages are repeats, however large the host is.
   Ranges include the page, so that a prefix on all pages of a large host is spread over several, and of each run
   ``PAGES`` pages at most are counted together with those of its parts in other ranges; a run with so many within its range
   needs no count. What goes back to a page are places in its stream, so that no suffix is joined with another table, and only
   pages with repeats are joined with theirs, packed. Pages with equal streams are one page, so that copies don't make their own text boilerplate, and two pages may be versions of one text.
3. A token lies in a repeat if any stretch of ``LONG`` tokens around it is one. Contested blocks with ``COVERED`` of their
   tokens in repeats are boilerplate and dropped; others are unique and stay whole. Blocks of the declared main part stay,
   as the contract has the whole article, and blocks outside it go. ``n_repeated`` says how many tokens of the page's
   stream lie in repeats. A page without a main part of which nothing would be left is kept as it is.

Defined cases: null html gives an empty text; unclosed, unbalanced and nested elements are tolerated (a skipped part
ends where its element or an enclosing one ends, or where the main part begins, but for reader comments); null and
malformed addresses share a host; repeated rows are kept and get equal answers; an empty table gives an empty result;
very long pages cost time and memory in proportion to themselves; other columns are left out.
"""

from __future__ import annotations

import html as _html
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Tokens of a sampled window, windows of which one is sampled at least, tokens of a long repeat, and of a sorted suffix.
GRAM, STEP = 8, 12
LONG, DEPTH = GRAM + STEP - 1, 28
PAGES, COVERED = 3, 0.7
#: Bits, at most, of the broadcast table that tells pages' windows that fewer than PAGES pages have: 16 MB. It is sized by the windows
#: counted; how full it is changes the traffic alone.
MOST_BITS = 1 << 27
MAIN, CONTESTED, OUTSIDE = 0, 1, 2

#: Fixed names of the markup.
RAW = "script|style|noscript|template|svg|iframe|object|textarea|select|audio|video|canvas|title"
SKIPPED = {"head", "nav", "footer", "aside", "form", "button", "menu", "dialog", "search", "fieldset", "label"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "header", "hr", "li", "dd", "dt", "main", "menu", "nav", "ol", "p",
    "pre", "search", "section", "summary", "table", "ul", *HEADINGS,
}
BLOCKS = {*CLOSES_P, "br", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "body", "html", "head", "option", "button", "label"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
IN_HEAD = {"meta", "link", "base", "basefont", "bgsound"}
#: An open element that a start tag closes, and the elements that it isn't looked for beyond.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "table", "section", "article", "main", "blockquote"}),
    "dd": ({"dd", "dt"}, {"dl", "table", "section", "article", "main"}),
    "dt": ({"dd", "dt"}, {"dl", "table", "section", "article", "main"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
P_SCOPE = {"table", "td", "th", "caption", "button", "html"}
#: Elements that an end tag doesn't reach beyond.
CELLS, EVERY_BLOCK = {"td", "th"}, BLOCKS | SKIPPED
BEYOND = {"li": {"ul", "ol", "menu"}, "p": P_SCOPE, **dict.fromkeys(("article", "main", "body", "html", "table", "tr", "td", "th", "thead", "tbody", "tfoot"), set())}
#: Words in class, id or role: of reader comments; of chrome; that may be chrome; that say nothing beside another one.
COMMENTS = {"comment", "comments", "commentlist", "commentary-list", "respond", "replies", "reply", "disqus"}
CHROME = {
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "masthead", "banner", "footer", "sidebar", "aside", "ad", "ads", "advert", "adverts", "advertisement", "advertising", "promo",
    "sponsored", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "pagination", "pager", "toolbar", "complementary", "contentinfo",
}
UNSURE = {
    "header", "related", "recommended", "recommendations", "search", "share", "sharing", "social", "widget", "skip", "copyright", "alert", "notification", "subscribe", "subscription", "signup", "login",
    "discussion", "promotion", "sponsor",
}
PLAIN = {
    "site", "page", "main", "global", "top", "bottom", "left", "right", "primary", "secondary", "mobile", "desktop", "wrapper", "wrap", "container", "box", "block", "area", "bar", "list", "section", "slot",
    "unit", "item", "items", "inner", "outer", "widget", "links", "link", "text", "message", "sticky", "fixed", "policy", "form",
}
NOT = {"has", "with", "no", "without", "is"}
SKIP, SKIP_COMMENTS, WEAK, HEADER = 1, 2, 3, 4

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|<[!?/][^>]*>", re.S | re.I
)
_BEGINS = re.compile(r"<[a-zA-Z!?/]")  #: of tags; any other one is text
_RAW = re.compile(rf"<({RAW})\b", re.I)
_RAW_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split("|")}
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_REST = re.compile(r"[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*>")
_STOPS = re.compile(r"[>\"']")
#: References by more digits than any character has, which the library refuses to read: eight of them are too many as well.
_HUGE = re.compile(r"&#([0-9]{8,});?")
_MARKED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ROLE_MAIN = re.compile(r"\brole\s*=\s*[\"']?main\b", re.I)
_CASES = re.compile(r"([a-z0-9])([A-Z])")


def marks(attributes: str) -> int:
    """What class, id and role say of an element: SKIP, SKIP_COMMENTS, HEADER, WEAK or 0. A name that has a word of chrome and
    otherwise only words that say nothing is chrome; with other words, as in "related-work", it may be."""
    found = 0
    for a, b, c in _MARKED.findall(attributes):
        for name in (a or b or c).split():
            parts = [x for x in re.split(r"[^a-z0-9]+", _CASES.sub(r"\1-\2", name).lower()) if x]
            if not parts or parts[0] in NOT:
                continue
            rest = [x for x in parts if x not in PLAIN]
            if rest and all(x in COMMENTS for x in rest):
                return SKIP_COMMENTS
            if rest and all(x in CHROME or x in COMMENTS for x in rest):
                found = SKIP
            elif rest == ["header"] and not found:
                found = HEADER
            elif not found and any(x in CHROME or x in COMMENTS or x in UNSURE for x in rest):
                found = WEAK
    return found


class _Ends:
    """Where tags of a page end: at the first ``>`` outside quotes. Once a tag has been found without an end, quotes are looked
    up in a table, and no place that led to no end is tried twice, so that a page of such tags takes linear time."""

    def __init__(self, page: str):
        self.page, self.stops = page, None

    def after(self, place: int) -> int:
        """The place behind the tag whose name ends at ``place``; -1 if it has no end."""
        if self.stops is None:
            if m := _REST.match(self.page, place):
                return m.end()
            self.stops = [m.start() for m in _STOPS.finditer(self.page)]
            self.next, last = [-1] * len(self.stops), {}
            for k in range(len(self.stops) - 1, -1, -1):
                mark = self.page[self.stops[k]]
                self.next[k] = last.get(mark, -1)
                last[mark] = k
            self.dead: set[int] = set()
        k, seen = bisect_left(self.stops, place), []
        while 0 <= k < len(self.stops) and k not in self.dead:
            if self.page[self.stops[k]] == ">":
                return self.stops[k] + 1
            seen.append(k)
            k = self.next[k] + 1 or -1
        self.dead.update(seen)
        return -1


def tags(page: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """(start, end, whether it ends an element, name, attributes) of the tags of a page in order, each place read once. The name
    is None for comments, declarations and elements whose content is no text, which are taken whole. One expression reads a
    tag; from the first one that it can't read on, tags are read by their parts, so that none takes more than its share."""
    read, find, at = _TOKEN.match, page.find, page.find("<")
    while at >= 0:
        if m := read(page, at):
            _, slash, name, rest = m.groups("")
            start, at = at, m.end()
            yield start, at, slash == "/", name.lower() if name else None, rest
        elif _BEGINS.match(page, at):
            break
        else:
            at += 1
        at = find("<", at)
    ends, last = _Ends(page), page.rfind(">")
    while 0 <= at < last:
        end = -1
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4) + 3
            yield at, (end := end if end > 2 else len(page)), False, None, ""
        elif raw := _RAW.match(page, at):
            begin = page.find(">", raw.end()) + 1  # there is one, as the last is beyond
            m = _RAW_ENDS[raw[1].lower()].search(page, begin)
            yield at, (end := m.end() if m else len(page)), False, None, ""
        elif (name := _NAME.match(page, at)) and (end := ends.after(name.end())) > 0:
            yield at, end, bool(name[1]), name[2].lower(), page[name.end() : end - 1]
        elif page[at + 1 : at + 2] in ("!", "?", "/"):
            end = page.find(">", at + 2) + 1
            if end:
                yield at, end, False, None, ""
        at = page.find("<", end if end > 0 else at + 1)
    if at >= 0 and (at := page.find("<!--", at)) >= 0:
        yield at, len(page), False, None, ""  # a comment without an end


def _plain(piece: str) -> str:
    """A piece of text with its references decoded."""
    if "&" not in piece:
        return piece
    return _html.unescape(_HUGE.sub(lambda m: f"&#{m[1].lstrip('0')[:8] or 0};", piece))


class _Later:
    """Whether something still follows in a page, by its last place, which is looked up once."""

    def __init__(self, page: str):
        self.page, self.last = page, {}

    def has(self, what: str, place: int) -> bool:
        if what not in self.last:
            self.last[what] = max((m.start() for m in re.finditer(re.escape(what), self.page, re.I)), default=-1)
        return self.last[what] >= place


def parse(page: str | None) -> tuple[list[str], list[int], bool]:
    """The page's text blocks in order without skipped parts, their kinds, and whether the page declares a main part."""
    page = page or ""
    texts: list[str] = []
    kinds: list[int] = []
    run: list[str] = []
    stack: list[list] = []  # [name, mark, whether it is a main part]
    names: list[str] = []  # the names in the stack
    where: dict[str, list[int]] = defaultdict(list)  # the places of each name in it
    skips: Counter = Counter()  # how many open elements are skipped, by what would end them
    later = _Later(page)
    open_marks, mains, declared, at = [0, 0, 0, 0, 0], 0, False, 0

    def end_block() -> None:
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                texts.append(text)
                kinds.append((CONTESTED if open_marks[WEAK] else MAIN) if mains else OUTSIDE)

    def pop_to(i: int) -> None:
        nonlocal mains
        if run and not EVERY_BLOCK.isdisjoint(names[i:]):
            end_block()
        del names[i:]
        while len(stack) > i:
            name, mark, is_main = stack.pop()
            where[name].pop()
            open_marks[mark] -= 1
            mains -= is_main
            if mark == SKIP:
                skips[end_of(name)] -= 1

    def close(wanted: set[str], beyond: set[str]) -> None:
        """Closes the innermost of the wanted elements, if none of those beyond which they aren't looked for is within it."""
        i = max((where[x][-1] for x in wanted if where.get(x)), default=-1)
        if i >= 0 and i >= max((where[x][-1] for x in beyond if where.get(x)), default=-1):
            pop_to(i)

    def end_of(name: str) -> str:
        return "" if name == "form" else f"</{name}" if name in SKIPPED or name == "header" else "<main"

    def lifted(end: int) -> bool:
        """Whether a main part that begins within skipped parts ends them: those that have no end tag, a form, and a part
        skipped by its name alone if no other main part follows."""
        return not any(n > 0 and what and (later.has(what, end) or what == "<main" and later.has("<article", end)) for what, n in skips.items())

    for start, end, ending, name, attributes in tags(page):
        if start > at and not (open_marks[SKIP] or open_marks[SKIP_COMMENTS]):
            run.append(_plain(page[at:start]))
        at = end
        if name is None:
            continue
        block = name in EVERY_BLOCK
        if not block and not attributes and len(stack) == open_marks[0] and name not in VOID:
            continue  # a part of a line that nothing depends on
        if ending:
            if block and run:
                end_block()
            if where.get(name):
                close({name}, BEYOND.get(name, CELLS) if block else EVERY_BLOCK)
            continue
        if names and names[-1] == "head" and name not in IN_HEAD:
            pop_to(len(names) - 1)
        if block:
            if name in CLOSES_P:
                if where.get("p"):
                    close({"p"}, P_SCOPE)
                if name in HEADINGS and names and names[-1] in HEADINGS:
                    pop_to(len(names) - 1)
            if name in IMPLIED:
                close(*IMPLIED[name])
            if run:
                end_block()
        if name in VOID or attributes.rstrip().endswith("/"):
            continue
        mark = marks(attributes) if attributes and name not in ("body", "html") else 0
        if mark == HEADER:
            mark = 0 if mains else SKIP
        is_main = name == "main" or name == "article" and not mark or "role" in attributes and _ROLE_MAIN.search(attributes) is not None
        if is_main and not open_marks[SKIP_COMMENTS] and (not open_marks[SKIP] or not mains and lifted(end)):
            mark = 0
            for x in stack if open_marks[SKIP] else ():  # the main part begins within something that isn't closed, or that wraps the page
                if x[1] == SKIP:
                    x[1] = 0
                    open_marks[SKIP] -= 1
                    open_marks[0] += 1
            skips.clear()
        else:
            is_main = False
            if name in SKIPPED or name == "header" and not mains:
                mark = mark if mark == SKIP_COMMENTS else SKIP
            elif not block and mark == WEAK:
                mark = 0  # a part of a line isn't decided alone
        if block or mark or open_marks[SKIP] or open_marks[SKIP_COMMENTS]:
            where[name].append(len(stack))
            stack.append([name, mark, is_main])
            names.append(name)
            open_marks[mark] += 1
            mains += is_main
            declared |= is_main
            if mark == SKIP:
                skips[end_of(name)] += 1
    if not (open_marks[SKIP] or open_marks[SKIP_COMMENTS]):
        run.append(_plain(page[at:]))
    end_block()
    if not (declared and any(k != OUTSIDE for k in kinds)):
        return texts, [CONTESTED] * len(texts), False
    return texts, kinds, True


def extract(page: str | None) -> str:
    """The main text of one page by its structure alone."""
    texts, kinds, _ = parse(page)
    return " ".join(t for t, k in zip(texts, kinds, strict=True) if k != OUTSIDE)


# --- token streams -------------------------------------------------------------------------------------------


#: Fixed odd numbers, one for each place in a token, from a seeded generator; places beyond begin anew.
_AT = np.random.default_rng(20_240_301).integers(0, 2**63, 4_096, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
#: Characters of text that are hashed together.
CHUNK = 1 << 20


def hashes(texts: list[str]) -> np.ndarray:
    """One hash for each token of a stream: the sum of its bytes times the numbers of their places, mixed."""
    raw = np.frombuffer(" ".join(texts).encode("utf-8", "surrogatepass") + b" ", np.uint8)
    if len(raw) == 1:
        return np.empty(0, np.uint64)
    ends = np.flatnonzero(raw == 32)  # blocks hold single spaces, and no other white space
    starts = np.append(0, ends[:-1] + 1)
    lengths = ends - starts
    places = np.arange(len(raw)) - np.repeat(starts, lengths + 1)
    sums = np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * _AT[places % len(_AT)], starts)
    h = (sums ^ (sums >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def sampled(ids: np.ndarray, bounds: np.ndarray, hosts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and fingerprints (with the host) of the sampled windows of streams that lie one after the other in ``ids``,
    from ``bounds[k]`` to ``bounds[k + 1]``: the least, and leftmost, of every STEP windows of one stream."""
    n = len(ids) - LONG + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h = ids[: len(ids) - GRAM + 1] ^ np.repeat(hosts.astype(np.uint64), np.diff(bounds))[: len(ids) - GRAM + 1]
    for j in range(1, GRAM):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[j : len(ids) - GRAM + 1 + j]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    stream = np.repeat(np.arange(len(hosts)), np.diff(bounds))
    whole = np.flatnonzero(stream[:n] == stream[LONG - 1 :])  # stretches within one stream
    places = np.unique(np.lib.stride_tricks.sliding_window_view(h, STEP)[whole].argmin(axis=1) + whole)
    return places, h[places].astype(np.int64)


class Streams:
    """Some parsed pages and the streams of their tokens, one after the other."""

    def __init__(self, hosts: list[int], parsed: list[tuple[list[str], list[int], bool]]):
        self.hosts, self.parsed = np.array(hosts, np.int64), parsed
        lists = [t for texts, _, _ in parsed for t in texts]
        self.ids = hashes(lists)
        n = [sum(t.count(" ") + 1 for t in texts) for texts, _, _ in parsed]
        self.bounds = np.append(0, np.cumsum(n)).astype(np.int64)
        self.places, self.fps = sampled(self.ids, self.bounds, self.hosts)
        self.owner = np.searchsorted(self.bounds, self.places, side="right") - 1

    def bodies(self) -> np.ndarray:
        return np.array([_body(texts) for texts, _, _ in self.parsed], np.int64)


BLOCKS_OF = "host long, texts array<string>, kinds array<int>, declared boolean"


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host and the blocks of every page, parsed once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            at = size = 0
            for i, page in enumerate(batch["html"]):
                found.append(parse(page.as_py()))
                size += sum(map(len, found[-1][0]))
                if size >= CHUNK or i + 1 == batch.num_rows:
                    columns = (pa.array([x[k] for x in found], t) for k, t in enumerate((pa.list_(pa.string()), pa.list_(pa.int32()), pa.bool_())))
                    rows = batch.slice(at, len(found))
                    yield pa.record_batch([rows["page_id"], rows["url"], rows["host"], *columns], names=["page_id", "url", "host", "texts", "kinds", "declared"])
                    found, at, size = [], i + 1, 0

    return pages.select("page_id", "url", _host(F.col("url")).alias("host"), "html").mapInArrow(run, f"{_fields(pages)}, {BLOCKS_OF}")


def _fields(pages: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select("page_id", "url").schema.fields)


def streams(batch: pa.RecordBatch) -> Iterator[Streams]:
    """The parsed pages of a batch in their order, by CHUNK characters or so."""
    hosts, at, size = batch["host"].to_pylist(), 0, 0
    pages: list[tuple] = []
    for i, page in enumerate(zip(batch["texts"], batch["kinds"], batch["declared"], strict=True)):
        pages.append(tuple(x.as_py() for x in page))
        size += sum(map(len, pages[-1][0]))
        if size >= CHUNK or i + 1 == len(hosts):
            yield Streams(hosts[at : i + 1], pages)
            pages, at, size = [], i + 1, 0


def near(places: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The starts of stretches of LONG tokens that hold a window at one of ``places``, of streams from begin to end."""
    starts = places[:, None] - np.arange(STEP)[None, :]
    return np.unique(starts[(starts >= begin[:, None]) & (starts <= end[:, None] - LONG)])


def suffix_keys(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The first DEPTH tokens of the suffixes, 16 bits each, 0 beyond the end: they sort as bytes."""
    short = ((ids >> np.uint64(48)) | np.uint64(1)).astype(">u2")
    padded = np.concatenate([short, np.zeros(DEPTH, ">u2")])
    return padded[starts[:, None] + np.arange(DEPTH)[None, :]]


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows).tobytes())]).cast(pa.binary())


def _host(url: Column) -> Column:
    name = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return F.xxhash64(F.coalesce(F.lower(name), F.lit("")))


def _body(texts: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(texts).encode("utf-8", "surrogatepass")) - 2**63


def candidates(pages: DataFrame) -> DataFrame:
    """Fingerprints (fp) of sampled windows that three pages of a host share, PAGES, as fewer make no repeat. What lies between the
    least and the greatest page shows in a remainder of the sum, so that a window of any number of pages is one row per task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in streams(batch):
                own = (part.bodies() & 0x7FFFFFFF).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(part.fps), pa.array(own[part.owner])], names=["fp", "body"])

    rows = pages.select("host", "texts", "kinds", "declared").mapInArrow(run, "fp long, body int")
    both = rows.groupBy("fp").agg(F.min("body").alias("lo"), F.max("body").alias("hi"), F.count("*").alias("n"), F.sum("body").alias("total"))
    return both.where("(total - n * lo) % nullif(hi - lo, 0) <> 0").select("fp")


def bitmap(fps: DataFrame) -> np.ndarray:
    """A table of 1,024 bits for each fingerprint, MOST_BITS at most, of which each one sets one; it comes to the driver as one row
    for every 32,768 bits."""
    size = min(MOST_BITS, 1 << max(24, (1024 * fps.count()).bit_length()))
    place = F.pmod(F.col("fp"), F.lit(size))
    rows = fps.groupBy(F.shiftright(place, 15).alias("bucket")).agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(32_767))).alias("bits")).collect()
    out = np.zeros(size >> 3, np.uint8)
    for r in rows:
        out[r.bucket << 12 : (r.bucket + 1) << 12] = np.frombuffer(r.bits, np.uint8)
    return out


def likely(fps: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = fps % (len(bits) << 3)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def suffixes(pages: DataFrame, bits) -> DataFrame:
    """host, key, body of the suffixes that start near windows which other pages may have, and the token they start at."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in streams(batch):
                hit = likely(part.fps, bits.value)
                owner = part.owner[hit]
                starts = near(part.places[hit], part.bounds[owner], part.bounds[owner + 1])
                owner = np.searchsorted(part.bounds, starts, side="right") - 1
                keys = suffix_keys(part.ids, starts)
                keys[starts[:, None] + np.arange(DEPTH)[None, :] >= part.bounds[owner + 1][:, None]] = 0  # a suffix ends with its page
                bodies = part.bodies()[owner] if len(owner) else np.empty(0, np.int64)
                places = (starts - part.bounds[owner]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(part.hosts[owner]), _binary(keys), pa.array(bodies), pa.array(places)], names=["host", "key", "body", "place"])

    return pages.select("host", "texts", "kinds", "declared").mapInArrow(run, "host long, key binary, body long, place int")


def common_prefixes(keys: np.ndarray, hosts: np.ndarray) -> np.ndarray:
    """The common prefix, in tokens, of each sorted suffix with the one before it; 0 for the first and at a new host."""
    out = np.zeros(len(keys), np.int64)
    if len(keys) > 1:
        same = keys[1:] == keys[:-1]
        out[1:] = np.where(hosts[1:] == hosts[:-1], np.where(same.all(axis=1), DEPTH, same.argmin(axis=1)), 0)
    return out


def repeats(rows: DataFrame) -> DataFrame:
    """(l_host, l_body, places): where the suffixes of a page start whose first LONG tokens PAGES pages of its host share."""

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(n, DEPTH)
                hosts, bodies, places = (batch.column(k).to_numpy() for k in (0, 2, 3))
                begins = common_prefixes(keys, hosts) < LONG  # of runs that share LONG tokens
                first, run = np.flatnonzero(begins), np.cumsum(begins) - 1
                order = np.lexsort((places, bodies, run))
                run, bodies, places = run[order], bodies[order], places[order]
                other = np.append(True, (run[1:] != run[:-1]) | (bodies[1:] != bodies[:-1]))
                new = other | np.append(True, places[1:] != places[:-1])
                sizes = np.bincount(run[other], minlength=len(first))
                sure = sizes >= PAGES
                # the first and the last run of a batch may go on in others: those say some of their pages, and all places if they are few
                edge = np.zeros(len(first), bool)
                edge[[0, -1]] = True
                nth = np.cumsum(other) - 1
                few = nth - nth[np.searchsorted(run, run)] < PAGES
                kept = new & (sure | edge)[run]
                run, bodies, places, few = run[kept], bodies[kept], places[kept], few[kept]
                starts: list = [None] * len(first)
                starts[0], starts[-1] = (keys[first[k], :LONG].tobytes() for k in (0, -1))
                yield pa.RecordBatch.from_arrays([pa.array(hosts[first][run]), pa.array(starts, pa.binary()).take(pa.array(run)), pa.array(bodies), pa.array(places), pa.array(sure[run]), pa.array(few)], names=["host", "start", "body", "place", "sure", "few"])

    ordered = rows.repartitionByRange("host", "key", "body").sortWithinPartitions("host", "key", "body")
    parts = materialize(ordered.mapInArrow(runs, "host long, start binary, body long, place int, sure boolean, few boolean"), "zstd")
    told = parts.where(F.col("start").isNotNull() & F.col("few")).select("host", "start", "body")  # PAGES pages of two runs of a batch at most
    wide = told.groupBy(F.col("host").alias("w_host"), F.col("start").alias("w_start")).agg(F.count_distinct("body").alias("n")).where(F.col("n") >= PAGES).drop("n")
    unsure = parts.where(~F.col("sure"))
    late = unsure.join(wide, (F.col("host") == F.col("w_host")) & (F.col("start") == F.col("w_start")), "left_semi")
    both = parts.where("sure").select("host", "body", "place").unionByName(late.select("host", "body", "place"))
    # one list for each distinct page, no longer than the page
    return both.groupBy(F.col("host").alias("l_host"), F.col("body").alias("l_body")).agg(F.collect_set("place").alias("places"))


def covered(n: int, places: list[int]) -> np.ndarray:
    """Which of n tokens lie in a repeat, by where the repeats start."""
    steps = np.zeros(n + 1, np.int64)
    at = np.array(places, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + LONG, -1)
    return np.cumsum(steps)[:n] > 0


def decide(texts: list[str], kinds: list[int], declared: bool, repeated: np.ndarray | None) -> list[str]:
    """The blocks that stay, from which tokens of the stream lie in repeats, if any do."""
    if repeated is None:
        return [t for t, k in zip(texts, kinds, strict=True) if k != OUTSIDE]
    out, at = [], 0
    for text, kind in zip(texts, kinds, strict=True):
        n = text.count(" ") + 1
        if kind == MAIN or kind == CONTESTED and repeated[at : at + n].mean() < COVERED:
            out.append(text)
        at += n
    return out if declared else out or texts


def main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars, n_repeated."""
    spark = pages.sparkSession
    source = materialize(parsed(pages), "zstd")
    bits = spark.sparkContext.broadcast(bitmap(materialize(candidates(source))))
    lists = materialize(repeats(materialize(suffixes(source, bits), "zstd")), "zstd")
    marked = spark.sparkContext.broadcast(bitmap(lists.select(F.col("l_body").alias("fp"))))
    fields = _fields(pages)
    answer = fields + ", text string, n_chars long, n_repeated long"

    def answers(ids: list, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array([t for t, _ in ids], pa.string())
        n = pa.array([len(t) for t, _ in ids], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts, n, pa.array([r for _, r in ids], pa.int64())], names=["page_id", "url", "text", "n_chars", "n_repeated"])

    def sharing(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        bodies = np.array([_body(t) for t in batch["texts"].to_pylist()], np.int64)
        return bodies, likely(bodies, marked.value)

    def alone(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages without a repeat."""
        for batch in batches:
            rows = batch.filter(pa.array(~sharing(batch)[1]))
            pages = zip(*(rows[k].to_pylist() for k in ("texts", "kinds", "declared")), strict=True)
            yield answers([(" ".join(decide(*page, None)), 0) for page in pages], rows)

    def shares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The others, to be joined with their repeats; blocks are packed, as they hold no line feed."""
        for batch in batches:
            bodies, hit = sharing(batch)
            rows = batch.filter(pa.array(hit))
            blocks = [zlib.compress("\n".join(t).encode()) for t in rows["texts"].to_pylist()]
            yield pa.record_batch([rows["page_id"], rows["url"], rows["host"], pa.array(blocks, pa.binary()), rows["kinds"], rows["declared"], pa.array(bodies[hit])], names=["page_id", "url", "host", "blocks", "kinds", "declared", "body"])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for blocks, kinds, declared, places in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True):
                texts = zlib.decompress(blocks).decode().split("\n") if kinds else []
                repeated = covered(sum(t.count(" ") + 1 for t in texts), places or [])
                out.append((" ".join(decide(texts, kinds, declared, repeated)), int(repeated.sum())))
            yield answers(out, batch)

    joined = source.mapInArrow(shares, f"{fields}, host long, blocks binary, kinds array<int>, declared boolean, body long").join(lists, (F.col("host") == F.col("l_host")) & (F.col("body") == F.col("l_body")), "left")
    both = joined.select("page_id", "url", "blocks", "kinds", "declared", "places").mapInArrow(cut, answer)
    return source.mapInArrow(alone, answer).unionByName(both)
