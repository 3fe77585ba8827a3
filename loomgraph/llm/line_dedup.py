"""Line dedup by site-relative frequency, with DataFrame functions only.

Pages are grouped by host. A line's ratio is the number of the host's pages that contain it over all
pages of the host; lines above the boilerplate ratio are dropped from every page of that host. Each
page counts a line once, and counts are summed before the shuffle, so neither a host with most of
the pages nor a line on all of them meets in one task. Lines are counted by their hashes first; the
text of those that may be frequent is then counted exactly.

The lists of boilerplate are joined to the pages by host. Lists of ``BROADCAST`` characters in all are broadcast.
Beyond that the hosts with over 1 / ``LARGE`` of all pages, which are fewer than ``LARGE``, are joined by a broadcast of
their lists, as their pages must not meet in one task, and the pages of the other hosts by a shuffle.

A line is what stands between line feeds, compared without white space around it. Defined cases: a
null text stays null and has no lines; lines without a word are kept and not counted; null hosts are
one host; hosts with fewer than ``min_pages`` pages that carry a line never lose it; repeated rows
count as pages of their own; an empty table gives an empty one. Other columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, materialize

RATIO, MIN_PAGES = 0.1, 5
MARKS = 1 << 21
BROADCAST, LARGE = 32 << 20, 1024


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per host that has boilerplate: its name (line_host), the lines (line_set) and its number of pages.

    A host's lines number at most (mean distinct lines of its pages) / ratio, as each takes more than
    that share of its pages; the arrays are that small for any number of pages.
    """
    pages = docs.select(F.col(f"`{host}`").alias("host"), F.col("text"))
    total = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = pages.select("host", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _bare))).alias("line")).where(F.col("line") != "")

    def frequent(rows: DataFrame, by: str) -> DataFrame:
        c, t = rows.groupBy("host", by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages).alias("c"), total.alias("t")
        return c.join(t, F.col("c.host").eqNullSafe(F.col("t.host"))).where(F.col("n") > ratio * F.col("pages")).select("c.host", by)

    # Most lines are on one page. Counts of 64-bit hashes, which no collision makes too small, leave few that may be
    # frequent, and only these are shuffled as text and counted exactly. They are told by a table of at most MARKS
    # numbers, broadcast; how full it is changes the traffic and not the result.
    mark = lambda x: F.pmod(F.xxhash64("host", x), F.lit(MARKS)).cast("int")
    marks = materialize(frequent(lines.select("host", F.xxhash64("line").alias("hash")), "hash").select(mark("hash").alias("mark")).distinct())
    likely = lines.join(F.broadcast(marks), mark(F.xxhash64("line")) == F.col("mark"), "left_semi")
    lists = frequent(likely, "line").groupBy(F.col("host").alias("line_host")).agg(F.collect_set("line").alias("line_set"))
    return lists.join(total, F.col("line_host").eqNullSafe(F.col("host"))).select("line_host", "line_set", "pages")


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, counts: bool = False) -> DataFrame:
    """``docs`` with the text less its host's boilerplate lines; with ``counts`` also n_lines (lines
    with a word) and n_dropped."""
    bad = boilerplate(docs, host, ratio, min_pages)
    h, s, k = fresh(docs, "line_host", "line_set", "line_kept")
    # written, so that its size is known when the join is planned
    bad = materialize(bad)
    same = F.col(f"`{host}`").eqNullSafe(F.col(h))
    size = bad.agg(F.sum(F.aggregate("line_set", F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)))).first()[0] or 0
    if size <= BROADCAST:
        joined = docs.join(F.broadcast(bad.select(F.col("line_host").alias(h), F.col("line_set").alias(s))), same, "left")
    else:
        total = docs.count()
        large = F.col("pages") * LARGE > total
        lists = lambda which: bad.where(which).select(F.col("line_host").alias(h), F.col("line_set").alias(s))
        hosts = F.broadcast(lists(large).select(h))
        few = docs.join(hosts, same, "left_semi").join(F.broadcast(lists(large)), same, "left")
        joined = few.unionByName(docs.join(hosts, same, "left_anti").join(lists(~large), same, "left"))
    kept = F.when(F.col(s).isNull(), _lines(F.col("text"))).otherwise(F.filter(_lines(F.col("text")), lambda x: ~F.array_contains(F.col(s), _bare(x))))
    out = joined.withColumn(k, kept).select(
        *[F.array_join(F.col(k), "\n").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        *([
            let(_lines(F.coalesce("text", F.lit(""))), lambda x: F.size(F.filter(x, lambda y: _bare(y) != ""))).cast("long").alias("n_lines"),
            F.coalesce(F.size(_lines(F.col("text"))) - F.size(k), F.lit(0)).cast("long").alias("n_dropped"),
        ] if counts else []),
    )
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out


SQL = r"""
WITH l AS (
  SELECT doc_id, source, text, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) AS bare FROM documents),
t AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
c AS (
  SELECT source, line, count(*) AS n FROM (SELECT source, unnest(list_distinct(bare)) AS line FROM l) WHERE line <> '' GROUP BY source, line),
b AS (
  SELECT c.source, list(line) AS bad FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source WHERE n >= 5 AND n > 0.1 * pages GROUP BY c.source)
SELECT doc_id, l.source,
       CASE WHEN bad IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(bad, bare[i])), chr(10)) END AS text,
       len(list_filter(bare, lambda x: x <> ''))::BIGINT AS n_lines,
       coalesce(len(list_filter(bare, lambda x: list_contains(bad, x))), 0)::BIGINT AS n_dropped
FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source
"""
