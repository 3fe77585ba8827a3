"""Near-duplicate documents by an LSH forest, confirmed on full sets.

1. Each text becomes its set of word shingles (64-bit hashes) and a MinHash signature. Texts with equal sets
   are one class, represented by its smallest doc_id; only classes go on.
2. The forest: ``TREES`` sorted orders, each of a different sequence of the signature's values. Rows that agree
   in the first ``SHALLOW`` values are a region; within it, neighbours in the order (longest common prefix) are
   candidates. Regions with more than ``CROWDED`` rows are split at a greater depth, so that no task sorts an
   unbounded one, and their parts are tied by their smallest members.
3. Candidates whose signatures agree far enough tie classes into groups, by rounds of large-star and
   small-star joins. Two classes over the threshold agree in the first values of at least one order with
   probability 1 - (1 - s^SHALLOW)^TREES (over 0.999999). That they then are neighbours, or tied by rows between
   them, isn't proved but measured: no link is missing against brute force (``tests/llm``).
4. Within a group every pair that matters is decided on full sets. Sets travel as hashes. A group beyond one block
   is linked to ``REPS`` representatives first, in slices that each hold some members and the representatives: one
   pass over the group. What these links join needs no more comparing, so that the members outside the largest
   such part alone are compared with all others, in tiles of two blocks, through an inverted index. Blocks have
   ``BLOCK`` sets and ``WEIGHT`` hashes on average, as sets are dealt by a hash, and one set at least. Tiles return a
   spanning forest, from which the components follow by the same rounds. A group of m near copies of which r are far
   from all representatives costs m + m r / BLOCK sets of traffic; r grows with m where a group has no centre.

Defined cases: texts without words (and null texts) have an empty set, are linked with nothing and are kept;
repeated rows, and rows of one doc_id with different texts, are one node; rows with a null doc_id belong to the
class of their set, never represent it and are kept; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, small_batches

TREES, SHALLOW, DEEP, LEVELS = 20, 3, 6, 8
CROWDED = 4_096
REPS, BLOCK, WEIGHT = 4, 256, 1 << 21
MARKS = 1 << 21
#: A candidate's estimated similarity may lie this far (over 4 standard deviations) below the threshold.
SLACK = 0.27
HASHES = TREES * SHALLOW
_CHUNK, _HELD, _LONG = 16_384, 150_000, 64

_rng = np.random.default_rng(20_240_229)
_A = (_rng.integers(0, 2**31, HASHES).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 2**32, HASHES).astype(np.uint32)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        out = xxhash.xxh3_64_intdigest(word)
        if len(word) <= _LONG:  # so that the table is bounded in bytes
            if len(self) > _HELD:
                self.clear()
            self[word] = out
        return out


_WORDS = _Words()


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct hashes of the text's ``k``-word shingles; of all its words if they are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(k, len(words))
    h = ids[: len(ids) - k + 1].copy()
    for j in range(1, k):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[j : len(ids) - k + 1 + j]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(h ^ (h >> np.uint64(32)))


def signature(hashes: np.ndarray) -> np.ndarray:
    low, out = (hashes >> np.uint64(17)).astype(np.uint32), np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(low), _CHUNK):
        part = low[at : at + _CHUNK]
        np.minimum(out, (part[None, :] * _A[:, None] + _B[:, None]).min(axis=1), out=out)
    return out


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, set_hash (128 bits), sig (the signature's values, 4 bytes each)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sets, sigs = [], [], []
            for text in batch.column(1).to_pylist():
                h = shingles(text, k)
                n.append(len(h))
                sets.append(xxhash.xxh3_128_digest(h.tobytes()))
                sigs.append(signature(h).astype(">u4").tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(sigs, pa.binary())], names=["doc_id", "n_shingles", "set_hash", "sig"])

    return small_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set_hash binary, sig binary")


def forest_edges(classes: DataFrame, similarity: float) -> DataFrame:
    """Candidate pairs a < b from (node, sig), whose signatures agree far enough."""

    def key(tree: int):
        own = [tree * SHALLOW + i for i in range(SHALLOW)]
        more = [(tree * SHALLOW + SHALLOW + 7 * i) % HASHES for i in range(LEVELS - SHALLOW)]
        return F.concat(*[F.substring("sig", 4 * i + 3, 2) for i in own + more])  # the lower two bytes of a value

    trees = F.explode(F.array(*[F.struct(F.lit(t).cast("byte").alias("tree"), key(t).alias("key")) for t in range(TREES)]))
    rows = classes.select("node", trees.alias("t")).select("node", "t.tree", "t.key").withColumn("region", F.substring("key", 1, 2 * SHALLOW))
    crowded = rows.groupBy("tree", "region").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED).withColumnsRenamed({"tree": "c_tree", "region": "c_region"})
    rows = rows.join(crowded, (F.col("tree") == F.col("c_tree")) & (F.col("region") == F.col("c_region")), "left")
    rows = rows.withColumn("part", F.when(F.col("n").isNull(), F.col("region")).otherwise(F.substring("key", 1, 2 * DEEP)))
    order = Window.partitionBy("tree", "part").orderBy("key", "node")
    near = rows.select("node", F.lag("node", 1).over(order).alias("p"), F.lag("node", 2).over(order).alias("q"))
    near = near.where("p is not null").select("node", F.explode(F.array_compact(F.array("p", "q"))).alias("other"))
    parts = rows.where("n is not null").groupBy("tree", "region", "part").agg(F.min("node").alias("node"))
    heads = parts.groupBy("tree", "region").agg(F.min("node").alias("other"))
    ties = parts.join(heads, ["tree", "region"]).select("node", "other")
    pairs = near.unionByName(ties).where("node <> other").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    sig = classes.select(F.col("node").alias("s_node"), "sig")
    both = pairs.join(sig, F.col("a") == F.col("s_node")).select("a", "b", F.col("sig").alias("sig_a")).join(sig, F.col("b") == F.col("s_node")).select("a", "b", "sig_a", "sig")
    least = int(np.ceil((similarity - SLACK) * HASHES))

    def agree(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lambda column: np.frombuffer(b"".join(column.to_pylist()), ">u4").reshape(-1, HASHES)
        for batch in batches:
            if batch.num_rows:
                same = (of(batch.column(2)) == of(batch.column(3))).sum(axis=1) >= least
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(same))

    return both.mapInArrow(agree, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), the root being the smallest node that it reaches.

    Large-star and small-star steps by turns (Kiveris et al. 2014); each is a grouped minimum, which sums up
    before its shuffle, joined back. Every round is written to the shared folder."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large.unionByName(least.where("k <> m").select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(least, F.col("u") == F.col("k")).select("v", "m").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct())


def _links(sets: list[np.ndarray], block: list[int], percent: int) -> Iterator[tuple[int, int]]:
    """The pairs over the threshold; across the two blocks only, if there are two."""
    size = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), size)
    order = np.argsort(ids, kind="stable")
    postings, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(ids))])
    own, where = np.array(block), np.concatenate([[0], np.cumsum(size)])
    two = own.min() != own.max()
    for x in range(len(sets)):
        mine = ids[where[x] : where[x + 1]]
        mine = mine[starts[mine + 1] - starts[mine] > 1]
        if len(mine) == 0 or two and own[x] != own.min():
            continue
        shared = np.bincount(np.concatenate([postings[a:b] for a, b in zip(starts[mine], starts[mine + 1], strict=True)]), minlength=len(sets))
        hit = 100 * shared >= percent * (size + size[x] - shared)
        for y in np.flatnonzero(hit & ((own != own[x]) if two else (np.arange(len(sets)) > x))):
            yield x, int(y)


def _mark(name: str):
    return F.pmod(F.xxhash64(name), F.lit(MARKS)).cast("int")


def _blocks(n: str, weight: str):
    return F.ceil(F.greatest(F.col(n) / BLOCK, F.col(weight) / WEIGHT)).cast("int")


def _spanning(names: list[int], links: Iterable[tuple[int, int]]) -> pa.Table:
    """The links (a, b) of a spanning forest of places in ``names``."""
    root = {n: n for n in names}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in links:
        a, b = find(names[x]), find(names[y])
        if a != b:
            root[max(a, b)] = min(a, b)
    found = [(find(n), n) for n in root if find(n) != n]
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _sets(table: pa.Table) -> tuple[list[int], list[np.ndarray], list[int]]:
    """Nodes, sets and blocks of the rows, repeated ones once."""
    rows = dict.fromkeys(zip(*(table.column(c).to_pylist() for c in ("node", "set", "block")), strict=True))
    return [n for n, _, _ in rows], [np.frombuffer(s, np.uint64) for _, s, _ in rows], [b for _, _, b in rows]


def _joined(mask: Column) -> Column:
    """The representatives that those of a mask are joined with by sets linked to several (kinds: the masks of a group)."""
    for _ in range(REPS - 1):
        mask = F.aggregate("kinds", mask, lambda a, x: F.when(a.bitwiseAND(x["mask"]) != 0, a.bitwiseOR(x["mask"])).otherwise(a))
    return mask


def _sum(of: str, where) -> Column:
    return F.aggregate("kinds", F.lit(0).cast("long"), lambda a, x: F.when(where(x["mask"]), a + x[of]).otherwise(a))


def confirmed(docs: DataFrame, groups: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) that span the components of each group, from (node, group) and the texts of the nodes."""
    # Only texts of grouped nodes are worth a shuffle. A table of at most MARKS hashes, broadcast, sorts most of the
    # others out beforehand; how full it is changes the traffic and not the result.
    marks = groups.select(_mark("node").alias("mark")).distinct()
    likely = docs.select("doc_id", "text").join(F.broadcast(marks), _mark("doc_id") == F.col("mark"), "left_semi")

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, k) for t in batch.column(1).to_pylist()]
            arrays = [batch.column(0).cast(pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "set", "n"])

    own = likely.mapInArrow(hashed, "doc_id long, set binary, n long").where("n > 0")
    sets = materialize(own.join(groups, F.col("doc_id") == F.col("node")).select("node", "group", "set", "n"))
    firsts = [F.min(F.struct(F.xxhash64("node", F.lit(i)), "node"))["node"] for i in range(REPS)]
    sizes = sets.groupBy(F.col("group").alias("s_group")).agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"), F.array_distinct(F.array(*firsts)).alias("reps"))
    sizes = materialize(sizes.select("s_group", _blocks("m", "w").alias("parts"), "reps"))
    sized = sets.join(sizes, F.col("group") == F.col("s_group"))

    def star(table: pa.Table) -> pa.Table:
        names, found, block = _sets(table)
        reps = [(i, -1 - b) for i, b in enumerate(block) if b < 0]
        members = [x for x, b in enumerate(block) if b >= 0]
        masks = []
        for x in members:
            mask = 0
            for r, k in reps:
                n = len(found[r]) + len(found[x])
                small = min(len(found[r]), len(found[x]))
                if 100 * small >= percent * (n - small):  # else sizes alone keep them apart
                    shared = np.intersect1d(found[r], found[x], assume_unique=True).size
                    mask |= int(100 * shared >= percent * (n - shared)) << k
            masks.append(mask)
        columns = {
            "group": pa.array([table.column("group")[0].as_py()] * len(members), pa.int64()), "node": pa.array([names[x] for x in members], pa.int64()),
            "set": pa.array([found[x].tobytes() for x in members], pa.binary()), "n": pa.array([len(found[x]) for x in members], pa.int64()), "mask": pa.array(masks, pa.int32()),
        }
        return pa.table(columns)

    def tile(table: pa.Table) -> pa.Table:
        names, found, block = _sets(table)
        return _spanning(names, _links(found, block, percent))

    zero = F.lit(0)
    tiles = sized.where("parts = 1").select("node", "set", "group", zero.alias("block"), zero.alias("i"), zero.alias("j"))
    links = None
    if not sizes.where("parts > 1").isEmpty():
        large = sized.where("parts > 1")
        sliced = large.select("node", "group", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("slice"), "set", zero.alias("block"))
        place = F.array_position("reps", F.col("node")).cast("int")
        centres = large.where(place > 0).select("node", "group", F.explode(F.sequence(zero, F.col("parts") - 1)).alias("slice"), "set", (-place).alias("block"))
        masks = materialize(sliced.unionByName(centres).groupBy("group", "slice").applyInArrow(star, "group long, node long, set binary, n long, mask int"))
        # of each group by mask, 2^REPS at most: which representatives are joined, and which such part is the largest
        kinds = masks.groupBy("group", "mask").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"))
        kinds = kinds.groupBy(F.col("group").alias("k_group")).agg(F.collect_list(F.struct("mask", "m", "w")).alias("kinds"))
        parts = F.transform(F.array(*[_joined(F.lit(1 << k)) for k in range(REPS)]), lambda c: F.struct(_sum("m", lambda x: x.bitwiseAND(c) != 0).alias("m"), c.alias("mask")))
        kinds = kinds.withColumn("main", F.array_max(parts)["mask"])
        inside, outside = (lambda x: x.bitwiseAND(F.col("main")) != 0), (lambda x: x.bitwiseAND(F.col("main")) == 0)
        counted = kinds.select("k_group", "main", *[_sum(of, where).alias(f"{name}_{of}") for name, where in (("main", inside), ("rest", outside)) for of in ("m", "w")])
        info = materialize(counted.select("k_group", "main", _blocks("main_m", "main_w").alias("n_main"), _blocks("rest_m", "rest_w").alias("n_rest")))
        bits = F.array(*[F.lit(1 << k) for k in range(REPS)])
        linked = F.filter("reps", lambda r, i: F.col("mask").bitwiseAND(F.get(bits, i)) != 0)
        links = masks.select("group", "node", "mask").join(sizes, F.col("group") == F.col("s_group")).select("node", F.explode(linked).alias("rep"))
        links = links.where("node <> rep").select(F.least("node", "rep").alias("a"), F.greatest("node", "rep").alias("b"))
        rest = F.col("mask").bitwiseAND(F.col("main")) == 0
        dealt = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
        block = F.when(rest, dealt("n_rest")).otherwise(F.col("n_rest") + dealt("n_main"))
        parted = masks.join(info.where("n_rest > 0"), F.col("group") == F.col("k_group")).select("node", "set", "group", block.alias("block"), "n_rest", (F.col("n_rest") + F.col("n_main")).alias("n_all"))
        # a block of the rest meets every block, one of the main part those of the rest
        others = F.sequence(zero, F.when(F.col("block") < F.col("n_rest"), F.col("n_all")).otherwise(F.col("n_rest")) - 1)
        parted = parted.withColumn("other", F.explode(others))
        tiles = tiles.unionByName(parted.select("node", "set", "group", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    found = tiles.groupBy("group", "i", "j").applyInArrow(tile, "a long, b long")
    return found if links is None else found.unionByName(links)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept. Two texts are linked if their sets of
    ``k``-word shingles have 100 * intersection >= ``percent`` * union."""
    sketches = materialize(sketch(docs, k))
    classes = materialize(sketches.where("n_shingles > 0").groupBy("set_hash").agg(F.min("doc_id").alias("node"), F.min("sig").alias("sig")))
    groups = components(forest_edges(classes.where("node is not null").select("node", "sig"), percent / 100))
    heads = groups.select(F.col("root").alias("node"), F.col("root").alias("group")).distinct()
    groups = heads.unionByName(groups.select("node", F.col("root").alias("group")))
    linked = components(confirmed(docs, groups, k, percent))
    owned = classes.select("set_hash", "node").join(linked, "node", "left").select(F.col("set_hash").alias("c_hash"), F.coalesce("root", "node").alias("component_id"))
    out = sketches.join(owned, F.col("set_hash") == F.col("c_hash"), "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    # rows of one id with different texts are one node, named by the smallest of their components
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "set_hash")


def deduplicated(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` of which one stays for each component; an id that stays for one of its texts stays with all
    of them, and rows without an id stay. Only rows whose id hashes like one that goes are shuffled."""
    found = materialize(near_duplicates(docs, k, percent).select("doc_id", "kept"))
    ids = found.groupBy("doc_id").agg(F.max("kept").alias("any"), F.sum(F.col("kept").cast("int")).alias("n"))
    name, key = fresh(docs, "gone_id", "gone_mark")
    gone = materialize(ids.where(~F.col("any")).select(F.col("doc_id").alias(name)))
    marks = F.broadcast(gone.select(_mark(name).alias(key)).distinct())  # at most MARKS rows
    on = _mark("doc_id") == F.col(key)
    stay = docs.join(marks, on, "left_anti").unionByName(docs.join(marks, on, "left_semi").join(gone, F.col("doc_id") == F.col(name), "left_anti"))
    again = ids.where("n > 1 and doc_id is not null").select(F.col("doc_id").alias(name))
    if again.isEmpty():
        return stay
    same = F.col("doc_id") == F.col(name)  # rows that the table repeats
    return stay.join(again, same, "left_anti").unionByName(stay.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
