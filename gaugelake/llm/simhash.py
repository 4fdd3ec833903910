"""Near-duplicate components by SimHash, exact neighbours through vantage-point trees.

A vantage point splits fingerprints by their Hamming distance to it, at the median: inner and outer half. By the triangle
inequality a pair within r of each other, one in each half, has both members within r of the border, so a query only goes
to the halves that its ball of radius r reaches. The first levels of the tree deal the fingerprints to shards: each lives
in one shard and is a guest in the shards of inner halves that its ball reaches. In a shard a tree over its residents
answers all of them and the guests. Nothing is approximate: every pair within r meets in one shard.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm.common import batch_of, keep, per_slice
from gaugelake.llm.components import components

WORDS, SEED, RADIUS = 3, 42, 2
SHARD = 1 << 17  # fingerprints that live in a shard, about
SAMPLED = 64  # fingerprints drawn per shard to place the vantage points: the only use of a sample
MOST_SAMPLED = 1 << 20
LEAF = 48
GUESTS = 4  # guests per resident in one task, about; more are dealt to further tasks with the same residents
HOT = 1000  # a fingerprint with over 1/HOT of all documents is joined by broadcast: there are fewer than HOT of them


def fingerprint(text: str | None) -> int:
    """Bit b is 1 if it is set in over half of the XXH64 codes of the 3-word shingles (repeats count). Words end at
    blanks; A-Z are lower-cased. Fewer words are one shingle, and a text without words has fingerprint 0."""
    words = text.encode().lower().split() if text else []  # bytes.lower() and split() know ASCII only
    if not words:
        return 0
    if len(words) <= WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1][:len(words) - WORDS + 1].tolist()
    code = xxhash.xxh64_intdigest
    codes = np.fromiter((code(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1:].tolist())), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(codes), 1 << 16):
        part = codes[at:at + (1 << 16)]
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(codes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``f``, the fingerprint as a signed long, for every row."""
    arrow = pa.schema([("doc_id", pa.int64()), ("f", pa.int64())])

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        own = np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64)
        return batch_of(arrow, part.column("doc_id"), own.view(np.int64))

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(per_slice(run), "doc_id long, f long"))


def distance(a, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Tree:
    """Nodes as (vantage, border, inner, outer); leaves as arrays of places in ``points``."""

    __slots__ = ("points", "root")

    def __init__(self, points: np.ndarray, leaf: int = LEAF, depth: int = 64):
        self.points = points
        self.root = self.node(np.arange(len(points)), leaf, depth)

    def node(self, places: np.ndarray, leaf: int, depth: int):
        if len(places) <= leaf or not depth:
            return places
        vantage = self.points[places[0]]
        away = distance(self.points[places], vantage)
        border = int(np.partition(away, len(away) // 2)[len(away) // 2])
        if (away <= border).all():
            border -= 1  # distinct points: the vantage itself is nearer
        inner = away <= border
        return vantage, border, self.node(places[inner], leaf, depth - 1), self.node(places[~inner], leaf, depth - 1)

    def near(self, queries: np.ndarray, radius: int):
        """(places of queries, places of points) of all pairs within ``radius``, leaf by leaf."""
        stack = [(self.root, np.arange(len(queries)))]
        while stack:
            node, own = stack.pop()
            if not len(own):
                continue
            if isinstance(node, tuple):
                vantage, border, inner, outer = node
                away = distance(queries[own], vantage).astype(np.int64)
                stack.append((inner, own[away <= border + radius]))
                stack.append((outer, own[away > border - radius]))
                continue
            for at in range(0, len(own), 1 << 14):
                part = own[at:at + (1 << 14)]
                q, p = np.nonzero(distance(queries[part][:, None], self.points[node][None, :]) <= radius)
                if len(q):
                    yield part[q], node[p]


class Shards:
    """The first levels of the tree, over a sample: which shard a fingerprint lives in, and where it is a guest."""

    def __init__(self, sample: np.ndarray, shards: int, radius: int):
        self.radius, self.count = radius, 0
        depth = max(0, math.ceil(math.log2(max(shards, 1))))
        self.root = self.named(Tree(np.unique(sample), leaf=1, depth=depth).root)

    def named(self, node):
        if isinstance(node, tuple):
            return (*node[:2], self.named(node[2]), self.named(node[3]))
        self.count += 1
        return self.count - 1

    def deal(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in ``f``, shard, whether it is a guest there. A resident near a border is a guest in the inner half; the
        pair across a border is found there, so inner residents need not go out. A guest goes wherever its ball reaches."""
        out, stack = [], [(self.root, np.arange(len(f)), np.zeros(len(f), bool))]
        while stack:
            node, own, guest = stack.pop()
            if not len(own):
                continue
            if not isinstance(node, tuple):
                out.append((own, np.full(len(own), node), guest))
                continue
            vantage, border, inner, outer = node
            away = distance(f[own], vantage).astype(np.int64)
            lives = ~guest & (away <= border)
            visits = (guest | (away > border)) & (away <= border + self.radius)
            stack.append((inner, np.r_[own[lives], own[visits]], np.r_[guest[lives], np.ones(visits.sum(), bool)]))
            beyond = np.where(guest, away > border - self.radius, away > border)
            stack.append((outer, own[beyond], guest[beyond]))
        if not out:
            return (np.empty(0, np.int64),) * 2 + (np.empty(0, bool),)
        return tuple(np.concatenate(c) for c in zip(*out))


def roots(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each group after joining pairs ``a``, ``b``: hook the greater root to the lesser one, halve paths."""
    while True:
        ra, rb = parent[a], parent[b]
        unlike = ra != rb
        if not unlike.any():
            return parent
        a, b = a[unlike], b[unlike]
        lo, hi = np.minimum(ra[unlike], rb[unlike]), np.maximum(ra[unlike], rb[unlike])
        np.minimum.at(parent, hi, lo)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def linked(residents: np.ndarray, guests: np.ndarray, both: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (greater, least of its group in this shard) that join what pairs within ``radius`` join. Pairs are used up
    as they are found: at most one link a member is told, however many pairs a family has."""
    tree = Tree(residents)
    asked = np.concatenate([residents, guests]) if both else guests
    every = np.unique(np.concatenate([residents, guests]).view(np.int64))
    place = {"asked": np.searchsorted(every, asked.view(np.int64)), "residents": np.searchsorted(every, residents.view(np.int64))}
    parent = np.arange(len(every))
    for q, p in tree.near(asked, radius):
        parent = roots(parent, place["asked"][q], place["residents"][p])
    moved = np.flatnonzero(parent != np.arange(len(every)))
    return every[moved], every[parent[moved]]


def links(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``f`` with at most ``radius`` differing bits: not all pairs, but
    their components are those of all pairs."""
    n = distinct.count()
    shards = max(1, math.ceil(n / shard))
    wanted = min(MOST_SAMPLED, SAMPLED * shards)
    drawn = distinct.where(F.pmod(F.xxhash64("f"), F.lit(max(1, n // wanted))) == 0).limit(2 * wanted) if shards > 1 else distinct.limit(1)
    ring = Shards(np.array([r.f for r in drawn.collect()], np.int64).view(np.uint64), shards, radius)
    arrow = pa.schema([("f", pa.int64()), ("shard", pa.int32()), ("guest", pa.bool_())])

    def deal(batches):
        for batch in batches:
            f = batch.column("f").to_numpy()
            for at in range(0, len(f), 1 << 13):
                own = f[at:at + (1 << 13)]
                place, number, guest = ring.deal(own.view(np.uint64))
                yield batch_of(arrow, own[place], number.astype(np.int32), guest)

    dealt = keep(distinct.select("f").mapInArrow(deal, "f long, shard int, guest boolean"), "simhash-dealt")
    sizes = dealt.groupBy("shard").agg(F.count_if("guest").alias("g"), F.count_if(~F.col("guest")).alias("r"))
    parts = sizes.select("shard", F.ceil(F.greatest(F.lit(1.0), F.col("g") / (F.col("r") + 1) / GUESTS)).cast("int").alias("parts"))
    placed = dealt.join(parts, "shard").withColumn(
        "part", F.when(F.col("guest"), F.array(F.pmod(F.xxhash64("f"), F.col("parts")).cast("int")))
        .otherwise(F.sequence(F.lit(0), F.col("parts") - 1))).select("shard", "f", "guest", F.explode("part").alias("part"))
    found = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        f, guest = group.column("f").to_numpy().view(np.uint64), group.column("guest").to_numpy()
        a, b = linked(f[~guest], f[guest], key[1].as_py() == 0, radius)
        return pa.table([a, b], schema=found)

    return placed.groupBy("shard", "part").applyInArrow(run, "a long, b long")


def near_components(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``f`` (fingerprint as a signed long) and ``component_id``: the least id among the documents reached over
    links of at most ``radius`` differing bits.

    Every row has a result. Null texts and texts without words have fingerprint 0, which links like any other; very long
    texts are taken whole. A row without an id takes part but names no component, which is null if no member has an
    id. Repeated rows share a component. No rows give no result; other columns are ignored. Copies of a fingerprint are
    one node, so a group of copies costs one row each.
    """
    own = keep(fingerprints(docs), "simhash-fingerprints")
    nodes = keep(own.groupBy("f").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-nodes")
    labels = components(keep(links(nodes, radius), "simhash-links"))
    known = nodes.join(labels, nodes["f"] == labels["id"], "left").select("f", "least", "n", F.coalesce("label", "f").alias("label"))
    named = known.groupBy("label").agg(F.min("least").alias("component_id"))
    table = keep(known.join(named, "label").select("f", "component_id", "n"), "simhash-components")
    return with_components(own, table)


def with_components(own: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with the component of their fingerprint. Fingerprints of over 1/HOT of all rows, fewer than HOT in number, are
    broadcast, so that no task gets all rows of one; the others are shuffled."""
    total = table.agg(F.sum("n").alias("n")).first().n or 0
    often = F.col("n") * HOT > total
    few = F.broadcast(table.where(often).select("f", "component_id"))
    rest = own.join(few.select("f"), "f", "left_anti")
    both = own.join(few, "f").unionByName(rest.join(table.where(~often).select("f", "component_id"), "f"))
    return both.select("doc_id", "f", "component_id")
