"""Near-duplicate classes by order MinHash, candidates verified by a banded alignment."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugelake.llm.common import batch_of, grams, keep, mix, per_slice, word_codes, words_of
from gaugelake.llm.components import components
from gaugelake.llm.recurring import key_columns, keyed

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 32  # a pair at 0.8 shares a key with probability 1 - (1 - 0.8 ** MINIMA) ** SKETCHES, over 0.9999
MINIMA = 6
FEW = 64  # texts of up to so many grams have FEW_SKETCHES more keys, of FEW_MINIMA grams: the chance above falls with the
FEW_SKETCHES = 16  # number of grams (0.990 for 8 of 10 in common) and with these is over 0.9998 at every number
FEW_MINIMA = 4
WHOLE = 8  # pairs of up to 17 grams in all may differ by one gram: that of up to WHOLE grams is the other without one gram
LEADERS_GROW = 8  # times as many leaders a bucket in each further round
SEED = 20240611


def labelled(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Codes of the word k-grams in text order, each with the number of its earlier occurrences mixed in.

    A text of fewer than ``k`` words is one gram of all its words; one without words has none.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    codes = grams(word_codes(words), min(k, len(words)))
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    first = np.r_[0, np.flatnonzero(ranked[1:] != ranked[:-1]) + 1]
    nth = np.empty(len(codes), np.uint64)
    nth[order] = (np.arange(len(codes)) - np.repeat(first, np.diff(np.r_[first, len(codes)]))).astype(np.uint64)
    return mix(codes + nth * np.uint64(0xD1342543DE82EF95))


def sketch(codes: np.ndarray, sketches: int = SKETCHES, minima: int = MINIMA, seed: int = SEED) -> np.ndarray:
    """One key per random order: its ``minima`` least grams, taken in text order."""
    n = len(codes)
    if not n:
        return np.empty(0, np.uint64)
    salts = mix(np.arange(seed, seed + sketches, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    keys = np.empty(sketches, np.uint64)
    step = max(1, (1 << 18) // n)
    for at in range(0, sketches, step):
        own = salts[at:at + step, None]
        rank = codes[None, :] * own
        rank ^= rank >> np.uint64(29)
        rank *= np.uint64(0xBF58476D1CE4E5B9)
        rank ^= rank >> np.uint64(32)
        if n > minima:
            place = np.sort(np.argpartition(rank, minima - 1, axis=1)[:, :minima], axis=1)
        else:
            place = np.broadcast_to(np.arange(n), (len(own), n))
        key = own[:, 0].copy()
        for column in range(place.shape[1]):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + codes[place[:, column]])
        keys[at:at + step] = key
    return keys


def sketch_keys(codes: np.ndarray) -> np.ndarray:
    """The keys of a text. One of up to MINIMA grams has none: pairs with it can only differ by one gram (short_keys)."""
    if len(codes) <= MINIMA:
        return np.empty(0, np.uint64)
    more = sketch(codes, FEW_SKETCHES, FEW_MINIMA, SEED + SKETCHES) if len(codes) <= FEW else np.empty(0, np.uint64)
    return np.r_[sketch(codes), more]


def short_keys(codes: np.ndarray) -> tuple[int | None, np.ndarray]:
    """A key of all grams in order, for texts of up to WHOLE grams, and the keys of what is left without one gram, for
    texts of 5 to WHOLE + 1 grams. With fewer, one gram more or less is below the threshold."""
    n = len(codes)

    def key(own: np.ndarray) -> np.ndarray:
        return grams(own, len(own), 0xC2B2AE3D27D4EB4F)

    whole = int(key(codes).view(np.int64)[0]) if 0 < n <= WHOLE else None
    if not 5 <= n <= WHOLE + 1:
        return whole, np.empty(0, np.uint64)
    return whole, np.unique(np.concatenate([key(np.delete(codes, i)) for i in range(n)]))


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence whose matches lie within ``band`` places of each other.

    Labelled grams do not repeat in a text, so it is the longest increasing run of matched places.
    """
    _, left, right = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    order = np.argsort(left)
    right = right[order][np.abs(left[order] - right[order]) <= band]
    if len(right) < 2 or (right[1:] > right[:-1]).all():
        return len(right)
    tails: list[int] = []
    for place in right.tolist():
        at = bisect_left(tails, place)
        if at == len(tails):
            tails.append(place)
        else:
            tails[at] = place
    return len(tails)


def allowance(total: int, similarity: float) -> int:
    """Unmatched grams that a pair with ``total`` grams may have: matched / (total - matched) >= similarity."""
    return int(total * (1 - similarity) / (1 + similarity) + 1e-9)


def alike(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether matched / (grams of both - matched) reaches ``similarity`` in the best order-keeping alignment.

    The band is the allowance: in an alignment with so few unmatched grams no match can be shifted further.
    """
    total = len(a) + len(b)
    most = allowance(total, similarity)
    return abs(len(a) - len(b)) <= most and total - 2 * aligned(a, b, most) <= most


def keys_of(base: DataFrame) -> DataFrame:
    arrow = pa.schema([("k", pa.int64()), ("t", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())),
                       ("whole", pa.int64()), ("without", pa.list_(pa.int64()))])

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        codes = [labelled(text) for text in part.column("text").to_pylist()]
        short = [short_keys(c) for c in codes]
        return batch_of(arrow, part.column("k"), part.column("t"), [len(c) for c in codes],
                        [sketch_keys(c).view(np.int64) for c in codes], [w for w, _ in short],
                        [left.view(np.int64) for _, left in short])

    return base.mapInArrow(per_slice(run), "k long, t long, n long, keys array<long>, whole long, without array<long>")


def short_pairs(keys: DataFrame) -> DataFrame:
    """``a``, ``b``: texts with the grams of a, or these and one more, each with one text of those grams. What is
    joined to nothing here differs by more than one gram from every text of up to WHOLE grams."""
    wholes = keys.where("whole IS NOT NULL").groupBy(F.col("whole").alias("key")).agg(F.min("t").alias("a"))
    members = (keys.where("whole IS NOT NULL").select("t", F.col("whole").alias("key"))
               .unionByName(keys.select("t", F.explode("without").alias("key"))))
    return members.join(wholes, "key").where("t <> a").select("a", F.col("t").alias("b"))


def sequences(base: DataFrame) -> DataFrame:
    arrow = pa.schema([("t", pa.int64()), ("grams", pa.binary())])

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        return batch_of(arrow, part.column("t"), [labelled(t).tobytes() for t in part.column("text").to_pylist()])

    return base.mapInArrow(per_slice(run), "t long, grams binary")


def verified(pairs: DataFrame, grams_of: DataFrame, similarity: float) -> DataFrame:
    """``a``, ``b``, whether they are ``alike``, the grams that b adds to a, and how many of a's it lacks."""
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("alike", pa.bool_()), ("added", pa.list_(pa.int64())), ("lacks", pa.int64())])

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        good, added, lacks = [], [], []
        for x, y in zip(part.column("ga").to_pylist(), part.column("gb").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            good.append(alike(x, y, similarity))
            added.append(np.setdiff1d(y, x, assume_unique=True).view(np.int64))
            lacks.append(len(x) - (len(y) - len(added[-1])))
        return batch_of(arrow, part.column("a"), part.column("b"), good, added, lacks)

    left = grams_of.select(F.col("t").alias("a"), F.col("grams").alias("ga"))
    right = grams_of.select(F.col("t").alias("b"), F.col("grams").alias("gb"))
    return (pairs.join(right, "b").join(left, "a").select("a", "b", "ga", "gb")
            .mapInArrow(per_slice(run, "gb"), "a long, b long, alike boolean, added array<long>, lacks long"))


def linked(base: DataFrame, firsts: DataFrame, similarity: float) -> DataFrame:
    """``id`` and ``label`` (least id of the component) of the texts that have a link.

    Pairs of so few grams that they may differ by only one are found by short_keys, all others by sketches. First each bucket of a sketch: the member that shares most keys with others, the likely original of a family, is
    compared with all members. That joins the family. What a member adds to its original and lacks of it is kept.

    Then what the originals did not join: the buckets that hold several components. Members of the smallest
    components of a bucket lead, in rounds with ever more leaders, and are compared with members of other components,
    but for those that cannot be alike: texts whose numbers of grams differ by more than they may differ in all, and
    texts with one original whose changes to it, without those they share, are too many (what both add is counted,
    of what they lack they share at most what the one with fewer lacks). A bucket is done when one component is left,
    or all of its members but those of the largest one have led: every pair that shares a key is then joined, compared
    or ruled out.
    """
    sketched = keys_of(base).join(firsts, ["k", "t"]).dropDuplicates(["t"]).select("t", "n", "keys", "whole", "without")
    keys = keep(sketched, "near-keys")
    single = keys.select("t", F.explode("keys").alias("key"))
    shared = single.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    buckets = keep(single.join(shared, "key"), "near-buckets")
    hubs = buckets.groupBy("t").agg(F.sum("members").alias("degree"))
    short = keep(short_pairs(keys), "near-short")
    compared = hubs.select("t").unionByName(short.select(F.explode(F.array("a", "b")).alias("t"))).distinct()
    grams_of = keep(sequences(base.join(firsts, ["k", "t"]).join(compared, "t").dropDuplicates(["t"])), "near-grams")

    ranked = buckets.select("key", "t").join(hubs, "t")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("degree", "t")).alias("top"))
    starred = (ranked.join(pivots, "key").where("t <> top.t")
               .select(F.col("top.t").alias("a"), F.col("t").alias("b"), F.col("top.degree").alias("degree")))
    pairs = keep(starred.unionByName(short.withColumn("degree", F.lit(0).cast("long"))).groupBy("a", "b")
                 .agg(F.max("degree").alias("degree")), "near-pairs")
    found = keep(verified(pairs.select("a", "b"), grams_of, similarity), "near-compared")
    done = found.select("a", "b")
    own = (pairs.groupBy("b").agg(F.max(F.struct("degree", "a")).alias("p")).select("b", F.col("p.a").alias("a"))
           .join(found, ["a", "b"]).select(F.col("b").alias("t"), F.col("a").alias("original"), "added", "lacks"))
    carried = ["t", "n", "degree", "original", "added", "lacks"]
    texts = keep(keys.join(hubs, "t").join(own, "t", "left").select(carried), "near-texts")
    waiting, labels, leaders = buckets.select("key", "t"), None, LEADERS_GROW
    while True:
        stars = found.where("alike").select("a", "b")
        if labels is None:
            labels = keep(components(stars), "near-labels")
        elif not stars.isEmpty():
            stars = stars.unionByName(labels.select(F.col("id").alias("a"), F.col("label").alias("b")))
            labels = keep(components(stars), "near-labels")
        known = (waiting.join(labels, F.col("t") == F.col("id"), "left")
                 .select("key", "t", F.coalesce("label", "t").alias("label")))
        mixed = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
        known = keep(known.join(mixed, "key").join(texts, "t").select("key", *carried, "label"), "near-open")
        parts = known.groupBy("key", "label").agg(F.count("*").alias("size"))
        largest = parts.groupBy("key").agg(F.max(F.struct("size", "label")).alias("top"))
        order = Window.partitionBy("key").orderBy("size", "label", F.desc("degree"), "t")
        lead = (known.join(parts.join(largest, "key").where("label <> top.label").select("key", "label", "size"), ["key", "label"])
                .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= leaders))
        lead = keep(lead.select(*(F.col(c).alias("l_" + c) for c in ("key", *carried, "label"))), "near-lead")
        if lead.isEmpty():
            return labels
        most = (F.col("n") + F.col("l_n")) * ((1 - similarity) / (1 + similarity)) + 1e-9
        changes = F.size("added") + F.size("l_added") + F.abs(F.col("lacks") - F.col("l_lacks"))
        apart = (F.abs(F.col("n") - F.col("l_n")) > most) | ((F.col("original") == F.col("l_original")) & (changes > most) & (
            (changes - 2 * F.least(F.size("added"), F.size("l_added")) > most)
            | (changes - 2 * F.size(F.array_intersect("added", "l_added")) > most)))
        on = (F.col("key") == F.col("l_key")) & (F.col("label") != F.col("l_label")) & ~F.coalesce(apart, F.lit(False))
        pairs = (known.join(lead, on).select(F.least("t", "l_t").alias("a"), F.greatest("t", "l_t").alias("b")).distinct()
                 .join(done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
        found = keep(verified(keep(pairs, "near-pairs"), grams_of, similarity), "near-compared")
        done = done.unionByName(found.select("a", "b"))
        waiting = (known.join(lead.select(F.col("l_key").alias("key"), F.col("l_t").alias("t")), ["key", "t"], "left_anti")
                   .select("key", "t"))
        leaders *= LEADERS_GROW


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``k``, ``t`` and ``lead`` (the ``k`` and ``t`` of the first document of its class) of every document with words.

    Copies of a text are one node, so a group of copies costs one row each and no comparison.
    """
    base = keyed(docs).where(F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    firsts = base.groupBy("t").agg(F.min("k").alias("k"))
    near = linked(base, firsts, similarity).join(firsts, F.col("id") == F.col("t")).select("t", "k", "label")
    leads = near.groupBy("label").agg(F.min(F.struct("k", "t")).alias("lead"))
    near = near.join(leads, "label").select("t", "lead")
    nodes = firsts.join(near, "t", "left").select("t", F.coalesce("lead", F.struct("k", "t")).alias("lead"))
    return base.select("k", "t").join(nodes, "t").select("k", "t", "lead")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id`` and ``class_id`` (least doc_id of the class) per document.

    A null or text without words is alone in its class, and so is a row without an id, whose class is null.
    Repeated rows share a class.
    """
    own = keyed(docs).where(~F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select("k", F.col("k").alias("label"))
    least = -(1 << 63)
    return (classes(docs, similarity).select("k", F.col("lead.k").alias("label")).unionByName(own)
            .select(*(F.when(F.col(c) != least, F.col(c)).alias(n) for c, n in (("k", "doc_id"), ("label", "class_id")))))


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the documents that have a class mate with a smaller id, and without repeated rows of one text
    and id. Documents without words all stay."""
    own = {"k": "gaugelake key", "t": "gaugelake text key"}
    held = (classes(docs, similarity).where("k = lead.k AND t = lead.t")
            .select(*(F.col(c).alias(name) for c, name in own.items())).distinct())
    base = docs.withColumns({own[c]: column for c, column in key_columns().items()})
    words = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    kept = base.where(words).join(held, list(own.values())).dropDuplicates(list(own.values())).select(docs.columns)
    return kept.unionByName(base.where(~words).select(docs.columns))
