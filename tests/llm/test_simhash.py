import random
import re

import numpy as np
import pytest
import xxhash

from gaugelake.llm import simhash as H
from gaugelake.llm.queries import QUERIES
from helpers import awkward, corpus, frame, prose


def plain(text):
    """Fingerprint by the contract's words."""
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    codes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def by_hand(rows):
    marks = [plain(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(marks[i] ^ marks[j]).count("1") <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    return sorted(((i, f"{m:016x}", least[g]) for (i, _), m, g in zip(rows, marks, group)), key=repr)


def near_texts(rng, n):
    """Long texts and ones with few changed words: neighbours at small distances."""
    out = []
    for _ in range(n):
        base = prose(rng, 400)
        out.append(base)
        for changes in (1, 1, 2, 6):
            words = base.split()
            for _ in range(changes):
                words[rng.randrange(len(words))] = "other"
            out.append(" ".join(words))
    return out


def test_query_against_all_pairs(spark, tmp_path):
    rng = random.Random(2)
    texts = [*corpus(), *near_texts(rng, 12), "One TWO three", "one two THREE", "One two", "É two three", "é two three", " ".join(["so"] * 5000)]
    ids = [*range(len(texts) - 2), None, 3]
    frame(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_vantage_point"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    want = by_hand(list(zip(ids, texts)))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert sum(i is not None and c != i for i, _, c in want) > 20


@pytest.mark.parametrize("text", [*awkward(), "A b  C\x0bd", "a\xa0b c d", "x y z " * 30])
def test_fingerprint(text):
    assert H.fingerprint(text) == plain(text)


def cloud(rng, n):
    """Fingerprints with families: bits flipped one after the other, and lone ones."""
    out = set()
    while len(out) < n:
        f = rng.getrandbits(64)
        out.add(f)
        for _ in range(rng.choice([0, 0, 0, 40])):
            f ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            out.add(f)
    return np.array(sorted(out), np.uint64)


def groups_of(points, pairs):
    parent = H.roots(np.arange(len(points)), *pairs)
    return parent


def all_pairs(points, radius=2):
    return np.nonzero(H.distance(points[:, None], points[None, :]) <= radius)


@pytest.mark.parametrize("seed,radius", [(1, 2), (2, 2), (3, 0), (4, 5)])
def test_tree_finds_all_pairs(seed, radius):
    points = cloud(random.Random(seed), 700)
    found = {(int(q), int(p)) for qs, ps in H.Tree(points, leaf=3).near(points, radius) for q, p in zip(qs, ps)}
    assert found == set(zip(*map(lambda a: a.tolist(), all_pairs(points, radius))))


@pytest.mark.parametrize("shards", [1, 2, 5, 40])
def test_every_pair_meets_in_one_shard(shards):
    points = cloud(random.Random(shards), 1500)
    ring = H.Shards(points[::5], shards, 2)
    place, shard, guest = ring.deal(points)
    assert sorted(place[~guest]) == list(range(len(points)))  # each lives in one shard
    met = set()
    for s in range(ring.count):
        own, visits = place[(shard == s) & ~guest], place[(shard == s) & guest]
        assert not set(own) & set(visits)
        q, p = np.nonzero(H.distance(points[np.r_[own, visits]][:, None], points[own][None, :]) <= 2)
        met |= {frozenset(x) for x in zip(np.r_[own, visits][q].tolist(), own[p].tolist())}
    assert met == {frozenset(x) for x in zip(*map(lambda a: a.tolist(), all_pairs(points)))}


def test_links_over_many_shards_join_what_all_pairs_join(spark, monkeypatch):
    monkeypatch.setattr(H, "GUESTS", 0.2)
    points = cloud(random.Random(8), 3000)
    table = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "f long")
    found = H.links(table, shard=200).collect()
    where = {int(p): i for i, p in enumerate(points.view(np.int64))}
    a, b = (np.array([where[r[c]] for r in found], np.int64) for c in ("a", "b"))
    assert (groups_of(points, (a, b)) == groups_of(points, all_pairs(points))).all()
    assert len(found) < 4 * len(points)


def test_a_family_does_not_tell_its_pairs():
    rng = random.Random(1)
    family = np.array(sorted({sum(1 << b for b in rng.sample(range(64), 1)) ^ (1 << rng.randrange(64)) for _ in range(4000)}), np.uint64)
    a, b = H.linked(family, np.empty(0, np.uint64), True, 2)
    assert len(a) < len(family) and len(set(b.tolist())) == 1


def test_hot_fingerprints(spark, tmp_path):
    texts = ["the same text"] * 300 + [f"text number {i} of many others {i * 7}" for i in range(200)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_vantage_point"](spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == by_hand(list(enumerate(texts)))


def test_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op12_vantage_point"](spark, str(tmp_path)).collect() == []
