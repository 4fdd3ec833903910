import random
from itertools import combinations

import numpy as np

from gaugelake.llm import near_dedup
from gaugelake.llm.components import components
from helpers import WORDS, awkward, frame, prose


def by_hand(rows):
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    grams = {i: near_dedup.labelled(t) for i, t in rows}
    for (a, _), (b, _) in combinations(rows, 2):
        if len(grams[a]) and len(grams[b]) and near_dedup.alike(grams[a], grams[b]):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {i: top(i) for i in parent}


def family(seed=3, groups=12):
    rng, texts = random.Random(seed), []
    for g in range(groups):
        base = prose(rng, 60 + 5 * g).split()
        texts.append(" ".join(base))
        for _ in range(4):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 8])):
                words[rng.randrange(len(words))] = "changed" + str(rng.randrange(99))
            texts.append("  ".join(words))
    return texts + awkward()


def test_classes_match_all_pairs(spark):
    texts = family()
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(frame(spark, texts)).collect()}
    assert got == by_hand(list(enumerate(texts)))


def test_pairs_that_a_third_text_does_not_join(spark):
    rng = random.Random(8)
    base = [f"{rng.choice(WORDS)}{rng.randrange(10**6)}" for _ in range(94)]
    texts = [" ".join(base)]
    for pair in range(150):  # each of a pair is alike to its fellow by 0.8, to the template and all others by under 0.7
        common = base[:10] + [f"w{pair}x{i}" for i in range(9)] + base[19:]
        for at in (45, 85):
            words = list(common)
            words[at] = f"own{pair}"
            texts.append(" ".join(words))
    want = by_hand(list(enumerate(texts)))
    assert len(set(want.values())) > 100 and sum(i != c for i, c in want.items()) > 100
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(frame(spark, texts)).collect()}
    assert got == want


def test_short_texts_match_all_pairs(spark):
    rng, texts = random.Random(12), []
    for n in range(1, 21):
        for _ in range(12):
            words = [rng.choice(WORDS) + str(rng.randrange(10**6)) for _ in range(n)]
            middle = list(words)
            middle[n // 2] = "changed"
            texts += [" ".join(w) for w in (words, [*words, "one"], ["other", *words], [*words, "two", "more"], [*words[:-1], "last"], middle)]
    texts += ["so it goes on and so it goes", "so it goes on and so it goes on"]
    want = by_hand(list(enumerate(texts)))
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(frame(spark, texts)).collect()}
    assert got == want and sum(want[i] != i for i in want) > 400


def test_one_of_each_keeps_the_least_id_and_texts_without_words(spark):
    texts = family()
    docs = frame(spark, texts + texts[:2], [*range(len(texts)), 0, 1])
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {i for i, c in by_hand(list(enumerate(texts))).items() if i == c}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(want)


def test_ids_repeated_with_other_texts_and_null_ids(spark):
    rng = random.Random(1)
    a, b, c = prose(rng, 40), prose(rng, 40), prose(rng, 40)
    docs = frame(spark, [a, b, c, a], [1, 1, None, 7])
    got = sorted(((r.doc_id, r.class_id) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (None, None), (7, 1)], key=str)
    assert near_dedup.one_of_each(docs).count() == 3
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_order_matters():
    rng = random.Random(5)
    a, b = prose(rng, 80), prose(rng, 80)
    assert not near_dedup.alike(near_dedup.labelled(a + " " + b), near_dedup.labelled(b + " " + a))
    assert near_dedup.alike(near_dedup.labelled(a), near_dedup.labelled(a))


def test_repeats_are_told_apart_by_their_number():
    grams = near_dedup.labelled(" ".join(["so it goes on and"] * 30))
    assert len(set(grams.tolist())) == len(grams)


def test_aligned_is_the_longest_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(40):
        a, b = (rng.permutation(30)[:rng.integers(5, 25)].astype(np.uint64) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert near_dedup.aligned(a, b, 99) == table[-1, -1]


def test_pairs_at_the_threshold_share_a_key():
    rng, missed = random.Random(9), 0
    for _ in range(200):
        words = [rng.choice(WORDS) + str(rng.randrange(10**6)) for _ in range(104)]
        other = list(words)
        other[10] = other[60] = "changed"  # ten of 100 grams differ, similarity 90 / 110 = 0.82
        a, b = (near_dedup.labelled(" ".join(w)) for w in (words, other))
        assert near_dedup.alike(a, b)
        missed += not (near_dedup.sketch(a) == near_dedup.sketch(b)).any()
    assert missed <= 1


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(20)] + [(50, 51), (7, 7)]
    got = {r.id: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 50: 50, 51: 50}
