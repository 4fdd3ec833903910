import random
from collections import Counter

import numpy as np
import pytest

from gaugelake.llm import recurring, substring_dedup, suffix_dedup
from gaugelake.llm.common import grams
from helpers import corpus, frame, prose


def passages_by_hand(rows, window):
    first = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        for at in range(len(words) - window + 1):
            first.setdefault(tuple(words[at:at + window]), i)
    out = []
    for i, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at:at + window])] < i:
                gone.update(range(at, at + window))
        out.append((i, len(words), len(gone), b" ".join(w for j, w in enumerate(words) if j not in gone).decode()))
    return sorted(out)


def repeats_by_hand(rows, window):
    count = Counter()
    for _, text in rows:
        data = (text or "").encode()
        count.update(data[at:at + window] for at in range(len(data) - window + 1))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = set()
        for at in range(len(data) - window + 1):
            if count[data[at:at + window]] > 1:
                gone.update(range(at, at + window))
        spans = sum(1 for j in gone if j - 1 not in gone)
        out.append((i, len(data), len(gone), spans, bytes(b for j, b in enumerate(data) if j not in gone)))
    return sorted(out)


@pytest.mark.parametrize("hot", [recurring.HOT_ANCHOR, 2])
def test_passages(spark, hot):
    texts = corpus()
    got = substring_dedup.remove_passages(frame(spark, texts), 8, 3, hot).collect()
    assert sorted(map(tuple, got)) == passages_by_hand(list(enumerate(texts)), 8)
    assert sum(r.n_removed for r in got) > 100


@pytest.mark.parametrize("hot", [recurring.HOT_ANCHOR, 2])
def test_byte_repeats(spark, hot):
    texts = corpus()
    got = suffix_dedup.remove_repeats(frame(spark, texts), 24, 8, hot).collect()
    assert sorted((*r[:4], bytes(r[4])) for r in got) == repeats_by_hand(list(enumerate(texts)), 24)
    assert sum(r.n_removed for r in got) > 1000


def test_repeated_rows_and_null_ids(spark):
    text = "one two three four five six seven eight nine ten"
    docs = frame(spark, [text, text, text, text + " eleven"], [5, 5, None, 9])
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_passages(docs, 4, 2).collect()}
    assert got == {(None, 10, 0), (5, 10, 10), (9, 11, 10)}  # a null id is the least
    got = [(r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(docs, 10, 4).collect()]
    assert sorted(got, key=str) == sorted([(5, len(text)), (5, len(text)), (None, len(text)), (9, len(text))], key=str)


def test_empty_tables(spark):
    docs = frame(spark, []).limit(0)
    assert substring_dedup.remove_passages(docs).count() == 0
    assert suffix_dedup.remove_repeats(docs).count() == 0


def test_anchor_of_equal_windows_is_the_same():
    rng = np.random.default_rng(3)
    for alphabet in (2, 50):
        codes = rng.integers(0, alphabet, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h, lo, size, off = recurring.anchor_runs(codes, 12, 5)
        assert size.sum() == 400 - 12 + 1 and (np.diff(lo) == size[:-1]).all()
        seen = {}
        for code, start, n, place in zip(h, lo, size, off):
            for i in range(n):
                window = tuple(codes[start + i:start + i + 12].tolist())
                assert seen.setdefault(window, (code, place - i)) == (code, place - i)


@pytest.mark.parametrize("chunk", [recurring.CHUNK, 64])
def test_windows_of_known_grams_go_to_their_anchor(monkeypatch, chunk):
    monkeypatch.setattr(recurring, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 30, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    gram = grams(codes, 5).view(np.int64)

    def owners(runs):
        return {start + i: (h, place + start) for h, start, n, place in zip(*(r.tolist() for r in runs)) for i in range(n)}

    every = owners(recurring.anchor_runs(codes, 12, 5))
    anchor_codes = sorted({h for h, _ in every.values()})
    known = set(anchor_codes[::2]) | set(rng.choice(gram, 40).tolist())
    at = np.array([i for i, h in enumerate(gram.tolist()) if h in known])
    got = owners(recurring.located_runs(at, gram[at], 400, 12, 5))
    assert all(got[start] == own for start, own in every.items() if own[0] in known)
    assert all(any(start <= i <= start + 7 for i in at) == (start in got) for start in range(389))
    assert not owners(recurring.located_runs(at[:0], gram[:0], 400, 12, 5))


def test_phrases_are_found_at_their_words():
    rng = np.random.default_rng(9)
    for distinct in (3, 40, 2000):  # spelt in one, two and three symbols
        words = [b"w%d" % i for i in rng.integers(0, distinct, 600)]
        machine = substring_dedup.Phrases(2)
        some = {b" ".join(words[i:i + 2]) for i in range(0, 500, 7)}
        for phrase in sorted(some):
            machine.add(phrase, hash(phrase), 3)
            machine.add(phrase, hash(phrase), 3)
        text = words[::-1] + [b"unseen"] + words
        at, codes, often = machine.occurrences(text)
        want = [(i, hash(b" ".join(text[i:i + 2]))) for i in range(len(text) - 1) if b" ".join(text[i:i + 2]) in some]
        assert list(zip(at.tolist(), codes.tolist())) == want and set(often) == {3}
    assert not len(substring_dedup.Phrases(2).occurrences([b"a", b"b"])[0])


def test_passages_over_many_shards(spark, monkeypatch):
    for name in ("SHARD_PHRASES", "SHARD_ANCHORS", "SHARD_TEXTS"):
        monkeypatch.setattr(substring_dedup, name, 3)
    texts = corpus(n=90) + [corpus()[0]] * 60
    got = substring_dedup.remove_passages(frame(spark, texts), 8, 3).collect()
    assert sorted(map(tuple, got)) == passages_by_hand(list(enumerate(texts)), 8)


def test_a_phrase_is_sent_to_a_shard_once(spark):
    line = "the same few words of one line again and again "
    docs = frame(spark, [line * 300, line * 280 + "end", line * 50 + "other end", prose(random.Random(1), 40)], [None, None, 3, 4])
    base = recurring.keyed(docs)
    wanted = recurring.recurrent(base, substring_dedup.word_tokens(8, 3), False, "test")[1]
    phrases = substring_dedup.phrases_of(base, wanted, 3).collect()
    assert len(phrases) == len({p.h for p in phrases}) == wanted.select("h").distinct().count() > 0
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_passages(docs, 8, 3).collect()}
    assert got == {(None, 3000, 0), (None, 2801, 0), (3, 502, 500), (4, 40, 0)}


def test_long_texts_go_in_chunks(monkeypatch):
    codes = np.random.default_rng(1).integers(0, 9, 500, dtype=np.uint64)
    whole = recurring.anchor_runs(codes, 10, 4)
    monkeypatch.setattr(recurring, "CHUNK", 64)
    parts = recurring.anchor_runs(codes, 10, 4)
    places = [set((f[1] + f[3]).tolist()) for f in (whole, parts)]
    assert places[0] == places[1] and parts[2].sum() == whole[2].sum()


def test_common_prefixes_over_gaps():
    values = np.array([5, 3, 9, 1, 7, 7, 2, 8], np.int16)
    first, last = np.array([0, 2, 4, 1, 7]), np.array([7, 2, 6, 5, 7])
    assert suffix_dedup.range_least(values, first, last).tolist() == [min(values[a:b + 1]) for a, b in zip(first, last)]
