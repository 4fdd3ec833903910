import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugelake.llm import packing, pieces, training_order, vocab
from gaugelake.llm.queries import PIECE_VOCABULARY, WORD_VOCABULARY
from helpers import corpus, frame

WORD, PIECE = vocab.path(WORD_VOCABULARY), vocab.path(PIECE_VOCABULARY)
ODD = ["  a  b ", "a ", " ", "<|endoftext|> hi", "It's we'll 's 12a3", "ΣΑΣ. ﬁ", "▁a▁▁ b", "日本語 テスト", "éa ́b", "🙂👍🏽",
       "İb", "  x y", "aᵃ. ªº", "</w> <0x0A> <s>", "don't!!! \"x\""]


def word_ids(texts):
    return [np.frombuffer(e, "<u4").tolist() for e in vocab.word_ids(WORD).encode(texts)]


def piece_ids(texts):
    return [np.frombuffer(e, "<i4").tolist() for e in vocab.chunk_ids(PIECE).encode(texts)]


def check(texts):
    library = vocab.word_ids(WORD).tokenizer
    assert word_ids(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert piece_ids(texts) == vocab.chunk_ids(PIECE).model.encode(texts)


def test_ids_are_the_libraries_own(monkeypatch):
    texts = ODD + [t for t in corpus() if t]
    check(texts)
    monkeypatch.setattr(vocab.WordIds, "WORDS", 20)
    monkeypatch.setattr(vocab.WordIds, "UNITS", 10)
    monkeypatch.setattr(vocab.ChunkIds, "BOUND", 20)
    for _ in range(2):
        for t in texts:
            check([t])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_ids_of_any_text(texts):
    check(texts)


def test_encode_and_decode(spark):
    texts = corpus() + ODD
    model = vocab.chunk_ids(PIECE).model
    for r in pieces.encode(frame(spark, texts), PIECE).collect():
        ids = model.encode(texts[r.doc_id] or "")
        assert r.ids == ids and r.decoded == model.decode(ids)
    assert pieces.encode(frame(spark, []).limit(0), PIECE).count() == 0


def test_packing(spark):
    texts = corpus() + [None, "x " * 500, "x " * 500]
    docs = frame(spark, texts, [*range(len(texts) - 1), len(texts) - 2])  # a repeated row
    capacity = 64
    rows = packing.pack_documents(docs, WORD, capacity).collect()
    library = vocab.word_ids(WORD).tokenizer
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [1]
        own = ids[r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes()) and r.start == r.piece * capacity
        assert r.length == min(capacity, len(ids) - r.start)
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r.piece)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // capacity) + 1
    assert set(by_doc) == set(range(len(texts) - 1))
    assert packing.pack_documents(docs.limit(0), WORD).count() == 0


def test_local_search_empties_a_bin():
    lengths = np.array([6, 5, 4, 3, 2])
    bins = packing.Bins(lengths, 10)
    for item, at in enumerate([0, 1, 1, 0, 2]):  # 9, 9 and 2: three bins where two do
        if at == len(bins.fill):
            bins.members.append([])
            bins.fill.append(0)
        bins.put(item, at)
    squares = sum(f * f for f in bins.fill)
    packing.local_search(bins)
    assert sorted(f for f in bins.fill if f) == [10, 10] and sum(f * f for f in bins.fill) > squares


@pytest.mark.parametrize("low, high, n, capacity", [(1000, 1701, 2000, 4096), (20, 60, 1500, 4096)])
def test_no_bin_has_a_step_left(low, high, n, capacity):
    lengths = np.random.default_rng(1).integers(low, high, n)
    numbers, _ = packing.pack_lengths(lengths, capacity)
    fill = np.bincount(numbers, lengths).astype(int)
    if len(fill) == -(-lengths.sum() // capacity):
        return
    room = capacity - fill
    for donor in np.flatnonzero(room > 0):
        other = lengths[(fill >= fill[donor])[numbers] & (numbers != donor) & (room > 0)[numbers]]
        free = room[numbers][(fill >= fill[donor])[numbers] & (numbers != donor) & (room > 0)[numbers]]
        own = lengths[numbers == donor]
        totals = {*own.tolist(), *(int(a + b) for i, a in enumerate(own) for b in own[i + 1:])}
        assert not any(((other < t) & (t - other <= free)).any() for t in totals)
        assert not any((free >= size).any() for size in own)


def test_no_piece_is_lost_by_the_search():
    rng = np.random.default_rng(4)
    for _ in range(20):
        lengths = rng.integers(1, 40, rng.integers(1, 200))
        numbers, offsets = packing.pack_lengths(lengths, 64)
        fill = np.bincount(numbers, lengths)
        assert fill.max() <= 64 and (fill > 0).all() and len(offsets) == len(lengths)
        assert len(fill) <= -(-lengths.sum() // 64) + 1


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation(n):
    slots = training_order.permuted(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    if n > 100:
        assert (slots != np.arange(n)).mean() > 0.9
        assert (training_order.permuted(np.arange(n), n, key=1) != slots).any()


def test_training_files(spark, tmp_path):
    texts = corpus() + [None, "x " * 500]
    folder = f"{tmp_path}/shards"
    rows = training_order.in_training_order(frame(spark, texts), WORD, folder, length=32, per_shard=7).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    read = {r.slot: r.ids for r in training_order.read_slots(spark, folder, 0, len(rows) + 5).collect()}
    library = vocab.word_ids(WORD).tokenizer
    seen = defaultdict(dict)
    for r in rows:
        assert (r.shard, r.byte_offset) == (r.slot // 7, r.slot % 7 * 66)
        at = 0
        for own in r.docs:
            for i, token in enumerate(read[r.slot][at:at + own.length]):
                seen[own.doc_id][own.start + i] = token
            at += own.length
        assert at == r.n_tokens and not any(read[r.slot][at:])
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert [seen[i][j] for j in range(len(ids))] == ids
    part = training_order.read_slots(spark, folder, 5, 9).collect()  # resumes anywhere
    assert {r.slot: r.ids for r in part} == {s: read[s] for s in range(5, 9)}
    assert training_order.in_training_order(frame(spark, []).limit(0), WORD, folder + "0").count() == 0


def test_units_are_parted_by_word_ends_without_offsets():
    table = vocab.WordIds(WORD)
    units = ["a", "the", "supercalifragilistic", "xqzj", "s", "t", "ll", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"]
    assert table.by_word_ends(units) == [table.whole(u) for u in units] == table.by_offsets(units)
    words = [*units, "The", "xqzj,", "é", "é!", "क़", "İb", "'s"]
    table.learn(words, set(words))
    assert [table.words[w] for w in words] == [table.whole(w) for w in words]
