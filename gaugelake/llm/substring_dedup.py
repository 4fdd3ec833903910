"""Removal of passages that an earlier document has, located by sharded phrase automata."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm import recurring
from gaugelake.llm.common import batch_of, grams, keep, merged, per_slice, slices, tidy, word_codes, words_of
from gaugelake.llm.recurring import cut

WINDOW = 50
PHRASE = 16
SHARD_PHRASES = 8_000  # a shard has about so many phrases, anchors of its texts, or texts, whichever makes more shards
SHARD_ANCHORS = 40_000
SHARD_TEXTS = 4_000
ALPHABET = "0123456789abcdefghijklmnopqrstuv"
PHRASES = pa.schema([("h", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def word_tokens(window: int = WINDOW, phrase: int = PHRASE) -> recurring.Tokens:
    return recurring.Tokens(window, phrase, words_of, word_codes, b" ".join)


class Phrases:
    """An automaton over phrases of ``length`` words each. Words are spelt in symbols of a small alphabet, all of one width,
    so that an automaton's node has few branches and a match's place in symbols is its place in words."""

    def __init__(self, length: int):
        self.length, self.words, self.known, self.machine = length, {}, {}, None

    def add(self, phrase: bytes, h: int, n: int) -> None:
        if phrase not in self.known:
            self.known[phrase] = (h, n)
            for word in phrase.split(b" "):
                self.words.setdefault(word, len(self.words) + 1)

    def compile(self) -> None:
        width = 1
        while len(ALPHABET) ** width <= len(self.words):
            width += 1
        spelt = Spelling({word: "".join(ALPHABET[number // len(ALPHABET) ** place % len(ALPHABET)] for place in range(width))
                          for word, number in self.words.items()})
        spelt.unknown = ALPHABET[0] * width  # in no phrase
        self.width, self.words, self.machine = width, spelt, ahocorasick.Automaton()
        for phrase, value in self.known.items():
            self.machine.add_word("".join(map(spelt.__getitem__, phrase.split(b" "))), value)
        self.known = {}
        if len(self.machine):
            self.machine.make_automaton()

    def occurrences(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """First word, code and number of occurrences in the corpus of each phrase in a whole text."""
        if self.machine is None:
            self.compile()
        ends, values = [], []
        if len(self.machine):
            for end, value in self.machine.iter("".join(map(self.words.__getitem__, words))):
                if (end + 1) % self.width == 0:
                    ends.append((end + 1) // self.width)
                    values.append(value)
        at = np.array(ends, np.int64) - self.length
        return at, np.array([h for h, _ in values], np.int64), [n for _, n in values]


class Spelling(dict):
    def __missing__(self, word: bytes) -> str:
        return self.unknown


def phrases_of(base: DataFrame, wanted: DataFrame, phrase: int) -> DataFrame:
    """``h``, ``n`` and ``body``: the words of each recurring phrase, from the first document that has it."""
    own = (wanted.where("k = least").groupBy("k", "t")
           .agg(F.collect_list(F.struct("h", "n", (F.col("lo") + F.col("off")).alias("at"))).alias("a")))

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [[] for _ in PHRASES]
        for text, places in zip(part.column("text").to_pylist(), part.column("a").to_pylist()):
            words = words_of(text)
            for h, (at, n) in {p["h"]: (p["at"], p["n"]) for p in places}.items():
                for row, value in zip(rows, (h, n, b" ".join(words[at:at + phrase]))):
                    row.append(value)
        return batch_of(PHRASES, *rows)

    # one row each, also where several texts have the least id, or a text has a phrase many times
    return (own.join(base, ["k", "t"]).select("text", "a").mapInArrow(per_slice(run), "h long, n long, body binary")
            .groupBy("h").agg(F.max("n").alias("n"), F.min("body").alias("body")))


def located(base: DataFrame, tokens: recurring.Tokens, hot: int, purpose: str) -> DataFrame:
    """Segments around all occurrences of recurring phrases in the distinct texts.

    Phrases that recur are read from the first text that has them and sent to the shards whose texts may hold them. Each shard compiles
    its phrases into one automaton and streams its whole texts through it; places come from the matches alone. The number of
    shards grows with phrases, texts and anchors, so that an automaton and its texts stay small. Phrases come first in a
    shard's rows, then texts one by one; a hot phrase is sent and compiled once a shard.
    """
    found, wanted = recurring.recurrent(base, tokens, False, purpose)
    wanted = keep(wanted, f"{purpose}-wanted")
    count = max(wanted.count() // SHARD_PHRASES, found.count() // SHARD_ANCHORS, base.count() // SHARD_TEXTS) + 1
    shard = F.pmod(F.xxhash64("k", "t"), F.lit(count)).alias("shard")
    nothing = F.lit(None).cast("long")
    firsts = found.select("k", "t").distinct().select(
        shard, F.lit(0).alias("step"), "k", "t", nothing.alias("h"), nothing.alias("n"), F.lit(None).cast("binary").alias("body"))
    routed = wanted.select("h", shard).distinct().join(phrases_of(base, wanted, tokens.k), "h").select(
        "shard", F.lit(1).alias("step"), nothing.alias("k"), nothing.alias("t"), "h", "n", "body")
    texts = base.where(F.length("text") >= 2 * tokens.window - 1).select(  # shorter ones have fewer words than a window
        shard, F.lit(2).alias("step"), "k", "t", nothing.alias("h"), nothing.alias("n"), F.col("text").cast("binary").alias("body"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, machine, waiting = None, None, set()
        for batch in batches:
            for part in slices(batch, "body"):
                rows = [[] for _ in recurring.SEGMENTS]
                for own, step, k, t, h, n, body in zip(*(part.column(c).to_pylist() for c in part.schema.names)):
                    if own != here:
                        here, machine, waiting = own, Phrases(tokens.k), set()
                    if step == 0:
                        waiting.add((k, t))
                    elif step == 1:
                        machine.add(body, h, n)
                    elif (k, t) in waiting:  # the first of a text's copies, once
                        waiting.remove((k, t))
                        words = body.split()
                        at, codes, often = machine.occurrences(words)
                        runs = recurring.located_runs(at, codes, len(words), tokens.window, tokens.k)
                        numbers = dict(zip(codes.tolist(), often))
                        cut(rows, tokens, hot, k, t, words, ((*r, numbers[r[0]]) for r in zip(*(c.tolist() for c in runs))))
                yield batch_of(recurring.SEGMENTS, *rows)

    return (firsts.unionByName(routed).unionByName(texts).repartition("shard").sortWithinPartitions("shard", "step")
            .mapInArrow(run, recurring.sql(recurring.SEGMENTS)))


def resolver(window: int):
    def resolve(table: pa.Table):
        """Windows that start in a document with a smaller id, as ranges of words."""
        size = table.column("size").to_numpy().astype(np.int64)
        data = table.column("data").to_pylist()
        keys = np.concatenate([grams(word_codes(d.split(b" ")), window)[:n] for d, n in zip(data, size)])
        row = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        doc = table.column("k").to_numpy()[row]
        distinct, inverse = np.unique(keys, return_inverse=True)
        first = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(first, inverse, doc)
        later = doc > first[inverse]
        flags = np.zeros((table.num_rows, int(size.max())), bool)
        flags[row[later], at[later]] = True
        found, start, end = recurring.runs_of(flags)
        lo = table.column("lo").to_numpy()[found]
        return found, lo + start, lo + end + window - 1
    return resolve


def hot_windows(window: int):
    def hot(rows: DataFrame) -> DataFrame:
        first = rows.groupBy("w1", "w2").agg(F.min("k").alias("first"))
        return (rows.join(first, ["w1", "w2"]).where("k > first")
                .select("k", "t", "lo", (F.col("lo") + window).alias("hi")))
    return hot


def remove_passages(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, hot: int = recurring.HOT_ANCHOR,
                    carry: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (left words joined by one blank) per document; with
    ``carry`` also ``text`` and ``row``, a struct of the other columns.

    A word goes if a window of ``window`` words over it also starts in a document with a smaller id. A text equal
    to one with a smaller id loses all words if it has a window at all. Repeats inside one document, and between
    rows with one id, stay. Null and empty texts have no words; a null id counts as the least.
    """
    joined = recurring.written(docs, lambda base: located(base, word_tokens(window, phrase), hot, "passages"),
                               resolver(window), hot_windows(window), "passages", carry)
    least = -(1 << 63)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [[] for _ in OUT]
        for k, text, first, own in zip(*(part.column(c).to_pylist() for c in ("k", "text", "first", "r"))):
            words = words_of(text)
            n = len(words)
            if first is not None and first < k and n >= window:
                words = []
            elif own:
                spans = np.array([(r["lo"], r["hi"]) for r in own if r], np.int64).reshape(-1, 2)
                kept, at = [], 0
                for lo, hi in zip(*(x.tolist() for x in merged(spans[:, 0], spans[:, 1]))):
                    kept += words[at:lo]
                    at = hi
                words = kept + words[at:]
            for row, value in zip(rows, (None if k == least else k, n, n - len(words), b" ".join(words).decode())):
                row.append(value)
        out = batch_of(OUT, *rows)
        for name in ("text", "row") if carry else ():
            out = out.append_column(part.schema.field(name), part.column(name))
        return out

    fields = "doc_id long, n_words long, n_removed long, kept string"
    if carry:
        fields += f", text string, row {joined.schema['row'].dataType.simpleString()}"
    return joined.mapInArrow(per_slice(run), fields)
