"""Language identification with hyperdimensional trigram profiles.

Each letter has a random vector of +1 and -1. A trigram binds its letters: the product of the first
letter's vector shifted by two, the second's shifted by one and the third's. A text bundles its
trigrams by adding; a language's prototype bundles all its texts. Prediction is the nearest prototype
by cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm.common import batch_of, forget, slices

DIM = 1024
SEED = 20240611
UNKNOWN = "und"
MOST_LANGUAGES = 8192  # more than all ISO 639-3 codes in use; bounds what the driver holds
TRIGRAMS_KEPT = 16_384
LETTERS_KEPT = 4_096


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class Space:
    """Letter and trigram vectors, made on demand from the code points and remembered up to a bound."""

    def __init__(self, dim: int = DIM, seed: int = SEED):
        self.dim, self.seed = dim, seed
        self.letters: dict[int, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((TRIGRAMS_KEPT, self.dim), np.int8)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            if len(self.letters) >= LETTERS_KEPT:
                self.letters.clear()
            bits = np.random.Generator(np.random.Philox(key=[self.seed, point])).integers(0, 2, self.dim)
            self.letters[point] = (2 * bits - 1).astype(np.int8)
        return self.letters[point]

    def trigram(self, code: int) -> np.ndarray:
        a, b, c = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def matrix(self, codes: np.ndarray) -> np.ndarray:
        """Vectors of distinct trigrams, one row each."""
        if len(codes) > TRIGRAMS_KEPT:
            return np.stack([self.trigram(c) for c in codes.tolist()]).astype(np.float32)
        fresh = [c for c in codes.tolist() if c not in self.rows]
        if len(self.rows) + len(fresh) > TRIGRAMS_KEPT:
            self.clear()
            fresh = codes.tolist()
        for code in fresh:
            self.vectors[len(self.rows)] = self.trigram(code)
            self.rows[code] = len(self.rows)
        return self.vectors[[self.rows[c] for c in codes.tolist()]].astype(np.float32)


@contextmanager
def space(dim: int, seed: int):
    """The vectors of one task, gone at its end."""
    yield Space(dim, seed)
    forget()


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes and the number of the text each comes from. Letters are lower-cased, every run of other
    characters is one blank (code point 32), and a blank stands before and after a text."""
    joined = "\n".join(t.lower() if t else "" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    own = [len(t.lower()) + 1 if t else 1 for t in texts]
    doc = np.repeat(np.arange(len(texts)), own)[:len(points)]
    points = np.concatenate([[10], points, [10]])
    doc = np.concatenate([[0], doc, [len(texts) - 1]])
    letters = letter_table()[points]
    points = np.where(letters, points, 32)
    held = np.r_[True, letters[1:] | letters[:-1]]
    points, doc, letters = points[held], doc[held], letters[held]
    if len(points) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]
    inside = letters[1:-1]  # the middle is a letter, so the trigram belongs to one text
    return codes[inside], doc[1:-1][inside]


def bundles(texts: list[str | None], hyper: Space) -> tuple[np.ndarray, np.ndarray]:
    """The bundled vector of each text, one row each, zero for a text without letters; and the number of its letters,
    each of which is the middle of one trigram."""
    codes, doc = trigrams(texts)
    letters = np.bincount(doc, minlength=len(texts)).astype(np.int64)
    if not len(codes):
        return np.zeros((len(texts), hyper.dim), np.float32), letters
    parts = [codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF]
    seen = np.zeros(0x110000, bool)
    for p in parts:
        seen[p] = True
    alphabet = np.flatnonzero(seen)
    if len(alphabet) <= 128:  # count in a table over the alphabet actually met
        small = np.zeros(0x110000, np.int64)
        small[alphabet] = np.arange(len(alphabet))
        a = len(alphabet)
        dense = (small[parts[0]] * a + small[parts[1]]) * a + small[parts[2]]
        met = np.flatnonzero(np.bincount(dense, minlength=1))
        back = np.empty(a ** 3, np.int64)
        back[met] = np.arange(len(met))
        column = back[dense]
        distinct = (alphabet[met // (a * a)] << 42) | (alphabet[met // a % a] << 21) | alphabet[met % a]
    else:
        distinct, column = np.unique(codes, return_inverse=True)
    counts = np.bincount(doc * len(distinct) + column, minlength=len(texts) * len(distinct))
    return counts.reshape(len(texts), -1).astype(np.float32) @ hyper.matrix(distinct), letters


def parts_of(batch: pa.RecordBatch):
    """Slices of at most 64 rows, which keeps the table of counts small."""
    for part in slices(batch):
        for at in range(0, part.num_rows, 64):
            yield part.slice(at, 64)


def prototypes(labelled: DataFrame, dim: int = DIM, seed: int = SEED) -> DataFrame:
    """``lang`` and ``vector``: the bundle of all texts of each language. Each task adds up its own texts; the
    task sums are added up by Spark, one (language, dimension) at a time."""
    arrow = pa.schema([("lang", pa.string()), ("vector", pa.list_(pa.float64()))])

    def run(batches):
        sums = {}
        with space(dim, seed) as hyper:
            for batch in batches:
                for part in parts_of(batch):
                    own, _ = bundles(part.column("text").to_pylist(), hyper)
                    langs = np.array(part.column("lang").to_pylist(), object)
                    for lang in set(langs):
                        total = sums.setdefault(lang, np.zeros(dim))
                        total += own[langs == lang].sum(axis=0, dtype=np.float64)
        if sums:
            yield batch_of(arrow, list(sums), [v for v in sums.values()])

    sums = (labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
            .select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "lang string, vector array<double>"))
    return (sums.select("lang", F.posexplode("vector").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v"))
            .select("lang", F.col("v.x").alias("vector")))


def verdict(profiles: DataFrame, dim: int = DIM, seed: int = SEED):
    """A column function: text to a struct of ``lang_pred``, ``score`` (cosine, 0 to 1) and ``letters``.

    ``und`` and 0 for a text that is null, empty or without letters, and for all where there are no
    profiles. Equal cosines go to the first language by name. Only texts go to Python, and only verdicts come back.
    The profiles, one vector a language, are collected; more than MOST_LANGUAGES is an error.
    """
    rows = profiles.orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    names = np.array([r.lang for r in rows] or [UNKNOWN], object)
    vectors = np.array([r.vector for r in rows] or [[0.0] * dim])
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0).astype(np.float32)
    known = bool(rows)

    @F.arrow_udf("lang_pred string, score double, letters long")
    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with space(dim, seed) as hyper:
            for array in texts:
                out = [(pa.array([], pa.string()), pa.array([], pa.float64()), pa.array([], pa.int64()))]
                for part in parts_of(pa.RecordBatch.from_arrays([array], names=["text"])):
                    own, letters = bundles(part.column("text").to_pylist(), hyper)
                    size = np.linalg.norm(own, axis=1)
                    near = own @ unit.T
                    best = near.argmax(axis=1)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        score = np.clip(np.nan_to_num(near[np.arange(len(best)), best] / size), 0, 1).astype(np.float64)
                    found = (size > 0) & known
                    out.append((pa.array(np.where(found, names[best], UNKNOWN).tolist(), pa.string()),
                                pa.array(np.where(found, score, 0.0)), pa.array(letters)))
                yield pa.StructArray.from_arrays([pa.concat_arrays(c) for c in zip(*out)], names=["lang_pred", "score", "letters"])

    return judge


def predict(docs: DataFrame, profiles: DataFrame, dim: int = DIM, seed: int = SEED) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of :func:`verdict` added; columns of these names are replaced."""
    held = [c for c in docs.columns if c not in ("lang_pred", "score")]
    judged = docs.select(*held, verdict(profiles, dim, seed)(F.col("text").cast("string")).alias("gaugelake verdict"))
    return judged.select(*held, F.col("`gaugelake verdict`.lang_pred").alias("lang_pred"), F.col("`gaugelake verdict`.score").alias("score"))


def held_out() -> F.Column:
    """True where crc32 of the id as text leaves 2 on division by 4; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, dim: int = DIM, seed: int = SEED) -> DataFrame:
    """Learn from the documents that are not held out, predict all of them: one row per row, repeated rows alike. Null,
    empty and letterless texts are ``und``; very long texts are taken whole; other columns are ignored."""
    profiles = prototypes(docs.where(~held_out()).select("lang", "text"), dim, seed)
    return predict(docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text")),
                   profiles, dim, seed).drop("text")
