"""Quality rules on how well public vocabularies cover a text."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm import vocab
from gaugelake.llm.common import batch_of, grams, per_slice, word_codes

SPACES = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("script", pa.string()), ("n_tokens", pa.int64()),
    ("chars_per_token", pa.float64()), ("byte_share", pa.float64()), ("token_entropy", pa.float64())])
MEASURES_SQL = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                "script string, n_tokens long, chars_per_token double, byte_share double, token_entropy double")

# Rejection bands by script: characters per token (least, most), largest share of byte-fallback tokens, and least
# token entropy as a share of the most that many tokens of the text could have. Scripts that the vocabulary spells
# out in bytes or single characters get wider bands; "other" holds for scripts without a row.
BANDS = {
    "latin": (1.6, 8.0, 0.10, 0.55),
    "cyrillic": (1.2, 6.0, 0.15, 0.50),
    "greek": (0.7, 5.0, 0.40, 0.45),
    "cjk": (0.3, 3.0, 0.80, 0.40),
    "none": (0.6, 8.0, 0.30, 0.45),
    "other": (0.2, 5.0, 0.95, 0.35),
}
MOST_SYMBOLS = 0.10  # of the characters in words; text made of marks has no fertility to speak of
SCRIPTS = (("LATIN", "latin"), ("CYRILLIC", "cyrillic"), ("GREEK", "greek"), ("CJK", "cjk"), ("HIRAGANA", "cjk"),
           ("KATAKANA", "cjk"), ("HANGUL", "cjk"))
NOT_ASCII = re.compile(r"[^\x00-\x7f]")


def script_of(text: str) -> str:
    """The script of most letters: ``latin``, ``cyrillic``, ``greek``, ``cjk``, ``other``, or ``none`` without letters."""
    rest = NOT_ASCII.findall(text)
    counts = {"latin": sum(map(text.count, set(filter(str.isalpha, set(text) - set(rest)))))}
    for char in set(rest):
        if char.isalpha():
            name = unicodedata.name(char, "")
            script = next((s for prefix, s in SCRIPTS if name.startswith(prefix)), "other")
            counts[script] = counts.get(script, 0) + text.count(char)
    best = max(sorted(counts), key=counts.get)
    return best if counts[best] else "none"


def base(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    duplicates = 0
    if "\n" in text:
        seen = set()
        for line in text.split("\n"):
            if line in seen:
                duplicates += 1
            elif line.strip(SPACES):
                seen.add(line)
    repeated = 0
    windows = grams(word_codes(words), WINDOW)
    if len(windows) > 1:
        order = np.argsort(windows)
        same = windows[order][1:] == windows[order][:-1]
        if same.any():
            twice = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, twice, 1)
            np.add.at(edge, twice + WINDOW, -1)
            repeated = int((np.cumsum(edge)[:-1] > 0).sum())
    return chars, symbols, duplicates, repeated


def measure(docs: DataFrame, file: str) -> DataFrame:
    """Counts and token measures per document. A null or text without words has zeros and script ``none``."""
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        table = vocab.chunk_ids(file)
        texts = [t or "" for t in part.column("text").to_pylist()]
        rows = []
        for doc, text, encoded in zip(part.column("doc_id").to_pylist(), texts, table.encode(texts)):
            words = text.encode().split()
            chars, symbols, duplicates, repeated = base(text, words)
            ids = np.frombuffer(encoded, "<i4")
            tokens = len(ids)
            if tokens:
                counts = np.unique(ids, return_counts=True)[1]
                share = counts / tokens
                entropy = float(-(share * np.log2(share)).sum())
                bytes_share = float(table.is_byte[ids[ids != table.newline]].sum()) / tokens
            else:
                entropy = bytes_share = 0.0
            rows.append((doc, len(words), chars, symbols, duplicates, repeated, script_of(text), tokens,
                         len(text) / tokens if tokens else 0.0, bytes_share, entropy))
        return batch_of(MEASURES, *(zip(*rows) if rows else [[] for _ in MEASURES]))

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(per_slice(run), MEASURES_SQL))


def judge(measures: DataFrame, bands: dict = BANDS) -> DataFrame:
    """Add ``base_failed`` and ``kept``. Failing the base rules, or leaving the script's band on any measure, rejects."""
    def band(at: int) -> F.Column:
        pick = F.lit(float(bands["other"][at]))
        for script, limits in bands.items():
            pick = F.when(F.col("script") == script, F.lit(float(limits[at]))).otherwise(pick)
        return pick

    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    most = F.log2(F.least(F.col("n_tokens").cast("double"), F.lit(1024.0)))
    inside = (F.col("chars_per_token").between(band(0), band(1)) & (F.col("byte_share") <= band(2))
              & (F.col("token_entropy") >= band(3) * most)
              & (F.col("n_symbols") <= MOST_SYMBOLS * F.col("word_chars")))
    return measures.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(inside, F.lit(False)))


def rules(docs: DataFrame, file: str, bands: dict = BANDS) -> DataFrame:
    return judge(measure(docs, file), bands)
