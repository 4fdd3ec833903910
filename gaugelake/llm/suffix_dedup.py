"""Removal of byte strings that occur elsewhere, by a column-wise transform of many strings at once.

Segments of one anchor are laid under each other with their anchors aligned. Each round adds one symbol per
segment, from the last column to the first: a stable sort by the new symbol turns the order of the suffixes at the
column after it into the order at this one (the Burrows-Wheeler transform of the collection, read column by column),
and the common prefix of neighbours grows by one or is cut. A window recurs where a neighbour shares its whole length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm import recurring
from gaugelake.llm.common import batch_of, merged, mix, per_slice

WINDOW = 200
ANCHOR = 32
PAD = 256
OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                 ("kept", pa.binary())])
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_codes(data: bytes) -> np.ndarray:
    return BYTE_CODES[np.frombuffer(data, np.uint8)]


def byte_tokens(window: int = WINDOW, anchor: int = ANCHOR) -> recurring.Tokens:
    return recurring.Tokens(window, anchor, lambda t: (t or "").encode(), byte_codes, bytes)


def aligned(table: pa.Table, window: int, anchor: int) -> np.ndarray:
    """Segments as columns of symbols, one row per column, anchors at column window - anchor; PAD around them."""
    data = table.column("data").to_pylist()
    length = np.array([len(d) for d in data])
    start = window - anchor - table.column("off").to_numpy().astype(np.int64)
    width = int((start + length).max())
    symbols = np.full((width, len(data)), PAD, np.uint16)
    row = np.repeat(np.arange(len(data)), length)
    column = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)
    symbols[column, row] = np.frombuffer(b"".join(data), np.uint8)
    return symbols


def range_least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least of values[first..last] for each pair, from the minima of runs of powers of two."""
    span = last - first + 1
    level = np.frexp(span.astype(np.float64))[1] - 1
    out = values[first]
    table, size = values, 1
    for step in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == step)
        if len(at):
            out[at] = np.minimum(table[first[at]], table[last[at] - size + 1])
        if 2 * size <= len(values):
            table = np.minimum(table[:-size], table[size:])
            size *= 2
    return out


def recurring_windows(symbols: np.ndarray, window: int, starts: int) -> np.ndarray:
    """Rows x first ``starts`` columns: True where the ``window`` symbols from there occur in another row too."""
    width, rows = symbols.shape
    order = np.arange(rows)
    common = np.zeros(rows, np.int16)  # common[i]: prefix shared by the suffixes at places i - 1 and i
    flags = np.zeros((starts, rows), bool)
    for column in range(width - 1, -1, -1):
        own = symbols[column][order]
        place = np.argsort(own, kind="stable")
        own = own[place]
        same = np.flatnonzero((own[1:] == own[:-1]) & (own[1:] != PAD)) + 1
        grown = np.zeros(rows, np.int16)
        before, here = place[same - 1], place[same]
        grown[same] = np.minimum(common[here], window - 1) + 1
        gap = np.flatnonzero(here - before > 1)
        if len(gap):
            grown[same[gap]] = np.minimum(range_least(common, before[gap] + 1, here[gap]), window - 1) + 1
        order, common = order[place], grown
        if column < starts:
            full = np.flatnonzero(common >= window)
            flags[column, order[full]] = True
            flags[column, order[full - 1]] = True
    return flags.T


def resolver(window: int, anchor: int):
    def resolve(table: pa.Table):
        starts = window - anchor + 1
        flags = recurring_windows(aligned(table, window, anchor), window, starts)
        row, first, end = recurring.runs_of(flags)
        shift = table.column("lo").to_numpy().astype(np.int64) - (window - anchor - table.column("off").to_numpy())
        return row, first + shift[row], end - 1 + window + shift[row]
    return resolve


def hot_windows(window: int):
    def hot(rows: DataFrame) -> DataFrame:
        often = rows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        return rows.join(often, ["w1", "w2"]).select("k", "t", "lo", (F.col("lo") + window).alias("hi"))
    return hot


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = recurring.HOT_ANCHOR) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` bytes per document.

    Every byte under a ``window``-byte string that also starts elsewhere goes, in all its places. A text that
    several rows have goes whole if it is long enough. Null and empty texts have no bytes; kept bytes may end
    inside a character.
    """
    joined = recurring.written(docs, lambda base: recurring.segments(base, byte_tokens(window, anchor), hot, "repeats"),
                               resolver(window, anchor), hot_windows(window), "repeats")
    least = -(1 << 63)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [[] for _ in OUT]
        for k, text, first, own in zip(*(part.column(c).to_pylist() for c in ("k", "text", "first", "r"))):
            data = (text or "").encode()
            kept, n_spans = data, 0
            if first is not None and len(data) >= window:
                kept, n_spans = b"", 1
            elif own:
                spans = np.array([(r["lo"], r["hi"]) for r in own if r], np.int64).reshape(-1, 2)
                left, at = [], 0
                for lo, hi in zip(*(x.tolist() for x in merged(spans[:, 0], spans[:, 1]))):
                    left.append(data[at:lo])
                    at = hi
                    n_spans += 1
                kept = b"".join(left) + data[at:]
            for row, value in zip(rows, (None if k == least else k, len(data), len(data) - len(kept), n_spans, kept)):
                row.append(value)
        return batch_of(OUT, *rows)

    return (joined
            .mapInArrow(per_slice(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))
