"""Passages of W tokens that occur more than once: anchors, cut segments, removed ranges.

Of the k-token grams in each window of W tokens, the one with the least code (the first on a tie) is the
window's anchor. Equal windows have equal anchors at equal distance, so a window can only recur where its
anchor does. Anchors are some 2 / (W - k + 2) of the positions; only segments around anchors that recur
are cut out and compared. Copies of a text are one text from the first join on: only the one with the least id has anchors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm.common import batch_of, grams, keep, slices, tidy

CHUNK = 1 << 22  # windows looked at together; the low 24 bits of a key hold the position
LOW = np.uint64((1 << 24) - 1)
HOT_ANCHOR = 20_000  # the windows of anchors with more occurrences meet by a shuffle of their codes, not in one task's block
BLOCK_ROWS = 20_000

ANCHORS = pa.schema([("k", pa.int64()), ("t", pa.int64()), ("h", pa.int64()), ("lo", pa.int32()), ("size", pa.int32()),
                     ("off", pa.int32()), ("twice", pa.bool_())])
SEGMENTS = pa.schema([("k", pa.int64()), ("t", pa.int64()), ("h", pa.int64()), ("lo", pa.int32()), ("size", pa.int32()),
                      ("off", pa.int32()), ("data", pa.binary()), ("w1", pa.int64()), ("w2", pa.int64())])
RANGES = pa.schema([("k", pa.int64()), ("t", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])


def sql(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` consecutive values, from running minima of blocks of ``w`` from both sides."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - w + 1], left[w - 1:n])


def least_runs(keys: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of keys with the position in their low bits: the position of the least of each ``reach`` consecutive ones, the first
    start that has it, and the number of starts in a row that have it."""
    place = (sliding_min(keys, reach) & LOW).astype(np.int64)
    first = np.r_[0, np.flatnonzero(place[1:] != place[:-1]) + 1]
    return place[first], first, np.diff(np.r_[first, len(place)])


def anchor_runs(codes: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """Anchor code, first window start, number of consecutive windows, and anchor place after that start."""
    out = [[], [], [], []]
    for start in range(0, len(codes) - window + 1, CHUNK):
        gram = grams(codes[start:start + CHUNK + window - 1], k)
        place, first, size = least_runs((gram & ~LOW) | np.arange(len(gram), dtype=np.uint64), window - k + 1)
        for column, values in zip(out, (gram[place].view(np.int64), first + start, size, place - first)):
            column.append(values)
    return tuple(np.concatenate(c) if c else np.empty(0, np.int64) for c in out)


def located_runs(at: np.ndarray, h: np.ndarray, n: int, window: int, k: int) -> tuple[np.ndarray, ...]:
    """``anchor_runs`` of a text of ``n`` tokens of whose grams only those with code ``h`` at the places ``at`` (rising) are
    known: each window goes to the known gram of least code in it, windows without any are left out. Where a window's anchor
    is known it is that gram, since no gram of the window has a lesser code."""
    out = [[], [], [], []]
    for start in range(0, n - window + 1, CHUNK):
        keys = np.full(min(CHUNK, n - window + 1 - start) + window - k, np.iinfo(np.uint64).max, np.uint64)
        here = slice(*np.searchsorted(at, (start, start + len(keys))))
        own = at[here] - start
        keys[own] = (h[here].view(np.uint64) & ~LOW) | own.astype(np.uint64)
        place, first, size = (c.copy() for c in least_runs(keys, window - k + 1))
        known = place != int(LOW)
        place, first, size = place[known], first[known], size[known]
        for column, values in zip(out, (h[here][np.searchsorted(own, place)], first + start, size, place - first)):
            column.append(values)
    return tuple(np.concatenate(c) if c else np.empty(0, np.int64) for c in out)


class Tokens:
    """How a text becomes tokens: ``codes`` for hashing, ``cut`` for the bytes of a run of tokens."""

    def __init__(self, window: int, k: int, split: Callable[[str | None], object], codes: Callable, cut: Callable):
        self.window, self.k, self.split, self.codes, self.cut = window, k, split, codes, cut


def key_columns() -> dict[str, F.Column]:
    """``k``: doc_id, null as the least number. ``t``: 60 bits of the text's MD5, null as empty."""
    return {"k": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))),
            "t": F.conv(F.substring(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")}


def keyed(docs: DataFrame, carry: bool = False) -> DataFrame:
    """The key columns and ``text`` (null as empty); with ``carry`` also ``row``, the other columns."""
    rest = [F.struct(*(F.col(c) for c in docs.columns if c != "text")).alias("row")] if carry else []
    return docs.select(*(e.alias(n) for n, e in key_columns().items()),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *rest)


def anchors(base: DataFrame, tokens: Tokens) -> DataFrame:
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows, columns = [], [[], [], [], []]
                for text in part.column("text").to_pylist():
                    found = anchor_runs(tokens.codes(tokens.split(text)), tokens.window, tokens.k)
                    rows.append(len(found[0]))
                    for column, values in zip(columns, found):
                        column.append(values)
                at = np.repeat(np.arange(len(rows)), rows)
                if not len(at):
                    continue
                h, lo, size, off = (np.concatenate(c) for c in columns)
                order = np.lexsort((h, at))  # the same anchor twice in one text
                same = (h[order][1:] == h[order][:-1]) & (at[order][1:] == at[order][:-1])
                twice = np.zeros(len(h), bool)
                twice[order[1:][same]] = twice[order[:-1][same]] = True
                yield batch_of(ANCHORS, pa.array(part.column("k").to_numpy()[at]), pa.array(part.column("t").to_numpy()[at]),
                               pa.array(h), pa.array(lo.astype(np.int32)), pa.array(size.astype(np.int32)),
                               pa.array(off.astype(np.int32)), pa.array(twice))

    return base.mapInArrow(run, sql(ANCHORS))


def window_keys(tokens: Tokens, piece, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit codes of each window of a segment."""
    codes = tokens.codes(piece)
    return (grams(codes, tokens.window)[:size].view(np.int64),
            grams(codes, tokens.window, 0xD1342543DE82EF95)[:size].view(np.int64))


def recurrent(base: DataFrame, tokens: Tokens, within: bool, purpose: str) -> tuple[DataFrame, DataFrame]:
    """All anchors of the distinct texts (each by its copy with the least id), and those of them that recur, with ``n``, the
    anchor's number of occurrences, and ``least``, the least id that has it.

    An anchor recurs if two distinct texts have it or, with ``within``, one text has it twice.
    """
    firsts = base.groupBy("t").agg(F.min("k").alias("k"))
    found = keep(anchors(base, tokens).join(firsts, ["k", "t"]).dropDuplicates(["k", "t", "lo"]), f"{purpose}-anchors")
    again = F.min("t") != F.max("t")
    repeated = found.groupBy("h").agg(
        (again | F.max("twice") if within else again).alias("again"), F.count("*").alias("n"), F.min("k").alias("least"))
    return found, found.drop("twice").join(repeated.where("again").drop("again"), "h")


def cut(rows: list[list], tokens: Tokens, hot: int, k: int, t: int, split, own: Iterator[tuple]) -> None:
    """Append the segments around the anchors ``own`` (h, lo, size, off, n) of a text to the columns ``rows``: the tokens of
    all windows of each, or, for an anchor with more than ``hot`` occurrences, one row per window with its codes."""
    for h, lo, size, off, n in own:
        piece = split[lo:lo + size + tokens.window - 1]
        if n > hot:
            for i, (w1, w2) in enumerate(zip(*window_keys(tokens, piece, size))):
                for row, value in zip(rows, (k, t, h, lo + i, 1, 0, None, w1, w2)):
                    row.append(value)
        else:
            for row, value in zip(rows, (k, t, h, lo, size, off, tokens.cut(piece), None, None)):
                row.append(value)


def segments(base: DataFrame, tokens: Tokens, hot: int, purpose: str) -> DataFrame:
    """One row per recurring anchor of each distinct text: the tokens of all its windows, or a row per window where hot.
    Here also anchors that recur in one text count."""
    wanted = (recurrent(base, tokens, True, purpose)[1].groupBy("k", "t")
              .agg(F.collect_list(F.struct("h", "lo", "size", "off", "n")).alias("a")))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [[] for _ in SEGMENTS]
                for k, t, text, own in zip(*(part.column(c).to_pylist() for c in ("k", "t", "text", "a"))):
                    cut(rows, tokens, hot, k, t, tokens.split(text), (tuple(a.values()) for a in own))
                yield batch_of(SEGMENTS, *rows)

    # repeated rows of one text are one here
    return (wanted.join(base, ["k", "t"]).dropDuplicates(["k", "t"]).select("k", "t", "text", "a")
            .mapInArrow(run, sql(SEGMENTS)))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by ``h`` in tables of about BLOCK_ROWS rows that never part an ``h``."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            table = pa.Table.from_batches(held)
            h = table.column("h").to_numpy()
            cut = int(np.flatnonzero(h != h[-1])[-1]) + 1 if h[0] != h[-1] else 0
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).to_batches()
                rows = table.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def ranges(parts: DataFrame, resolve: Callable[[pa.Table], tuple[np.ndarray, ...]], hot_windows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Removed token ranges ``k, t, lo, hi`` of the segments: in blocks of whole anchors, and window by window where hot."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            row, lo, hi = resolve(table)
            if len(row):
                yield batch_of(RANGES, pa.array(table.column("k").to_numpy()[row]), pa.array(table.column("t").to_numpy()[row]),
                               pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)))

    cold = (parts.where("data IS NOT NULL").drop("w1", "w2").repartition("h").sortWithinPartitions("h")
            .mapInArrow(run, sql(RANGES)))
    return cold.unionByName(hot_windows(parts.where("data IS NULL")))


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and past-last column of each maximal run of True in a matrix."""
    padded = np.zeros((flags.shape[0], flags.shape[1] + 2), np.int8)
    padded[:, 1:-1] = flags
    step = np.diff(padded, axis=1)
    row, first = np.nonzero(step == 1)
    return row, first, np.nonzero(step == -1)[1]


def marks(base: DataFrame, removed: DataFrame) -> DataFrame:
    """Per document that has any: whether copies of its text exist, the least id among them, and its ranges."""
    groups = base.groupBy("t").agg(F.min("k").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = base.select("k", "t").join(groups, "t").select("k", "t", "first", F.lit(None).cast("struct<lo:int,hi:int>").alias("r"))
    own = removed.select("k", "t", F.lit(None).cast("long").alias("first"), F.struct("lo", "hi").alias("r"))
    return (copies.unionByName(own).groupBy("k", "t")
            .agg(F.min("first").alias("first"), F.collect_list("r").alias("r")))


def written(docs: DataFrame, cut_out: Callable[[DataFrame], DataFrame], resolve, hot_windows, purpose: str,
            carry: bool = False) -> DataFrame:
    """``docs`` keyed, with the marks of each; segments and marks are written aside in between."""
    base = keyed(docs)
    parts = keep(cut_out(base), f"{purpose}-segments")
    found = keep(marks(base, ranges(parts, resolve, hot_windows)), f"{purpose}-ranges")
    return keyed(docs, carry).join(found, ["k", "t"], "left").drop("t")
