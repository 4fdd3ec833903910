"""Packing of token pieces into fixed-length sequences by swap-based local search."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm import vocab
from gaugelake.llm.common import batch_of, keep, slices

CAPACITY = 4096
GROUP_TOKENS = 1 << 24
GROUP_PIECES = 200_000
END = 1
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


def token_bytes(texts: list[str | None], file: str) -> list[bytes]:
    """Ids of each text with the end id, as little-endian unsigned 32-bit bytes; null is an empty text."""
    end = np.array([END], "<u4").tobytes()
    return [ids + end for ids in vocab.word_ids(file).encode([t or "" for t in texts])]


def pieces(docs: DataFrame, file: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens; a document of up to ``capacity`` tokens is one piece.

    ``with_ids`` adds the ids themselves as an array. A null or empty text is one piece holding the end id.
    """
    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")
    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                       ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                rows = [[] for _ in arrow]
                docs_ids = part.column("doc_id").to_pylist()
                for doc, ids in zip(docs_ids, token_bytes(part.column("text").to_pylist(), file)):
                    view = memoryview(ids)
                    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = view[at:at + 4 * capacity]
                        for row, value in zip(rows, (doc, number, at // 4, len(own) // 4, zlib.crc32(own))):
                            row.append(value)
                        if with_ids:
                            rows[-1].append(np.frombuffer(own, "<u4").astype(np.int32))
                yield batch_of(arrow, *rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


class Bins:
    """Open bins with their members; members are positions in ``lengths``."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.members: list[list[int]] = []
        self.fill: list[int] = []
        self.place = np.empty(len(lengths), np.int64)

    def put(self, item: int, at: int) -> None:
        self.members[at].append(item)
        self.fill[at] += int(self.lengths[item])
        self.place[item] = at

    def take(self, item: int) -> None:
        at = self.place[item]
        self.members[at].remove(item)
        self.fill[at] -= int(self.lengths[item])

    def move(self, item: int, at: int) -> None:
        self.take(item)
        self.put(item, at)


def first_packing(lengths: np.ndarray, capacity: int) -> Bins:
    """Longest pieces first, each into the fullest bin it fits; a bit per remaining room finds that bin."""
    bins = Bins(lengths, capacity)
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            at, room = len(bins.fill), capacity
            bins.members.append([])
            bins.fill.append(0)
        bins.put(item, at)
        if room > size:
            by_room.setdefault(room - size, []).append(at)
            rooms |= 1 << (room - size)
    return bins


def local_search(bins: Bins) -> None:
    """Empty bins, the least filled first, by moves and exchanges that raise the sum of squared fills.

    For a donor bin, in this order: move a member into a bin with room; exchange one member against a
    smaller one of another bin; exchange two members against one smaller than their sum. Receivers are at
    least as full as the donor, so each step raises the sum of squares, and the search ends: after a pass
    over all open bins without a step, or at the lower bound ceil(tokens / capacity).
    """
    least = -(-int(bins.lengths.sum()) // bins.capacity)
    by_length = np.argsort(bins.lengths, kind="stable")
    fill = np.array(bins.fill, np.int64)
    stepped = True
    while stepped and (fill > 0).sum() > least:
        stepped = False
        open_bins = np.flatnonzero((fill > 0) & (fill < bins.capacity))
        for donor in open_bins[np.argsort(fill[open_bins], kind="stable")].tolist():
            while bins.members[donor] and step(bins, donor, by_length, fill):
                stepped = True


def step(bins: Bins, donor: int, by_length: np.ndarray, fill: np.ndarray) -> bool:
    """One move or exchange out of a bin; False if none raises the sum of squares. ``by_length``: pieces, shortest first;
    ``fill``: the fills, kept up to date."""
    room = bins.capacity - fill
    able = (room > 0) & (fill >= fill[donor])
    able[donor] = False
    if not able.any():
        return False
    alike: dict[int, list[int]] = {}  # members of one length are interchangeable
    for item in bins.members[donor]:
        alike.setdefault(int(bins.lengths[item]), []).append(item)
    own = sorted(alike, reverse=True)
    most = int(room[able].max())
    for length in own:
        if length <= most:
            fits = np.flatnonzero(able & (room >= length))
            to = int(fits[np.argmin(room[fits])])
            bins.move(alike[length][0], to)
            fill[[donor, to]] = bins.fill[donor], bins.fill[to]
            return True
    items = by_length[able[bins.place[by_length]]]
    size = bins.lengths[items]
    reach = np.maximum.accumulate(size + room[bins.place[items]])  # the first to reach a total is the shortest to give for it
    ones = np.array(own, np.int64)
    first, second = np.triu_indices(len(own))
    twice = np.array([len(alike[length]) > 1 for length in own])
    paired = (first != second) | twice[first]
    first, second = first[paired], second[paired]
    for total, given in ((ones, [ones]), (ones[first] + ones[second], [ones[first], ones[second]])):
        at = np.searchsorted(reach, total)
        good = np.flatnonzero((at < len(items)) & (size[np.minimum(at, len(items) - 1)] < total))
        if len(good):
            other = int(items[at[good[0]]])
            to = int(bins.place[other])
            bins.move(other, donor)
            for lengths in given:
                bins.move(alike[int(lengths[good[0]])].pop(), to)
            fill[[donor, to]] = bins.fill[donor], bins.fill[to]
            return True
    return False


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin number (0, 1, ...) and gapless offset of each length."""
    bins = first_packing(lengths, capacity)
    local_search(bins)
    numbers, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for number, members in enumerate(m for m in bins.members if m):
        at = 0
        for item in members:
            numbers[item], offsets[item] = number, at
            at += int(lengths[item])
    return numbers, offsets


def pack(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of pieces with ``doc_id``, ``piece`` and ``length``.

    Pieces are dealt by hash into groups of about GROUP_TOKENS tokens and GROUP_PIECES pieces, whatever
    their number, and each group is packed by itself: at most one open bin a group is lost against one
    packing of all. Only lengths and keys move, no ids.
    """
    total = table.agg(F.sum("length").alias("tokens"), F.count("*").alias("pieces")).first()
    groups = max(1, math.ceil((total.tokens or 0) / GROUP_TOKENS), math.ceil(total.pieces / GROUP_PIECES))
    names = table.columns

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        numbers, offsets = pack_lengths(rows.column("length").to_numpy().astype(np.int64), capacity)
        group = rows.column("pack_group").to_numpy().astype(np.int64)
        return (rows.select(names).append_column("sequence_id", pa.array((group << 32) + numbers))
                .append_column("offset", pa.array(offsets)))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    return (table.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
            .groupBy("pack_group").applyInArrow(run, fields + ", sequence_id long, offset long"))


def pack_documents(docs: DataFrame, file: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack documents. Nulls and empty texts are one end id each; repeated rows are packed
    once per row; an empty table gives no rows; other columns are ignored."""
    return pack(keep(pieces(docs, file, capacity), "pieces"), capacity)
