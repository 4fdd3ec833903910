"""Training-order files: every sequence gets a global slot by a keyed permutation and lies at that slot's place.

A shard is one file of fixed-stride records: ``length`` token ids of two bytes each (little-endian) and two zero bytes.
Slot s lies in shard s // per_shard at byte (s % per_shard) * stride, so any range of slots is one sequential read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugelake.llm import vocab
from gaugelake.llm.common import batch_of, keep, mix, slices
from gaugelake.llm.packing import token_bytes

LENGTH = 1024
PER_SHARD = 8192
MOST_SHARDS = 65_536  # beyond, shards grow instead
ROUNDS = 6
KEY = 20240611
RECORD_END = "\u0000\u0000"

SEQUENCES = pa.schema([
    ("ids", pa.binary()), ("n_tokens", pa.int32()), ("ids_crc32", pa.int64()),
    ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32())])))])
SEQUENCES_SQL = "ids binary, n_tokens int, ids_crc32 long, docs array<struct<doc_id:long,start:long,length:int>>"


def sequences(docs: DataFrame, file: str, length: int = LENGTH) -> DataFrame:
    """One row a sequence: documents of a task laid end to end, each with its end id, and cut into sequences of ``length`` tokens; the last
    of a task is filled up with zeros. ``docs`` tells which tokens of which documents a sequence holds. Nulls and empty
    texts are one end id, very long ones fill many sequences, repeated rows are laid each time, and an empty table has no
    sequences. Other columns are ignored."""
    def run(batches):
        held, filled, owners = [], 0, []
        if vocab.word_ids(file).tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary does not fit two bytes")
        for batch in batches:
            for part in slices(batch):
                rows = [[] for _ in SEQUENCES]

                def close(held, filled, owners):
                    ids = b"".join(held)
                    for row, value in zip(rows, (ids + bytes(2 * length - len(ids)), filled, zlib.crc32(ids), owners)):
                        row.append(value)

                for doc, encoded in zip(part.column("doc_id").to_pylist(), token_bytes(part.column("text").to_pylist(), file)):
                    own, at = np.frombuffer(encoded, "<u4").astype("<u2").tobytes(), 0
                    total = len(own) // 2
                    while at < total:
                        take = min(length - filled, total - at)
                        held.append(own[2 * at:2 * (at + take)])
                        owners.append({"doc_id": doc, "start": at, "length": take})
                        filled += take
                        at += take
                        if filled == length:
                            close(held, filled, owners)
                            held, filled, owners = [], 0, []
                yield batch_of(SEQUENCES, *rows)
        if filled:
            ids = b"".join(held)
            yield batch_of(SEQUENCES, [ids + bytes(2 * length - len(ids))], [filled], [zlib.crc32(ids)], [owners])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, SEQUENCES_SQL))


def permuted(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """A keyed permutation of 0 .. n-1: a Feistel network over the next power of four, walked on from values
    outside until they fall inside."""
    half = max(1, math.ceil(max(1, n - 1).bit_length() / 2))
    low = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    keys = mix(np.arange(key, key + ROUNDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & low
        for round_key in keys:
            left, right = right, left ^ (mix(right + round_key) & low)
        return (left << shift) | right

    out = once(index.astype(np.uint64))
    outside = np.flatnonzero(out >= np.uint64(n))
    while len(outside):
        out[outside] = once(out[outside])
        outside = outside[out[outside] >= np.uint64(n)]
    return out.astype(np.int64)


MOST_FILES = 200_000  # whose counts, some 100 bytes each, are broadcast; with more the planner decides


def numbered(written: DataFrame) -> DataFrame:
    """A written table with ``index`` (0, 1, ... without gaps): rows before the file, by name, plus the row in the file."""
    rows = written.withColumns({"file": F.col("_metadata.file_name"), "row": F.col("_metadata.row_index")})
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = (rows.groupBy("file").agg(F.count("*").alias("n"))  # one row a file
             .select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    if len(written.inputFiles()) <= MOST_FILES:
        files = F.broadcast(files)  # so that the sequences do not move for this
    return rows.join(files, "file").withColumn("index", F.col("before") + F.col("row")).drop("file", "row", "before")


def materialise(written: DataFrame, folder: str, length: int = LENGTH, key: int = KEY, per_shard: int = PER_SHARD) -> DataFrame:
    """Write the sequences of a written table as shards under ``folder``; returns ``slot``, ``shard``, ``byte_offset``,
    ``n_tokens``, ``ids_crc32`` and ``docs`` of each. Shard i is the file ``part-<i>-``; ``layout/`` holds the numbers that
    :func:`read_slots` needs. An empty table gives no rows. More sequences than MOST_SHARDS shards of ``per_shard`` hold
    make larger shards. Up to MOST_FILES written files their counts are broadcast; the rows are the same either way."""
    total = written.count()
    per_shard = max(per_shard, math.ceil(total / MOST_SHARDS))
    shards = max(1, math.ceil(total / per_shard))
    moved = pa.schema([("slot", pa.int64()), ("shard", pa.int32()), ("ids", pa.binary())])
    placed = pa.schema([("ids", pa.binary())])

    def deal(batches):
        squeeze = zstandard.ZstdCompressor(level=2).compress  # the ids move at two thirds of their size
        for batch in batches:
            slot = permuted(batch.column("index").to_numpy(), total, key)
            yield batch_of(moved, pa.array(slot), pa.array((slot // per_shard).astype(np.int32)),
                           [squeeze(d) for d in batch.column("ids").to_pylist()])

    def place(batches):
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            yield batch_of(placed, [expand(d) for d in batch.column("ids").to_pylist()])

    @F.pandas_udf("long")
    def slot(index: pd.Series) -> pd.Series:
        return pd.Series(permuted(index.to_numpy(), total, key))

    rows = numbered(written)
    # slots are dense, so the ranges are known: partition i takes the slots of shard i, and nothing is sampled
    (rows.select("index", "ids").mapInArrow(deal, "slot long, shard int, ids binary")
     .repartitionById(shards, "shard").sortWithinPartitions("slot").select("ids")
     .mapInArrow(place, "ids binary").select(F.col("ids").cast("string").alias("value"))
     .write.option("lineSep", RECORD_END).text(folder))
    spark, stride = written.sparkSession, 2 * length + 2
    spark.range(1).select(F.lit(length).alias("length"), F.lit(per_shard).alias("per_shard"), F.lit(total).alias("total")).write.json(f"{folder}/layout")
    return rows.withColumn("slot", slot("index")).select(
        "slot", F.floor(F.col("slot") / per_shard).cast("int").alias("shard"),
        ((F.col("slot") % per_shard) * stride).alias("byte_offset"), "n_tokens", "ids_crc32", "docs")


def read_slots(spark, folder: str, first: int, last: int) -> DataFrame:
    """``slot`` and ``ids`` of the slots from ``first`` to before ``last``, from the shards that hold them; slots beyond the
    last are left out."""
    layout = spark.read.schema("length int, per_shard long, total long").json(f"{folder}/layout").first()
    length, per_shard, stride = layout.length, layout.per_shard, 2 * layout.length + 2
    first, last = max(first, 0), min(last, layout.total)
    if first >= last:
        return spark.createDataFrame([], "slot long, ids array<int>")
    files = (spark.read.format("binaryFile")
             .load([f"{folder}/part-{s:05d}-*" for s in range(first // per_shard, (last - 1) // per_shard + 1)])
             .select(F.regexp_extract(F.substring_index("path", "/", -1), "part-([0-9]+)-", 1).cast("int").alias("shard"), "content"))
    schema = pa.schema([("slot", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("content").to_pylist()):
                table = np.frombuffer(data, "<u2").reshape(-1, stride // 2)[:, :length].astype(np.int32)
                slot = shard * per_shard + np.arange(len(table))
                held = (slot >= first) & (slot < last)
                yield batch_of(schema, slot[held], list(table[held]))

    return files.mapInArrow(run, "slot long, ids array<int>")


def in_training_order(docs: DataFrame, file: str, folder: str, length: int = LENGTH, key: int = KEY,
                      per_shard: int = PER_SHARD) -> DataFrame:
    """:func:`sequences` of ``docs``, written under ``folder`` in a keyed random order; see :func:`materialise`."""
    return materialise(keep(sequences(docs, file, length), "training-sequences"), folder, length, key, per_shard)
