"""Helpers the operators share: written intermediate tables, Arrow slices, word codes."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from gaugelake.session import workspace

SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Give this package to the Python workers once per application."""
    context = spark.sparkContext
    if not any(f.endswith("gaugelake-package.zip") for f in context.listFiles):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="gaugelake-ship-"), "gaugelake-package.zip")
        with zipfile.ZipFile(path, "w") as bundle:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        bundle.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(path)
    return spark


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table in the shared folder and read it again, which cuts its lineage."""
    path = workspace(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about SLICE_BYTES of text each; a single longer row is a part of its own."""
    sizes = np.array([0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()],
                     dtype=np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size + 64
    if start < len(sizes):
        yield batch.slice(start)


def forget() -> None:
    """Empty what a Python worker remembers between tasks: workers are used again by later stages, whose memory it is."""
    CODES.clear()
    pa.default_memory_pool().release_unused()
    if hasattr(LIBC, "malloc_trim"):
        LIBC.malloc_trim(0)


def tidy(run):
    """A mapInArrow function that forgets at the end of its task."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            forget()
    return wrapped


def per_slice(fn: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text"):
    """A mapInArrow function that applies ``fn`` to slices."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                yield fn(part)
    return run


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema)


class WordCodes(dict):
    """Word (bytes) to 64-bit code, remembered up to a bound."""

    BOUND = 1 << 18

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.BOUND:
            self.clear()
        self[word] = code
        return code


CODES = WordCodes()
LIBC = ctypes.CDLL(None)


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(CODES.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8; bytes.split() parts at exactly those six characters."""
    return text.encode().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(codes: np.ndarray, k: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Codes of all runs of ``k`` consecutive elements, by doubling: log2(k) passes."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    done, length, power = None, 0, codes.astype(np.uint64)  # power: runs of 2**i from each start
    scale, size, rest = pow(base, 1, 1 << 64), 1, k
    while rest:
        if rest & 1:
            if done is None:
                done, length = power, size
            else:  # done covers `length` elements from each start; append the next `size`
                m = min(len(done), len(power) - length)
                done = done[:m] * np.uint64(scale) + power[length:length + m]
                length += size
        rest >>= 1
        if rest:
            power = power[:-size] * np.uint64(scale) + power[size:]
            scale, size = scale * scale % (1 << 64), size * 2
    return mix(done[:n])


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges as maximal disjoint ranges; touching ranges join."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.r_[True, starts[1:] > ends[:-1]]
    return starts[first], ends[np.r_[np.flatnonzero(first)[1:] - 1, len(ends) - 1]]
