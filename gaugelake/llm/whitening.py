"""Embedding whitening from exact integer moments.

Each dimension's integers are shifted to start at zero and cut into bit planes; a plane packs its bits of 64 rows into a
word. The cross-product of two dimensions is the sum over their planes p and q of 2^(p+q) times the number of bits that
are set in both, so AND and popcount give it exactly, without a multiplication per row. Tasks add up their own rows, Spark
adds up the tasks, and the driver gets one table of sums whose size is the square of the dimension. Covariances are
centred as integers of any length and only then become floats for ``eigh``.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm.common import keep

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
MOST_DIM = 8192  # bounds the table of sums that the driver holds
ROWS = 16_384  # rows of which planes are packed at a time; at 64 dimensions of 12 bits these are 1.5 MB
RANK = 1e-12  # an eigenvalue of at most this share of the largest is noise of a dependent direction


def integers(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id`` and ``x`` = floor(scale * c) + shift. Rows whose vector is null or holds a null or non-finite entry take
    no part; rows without an id do. Other columns are left out."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.where(F.col("embedding").isNotNull() & finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long") + shift).alias("x")))


def matrix(batch: pa.RecordBatch, column: str = "x") -> tuple[np.ndarray, np.ndarray]:
    """Flat values and lengths of a list column."""
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)


def by_length(batch: pa.RecordBatch):
    """(length, rows, values) for every length of vectors in a batch; empty vectors have no components."""
    flat, lengths = matrix(batch)
    starts = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dim)
        yield dim, rows, flat[starts[rows][:, None] + np.arange(dim)]


def column_sums(values: np.ndarray) -> list[int]:
    wide = max(abs(int(values.min())), abs(int(values.max()))) * len(values) >= 1 << 62
    return [int(v) for v in (values.astype(object) if wide else values).sum(axis=0)]


def ranges(vectors: DataFrame) -> dict[int, tuple[int, list[int], list[int], list[int]]]:
    """By length of vector: rows, and per dimension least and greatest value and sum. Tasks reduce their own rows."""
    arrow = pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()),
                       ("s", pa.decimal128(38, 0))])

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for dim, rows, x in by_length(batch):
                own = [len(rows), x.min(axis=0), x.max(axis=0), column_sums(x)]
                if dim in held:
                    n, lo, hi, s = held[dim]
                    own = [n + own[0], np.minimum(lo, own[1]), np.maximum(hi, own[2]), [a + b for a, b in zip(s, own[3])]]
                held[dim] = own
        for dim, (n, lo, hi, s) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                ([dim] * dim, range(dim), [n] * dim, lo, hi, s), arrow)], schema=arrow)

    found = (vectors.select("x").mapInArrow(run, "dim int, i int, n long, lo long, hi long, s decimal(38,0)").groupBy("dim", "i")
             .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("s").alias("s"))
             .limit(4 * MOST_DIM + 1).collect())
    if any(r.dim > MOST_DIM for r in found) or len(found) > 4 * MOST_DIM:
        raise ValueError(f"vectors of over {MOST_DIM} dimensions, or of too many lengths")
    out: dict[int, tuple] = {}
    for r in sorted(found, key=lambda r: (r.dim, r.i)):
        own = out.setdefault(r.dim, (r.n, [], [], []))
        for values, v in zip(own[1:], (r.lo, r.hi, r.s)):
            values.append(int(v))
    return out


def packed(values: np.ndarray, bits: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the columns of non-negative ``values``, 64 rows a word; dimension and weight exponent of each."""
    rows, dim = values.shape
    own = np.repeat(np.arange(dim), bits)
    exponent = np.concatenate([np.arange(b) for b in bits]) if len(own) else np.empty(0, np.int64)
    planes = np.zeros((len(own), -(-rows // 64) * 8), np.uint8)
    at = 0
    for column, b in enumerate(bits):
        if b:
            set_bits = (values[:, column][None, :] >> np.arange(b, dtype=values.dtype)[:, None]) & 1
            planes[at:at + b, :-(-rows // 8)] = np.packbits(set_bits.astype(np.uint8), axis=1)
            at += b
    return planes.view(np.uint64), own, exponent


def cross_products(values: np.ndarray, bits: list[int]) -> list[list[int]]:
    """Exact sums over rows of products of two columns, upper triangle (row i holds columns i and up). Exponents add up to
    126 at most, so counts are gathered by exponent first and weighted as integers of any length."""
    dim = len(bits)
    planes, own, exponent = packed(values, bits)
    out = [[0] * (dim - i) for i in range(dim)]
    edges = np.r_[0, np.cumsum(bits)].astype(np.int64)
    filled = np.flatnonzero(np.array(bits))
    small = max(bits, default=0) <= 22 and len(values) < 1 << 18  # weighted counts then fit 64 bits
    for i in filled.tolist():
        start = edges[i]
        total = np.zeros(dim, np.int64) if small else np.zeros(dim, object)
        for p in range(bits[i]):
            counts = np.bitwise_count(planes[start:] & planes[start + p]).sum(axis=1, dtype=np.int64)
            weighted = counts << (exponent[start:] + p) if small else (
                counts.astype(object) * np.array([1 << int(e) + p for e in exponent[start:]], object))
            total[filled[filled >= i]] += np.add.reduceat(weighted, (edges[filled[filled >= i]] - start))
        out[i] = [int(v) for v in total[i:]]
    return out


def sums_of_products(vectors: DataFrame, spans: dict[int, tuple]) -> dict[int, list[list[int]]]:
    """By length: sums over all rows of products of shifted columns (value minus the column's least), upper triangle."""
    lows = {dim: np.array(lo, np.int64) for dim, (_, lo, _, _) in spans.items()}
    bits = {dim: [(h - l).bit_length() for l, h in zip(lo, hi)] for dim, (_, lo, hi, _) in spans.items()}
    arrow = pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("s", pa.decimal128(38, 0))])

    def run(batches):
        held: dict[int, list[np.ndarray]] = {}
        totals: dict[int, list[list[int]]] = {}

        def add(dim: int) -> None:
            values = np.concatenate(held.pop(dim))
            for at in range(0, len(values), ROWS):
                own = cross_products(values[at:at + ROWS], bits[dim])
                if dim in totals:
                    totals[dim] = [[a + b for a, b in zip(x, y)] for x, y in zip(totals[dim], own)]
                else:
                    totals[dim] = own

        for batch in batches:
            for dim, _, values in by_length(batch):
                held.setdefault(dim, []).append((values - lows[dim]).astype(np.uint64))
                if sum(map(len, held[dim])) >= ROWS:
                    add(dim)
        for dim in list(held):
            add(dim)
        for dim, table in totals.items():
            for i, row in enumerate(table):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                    ([dim] * len(row), [i] * len(row), range(i, dim), row), arrow)], schema=arrow)

    found = (vectors.select("x").mapInArrow(run, "dim int, i int, j int, s decimal(38,0)")
             .groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).toLocalIterator())
    out = {dim: [[0] * (dim - i) for i in range(dim)] for dim in spans}
    for r in found:
        out[r.dim][r.i][r.j - r.i] = int(r.s)
    return out


def covariance(n: int, low: list[int], sums: list[int], products: list[list[int]]) -> tuple[np.ndarray, float]:
    """Covariance, divisor n, and its trace. n * products - sums * sums is centred and exact; a shift changes nothing."""
    dim = len(sums)
    shifted = [s - n * l for s, l in zip(sums, low)]
    v = np.zeros((dim, dim))
    trace = 0
    for i in range(dim):
        for j in range(i, dim):
            c = n * products[i][j - i] - shifted[i] * shifted[j]
            v[i, j] = v[j, i] = c / (n * n)  # integers divide to the nearest float
            trace += c if i == j else 0
    return v, float(Fraction(trace, n * n))


class Fit:
    """Mean and components of the vectors of one length."""

    def __init__(self, n: int, low: list[int], high: list[int], sums: list[int], products: list[list[int]], components: int):
        self.n, self.sums = n, sums
        v, self.trace = covariance(n, low, sums, products)
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > RANK * max(values[-1], 0)]
        self.values, self.vectors = values[order], vectors[:, order]
        widest = max(max(abs(n * l - s), abs(n * h - s)) for l, h, s in zip(low, high, sums))
        self.small = widest < 1 << 62 and widest * widest * len(sums) < 1 << 62 and n * max(map(abs, [*low, *high])) < 1 << 62

    def of(self, x: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Deviations (exact) and whitened rows."""
        if self.small:
            centred = self.n * x - np.array(self.sums, np.int64)
            deviation = (centred * centred).sum(axis=1).tolist()
        else:
            centred = self.n * x.astype(object) - np.array(self.sums, object)
            deviation = [sum(c * c for c in row) for row in centred]
        plain = (centred / self.n).astype(np.float64)
        return deviation, plain @ self.vectors / np.sqrt(self.values)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row a vector of :func:`integers`: ``vec_id``, ``n``, ``deviation`` (decimal, exact), ``whitened`` and ``explained``
    (arrays by component), and ``identity_error``.

    Vectors of each length are a fit list of their own. Directions without variance (eigenvalue at most RANK of the
    greatest) cannot be whitened and are no components: one vector, or equal ones, have none and empty arrays. Repeated
    rows count each time. Without vectors there are no rows. ``identity_error`` is measured on the whitened rows: the
    greatest entry, over all lengths, of their covariance less the identity; 0 where no component is.
    """
    spans = ranges(vectors)
    products = sums_of_products(vectors, spans) if spans else {}
    fits = {dim: Fit(n, lo, hi, s, products[dim], components) for dim, (n, lo, hi, s) in spans.items()}
    arrow = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("n", pa.int64()), ("deviation", pa.decimal128(38, 0)),
                       ("whitened", pa.list_(pa.float64())), ("explained", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            for dim, rows, x in by_length(batch):
                fit = fits[dim]
                deviation, white = fit.of(x)
                share = (fit.values / fit.trace).tolist() if len(fit.values) else []
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)), pa.array([dim] * len(rows), pa.int32()), pa.array([fit.n] * len(rows)),
                     pa.array(deviation, arrow.field("deviation").type), pa.array(list(white), arrow.field("whitened").type),
                     pa.array([share] * len(rows), arrow.field("explained").type)], schema=arrow)

    done = keep(vectors.mapInArrow(run, "vec_id long, dim int, n long, deviation decimal(38,0), whitened array<double>, explained array<double>"),
                "whitened")
    return done.drop("dim").withColumn("identity_error", F.lit(identity_error(done)))


def identity_error(whitened: DataFrame) -> float:
    """Greatest absolute entry of covariance less identity over the rows' ``whitened``; tasks add up their own rows."""
    arrow = pa.schema([("dim", pa.int32()), ("sums", pa.list_(pa.float64()))])

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            flat, lengths = matrix(batch, "whitened")
            starts, dims = np.cumsum(lengths) - lengths, batch.column("dim").to_numpy()
            for dim in np.unique(dims[lengths > 0]).tolist():
                rows = np.flatnonzero((dims == dim) & (lengths > 0))
                w = flat[starts[rows][:, None] + np.arange(lengths[rows[0]])]
                own = np.r_[len(rows), w.sum(axis=0), (w.T @ w).ravel()]
                totals[dim] = totals.get(dim, 0) + own
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(totals, pa.int32()), pa.array(list(totals.values()), arrow.field(1).type)], schema=arrow)

    found = (whitened.select("dim", "whitened").mapInArrow(run, "dim int, sums array<double>")
             .select("dim", F.posexplode("sums").alias("at", "v")).groupBy("dim", "at").agg(F.sum("v").alias("v")).collect())
    worst = 0.0
    for dim in {r.dim for r in found}:
        sums = np.array([r.v for r in sorted((r for r in found if r.dim == dim), key=lambda r: r.at)])
        k = int(round((np.sqrt(1 + 4 * (len(sums) - 1)) - 1) / 2))
        mean, second = sums[1:k + 1] / sums[0], sums[k + 1:].reshape(k, k) / sums[0]
        worst = max(worst, float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max()))
    return worst
