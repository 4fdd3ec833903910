"""Exact top-k by inner product: cover trees over queries and data, searched together."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 10
SCALE = 1024
QUERY_BLOCK = 4096
DATA_BLOCK = 8192
LEAF = 64
FANOUT = 16


class Node:
    """A ball: every member lies within ``radius`` of ``center``. Leaves have no children."""

    __slots__ = ("center", "norm", "radius", "members", "children")

    def __init__(self, center, radius, members, children):
        self.center, self.norm, self.radius = center, float(np.linalg.norm(center)), radius
        self.members, self.children = members, children


def tree(points: np.ndarray, members: np.ndarray, first: int) -> Node:
    """Covering tree over ``members``: children are centered on members far from each other (each new center the
    farthest from those taken, until all lie within half the parent's radius or FANOUT are taken), every member goes
    to the nearest center, and each node keeps the covering radius it really has."""
    center = points[first]
    distance = np.linalg.norm(points[members] - center, axis=1)
    radius = float(distance.max())
    if len(members) <= LEAF or radius == 0:
        return Node(center, radius, members, ())
    centers, near, owner = [first], distance.copy(), np.zeros(len(members), np.int64)
    while near.max() > radius / 2 and len(centers) < FANOUT:
        far = int(near.argmax())
        centers.append(int(members[far]))
        other = np.linalg.norm(points[members] - points[members[far]], axis=1)
        closer = other < near
        owner[closer] = len(centers) - 1
        near = np.where(closer, other, near)
    children = [tree(points, members[owner == i], c) for i, c in enumerate(centers) if (owner == i).any()]
    return Node(center, radius, members, children)


class Best:
    """The k best (score, id) of each query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def worst(self, rows: np.ndarray) -> float:
        return float(self.score[rows, -1].min())

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        score = np.concatenate([self.score[rows], score], axis=1)
        ids = np.concatenate([self.id[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
        by_id = np.argsort(ids, axis=1, kind="stable")
        score, ids = np.take_along_axis(score, by_id, 1), np.take_along_axis(ids, by_id, 1)
        top = np.argsort(-score, axis=1, kind="stable")[:, :self.k]
        self.score[rows], self.id[rows] = np.take_along_axis(score, top, 1), np.take_along_axis(ids, top, 1)


def search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int) -> Best:
    """Dual-tree search. A pair of nodes is left out when even its best possible score, the product of the centers
    widened by both radii, is below the worst k-th score in the query node; equal scores are still looked at."""
    best = Best(len(queries), k)
    if not len(queries) or not len(data):
        return best
    # equal vectors are one point; of its rows a query takes the k of smallest ids, besides those of its own id, of which k stay
    points, point_of = np.unique(data, axis=0, return_inverse=True)
    order = np.lexsort((data_ids, point_of.ravel()))
    owners = point_of.ravel()[order]
    new = np.r_[True, (owners[1:] != owners[:-1]) | (data_ids[order][1:] != data_ids[order][:-1])]
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    few = np.arange(len(order)) - first < k
    order, owners = order[few], owners[few]
    start = np.searchsorted(owners, np.arange(len(points)))
    kept = order[np.arange(len(order)) - start[owners] < 2 * k]
    ids_of = np.split(data_ids[kept], np.cumsum(np.bincount(point_of.ravel()[kept], minlength=len(points)))[:-1])
    exact = points.astype(np.float64)
    slack = 1e-6 * (1 + np.abs(queries).max(initial=0) * np.abs(exact).max(initial=0) * data.shape[1])
    top = tree(exact, np.arange(len(points)), 0)
    asked = queries.astype(np.float64)
    stack = [(math.inf, tree(asked, np.arange(len(asked)), 0), top)]

    def reach(q: Node, c: Node) -> float:
        return float(q.center @ c.center) + q.radius * c.norm + c.radius * q.norm + q.radius * c.radius + slack

    while stack:
        bound, q, c = stack.pop()
        if bound < best.worst(q.members):
            continue
        if not q.children and not c.children:
            ids = np.concatenate([ids_of[m] for m in c.members])
            column = np.repeat(np.arange(len(c.members)), [len(ids_of[m]) for m in c.members])
            score = (asked[q.members] @ exact[c.members].T)[:, column]
            score[query_ids[q.members][:, None] == ids[None, :]] = -np.inf
            best.add(q.members, score, ids)
        elif c.children and (not q.children or c.radius >= q.radius):
            stack += sorted(((reach(q, x), q, x) for x in c.children), key=lambda s: s[0])
        else:
            stack += sorted(((reach(x, c), x, c) for x in q.children), key=lambda s: s[0])
    return best


def quantised(vectors: DataFrame, scale: int = SCALE, copies: int = 1) -> DataFrame:
    """``vec_id`` and ``v`` (components floor(scale * x)). Rows take no part whose id or vector is null or that hold a
    null or non-finite component. All vectors of an id stay; of rows equal in both, ``copies``: with k of them the best k
    are those of all rows."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
            .where(finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
            .groupBy("vec_id", "v").agg(F.count("*").alias("rows"))
            .select("vec_id", "v", F.explode(F.sequence(F.lit(1), F.least("rows", F.lit(copies).cast("long")))).alias("copy"))
            .select("vec_id", "v"))


def top_k(table: DataFrame, is_query: F.Column, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the best ``k`` of all rows of other ids for each query. Several
    query rows of one id are ranked together, each pair of rows counting.

    ``table`` has ``vec_id`` and integer vectors ``v``; only vectors of one length are compared. Queries and data are
    dealt into blocks of bounded size and every pair of blocks is one task; its k best per query are merged by a
    ranking window.
    """
    sizes = table.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    q_blocks, d_blocks = max(1, math.ceil(sizes.q / QUERY_BLOCK)), max(1, math.ceil(sizes.n / DATA_BLOCK))
    dealt = table.withColumn("dim", F.size("v"))

    def copies(block: str, own: int, other: str, others: int, rows: DataFrame) -> DataFrame:
        return (rows.withColumn(block, F.pmod(F.xxhash64("vec_id", "v"), F.lit(own)))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))

    asked = copies("qb", q_blocks, "db", d_blocks, dealt.where(is_query)).select("dim", "qb", "db", "vec_id", "v")
    data = copies("db", d_blocks, "qb", q_blocks, dealt).select("dim", F.col("qb").cast("long").alias("qb"), "db", "vec_id", "v")
    asked = asked.withColumn("db", F.col("db").cast("long"))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def matrix(rows: pa.Table) -> np.ndarray:
        flat = rows.column("v").combine_chunks().flatten().to_numpy()
        return flat.reshape(rows.num_rows, -1) if rows.num_rows else np.empty((0, 0), np.int64)

    def run(q: pa.Table, d: pa.Table) -> pa.Table:
        ids = q.column("vec_id").to_numpy()
        best = search(matrix(q), ids, matrix(d), d.column("vec_id").to_numpy(), k)
        row, column = np.nonzero(best.score > -np.inf)
        return pa.table([ids[row], best.id[row, column], best.score[row, column].astype(np.int64)], schema=schema)

    found = (asked.groupBy("dim", "qb", "db").cogroup(data.groupBy("dim", "qb", "db"))
             .applyInArrow(run, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
