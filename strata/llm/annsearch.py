"""Nearest vectors by inner product with stable projections and kd-trees (op 1).

Largest inner product becomes nearest distance by one more coordinate: rows get
``sqrt(M^2 - |x|^2)`` (M the largest norm), queries are scaled to norm M and get 0.  Gaussian
projections to ``PLACES`` dimensions are 2-stable: a projected squared distance is the true one times a
chi-square variable.  So projected neighbours are looked at in order of distance,
verified on the original vectors, and once the next is farther than
``quantile(CONFIDENCE) * (distance of the k-th found)`` any nearer row would have come before
with that probability: the search stops.

* Equal vectors are one point; of their ids the ``K + 1`` smallest are kept, as no more can be among
  the ``K`` nearest of any query.
* A kd-tree over the projections of a bounded sample (``SAMPLE`` points) cuts the space into cells; every row goes
  into its cell's block, and large cells are split into blocks of about ``BLOCK_ROWS`` rows.
* A query searches its own cell first.  Its k-th distance then tells which other cells the
  stopping test cannot rule out; these are searched with that bound.
* Inside a block a kd-tree of small leaves gives the projected neighbours step by step.

Queries of a cell go together in chunks, so neither rows nor queries of a group are unbounded.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
rows with a null id; vectors of another length than the query's are no candidates; repeated rows (same id
and vector) count once; a query with fewer candidates than K gets all; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .quality import chi2_quantile
from .storage import materialize, ship, table

K = 20
PLACES = 12
CONFIDENCE = 0.98
SAMPLE = 20_000
CELL_ROWS = 4096
BLOCK_ROWS = 8192
QUERIES = 1024
LEAF = 64
EVERY = 20


def projection(dim: int) -> np.ndarray:
    """The Gaussian matrix of a dimension (one more row for the added coordinate)."""
    return np.random.default_rng(20_000 + dim).standard_normal((dim + 1, PLACES))


class Cells:
    """kd-tree over a sample: inner splits by median of the widest dimension; regions of the leaves."""

    def __init__(self, points: np.ndarray, cells: int):
        self.split: list[tuple[int, float, int, int]] = []  # dimension, value, left, right; leaves are -1 - cell
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        inf = np.full(PLACES, np.inf)
        self.root = self._grow(points, max(cells, 1), -inf, inf)
        self.low_, self.high_ = np.array(self.low), np.array(self.high)

    def _grow(self, p: np.ndarray, cells: int, low: np.ndarray, high: np.ndarray) -> int:
        if cells > 1 and len(p) > 1:
            d = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
            v = float(np.median(p[:, d]))
            side = p[:, d] < v
            if side.any() and not side.all():
                at = len(self.split)
                self.split.append((d, v, 0, 0))
                up, down = high.copy(), low.copy()
                up[d] = down[d] = v
                left = self._grow(p[side], cells // 2, low, up)
                self.split[at] = (d, v, left, self._grow(p[~side], cells - cells // 2, down, high))
                return at
        self.low.append(low)
        self.high.append(high)
        return -len(self.low)

    def of(self, p: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        out = np.empty(len(p), np.int64)
        todo = [(self.root, np.arange(len(p)))]
        while todo:
            at, rows = todo.pop()
            if at < 0:
                out[rows] = -1 - at
            elif len(rows):
                d, v, left, right = self.split[at]
                side = p[rows, d] < v
                todo += [(left, rows[side]), (right, rows[~side])]
        return out

    def distances(self, p: np.ndarray) -> np.ndarray:
        """Squared distance of one point to each cell's region."""
        gap = np.maximum(np.maximum(self.low_ - p, p - self.high_), 0)
        return (gap * gap).sum(axis=1)


class Block:
    """Rows of a block behind a kd-tree of leaves of ``LEAF`` rows."""

    def __init__(self, nodes: np.ndarray, vectors: np.ndarray, points: np.ndarray):
        order: list[np.ndarray] = []
        todo = [np.arange(len(nodes))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                order.append(rows)
                continue
            p = points[rows]
            d = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
            by = rows[np.argsort(p[:, d], kind="stable")]
            todo += [by[: len(by) // 2], by[len(by) // 2 :]]
        self.size = np.array([len(r) for r in order])
        rows = np.concatenate(order)
        self.nodes, self.vectors, self.points = nodes[rows], vectors[rows], points[rows]
        self.start = np.concatenate(([0], np.cumsum(self.size)))
        self.low = np.minimum.reduceat(self.points, self.start[:-1], axis=0)
        self.high = np.maximum.reduceat(self.points, self.start[:-1], axis=0)

    def search(self, q: np.ndarray, p: np.ndarray, norm: float, k: int, bound: float, stop: float) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and inner products of the k nearest found; ``bound``: a k-th inner product known already."""
        gap = np.maximum(np.maximum(self.low - p, p - self.high), 0)
        far = (gap * gap).sum(axis=1)
        leaves = np.argsort(far, kind="stable")
        scale = norm / np.sqrt(q @ q)
        best_n, best_s = np.empty(0, np.int64), np.empty(0)
        at, step = 0, 4
        while at < len(leaves):
            # squared distance in the space of the added coordinate
            limit = stop * max(2 * norm * norm - 2 * scale * bound, 0.0) * (1 + 1e-9) + 1e-12
            if far[leaves[at]] > limit:
                break
            take = leaves[at : at + step]
            at, step = at + step, min(step * 2, 32)
            rows = np.concatenate([np.arange(self.start[x], self.start[x + 1]) for x in take])
            d = self.points[rows] - p
            rows = rows[(d * d).sum(axis=1) <= limit] if np.isfinite(limit) else rows
            score = (self.vectors[rows] * q).sum(axis=1)
            n = np.concatenate((best_n, self.nodes[rows]))
            s = np.concatenate((best_s, score))
            top = np.lexsort((n, -s))[:k]
            best_n, best_s = n[top], s[top]
            if len(top) == k:
                bound = max(bound, float(best_s[-1]))
        return best_n, best_s


def _rows(vectors: list[list[float]]) -> np.ndarray:
    return np.array(vectors, np.float64)


def _search(pairs: DataFrame, index: DataFrame, queries: DataFrame, norm: float, k: int) -> DataFrame:
    """qnode, node, score: every query in the blocks that ``pairs`` (qnode, cell, part) gives it."""
    stop = chi2_quantile(CONFIDENCE, PLACES)
    asked = pairs.join(queries, "qnode")
    groups = asked.select(F.col("cell").alias("gcell"), F.col("part").alias("gpart"), F.col("chunk").alias("gchunk")).distinct()
    blocks = index.join(groups, (F.col("cell") == F.col("gcell")) & (F.col("part") == F.col("gpart"))).select("gcell", "gpart", "gchunk", "node", "vec", "point")

    def run(block: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(block) and len(ask):
            b = Block(block["node"].to_numpy(), np.stack([np.frombuffer(x) for x in block["vec"]]), np.stack([np.frombuffer(x) for x in block["point"]]))
            for node, vec, point, bound in zip(ask["qnode"], ask["qvec"], ask["qpoint"], ask["bound"], strict=True):
                n, s = b.search(np.frombuffer(vec), np.frombuffer(point), norm, k, -np.inf if pd.isna(bound) else bound, stop)
                out.append((np.full(len(n), node), n, s))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pd.DataFrame({"qnode": cols[0], "node": cols[1], "score": cols[2]})

    return blocks.groupBy("gcell", "gpart", "gchunk").cogroup(asked.groupBy("cell", "part", "chunk")).applyInPandas(run, "qnode long, node long, score double")


def _one_length(points: DataFrame, qnodes: DataFrame, dim: int, k: int) -> DataFrame:
    """qnode, node, score of the k nearest points found, among vectors of one length."""
    n, norm2 = points.agg(F.count("*"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))).first()
    norm = float(np.sqrt(norm2))
    matrix = projection(dim)

    def project(v: np.ndarray, added: np.ndarray) -> np.ndarray:
        return v @ matrix[:-1] + added[:, None] * matrix[-1]

    def as_point(v: np.ndarray) -> np.ndarray:
        return project(v, np.sqrt(np.maximum(norm * norm - (v * v).sum(axis=1), 0)))

    def as_query(v: np.ndarray) -> np.ndarray:
        return project(v * (norm / np.sqrt((v * v).sum(axis=1)))[:, None], np.zeros(len(v)))

    share = min(1.0, SAMPLE / n)
    some = points.filter(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("embedding").limit(2 * SAMPLE).collect()
    sample = as_point(_rows([r[0] for r in some])) if some else np.zeros((1, PLACES))
    cells = Cells(sample, min(-(-n // CELL_ROWS), max(len(sample) // 8, 1)))

    def place(kind):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    v = _rows(b.column(1).to_pylist())
                    p = kind(v)
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cells.of(p)), pa.array([x.tobytes() for x in v], pa.binary()), pa.array([x.tobytes() for x in p], pa.binary())], ["a", "b", "c", "d"])

        return run

    put = "a long, b long, c binary, d binary"
    index = points.select("node", "embedding").mapInArrow(place(as_point), put).toDF("node", "cell", "vec", "point")
    index = materialize(index, "ann-rows")
    parts = materialize(index.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).cast("int").alias("parts")), "ann-cells")
    index = index.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).drop("parts")
    asked = points.join(qnodes, "node").select("node", "embedding").mapInArrow(place(as_query), put).toDF("qnode", "home", "qvec", "qpoint")
    many = asked.groupBy("home").agg(F.ceil(F.count("*") / F.lit(QUERIES)).alias("chunks"))
    chunk = F.struct("home", F.pmod(F.xxhash64("qnode"), F.col("chunks")).alias("i"))
    asked = materialize(asked.join(many, "home").withColumn("chunk", chunk).drop("chunks"), "ann-queries")
    # a cell of the sample's tree that has no row has no block: the query starts in the others
    home = asked.join(parts, asked.home == parts.cell).select("qnode", "cell", F.lit(0).alias("part"))
    first = materialize(_search(home, index, asked.drop("home").withColumn("bound", F.lit(None).cast("double")), norm, k), "ann-home")
    bound = first.groupBy("qnode").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    asked = asked.join(bound, "qnode", "left")
    stop = chi2_quantile(CONFIDENCE, PLACES)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, at = [], []
            for node, vec, point, bound in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                q = np.frombuffer(vec)
                limit = np.inf if bound is None else stop * max(2 * norm * norm - 2 * norm / np.sqrt(q @ q) * bound, 0.0) * (1 + 1e-9) + 1e-12
                got = np.flatnonzero(cells.distances(np.frombuffer(point)) <= limit)
                nodes.append(np.full(len(got), node))
                at.append(got)
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(at))], ["qnode", "cell"])

    more = asked.select("qnode", "qvec", "qpoint", "bound").mapInArrow(visit, "qnode long, cell long").join(parts, "cell")
    more = more.select("qnode", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(home, ["qnode", "cell", "part"], "left_anti")
    rest = _search(more, index, asked.drop("home"), norm, k)
    rank = F.row_number().over(Window.partitionBy("qnode").orderBy(F.desc("score"), "node"))
    return first.unionByName(rest).withColumn("r", rank).filter(F.col("r") <= k).drop("r")


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``."""
    ship(vectors.sparkSession)
    ok = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter(F.col("vec_id").isNotNull() & ok)
    base = base.select("vec_id", "embedding")
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    ids = materialize(base.dropDuplicates(["vec_id", "embedding"]).withColumn("nth", first).filter(F.col("nth") <= k + 1), "ann-ids")
    points = ids.filter("nth = 1").select(F.col("vec_id").alias("node"), "embedding")
    member = ids.join(points, "embedding").select("node", "vec_id")
    asking = materialize(base.filter(F.col("vec_id") % every == 0).distinct().join(points, "embedding").select("node", F.col("vec_id").alias("query_id")), "ann-asking")
    qnodes = asking.select("node").distinct()
    lengths = [r[0] for r in points.select(F.size("embedding")).distinct().collect()]
    if not lengths:
        return base.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    found = reduce(DataFrame.unionByName, [_one_length(points.filter(F.size("embedding") == d), qnodes, d, k + 1) for d in lengths])
    near = found.join(member, "node").withColumn("r", F.row_number().over(Window.partitionBy("qnode").orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") <= k + 1)
    out = asking.join(near.select("qnode", "vec_id", "score"), F.col("node") == F.col("qnode")).filter("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of each query row of ``embeddings``."""
    return nearest(table(spark, sf_dir, "embeddings"))
