"""Exact top-k search by inner product, with pivots that bound it.

Candidates are dealt into blocks, and each block meets every query once. In a block, vectors x get one more component so
that all have the length M of its longest; a query's has 0. Then |q - x|² = |q|² + M² - 2 q·x, so the nearest candidate is that
of the largest product, and the triangle inequality bounds it: with any pivot p, |q - x| >= | |q - p| - |x - p| |. A block's
distances to its pivots are reckoned once; a query takes the largest of each candidate's lower bounds, evaluates the
candidates in the order of these bounds, and stops where no later one can reach its k-th best score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from onoma.llm.clustering import LARGEST, integers, size_of
from onoma.llm.common import map_arrow, stash

K, SCALE, EVERY = 5, 256, 50
#: Pivots of a block, vectors among which they are looked for, and candidates evaluated first.
PIVOTS, AMONG, STEP = 32, 512, 256
#: Vectors of a block: few enough for a task's memory, and else as many as leave some work for TASKS tasks.
LEAST_BLOCK, MOST_BLOCK, TASKS = 2048, 1 << 18, 64
#: Bounds held at once.
HELD = 1 << 21


def squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of rows of x to rows of y."""
    return np.sqrt(np.maximum(squares(x)[:, None] - 2.0 * (x @ y.T) + squares(y)[None, :], 0.0))


def farthest(x: np.ndarray, n: int) -> np.ndarray:
    """Up to n rows, each the one farthest from those before it, among the first AMONG."""
    x = x[:AMONG]
    chosen, far = [0], apart(x, x[:1])[:, 0]
    while len(chosen) < min(n, len(x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, apart(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


class Block:
    """Candidates of one length: their rows, ids (null: the largest long, and marked), integers, and distances to the pivots."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, null: np.ndarray, x: np.ndarray, pivots: int = PIVOTS):
        self.rows, self.ids, self.null, self.exact, self.size = rows, ids, null, x, size_of(x)
        self.real = x.astype(np.float64)
        norms = squares(self.real)
        self.top = float(norms.max())
        lifted = np.column_stack([self.real, np.sqrt(np.maximum(self.top - norms, 0.0))])
        self.pivots = farthest(lifted, pivots) if math.isfinite(self.top) else lifted[:0]
        self.table = apart(lifted, self.pivots).T.copy()

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """(query, candidate): the most that the product can be, with room for rounding."""
        x = np.column_stack([q.astype(np.float64), np.zeros(len(q))])
        to, low = apart(x, self.pivots), np.zeros((len(q), len(self.ids)))
        for p, column in enumerate(self.table):
            np.maximum(low, np.abs(to[:, p, None] - column[None, :]), out=low)
        both = squares(x)[:, None] + self.top
        most = (both - low * low) / 2 + 4 * math.sqrt(x.shape[1] * 2.0**-50) * both + 1
        return np.where(np.isfinite(most), np.maximum(most, -(2.0**63)), np.inf)

    def products(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact inner products, within the longs."""
        most = len(q) * self.size * size_of(q)
        if most < 2**53:
            return (self.real[at] @ q.astype(np.float64)).astype(np.int64)
        if most <= LARGEST:
            return (self.exact[at].astype(np.int64) * q.astype(np.int64)).sum(axis=1)
        score = (self.exact[at].astype(object) * q.astype(object)).sum(axis=1)
        return np.array([min(max(v, -LARGEST - 1), LARGEST) for v in score.tolist()], object)

    def best(self, own: int, q: np.ndarray, bound: np.ndarray, k: int) -> tuple[list[tuple[int, int, bool, int]], int]:
        """The k best (-score, id, no id, row), and how many candidates were evaluated."""
        found: list[tuple[int, int, bool, int]] = []
        step, seen = min(max(STEP, k + 1), len(bound)), 0
        order = np.argpartition(-bound, step - 1)
        first, rest = order[:step], order[step:]
        while len(first):
            score = self.products(first, q)
            seen += len(first)
            fine = self.rows[first] != own
            if len(found) == k:
                fine &= score >= -found[-1][0]
            some = first[fine]
            found += zip([-s for s in score[fine].tolist()], self.ids[some].tolist(), self.null[some].tolist(), self.rows[some].tolist(), strict=True)
            found = sorted(found)[:k]
            if len(found) == k:  # an equal score may still have a smaller id
                rest = rest[bound[rest] >= -found[-1][0]]
            step *= 2
            if len(rest) > step:
                order = np.argpartition(-bound[rest], step - 1)
                first, rest = rest[order[:step]], rest[order[step:]]
            else:
                first, rest = rest, rest[:0]
        return found, seen


def _matrix(part: pa.RecordBatch, scale: int) -> np.ndarray:
    flat = part.column("x").flatten().to_numpy(zero_copy_only=False)
    return integers(flat.astype(np.float64).reshape(part.num_rows, part.column("dim")[0].as_py()), scale)


def _search(k: int, scale: int, pivots: int):  # noqa: ANN202
    def answers(block: Block, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        step = max(1, HELD // len(block.ids))
        q, rows = _matrix(part, scale), part.column("row").to_numpy()
        for a in range(0, len(q), step):
            out = []
            for row, x, bound, ident in zip(rows[a : a + step].tolist(), q[a : a + step], block.bounds(q[a : a + step]), part.column("vec_id").slice(a, step).to_pylist(), strict=True):
                out += [(row, ident, None if null else i, -score, at) for score, i, null, at in block.best(row, x, bound, k)[0]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 5)], ["query_row", "query_id", "vec_id", "score", "row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by block, its candidates before the queries; only the candidates are held."""
        now, parts, block = None, [], None
        for b in batches:
            keys = np.column_stack([b.column(c).to_numpy() for c in ("cell", "dim", "side")])
            edges = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if hi == lo:
                    continue
                if now != (at := tuple(keys[lo, :2].tolist())):
                    now, parts, block = at, [], None
                part = b.slice(lo, hi - lo)
                if not keys[lo, 2]:
                    ids = part.column("vec_id")
                    parts.append((part.column("row").to_numpy(), ids.fill_null(LARGEST).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), _matrix(part, scale)))
                elif parts or block is not None:  # of a rare length a cell may hold queries only
                    if block is None:
                        block, parts = Block(*[np.concatenate(c) for c in zip(*parts, strict=True)], pivots), []
                    yield from answers(block, part)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, pivots: int = PIVOTS, block: int | None = None) -> DataFrame:
    """vectors: (vec_id, embedding array of numbers) -> (query_id, rank, vec_id, score): each query's k highest inner products.

    is_query tells the queries by vec_id; candidates are all rows but the query's own. A component x counts as
    floor(scale * x). Equal scores stand by vec_id, rows without one last. Vectors that are null or hold null or non-finite
    components take no part, and only vectors of a query's own length are its candidates; where they are fewer than k, it
    has as many rows. A repeated id or row is a row of its own, as query and as candidate: its copies find each other.
    Scores are exact; one that a long does not hold counts as the largest or smallest long. Empty vectors score 0. An empty table
    gives no rows, and other columns are ignored. block: vectors of a block, by the table's size if None.
    """
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("x")).where(F.col("x").isNotNull() & fine)
    rows = stash(rows.withColumn("row", F.monotonically_increasing_id()), "candidates")
    n = rows.count()
    blocks = max(1, math.ceil(n / (block or min(max(n // TASKS, LEAST_BLOCK), MOST_BLOCK))))
    own = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    sides = rows.select(own.alias("cell"), F.lit(0).alias("side"), "row", "vec_id", "x")
    asked = rows.where(is_query).select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cell"), F.lit(1).alias("side"), "row", "vec_id", "x")
    dealt = sides.unionByName(asked).withColumn("dim", F.size("x")).repartition(blocks, "cell", "dim").sortWithinPartitions("cell", "dim", "side")
    found = map_arrow(dealt, _search(k, scale, pivots), "query_row long, query_id long, vec_id long, score long, row long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
