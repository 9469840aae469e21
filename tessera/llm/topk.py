"""Exact top-k search by inner product with an impact-ordered index that is
processed score at a time.

Vectors are integer components.  A block of candidates is indexed by dimension:
its postings (rows with a component other than zero) are ordered by descending
quantised magnitude of the component, rows of one quantised magnitude being a
segment.  For a query, the impact of a segment is |query component| times that
magnitude; segments of all dimensions are added to the rows' accumulators by
descending impact, in waves.  After a wave every impact not yet added is at most
the wave's limit t, so the score of a row that has met ``c`` of the query's ``m``
dimensions lies within ``(m - c) * t`` (and the rounding of the magnitudes) of its
accumulator.  Rows whose upper bound is below the k-th best lower bound are proven
out.  Waves end only when such a proof leaves few rows; these are scored exactly.

Candidates and queries meet in blocks of bounded size, so that no task holds
more than a block of each; the k best of every block are merged per query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

#: Rows of a block of candidates and of a block of queries.
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 1_024
#: Most tasks in which pairs of blocks are searched.
MOST_TASKS = 20_000
#: Quantised magnitudes of a dimension.
LEVELS = 256
#: Shares of the postings that each wave is to have processed (the last: all).
WAVES = (0.5, 0.6, 0.68, 0.76, 0.84, 0.92)
#: Rows left by a proof, as a share of the block, that are few enough to score.
FEW = 1 / 64


class ImpactIndex:
    """The postings of a block of vectors (rows x dimensions, integers)."""

    def __init__(self, x: np.ndarray):
        self.x = x
        rows, dims = x.shape
        size = np.abs(x)
        most = size.max(axis=0, initial=0)
        self.step = np.maximum(1, -(-most // LEVELS))  # quantised magnitude = step * level
        level = size // self.step
        top = int(level.max(initial=0))
        kind = np.uint16 if top < 1 << 16 else np.int64
        self.order = np.ascontiguousarray(np.argsort((top - level).astype(kind), axis=0, kind="stable").T)
        signed = np.sign(x) * level * self.step
        self.value = np.ascontiguousarray(np.take_along_axis(signed.T, self.order, axis=1)).astype(np.float64)
        # postings of dimension d with a level of at least v: reach[d, v]
        held = np.zeros((dims, top + 2), np.int64)
        np.add.at(held, (np.repeat(np.arange(dims)[None], rows, 0).ravel(), level.ravel()), 1)
        self.reach = np.ascontiguousarray(held[:, ::-1].cumsum(axis=1)[:, ::-1])
        self.top = top
        # where postings are put together for adding them up
        self.docs, self.parts = np.empty(x.size, np.int64), np.empty(x.size, np.float64)

    def _reached(self, weight: np.ndarray, dims: np.ndarray, limit: float) -> np.ndarray:
        """Postings of each dimension with an impact above ``limit``."""
        least = np.minimum(np.floor(limit / weight) + 1, self.top + 1).astype(np.int64)
        return self.reach[dims, least]

    def _limits(self, weight: np.ndarray, dims: np.ndarray) -> list[float]:
        """Descending impacts at which about ``WAVES`` of the postings are above."""
        tried = weight.max() * self.top * np.geomspace(1, 1 / 512, 40)
        least = np.minimum(np.floor(tried[:, None] / weight) + 1, self.top + 1).astype(np.int64)
        done = self.reach[dims[None, :], least].sum(axis=1)
        every = max(1, int(self.reach[dims, 1].sum()))
        at = np.unique(np.searchsorted(done / every, WAVES))
        return [float(tried[k]) for k in at if k < tried.size] + [0.0]

    def possible(self, q: np.ndarray, k: int) -> np.ndarray:
        """Rows that may be among the ``k`` best, all others being proven out."""
        rows = len(self.x)
        dims = np.flatnonzero((q != 0) & (self.reach[:, 1] > 0))
        if rows <= k or not dims.size:
            return np.arange(rows)
        size = np.abs(q[dims]).astype(np.float64)
        weight = size * self.step[dims]
        # of magnitudes to their segment's and, for very large ones, of floating point
        rounding = float((size * (self.step[dims] - 1)).sum() + 1e-12 * weight.sum() * self.top)
        # sums of impacts and how many dimensions a row has met, added up as one number
        # where it is exact: met * unit + sum
        reach = float(weight.sum()) * self.top
        unit = 2.0 ** math.ceil(math.log2(2 * reach + 2))
        together = unit * (dims.size + 1) < 2.0 ** 53
        total, met = np.zeros(rows), np.zeros(rows)
        before = np.zeros(dims.size, np.int64)
        left = np.arange(rows)
        for limit in self._limits(weight, dims):
            upto = self._reached(weight, dims, limit)
            n = 0
            for d, s, e, w in zip(dims.tolist(), before.tolist(), upto.tolist(), q[dims].tolist()):
                self.docs[n:n + e - s] = self.order[d, s:e]
                np.multiply(self.value[d, s:e], w, out=self.parts[n:n + e - s])
                n += e - s
            docs, parts = self.docs[:n], self.parts[:n]
            if together:
                parts += unit
                found = np.bincount(docs, parts, rows)
                times = np.rint(found / unit)
                total += found - times * unit
                met += times
            else:
                total += np.bincount(docs, parts, rows)
                met += np.bincount(docs, minlength=rows)
            before = upto
            slack = (dims.size - met) * limit + rounding
            least = np.partition(total - slack, rows - k)[rows - k]
            left = np.flatnonzero(total + slack >= least)
            if left.size <= max(4 * k, FEW * rows):
                break
        return left

    def scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The exact scores of ``rows``."""
        x = self.x[rows]
        most = int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(1, q.size)
        if most < 1 << 53:
            return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        if most < 1 << 62:
            return x @ q
        exact = [sum(a * b for a, b in zip(r, q.tolist())) for r in x.tolist()]
        return np.array(exact, np.int64)  # raises if a score is no 64-bit integer


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists of integers as rows, filled up with zeros."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < size[:, None]] = flat
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max((len(x) for c in columns for x in c), default=0)


def _best(ids: np.ndarray, known: np.ndarray, score: np.ndarray, copies: np.ndarray, k: int) -> np.ndarray:
    """Which rows give the ``k`` highest scores, ties to smaller ids (null ids
    last), a row counting as often as it has copies."""
    order = np.lexsort((ids, ~known, -score))
    before = np.cumsum(copies[order]) - copies[order]
    return order[(before < k) & (copies[order] > 0)]


def _search(k: int):
    def run(found: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query": [], "vec_id": [], "known": [], "score": [], "copies": []}
        if found.num_rows and asked.num_rows:
            dims = _width(found["__v"], asked["__v"])
            x, q = _matrix(found["__v"], dims), _matrix(asked["__v"], dims)
            known = found["__id"].is_valid().to_numpy()
            ids = found["__id"].fill_null(0).to_numpy()
            copies = found["__n"].to_numpy()
            at = np.lexsort((ids, ~known))
            x, ids, known, copies = x[at], ids[at], known[at], copies[at]
            index = ImpactIndex(x)
            own_ids = asked["__id"].to_numpy()
            for j in range(len(q)):
                # of the query's own row one copy less stands to be found
                own = np.arange(*np.searchsorted(ids[known], [own_ids[j], own_ids[j] + 1]))
                own = own[(x[own] == q[j]).all(axis=1)]
                rows = index.possible(q[j], k + own.size)
                times = copies[rows] - np.isin(rows, own)
                rows, times = rows[times > 0], times[times > 0]
                score = index.scores(q[j], rows)
                best = _best(ids[rows], known[rows], score, times, k)
                out["query"].append(np.full(best.size, asked["__q"][j].as_py()))
                out["vec_id"].append(ids[rows[best]])
                out["known"].append(known[rows[best]])
                out["score"].append(score[best])
                out["copies"].append(np.minimum(times[best], k))
        flat = {c: np.concatenate(v) if v else np.zeros(0, bool if c == "known" else np.int64) for c, v in out.items()}
        return pa.table({
            "__q": pa.array(flat["query"], pa.int64()), "vec_id": pa.array(flat["vec_id"], pa.int64(), mask=~flat["known"]),
            "score": pa.array(flat["score"], pa.int64()), "__n": pa.array(flat["copies"], pa.int64())})
    return run


def whole_components(vector: Column, factor: float) -> Column:
    """``floor(factor * x)`` of each component as integers; null if the vector
    is null or has a null or non-finite component."""
    x = F.transform(vector, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * F.lit(float(factor))).cast("bigint")))


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "vector",
          block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """For every row of ``vectors`` for which ``is_query`` holds, its ``k`` highest
    integer inner products with other rows (all, if there are fewer): query_id,
    rank (from 1), vec_id, score.  ``vector``: arrays of integers.

    Ties go to the smaller id, a null id being last.  Rows whose vector is null or
    holds a null take no part; an empty vector scores 0, a shorter one counts as
    filled up with zeros.  Rows with a null id are found but ask nothing.  Equal
    rows are worked on once and count as often as they stand; a row is not found
    by itself, but by its copies.  Each copy of a query has its own rows in the
    result.  Further columns are ignored.  A score that is no 64-bit integer
    raises an error.
    """
    asks = F.coalesce(is_query, F.lit(False)) & F.col(vec_id).isNotNull()
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("__id"), F.col(vector).cast("array<bigint>").alias("__v"),
                          asks.alias("__asks"))
    rows = rows.where(F.col("__v").isNotNull() & F.forall("__v", lambda v: v.isNotNull()))
    rows = cut_lineage(rows.groupBy("__id", "__v", "__asks").agg(F.count(F.lit(1)).alias("__n")))
    size = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("__asks"), 1))).first()
    parts, groups = -(-size[0] // block_rows) or 1, -(-size[1] // block_queries) or 1
    deal = F.xxhash64("__id", "__v")
    found = rows.select("__id", "__v", "__n", F.pmod(deal, F.lit(parts)).alias("__part"),
                        F.explode(_numbers(groups)).alias("__group"))
    # a query's number: its own id and vector together are unique, their hash need not be
    asked = cut_lineage(rows.where("__asks").withColumn("__q", F.monotonically_increasing_id()))
    sent = asked.select("__q", "__id", "__v", F.pmod(deal, F.lit(groups)).alias("__group"),
                        F.explode(_numbers(parts)).alias("__part"))
    keys = ["__part", "__group"]
    # as many tasks as pairs of blocks: their work follows rows, not bytes
    pairs = min(parts * groups, MOST_TASKS)
    found, sent = found.repartition(pairs, *keys), sent.repartition(pairs, *keys)
    best = (found.groupBy(*keys).cogroup(sent.groupBy(*keys))
            .applyInArrow(_search(k), "__q bigint, vec_id bigint, score bigint, __n bigint"))
    order = Window.partitionBy("__q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    before = F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    taken = (best.withColumn("__before", before).where(F.col("__before") < k)
             .withColumn("rank", F.explode(F.sequence(F.col("__before") + 1, F.least(F.col("__before") + F.col("__n"), F.lit(k))))))
    return (taken.join(asked.select("__q", F.col("__id").alias("query_id"), F.col("__n").alias("__times")), "__q")
            .withColumn("__time", F.explode(F.sequence(F.lit(1).cast("bigint"), "__times")))
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
