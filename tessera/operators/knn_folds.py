"""Accuracy of exact k-nearest-neighbour classifiers of all folds from one search.

A fold's classifier has the rows outside it as its points and scales features to the
least and largest value of those rows.  Folds with the same scale (nearly all: a fold
differs only if it alone holds an extreme value) share one search: labelled rows are
folded to distinct (features, label, fold), dealt to cells of space, and every cell's
task builds a tree of its points and asks it for the neighbours of the same rows.
What a query keeps suffices for every fold that may be left out, and cells beyond its
own are asked only for points within the distance found.  No row is joined back: the
points themselves say how many rows were right.

Order among equal distances and votes are those of ``operators.knn``.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.knn import LEAF, SAMPLE, Borders, PartitionTree, _matrix
from tessera.session import keep

#: Least and most points of a cell, cells wanted, queries searched together.
LEAST, MOST, WANTED, TOGETHER = 4096, 65_536, 32, 1024

_NEAR = "array<struct<square:double,code:bigint,fold:bigint,n:bigint>>"


class FoldTree:
    """A partition tree whose points also have a fold."""

    def __init__(self, x: np.ndarray, label: np.ndarray, fold: np.ndarray, count: np.ndarray, leaf: int = LEAF):
        self.tree = PartitionTree(x, np.arange(len(x)), count, leaf)
        self.planes = [np.ascontiguousarray(self.tree.points[:, :, f]) for f in range(self.tree.d)]
        self.count = self.tree.count
        self.leaves = np.flatnonzero(self.tree.child < 0)
        self.leaves = self.leaves[np.argsort(self.tree.cell[self.leaves])]  # by cell
        self.label, self.fold = (a[self.tree.label] if len(x) else self.tree.label for a in (label, fold))

    def nearest(self, q: np.ndarray, k: int, own: np.ndarray | None, without: Sequence[int], bound: np.ndarray):
        """Distances (squared), labels, folds and multiplicities of points, none farther
        than ``bound``, that hold the ``k`` nearest of each query whichever of the folds
        ``without`` is left out, or, if ``own`` is given, without its own fold; in order
        of distance, and that bound (updated in place).  Multiplicity 0: no point."""
        best = [np.full((len(q), k), np.inf), *(np.zeros((len(q), k), np.int64) for _ in range(3))]
        if not len(q) or not len(self.tree.points):
            return best
        home = self.tree._home(q)
        best = self._visit(q, np.arange(len(q)), home, k, own, without, best, bound)
        # cells beside each other mostly have the same parents: as many as may hold k points bound the distance
        beside = 1
        while beside * self.count.shape[1] < 6 * k:
            beside *= 2
        group = self.tree.cell[home] // beside
        for j in range(beside):
            cell = group * beside + j
            new = np.flatnonzero((cell < len(self.leaves)) & (cell != self.tree.cell[home]))
            best = self._visit(q, new, self.leaves[cell[new]], k, own, without, best, bound)
        rows, node, found = np.arange(len(q)), np.zeros(len(q), np.int64), []
        while rows.size:
            box = self.tree._box(q[rows], node)
            near = box <= bound[rows]
            rows, node, box = rows[near], node[near], box[near]
            leaf = self.tree.child[node] < 0
            other = leaf & (self.tree.cell[node] // beside != group[rows])
            found.append((rows[other], node[other], box[other]))
            rows, node = np.repeat(rows[~leaf], 2), np.repeat(self.tree.child[node[~leaf]], 2)
            node[1::2] += 1
        rows, node, box = (np.concatenate(a) for a in zip(*found))
        order = np.lexsort((box, rows))
        rows, node, box = rows[order], node[order], box[order]
        turn = np.arange(rows.size) - np.searchsorted(rows, np.arange(len(q)))[rows]
        by_turn = np.argsort(turn, kind="stable")
        start = 0
        for end in np.cumsum(np.bincount(turn)) if rows.size else []:
            at = by_turn[start:end]
            at = at[box[at] <= bound[rows[at]]]
            if not at.size:  # boxes only get farther
                break
            best = self._visit(q, rows[at], node[at], k, own, without, best, bound)
            start = end
        return best

    def _visit(self, q: np.ndarray, rows: np.ndarray, node: np.ndarray, k: int, own, without, best: list, bound: np.ndarray) -> list:
        """Merges the points of a cell each into the best of ``rows``."""
        if not rows.size:
            return best
        cell = self.tree.cell[node]
        square = np.zeros((len(rows), self.count.shape[1]))
        for f, plane in enumerate(self.planes):
            gap = plane[cell]
            gap -= q[rows, f][:, None]
            gap *= gap
            square += gap
        hit = square <= bound[rows][:, None]
        hit &= self.count[cell] > 0
        if own is not None:
            hit &= self.fold[cell] != own[rows][:, None]
        some = hit.any(axis=1)
        if not some.any():
            return best
        rows, cell, hit = rows[some], cell[some], hit[some]
        new = [np.where(hit, square[some], np.inf), self.label[cell], self.fold[cell], np.where(hit, self.count[cell], 0)]
        joined = [np.concatenate([b[rows], n], axis=1) for b, n in zip(best, new)]
        order = np.argsort(joined[0], axis=1)
        joined = [np.take_along_axis(a, order, axis=1) for a in joined]
        square, label, fold, count = joined
        limit = np.full(len(rows), -np.inf)
        every = count.cumsum(axis=1)
        for f in without if own is None else [None]:
            enough = (every if f is None else every - (count * (fold == f)).cumsum(axis=1)) >= k
            at = enough.argmax(axis=1)
            here = np.arange(len(rows))
            limit = np.maximum(limit, np.where(enough[here, at], square[here, at], np.inf))
        limit = np.minimum(limit, bound[rows])
        bound[rows] = limit
        kept = (square <= limit[:, None]) & (count > 0)
        if kept.sum(axis=1).max() > 4 * k + LEAF:
            # of a label and fold no more than k rows can count
            for f, c in set(zip(fold[kept].tolist(), label[kept].tolist())):
                mine = (fold == f) & (label == c) & kept
                copies = np.where(mine, count, 0)
                kept &= ~(mine & (copies.cumsum(axis=1) - copies >= k))
        square[~kept], count[~kept] = np.inf, 0
        width = max(k, int((kept * np.arange(1, kept.shape[1] + 1)).max()))
        if width > best[0].shape[1]:
            more = width - best[0].shape[1]
            best = [np.pad(b, ((0, 0), (0, more)), constant_values=v) for b, v in zip(best, (np.inf, 0, 0, 0))]
        width = best[0].shape[1]
        for b, a in zip(best, joined):
            b[rows, :min(width, a.shape[1])] = a[:, :width]
            b[rows, a.shape[1]:] = np.inf if b.dtype.kind == "f" else 0
        return best


def _lists(parts: list[list[np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    """The real points of each query as a list, and how many there are."""
    size = [np.zeros(0, np.int64), *((p[3] > 0).sum(axis=1) for p in parts)]
    flat = [[a[p[3] > 0] for a in p] for p in parts] or [[np.zeros(0), *[np.zeros(0, np.int64)] * 3]]
    size = np.concatenate(size)
    ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
    fields = pa.StructArray.from_arrays([pa.array(np.concatenate(a)) for a in zip(*flat)], ["square", "code", "fold", "n"])
    return pa.ListArray.from_arrays(ends, fields), size


def _tree_of(points: pa.Table, d: int) -> FoldTree:
    x = _matrix(points["x"].combine_chunks(), d) if len(points) else np.zeros((0, d))
    return FoldTree(x, *(points[c].to_numpy() for c in ("code", "fold", "n")))


def _rows(x: np.ndarray, d: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * d + 1, d, dtype=np.int32)), pa.array(x.ravel()))


def _cell(borders: Borders, d: int) -> Column:
    @F.arrow_udf("bigint")
    def cell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(borders.cell(_matrix(batch, d)))

    return cell("x")


class _Search:
    """The neighbours of all rows for the folds ``asked`` of one scale.  ``train``: for
    each of them the neighbours of all rows, else those of its own rows."""

    def __init__(self, points: DataFrame, cells: int, low: np.ndarray, high: np.ndarray, asked: list[int], train: bool, ks: list[int], labels: int):
        self.points, self.cells, self.low, self.high, self.asked = points, cells, low, high, asked
        self.train, self.ks, self.labels, self.d = train, ks, labels, low.shape[1]

    def _nearest(self, tree: FoldTree, x: np.ndarray, own: np.ndarray, bound: np.ndarray) -> list[list[np.ndarray]]:
        most, train, asked, out = max(self.ks), self.train, self.asked, []
        for at in range(0, len(x), TOGETHER):
            mine = slice(at, at + TOGETHER)
            out.append(tree.nearest(x[mine], most, None if train else own[mine], asked, bound[mine]))
        return out

    def at_home(self) -> DataFrame:
        """(id, x, own, bound, near, mine) of each cell's queries; ``mine``: the rows
        that ask it."""
        d, train, asked, search = self.d, self.train, np.array(self.asked), self._without_frames()

        def of_cell(points: pa.Table) -> pa.Table:
            cell = points["cell"][0].as_py()
            asks = points if train else points.filter(pa.array(np.isin(points["fold"].to_numpy(), asked)))
            every = _matrix(asks["x"].combine_chunks(), d) if len(asks) else np.zeros((0, d))
            fold, code, n = (asks[c].to_numpy() for c in ("fold", "code", "n"))
            own = np.full(len(every), -1) if train else fold
            distinct, back = np.unique(np.column_stack([every, own]), axis=0, return_inverse=True)
            x, own, back = np.ascontiguousarray(distinct[:, :d]), distinct[:, d].astype(np.int64), back.ravel()
            bound = np.full(len(x), np.inf)
            near, _ = _lists(search._nearest(_tree_of(points, d), x, own, bound))
            order = np.argsort(back, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(back, minlength=len(x)))]).astype(np.int32)
            mine = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                [pa.array(a[order]) for a in (code, fold, n)], ["code", "fold", "n"]))
            # sorted distinct queries: a cell that is computed again gives the same numbers
            number = (cell << 32) + np.arange(len(x))
            return pa.table({"id": number, "x": _rows(x, d), "own": own, "cell": np.full(len(x), cell), "bound": bound, "near": near, "mine": mine})

        return self.points.groupBy("cell").applyInArrow(of_cell, "id bigint, x array<double>, own bigint, cell bigint, bound double, "
                                                                 f"near {_NEAR}, mine array<struct<code:bigint,fold:bigint,n:bigint>>")

    def _without_frames(self) -> _Search:
        """For tasks."""
        return _Search(None, self.cells, self.low, self.high, self.asked, self.train, self.ks, self.labels)

    def _others(self) -> Column:
        """The cells, but a query's own, whose box is within its bound."""
        low, high, d = self.low, self.high, self.d

        @F.arrow_udf("array<bigint>")
        def others(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for x, home, bound in batches:
                x, home, bound = _matrix(x, d), home.to_numpy(), bound.to_numpy()
                size, cells = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)]
                for at in range(0, len(x), TOGETHER):
                    mine = slice(at, at + TOGETHER)
                    square = np.zeros((len(x[mine]), len(low)))
                    for f in range(d):
                        gap = np.maximum(np.maximum(low[:, f] - x[mine, f, None], x[mine, f, None] - high[:, f]), 0.0)
                        square += gap * gap
                    # a cell without points has an infinite box
                    within = (square <= bound[mine, None]) & np.isfinite(low[:, 0])
                    within[np.arange(len(within)), home[mine]] = False
                    size.append(within.sum(axis=1))
                    cells.append(np.nonzero(within)[1])
                yield pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(size)).astype(np.int32)), pa.array(np.concatenate(cells)))

        return others("x", "cell", "bound")

    def beyond(self, home: DataFrame) -> DataFrame:
        """(id, near): what other cells have within a query's bound."""
        d, search = self.d, self._without_frames()

        def of_cell(asks: pa.Table, points: pa.Table) -> pa.Table:
            x = _matrix(asks["x"].combine_chunks(), d) if len(asks) else np.zeros((0, d))
            near, size = _lists(search._nearest(_tree_of(points, d) if len(x) else None, x, asks["own"].to_numpy(), asks["bound"].to_numpy().copy()))
            got = pa.array(size > 0)
            return pa.table({"id": asks["id"].filter(got), "near": near.filter(got)})

        asks = home.select("id", "x", "own", "bound", F.explode(self._others()).alias("cell"))
        return asks.repartition(self.cells, "cell").groupBy("cell").cogroup(self.points.groupBy("cell")).applyInArrow(of_cell, f"id bigint, near {_NEAR}")

    def right(self) -> dict[tuple[int, int], np.ndarray]:
        """(fold left out, number of neighbours) -> rows right and rows, of the other
        folds and of its own."""
        home = keep(self.at_home())
        every = home.select("id", "near", "mine").unionByName(
            self.beyond(home).withColumn("mine", F.array().cast("array<struct<code:bigint,fold:bigint,n:bigint>>")))
        merged = every.groupBy("id").agg(F.flatten(F.collect_list("near")).alias("near"), F.flatten(F.collect_list("mine")).alias("mine"))
        ks, asked, train, labels = self.ks, self.asked, self.train, self.labels

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((len(asked), len(ks), 4), np.int64)
            for batch in batches:
                near, mine = batch["near"], batch["mine"]
                flat, size = near.flatten(), np.diff(near.offsets.to_numpy())
                row, place = np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
                square, code, fold, n = (flat.field(i).to_numpy() for i in range(4))
                order = np.lexsort((code, square, row))
                width = max(1, int(size.max(initial=0)))
                wide = [np.full((len(size), width), np.inf), *(np.zeros((len(size), width), np.int64) for _ in range(3))]
                for a, b in zip(wide, (square, code, fold, n)):
                    a[row, place] = b[order]
                asks, of = mine.flatten(), np.repeat(np.arange(len(size)), np.diff(mine.offsets.to_numpy()))
                label, home_fold, rows = (asks.field(i).to_numpy() for i in range(3))
                if not train:  # the lists have no rows of a query's own fold
                    hits = [PartitionTree.votes((wide[0], wide[1], wide[3]), k, "uniform", labels)[of] == label for k in ks]
                for i, f in enumerate(asked):
                    held = home_fold == f
                    if train:
                        without = wide[0], wide[1], np.where(wide[2] == f, 0, wide[3])
                        hits = [PartitionTree.votes(without, k, "uniform", labels)[of] == label for k in ks]
                        out[i, :, 1] += rows[~held].sum()
                    out[i, :, 3] += rows[held].sum()
                    for j, hit in enumerate(hits):
                        out[i, j, 0] += rows[hit & ~held].sum() if train else 0
                        out[i, j, 2] += rows[hit & held].sum()
            yield pa.RecordBatch.from_arrays([pa.array(out.ravel()), pa.array(np.arange(out.size))], ["v", "at"])

        sums = merged.mapInArrow(counted, "v bigint, at bigint").groupBy("at").agg(F.sum("v").alias("v")).collect()
        out = np.zeros((len(asked), len(ks), 4), np.int64)
        for r in sums:
            out.flat[r["at"]] = r["v"]
        home.unpersist()
        return {(f, k): out[i, j] for i, f in enumerate(asked) for j, k in enumerate(ks)}


def fold_accuracies(df: DataFrame, cols: Sequence[str], label: str, fold: str, folds: Sequence[int], ks: Sequence[int],
                    train: bool) -> dict[tuple[int, int], tuple[float | None, float | None]]:
    """(fold, k) -> share of right predictions of the other folds' rows (if ``train``)
    and of the fold's own rows, by the k nearest rows outside the fold (votes count
    alike).  Rows with a null feature are no points and are not counted."""
    cols, ks, d = list(cols), list(ks), len(cols)
    data = df.where(F.col(label).isNotNull() & F.col(fold).isNotNull())
    ends = {r["fold"]: r for r in data.groupBy(F.col(fold).alias("fold")).agg(
        *[f(c).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))]).collect()}
    scales: dict[tuple, list[int]] = {}
    for f in folds:
        others = [r for g, r in ends.items() if g != f]
        if not others:
            raise ValueError("there are no labelled rows")
        lo = [float(min((r[f"lo{i}"] for r in others if r[f"lo{i}"] is not None), default=0)) for i in range(d)]
        hi = [float(max((r[f"hi{i}"] for r in others if r[f"hi{i}"] is not None), default=0)) for i in range(d)]
        scales.setdefault((tuple(lo), tuple((b - a) or 1.0 for a, b in zip(lo, hi))), []).append(f)
    known = functools.reduce(operator.and_, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in cols])
    out: dict[tuple[int, int], tuple[float | None, float | None]] = {}
    names = [f"x{i}" for i in range(d)]
    for (lo, span), asked in scales.items():
        scaled = [((F.col(c) - a) / b).cast("double").alias(n) for c, n, a, b in zip(cols, names, lo, span)]
        points = keep(data.where(known).groupBy(*scaled, F.col(label).alias("label"), F.col(fold).cast("bigint").alias("fold"))
                      .agg(F.count(F.lit(1)).alias("n")))
        labels = sorted(r["label"] for r in points.select("label").distinct().collect())
        many = points.count()
        if not many:
            return {(f, k): (None, None) for f in folds for k in ks}
        share = min(1.0, SAMPLE / many)
        drawn = F.pmod(F.xxhash64(*names, "label", "fold"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
        # the sample only places the cells' borders; no point is left out
        sample = points.where(drawn).select(*names).toPandas().to_numpy(float).reshape(-1, d)
        size = min(max(many // WANTED, LEAST), MOST)
        borders = Borders(sample, min(-(-many // size), SAMPLE // 8))
        code = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col("label")) - 1
        dealt = keep(points.select(F.array(*names).alias("x"), code.cast("bigint").alias("code"), "fold", "n")
                     .withColumn("cell", _cell(borders, d)).repartition(borders.cells, "cell"))
        low, high = np.full((borders.cells, d), np.inf), np.full((borders.cells, d), np.inf)
        for r in dealt.groupBy("cell").agg(*[f(F.col("x")[i]).alias(f"{n}{i}") for i in range(d) for f, n in ((F.min, "l"), (F.max, "h"))]).collect():
            low[r["cell"]], high[r["cell"]] = [r[f"l{i}"] for i in range(d)], [r[f"h{i}"] for i in range(d)]
        points.unpersist()
        found = _Search(dealt, borders.cells, low, high, asked, train, ks, len(labels)).right()
        dealt.unpersist()
        for key, (right, rows, held_right, held) in ((k, v.tolist()) for k, v in found.items()):
            out[key] = (right / rows if rows else None, held_right / held if held else None)
    return out
