"""Interval bins.

pandas ``cut`` / ``qcut`` bins are right-closed ``(a, b]``; Spark's
``Bucketizer`` and ``QuantileDiscretizer`` are left-closed, so bins are
built here from expressions.  Fixed edge lists compile to one ``CASE`` chain
inside whole-stage codegen; data-derived edges (min/max, quantiles) come from
one aggregate row that is cross-joined (a single row, broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import exact_percentiles


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cut_index(x: Column | str, edges: Sequence[float], right: bool = True,
              include_lowest: bool = False) -> Column:
    """0-based bin of ``x`` for sorted ``edges``; outside the range -> null."""
    x = _c(x)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = float(edges[i]), float(edges[i + 1])
        if right:
            cond = ((x > lo) | (F.lit(include_lowest and i == 0) & (x == lo))) & (x <= hi)
        else:
            cond = (x >= lo) & ((x < hi) | (F.lit(i == len(edges) - 2) & (x == hi)))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def cut_explicit(df: DataFrame, col: str, edges: Sequence[float], name: str) -> DataFrame:
    """``cut(x, edges)``: bin index plus its (lo, hi] bounds."""
    idx = cut_index(col, edges)
    lows = F.array(*[F.lit(float(e)) for e in edges[:-1]])
    highs = F.array(*[F.lit(float(e)) for e in edges[1:]])
    return (df.withColumn(name, idx)
            .withColumn(f"{name}_lo", F.try_element_at(lows, F.col(name) + 1))
            .withColumn(f"{name}_hi", F.try_element_at(highs, F.col(name) + 1)))


def cut_equal_width(df: DataFrame, col: str, bins: int, name: str) -> DataFrame:
    """``cut(x, n)``: ``n`` equal-width bins over [min, max], right-closed,
    the lowest edge widened (so the minimum falls in bin 0).  A constant column
    gets the range widened by 0.1 % of its value to both sides (0.001 for 0)."""
    rng = df.agg(F.min(col).cast("double").alias("__ew_lo"), F.max(col).cast("double").alias("__ew_hi"))
    pad = F.when(F.col("__ew_lo") == F.col("__ew_hi"), F.when(F.col("__ew_lo") == 0, F.lit(0.001)).otherwise(
        F.abs("__ew_lo") * 0.001)).otherwise(F.lit(0.0))
    rng = rng.select((F.col("__ew_lo") - pad).alias("__ew_min"), (F.col("__ew_hi") + pad).alias("__ew_max"))
    width = (F.col("__ew_max") - F.col("__ew_min")) / bins
    raw = F.ceil(F.try_divide(F.col(col) - F.col("__ew_min"), width))
    idx = F.when(F.col(col).isNull(), None).otherwise(
        F.least(F.greatest(raw, F.lit(1)), F.lit(bins)) - 1)
    return (df.crossJoin(F.broadcast(rng))  # one row
            .withColumn(name, idx.cast("int")).drop("__ew_min", "__ew_max"))


def quantile_edges(df: DataFrame, col: str, q: int, by: Sequence[str] = ()) -> DataFrame:
    """Exact edges of ``qcut(x, q)`` as one row (per ``by`` key): e0..eq."""
    probs = [i / q for i in range(q + 1)]
    return exact_percentiles(df, col, probs, by, [f"__qe{i}" for i in range(q + 1)])


def cut_quantile(df: DataFrame, col: str, q: int, name: str) -> DataFrame:
    """``qcut(x, q)``: bin = number of inner edges strictly below x
    (right-closed bins, the minimum in bin 0); null stays null.  Equal edges are
    an error."""
    found = quantile_edges(df, col, q).first()
    edges = [found[i] for i in range(q + 1)] if found else [None] * (q + 1)
    if found and any(a == b for a, b in zip(edges, edges[1:])):
        raise ValueError(f"bin edges of {col} are not unique: {edges}")
    idx = sum((F.col(col) > F.lit(e).cast("double")).cast("int") for e in edges[1:-1])
    return df.withColumn(name, F.when(F.col(col).isNotNull(), idx))


def floor_bucket(x: Column | str, width: float) -> Column:
    """``x // width * width`` (floor division, as Python)."""
    return (F.floor(_c(x) / width) * width).cast("double")


def threshold_code(x: Column | str, cuts: Sequence[float]) -> Column:
    """Ordinal code: 0 for x <= cuts[0], 1 for x <= cuts[1], ..., len(cuts)
    above the last; null stays null."""
    x = _c(x)
    expr = F.when(x.isNull(), None)
    for i, c in enumerate(cuts):
        expr = expr.when(x <= c, F.lit(i))
    return expr.otherwise(F.lit(len(cuts)))
