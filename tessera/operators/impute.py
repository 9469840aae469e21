"""Missing-value imputation: fitted statistics are computed once (on the
rows the caller designates as training rows) and applied as column
expressions.  Scalar statistics travel as a one-row DataFrame that is
cross-joined (broadcast of a single row); per-group statistics are joined
back with hot groups salted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.draws import draw_int
from tessera.operators.aggregate import mode_table
from tessera.operators.groups import ROWS, join_back
from tessera.operators.ordering import exact_median, exact_percentiles


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def _with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    return df.crossJoin(F.broadcast(scalars))  # a single row


def fill_global_median(df: DataFrame, col: str, fit: DataFrame | None = None) -> DataFrame:
    """Nulls of ``col`` <- exact median of ``col`` over ``fit`` (default: df)."""
    med = exact_median(fit if fit is not None else df, col, name="__med")
    return (_with_scalars(df, med)
            .withColumn(col, F.coalesce(F.col(col), F.col("__med").cast(df.schema[col].dataType)))
            .drop("__med"))


def fill_mode(df: DataFrame, cols: Sequence[str], fit: DataFrame | None = None) -> DataFrame:
    """Each column's nulls <- its most frequent value over ``fit`` (ties:
    smallest value)."""
    src = fit if fit is not None else df
    out = df
    for c in cols:
        mode = mode_table(src, [], c).select(F.col("mode").alias(f"__mode_{c}"))
        out = _with_scalars(out, mode).withColumn(c, F.coalesce(F.col(c), F.col(f"__mode_{c}"))) \
            .drop(f"__mode_{c}")
    return out


def fill_group_median(df: DataFrame, col: str, by: Sequence[str],
                      fit: DataFrame | None = None) -> DataFrame:
    """Nulls of ``col`` <- exact median of its (``by``) group."""
    by = list(by)
    src = fit if fit is not None else df
    med = exact_percentiles(src, col, [0.5], by, ["__gmed"])
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias(ROWS))
    stats = sizes.join(med, by, "left")
    return (join_back(df, stats, by)
            .withColumn(col, F.coalesce(F.col(col), F.col("__gmed")))
            .drop("__gmed"))


def fill_cell_median(df: DataFrame, col: str, cell: Column,
                     fit: DataFrame | None = None) -> DataFrame:
    """Nulls of ``col`` <- median of ``col`` over the rows where ``cell`` holds."""
    src = (fit if fit is not None else df).filter(cell)
    return fill_global_median(df, col, src)


def fill_random_range(df: DataFrame, col: str, key: str, seed: int = 42,
                      fit: DataFrame | None = None) -> DataFrame:
    """Nulls <- integer drawn from [int(mean - std), int(mean + std)) by a
    hash of (seed, key); the column is then truncated to int."""
    src = fit if fit is not None else df
    st = src.agg(F.avg(col).alias("__mu"), F.stddev_samp(col).alias("__sd")).select(
        (F.col("__mu") - F.col("__sd")).cast("bigint").alias("__lo"),
        (F.col("__mu") + F.col("__sd")).cast("bigint").alias("__hi"))
    drawn = draw_int(key, seed, F.col("__lo"), F.col("__hi"))
    return (_with_scalars(df, st)
            .withColumn(col, F.coalesce(F.col(col).cast("bigint"), drawn).cast("int"))
            .drop("__lo", "__hi"))
