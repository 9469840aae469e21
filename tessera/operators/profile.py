"""Table profiling: shape, column info, missing values, numeric and
categorical summaries.  Each is one (or two) aggregation passes; per-column
statistics are computed on a long (column, value) projection so a single
job covers every column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ordering import wide_percentiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def shape(df: DataFrame, by: str, n_columns: dict | None = None) -> DataFrame:
    out = df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))
    if n_columns:
        cols = F.create_map(*[x for k, v in n_columns.items() for x in (F.lit(k), F.lit(v))])
        out = out.withColumn("n_cols", F.element_at(cols, F.col(by)))
    return out


def info(df: DataFrame) -> DataFrame:
    """Per column: non-null count and Spark type name."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column", "non_null")
    types = F.create_map(*[x for c, t in df.dtypes for x in (F.lit(c), F.lit(t))])
    return long.withColumn("dtype", F.element_at(types, F.col("column")))


def missing(df: DataFrame, by: str) -> DataFrame:
    """Per ``by`` value and column: number of nulls."""
    cols = [c for c in df.columns if c != by]
    wide = df.groupBy(by).agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    return wide.unpivot([by], cols, "column", "missing")


def _long(df: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    return df.select(*[F.col(c).cast(cast).alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value")


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (exact, linear) and max, one
    row per column.  Moments and the quartiles' brackets come from one aggregate
    over the columns as they are, the quartiles from one count between brackets."""
    cols = list(cols or numeric_columns(df))
    x = {c: F.col(c).cast("double") for c in cols}
    quart, found = wide_percentiles(
        df, cols, [0.25, 0.5, 0.75], ["p25", "p50", "p75"],
        *[F.struct(F.lit(c).alias("column"), F.count(x[c]).alias("count"), F.avg(x[c]).alias("mean"),
                   F.stddev_samp(x[c]).alias("std"), F.min(x[c]).alias("min"), F.max(x[c]).alias("max"))
          .alias(f"__s{i}") for i, c in enumerate(cols)])
    moments = df.sparkSession.createDataFrame(  # one row per column
        [tuple(found[f"__s{i}"]) for i in range(len(cols))], "column string, count bigint, mean double, std double, min double, max double")
    return moments.join(F.broadcast(quart), "column", "left")


def describe_categorical(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top (most frequent; ties: smallest) and its freq, all
    from one count per (column, value)."""
    cols = list(cols or string_columns(df))
    counts = _long(df, cols, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    top = F.min(F.when(known, F.struct((-F.col("n")).alias("n"), "value")))
    return counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("count"), F.count("value").alias("unique"),
        top.alias("__top")).select("column", "count", "unique", F.col("__top.value").alias("top"),
                                   (-F.col("__top.n")).alias("freq"))
