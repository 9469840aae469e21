"""Aggregates whose naive form would funnel a big group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.groups import row_hash


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    salts: int = 64, salt_by: Sequence[str] | None = None) -> DataFrame:
    """Rows ranked 1..n per ``keys`` in ``order`` (give a total order).

    Two phases: the top n inside each (key, hash bucket) - a bucket holds
    1/salts of a group - then the top n of those at most ``salts * n``
    candidates per key.  Exact, since a group's top n is contained in the union
    of its buckets' top n."""
    keys = list(keys)
    bucket = F.pmod(row_hash(df, salt_by), F.lit(salts))
    w1 = Window.partitionBy(*keys, "__tn_b").orderBy(*order)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__tn_b", bucket)
            .withColumn("__tn_r", F.row_number().over(w1))
            .filter(F.col("__tn_r") <= n)
            .withColumn("__tn_r", F.row_number().over(w2))
            .filter(F.col("__tn_r") <= n)
            .drop("__tn_b", "__tn_r"))


def mode_table(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent non-null ``value`` per key (ties: smallest value), with its
    count.  Two aggregations, both partial: counts per (key, value), then per
    key ``min_by(value, (-count, value))`` - no join or window that would put
    all values of one key (say, every distinct name) into one task."""
    keys = list(keys)
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__m_cnt")))
    order = F.struct((-F.col("__m_cnt")).alias("c"), F.col(value).alias("v"))
    return counts.groupBy(*keys).agg(F.min_by(F.col(value), order).alias("mode"),
                                     F.max("__m_cnt").alias("freq"))


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
