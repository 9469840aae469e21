"""Lookups and corrections by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.groups import ROWS, group_stats, join_back


def patch_rows(df: DataFrame, patches: DataFrame, key: str, cols: Sequence[str],
               small: bool = False) -> DataFrame:
    """Replace ``cols`` of the rows named in ``patches`` (key + new values).
    ``small=True`` broadcasts the patch table: use it only for a literal,
    hand-written list; a data-derived patch table is joined by shuffle."""
    p = patches.select(key, *[F.col(c).alias(f"__patch_{c}") for c in cols])
    joined = df.join(F.broadcast(p) if small else p, key, "left")
    for c in cols:
        joined = joined.withColumn(c, F.coalesce(F.col(f"__patch_{c}"), F.col(c)))
    return joined.drop(*[f"__patch_{c}" for c in cols])


def lookup_with_default(df: DataFrame, table: DataFrame, key: str, value: str,
                        default: Column, out: str, flag: str) -> DataFrame:
    """Look ``key`` up in ``table`` (key, value; one row per key): hit -> value
    and flag 1, miss -> ``default`` (a column, e.g. a one-row broadcast scalar)
    and 0.  Keys with many rows are salted by the row counts of ``table``
    (``group_stats``), which is taken of ``df`` if it has none."""
    if ROWS not in table.columns:
        table = group_stats(df.select(key).filter(F.col(key).isNotNull()), key).join(table, key)
    t = table.select(key, F.col(value).alias("__lk_v"), F.lit(1).alias("__lk_hit"), ROWS)
    return (join_back(df, t, key)
            .withColumn(out, F.coalesce(F.col("__lk_v"), default))
            .withColumn(flag, F.coalesce(F.col("__lk_hit"), F.lit(0)))
            .drop("__lk_v", "__lk_hit"))
