"""Group ("same ticket") analytics: null-aware group rates, group sizes and
their roll-up to (class, size)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.nulls import rate


def group_rate_by_size(df: DataFrame, group: str = "ticket", label: str = "label",
                       cls: str = "cls", top: int = 3, digits: int = 6) -> DataFrame:
    """Per group: null-aware label rate (x100) and size; per (class, size): the
    mean of the member rows' group rate; the ``top`` best sizes per class.

    Rows are first folded to (group, class) partial counts, so the shuffle
    carries aggregates, never member rows, and a hot group is one row per
    class.  Group totals are a window over that folded table (at most one row
    per class in a window partition), so the input is scanned once and no
    join is needed.  The row-level mean is rebuilt exactly as
    sum(rate * rows) / rows-with-rate.
    """
    part = df.groupBy(group, cls).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(label).alias("s"),
        F.count(label).alias("c"))
    g = Window.partitionBy(group)
    per_group = part.select(
        cls, "n", F.sum("n").over(g).alias("team_size"),
        (rate(F.sum("s").over(g), F.sum("c").over(g)) * 100).alias("rate"))
    by_size = (per_group
               .groupBy(cls, "team_size")
               .agg(rate(F.sum(F.col("rate") * F.col("n")),
                         F.sum(F.when(F.col("rate").isNotNull(), F.col("n")))).alias("mean_rate")))
    ranked = by_size.withColumn("mean_rate", F.round("mean_rate", digits))
    w = Window.partitionBy(cls).orderBy(F.col("mean_rate").desc_nulls_last(), F.col("team_size").desc())
    return (ranked.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= top).drop("_rn"))
