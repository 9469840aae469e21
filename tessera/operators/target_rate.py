"""Target-rate encoding of group keys (families, tickets).

Per key: the median label over the labelled rows, kept only when the key
occurs in both the labelled and the unlabelled part and the key's median
group size exceeds 1; every other row gets the labelled mean and a 0 flag.
One fold by key counts rows, parts, labels and sizes, from which both medians
follow; the key table reaches the rows by a join with hot keys salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.groups import ROWS
from tessera.operators.joins import lookup_with_default


def key_rates(df: DataFrame, is_train: Column, key: str, label: str, size: str | None) -> DataFrame:
    """(key, __rate, row count) of the keys that qualify.  ``label`` is 0 or 1;
    ``size`` a whole number from 1 on (None: the key's number of rows).

    The median label is 1, 0 or, in a draw, 0.5.  The median size exceeds 1 unless
    more than half of the labelled rows have size 1."""
    train = F.count(F.when(is_train, 1))
    single = F.count(F.when(is_train & (F.col(size) <= 1), 1)) if size else F.when(F.count(F.lit(1)) <= 1, train).otherwise(F.lit(0))
    keys = (df.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias(ROWS), train.alias("n_train"), F.count(F.when(~is_train, 1)).alias("n_test"),
                 F.count(F.when(is_train & (F.col(label) == 1), 1)).alias("n1"),
                 F.count(F.when(is_train & (F.col(label) == 0), 1)).alias("n0"), single.alias("single"))
            # of an even number the larger of the two middle sizes decides
            .filter((F.col("n_train") > 0) & (F.col("n_test") > 0) & (F.col("single") <= F.floor(F.col("n_train") / 2))))
    median = F.when(F.col("n1") > F.col("n0"), 1.0).when(F.col("n1") < F.col("n0"), 0.0).when(F.col("n1") > 0, 0.5)
    return keys.select(key, median.alias("__rate"), ROWS)


def target_rate_encode(df: DataFrame, is_train: Column, key: str, label: str, size: str | None,
                       out: str, flag: str) -> DataFrame:
    table = key_rates(df, is_train, key, label, size)
    mean = df.filter(is_train).agg(F.avg(label).alias("__mean"))
    return lookup_with_default(df.crossJoin(F.broadcast(mean)), table, key, "__rate",  # one-row mean
                               F.col("__mean"), out, flag).drop("__mean")
