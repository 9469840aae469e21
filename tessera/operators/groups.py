"""Group aggregates broadcast back to member rows, safe under key skew.

``groupby(k)[c].transform(f)`` in pandas repeats a group aggregate on every
member row.  The obvious Spark form, ``f(c).over(Window.partitionBy(k))``,
moves every row of a group into one task: one ticket holding a third of all
rows would mean one task sorting a third of the table.  Here the aggregate is
computed with ``groupBy`` (map-side partial aggregation, so a hot key costs
one partial row per map task) and joined back on the key.  The join splits hot
keys:

* every group with at least ``minRows`` rows is hot; the list of them, at most
  all rows / ``minRows``, is counted and broadcast up to ``HOT_BROADCAST`` keys,
  else joined;
* member rows of a hot key get a salt ``hash(row key) % salts`` (or of the
  per-row id); the aggregate row of a hot key is replicated ``salts`` times;
* the join is on (key, salt), so a hot key is spread over ``salts`` tasks
  instead of one.  Every other key has salt 0 and joins as usual.

Salt values never change the result: the aggregate row exists under every
salt, so whichever salt a row gets - also after a partition is recomputed
when an executor is lost - it meets exactly one copy of its group's row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import SKEW_MIN_ROWS, SKEW_SALTS, conf_int, keep

ROWS = _ROWS = "__grp_rows"
_HOT = "__grp_hot"
_SALT = "__grp_salt"
#: Most hot keys that are broadcast.
HOT_BROADCAST = 100_000


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Spreading hash of a row: of ``columns`` (e.g. the row key) when given,
    else of the per-row id - never of every column, which would force the
    scan to read columns the query does not need."""
    if columns:
        return F.xxhash64(*[F.col(c) for c in columns])
    return F.xxhash64(F.monotonically_increasing_id())


def group_stats(df: DataFrame, keys: str | Sequence[str], *aggs: Column) -> DataFrame:
    """One row per key with the given aggregates plus the group row count."""
    return df.groupBy(*_keys(keys)).agg(*aggs, F.count(F.lit(1)).alias(_ROWS))


def join_back(df: DataFrame, stats: DataFrame, keys: str | Sequence[str],
              how: str = "left", salt_by: Sequence[str] | None = None) -> DataFrame:
    """Join a one-row-per-key table ``stats`` (from ``group_stats``) to the
    member rows of ``df`` with hot keys salted (see module doc)."""
    spark = df.sparkSession
    keys = _keys(keys)
    min_rows = conf_int(spark, SKEW_MIN_ROWS, 1_000_000)
    salts = conf_int(spark, SKEW_SALTS, 64)
    if _ROWS not in stats.columns:
        raise ValueError("stats must come from group_stats (needs the row count)")
    # read again (hot keys and the join): aggregate once, keep it
    stats = keep(stats)

    hot = stats.filter(F.col(_ROWS) >= min_rows).select(*keys, F.lit(True).alias(_HOT))
    if hot.count() <= HOT_BROADCAST:
        hot = F.broadcast(hot)

    rows = (df.join(hot, keys, "left")
            .withColumn(_SALT, F.when(F.col(_HOT), F.pmod(row_hash(df, salt_by), F.lit(salts)))
                        .otherwise(F.lit(0).cast("bigint")))
            .drop(_HOT))
    fanned = (stats.join(hot, keys, "left")
              .withColumn(_SALT, F.explode(
                  F.when(F.col(_HOT), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
                  .otherwise(F.array(F.lit(0).cast("bigint")))))
              .drop(_HOT, _ROWS))
    return rows.join(fanned, keys + [_SALT], how).drop(_SALT)


def broadcast_to_rows(df: DataFrame, keys: str | Sequence[str], how: str = "left",
                      salt_by: Sequence[str] | None = None, **named: Column) -> DataFrame:
    """``df`` plus one column per named group aggregate, e.g.
    ``broadcast_to_rows(df, 'ticket', size=F.count(F.lit(1)))``."""
    stats = group_stats(df, keys, *[c.alias(n) for n, c in named.items()])
    return join_back(df, stats, keys, how=how, salt_by=salt_by)
