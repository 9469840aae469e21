"""Joining a one-row-per-key table to rows of which one key may have a third."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.columns import free_name

#: Rows of a key above which they are dealt over salts, and the salts.
HOT_ROWS, SALTS = 100_000, 64
#: Most hot keys that are broadcast; more are joined.
BROADCAST_KEYS = 100_000


def join_salted(rows: DataFrame, table: DataFrame, keys: list[str], n: str,
                hot_rows: int = HOT_ROWS, salts: int = SALTS) -> DataFrame:
    """``rows`` joined with ``table`` (one row per key; its column ``n`` is the
    key's number of rows and is dropped) on ``keys``, none of them null.

    The row of a key with more than ``hot_rows`` rows stands in ``table`` once
    for each salt, and its rows get a salt each, so they are dealt over many
    tasks; whichever salt a row gets, it meets one copy."""
    salt, hot = free_name(rows, "salt"), free_name(rows, "hot")
    listed = table.where(F.col(n) > hot_rows).select(*keys, F.lit(True).alias(hot))
    # keys with so many rows are few: at most all rows / hot_rows
    listed = F.broadcast(listed) if listed.count() <= BROADCAST_KEYS else listed
    every = F.when(F.col(n) > hot_rows, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = table.withColumn(salt, F.explode(every)).drop(n)
    # by what the row holds, so that a row gets its salt again after a loss; columns
    # that have no hash (maps) are left out
    told = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString() and f.name not in keys
            and "variant" not in f.dataType.simpleString()]
    spread = F.pmod(F.xxhash64(*told), F.lit(salts)).cast("int") if told else F.floor(F.rand(42) * salts).cast("int")
    dealt = rows.join(listed, keys, "left").withColumn(salt, F.when(F.col(hot), spread).otherwise(F.lit(0))).drop(hot)
    return dealt.join(copies, [*keys, salt]).drop(salt)
