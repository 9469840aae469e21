"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a document's hash; slots point to
shards.  A shard that holds more bytes than the limit is split on its next bit,
all others stay as they are, until every shard fits.  Only sums per slot are
needed for that: the first directory has a few slots per shard that the total
size calls for, and slots that are still too large get more bits in further
rounds, which look at their documents alone.

The hash is the first 60 bits of the MD5 of the id.  Rows with equal ids have
equal hashes and cannot be told apart by it, so beyond those bits a hash of the
row's number goes on (a third of all rows may have one id).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.skew import join_salted
from tessera.session import cut_lineage

BITS = 60
#: Bits of the first directory beyond those that equal shards would need, and
#: bits added in each further round.
SPARE_BITS, MORE_BITS = 3, 6
#: Rows of a directory that is broadcast; a longer one is joined.
BROADCAST_ROWS = 100_000


def id_hash(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id as text (null: of the empty
    text)."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("bigint")


def _slot(level: int) -> list[Column]:
    """The first ``level`` bits of the key (h, then u) as two numbers."""
    return [F.shiftright("h", BITS - min(level, BITS)).alias("p"),
            (F.shiftright("u", 2 * BITS - level) if level > BITS else F.lit(0).cast("bigint")).alias("q")]


def _directory(rows: DataFrame, level: int, above: int, limit: int) -> DataFrame:
    """One row per slot of ``level`` bits that has documents: p, q, and the
    shard it points to as depth, shard_bytes and shard_docs (null: its
    documents do not fit at this level).  Shards have more than ``above`` bits
    (none fits there)."""
    sums = cut_lineage(rows.groupBy(*_slot(level)).agg(
        F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs")))
    at = sums.select("p", "q", "bytes", "docs",
                     F.explode(F.sequence(F.lit(above + 1), F.lit(level))).alias("depth"))
    low = min(level, BITS)
    at = at.withColumn("np", F.expr(f"shiftright(p, greatest(0, {low} - depth))")).withColumn(
        "nq", F.expr(f"CASE WHEN depth <= {BITS} THEN 0L ELSE shiftright(q, {level} - depth) END"))
    nodes = at.groupBy("depth", "np", "nq").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
    # a document that is too large by itself is a shard of its own
    fits = nodes.where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1))
    return (at.join(fits, ["depth", "np", "nq"], "left").groupBy("p", "q")
            .agg(F.min_by(F.struct("depth", "shard_bytes", "shard_docs"),
                          F.when(F.col("shard_bytes").isNotNull(), F.col("depth"))).alias("shard"), F.max("docs").alias("n")))


def _joined(rows: DataFrame, directory: DataFrame, level: int) -> DataFrame:
    placed = rows.withColumns({c: v for c, v in zip(("p", "q"), _slot(level))})
    if directory.count() <= BROADCAST_ROWS:
        return placed.join(F.broadcast(directory.drop("n")), ["p", "q"])
    return join_salted(placed, directory, ["p", "q"], "n")  # all rows of one id share a slot


def assign_shards(docs: DataFrame, limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8; null text: 0),
    shard (its hash prefix in bits, empty for a single shard), depth,
    shard_bytes, shard_docs, oversize.

    Every shard holds at most ``limit`` bytes, but for single documents of more
    (oversize).  Which of several rows with one id goes where is fixed once,
    not by their content.  Further columns are not read; an empty table gives
    no rows."""
    if limit < 1:
        raise ValueError("limit must be at least 1 byte")
    rows = cut_lineage(docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("bigint").alias("n_bytes"),
        id_hash(F.col(doc_id)).alias("h"),
        F.shiftright(F.xxhash64(F.monotonically_increasing_id()), 64 - BITS).bitwiseAND(F.lit((1 << BITS) - 1)).alias("u")))
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    above, level = -1, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE_BITS)
    done = None
    while True:
        directory = cut_lineage(_directory(rows, level, above, limit))
        found = _joined(rows, directory, level)
        fitting = found.where("shard is not null").select(
            "doc_id", "n_bytes", F.substring(F.concat(
                F.lpad(F.bin("h"), BITS, "0"), F.lpad(F.bin("u"), BITS, "0")), F.lit(1), F.col("shard.depth")).alias("shard_bits"),
            "shard.depth", "shard.shard_bytes", "shard.shard_docs")
        done = fitting if done is None else done.unionByName(fitting)
        if directory.where("shard is null").isEmpty():
            break
        if level == 2 * BITS:
            raise ValueError(f"some documents agree in all {2 * BITS} bits and exceed {limit} bytes together")
        rows = cut_lineage(found.where("shard is null").select("doc_id", "n_bytes", "h", "u"))
        above, level = level, min(2 * BITS, level + MORE_BITS)
    return done.select("doc_id", "n_bytes", F.col("shard_bits").alias("shard"), "depth", "shard_bytes", "shard_docs",
                       (F.col("shard_bytes") > limit).alias("oversize"))


def write_shards(docs: DataFrame, shards: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """Writes ``docs`` (unique ids) as Parquet, a folder per shard, named ``b``
    and its bits (so they are read back as text)."""
    (docs.join(shards.select(F.col("doc_id").alias(doc_id), F.concat(F.lit("b"), "shard").alias("shard")), doc_id)
     .repartition("shard").write.partitionBy("shard").parquet(path))
