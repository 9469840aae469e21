"""Near-duplicate components of documents by SimHash and a Gray-order index.

Fingerprints are computed per text, then only distinct fingerprints are
compared.  Their index is hierarchical:

* fingerprints are sorted by Gray rank (the position of a code in the Gray
  sequence, where neighbours differ in one bit), so that neighbours in the
  order share bits;
* runs of the order are groups; a group's node holds the bits on which all its
  members agree (a mask and a pattern).  Groups of groups form upper nodes, and
  a node keeps only the bits that its parent does not hold already;
* a query goes down with the differences it has gathered so far and leaves a
  whole group as soon as they exceed the limit.

Two codes that differ in few bits differ in at most half as many in one of
their halves.  So the index is built twice, over the codes and over the codes
with their halves exchanged, and each leaves a group also when the first half
has gathered more than half of the limit.  A code then meets the groups around
it in proportion to the depth of the index, not to its square.

The top of the index, at most ``MOST_BLOCKS`` nodes, is broadcast and sends each
fingerprint to the blocks that may hold a neighbour.  Blocks are searched where
they are: a task builds the lower levels over the block's members.  Instead of
all pairs a task gives one link from a query to each connected part of its
block, so a dense group costs links in proportion to its members.  Links go
through a distributed star contraction to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.llm.columns import RunFn, free_name, struct_of
from tessera.llm.skew import HOT_ROWS, join_salted
from tessera.session import cut_lineage

SEED = 42
#: Members of a block aimed at, and most blocks (the broadcast top of the
#: index): with more fingerprints blocks get larger, not more.
BLOCK_MEMBERS, MOST_BLOCKS = 8192, 1 << 14
#: Children of a node.
FAN_OUT = 16
#: Queries of a block that one task takes on; more are dealt over slices.
SLICE_QUERIES = 1 << 18
#: Pairs of query and node looked at together.
FRONTIER = 1 << 20


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of each shingle of ``width`` words (lower case A-Z, split at
    ASCII white space), repeats included; of all words if they are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(line, SEED)], np.uint64)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends[:-width]]]
    return np.array([digest(line[s:e], SEED) for s, e in zip(starts, ends[width - 1:])], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, hashes.size, 1 << 15):
        part = hashes[at:at + (1 << 15)].astype(">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > hashes.size)
    return int.from_bytes(bits.tobytes(), "big")


_SCHEMA = T.StructType([T.StructField("fp", T.LongType())])


def fingerprints(text: Column, width: int) -> Column:
    """The fingerprint of a text as a signed 64-bit number (null: 0)."""
    def make() -> RunFn:
        def work(run: list[bytes | None]) -> dict:
            got = np.array([fingerprint(shingle_hashes(t or b"", width)) for t in run], np.uint64)
            return {"fp": got.view(np.int64)}
        return work
    return struct_of(text, _SCHEMA, make)["fp"]


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence: bit k is the parity of the
    code's bits from the top down to k."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def _ranked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for codes in batches:
        rank = gray_rank(codes.to_numpy(np.int64).view(np.uint64))
        yield pd.Series((rank ^ np.uint64(1 << 63)).view(np.int64))  # signed order is the rank's


class GrayIndex:
    """The hierarchy over nodes sorted by Gray rank.  A leaf is a pattern on a
    mask (for single fingerprints the mask is all bits)."""

    def __init__(self, pattern: np.ndarray, mask: np.ndarray):
        levels = [(pattern, mask)]
        while levels[-1][0].size > FAN_OUT:
            p, m = levels[-1]
            heads = np.arange(0, p.size, FAN_OUT)
            # bits on which all children agree: known to all and never different
            every = np.bitwise_and.reduceat(m, heads)
            low, high = np.bitwise_and.reduceat(p, heads), np.bitwise_or.reduceat(p & m, heads)
            shared = every & ~(low ^ high)
            levels.append((low & shared, shared))
        #: from the top: patterns, and the bits that the parent does not hold
        self.levels = []
        for k, (p, m) in enumerate(levels):
            above = np.repeat(levels[k + 1][1], FAN_OUT)[:p.size] if k + 1 < len(levels) else np.uint64(0)
            self.levels.append((p, m & ~above))
        self.levels.reverse()

    def search(self, queries: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query number, leaf number) that differ in at most ``limit``
        of the leaf's bits and in at most half of it in the first 32, in runs
        of bounded size, queries ascending."""
        width = max(1, FRONTIER // (FAN_OUT * 64))
        tops = np.arange(self.levels[0][0].size)
        for at in range(0, queries.size, width):
            codes = queries[at:at + width]
            q = np.repeat(np.arange(codes.size), tops.size)
            none = np.zeros(q.size, np.uint8)
            for a, b in self._down(codes, q, np.tile(tops, codes.size), none, none, 0, limit):
                yield at + a, b

    def _down(self, codes, q, node, gone, first, level, limit):
        """``gone``: differences so far, ``first``: those in the first half."""
        while q.size:
            pattern, mask = self.levels[level]
            differ = (codes[q] ^ pattern[node]) & mask[node]
            gone = gone + np.bitwise_count(differ)
            first = first + np.bitwise_count(differ >> np.uint64(32))
            near = np.flatnonzero((gone <= limit) & (first <= limit // 2))
            q, node, gone, first = q[near], node[near], gone[near], first[near]
            level += 1
            if level == len(self.levels):
                if q.size:
                    yield q, node
                return
            if q.size * FAN_OUT > FRONTIER and q[0] != q[-1]:  # too wide: halves of the queries
                half = int(np.searchsorted(q, (int(q[0]) + int(q[-1]) + 1) // 2))
                for part in (slice(0, half), slice(half, None)):
                    yield from self._down(codes, *self._children(q[part], node[part], gone[part], first[part], level),
                                          level, limit)
                return
            q, node, gone, first = self._children(q, node, gone, first, level)

    def _children(self, q, node, gone, first, level):
        child = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
        real = child < self.levels[level][0].size
        return tuple(np.repeat(x, FAN_OUT)[real] if x is not node else child[real] for x in (q, node, gone, first))


class _Parts:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            above = self.up[self.up]
            if np.array_equal(above, self.up):
                return self.up
            self.up = above

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unites a[i] with b[i], all at once: the larger root of each pair is
        hung under the smaller until every pair agrees."""
        while a.size:
            up = self.roots()
            ra, rb = up[a], up[b]
            on = ra != rb
            a, b, ra, rb = a[on], b[on], ra[on], rb[on]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))


FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def block_links(members: np.ndarray, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within a block (each member to the first of its connected part)
    and from ``queries`` (distinct, elsewhere at home) to each connected part
    that has a neighbour of theirs."""
    members = members[np.argsort(gray_rank(members), kind="stable")]
    index = GrayIndex(members, np.full(members.size, FULL))
    parts = _Parts(members.size)
    for q, node in index.search(members, limit):
        parts.join(q, node)
    root = parts.roots()
    own = np.flatnonzero(root != np.arange(members.size))
    left, right = [members[own]], [members[root[own]]]
    for q, node in index.search(queries, limit):
        pair = np.unique(q.astype(np.int64) << 32 | root[node])
        left.append(queries[pair >> 32])
        right.append(members[pair & 0xFFFFFFFF])
    return np.concatenate(left), np.concatenate(right)


def exchanged(code: Column) -> Column:
    """A code with its halves exchanged."""
    return F.shiftleft(code, 32).bitwiseOR(F.shiftrightunsigned(code, 32))


def near_links(codes: DataFrame, limit: int, block: int = BLOCK_MEMBERS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect
    exactly those that chains of neighbours at ``limit`` bits connect.

    Both indexes go through the same steps: ``side`` 1 has the codes with their
    halves exchanged, and its blocks are numbered on from ``MOST_BLOCKS``."""
    spark = codes.sparkSession
    rank = F.pandas_udf(_ranked, "bigint")
    both = codes.select(F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("fp").alias("fp")),
        F.struct(F.lit(1).alias("side"), exchanged(F.col("fp")).alias("fp")))).alias("x")).select("x.side", "x.fp")
    ranked = cut_lineage(both.select("side", "fp", rank("fp").alias("rank")))
    n = ranked.count() // 2
    if n < 2:
        return spark.createDataFrame([], "a bigint, b bigint")
    blocks = int(min(MOST_BLOCKS, max(1, -(-n // block))))
    # any cuts give right results; these deal the ranks about evenly
    shares = [k / blocks for k in range(1, blocks)] or [0.0]
    found = {r["side"]: r["cuts"] for r in ranked.groupBy("side").agg(
        F.percentile_approx("rank", shares, 4 * blocks).alias("cuts")).collect()}
    cuts = spark.sparkContext.broadcast([np.array(sorted(set(found[s])), np.int64) for s in (0, 1)])

    @F.pandas_udf("int")
    def home(side: pd.Series, ranks: pd.Series) -> pd.Series:
        side, ranks = side.to_numpy(), ranks.to_numpy(np.int64)
        return pd.Series(np.where(side == 0, np.searchsorted(cuts.value[0], ranks, side="right"),
                                  np.searchsorted(cuts.value[1], ranks, side="right") + MOST_BLOCKS).astype(np.int32))

    members = ranked.select("fp", home("side", "rank").alias("block"))
    top = members.groupBy("block").agg(F.bit_and("fp").alias("low"), F.bit_or("fp").alias("high")).orderBy("block").collect()
    indexes = []
    for side in (0, 1):
        rows = [r for r in top if r["block"] // MOST_BLOCKS == side]
        low, high = (np.array([r[c] for r in rows], np.int64).view(np.uint64) for c in ("low", "high"))
        mask = ~(low ^ high)
        indexes.append((GrayIndex(low & mask, mask), np.array([r["block"] for r in rows], np.int32)))
    index = spark.sparkContext.broadcast(indexes)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for side, (nodes, names) in enumerate(index.value):
                home_block = batch.column(1).to_numpy()
                here = home_block // MOST_BLOCKS == side
                fp, at = batch.column(0).to_numpy()[here], np.searchsorted(names, home_block[here])
                for q, node in nodes.search(fp.view(np.uint64), limit):
                    on = node >= at[q]  # a pair of blocks is searched from the lower one
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(fp[q[on]]), pa.array(names[node[on]]), pa.array(node[on] == at[q[on]])],
                        names=["fp", "block", "own"])

    sent = members.mapInArrow(send, "fp bigint, block int, own boolean")
    # queries of a block are dealt over slices, each with all members of the block
    many = {r["block"]: r["n"] for r in sent.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    slices = spark.sparkContext.broadcast({b: -(-c // SLICE_QUERIES) for b, c in many.items()})

    @F.pandas_udf("array<int>")
    def deal(fp: pd.Series, b: pd.Series, own: pd.Series) -> pd.Series:
        count = b.map(slices.value).to_numpy()
        one = (fp.to_numpy(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % count.astype(np.uint64)
        return pd.Series([list(range(c)) if o else [int(k)] for c, k, o in zip(count, one, own)])

    dealt = sent.select("fp", "block", "own", F.explode(deal("fp", "block", "own")).alias("slice"))

    def link(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().view(np.uint64)
        own = group.column("own").to_numpy(zero_copy_only=False)
        a, b = block_links(fp[own], fp[~own], limit)
        if group.column("block")[0].as_py() >= MOST_BLOCKS:  # back to the codes as they are
            a, b = ((x << np.uint64(32)) | (x >> np.uint64(32)) for x in (a, b))
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return dealt.groupBy("block", "slice").applyInArrow(link, "a bigint, b bigint")


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as stars: each node to the least of its part."""
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy()])
        b = np.concatenate([b, batch.column(1).to_numpy()])
        if a.size > 1 << 20:
            a, b = _stars(a, b)
            if a.size > 1 << 19:  # all in use: pass on, the next round goes on
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                a = b = np.zeros(0, np.int64)
    a, b = _stars(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    nodes, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    parts = _Parts(nodes.size)
    parts.join(which[:a.size], which[a.size:])
    root = parts.roots()  # nodes are sorted, so a root is the least of its part
    on = np.flatnonzero(root != np.arange(nodes.size))
    return nodes[on], nodes[root[on]]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not the least of
    its component; root is that least node.

    Each round replaces a node's links by links to the least node it is linked
    with (alternating large and small stars), after every task has contracted
    the links it holds.  It ends when all links are stars."""
    stars = cut_lineage(links.mapInArrow(_contracted, "a bigint, b bigint").distinct())
    while True:
        # a > b always; a star has no node that is both
        tops = stars.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n"))
        inner = stars.select(F.col("b").alias("a")).distinct().join(stars.select("a").distinct(), "a", "left_semi")
        if tops.where("n > 1").isEmpty() and inner.isEmpty():
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        # small star: the smaller neighbours of a node are linked with the least of them
        small = (stars.join(tops.select("a", "least"), "a")
                 .select(F.explode(F.array(F.struct("a", F.col("least").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("x"))
                 .select("x.a", "x.b").where("a <> b"))
        small = cut_lineage(small.mapInArrow(_contracted, "a bigint, b bigint").distinct())
        # large star: the larger neighbours of a node are linked with its least neighbour or itself
        least = small.groupBy("a").agg(F.min("b").alias("least"))
        large = (small.join(least.select(F.col("a").alias("b"), F.col("least").alias("up")), "b", "left")
                 .select("a", F.coalesce("up", "b").alias("b"))
                 .unionByName(least.select("a", F.col("least").alias("b"))))
        stars = cut_lineage(large.repartition("a").mapInArrow(_contracted, "a bigint, b bigint").distinct())


def component_ids(rows: DataFrame, limit: int, hot_rows: int = HOT_ROWS, block: int = BLOCK_MEMBERS) -> DataFrame:
    """``rows`` (doc_id, fp, ...) with component_id, the smallest doc_id among
    all rows reachable (null if they have none), and root, a number of the
    component."""
    rows = cut_lineage(rows)
    codes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    parts = components(near_links(codes.select("fp"), limit, block))
    rooted = codes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = cut_lineage(rooted.join(ids, "root").select("fp", "component_id", "root", "n"))
    # a fingerprint may stand in a third of all rows
    return join_salted(rows, known, ["fp"], "n", hot_rows)


def near_duplicates(docs: DataFrame, width: int = 3, limit: int = 2, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits),
    component_id.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other.  Repeated rows are given back each; a component without any doc_id
    has a null component_id.  Further columns are not read."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), width).alias("fp"))
    return component_ids(rows, limit).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, width: int = 3, limit: int = 2, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``docs`` with one row of every component, all columns as they are: that
    of the smallest doc_id; among equal ids that of the least text hash.

    Rows are told apart by doc_id and text; of fully equal ones one stays."""
    th = F.xxhash64(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), th.alias("th"), fingerprints(F.col(text), width).alias("fp"))
    first = (component_ids(rows, limit).groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("th").alias("th"))).alias("k"))
             .select("k.id", "k.th"))
    # the texts are shuffled once, on the key that also tells equal rows apart
    text_key, id_key, row = free_name(docs, "text_key"), free_name(docs, "id_key"), free_name(docs, "row")
    as_key = lambda c: F.coalesce(c.cast("string"), F.lit("\0null"))
    chosen = cut_lineage(first.select(as_key(F.col("id")).alias(id_key), F.col("th").alias(text_key)))
    kept = docs.withColumns({id_key: as_key(F.col(doc_id)), text_key: th}).join(chosen, [id_key, text_key], "left_semi")
    return (kept.withColumn(row, F.row_number().over(Window.partitionBy(id_key, text_key).orderBy(id_key)))
            .where(F.col(row) == 1).select(*[F.col(f"`{c}`") for c in docs.columns]))
