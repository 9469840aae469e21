"""A Merkle manifest of a dataset, and proofs of its rows by octopus multiproofs.

Every row is a leaf (SHA-256 over its fields).  The leaves of a group (a
language) in the order of their ids form a binary tree: two consecutive nodes
become their hash, a last single one the hash of itself, until one node, the
group's subroot, remains.  The subroots in the order of their groups form one
more such tree, whose last node is the root.

Trees are built from runs of 2 ** ``HEIGHT`` consecutive nodes, one task working
on some runs at a time; the tops of the runs are the next round's nodes, so even
one group of 10 ** 10 rows takes three rounds.

Proofs are made per partition of leaves (a run of consecutive ones).  From the
leaves that it is to prove a partition computes which nodes' coordinates (level,
position) are missing: the minimal set that, together with nodes derived from its
own leaves, gives the root.  They are fetched once for the partition, shared
interior nodes are derived once, and each row's own proof is expanded locally.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import row_number
from tessera.session import cut_lineage

#: Levels of a run; a run has at most 2 ** HEIGHT nodes.
HEIGHT = 12
#: Most nodes above the runs that are broadcast; more are joined, those of many
#: partitions (from HOT_LEVEL up) once for each of SALTS.
BROADCAST_NODES, HOT_LEVEL, SALTS = 100_000, 24, 64
#: Name of the tree of subroots; a group's tree is ``GROUP`` + its name or ``NULL``.
TOP, NULL, GROUP = "", "-", "="

NODE = "tree string, level int, at bigint, digest string"


def digest(*parts: str) -> str:
    """Lower-case hex SHA-256 of the parts one after another."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields: ``-`` if null, else UTF-8 byte count, ``:``, value."""
    shown = []
    for f in fields:
        f = f.cast("string")
        shown.append(F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")))
    return F.sha2(F.concat(*shown), 256)


def sizes(n: int) -> list[int]:
    """Nodes of each level of a tree over ``n`` leaves."""
    out = [n]
    while out[-1] > 1:
        out.append((out[-1] + 1) // 2)
    return out


def missing(at: list[int], n: int) -> list[tuple[int, int]]:
    """Coordinates of the nodes that the leaves ``at`` lack to give the root of a
    tree over ``n`` leaves, none of which can be derived from them."""
    out = []
    known = sorted(set(at))
    for level, size in enumerate(sizes(n)[:-1]):
        have = set(known)
        out += [(level, k ^ 1) for k in known if k ^ 1 not in have and k ^ 1 < size]
        known = sorted({k >> 1 for k in known})
    return out


def derive(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> list[dict[int, str]]:
    """All nodes, by level, that follow from ``leaves`` and the fetched ones; the
    last level holds the root."""
    found = [dict(leaves)]
    count = sizes(n)
    for level, size in enumerate(count):
        here = found[level]
        here.update({at: d for (lv, at), d in fetched.items() if lv == level})
        if level + 1 < len(count):
            above = {}
            for k in {k >> 1 for k in here}:
                run = [here.get(2 * k)] + ([here.get(2 * k + 1)] if 2 * k + 1 < size else [])
                if None not in run:
                    above[k] = digest(*run)
            found.append(above)
    return found


def siblings(at: int, nodes: list[dict[int, str]], n: int) -> list[str | None]:
    """The other node of the run of ``at`` at every level (none: None)."""
    out = []
    for level, size in enumerate(sizes(n)[:-1]):
        out.append(nodes[level][at ^ 1] if at ^ 1 < size else None)
        at >>= 1
    return out


def fold(leaf: str, at: int, others: list[str | None]) -> str:
    """The root that a leaf at position ``at`` gives with its siblings."""
    for other in others:
        leaf = digest(leaf) if other is None else digest(other, leaf) if at & 1 else digest(leaf, other)
        at >>= 1
    return leaf


def _runs(height: int):
    """One task's runs: all nodes above the given ones; the last is the top."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"tree": [], "level": [], "at": [], "digest": []}
            for row in batch.to_pylist():
                nodes = [d["digest"] for d in sorted(row["nodes"], key=lambda d: d["at"])]
                level, at = row["level"], row["first"]
                alone = row["n"] <= 1 << height  # the whole tree at this level
                for up in range(height):
                    if alone and len(nodes) == 1:
                        break
                    nodes = [digest(*nodes[k:k + 2]) for k in range(0, len(nodes), 2)]
                    at >>= 1
                    out["tree"] += [row["tree"]] * len(nodes)
                    out["level"] += [level + up + 1] * len(nodes)
                    out["at"] += range(at, at + len(nodes))
                    out["digest"] += nodes
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("tree", pa.string()), ("level", pa.int32()), ("at", pa.int64()), ("digest", pa.string())]))
    return work


def grow(leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """All nodes of the trees over ``leaves`` (tree, at, digest; positions from 0
    without a gap): tree, level (leaves: 0), at, digest."""
    nodes = leaves.select("tree", F.lit(0).alias("level"), "at", "digest")
    parts, base, level = [nodes], nodes, 0
    while True:
        count = base.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
        runs = (base.groupBy("tree", F.shiftright("at", height).alias("run"))
                .agg(F.collect_list(F.struct("at", "digest")).alias("nodes")))
        # a row of a run is as wide as its 2 ** height nodes
        runs = (runs.join(count.where("n > 1"), "tree")
                .select("tree", F.lit(level).alias("level"), F.shiftleft("run", height).alias("first"), "n", "nodes"))
        above = cut_lineage(runs.mapInArrow(_runs(height), NODE))
        parts.append(above)
        level += height
        base = above.where(F.col("level") == level)
        if base.groupBy("tree").count().where("count > 1").limit(1).count() == 0:
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def tree_of(group: Column) -> Column:
    return F.coalesce(F.concat(F.lit(GROUP), group.cast("string")), F.lit(NULL))


class Manifest:
    """``leaves``: the rows with tree, at and digest; ``trees``: tree, n, rank,
    subroot; ``nodes``: all nodes; ``root``: None if there is no row."""

    def __init__(self, leaves: DataFrame, trees: DataFrame, nodes: DataFrame, root: str | None, n_trees: int):
        self.leaves, self.trees, self.nodes, self.root, self.n_trees = leaves, trees, nodes, root, n_trees


def build(rows: DataFrame, group: str, order: list[str], leaf: str, height: int = HEIGHT) -> Manifest:
    """The manifest of ``rows``; ``leaf`` is their digest's column.  Within a group
    (null is one) leaves ascend by ``order``, nulls first; that must tell rows
    with different leaves apart.  Rows should be written down before."""
    keyed = rows.withColumn("tree", tree_of(F.col(group)))
    numbered = cut_lineage(row_number(keyed, order, ["tree"], "at").withColumn("at", F.col("at") - 1))
    nodes = grow(numbered.select("tree", "at", F.col(leaf).alias("digest")), height)
    count = numbered.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    top = nodes.groupBy("tree").agg(F.max_by("digest", "level").alias("subroot"))
    # null, '-', sorts before '=' and so before every name
    trees = cut_lineage(row_number(top.join(count, "tree"), ["tree"], [], "rank").withColumn("rank", F.col("rank") - 1))
    above = grow(trees.select(F.lit(TOP).alias("tree"), F.col("rank").alias("at"), F.col("subroot").alias("digest")), height)
    n_trees = trees.count()
    root = above.agg(F.max_by("digest", "level")).first()[0]
    return Manifest(numbered, trees, nodes.unionByName(above), root, n_trees)


def _missing(n_trees: int):
    """Coordinates that each partition lacks, in its own tree and in the top."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"part": [], "tree": [], "level": [], "at": []}
            for row in batch.to_pylist():
                wanted = [(row["tree"], *c) for c in missing(row["at"], row["n"])]
                wanted += [(TOP, *c) for c in missing([row["rank"]], n_trees)]
                out["part"] += [{"tree": row["tree"], "run": row["run"]}] * len(wanted)
                for tree, level, at in wanted:
                    out["tree"].append(tree)
                    out["level"].append(level)
                    out["at"].append(at)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("part", pa.struct([("tree", pa.string()), ("run", pa.int64())])),
                ("tree", pa.string()), ("level", pa.int32()), ("at", pa.int64())]))
    return work


def _fetched(wanted: DataFrame, nodes: DataFrame, height: int) -> DataFrame:
    """The digests of the wanted nodes.  A node above the runs is wanted by many
    partitions: such nodes are broadcast if they are few, else salted."""
    keys = ["tree", "level", "at"]
    upper = nodes.where((F.col("level") >= height) | (F.col("tree") == TOP))
    if upper.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES:
        high = (F.col("level") >= height) | (F.col("tree") == TOP)
        return (wanted.where(high).join(F.broadcast(upper), keys)
                .unionByName(wanted.where(~high).join(nodes.where(~high), keys)))
    hot = (F.col("level") >= HOT_LEVEL) | (F.col("tree") == TOP)
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = wanted.withColumn("salt", F.when(hot, F.pmod(F.hash("part"), F.lit(SALTS))).otherwise(F.lit(0)))
    return salted.join(nodes.withColumn("salt", F.explode(copies)), [*keys, "salt"]).drop("salt")


def _prove(root: str, n_trees: int):
    """Proofs of a partition's leaves; ``shown`` leaves (tampered ones) are folded
    with the original siblings."""
    def work(key, leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        rows = leaves.select(["id", "at", "digest", "shown", "n", "rank"]).to_pylist()
        out: dict[str, list] = {c: [] for c in ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")}
        if rows:
            n, rank = rows[0]["n"], rows[0]["rank"]
            own, top = {}, {}
            for c in fetched.select(["tree", "level", "at", "digest"]).to_pylist():
                (top if c["tree"] == TOP else own)[c["level"], c["at"]] = c["digest"]
            nodes = derive({r["at"]: r["digest"] for r in rows}, own, n)
            subroot = nodes[-1][0]
            upper = derive({rank: subroot}, top, n_trees)
            above = siblings(rank, upper, n_trees)
            whole = upper[-1][0]
            for r in rows:
                below = siblings(r["at"], nodes, n)
                folded = whole
                if r["shown"] != r["digest"]:
                    folded = fold(fold(r["shown"], r["at"], below), rank, above)
                out["id"].append(r["id"])
                out["leaf"].append(r["digest"])
                out["subroot"].append(subroot)
                out["root"].append(root)
                out["proof_sha256"].append(digest(*[d for d in below + above if d is not None]))
                out["folded_root"].append(folded)
                out["verified"].append(folded == root)
        return pa.table(out, schema=pa.schema([
            ("id", leaves.schema.field("id").type), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
            ("verified", pa.bool_())]))
    return work


def prove(manifest: Manifest, leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """For each of ``leaves`` (some or all rows of the manifest: id, tree, at,
    digest and ``shown``, the digest to be checked): id, leaf, subroot, root,
    proof_sha256 (hash of all siblings, level by level), folded_root and whether
    it is the root."""
    small = manifest.n_trees <= BROADCAST_NODES
    trees = manifest.trees.select("tree", "n", "rank")
    keyed = leaves.withColumn("run", F.shiftright("at", height))
    parts = (keyed.groupBy("tree", "run").agg(F.collect_set("at").alias("at"))
             .join(F.broadcast(trees) if small else trees, "tree"))
    wanted = parts.mapInArrow(_missing(manifest.n_trees),
                              "part struct<tree: string, run: bigint>, tree string, level int, at bigint")
    fetched = _fetched(wanted, manifest.nodes, height).select(
        F.col("part.tree").alias("of"), F.col("part.run").alias("run"), "tree", "level", "at", "digest")
    # every leaf carries its tree's size and rank; one tree may have most leaves
    placed = parts.select(F.col("tree").alias("__t"), F.col("run").alias("__r"), "n", "rank")
    ready = keyed.join(placed, (F.col("tree") == F.col("__t")) & (F.col("run") == F.col("__r"))).withColumn("of", F.col("tree"))
    id_type = leaves.schema["id"].dataType.simpleString()
    return (ready.groupBy("of", "run").cogroup(fetched.groupBy("of", "run"))
            .applyInArrow(_prove(manifest.root, manifest.n_trees),
                          f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, "
                          "folded_root string, verified boolean"))


#: Documents that the query shows tampered: 7 divides the CRC-32 of their id.
TAMPERED = 7


def document_proofs(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                    group: str = "lang", changed: str = "n_chars", height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified.

    The first field is the id.  A document's proof is checked with its own leaf or,
    if 7 divides the CRC-32 of its id, with the leaf of a copy in which ``changed``
    is larger by 1 (a null stays null, and so verifies).  Leaves of a group ascend
    by id, null ids first and equal ids by digest; equal rows are leaves of their
    own.  A null group is a group, first in order; an empty text differs from a
    null one.  No documents give no rows.  Further columns are ignored.
    """
    key = fields[0]
    more = [F.col(c) if c != changed else (F.col(c).cast("decimal(20,0)") + 1) for c in fields]
    told = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))
    leaf = leaf_digest([F.col(c) for c in fields])
    rows = cut_lineage(docs.select(F.col(key).alias("id"), F.col(group).alias("group"), leaf.alias("digest"),
                                   F.when(told, leaf_digest(more)).otherwise(leaf).alias("shown")))
    manifest = build(rows, "group", ["id", "digest"], "digest", height)
    if manifest.root is None:  # no documents
        empty = rows.where(F.lit(False))
        return empty.select(F.col("id").alias(key), *[F.col("digest").alias(c) for c in (
            "leaf", "subroot", "root", "proof_sha256", "folded_root")], F.lit(False).alias("verified"))
    return prove(manifest, manifest.leaves.select("id", "tree", "at", "digest", "shown"), height).withColumnRenamed("id", key)
