"""Merkle manifests and multiproofs against brute force."""

import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import merkle

FIELDS = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, at int"


def leaf_of(r, plus=0):
    shown = []
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        value = r[name]
        value = value if value is None else str(value + plus if name == "n_chars" else value)
        shown.append("-" if value is None else f"{len(value.encode())}:{value}")
    return merkle.digest(*shown)


def tree(nodes):
    """Root and each leaf's path: (stands right, sibling)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            paths[i].append((k & 1, nodes[k ^ 1] if k ^ 1 < len(nodes) else None))
        at = [k >> 1 for k in at]
        nodes = [merkle.digest(*nodes[k:k + 2]) for k in range(0, len(nodes), 2)]
    return nodes[0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    langs, parts = sorted(by, key=lambda x: (x is not None, (x or "").encode())), []
    for lang in langs:
        found = sorted(by[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        parts.append((found, *tree([leaf_of(r) for r in found])))
    root, tops = tree([p[1] for p in parts]) if parts else (None, [])
    out = []
    for (found, subroot, paths), top in zip(parts, tops):
        for r, path in zip(found, paths):
            told = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            d = leaf_of(r, int(told and r["n_chars"] is not None))  if r["n_chars"] is not None else leaf_of(r)
            for right, other in path + top:
                d = merkle.digest(d) if other is None else merkle.digest(other, d) if right else merkle.digest(d, other)
            proof = merkle.digest(*[o for _, o in path + top if o is not None])
            out.append((r["doc_id"], leaf_of(r), subroot, root, proof, d, d == root))
    return sorted(out, key=str)


def proofs(df, height):
    got = merkle.document_proofs(df, height=height)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("height", [12, 2])
def test_like_brute_force(spark, height):
    rows = [(i * 3, f"s{i % 4}", ["en", "de", "fr", None][i * i % 7 % 4], i, "text " * (i % 5), "clash", i) for i in range(150)]
    df = spark.createDataFrame(rows, FIELDS).repartition(5)
    assert proofs(df, height) == brute([r.asDict() for r in df.collect()])


def test_odd_rows(spark):
    rows = [(None, "a", None, 1, "x"), (1, None, None, None, ""), (1, None, None, None, ""), (1, "b", "en", 2, None),
            (7, "é", "fr", 3, "y" * 100_000), (14, "s", "", 5, "q"), (14, "s", "-", 2 ** 63 - 1, "q")]
    df = spark.createDataFrame([(*r, None, None) for r in rows], FIELDS)
    for some in (df, df.limit(1), df.limit(0)):
        assert proofs(some, 12) == brute([r.asDict() for r in some.collect()])


def test_a_tampered_document_does_not_verify(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 0]
    df = spark.createDataFrame([(i, "s", "en", i if i % 2 else None, "t", None, 1) for i in range(40)], FIELDS)
    assert {r[0] for r in proofs(df, 3) if not r[-1]} == {i for i in ids if i % 2}


@given(st.integers(1, 70), st.data())
@settings(max_examples=60, deadline=None)
def test_missing_nodes_are_enough_and_none_is_derivable(n, data):
    """The root follows from them and not without any one of them."""
    at = sorted(data.draw(st.sets(st.integers(0, n - 1), min_size=1)))
    leaves = [str(k) for k in range(n)]
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([merkle.digest(*levels[-1][k:k + 2]) for k in range(0, len(levels[-1]), 2)])
    wanted = merkle.missing(at, n)
    assert len(set(wanted)) == len(wanted)
    fetched = {(lv, k): levels[lv][k] for lv, k in wanted}
    found = merkle.derive({k: leaves[k] for k in at}, fetched, n)
    assert found[-1] == {0: levels[-1][0]}
    for k in at:
        assert merkle.fold(leaves[k], k, merkle.siblings(k, found, n)) == levels[-1][0]
    for c in wanted:
        less = {k: v for k, v in fetched.items() if k != c}
        assert merkle.derive({k: leaves[k] for k in at}, less, n)[-1] == {}


def test_proofs_of_some_leaves(spark):
    """Partitions that prove only a few of their leaves fetch what they lack."""
    rows = spark.createDataFrame([(i, "g" if i % 5 else None, merkle.digest(str(i))) for i in range(200)],
                                 "id bigint, grp string, digest string")
    made = merkle.build(rows, "grp", ["id"], "digest", 3)
    some = made.leaves.where("id % 13 = 0").selectExpr("id", "tree", "at", "digest", "digest AS shown")
    got = merkle.prove(made, some, 3).collect()
    assert sorted(r.id for r in got) == list(range(0, 200, 13)) and all(r.verified and r.root == made.root for r in got)
    every = merkle.prove(made, made.leaves.selectExpr("id", "tree", "at", "digest", "digest AS shown"), 3)
    proof = {r.id: r.proof_sha256 for r in every.collect()}
    assert all(proof[r.id] == r.proof_sha256 for r in got)


def test_upper_nodes_that_are_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_NODES", 1)
    monkeypatch.setattr(merkle, "HOT_LEVEL", 3)
    rows = [(i, "s", "en" if i % 3 else "de", i, "t", None, i) for i in range(90)]
    df = spark.createDataFrame(rows, FIELDS)
    assert proofs(df, 2) == brute([r.asDict() for r in df.collect()])
