"""Token alignment against the libraries and a plain loop."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import align
from tessera.llm.bpe import _printable_bytes

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = tokenizers.Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
CHARS = _printable_bytes()


def tokens(text):
    """Ids and bytes of both tokenizers; nothing if they do not spell the text."""
    if not text:
        return [], [], [], []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    bytes_a = [bytes(CHARS[c] for c in A.id_to_token(k)) for k in a]
    bytes_b = [bytes([int(B.id_to_piece(k)[3:5], 16)]) if B.is_byte(k) else B.id_to_piece(k).replace("▁", " ").encode() for k in b]
    whole = (" " + text).encode()
    return (a, b, bytes_a, bytes_b) if b"".join(bytes_a) == whole == b"".join(bytes_b) else ([], [], [], [])


def brute(rows):
    out, count = [], Counter()
    for key, text in rows:
        a, b, bytes_a, bytes_b = tokens(text)
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links = [(a[i], b[j]) for i, e in enumerate(ends_a) for j in [ends_b.index(e) if e in ends_b else -1] if j >= 0]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            n, m = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(map(str, a[i:n])) + "|" + ",".join(map(str, b[j:m])))
            i, j = n, m
        count.update(links)
        out.append((key, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = {}
    for (_, k), n in count.items():
        most[k] = max(most.get(k, 0), n)
    return sorted(((key, na, nb, ng, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), sha)
                   for key, na, nb, ng, links, sha in out), key=str)


def aligned(df, **options):
    got = align.align_tokens(df, A_PATH, B_PATH, **options)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


ODD = [(None, None), (1, ""), (2, " "), (3, "   a  b   "), (4, "x▁y"), (5, "<|endoftext|> <s></s> <0x41>"),
       (6, "\t\n \r\n\x00é ﬁ 漢字 🙂‍🙂"), (7, "a" * 5000), (8, " " * 3000), (8, " " * 3000), (9, "don't  stop\n\n  now "),
       (10, "　 x y"), (11, "word " * 2000)]


@pytest.mark.parametrize("table", [align.TABLE_PAIRS, 30, 1])
def test_like_the_libraries(spark, table):
    df = spark.createDataFrame([(k, t, "clash", 7) for k, t in ODD], "doc_id bigint, text string, pairs string, n_a int")
    assert aligned(df, table_pairs=table) == brute(ODD)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert aligned(df) == brute([(r.doc_id, r.text) for r in df.collect()])
    assert aligned(df.limit(0)) == []


@given(st.lists(st.text(st.sampled_from("ab é漢\n \t'▁🙂"), max_size=30), min_size=1, max_size=4))
@settings(max_examples=80, deadline=None)
def test_words_give_the_pieces_of_whole_texts(texts):
    texts = [t for t in texts if "▁" not in t] or ["x"]
    ids, counts = PIECES.encode([b" " + t.encode() for t in texts])
    cut = np.split(ids, np.cumsum(counts)[:-1])
    for t, got in zip(texts, cut):
        assert got.tolist() == (B.encode(t) if t else [B.piece_to_id("▁")])


PIECES = align.Pieces(B)


@given(st.data())
@settings(max_examples=100, deadline=None)
def test_pointers_end_at_the_last_token_of_the_component(data):
    n = data.draw(st.integers(1, 40))
    cuts = [sorted(data.draw(st.sets(st.integers(1, n - 1))) if n > 1 else []) + [n] for _ in range(2)]
    ends_a, ends_b = (np.array(c) for c in cuts)
    last = align.terminals(align.farthest(ends_a, ends_b))
    shared = sorted(set(cuts[0]) & set(cuts[1]))
    want = [cuts[0].index(next(e for e in shared if e >= x)) for c in cuts for x in c]
    assert last.tolist() == want
