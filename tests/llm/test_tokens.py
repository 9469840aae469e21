"""Pre-tokens, BPE and token counts against the public libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
import tokenizers

from tessera.llm import bpe, packing, token_counts
from tessera.llm.pretokens import IdCache, joined, pieces_of, split

PARTS = ["a", "s", "t", "re", "ve", "ll", "'", " ", "  ", "\n", "\t", " ", "é", "1", "²", "!", "#", " ", "世", "😀",
         "'s", "x", "d", "m", "\x1c", "\x00", " ", "The", " the", "<|endoftext|>"]
TEXTS = ["", " ", "a", "\n\n", "don't we'll 'twas''s", "x" * 3000, "é" * 2000, "=" * 5000 + " end", "a b " * 3000,
         "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "\x00\x01 ­", "١٢٣ ½ ①", "tab\t\t x"]


def _random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def multi():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        data = f.read()
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("multi", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe._ranks(data)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_split_gives_the_matches_of_the_pattern():
    pattern = regex.compile(P.PATTERN)
    texts = _random_texts(4000) + TEXTS
    b, _ = joined([t.encode() for t in texts])
    starts, ends = split(b)
    raw = b.tobytes()
    assert [raw[s:e].decode() for s, e in zip(starts, ends)] == [m for t in texts for m in pattern.findall(t)]


def test_cut_pieces_split_as_the_whole():
    pattern = regex.compile(P.PATTERN)
    for text in _random_texts(200) + TEXTS:
        pieces = [p.decode() for p in pieces_of(text.encode(), 7)]
        assert "".join(pieces) == text
        assert [m for p in pieces for m in pattern.findall(p)] == pattern.findall(text)


def test_matrices_and_heap_equal_the_library(multi):
    encoding, vocabulary = multi
    texts = _random_texts(1500) + TEXTS
    for limit in (1 << 19, 40):
        ids, counts = bpe.encode_run(IdCache(vocabulary.encode, limit), [t.encode() for t in texts])
        expected = [encoding.encode_ordinary(t) for t in texts]
        assert counts.tolist() == [len(x) for x in expected]
        assert ids.tolist() == [i for x in expected for i in x]
    word = "ab" * 700 + "thequickbrown" * 60
    assert vocabulary._by_heap(word.encode()).tolist() == encoding.encode_ordinary(word)


def _frame(spark, texts):
    rows = [(k, t, "x", 1) for k, t in enumerate(texts)] + [(None, None, "y", 2), (0, texts[0], "x", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, bpe int")


def test_bpe_digests(spark, multi):
    encoding, _ = multi
    texts = _random_texts(60) + TEXTS
    df = _frame(spark, texts)
    rows = bpe.bpe_digests(df, P.path("byte_bpe_multi_50k.tiktoken")).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = texts[r.doc_id] if r.doc_id is not None else ""
        ids = encoding.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.bpe_digests(df.limit(0), P.path("byte_bpe_multi_50k.tiktoken")).count() == 0


def test_encode_then_decode_is_the_text(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    df = _frame(spark, _random_texts(30) + TEXTS)
    for r in bpe.decode_ids(bpe.encode_texts(df, path), path).collect():
        assert bytes(r.decoded).decode() == (r.text or "")


@pytest.mark.parametrize("sample", [4096, 1])
def test_token_counts(spark, library, sample):
    texts = _random_texts(80) + TEXTS
    got = token_counts.token_counts(_frame(spark, texts), P.path("byte_bpe_50k.json"), limit=20, sample=sample).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = texts[r.doc_id] if r.doc_id is not None else ""
        n = len(library.encode(text, add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 20)
    assert token_counts.token_counts(_frame(spark, texts).limit(0), P.path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_of_other_files(spark, name):
    import sentencepiece
    texts = ["", "Hello  World", "éß 1 2", "a" * 300]
    rows = token_counts.token_counts(_frame(spark, texts), P.path(name)).where("doc_id is not null").collect()
    for r in rows:
        if name.endswith(".json"):
            n = len(tokenizers.Tokenizer.from_file(P.path(name)).encode(texts[r.doc_id], add_special_tokens=False))
        else:
            n = len(sentencepiece.SentencePieceProcessor(model_file=P.path(name)).encode(texts[r.doc_id]))
        assert r.n_tokens == n


def _check_packing(rows, documents, capacity):
    by_doc, sequences = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, ids in documents.items():
        at = 0
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        for k, r in enumerate(pieces):
            assert (r.piece, r.start) == (k, at)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
            assert r.length == capacity or k == 0
        assert at == len(ids)
        assert len(pieces) == max(1, -(-len(ids) // capacity))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert 0 < at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(spark, library, capacity):
    texts = _random_texts(150) + TEXTS + ["word " * 2047, "word " * 2048, "word " * 4096]
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)] + [(-1, None, 0)], "doc_id bigint, text string, piece int")
    documents = {k: library.encode(t, add_special_tokens=False).ids + [0] for k, t in enumerate(texts)} | {-1: [0]}
    rows = packing.pack_documents(df, P.path("byte_bpe_50k.json"), capacity).collect()
    n = _check_packing(rows, documents, capacity)
    assert n <= 1.1 * sum(map(len, documents.values())) / capacity + 1
    assert packing.pack_documents(df.limit(0), P.path("byte_bpe_50k.json"), capacity).count() == 0


def test_packing_keeps_repeated_rows(spark):
    df = spark.createDataFrame([(None, "a b c")] * 5 + [(7, "x")] * 3, "doc_id bigint, text string")
    rows = packing.pack_documents(df, P.path("byte_bpe_50k.json"), 8).collect()
    assert len(rows) == 8
    places = sorted((r.sequence_id, r.offset) for r in rows)
    assert len(set(places)) == 8


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_piece_and_come_near_the_bound(seed):
    rng = random.Random(seed)
    capacity = rng.choice([64, 257])
    histogram = {rng.randint(1, capacity): rng.choice([1, 5, 300, 10 ** 6]) for _ in range(rng.choice([1, 3, 40]))}
    plan = packing.plan_packing(histogram, capacity)
    got = {}
    for config, n in plan:
        assert n > 0 and sum(config) <= capacity
        for length in config:
            got[length] = got.get(length, 0) + n
    assert got == histogram
    alone = packing.best_fit(histogram, capacity)
    assert sum(n for _, n in plan) <= 1.08 * sum(n for _, n in alone) + 1


def test_plan_of_many_lengths_is_within_two_percent_of_the_bound():
    rng = random.Random(0)
    histogram = {n: rng.randint(20, 200) for n in range(1, 512)}
    plan = packing.plan_packing(histogram, 512)
    assert sum(n for _, n in plan) <= 1.02 * sum(n * c for n, c in histogram.items()) / 512
