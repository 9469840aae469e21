"""Byte-level BPE encoding and decoding as padded numpy matrices.

Pre-tokens are dealt into buckets of equal byte length.  A bucket is a matrix
of token ids, one row a pre-token, with a matrix beside it of the ranks of
neighbouring pairs.  In each round every row merges its leftmost pair of
minimum rank, so after a round each row that still merges is one column
shorter; rows without a mergeable pair are finished and leave the matrix.
Pair ranks come from a hash table over flat arrays; a merge changes two
neighbouring pairs, so a round looks up two ranks per row.

Pre-tokens too long for a matrix are merged one by one with a heap in the same
order (rank, then position), so texts without white space stay near linear.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.columns import RunFn, free_name, struct_of
from tessera.llm.pretokens import IdCache, joined, pieces_of, split

NONE = np.int32(1 << 30)
#: Longer pre-tokens go through the heap.
MATRIX_BYTES = 256
MATRIX_CELLS = 1 << 21


class PairTable:
    """(left id, right id) -> (rank, merged id): open addressing, all probed
    at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        bits = max(4, int(4 * left.size).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.key = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NONE, np.int32)
        self.merged = np.zeros(1 << bits, np.int32)
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = self._slot(key)
        while key.size:
            free = self.key[slot] < 0
            self.key[slot[free]] = key[free]
            won = free & (self.key[slot] == key)
            self.rank[slot[won]], self.merged[slot[won]] = rank[won], merged[won]
            on = ~won
            key, rank, merged, slot = key[on], rank[on], merged[on], (slot[on] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair; a pair that does not merge gets an empty slot
        (rank ``NONE``)."""
        shape = left.shape
        key = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        slot = self._slot(key)
        on = np.flatnonzero((self.key[slot] != key) & (self.key[slot] >= 0))
        while on.size:
            slot[on] = (slot[on] + 1) & self.mask
            on = on[(self.key[slot[on]] != key[on]) & (self.key[slot[on]] >= 0)]
        return slot.reshape(shape)


class Vocabulary:
    """Byte tokens, their ids, and which pairs merge at which rank.

    ``whole``: a pre-token that is itself a token is that token, whatever the
    merges would give.
    """

    def __init__(self, tokens: dict[bytes, int], pairs: list[tuple[int, int, int, int]], whole: bool):
        table = np.array(pairs, np.int64).reshape(-1, 4)
        self.pairs = PairTable(table[:, 0], table[:, 1], table[:, 2], table[:, 3].astype(np.int32))
        self.byte_id = np.array([tokens[bytes([k])] for k in range(256)], np.int32)
        self.whole = tokens if whole else {}
        self.bytes_of = [b""] * (max(tokens.values()) + 1)
        for token, number in tokens.items():
            self.bytes_of[number] = token

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each pre-token: (flat ids, lengths)."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        lengths = np.zeros(len(texts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # rows, their ids (as wide each)
        if self.whole:
            number = np.fromiter((self.whole.get(t, -1) for t in texts), np.int64, len(texts))
            rows = np.flatnonzero(number >= 0)
            parts.append((rows, number[rows, None].astype(np.uint32)))
            size[rows] = -1
        for n in np.unique(size[size > 0]).tolist():
            rows = np.flatnonzero(size == n)
            if n > MATRIX_BYTES:
                parts += [(np.array([r]), self._by_heap(texts[r])[None, :]) for r in rows.tolist()]
                continue
            step = max(1, MATRIX_CELLS // n)
            for at in range(0, rows.size, step):
                some = rows[at:at + step]
                parts += self._by_matrix([texts[r] for r in some.tolist()], some, n)
        for rows, ids in parts:
            lengths[rows] = ids.shape[1]
        before = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), np.uint32)
        for rows, ids in parts:
            out[before[rows][:, None] + np.arange(ids.shape[1])] = ids
        return out, lengths

    def _by_matrix(self, texts: list[bytes], row: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        parts = []
        ids = self.byte_id[np.frombuffer(b"".join(texts), np.uint8).reshape(len(texts), n)]
        rank = np.full((len(texts), max(n - 1, 0)), NONE, np.int32)
        merged = np.zeros(rank.shape, np.int32)
        if n > 1:
            slot = self.pairs.find(ids[:, :-1], ids[:, 1:])
            rank, merged = self.pairs.rank[slot], self.pairs.merged[slot]
        while True:
            width = ids.shape[1]
            at = rank.argmin(axis=1) if width > 1 else np.zeros(len(ids), np.int64)
            on = rank[np.arange(len(ids)), at] < NONE if width > 1 else np.zeros(len(ids), bool)
            if not on.all():
                parts.append((row[~on], ids[~on].astype(np.uint32)))
                ids, rank, merged, row, at = ids[on], rank[on], merged[on], row[on], at[on]
            if not len(ids):
                return parts
            each = np.arange(len(ids))
            token = merged[each, at]
            # what stands right of the pair moves one column to the left
            after = np.arange(width - 1) > at[:, None]
            ids = np.where(after, ids[:, 1:], ids[:, :-1])
            ids[each, at] = token
            if width > 2:
                # the pair at the merge goes; its neighbours are looked up anew
                after = np.arange(width - 2) >= at[:, None]
                rank = np.where(after, rank[:, 1:], rank[:, :-1])
                merged = np.where(after, merged[:, 1:], merged[:, :-1])
                for side in (at - 1, at):
                    ok = np.flatnonzero((side >= 0) & (side < width - 2))
                    s = side[ok]
                    slot = self.pairs.find(ids[ok, s], ids[ok, s + 1])
                    rank[ok, s], merged[ok, s] = self.pairs.rank[slot], self.pairs.merged[slot]
            else:
                rank, merged = rank[:, :0], merged[:, :0]

    def _by_heap(self, text: bytes) -> np.ndarray:
        ids = self.byte_id[np.frombuffer(text, np.uint8)]
        slot = self.pairs.find(ids[:-1], ids[1:])
        first = self.pairs.rank[slot]
        at = np.flatnonzero(first < NONE)
        heap = list(zip(first[at].tolist(), at.tolist(), ids[at].tolist(), ids[at + 1].tolist(),
                        self.pairs.merged[slot[at]].tolist()))
        heapq.heapify(heap)
        n = ids.size
        ids = ids.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def push(left: int) -> None:
            right = after[left]
            if right >= n:
                return
            s = int(self.pairs.find(np.array([ids[left]]), np.array([ids[right]]))[0])
            if self.pairs.rank[s] < NONE:
                heapq.heappush(heap, (int(self.pairs.rank[s]), left, ids[left], ids[right], int(self.pairs.merged[s])))

        while heap:
            _, left, a, b, token = heapq.heappop(heap)
            right = after[left]
            if ids[left] != a or right >= n or ids[right] != b:
                continue  # one of the two has merged since
            ids[left], ids[right] = token, -1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            if before[left] >= 0:
                push(before[left])
            push(left)
        return np.array([x for x in ids if x >= 0], np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def _ranks(data: bytes) -> Vocabulary:
    """A rank file: a line a token, base64 and rank.  Two tokens merge if
    their bytes together are a token, at its rank."""
    tokens = {}
    for line in data.splitlines():
        if line.strip():
            token, rank = line.split()
            tokens[base64.b64decode(token)] = int(rank)
    pairs = []
    for token, rank in tokens.items():
        for cut in range(1, len(token)):
            left, right = tokens.get(token[:cut]), tokens.get(token[cut:])
            if left is not None and right is not None:
                pairs.append((left, right, rank, rank))
    return Vocabulary(tokens, pairs, whole=True)


def _printable_bytes() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: Latin-1
    characters that print stand for themselves, the others for U+0100 on."""
    shown = [k for k in range(256) if 33 <= k <= 126 or 161 <= k <= 172 or 174 <= k <= 255]
    hidden = [k for k in range(256) if k not in set(shown)]
    return {chr(k): k for k in shown} | {chr(256 + n): k for n, k in enumerate(hidden)}


def _merges(data: bytes) -> tuple[Vocabulary, dict[bytes, int]]:
    """A tokenizer file with a vocabulary and an ordered list of merges; also
    its special tokens, which stand outside the merges."""
    spec = json.loads(data)
    model = spec["model"]
    if (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer") \
            or model.get("end_of_word_suffix") or not spec["pre_tokenizer"].get("use_regex", True) \
            or spec["pre_tokenizer"].get("add_prefix_space"):
        raise ValueError("only byte-level vocabularies without normalizer or prefix space are read here")
    chars = _printable_bytes()
    special = {t["content"].encode(): t["id"] for t in spec.get("added_tokens", [])}
    vocab = model["vocab"]
    tokens = {bytes(chars[c] for c in token): number for token, number in vocab.items()
              if token.encode() not in special}
    pairs = []
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs.append((vocab[left], vocab[right], rank, vocab[left + right]))
    return Vocabulary(tokens, pairs, whole=bool(model.get("ignore_merges"))), special


@functools.lru_cache(maxsize=4)
def _load(digest: str, kind: str, data: bytes):
    return _ranks(data) if kind == "tiktoken" else _merges(data)


class VocabularyFile:
    """A vocabulary's bytes as a broadcast; workers build their tables from it
    once (a file of some MB: its size does not grow with the data)."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.kind = "tiktoken" if path.endswith(".tiktoken") else "json"
        self.digest = hashlib.sha256(data).hexdigest()
        self.data = spark.sparkContext.broadcast(data)

    def load(self):
        return _load(self.digest, self.kind, self.data.value)


_CACHES: dict[tuple, IdCache] = {}


def worker_cache(key: tuple, make) -> IdCache:
    """A cache that lasts as long as the worker process, at most two of them."""
    if key not in _CACHES:
        if len(_CACHES) > 1:
            _CACHES.clear()
        _CACHES[key] = make()
    return _CACHES[key]


def encode_run(cache: IdCache, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a run of texts one after another, and how many each has."""
    pieces: list[bytes] = []
    owner: list[int] = []
    for k, text in enumerate(texts):
        cut = pieces_of(text)
        pieces += cut
        owner += [k] * len(cut)
    b, begins = joined(pieces)
    starts, ends = split(b)
    ids, lengths = cache.ids(cache.numbers(b, starts, ends))
    before = np.concatenate([[0], np.cumsum(lengths)])
    bounds = np.append(np.searchsorted(starts, begins), starts.size)
    per_piece = before[bounds[1:]] - before[bounds[:-1]]
    return ids, np.bincount(np.array(owner, np.int64), per_piece, len(texts)).astype(np.int64)


SCHEMA = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])


def _digests(vocabulary: VocabularyFile) -> RunFn:
    vocab = vocabulary.load()
    cache = worker_cache(("bpe", vocabulary.digest), lambda: IdCache(vocab.encode))

    def work(run: list[bytes | None]) -> dict:
        ids, counts = encode_run(cache, [t or b"" for t in run])
        ids = ids.astype("<u4")
        at = np.concatenate([[0], np.cumsum(counts)]).tolist()
        parts = [ids[s:e] for s, e in zip(at, at[1:])]
        return {"n_tokens": counts,
                "ids_sha256": [hashlib.sha256(p.tobytes()).hexdigest() for p in parts],
                "decoded_sha256": [hashlib.sha256(vocab.decode(p)).hexdigest() for p in parts]}

    return work


def encode_texts(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a column ``ids`` of the text's token ids (null text: no
    ids).  ``path``: a rank file (``.tiktoken``)."""
    vocabulary = VocabularyFile(df.sparkSession, path)
    schema = T.StructType([T.StructField("ids", T.ArrayType(T.LongType()))])

    def make() -> RunFn:
        vocab = vocabulary.load()
        cache = worker_cache(("bpe", vocabulary.digest), lambda: IdCache(vocab.encode))

        def work(run: list[bytes | None]) -> dict:
            flat, counts = encode_run(cache, [t or b"" for t in run])
            at = np.concatenate([[0], np.cumsum(counts)]).tolist()
            return {"ids": [flat[s:e].astype(np.int64) for s, e in zip(at, at[1:])]}
        return work

    return df.withColumn(ids, struct_of(F.col(text), schema, make)["ids"])


def decode_ids(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with a binary column of the bytes that the ids stand for (null:
    no bytes)."""
    vocabulary = VocabularyFile(df.sparkSession, path)

    @F.arrow_udf(T.BinaryType())
    def apply(column: pa.Array) -> pa.Array:
        vocab = vocabulary.load()
        return pa.array([vocab.decode(np.array(x or [], np.int64)) for x in column.to_pylist()], pa.binary())

    return df.withColumn(out, apply(F.col(ids).cast("array<bigint>")))


def bpe_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, the number of token ids of its
    whole text, and SHA-256 of the ids (little-endian, 32 bits) and of the
    bytes they decode to.

    Null and empty texts have no ids.  Repeated rows, null ids and any further
    columns of ``docs`` are allowed; only ``doc_id`` and ``text`` are read.
    """
    vocabulary = VocabularyFile(docs.sparkSession, path)
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    got: Column = struct_of(F.col("text"), SCHEMA, lambda: _digests(vocabulary))
    name = free_name(kept, "bpe")
    return kept.select("doc_id", got.alias(name)).select("doc_id", f"{name}.*")
