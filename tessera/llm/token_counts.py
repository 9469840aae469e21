"""Token counts by a two-tier lookup on the map side.

Tier one is a broadcast hash table from frequent pre-tokens to their number of
tokens.  It is filled from a sample of the documents of bounded size and has a
bounded number of rows, so its size does not grow with the data; it only saves
work and never changes a count.  Tier two is a cache in each worker process:
pre-tokens that tier one lacks are encoded by the tokenizer library, each
distinct one once per worker.  No pre-token is ever shuffled: documents stay in
their task and only their counts leave it.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bpe import worker_cache
from tessera.llm.columns import RunFn, free_name, struct_of, text_runs
from tessera.llm.pretokens import WORDS_HOLD, IdCache, WordTable, joined, keys, pieces_of, split

#: Rows of the broadcast table and documents it is filled from (the sample).
TABLE_ROWS = 1 << 15
SAMPLE_DOCUMENTS = 4096
SAMPLE_TASKS = 8

SCHEMA = T.StructType([T.StructField("n_tokens", T.LongType())])


@functools.lru_cache(maxsize=2)
def _library(digest: str, kind: str, data: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    if kind == "model":
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_proto=data)
    import tokenizers
    library = tokenizers.Tokenizer.from_buffer(data)
    library.no_truncation()
    library.no_padding()
    return library


class Tokenizer:
    """A tokenizer file of ``tokenizers`` (.json) or ``sentencepiece``
    (.model), broadcast as bytes (some MB, whatever the data)."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.kind = "model" if path.endswith(".model") else "json"
        self.digest = hashlib.sha256(data).hexdigest()
        self.special: list[bytes] = []
        self.splits = False  # into pre-tokens that encode independently, as ``split`` does
        if self.kind == "json":
            spec = json.loads(data)
            before = spec.get("pre_tokenizer") or {}
            self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
            self.splits = (before.get("type") == "ByteLevel" and bool(before.get("use_regex", True))
                           and not before.get("add_prefix_space") and not spec.get("normalizer"))
        self.data = spark.sparkContext.broadcast(data)

    def load(self):
        return _library(self.digest, self.kind, self.data.value)

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """The library's own count of each text."""
        strings = [t.decode("utf-8", "replace") for t in texts]
        if self.kind == "model":
            return np.array([len(x) for x in self.load().encode(strings, num_threads=1)], np.int64)
        got = self.load().encode_batch_fast(strings, add_special_tokens=False)
        return np.array([len(x) for x in got], np.int64)


def frequent_pretokens(docs: DataFrame, text: str = "text", rows: int = TABLE_ROWS,
                       sample: int = SAMPLE_DOCUMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the most frequent short pre-tokens of about ``sample``
    documents (chosen by a hash of the row's number and text, so that a repeated
    text is not taken in all its copies; at most ``sample``).  At most
    ``SAMPLE_TASKS * rows`` rows reach the driver."""
    texts = docs.select(F.col(text).alias("t")).where(F.col("t").isNotNull())
    n = docs.count()
    share = min(1.0, sample / max(1, n))
    cut = int((share - 0.5) * 2 ** 64)
    if share < 1:
        texts = texts.where(F.xxhash64(F.monotonically_increasing_id(), "t") < F.lit(max(-2 ** 63, cut))).limit(sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for run in text_runs(batch.column(0)):
                b, _ = joined([p for t in run for p in pieces_of(t)])
                starts, ends = split(b)
                short = ends - starts <= WORDS_HOLD
                low, high = keys(b, starts[short], ends[short])
                both, times = np.unique(np.stack([low, high], 1), axis=0, return_counts=True)
                found.update(dict(zip(map(tuple, both.tolist()), times.tolist())))
                if len(found) > 8 * rows:  # keeps the task's memory bounded
                    found = Counter(dict(found.most_common(4 * rows)))
        top = found.most_common(rows)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.array([k[0] for k, _ in top], np.uint64).view(np.int64)),
            pa.array(np.array([k[1] for k, _ in top], np.uint64).view(np.int64)),
            pa.array([c for _, c in top], pa.int64())], names=["low", "high", "n"])

    got = (texts.repartition(SAMPLE_TASKS).mapInArrow(count, "low bigint, high bigint, n bigint")
           .groupBy("low", "high").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "low", "high").limit(rows).toPandas())
    return (got["low"].to_numpy(np.int64).view(np.uint64), got["high"].to_numpy(np.int64).view(np.uint64))


def _bytes_of(low: np.ndarray, high: np.ndarray) -> list[bytes]:
    raw = np.stack([low, high], 1).astype("<u8").tobytes()
    sizes = (high >> np.uint64(56)).tolist()
    return [raw[16 * k:16 * k + int(n)] for k, n in enumerate(sizes)]


@functools.lru_cache(maxsize=2)
def _tier_one(digest: str, low: bytes, high: bytes, lengths: bytes) -> WordTable:
    table = WordTable(max(4, int(4 * len(low) // 8).bit_length()))
    table.add(np.frombuffer(low, np.uint64), np.frombuffer(high, np.uint64), np.frombuffer(lengths, np.int32))
    return table


def _by_table(tokenizer: Tokenizer, frequent) -> RunFn:
    tokenizer.load()
    first = _tier_one(tokenizer.digest, *frequent.value)
    second = worker_cache(("count", tokenizer.digest),
                          lambda: IdCache(lambda texts: (np.zeros(0, np.uint32), tokenizer.lengths(texts))))

    def work(run: list[bytes | None]) -> dict:
        texts = [t or b"" for t in run]
        counts = np.zeros(len(texts), np.int64)
        whole = [k for k, t in enumerate(texts) if any(s in t for s in tokenizer.special)]
        if whole:  # the library cuts special strings out first
            counts[whole] = tokenizer.lengths([texts[k] for k in whole])
            for k in whole:
                texts[k] = b""
        pieces, owner = [], []
        for k, t in enumerate(texts):
            cut = pieces_of(t)
            pieces += cut
            owner += [k] * len(cut)
        b, begins = joined(pieces)
        starts, ends = split(b)
        n = np.zeros(starts.size, np.int64)
        short = np.flatnonzero(ends - starts <= WORDS_HOLD)
        n[short] = first.find(*keys(b, starts[short], ends[short]))
        n[ends - starts > WORDS_HOLD] = -1
        miss = np.flatnonzero(n < 0)
        numbers = second.numbers(b, starts[miss], ends[miss])
        n[miss] = second.length[numbers]
        before = np.concatenate([[0], np.cumsum(n)])
        bounds = np.append(np.searchsorted(starts, begins), starts.size)
        each = before[bounds[1:]] - before[bounds[:-1]]
        counts += np.bincount(np.array(owner, np.int64), each, len(texts)).astype(np.int64)
        return {"n_tokens": counts}

    return work


def _by_library(tokenizer: Tokenizer) -> RunFn:
    return lambda run: {"n_tokens": tokenizer.lengths([t or b"" for t in run])}


def token_counts(docs: DataFrame, path: str, limit: int = 1024, doc_id: str = "doc_id",
                 text: str = "text", table_rows: int = TABLE_ROWS,
                 sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens,
    over_limit (more than ``limit`` tokens).

    Counts are the library's, without begin and end tokens; special strings
    inside a text count as the library counts them.  Files whose pre-tokens
    are not those of ``split`` (other normalizers, ``.model``) are counted on
    whole texts by the library.  A null text counts as empty: 0 bytes, 0
    tokens.  Null or repeated ids and further columns are allowed.
    """
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    tokenizer = Tokenizer(docs.sparkSession, path)
    if tokenizer.splits:
        low, high = frequent_pretokens(kept, "text", table_rows, sample)
        lengths = tokenizer.lengths(_bytes_of(low, high)).astype(np.int32)
        frequent = docs.sparkSession.sparkContext.broadcast((low.tobytes(), high.tobytes(), lengths.tobytes()))
        make = lambda: _by_table(tokenizer, frequent)
    else:
        make = lambda: _by_library(tokenizer)
    name = free_name(kept, "count")
    return (kept.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
                        struct_of(F.col("text"), SCHEMA, make)["n_tokens"].alias(name))
            .select("doc_id", "n_bytes", F.col(name).alias("n_tokens"),
                    (F.col(name) > limit).alias("over_limit")))
