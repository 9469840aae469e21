"""Aligning the tokens of two tokenizers.

Each text is encoded twice: A is a byte-level vocabulary file, B a sentencepiece
model.  Both token sequences spell the same bytes (a space and the text), so tokens
are byte intervals, and tokens that overlap, directly or through others, form a
group.  Groups are found by pointer jumping: every token of a run of texts points
to its farthest-right overlapping token (the other tokenizer's token over its last
byte, if that ends later; where two end together, both point to A's), and the
pointers are doubled for all tokens at once until they no longer change.  Each then
points to its group's last token, which labels the group.

How often two ids are linked is counted over all documents (folded per document,
then by Spark).  Counts are looked up twofold: those of the most frequent pairs are
broadcast (a bounded table), the rest of a document's pairs, few by construction,
are joined with the rest of the counts.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bpe import VocabularyFile, encode_run
from tessera.llm.columns import RunFn, free_name, struct_of
from tessera.llm.pretokens import CUT_BYTE, IdCache, joined
from tessera.llm.token_counts import Tokenizer
from tessera.session import cut_lineage, ensure_checkpoint_dir

#: Most pairs whose counts are broadcast (17 bytes each).
TABLE_PAIRS = 1 << 20
#: Bytes of the texts that are aligned at once, and words and pre-tokens kept by a
#: worker (both bound its memory).
RUN_BYTES, KEPT = 1 << 19, 1 << 17
#: A pair as one number: A's id above, B's below.
LOW_BITS = 32

SCHEMA = T.StructType([
    T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
    T.StructField("groups_sha256", T.StringType()),
    T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))])


def farthest(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The farthest-right overlapping token of each token (A's first, then B's):
    itself for the last token of a group in A, A's for that in B.  Both sequences
    cover the same bytes without a gap."""
    over_a = np.searchsorted(ends_b, ends_a)  # B's token over the last byte of each of A's
    over_b = np.searchsorted(ends_a, ends_b)
    to_b = np.where(ends_b[over_a] > ends_a, ends_a.size + over_a, np.arange(ends_a.size))
    return np.concatenate([to_b, over_b])


def terminals(pointer: np.ndarray) -> np.ndarray:
    """Where each token's pointers end, by doubling."""
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            return pointer
        pointer = further


class Pieces:
    """A sentencepiece model, words encoded once each.

    A word is a run of spaces and what follows up to the next space; as no piece
    goes on with a space after another character, the pieces of a text are those
    of its words.  A model that has such pieces encodes whole texts."""

    def __init__(self, library):
        self.library = library
        pieces = [library.id_to_piece(k) for k in range(library.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if library.is_byte(k) else p.replace("▁", " ").encode()
                         for k, p in enumerate(pieces)]
        self.size = np.array([len(b) for b in self.bytes_of], np.int64)
        self.space = library.piece_to_id("▁")
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces)
        self.cache = IdCache(self._words, KEPT)

    def _library(self, texts: list[bytes]) -> list[list[int]]:
        return self.library.encode([t.decode("utf-8", "replace") for t in texts], num_threads=1)

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``words`` with the space that the model adds."""
        got = [ids if len(w) > 1 else [self.space] for w, ids in zip(words, self._library([w[1:] for w in words]))]
        return (np.array([k for ids in got for k in ids], np.uint32), np.array([len(ids) for ids in got], np.int64))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another and how many each has.  Each text
        begins with the space that the model adds."""
        if not self.by_word:
            got = self._library([t[1:] for t in texts])
            return (np.array([k for ids in got for k in ids], np.int64), np.array([len(ids) for ids in got], np.int64))
        b, begins = joined(texts)
        space = b == 0x20
        first = space.copy()
        first[1:] &= ~space[:-1]
        starts = np.flatnonzero(first)
        stop = np.flatnonzero(b == CUT_BYTE)  # not in UTF-8: one ends each text
        after = np.append(starts[1:], b.size)
        ends = np.minimum(after, stop[np.minimum(np.searchsorted(stop, starts), stop.size - 1)])
        ids, lengths = self.cache.ids(self.cache.numbers(b, starts, ends))
        before = np.concatenate([[0], np.cumsum(lengths)])
        bounds = np.append(np.searchsorted(starts, begins), starts.size)
        return ids.astype(np.int64), before[bounds[1:]] - before[bounds[:-1]]


@functools.lru_cache(maxsize=2)
def _worker(digest_a: str, digest_b: str, vocabulary, model):
    vocab = vocabulary.load()
    vocab = vocab[0] if isinstance(vocab, tuple) else vocab
    size = np.array([len(b) for b in vocab.bytes_of], np.int64)
    return vocab.bytes_of, size, IdCache(vocab.encode, KEPT), Pieces(model.load())


def _cut(flat: np.ndarray, counts: np.ndarray, bytes_of: list[bytes], texts: list[bytes]) -> np.ndarray:
    """Which texts their tokens spell."""
    at = np.concatenate([[0], np.cumsum(counts)]).tolist()
    return np.array([b"".join(map(bytes_of.__getitem__, flat[s:e].tolist())) == t
                     for t, s, e in zip(texts, at, at[1:])], bool)


def _shown(ids_a, ids_b, groups_a, groups_b, text_of_group, n_texts: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text as a digest; '' without tokens."""
    group = np.concatenate([groups_a, groups_b])
    side = np.repeat([0, 1], [groups_a.size, groups_b.size])
    order = np.lexsort((np.arange(group.size), side, group))
    ids, group, side = np.concatenate([ids_a, ids_b])[order], group[order], side[order]
    # what follows each token: 0 ',' 1 '|' 2 ';'
    follows = np.zeros(ids.size, np.int64)
    follows[:-1] = np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
    follows[-1:] = 2
    kinds, which = np.unique(ids * 3 + follows, return_inverse=True)
    words = [str(k // 3) + ",|;"[k % 3] for k in kinds.tolist()]
    pieces = [words[k] for k in which.tolist()]
    bounds = np.searchsorted(text_of_group[group], np.arange(n_texts + 1)).tolist()
    return [hashlib.sha256("".join(pieces[s:e])[:-1].encode()).hexdigest() if e > s else ""
            for s, e in zip(bounds, bounds[1:])]


def align_run(texts: list[bytes | None], spell_a, encode_a, size_a, spell_b, encode_b, size_b) -> dict:
    """The columns of ``SCHEMA`` for a run of texts."""
    count = len(texts)
    rows = [k for k, t in enumerate(texts) if t]
    whole = [b" " + texts[k] for k in rows]
    a, n_a = encode_a(whole)
    b, n_b = encode_b(whole)
    a, b = a.astype(np.int64), b.astype(np.int64)
    fine = _cut(a, n_a, spell_a, whole) & _cut(b, n_b, spell_b, whole)
    a, b = a[np.repeat(fine, n_a)], b[np.repeat(fine, n_b)]
    kept = np.array(rows, np.int64)[fine]
    n_a, n_b = n_a[fine], n_b[fine]
    out = {"n_a": np.zeros(count, np.int64), "n_b": np.zeros(count, np.int64), "n_groups": np.zeros(count, np.int64),
           "groups_sha256": [""] * count, "pairs": [[]] * count, "times": [[]] * count}
    if not kept.size:
        return out
    ends_a, ends_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
    last = terminals(farthest(ends_a, ends_b))
    group_a, group_b = last[:a.size], last[a.size:]
    ends = np.flatnonzero(group_a == np.arange(a.size))  # A's last token of each group
    text_a = np.repeat(np.arange(kept.size), n_a)
    # A and B tokens that end together are linked: the last ones of each group
    code = a[ends] << LOW_BITS | b[np.searchsorted(ends_b, ends_a[ends])]
    out["n_a"][kept], out["n_b"][kept] = n_a, n_b
    out["n_groups"][kept] = np.bincount(text_a[ends], minlength=kept.size)
    shown = _shown(a, b, group_a, group_b, text_a, kept.size)
    order = np.lexsort((code, text_a[ends]))
    owner, code = text_a[ends][order], code[order]
    new = np.ones(code.size, bool)
    new[1:] = (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, code.size))
    bounds = np.searchsorted(owner[at], np.arange(kept.size + 1))
    for k, row in enumerate(kept.tolist()):
        out["groups_sha256"][row] = shown[k]
        out["pairs"][row] = code[at[bounds[k]:bounds[k + 1]]]
        out["times"][row] = times[bounds[k]:bounds[k + 1]]
    return out


def _aligned(vocabulary: VocabularyFile, model: Tokenizer) -> RunFn:
    spell_a, size_a, cache_a, pieces = _worker(vocabulary.digest, model.digest, vocabulary, model)
    return lambda run: align_run(run, spell_a, lambda t: encode_run(cache_a, t), size_a,
                                 pieces.bytes_of, pieces.encode, pieces.size)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (links that hold it, over all documents), best (no pair of its B id
    has more)."""
    folded = (aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
              .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n")))
    # a window per B id: at most one row for each of A's ids
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << LOW_BITS) - 1)))
    return folded.withColumn("best", F.col("n") == F.max("n").over(of_b))


LOOKED = T.StructType([
    T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
    T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))])


def _look_up(table):
    """Sums over the pairs that the broadcast table has, and the other pairs."""
    fields = [pa.field("n_best", pa.int64()), pa.field("count_sum", pa.int64()),
              pa.field("pairs", pa.list_(pa.int64())), pa.field("times", pa.list_(pa.int64()))]

    @F.arrow_udf(LOOKED)
    def look_up(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pair, n, best = (np.frombuffer(raw, kind) for raw, kind in zip(table.value, (np.int64, np.int64, np.bool_)))
        for codes, times in columns:
            size = np.diff(codes.offsets.to_numpy())
            flat, many = codes.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.searchsorted(pair, flat)
            hit = at < pair.size
            hit[hit] = pair[at[hit]] == flat[hit]
            found = at[hit]
            owner = np.repeat(np.arange(size.size), size)
            sums = np.zeros((2, size.size), np.int64)
            np.add.at(sums[0], owner[hit], many[hit] * best[found])
            np.add.at(sums[1], owner[hit], many[hit] * n[found])
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[~hit], minlength=size.size))]).astype(np.int32))
            yield pa.StructArray.from_arrays([
                pa.array(sums[0]), pa.array(sums[1]), pa.ListArray.from_arrays(offsets, pa.array(flat[~hit])),
                pa.ListArray.from_arrays(offsets, pa.array(many[~hit]))], fields=fields)

    return look_up


def link_counts(aligned: DataFrame, key: str, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """``aligned`` (``key``: a number of its own for each row) with n_best and
    count_sum instead of pairs and times."""
    counts = cut_lineage(pair_counts(aligned))
    top = counts.orderBy(F.desc("n"), "pair").limit(table_pairs).toPandas().sort_values("pair")
    table = aligned.sparkSession.sparkContext.broadcast((
        top["pair"].to_numpy(np.int64).tobytes(), top["n"].to_numpy(np.int64).tobytes(), top["best"].to_numpy(bool).tobytes()))
    name = free_name(aligned, "looked")
    looked = aligned.withColumn(name, _look_up(table)("pairs", "times"))
    rest = [c for c in aligned.columns if c not in ("pairs", "times")]
    if len(top) < table_pairs or counts.count() == len(top):  # every pair is in the table
        return looked.select(*rest, f"{name}.n_best", f"{name}.count_sum")
    # pairs beyond the table: rare ones, so that no pair has many rows
    missed = (looked.select(key, F.explode(F.arrays_zip(f"{name}.pairs", f"{name}.times")).alias("x"))
              .select(key, F.col("x.pairs").alias("pair"), F.col("x.times").alias("many"))
              .join(counts, "pair").groupBy(key)
              .agg(F.sum(F.col("many") * F.col("best").cast("bigint")).alias("__best"),
                   F.sum(F.col("many") * F.col("n")).alias("__sum")))
    zero = F.lit(0).cast("bigint")
    return (looked.join(missed, key, "left").select(
        *rest, (F.col(f"{name}.n_best") + F.coalesce("__best", zero)).alias("n_best"),
        (F.col(f"{name}.count_sum") + F.coalesce("__sum", zero)).alias("count_sum")))


def align_tokens(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text",
                 table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    ``path_a``: a byte-level vocabulary (.json), ``path_b``: a sentencepiece model;
    strings of special tokens in a text are plain text.  A null or empty text, and
    one whose tokens do not spell a space and the text (sentencepiece shows U+2581
    as a space, say), has no tokens: zeros and ''.  Each group has one link, that
    of the two tokens that end it.  Repeated rows, null ids and further columns are
    allowed; every copy of a row counts.
    """
    spark = docs.sparkSession
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    vocabulary, model = VocabularyFile(spark, path_a), Tokenizer(spark, path_b)
    got = struct_of(F.col("text"), SCHEMA, lambda: _aligned(vocabulary, model), RUN_BYTES)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/aligned-{uuid.uuid4().hex}"
    kept.select("doc_id", got.alias("x")).select("doc_id", "x.*").withColumn(
        "row", F.monotonically_increasing_id()).write.parquet(path)
    counted = link_counts(spark.read.parquet(path), "row", table_pairs)
    return counted.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum",
                          "groups_sha256")
