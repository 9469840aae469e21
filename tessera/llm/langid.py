"""Language identification by error-correcting output codes.

Every language gets a codeword of bits; for each bit a binary classifier over
character n-grams predicts whether the text's language has a one there.  A text
gets the language whose codeword loses least: the logistic loss of each bit's
margin, weighted by how well that bit's classifier separates the languages it
was fitted on.  When the two best codewords lose nearly the same the text is
flagged as ambiguous.

N-grams are hashed (lengths 1 to 3 over lower-case letters, everything else one
word break), a text's features are the square roots of its n-gram shares, so
texts of all lengths look alike.  The classifiers are logistic regressions
fitted with numpy on a bounded sample of the labelled rows, in equal parts per
language; only hashed features of the sample reach the driver.  Prediction
counts the n-grams of the whole text, in runs of bounded memory.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.llm.columns import RunFn, free_name, struct_of, text_runs

#: The sample that the classifiers are fitted on: at most so many documents,
#: and so many of one language.
SAMPLE_DOCUMENTS, SAMPLE_PER_LANGUAGE = 2000, 400
DIMENSIONS = 1 << 12
LONGEST_GRAM = 3
#: Up to so many languages all codewords are used (2^(k-1) - 1 bits).
EXHAUSTIVE = 6
#: Difference of the two best languages' probabilities below which a text is
#: ambiguous.
AMBIGUOUS = 0.1
UNKNOWN = "und"
STEPS, RATE, PENALTY = 300, 4.0, 1e-4
#: Code points worked on at once.
PART = 1 << 18

_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point its lower-case form if it is a letter, else 0 (a
    word break)."""
    if not _TABLE:
        table = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            c = chr(point)
            if c.isalpha():
                low = c.lower()
                table[point] = ord(low) if len(low) == 1 else point
        _TABLE.append(table)
    return _TABLE[0]


def gram_counts(text: bytes, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Counts of the hashed n-grams of the whole text; None if it has no
    letter."""
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), "<u4")
    table = _letters()
    total = np.zeros(dimensions, np.int64)
    found = False
    tail = np.zeros(1, np.uint32)  # a text begins after a break
    bits = np.uint32(32 - (dimensions.bit_length() - 1))
    for at in range(0, max(codes.size, 1), PART):
        part = table[codes[at:at + PART]]
        found = found or bool(part.any())
        end = at + PART >= codes.size
        part = np.concatenate([tail, part, np.zeros(1 if end else 0, np.uint32)])
        keep = np.empty(part.size, bool)  # one break for a run of breaks
        keep[0] = True
        np.logical_or(part[1:] != 0, part[:-1] != 0, out=keep[1:])
        part = part[keep]
        # n-grams that end in the part now added; the tail carries what precedes
        done = min(tail.size, part.size)
        for n in range(1, LONGEST_GRAM + 1):
            if part.size < n:
                continue
            h = np.zeros(part.size - n + 1, np.uint32)
            for k in range(n):
                h = (h ^ part[k:k + h.size]) * _FACTORS[k]
            h ^= h >> np.uint32(15)
            h = (h + np.uint32(n)) * np.uint32(0x27D4EB2F)
            first = max(0, done - n + 1) if at else 0
            total += np.bincount(h[first:] >> bits, minlength=dimensions)
        tail = part[-(LONGEST_GRAM - 1):] if part.size >= LONGEST_GRAM else part
    return total if found else None


def _features(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def codewords(k: int) -> np.ndarray:
    """A k x bits matrix of -1 and 1.  Few languages: every way to divide them
    into two parts.  More: random columns (fixed seed), of which those are kept
    that make the closest pair of rows differ most."""
    if k == 1:
        return np.ones((1, 1), np.int8)
    if k <= EXHAUSTIVE:
        columns = [(1, *rest) for rest in itertools.product((1, -1), repeat=k - 1)][1:]
        return np.array(columns, np.int8).T
    bits = int(np.ceil(10 * np.log2(k)))
    rng = np.random.default_rng(42)
    best, best_gap = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (k, bits))
        gap = int(((bits - code.astype(int) @ code.T.astype(int)) // 2 + bits * np.eye(k, dtype=int)).min())
        split = np.abs(code.astype(int).sum(0)).max() < k
        if split and gap > best_gap:
            best, best_gap = code, gap
    return best


class Model:
    """Languages, their codewords, one linear classifier per bit and the bit
    weights of the decoding."""

    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray,
                 trust: np.ndarray):
        self.languages, self.code = languages, code
        self.weights, self.bias, self.trust = weights, bias, trust

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the languages for each row of features, and the
        margins of the bits."""
        margins = x @ self.weights + self.bias
        # loss of language l: sum over bits of trust * log(1 + exp(-code * margin))
        loss = np.logaddexp(0.0, -self.code[None, :, :] * margins[:, None, :]) @ self.trust
        fit = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        return fit / fit.sum(axis=1, keepdims=True), margins


def fit(features: np.ndarray, labels: list[str]) -> Model | None:
    """The model of a sample; None without rows."""
    if not len(labels):
        return None
    languages = sorted(set(labels))
    index = {name: k for k, name in enumerate(languages)}
    code = codewords(len(languages))
    y = code[[index[v] for v in labels]].astype(np.float32)
    rows, bits = y.shape
    weights, bias = np.zeros((features.shape[1], bits), np.float32), np.zeros(bits, np.float32)
    if len(languages) == 1:
        return Model(languages, code, weights, bias + 1, np.ones(bits))
    counts = np.bincount([index[v] for v in labels], minlength=len(languages))
    share = (1.0 / counts[[index[v] for v in labels]] / len(languages)).astype(np.float32)[:, None]
    v, vb, last, last_b = weights.copy(), bias.copy(), weights, bias
    for step in range(STEPS):  # accelerated gradient descent
        pull = -share * y / (1 + np.exp(np.clip(y * (features @ v + vb), -30, 30)))
        new = v - RATE * (features.T @ pull + PENALTY * v)
        new_b = vb - RATE * pull.sum(axis=0)
        ahead = step / (step + 3)
        v, vb = new + ahead * (new - last), new_b + ahead * (new_b - last_b)
        last, last_b = new, new_b
    right = (share * ((features @ last + last_b) * y > 0)).sum(axis=0)
    trust = np.clip(2 * right - 1, 0.05, 1.0).astype(np.float64)  # 0: a coin, 1: always right
    scale = 8.0  # margins of square-root shares are small; sharpened for decoding
    return Model(languages, code, last * scale, last_b * scale, trust / trust.sum())


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
          sample: int = SAMPLE_DOCUMENTS, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Fits a model on a sample of the rows that have text and language.

    The sample has at most ``sample`` documents, at most ``per_language`` of a
    language, chosen by a hash of id and text.  Null if there is no such row.
    """
    known = (docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"),
                         F.xxhash64(F.col(doc_id).cast("string"), F.col(text).cast("string")).alias("h"))
             .where("text is not null and lang is not null").where(F.col("text").rlike(r"\p{L}")))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    listed = sizes.orderBy(F.desc("n"), "lang").limit(sample).collect()
    if not listed:
        return None
    each = max(1, min(per_language, sample // len(listed)))
    # a hash below a language's bound: about twice as many rows as wanted, then the first of them
    bound = F.create_map(*[F.lit(v) for r in listed
                           for v in (r["lang"], int(2 ** 64 * min(1.0, 2 * each / r["n"])) - 2 ** 63 - 1)])
    some = known.withColumn("bound", bound[F.col("lang")]).where("h <= bound").dropDuplicates(["lang", "h"])
    first = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))
    chosen = some.withColumn("row", F.row_number().over(first)).where(F.col("row") <= each).select("lang", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            vectors = []
            for run in text_runs(batch.column(1)):
                vectors += [gram_counts(t or b"") for t in run]
            ok = [k for k, v in enumerate(vectors) if v is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in ok], pa.string()),
                 pa.array([_features(vectors[k]).tobytes() for k in ok], pa.binary())], names=["lang", "x"])

    got = chosen.mapInArrow(features, "lang string, x binary").orderBy("lang", "x").collect()
    if not got:
        return None
    return fit(np.stack([np.frombuffer(r["x"], np.float32) for r in got]), [r["lang"] for r in got])


SCHEMA = T.StructType([
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("second", T.StringType()),
    T.StructField("ambiguous", T.BooleanType()),
])


def predict(docs: DataFrame, model: Model | None, text: Column, ambiguous: float = AMBIGUOUS) -> Column:
    """A struct column lang_pred, score (the decoded probability), second (the
    next language) and ambiguous.  A text that is null or has no letter gets
    ``und`` with score 0; so does every text when there is no model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> RunFn:
        m = shared.value

        def work(run: list[bytes | None]) -> dict:
            counts = [gram_counts(t) if t and m else None for t in run]
            rows = [k for k, c in enumerate(counts) if c is not None]
            names: list[str] = [UNKNOWN] * len(run)
            second: list[str | None] = [None] * len(run)
            score, unsure = [0.0] * len(run), [False] * len(run)
            for at in range(0, len(rows), 256):
                part = rows[at:at + 256]
                p, _ = m.decode(np.stack([_features(counts[k]) for k in part]))
                order = np.argsort(-p, axis=1, kind="stable")
                for row, chances, ranked in zip(part, p, order):
                    names[row], score[row] = m.languages[ranked[0]], float(chances[ranked[0]])
                    if len(ranked) > 1:
                        second[row] = m.languages[ranked[1]]
                        unsure[row] = bool(chances[ranked[0]] - chances[ranked[1]] < ambiguous)
            return {"lang_pred": names, "score": score, "second": second, "ambiguous": unsure}

        return work

    return struct_of(text, SCHEMA, make)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32(id as text) mod 4 is 2 (a
    null id is never held out, and never learned from either)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def language_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, second,
    ambiguous.

    The model learns from text and language of documents that are not held
    out.  Null or letterless texts are ``und``.  Repeated rows, null ids and
    further columns are allowed; an empty or unlabelled table gives ``und``
    throughout."""
    model = train(docs.where(F.crc32(F.col(doc_id).cast("string")) % 4 != 2), text, lang, doc_id)
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    name = free_name(kept, "language")
    return (kept.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        predict(kept, model, F.col("text")).alias(name))
            .select("doc_id", "held_out", f"{name}.*"))


def keep_known(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is recognised, with all their
    columns: those that are ``und`` or ambiguous go.  With nothing to learn
    from (no document that is not held out has a language and a letter) only
    texts without a letter go."""
    model = train(docs.where(F.crc32(F.col(doc_id).cast("string")) % 4 != 2), text, lang, doc_id)
    if model is None:
        return docs.where(F.col(text).rlike(r"\p{L}"))
    name = free_name(docs, "language")
    return (docs.withColumn(name, predict(docs, model, F.col(text)))
            .where((F.col(f"{name}.lang_pred") != UNKNOWN) & ~F.col(f"{name}.ambiguous")).drop(name))
