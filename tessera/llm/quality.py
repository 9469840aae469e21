"""Quality rules whose cutoffs carry a guarantee on clean documents.

Every rule compares one statistic of a text with a cutoff.  Cutoffs are chosen
per stratum (the document's language) from labelled documents so that, with
confidence ``1 - delta`` over all strata and rules together, all rules of a
stratum reject at most a share ``alpha`` of its good documents:

* a rule may spend ``alpha / number of rules``;
* whether a cutoff keeps within that share is decided by the exact binomial
  bound: with k of n good holdout documents rejected, the chance of k or fewer
  rejections at that share must not exceed the level (the upper
  Clopper-Pearson bound lies below the share);
* the level is ``delta / (strata * rules)`` (Bonferroni); along a rule's
  cutoffs, tested from the most lenient on, testing stops at the first one that
  fails (fixed-sequence testing), which needs no further correction.

Of the cutoffs that hold, the one that best tells bad from good holdout
documents is taken, ties to the most lenient; a rule that rejects no more bad
than good ones is left out.  A stratum with too few labels gets no cutoff.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.llm.columns import RunFn, free_name, struct_of
from tessera.session import cut_lineage

#: Share of a stratum's good documents that its rules may reject, and the
#: chance that this fails anywhere.
ALPHA, DELTA = 0.05, 0.05
#: Base rules: fewer words than this, or a larger share of repeated words, fail.
LEAST_WORDS, MOST_REPEATED = 20, 0.30
WINDOW = 8
#: Most rows of the cutoff table that is broadcast; a longer one is joined.
BROADCAST_ROWS = 10_000

#: Rule: cutoffs of its statistic from the most lenient on (larger is worse).
CUTOFFS: dict[str, list[float]] = {
    "symbols": [2.0, 1.5, 1.0, 0.75, 0.5, 0.3, 0.2, 0.1, 0.05],
    "dup_lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
    "repeats": [0.3, 0.25, 0.2, 0.15, 0.1, 0.05],
    "upper": [0.9, 0.7, 0.5, 0.3, 0.2, 0.1],
    "long_words": [12.0, 10.0, 9.0, 8.0, 7.5, 7.0, 6.5],
    "short_words": [-2.0, -2.5, -3.0, -3.5, -4.0, -4.25],
}

STATS = T.StructType([T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")])

_SPACES = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_MIX = np.random.default_rng(42).integers(1 << 62, 1 << 63, WINDOW, np.uint64) | np.uint64(1)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.uint64, len(words))
    mixed = np.zeros(n, np.uint64)
    for k in range(width):
        mixed += (ids[k:k + n] + np.uint64(1)) * _MIX[k % WINDOW] * np.uint64(2 * (k // WINDOW) + 1)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return 0
    # equal windows have equal sums; that equal sums are equal windows is checked
    near = np.flatnonzero(same)
    a, b = order[near], order[near + 1]
    equal = np.ones(near.size, bool)
    for k in range(width):
        equal &= ids[a + k] == ids[b + k]
    if equal.all():
        starts = np.unique(np.concatenate([a, b]))
    else:
        seen: dict[tuple, list[int]] = {}
        for at in np.unique(np.concatenate([a, b])).tolist():
            seen.setdefault(tuple(ids[at:at + width].tolist()), []).append(at)
        starts = np.array([at for group in seen.values() if len(group) > 1 for at in group], np.int64)
    cover = np.zeros(len(words) + 1, np.int64)
    cover[starts] += 1
    np.subtract.at(cover, starts + width, 1)
    return int(np.count_nonzero(np.cumsum(cover)[:-1]))


def _stats() -> RunFn:
    def work(run: list[bytes | None]) -> dict:
        out: dict[str, list[int]] = {f.name: [] for f in STATS.fields}
        for text in run:
            text = text or b""
            words = text.split()  # of bytes: at U+0020 and U+0009 to U+000D
            lines = [line for line in text.split(b"\n") if line.strip()]
            out["n_words"].append(len(words))
            out["word_chars"].append(len(text.translate(None, _SPACES).decode("utf-8", "replace")))
            out["n_symbols"].append(len(text) - len(text.translate(None, _SYMBOLS)))
            out["n_dup_lines"].append(len(lines) - len(set(lines)))
            out["n_repeat_words"].append(repeated_words(words))
            out["n_lines"].append(len(lines))
            out["n_upper"].append(sum(map(bytes.isupper, words)))
        return out

    return work


def text_stats(text: Column) -> Column:
    """The statistics of a text as one struct (null text: as if empty)."""
    return struct_of(text, STATS, _stats)


def base_failed(s: str) -> Column:
    """The two rules that need no labels, over the struct column ``s``."""
    words = F.col(f"{s}.n_words")
    return (words < LEAST_WORDS) | (100 * F.col(f"{s}.n_repeat_words") > round(100 * MOST_REPEATED) * words)


def measures(s: str) -> dict[str, Column]:
    """The statistic of each rule over the struct column ``s`` (0 words or
    lines: 0, such texts fail the base rules)."""
    col = lambda c: F.col(f"{s}.{c}")
    per = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return {
        "symbols": per(col("n_symbols"), col("n_words")),
        "dup_lines": per(col("n_dup_lines"), col("n_lines")),
        "repeats": per(col("n_repeat_words"), col("n_words")),
        "upper": per(col("n_upper"), col("n_words")),
        "long_words": per(col("word_chars"), col("n_words")),
        "short_words": -per(col("word_chars"), col("n_words")),
    }


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p): the regularised incomplete beta function
    I_{1-p}(n - k, k + 1) by its continued fraction."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    a, b, x = float(n - k), float(k + 1), 1.0 - p
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta(b, a, 1.0 - x)
    return _beta(a, b, x)


def _beta(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
    value = d
    for m in range(1, 100_000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
            c = 1.0 + top / c
            c = c if abs(c) > 1e-300 else 1e-300
            value *= c * d
        if abs(c * d - 1.0) < 1e-14:
            break
    return front * value


def choose_cutoffs(stats: DataFrame, labels: DataFrame, s: str, doc_id: str = "doc_id",
                   stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA,
                   cutoffs: dict[str, list[float]] = CUTOFFS) -> DataFrame:
    """Cutoffs that hold, one row per stratum: the stratum, then one column a
    rule (null: the rule is not used there).

    ``stats`` has ``doc_id``, ``stratum`` and the struct column ``s``;
    ``labels`` has doc_id and quality (1 good, 0 bad).  Rows without a doc_id
    or quality and ids with both labels are not used; equal labels count once.
    A null stratum is a stratum.

    The bound is on independent documents, so an id counts once in a stratum,
    however often its row is repeated there; an id whose rows differ in what the
    rules say of them (several texts under one id) is not used there.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
             .groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("good"), F.max("quality").alias("__most"))
             .where(F.col("good") == F.col("__most")).drop("__most"))
    m = measures(s)
    # the bin of a value is how many cutoffs it lies beyond; a cutoff's step is the least bin beyond it
    bins = F.array(*[F.struct(
        F.lit(rule).alias("rule"),
        sum(F.when(m[rule] > c, 1).otherwise(0) for c in cutoffs[rule]).alias("bin")) for rule in cutoffs])
    held = (stats.where(~base_failed(s))
            .select(F.col(doc_id).alias("__id"), F.col(stratum).alias("stratum"), bins.alias("bins"))
            # repeated rows are folded before the shuffle: none meets its label more than once
            .groupBy("__id", "stratum").agg(F.min("bins").alias("bins"), F.max("bins").alias("__most"))
            .where(F.col("bins") == F.col("__most"))
            .join(known, "__id").select("stratum", "good", F.explode("bins").alias("x"))
            .groupBy("stratum", "x.rule", "x.bin")
            .agg(F.sum("good").cast("bigint").alias("good"), F.sum(1 - F.col("good")).cast("bigint").alias("bad")))
    # from here on a row is a stratum, rule and cutoff: counts, not documents
    group = Window.partitionBy("stratum", "rule")
    steps = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(len(cutoffs[rule]) - k).alias("step"),
                               F.lit(float(c)).alias("cutoff")) for rule in cutoffs for k, c in enumerate(cutoffs[rule])])
    grid = (held.groupBy("stratum").agg(F.lit(1).alias("__one")).select("stratum", F.explode(steps).alias("g"))
            .select("stratum", "g.rule", "g.step", "g.cutoff"))
    both = (grid.withColumnRenamed("step", "bin")
            .unionByName(held, allowMissingColumns=True)
            .groupBy("stratum", "rule", "bin")
            .agg(F.max("cutoff").alias("cutoff"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                 F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    beyond = group.orderBy("bin").rowsBetween(0, Window.unboundedFollowing)
    counts = both.select(
        "stratum", "rule", "bin", "cutoff", F.sum("good").over(beyond).alias("k"), F.sum("bad").over(beyond).alias("k_bad"),
        F.sum("good").over(group).alias("n"), F.sum("bad").over(group).alias("n_bad")).where("cutoff is not null")
    share = alpha / len(cutoffs)
    n_strata = held.where("good > 0").select("stratum").distinct().count()
    level = delta / max(1, n_strata * len(cutoffs))

    @F.pandas_udf("double")
    def chance(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([binomial_cdf(int(a), int(b), share) if b > 0 else 1.0 for a, b in zip(k, n)])

    tested = (counts.withColumn("p", chance("k", "n"))
              .withColumn("worst", F.max("p").over(group.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)))
              .where(F.col("worst") <= level)
              .withColumn("gain", F.col("k_bad") / F.greatest("n_bad", F.lit(1)) - F.col("k") / F.col("n"))
              .where("gain > 0"))
    return (tested.groupBy("stratum").pivot("rule", list(cutoffs))
            .agg(F.max_by("cutoff", F.struct("gain", "bin"))))


def verdicts(rows: DataFrame, cutoffs: DataFrame, s: str, stratum: str = "lang") -> DataFrame:
    """``rows`` with two more columns, base_failed and kept.  ``cutoffs``: of
    ``choose_cutoffs``; broadcast when it has at most ``BROADCAST_ROWS`` rows."""
    small = cutoffs.count() <= BROADCAST_ROWS
    rules = [c for c in cutoffs.columns if c != "stratum"]
    table = cutoffs.select(F.col("stratum").alias("__stratum"), F.struct(*rules).alias("__cut"))
    table = F.broadcast(table) if small else table
    m = measures(s)
    rejected = F.lit(False)
    for rule in rules:
        rejected = rejected | F.coalesce(m[rule] > F.col(f"__cut.{rule}"), F.lit(False))
    joined = rows.join(table, F.col(stratum).eqNullSafe(F.col("__stratum")), "left")
    return (joined.withColumn("base_failed", base_failed(s))
            .withColumn("kept", ~F.col("base_failed") & ~rejected).drop("__stratum", "__cut"))


def quality_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per row of ``docs``: doc_id, the statistics, base_failed, kept.

    Null and empty texts have no words and fail.  With no usable label (an
    empty ``labels``, say) the base rules alone decide.  Repeated rows are
    judged each; further columns of both tables are not read.
    """
    stats = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).cast("string").alias("lang"),
                                    text_stats(F.col(text)).alias("s")))
    cutoffs = cut_lineage(choose_cutoffs(stats, labels, "s", alpha=alpha, delta=delta))
    return verdicts(stats, cutoffs, "s").select(
        "doc_id", "s.n_words", "s.word_chars", "s.n_symbols", "s.n_dup_lines", "s.n_repeat_words",
        "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
              stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Two passes over the texts, none of which shuffles them: the first leaves
    narrow statistics from which the cutoffs are chosen, the second judges each
    row where it is."""
    held = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).cast("string").alias("lang"),
                                   text_stats(F.col(text)).alias("s")))
    cutoffs = cut_lineage(choose_cutoffs(held, labels, "s", alpha=alpha, delta=delta))
    s = free_name(docs, "quality")
    judged = verdicts(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        text_stats(F.col(text)).alias(s), F.col(stratum).cast("string").alias("__lang")),
        cutoffs, s, "__lang")
    return judged.where("kept").select("__row.*")
