"""Document fingerprints as invertible Bloom lookup sketches of paragraphs,
with DataFrame functions only.

A paragraph's digest goes into one cell of each of three tables; a cell keeps
how many digests it has and the exclusive or of them and of their check sums.
Subtracting the cells of two versions leaves the digests that differ.  A cell
with one digest left gives it away; taking it out of its other cells frees
further ones, and so on (peeling).  If some cannot be peeled, the sketch was
too small for the difference: both versions are sketched again, larger.  A
larger sketch is dealt into buckets by a hash, each with tables of its own, so
sketching and peeling stay near linear in the number of paragraphs; a bucket
that still does not peel is sketched larger by itself.

Paragraphs are the lines of a text that are not blank; a text's sketch is over
its distinct paragraphs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.columns import free_name
from tessera.session import cut_lineage

#: Tables of a sketch and cells of a table (a power of two): first, and for
#: buckets that do not peel.
TABLES = 3
WIDTH, LARGER = 16, (16, 64, 256)
#: Digests aimed at for a bucket of a larger sketch.
BUCKET = 8
ROUNDS = 40


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def digests(text: Column) -> Column:
    """Digests of the distinct paragraphs of a text."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(F.translate(x, "\t\r\x0b\x0c", "    ")) != "")
    return F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check")).bitwiseAND(F.lit((1 << 32) - 1))


def _place(key: Column, table: int, width: Column) -> Column:
    """The cell of a digest in one of the tables."""
    h = F.xxhash64(key, width)
    return F.shiftrightunsigned(h, 20 * table).bitwiseAND(width - 1)


def _cell(n: Column, key: Column, check: Column) -> Column:
    return F.struct(n.cast("bigint").alias("n"), key.alias("key"), check.alias("check"))


def _zero() -> Column:
    return _cell(F.lit(0), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))


def sketch(keys: Column, width: Column) -> Column:
    """The cells of a set of digests: ``TABLES`` tables of ``width`` cells
    (a bigint), one after another."""
    def tables(entries: Column) -> Column:
        def cell(table: int) -> Callable[[Column], Column]:
            return lambda i: F.aggregate(
                F.filter(entries, lambda e: e[f"at{table}"] == i), _zero(),
                lambda c, e: _cell(c["n"] + 1, c["key"].bitwiseXOR(e["key"]), c["check"].bitwiseXOR(e["check"])))
        every = F.sequence(F.lit(0).cast("bigint"), width - 1)
        return F.concat(*[F.transform(every, cell(t)) for t in range(TABLES)])

    entries = F.transform(keys, lambda d: F.struct(
        d.alias("key"), _check(d).alias("check"), *[_place(d, t, width).alias(f"at{t}") for t in range(TABLES)]))
    return _let(entries, tables)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: _cell(
        x["n"] - y["n"], x["key"].bitwiseXOR(y["key"]), x["check"].bitwiseXOR(y["check"])))


def peel(cells: Column, width: Column) -> Column:
    """The digests left in subtracted cells, as an array of (key, n): n is 1
    for the first version's, -1 for the second's; null if some stay hidden."""
    none = F.array().cast("array<struct<key:bigint,n:bigint>>")
    start = F.struct(cells.alias("cells"), none.alias("found"), F.lit(False).alias("over"))

    def step(s: Column) -> Column:
        pure = F.array_distinct(F.transform(
            F.filter(s["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"]))),
            lambda c: F.struct(c["key"].alias("key"), c["n"].alias("n"))))

        def take(p: Column) -> Column:
            placed = F.transform(p, lambda x: F.struct(
                x["key"].alias("key"), x["n"].alias("n"), _check(x["key"]).alias("check"),
                *[_place(x["key"], t, width).alias(f"at{t}") for t in range(TABLES)]))

            def table(q: Column, t: int) -> Column:
                return F.transform(F.slice(s["cells"], (t * width + 1).cast("int"), width.cast("int")), lambda c, i: F.aggregate(
                    F.filter(q, lambda x: x[f"at{t}"] == i), c,
                    lambda left, x: _cell(left["n"] - x["n"], left["key"].bitwiseXOR(x["key"]),
                                          left["check"].bitwiseXOR(x["check"]))))

            def without(q: Column) -> Column:
                return F.concat(*[table(q, t) for t in range(TABLES)])

            return F.struct(_let(placed, without).alias("cells"), F.concat(s["found"], p).alias("found"),
                            (F.size(p) == 0).alias("over"))

        return _let(pure, take)

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, _: F.when(s["over"], s).otherwise(step(s)))
    empty = lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)
    return _let(done, lambda s: F.when(F.forall(s["cells"], empty), s["found"]))


def _dealt(keys: Column, first: Column, second: Column) -> Column:
    """The digests dealt into ``first * second`` buckets by a hash, in two
    steps, so that each digest is looked at ``first + second`` times."""
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    h = lambda d: F.xxhash64(d, F.lit("bucket"))
    coarse = F.transform(upto(first), lambda a: F.filter(keys, lambda d: F.pmod(h(d), first) == a))
    return F.flatten(F.transform(coarse, lambda some: F.transform(
        upto(second), lambda b: F.filter(some, lambda d: F.pmod(F.shiftrightunsigned(h(d), 32), second) == b))))


def _exact(a: Column, b: Column) -> Column:
    tag = lambda keys, n: F.transform(keys, lambda d: F.struct(d.alias("key"), F.lit(n).cast("bigint").alias("n")))
    return F.concat(tag(F.array_except(a, b), 1), tag(F.array_except(b, a), -1))


def _again(a: Column, b: Column) -> Column:
    """The differing digests from larger sketches of both versions.  A bucket
    that no size peels (its digests would have to collide in all of them) is
    compared digest by digest."""
    bits = F.ceil(F.log2(F.greatest(F.lit(1.0), (F.size(a) + F.size(b)) / BUCKET))).cast("int")
    power = lambda n: F.pow(F.lit(2.0), n).cast("bigint")
    first, second = power(F.floor(bits / 2)), power(bits - F.floor(bits / 2))
    pairs = F.arrays_zip(_dealt(a, first, second).alias("a"), _dealt(b, first, second).alias("b"))
    found = "array<struct<key:bigint,n:bigint>>"

    def bucket(p: Column) -> Column:
        tried = F.aggregate(F.array(*[F.lit(w).cast("bigint") for w in LARGER]), F.lit(None).cast(found), lambda got, w: F.coalesce(
            got, peel(subtract(sketch(p["a"], w), sketch(p["b"], w)), w)))
        return F.coalesce(tried, _exact(p["a"], p["b"]))

    return F.flatten(F.transform(pairs, bucket))


def _first() -> Column:
    return F.lit(WIDTH).cast("bigint")


def differing(cells_a: Column, cells_b: Column, keys_a: Column, keys_b: Column) -> Column:
    """The digests in which two versions differ (as ``peel`` gives them), from
    their sketches, or from larger ones if those do not peel."""
    return F.coalesce(peel(subtract(cells_a, cells_b), _first()), _again(keys_a, keys_b))


def likeness(found: Column, keys_a: Column, keys_b: Column) -> Column:
    """Shared paragraphs as a share of all (two texts without any: 1)."""
    both = F.size(keys_a) + F.size(keys_b)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - F.size(found)) / (both + F.size(found)))


def as_text(text: Column, keys: Column, cells: Column) -> Column:
    """A fingerprint as one string: the text's hash, the number of its
    paragraphs and the cells (count, digest, check; empty ones blank)."""
    shown = F.transform(cells, lambda c: F.when(c["n"] == 0, F.lit("")).otherwise(
        F.concat_ws(".", c["n"].cast("string"), F.hex(c["key"]), F.hex(c["check"]))))
    return F.lower(F.concat_ws("|", F.hex(F.xxhash64(text)), F.size(keys).cast("string"), F.array_join(shown, ",")))


def paragraph_differences(df: DataFrame, a: str, b: str, out: str = "differences") -> DataFrame:
    """``df`` with a column of the paragraph digests in which the texts ``a``
    and ``b`` differ, as (key, n): n is 1 if only ``a`` has it, -1 if only
    ``b``.  Null texts are empty."""
    names = [free_name(df, n) for n in ("keys_a", "keys_b")]
    keyed = df.withColumns({n: digests(F.coalesce(F.col(c), F.lit(""))) for n, c in zip(names, (a, b))})
    ka, kb = map(F.col, names)
    return keyed.withColumn(out, differing(sketch(ka, _first()), sketch(kb, _first()), ka, kb)).drop(*names)


def _search(cuts: list[Column], value: Column) -> Column:
    """How many of the ascending ``cuts`` are not above ``value`` (halving)."""
    if not cuts:
        return F.lit(0)
    table = F.array(*cuts)
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(
        (at + s <= len(cuts)) & (F.get(table, at + s - 1) <= value), at + s).otherwise(at))


def with_next(docs: DataFrame, order: list[str], carried: list[str]) -> DataFrame:
    """``docs`` with the columns ``carried`` of the next row (as the struct
    ``next``) in descending order of ``order`` (nulls last; after the last the
    first).

    The order is cut into ranges; within a range a window finds the next row,
    and the top row of each range is also given to the range above it, where it
    comes last.  Cuts and tops are a row per range, so their number is that of
    the tasks, not of the rows."""
    spark = docs.sparkSession
    ranges = 2 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kinds = {c: docs.schema[c].dataType for c in order}
    ids = docs.select(*order)
    dealt = cut_lineage(ids.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()))
    bounds = dealt.groupBy("range").agg(F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high"))
    bounds = sorted(bounds.collect(), key=lambda r: r["range"])
    literal = lambda row: F.struct(*[F.lit(row[c]).cast(kinds[c]).alias(c) for c in order])
    # equal keys may straddle two ranges: a cut is the least key of a range, so they all go to the upper one
    cuts = [r["low"] for r in bounds[1:]]
    cuts = [c for k, c in enumerate(cuts) if k == 0 or c != cuts[k - 1]]
    key = F.struct(*order)
    bucket = _search([literal(c) for c in cuts], key)
    tops = cut_lineage(dealt.select(key.alias("key"), bucket.alias("bucket")).groupBy("bucket").agg(F.max("key").alias("top")))
    listed = sorted(tops.collect(), key=lambda r: r["bucket"])
    # a bucket's top row comes last in the next bucket above that has rows
    above = {r["bucket"]: listed[(k + 1) % len(listed)]["bucket"] for k, r in enumerate(listed)}
    copies = F.broadcast(tops.select("top", F.create_map(*[F.lit(x) for pair in above.items() for x in pair])[
        F.col("bucket")].alias("above"))) if listed else None
    if copies is None:
        return docs.withColumn("next", F.struct(*carried))
    both = docs.join(copies, F.struct(*order).eqNullSafe(F.col("top")), "left").withColumn("x", F.explode(F.when(
        F.col("above").isNull(), F.array(F.struct(bucket.alias("bucket"), F.lit(0).alias("ghost")))).otherwise(
        F.array(F.struct(bucket.alias("bucket"), F.lit(0).alias("ghost")),
                F.struct(F.col("above").alias("bucket"), F.lit(1).alias("ghost")))))).drop("top", "above")
    w = Window.partitionBy("x.bucket").orderBy("x.ghost", *[F.col(c).desc_nulls_last() for c in order])
    return both.withColumn("next", F.lead(F.struct(*carried)).over(w)).where("x.ghost = 0").drop("x")


def edit_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 2) characters replaced by the
    first as many of the next document's (descending doc_id, nulls last, ties
    by a hash of the text; the last is followed by the first).  A null text is
    empty.  Two texts without paragraphs are alike (1).  Further columns are
    not read; an empty table gives no rows."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    keyed = (rows.withColumn("keys", digests(F.col("text")))
             .withColumn("cells", sketch(F.col("keys"), _first())))
    paired = with_next(keyed, ["doc_id", "hash"], ["text", "keys", "cells"])
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.char_length("text") - half),
                      F.substring("next.text", F.lit(1), half))
    out = (paired.withColumn("edited", edited)
           .withColumn("edited_keys", digests(F.col("edited")))
           .withColumn("edited_cells", sketch(F.col("edited_keys"), _first())))
    c = F.col
    versions = F.array(F.struct(c("edited_keys").alias("keys"), c("edited_cells").alias("cells")),
                       F.struct(c("next.keys").alias("keys"), c("next.cells").alias("cells")))
    near = F.transform(versions, lambda v: likeness(
        differing(c("cells"), v["cells"], c("keys"), v["keys"]), c("keys"), v["keys"]))
    return out.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(c("text"), c("keys"), c("cells")).alias("fingerprint"),
        as_text(c("edited"), c("edited_keys"), c("edited_cells")).alias("edited_fingerprint"),
        near.alias("near")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        F.col("near")[0].alias("near_edited"), F.col("near")[1].alias("near_next"))
