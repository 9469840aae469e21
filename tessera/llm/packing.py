"""Packing documents into sequences of a fixed number of tokens.

Documents are cut into pieces that fit, and how many pieces there are of each
length is all that the packing needs: at most ``capacity`` numbers, whatever
the data.  Over this histogram the configuration linear program (fewest
sequences, a configuration being a multiset of lengths that fits into one) is
solved by multiplicative weights: a length's weight falls as it gets covered,
and a knapsack dynamic program finds the configurations of largest weight.  The
fractional solution is rounded down to whole sequences and then up by largest
remainder, what is left is solved again, and the rest is packed by best fit over lengths with their counts.  As
usual for such schemes the program is over the larger lengths alone; short
pieces (under a sixteenth of a sequence) then fill the room it leaves.

The plan (which configuration how often) is a small table.  Pieces are numbered
within their length by a distributed count, and piece number r of a length
takes the r-th place that the plan has for that length.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.llm.bpe import VocabularyFile, encode_run, worker_cache
from tessera.llm.columns import RunFn, free_name, struct_of
from tessera.llm.pretokens import IdCache
from tessera.session import cut_lineage

CAPACITY = 2048
END_ID = 0
#: Rounds of the multiplicative weights, configurations taken from one round
#: (so the plan has a bounded number of rows), how far below the best they may
#: be, and how fast weights fall.
ROUNDS, PER_ROUND, SLACK, FALL = 40, 256, 0.03, 1.0
#: The program is over lengths of at least this share of a sequence.
SMALL = 1 / 16
#: Times that the program is solved, the later ones for what rounding leaves,
#: and the share of the tokens that best fit may place in the end.
SOLVES, REST = 4, 0.02

#: A configuration and how many sequences follow it.
Plan = list[tuple[tuple[int, ...], int]]


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids: whole sequences,
    after a first piece of the rest."""
    if n <= capacity:
        return [n]
    rest = n % capacity
    return [rest] * (rest > 0) + [capacity] * (n // capacity)


def _knapsack(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value for every capacity, and the length taken last (-1: none,
    look at one less)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fits[c]:
            got = best[c - lengths[:fits[c]]] + value[:fits[c]]
            k = int(got.argmax())
            if got[k] > best[c]:
                best[c], last[c] = got[k], k
    return best, last


def _configuration(last: np.ndarray, lengths: np.ndarray, first: int, capacity: int) -> tuple[int, ...]:
    """The best configuration that holds the length numbered ``first``."""
    took, c = [first], capacity - int(lengths[first])
    while c > 0:
        k = int(last[c])
        if k < 0:
            c -= 1
            continue
        took.append(k)
        c -= int(lengths[k])
    return tuple(sorted(took))


def solve_fractional(lengths: np.ndarray, demand: np.ndarray, capacity: int,
                     rounds: int = ROUNDS) -> tuple[dict[tuple[int, ...], float], np.ndarray, float]:
    """Configurations (of indices into ``lengths``, ascending) and how often
    each is used, how often they cover each demand, and a lower bound of the
    program (of any round's prices: their worth of all pieces, divided by that of
    the best configuration)."""
    covered = np.zeros(lengths.size)
    use: dict[tuple[int, ...], float] = {}
    bound = 0.0
    for _ in range(rounds):
        weight = lengths * np.exp(-FALL * (covered - covered.min()))
        best, last = _knapsack(lengths, weight, capacity)
        bound = max(bound, float((demand * weight).sum() / best[capacity]))
        reach = weight + best[capacity - lengths]  # of the best configuration with this length
        near = np.flatnonzero(reach >= (1 - SLACK) * reach.max())
        near = near[np.argsort(covered[near], kind="stable")][:PER_ROUND]
        load = np.zeros(lengths.size)
        fresh = {}
        for k in near.tolist():
            config = _configuration(last, lengths, k, capacity)
            if config not in fresh:
                kinds, times = np.unique(config, return_counts=True)
                step = float((demand[kinds] / times).min())
                fresh[config] = (kinds, times, step)
                load[kinds] += times * step / demand[kinds]
        for config, (kinds, times, step) in fresh.items():
            step /= max(1.0, load[kinds].max())  # a round covers no length more than once
            use[config] = use.get(config, 0.0) + step
            covered[kinds] += times * step / demand[kinds]
    return use, covered, bound


def best_fit(left: dict[int, int], capacity: int, plan: Plan = ()) -> Plan:
    """Best-fit decreasing over lengths with counts, into the room that
    ``plan`` leaves and new sequences: sequences with the same room are a group,
    and pieces of a length are put into a whole group at once."""
    full: Plan = []
    rooms: list[int] = []  # rooms that some sequences have, ascending
    groups: dict[int, Plan] = {}

    def put(room: int, config: tuple[int, ...], n: int) -> None:
        if n and not room:
            full.append((config, n))
        elif n:
            if room not in groups:
                bisect.insort(rooms, room)
                groups[room] = []
            groups[room].append((config, n))

    for config, n in plan:
        put(capacity - sum(config), config, n)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                put(capacity - each * length, (length,) * each, n // each)
                put(capacity - n % each * length, (length,) * (n % each), int(n % each > 0))
                break
            room = rooms[at]
            config, m = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[at]
            each = min(room // length, max(1, n // m))
            took = min(m, n // each)
            put(room, config, m - took)
            put(room - each * length, config + (length,) * each, took)
            n -= took * each
    return full + [x for room in rooms for x in groups[room]]


def sequences(plan: Plan) -> int:
    return sum(n for _, n in plan)


def _by_program(left: dict[int, int], capacity: int) -> Plan:
    """The program's packing."""
    tokens = sum(n * c for n, c in left.items())
    left, plan = dict(left), []
    for _ in range(SOLVES):
        large = sorted(n for n in left if n >= capacity * SMALL)
        if not large:
            break
        lengths = np.array(large, np.int64)
        rest = np.array([left[n] for n in large], np.int64)
        use, covered, _ = solve_fractional(lengths, rest.astype(np.float64), capacity)
        before = int(rest.sum())
        fill = {c: int(lengths[list(c)].sum()) for c in use}
        part: dict[tuple[int, ...], float] = {}
        # the fullest first; each as often as what it covers most is covered once
        for config in sorted(use, key=lambda c: (-fill[c], -c[-1], c)):
            kinds, times = np.unique(config, return_counts=True)
            often = use[config] / covered[kinds].max()
            n = min(int(often), int((rest[kinds] // times).min()))
            part[config] = often - n
            if n:
                rest[kinds] -= n * times
                plan.append((tuple(lengths[list(config)].tolist()), n))
        # single sequences by largest remainder: with few pieces all uses are fractions
        for config in sorted(part, key=lambda c: (-part[c], -c[-1], c)):
            kinds, times = np.unique(config, return_counts=True)
            if part[config] >= 0.5 and (rest[kinds] >= times).all():
                rest[kinds] -= times
                plan.append((tuple(lengths[list(config)].tolist()), 1))
        left = {n: c for n, c in left.items() if n < large[0]} | {n: c for n, c in zip(large, rest.tolist()) if c}
        if rest.sum() > 0.95 * before or (rest * lengths).sum() < REST * tokens:
            break
    return best_fit(left, capacity, plan)


def plan_packing(histogram: dict[int, int], capacity: int) -> Plan:
    """Sequences that hold all pieces: configurations (tuples of lengths) and
    how often each is used.

    The program is solved and rounded for every histogram.  A best-fit packing is
    its starting solution, which stands only where the rounded one needs more
    sequences."""
    left = {n: c for n, c in histogram.items() if n > 0 and c > 0}
    plan: Plan = [((capacity,), left.pop(capacity))] if capacity in left else []
    start = best_fit(left, capacity)
    found = _by_program(left, capacity)
    return plan + (found if sequences(found) <= sequences(start) else start)


class Places:
    """The places of a plan, by length: ``at(length, r)`` is the sequence and
    offset of the r-th place for that length."""

    def __init__(self, plan: Plan):
        rows, first = [], 0
        for config, n in plan:
            offset = 0
            kinds, times = np.unique(np.array(config, np.int64), return_counts=True)
            for length, each in zip(kinds.tolist(), times.tolist()):
                rows.append((length, n * each, first, each, offset))
                offset += length * each
            first += n
        rows.sort(key=lambda r: (r[0], r[2]))
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.length, slots, self.first, self.each, self.offset = table.T
        total = np.cumsum(slots)
        begins = np.concatenate([[True], self.length[1:] != self.length[:-1]]) if len(rows) else np.zeros(0, bool)
        base = np.maximum.accumulate(np.where(begins, total - slots, 0)) if len(rows) else total
        self.before = total - slots - base  # places of the length in earlier rows
        self.key = (self.length << 48) | self.before

    def at(self, length: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.key, (length << 48) | r, side="right") - 1
        within = r - self.before[k]
        return self.first[k] + within // self.each[k], self.offset[k] + within % self.each[k] * length


PIECES = T.StructType([
    T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("crcs", T.ArrayType(T.LongType()))])


def _pieces(vocabulary: VocabularyFile, capacity: int, end_id: int) -> RunFn:
    vocab, special = vocabulary.load()
    cache = worker_cache(("pack", vocabulary.digest), lambda: IdCache(vocab.encode))
    pattern = re.compile(b"|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
    end = np.array([end_id], "<u4")

    def ids_of(texts: list[bytes]) -> list[np.ndarray]:
        parts: list[bytes] = []
        owner: list[list] = []
        for text in texts:
            plan: list = []
            at = 0
            if pattern and any(s in text for s in special):
                for m in pattern.finditer(text):
                    plan += [len(parts), np.array([special[m.group()]], "<u4")]
                    parts.append(text[at:m.start()])
                    at = m.end()
            plan.append(len(parts))
            parts.append(text[at:] if at else text)
            owner.append(plan)
        flat, counts = encode_run(cache, parts)
        flat = flat.astype("<u4")
        bound = np.concatenate([[0], np.cumsum(counts)]).tolist()
        take = lambda x: flat[bound[x]:bound[x + 1]] if isinstance(x, int) else x
        return [np.concatenate([*map(take, plan), end]) for plan in owner]

    def work(run: list[bytes | None]) -> dict:
        lengths, crcs = [], []
        for ids in ids_of([t or b"" for t in run]):
            sizes = cut(ids.size, capacity)
            raw, at, sums = memoryview(ids.tobytes()), 0, []
            for n in sizes:
                sums.append(zlib.crc32(raw[4 * at:4 * (at + n)]))
                at += n
            lengths.append(sizes)
            crcs.append(sums)
        return {"lengths": lengths, "crcs": crcs}

    return work


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece (from 0), start, length, ids_crc32.

    A document is the token ids of its text (null: none), as the tokenizer
    file's library gives them, then ``end_id``."""
    vocabulary = VocabularyFile(docs.sparkSession, path)
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    name = free_name(kept, "pieces")
    got: Column = struct_of(F.col("text"), PIECES, lambda: _pieces(vocabulary, capacity, end_id))
    zipped = F.arrays_zip(F.col(f"{name}.lengths").alias("lengths"), F.col(f"{name}.crcs").alias("crcs"))
    rows = kept.select("doc_id", got.alias(name)).select(
        "doc_id", F.col(f"{name}.lengths")[0].alias("first"), F.posexplode(zipped).alias("piece", "x"))
    return rows.select(
        "doc_id", "piece",
        F.when(F.col("piece") == 0, F.lit(0)).otherwise(F.col("first") + (F.col("piece") - 1) * capacity)
        .cast("bigint").alias("start"),
        F.col("x.lengths").alias("length"), F.col("x.crcs").alias("ids_crc32"))


def numbered(pieces: DataFrame, total: int) -> DataFrame:
    """``pieces`` with ``rank``, a number from 0 without gaps within a length.

    Pieces of a length are dealt into buckets by a hash, numbered there and
    shifted by the sizes of earlier buckets, so no length (a third of all
    pieces may be full) has to pass one task."""
    buckets = max(1, int(total ** 0.5 / 2))
    dealt = pieces.withColumn("bucket", F.pmod(
        F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (dealt.withColumn("row", F.row_number().over(within)).join(shift, ["length", "bucket"])
            .withColumn("rank", F.col("shift") + F.col("row") - 1).drop("bucket", "row", "shift"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32; length at least 1)
    with sequence_id and offset: sequences have no gaps and at most
    ``capacity`` tokens."""
    pieces = cut_lineage(pieces)
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = pieces.sparkSession.sparkContext.broadcast(Places(plan_packing(histogram, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            sequence, offset = places.value.at(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return numbered(pieces, sum(histogram.values())).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
               f"sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of ``docs``: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    Only documents of more than ``capacity`` ids are cut; their first piece may
    be shorter.  Null and empty texts are documents of the end id alone.
    Repeated rows are packed each; null ids and further columns are allowed; an
    empty table gives no rows."""
    return pack(token_pieces(docs, path, capacity, end_id, doc_id, text), capacity)
