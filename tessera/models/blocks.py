"""Rows of a fit as numpy blocks that stay in the executors.

Iterative fits (Newton steps, tree levels) read the same rows many times and need
one small sum per reading.  ``blocks`` turns a DataFrame into cached blocks of
arrays, once; ``total`` adds up what a function gives for each block, in a tree of
tasks when there are many.  A lost block is computed again from the frame, which
callers write down first.  This is the one place where RDDs are used: the plan of
an aggregate over the frame would be analysed and compiled anew for each of
hundreds of steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block, which bound what a worker holds whatever the partitions; from
#: MANY partitions on, or LARGE numbers from all of them, sums are added up in two steps.
BLOCK_ROWS, MANY, LARGE = 1 << 13, 64, 1 << 20


class Block:
    """Features (rows x features), label, fold (-1: none) and a hash of each row."""

    def __init__(self, x: np.ndarray, y: np.ndarray, fold: np.ndarray, key: np.ndarray):
        self.x, self.y, self.fold, self.key = x, y, fold, key


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to blocks."""
    waiting: list[pa.RecordBatch] = []
    schema = pa.schema([("x", pa.binary()), ("y", pa.binary()), ("fold", pa.binary()), ("key", pa.binary())])

    def packed():
        t = pa.Table.from_batches(waiting).combine_chunks()
        x = t["x"].chunk(0).flatten().to_numpy(zero_copy_only=False)
        arrays = [x, *(t[c].to_numpy() for c in ("y", "fold", "key"))]
        return pa.RecordBatch.from_arrays([pa.array([a.tobytes()]) for a in arrays], schema=schema)

    rows = 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield packed()
            waiting, rows = [], 0
    if waiting:
        yield packed()


def blocks(df: DataFrame, features: Sequence[str | Column], label: str, fold: str | Column | None = None,
           key: str | None = None, kept: bool = True) -> RDD:
    """Blocks of the rows of ``df`` with a label, cached if ``kept``.  ``key`` tells
    rows apart for repeatable draws (else a hash of the features does)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in features]
    spread = F.xxhash64(key) if key else F.xxhash64(*cols)
    chosen = df.where(F.col(label).isNotNull()).select(
        F.array(*[c.cast("double") for c in cols]).alias("x"), F.col(label).cast("double").alias("y"),
        (F.lit(-1) if fold is None else F.col(fold) if isinstance(fold, str) else fold).cast("int").alias("fold"),
        spread.alias("key"))
    d = len(cols)

    def unpack(row) -> Block:
        y = np.frombuffer(row.y, np.float64)
        return Block(np.frombuffer(row.x, np.float64).reshape(y.size, d), y, np.frombuffer(row.fold, np.int32),
                     np.frombuffer(row.key, np.int64))

    packed = chosen.mapInArrow(_pack, "x binary, y binary, fold binary, key binary")
    rdd = packed.rdd.map(unpack)
    return rdd.persist(StorageLevel.MEMORY_AND_DISK) if kept else rdd


def total(rdd: RDD, of_block: Callable, combine: Callable = np.add, size: int = 0) -> list[np.ndarray] | None:
    """The sums (or what ``combine`` makes) of the arrays that ``of_block`` gives for
    each block; None if there is no block.  ``size``: how many numbers these are, if
    they are many."""
    def of_part(parts: Iterator) -> Iterator[list[np.ndarray]]:
        out = None
        for block in parts:
            got = of_block(block)
            out = got if out is None else [combine(a, b) for a, b in zip(out, got)]
        if out is not None:
            yield out

    def add(a, b):
        return [combine(x, y) for x, y in zip(a, b)]

    sums = rdd.mapPartitions(of_part)
    many = rdd.getNumPartitions()
    if many > MANY or many > 1 and many * size > LARGE:
        # the driver gets the sums of some tasks, not those of all
        few = min(16, many, max(1, LARGE // max(1, size)))
        sums = sums.mapPartitionsWithIndex(lambda i, it: ((i % few, v) for v in it)).reduceByKey(add, few).values()
    parts = sums.collect()
    if not parts:
        return None
    out = parts[0]
    for part in parts[1:]:
        out = add(out, part)
    return out


def draw(key: np.ndarray, *seed: int) -> np.ndarray:
    """Numbers in [0, 1) from the rows' hashes and a seed, the same on every run."""
    with np.errstate(over="ignore"):
        h = key.astype(np.uint64)
        for s in seed:
            h = (h ^ np.uint64(s & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
    return (h >> np.uint64(11)).astype(np.float64) / 2.0 ** 53
