"""Registered queries: one per operator of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the given tables (or the ``manifest``
view Spark derives from them), each with its independent SQL oracle in
``tessera.plans.oracle``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.session import release

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    """Register ``fn`` under ``name``.  The registered callable first releases
    the intermediates kept by earlier queries (their results have been
    consumed; anything still referenced recomputes from lineage), so a long
    session does not accumulate caches.  Direct calls of ``fn`` do not."""
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            release()
            return fn(spark, sf_dir)
        QUERIES[name] = run
        return fn
    return register


def load_all() -> dict[str, QueryFn]:
    # importing the modules registers their queries
    from tessera.plans import (q_core, q_groups, q_features, q_ml)  # noqa: F401
    return dict(QUERIES)
