"""Reshaping: complete grids, stacked totals and parameter sweeps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.nulls import rate
from tessera.operators.ordering import row_number
from tessera.session import cut_lineage


def complete_grid(values: DataFrame, domains: Mapping[str, DataFrame | Sequence],
                  fill: Mapping[str, object]) -> DataFrame:
    """Every combination of the key domains, with ``values`` where present and
    ``fill`` elsewhere (pandas' categorical group-by with empty bins).

    The grid is the product of the distinct key values, never of data rows; its
    size is that of the result that is asked for."""
    spark = values.sparkSession
    grid = None
    for name, dom in domains.items():
        if not isinstance(dom, DataFrame):
            dtype = values.schema[name].dataType
            dom = spark.createDataFrame([(v,) for v in dom], f"{name} {dtype.simpleString()}")
        dom = dom.select(name).distinct()
        grid = dom if grid is None else grid.crossJoin(dom)
    keys = list(domains)
    return grid.join(values, keys, "left").fillna(dict(fill))


def stacked_total(df: DataFrame, keys: Sequence[str], series: str, value: str,
                  order: Sequence[str]) -> DataFrame:
    """Stacked-chart data: each series value becomes the running total of
    itself and the series after it in ``order`` (bottom series unchanged)."""
    wide = df.groupBy(*keys).pivot(series, list(order)).agg(F.first(value))
    for i, s in enumerate(order[:-1]):
        wide = wide.withColumn(s, sum((F.coalesce(F.col(t), F.lit(0)) for t in order[i:]), F.lit(0)))
    return wide.unpivot(list(keys), list(order), series, value)


def cutoff_sweep(df: DataFrame, cutoffs: Iterable[int], age: str = "age", sex: str = "sex",
                 label: str = "label") -> DataFrame:
    """For each age cutoff: role (Child if age <= cutoff, else Woman/Man by
    sex) and the labelled rate per role -> (cutoff, role, rate).

    A difference array: each row falls to the smallest cutoff that covers its age
    (none: after the last), so rows fold to (cutoff, sex) whatever the number of
    distinct ages; running sums over the cutoffs give the children of each, and
    what lies beyond it the women and men.  A role that has no row at a cutoff is
    left out there, as a group without rows is."""
    spark = df.sparkSession
    cuts = sorted({int(c) for c in cutoffs})
    first = F.lit(len(cuts))
    for i in range(len(cuts) - 1, -1, -1):
        first = F.when(F.col(age) <= cuts[i], F.lit(i)).otherwise(first)
    female = F.coalesce(F.col(sex) == "female", F.lit(False))
    folded = df.groupBy(first.alias("i"), female.alias("f")).agg(
        F.sum(label).alias("s"), F.count(label).alias("c"), F.count(F.lit(1)).alias("n"))
    # at most twice as many rows as cutoffs from here on
    slots = spark.createDataFrame([(i, f, c) for i, c in enumerate([*cuts, None]) for f in (False, True)],
                                  "i int, f boolean, cutoff int")
    full = slots.join(folded, ["i", "f"], "left").fillna(0, ["s", "c", "n"])
    upto = Window.partitionBy("f").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    beyond = Window.partitionBy("f").orderBy("i").rowsBetween(1, Window.unboundedFollowing)
    runs = full.select("cutoff", "f", *[F.sum(x).over(w).alias(f"{x}_{side}") for x in ("s", "c", "n")
                                        for side, w in (("upto", upto), ("beyond", beyond))]).filter(F.col("cutoff").isNotNull())
    parts = runs.select("cutoff", F.explode(F.array(
        F.struct(F.lit("Child").alias("role"), *[F.col(f"{x}_upto").alias(x) for x in "scn"]),
        F.struct(F.when(F.col("f"), "Woman").otherwise("Man").alias("role"), *[F.col(f"{x}_beyond").alias(x) for x in "scn"]),
    )).alias("p")).select("cutoff", "p.*")
    return (parts.groupBy("cutoff", "role").agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.sum("n").alias("n"))
            .filter(F.col("n") > 0).select("cutoff", "role", F.round(rate(F.col("s"), F.col("c")), 6).alias("rate")))


def _placed(df: DataFrame, order: Sequence[str] | None, name: str) -> DataFrame:
    """``df`` with its rows' positions from 0 as ``name``."""
    if order:
        return row_number(df, order, name=name).withColumn(name, F.col(name) - 1)
    # the frame's own order: by task, then within the task, written down so that it stays
    fixed = cut_lineage(df.withColumn(name, F.monotonically_increasing_id()))
    task = F.shiftright(F.col(name), 33)
    sizes = fixed.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    starts = sizes.select("__task", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return (fixed.join(F.broadcast(starts), task == F.col("__task"))
            .withColumn(name, F.col("__start") + F.col(name).bitwiseAND(F.lit((1 << 33) - 1))).drop("__task", "__start"))


def glue_columns(left: DataFrame, right: DataFrame, left_order: Sequence[str] | None = None,
                 right_order: Sequence[str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """The columns of two frames side by side: the rows at the same position become
    one row.

    A frame's positions are those in the order of its ``*_order`` columns, which should
    be total; without them, the order in which the frame's tasks give its rows.  The
    frames need no common key.  Frames of unequal lengths raise an error, as do
    columns of the same name (``drop``: columns that only gave an order).  Positions
    are unique, so the join has no hot key."""
    kept = [c for c in right.columns if c not in drop]
    clash = {c.lower() for c in left.columns if c not in drop} & {c.lower() for c in kept}
    if clash:
        raise ValueError(f"both frames have the columns {sorted(clash)}")
    a, b = _placed(left, left_order, "__place_a"), _placed(right, right_order, "__place_b")
    sizes = left.count(), right.count()
    if sizes[0] != sizes[1]:
        raise ValueError(f"the frames have {sizes[0]} and {sizes[1]} rows")
    return (a.join(b.select(*kept, "__place_b"), F.col("__place_a") == F.col("__place_b"))
            .select(*[c for c in left.columns if c not in drop], *kept))
