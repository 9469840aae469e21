"""Order statistics that never put a whole table (or a whole group) in one task.

``cumulative_rank`` is the primitive: a running (weighted) count in a total
order, optionally restarted per partition key.  Rows are range-partitioned on
(partition key, order key) - so even a single hot key is spread over many
tasks by its order values - summed up within each range by a window, and
shifted by the totals of the key's earlier ranges.  Null keys are a key like
any other.  There is one path, whatever the size, so results cannot depend on
it.

On top of it: row numbers and contiguous ``ntile`` folds.  Exact percentiles (linear
interpolation, as pandas / Spark ``percentile``), globally or per group, need no
order of the rows: they are selected between brackets (``exact_percentiles``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.groups import ROWS, join_back
from tessera.session import cut_lineage

_PID = "__rk_pid"
_W = "__rk_w"
_OFF = "__rk_off"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal keys, null being equal to null; the right side's keys are
    dropped."""
    renamed = right.withColumnsRenamed({k: f"__ns_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"__ns_{k}"])
    return left.join(renamed, on, how).drop(*[f"__ns_{k}" for k in keys])


def cumulative_rank(df: DataFrame, order_cols: Sequence[str], part_cols: Sequence[str] = (),
                    weight: str | None = None, name: str = "cum",
                    partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name`` = running sum of ``weight`` (1 per row when None)
    within ``part_cols``, in ``order_cols`` order (inclusive of the row).
    ``order_cols`` should make the order total, or ties get an arbitrary but
    fixed order."""
    part_cols, order_cols = list(part_cols), list(order_cols)
    n = partitions or _partitions(df)
    wcol = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    # the ranges are sampled: written down, because totals and rows must agree
    # on them also when a lost executor's part is computed again
    keyed = cut_lineage(df.withColumn(_W, wcol)
                        .repartitionByRange(n, *part_cols, *order_cols)
                        .withColumn(_PID, F.spark_partition_id()))
    within = (Window.partitionBy(_PID, *part_cols).orderBy(*order_cols)
              .rowsBetween(Window.unboundedPreceding, 0))
    local = keyed.withColumn(name, F.sum(_W).over(within))
    totals = keyed.groupBy(_PID, *part_cols).agg(F.sum(_W).alias("__rk_tot"))
    earlier = Window.partitionBy(*part_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # a row per range and key that occurs there; only keys that span ranges shift
    offsets = (totals.withColumn(_OFF, F.sum("__rk_tot").over(earlier)).where(F.col(_OFF).isNotNull())
               .drop("__rk_tot"))
    return (join_null_safe(local, offsets, [_PID, *part_cols])
            .withColumn(name, F.col(name) + F.coalesce(F.col(_OFF), F.lit(0)))
            .drop(_PID, _W, _OFF))


def row_number(df: DataFrame, order_cols: Sequence[str], part_cols: Sequence[str] = (),
               name: str = "row_no") -> DataFrame:
    """1-based row number in a total order, optionally per partition key."""
    return cumulative_rank(df, order_cols, part_cols, None, name)


def ntile(df: DataFrame, k: int, order_cols: Sequence[str], part_cols: Sequence[str] = (),
          name: str = "fold") -> DataFrame:
    """0-based SQL ``ntile(k) - 1`` over (part) order: the first n % k tiles
    hold one row more."""
    numbered = row_number(df, order_cols, part_cols, "__nt_rn")
    if part_cols:
        # rows of one class may be most of all: its size reaches them by a salted join
        key = F.struct(*[F.col(c) for c in part_cols])
        sizes = df.groupBy(key.alias(_KEY)).agg(F.count(F.lit(1)).alias("__nt_n")).withColumn(ROWS, F.col("__nt_n"))
        numbered = join_back(numbered.withColumn(_KEY, key), sizes, _KEY, salt_by=order_cols).drop(_KEY)
    else:
        numbered = numbered.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("__nt_n"))))  # one row
    r = F.col("__nt_rn") - 1
    q = F.floor(F.col("__nt_n") / k)
    rem = F.col("__nt_n") - q * k
    big = rem * (q + 1)
    tile = F.when(r < big, F.floor(r / (q + 1))).otherwise(rem + F.floor((r - big) / q))
    return numbered.withColumn(name, tile.cast("int")).drop("__nt_rn", "__nt_n")


#: Rank error of the sketch is n / ACCURACY; groups of at most SMALL rows are folded
#: whole, and at most FEW sorted values or groups are handled as small tables.
ACCURACY, SMALL, FEW = 10_000, 10_000, 100_000
_KEY, _V, _C = "__ep_k", "__ep_v", "__ep_c"


def _bracket_columns(probs: Sequence[float]) -> list:
    """Aggregates that give for each probability two values between which its order
    statistics lie: quantiles of a mergeable sketch, wider by three times its rank
    error; the least and largest value for a small group."""
    margin = 3.0 / ACCURACY
    asked = [min(max(p + side * margin, 0.0), 1.0) for p in probs for side in (-1, 1)]
    return [F.min(_V).alias("__ep_min"), F.max(_V).alias("__ep_max"), F.count(F.lit(1)).alias(ROWS),
            F.percentile_approx(_V, asked, ACCURACY).alias("__ep_q")]


def _bracket(i: int, p: float):
    """The two values of the i-th probability as columns."""
    small = F.col(ROWS) <= SMALL
    margin = 3.0 / ACCURACY
    low = F.col("__ep_min") if p <= margin else F.when(small, F.col("__ep_min")).otherwise(F.col("__ep_q")[2 * i])
    high = F.col("__ep_max") if p >= 1 - margin else F.when(small, F.col("__ep_max")).otherwise(F.col("__ep_q")[2 * i + 1])
    return low.alias(f"__ep_lo{i}"), high.alias(f"__ep_hi{i}")


def exact_percentiles(df: DataFrame, value: str, probs: Sequence[float],
                      by: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolation percentiles of ``value`` (nulls ignored),
    one row per ``by`` key (one row in total when ``by`` is empty; a null key is a
    key).

    A first pass brackets each order statistic with a mergeable sketch.  A second
    one counts: values inside a bracket keep their value, all others fall into the
    gap between two brackets, so map-side sums leave few rows, from which running
    counts pick the exact values.  Nothing is sorted but these.  Rows of a hot key
    are counted where they are; the brackets reach them by a salted join."""
    by = list(by)
    names = list(names) if names else [f"p{int(round(p * 100))}" for p in probs]
    v = F.col(value).cast("double").alias(_V)
    key = [F.struct(*[F.col(c) for c in by]).alias(_KEY)] if by else []
    vals = df.select(*key, v).filter(F.col(_V).isNotNull())
    ends = [c for i, p in enumerate(probs) for c in _bracket(i, p)]
    if by:
        stats = group_stats_of(vals, probs).select(_KEY, ROWS, *ends)
        rows = join_back(vals, stats, _KEY)
        low, high = ([F.col(f"__ep_{side}{i}") for i in range(len(probs))] for side in ("lo", "hi"))
    else:
        found = vals.agg(*_bracket_columns(probs)).select(ROWS, *ends).first()  # one row
        rows = vals.withColumn(_KEY, F.lit(0))
        low, high = ([F.lit(found[f"__ep_{side}{i}"]).cast("double") for i in range(len(probs))] for side in ("lo", "hi"))
    at, gap = _place(F.col(_V), low, high)
    picked = _picked(rows.select(_KEY, at.alias("__ep_at"), gap.alias("__ep_gap")), probs)
    outs = [(F.col(f"__lo{i}") + F.col(f"__fr{i}") * (F.col(f"__hi{i}") - F.col(f"__lo{i}"))).alias(nm)
            for i, nm in enumerate(names)]
    return picked.select(*[F.col(f"{_KEY}.{c}").alias(c) for c in by], *outs)


def group_stats_of(vals: DataFrame, probs: Sequence[float]) -> DataFrame:
    return vals.groupBy(_KEY).agg(*_bracket_columns(probs))


def wide_percentiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], names: Sequence[str],
                     *also) -> tuple[DataFrame, object]:
    """(column, percentiles...) of several columns, and the row of the aggregates
    ``also``, which are read together with the brackets."""
    x = {c: F.col(c).cast("double") for c in cols}
    margin = 3.0 / ACCURACY
    asked = [min(max(p + side * margin, 0.0), 1.0) for p in probs for side in (-1, 1)]
    found = df.agg(*also, *[e for i, c in enumerate(cols) for e in (
        F.min(x[c]).alias(f"__ep_min{i}"), F.max(x[c]).alias(f"__ep_max{i}"), F.count(x[c]).alias(f"__ep_n{i}"),
        F.percentile_approx(x[c], asked, ACCURACY).alias(f"__ep_q{i}"))]).first()
    parts = []
    for i, c in enumerate(cols):
        small = found[f"__ep_n{i}"] <= SMALL
        low = [found[f"__ep_min{i}"] if small or p <= margin else found[f"__ep_q{i}"][2 * j] for j, p in enumerate(probs)]
        high = [found[f"__ep_max{i}"] if small or p >= 1 - margin else found[f"__ep_q{i}"][2 * j + 1] for j, p in enumerate(probs)]
        at, gap = _place(x[c], [F.lit(v).cast("double") for v in low], [F.lit(v).cast("double") for v in high])
        parts.append(F.when(x[c].isNotNull(), F.struct(F.lit(c).alias(_KEY), at.alias("__ep_at"), gap.alias("__ep_gap"))))
    placed = df.select(F.explode(F.filter(F.array(*parts), lambda p: p.isNotNull())).alias("p")).select("p.*")
    picked = _picked(placed, probs)
    outs = [(F.col(f"__lo{i}") + F.col(f"__fr{i}") * (F.col(f"__hi{i}") - F.col(f"__lo{i}"))).alias(nm) for i, nm in enumerate(names)]
    return picked.select(F.col(_KEY).alias("column"), *outs), found


def _place(v, low: list, high: list) -> tuple:
    """Where a value counts: at itself inside a bracket, else after the last bracket
    below it (null: before all); and whether it is in such a gap."""
    inside = F.lit(False)
    for a, b in zip(low, high):
        inside = inside | ((v >= a) & (v <= b))
    below = [F.when(b < v, b) for b in high]
    return F.when(inside, v).otherwise(F.greatest(*below) if len(below) > 1 else below[0]), ~inside


def _picked(placed: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Per key the two order statistics around each probability and the share
    between them."""
    folded = placed.groupBy(_KEY, "__ep_at", "__ep_gap").agg(F.count(F.lit(1)).alias(_C))
    order = Window.partitionBy(_KEY).orderBy("__ep_at", "__ep_gap")
    run = folded.withColumn("__ep_cum", F.sum(_C).over(order.rowsBetween(Window.unboundedPreceding, 0))) \
                .withColumn("__ep_n", F.sum(_C).over(Window.partitionBy(_KEY)))
    prev, cum = F.col("__ep_cum") - F.col(_C), F.col("__ep_cum")
    missed = F.raise_error(F.lit("an order statistic lies outside its bracket")).cast("double")
    here = F.when(F.col("__ep_gap"), missed).otherwise(F.col("__ep_at"))
    aggs = []
    for i, p in enumerate(probs):
        h = (F.col("__ep_n") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        aggs += [F.max(F.when((prev <= lo) & (lo < cum), here)).alias(f"__lo{i}"),
                 F.max(F.when((prev <= hi) & (hi < cum), here)).alias(f"__hi{i}"),
                 F.max(h - lo).alias(f"__fr{i}")]
    return run.groupBy(_KEY).agg(*aggs)


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_percentiles(df, value, [0.5], by, [name])


def codes_of(distinct: DataFrame, col: str, name: str, n: int) -> DataFrame:
    """``distinct`` (``n`` rows, one per value) plus the 0-based position of each
    value in sorted order."""
    if n <= FEW:  # a small table: sorted in one task
        return distinct.withColumn(name, (F.row_number().over(Window.orderBy(col)) - 1).cast("int"))
    return row_number(distinct, [col], name="__dc_rn").withColumn(name, (F.col("__dc_rn") - 1).cast("int")).drop("__dc_rn")
