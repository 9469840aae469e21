"""Conditional and lookup projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def value_map(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup (a literal map, evaluated in codegen); unmapped ->
    null, then ``default`` when given."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    looked = F.try_element_at(F.create_map(*pairs), _c(c))
    return looked if default is None else F.coalesce(looked, F.lit(default))


def collapse(c: Column | str, groups: Mapping[str, Sequence]) -> Column:
    """Many values -> one: ``{'ABC': ['A', 'B', 'C'], ...}``; others kept."""
    c = _c(c)
    expr = None
    for target, members in groups.items():
        cond = c.isin(list(members))
        expr = F.when(cond, F.lit(target)) if expr is None else expr.when(cond, F.lit(target))
    return c if expr is None else expr.otherwise(c)


def select_first(conditions: Sequence[tuple[Column, object]], default=None) -> Column:
    """``np.select``: value of the first true condition, else ``default``."""
    expr = None
    for cond, value in conditions:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr if default is None else expr.otherwise(F.lit(default))


def keep_where(c: Column | str, cond: Column) -> Column:
    """``Series.where(cond)``: value where cond holds, else null."""
    return F.when(cond, _c(c))
