"""Null-aware arithmetic under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double; null when the denominator is 0 or
    null (ANSI ``/`` would raise on 0)."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))

