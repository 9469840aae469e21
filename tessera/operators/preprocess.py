"""Fit / transform preprocessing stages usable in a ``pyspark.ml.Pipeline``:
exact-median and mode imputers and a population-std scaler, plus the
numeric + categorical feature pipeline assembled into one vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregate import mode_table
from tessera.operators.encode import CategoricalEncoder
from tessera.operators.ordering import exact_percentiles


class _ConstantFill(Model):
    def __init__(self, values: dict):
        super().__init__()
        self.values_ = values

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.fillna({c: v for c, v in self.values_.items() if v is not None})


class MedianImputer(Estimator):
    """Fill nulls with the exact (interpolated) median of the fit rows."""

    def __init__(self, cols: Sequence[str]):
        super().__init__()
        self.cols = list(cols)

    def _fit(self, df: DataFrame) -> _ConstantFill:
        long = df.select(*self.cols).unpivot([], self.cols, "__c", "__v")
        med = exact_percentiles(long, "__v", [0.5], ["__c"], ["__m"]).collect()  # one row per column
        return _ConstantFill({r["__c"]: r["__m"] for r in med})


class ModeImputer(Estimator):
    """Fill nulls with the most frequent value of the fit rows (ties:
    smallest value)."""

    def __init__(self, cols: Sequence[str]):
        super().__init__()
        self.cols = list(cols)

    def _fit(self, df: DataFrame) -> _ConstantFill:
        long = df.select(*[F.col(c).cast("string") for c in self.cols]).unpivot([], self.cols, "__c", "__v")
        modes = mode_table(long, ["__c"], "__v").collect()  # one row per column
        return _ConstantFill({r["__c"]: r["mode"] for r in modes})


class PopStandardScalerModel(Model):
    def __init__(self, stats: dict, suffix: str):
        super().__init__()
        self.stats_ = stats
        self.suffix = suffix

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            f"{c}{self.suffix}": F.try_divide(F.col(c) - F.lit(mu), F.lit(sd))
            for c, (mu, sd) in self.stats_.items()})


class PopStandardScaler(Estimator):
    """(x - mean) / population std per column (Spark's StandardScaler uses
    the sample std)."""

    def __init__(self, cols: Sequence[str], suffix: str = "_scaled"):
        super().__init__()
        self.cols = list(cols)
        self.suffix = suffix

    def _fit(self, df: DataFrame) -> PopStandardScalerModel:
        aggs = []
        for c in self.cols:
            aggs += [F.avg(c).alias(f"{c}__mu"), F.stddev_pop(c).alias(f"{c}__sd")]
        row = df.agg(*aggs).first()
        return PopStandardScalerModel({c: (row[f"{c}__mu"], row[f"{c}__sd"]) for c in self.cols}, self.suffix)


def num_cat_pipeline(numeric: Sequence[str], categorical: Sequence[str],
                     output_col: str = "features") -> Pipeline:
    """Numeric branch (median fill, population-std scale) and categorical
    branch (mode fill, one-hot of sorted categories, unknown -> zeros), glued
    into one vector; other columns are left untouched."""
    numeric, categorical = list(numeric), list(categorical)
    return Pipeline(stages=[
        MedianImputer(numeric),
        PopStandardScaler(numeric),
        ModeImputer(categorical),
        CategoricalEncoder(categorical, "onehot", "ignore", output_col="__cat_vec"),
        VectorAssembler(inputCols=[f"{c}_scaled" for c in numeric] + ["__cat_vec"], outputCol=output_col),
    ])
