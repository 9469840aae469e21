"""Categorical encoders and scalers as fit / transform pairs.

Means and deviations are one row.  Categories are a dictionary table (value, code),
computed distributed and joined to the rows: broadcast while it is small, else by a
join in which frequent values are salted.  Nothing bounds their number, and no
statistic that grows with the data is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.groups import ROWS, group_stats, join_back
from tessera.operators.ordering import FEW, codes_of
from tessera.session import keep

UNKNOWN_ERROR = "error"
UNKNOWN_IGNORE = "ignore"


def label_encode(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """0..n-1 code of each value in sorted order (nulls stay null).  The code
    table is computed distributed and joined back, hot values salted."""
    return label_encode_many(df, [col], {col: name or f"{col}_code"})


def label_encode_many(df: DataFrame, cols: Sequence[str], names: Mapping[str, str] | None = None,
                      scaled: bool = False) -> DataFrame:
    """Label-encode several columns; all code tables are computed from the
    same (persisted) input, then joined.  ``scaled=True`` also min-max scales
    each code to [0, 1] (code / (n - 1), 0 when n = 1), as LabelEncoder
    followed by MinMaxScaler."""
    base = keep(df)
    out = base
    for c in cols:
        name = (names or {}).get(c, f"{c}_code")
        table, n = dictionary(base, c)
        if scaled:
            table = table.withColumn("code", F.coalesce(F.try_divide(F.col("code").cast("double"), F.lit(float(n - 1))), F.lit(0.0)))
        out = join_codes(out, table, n, c, name)
    return out


def minmax_scale(df: DataFrame, col: str, name: str, fit: DataFrame | None = None) -> DataFrame:
    st = (fit if fit is not None else df).agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    scaled = F.try_divide(F.col(col) - F.col("__lo"), F.col("__hi") - F.col("__lo"))
    return df.crossJoin(F.broadcast(st)).withColumn(name, scaled).drop("__lo", "__hi")  # one row


def standard_scale(df: DataFrame, col: str, name: str, fit: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std (scikit-learn StandardScaler)."""
    st = (fit if fit is not None else df).agg(F.avg(col).alias("__mu"), F.stddev_pop(col).alias("__sd"))
    scaled = F.try_divide(F.col(col) - F.col("__mu"), F.col("__sd"))
    return df.crossJoin(F.broadcast(st)).withColumn(name, scaled).drop("__mu", "__sd")  # one row


def dictionary(df: DataFrame, col: str) -> tuple[DataFrame, int]:
    """(value, code, row count) of each distinct non-null value of ``col``, codes in
    sorted order, and their number.  It is a table like any other: nothing bounds
    the number of values."""
    counted = keep(group_stats(df.filter(F.col(col).isNotNull()).select(F.col(col).alias("value")), "value"))
    n = counted.count()
    return keep(codes_of(counted, "value", "code", n)), n


def given_dictionary(df: DataFrame, col: str, values: Sequence) -> tuple[DataFrame, int]:
    """The same of listed values."""
    kind = df.schema[col].dataType
    rows = [(v, i, 1) for i, v in enumerate(sorted(values))]
    schema = T.StructType([T.StructField("value", kind), T.StructField("code", T.IntegerType()), T.StructField(ROWS, T.LongType())])
    return df.sparkSession.createDataFrame(rows, schema), len(rows)


def join_codes(df: DataFrame, table: DataFrame, n: int, col: str, name: str) -> DataFrame:
    """``df`` plus the code of ``col`` (null: no such value).  A small dictionary is
    broadcast; for a large one the rows of frequent values are salted."""
    t = table.select(F.col("value").alias(f"__dv_{name}"), F.col("code").alias(name), ROWS)
    if n <= FEW:
        return df.join(F.broadcast(t.drop(ROWS)), F.col(col) == F.col(f"__dv_{name}"), "left").drop(f"__dv_{name}")
    keyed = df.withColumn(f"__dv_{name}", F.col(col))
    return join_back(keyed, t, f"__dv_{name}").drop(f"__dv_{name}")


#: Unseen values that an error message spells out.
SHOWN = 1_000


class UnseenValues(ValueError):
    """Values outside the categories; ``listing`` has all of them (column, value),
    the message the first ``SHOWN``."""

    def __init__(self, listing: DataFrame, what: str):
        self.listing = listing
        rows = listing.orderBy("column", "value").limit(SHOWN + 1).collect()
        found: dict[str, list[str]] = {}
        for r in rows[:SHOWN]:
            found.setdefault(r["column"], []).append(r["value"])
        more = " and more" if len(rows) > SHOWN else ""
        super().__init__(f"values outside the {what} categories: "
                         + "; ".join(f"{c}: {', '.join(v)}" for c, v in found.items()) + more)


def unseen_values(df: DataFrame, tables: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """(column, value): all non-null values in ``df`` that the dictionaries lack,
    each once."""
    parts = []
    for c, (table, n) in tables.items():
        # distinct before the join: a frequent value is one row
        values = df.select(F.col(c).alias("value")).filter(F.col("value").isNotNull()).distinct()
        known = table.select("value")
        parts.append(values.join(F.broadcast(known) if n <= FEW else known, "value", "left_anti")
                     .select(F.lit(c).alias("column"), F.col("value").cast("string").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class CategoricalEncoder(Estimator):
    """Ordinal or one-hot encoding of several columns with sorted categories,
    however many there are.

    ``categories``: 'auto' (fit from data) or {column: [values]} (validated
    against the fit data).  ``handle_unknown``: 'error' raises ``UnseenValues``,
    which lists all of them, when rows are transformed (while they are read on a
    stream, naming the first); 'ignore' gives an all-zero block (one-hot)."""

    def __init__(self, input_cols: Sequence[str], encoding: str = "onehot",
                 handle_unknown: str = UNKNOWN_ERROR, categories="auto",
                 output_col: str = "features"):
        super().__init__()
        if encoding not in ("onehot", "onehot-dense", "ordinal"):
            raise ValueError(f"unknown encoding {encoding!r}")
        if handle_unknown not in (UNKNOWN_ERROR, UNKNOWN_IGNORE):
            raise ValueError("handle_unknown must be 'error' or 'ignore'")
        if encoding == "ordinal" and handle_unknown == UNKNOWN_IGNORE:
            raise ValueError("handle_unknown='ignore' is not allowed with ordinal encoding")
        self.input_cols = list(input_cols)
        self.encoding = encoding
        self.handle_unknown = handle_unknown
        self.categories = categories
        self.output_col = output_col

    def _fit(self, df: DataFrame) -> CategoricalEncoderModel:
        if self.categories == "auto":
            tables = {c: dictionary(df, c) for c in self.input_cols}
        else:
            tables = {c: given_dictionary(df, c, self.categories[c]) for c in self.input_cols}
            if self.handle_unknown == UNKNOWN_ERROR:
                listing = unseen_values(df, tables)
                if not listing.isEmpty():
                    raise UnseenValues(listing, "given")
        return CategoricalEncoderModel(tables, self.encoding, self.handle_unknown, self.output_col)


class CategoricalEncoderModel(Model):
    """``tables``: per column its dictionary and number of categories."""

    def __init__(self, tables: dict[str, tuple[DataFrame, int]], encoding: str, handle_unknown: str, output_col: str):
        super().__init__()
        self.tables = tables
        self.input_cols = list(tables)
        self.sizes = {c: n for c, (_, n) in tables.items()}
        self.encoding = encoding
        self.handle_unknown = handle_unknown
        self.output_col = output_col

    @property
    def n_features(self) -> int:
        return sum(self.sizes.values())

    def _coded(self, df: DataFrame) -> DataFrame:
        """``df`` with ``__code_<column>`` for each column."""
        if self.handle_unknown == UNKNOWN_ERROR and not df.isStreaming:
            listing = unseen_values(df, self.tables)
            if not listing.isEmpty():
                raise UnseenValues(listing, "fitted")
        out = df
        for c, (table, n) in self.tables.items():
            out = join_codes(out, table, n, c, f"__code_{c}")
            if self.handle_unknown == UNKNOWN_ERROR and df.isStreaming:
                out = out.withColumn(f"__code_{c}", F.when(F.col(c).isNotNull() & F.col(f"__code_{c}").isNull(), F.raise_error(F.concat(
                    F.lit(f"value of {c} outside the fitted categories: "), F.col(c).cast("string")))).otherwise(F.col(f"__code_{c}")).cast("int"))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        coded = self._coded(df)
        codes = {c: f"__code_{c}" for c in self.input_cols}
        if self.encoding == "ordinal":
            return coded.withColumns({f"{c}_code": F.col(k) for c, k in codes.items()}).drop(*codes.values())
        if self.encoding == "onehot-dense":
            return coded.withColumns({f"{c}_{i + 1}": F.coalesce((F.col(codes[c]) == i).cast("int"), F.lit(0))
                                      for c in self.input_cols for i in range(self.sizes[c])}).drop(*codes.values())
        # sparse one-hot: codes carry nominal metadata with one extra slot for
        # unknown values; dropLast removes that slot, so unknown -> all zeros
        tmp = {}
        for c in self.input_cols:
            n = self.sizes[c]
            code = F.coalesce(F.col(codes[c]), F.lit(n)).cast("double")
            meta = {"ml_attr": {"type": "nominal", "name": f"__oh_{c}", "num_vals": n + 1}}
            tmp[f"__oh_{c}"] = code.alias(f"__oh_{c}", metadata=meta)
        coded = coded.withColumns(tmp).drop(*codes.values())
        ohe = OneHotEncoder(inputCols=list(tmp), outputCols=[f"{k}_v" for k in tmp], dropLast=True,
                            handleInvalid="error")
        vec = ohe.fit(coded.limit(0)).transform(coded)
        asm = VectorAssembler(inputCols=[f"{k}_v" for k in tmp], outputCol=self.output_col)
        return asm.transform(vec).drop(*tmp, *[f"{k}_v" for k in tmp])
