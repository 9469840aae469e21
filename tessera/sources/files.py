"""CSV reading and writing.

Reads always take an explicit schema (no ``inferSchema`` pass over the
data); an empty cell is null, as in pandas ``read_csv``.  A write produces a
directory of part files (one per task), never one file funnelled through a
single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv_typed(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    return (spark.read.schema(schema)
            .option("header", True)
            .option("nullValue", "")
            .option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line)
            .option("mode", "FAILFAST")
            .csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("nullValue", "").option("quote", '"').option("escape", '"').csv(path)


def export_predictions(predictions: DataFrame, key: str, prediction: str, path: str,
                       out_name: str = "prediction") -> DataFrame:
    """Two-column (key, prediction) export of scored rows."""
    out = predictions.select(key, predictions[prediction].cast("int").alias(out_name))
    write_csv(out, path)
    return out
