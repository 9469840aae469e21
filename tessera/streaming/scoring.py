"""Prediction export on a stream: a fitted model (any ``pyspark.ml`` model
or pipeline) scores new unlabelled rows as they arrive.

Each micro-batch is written to its own ``batch=<id>`` folder with overwrite,
so a batch replayed after a failure replaces its earlier output instead of
duplicating it; progress lives in the checkpoint folder under the cluster's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.session import ensure_checkpoint_dir
from tessera.sources.files import write_csv


def export_stream_predictions(stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], model, key: str,
                              out_dir: str, name: str = "prediction_export",
                              available_now: bool = True) -> StreamingQuery:
    """``prepare`` turns a micro-batch of raw rows into the model's input
    frame (the same function used in batch)."""
    ckpt = f"{ensure_checkpoint_dir(stream.sparkSession).rstrip('/')}/streams/{name}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        scored = model.transform(prepare(batch))
        out = scored.select(key, scored["prediction"].cast("int").alias("prediction"))
        write_csv(out, f"{out_dir.rstrip('/')}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt).queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
