import os
import tempfile

from pyspark.sql import functions as F

from tessera.models.classifiers import make
from tessera.models.features import FeatureModel
from tessera.sources.manifest import manifest
from tessera.streaming.scoring import export_stream_predictions

from conftest import SMALL


def test_a_stream_of_unlabelled_rows_alone_is_scored_as_the_batch(spark):
    m = manifest(spark, SMALL)
    train, test = m.filter(F.col("split") == "train"), m.filter(F.col("split") == "test")
    features = FeatureModel.fit(train)
    model = make("tree").fit(features.transform(train))
    src = tempfile.mkdtemp(prefix="tessera-stream-src-")
    test.repartition(3).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(test.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = tempfile.mkdtemp(prefix="tessera-stream-out-")
    q = export_stream_predictions(stream, features.transform, model, "row_id", out, name=f"t{os.getpid()}")
    q.awaitTermination(300)
    got = spark.read.option("header", True).csv(f"{out}/batch=*")
    batch = model.transform(features.transform(test)).select("row_id", F.col("prediction").cast("int"))
    assert sorted((int(r.row_id), int(r.prediction)) for r in got.collect()) == sorted(map(tuple, batch.collect()))
