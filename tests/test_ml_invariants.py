"""Invariants of the model-evaluation operators on the smallest fixture."""

import numpy as np
from pyspark.sql import functions as F

from tessera.models import classifiers
from tessera.models import evaluate as EV
from tessera.models import stacking as ST
from tessera.models.discriminant import DiscriminantAnalysis
from tessera.models.features import ml_frame
from tessera.sources.manifest import manifest

from conftest import SMALL


def test_folds_cover_each_row_once(spark):
    m = manifest(spark, SMALL).filter(F.col("split") == "train").select("row_id", "label")
    f = EV.stratified_folds(m, 5, "row_id", "label").toPandas()
    assert f.row_id.is_unique and set(f.fold) == set(range(5))
    shares = f.groupby("fold").label.mean()
    assert shares.max() - shares.min() < 0.05


def test_stack_oof_predicts_each_key_once_per_model(spark):
    data = ml_frame(manifest(spark, SMALL)).withColumn("fold", EV.shuffled_folds("row_id", 3, 0))
    oof, imps = ST.stack_oof(spark, data, ["tree", "logistic"], k=3, parallelism=2)
    pdf = oof.toPandas()
    assert not pdf.duplicated(["row_id", "model"]).any()
    assert len(pdf) == 2 * data.count()
    assert set(imps.toPandas().model) == {"tree"}


def test_heldout_rows_are_never_in_their_own_fit(spark):
    """The label is a coin flip by row and the model a memory of rows: had a fit
    seen the held-out rows, it would know their labels."""
    rng = np.random.default_rng(2)
    rows = [(i, float(rng.integers(0, 2)), i % 4) for i in range(64)]
    data = spark.createDataFrame(rows, "row_id bigint, label double, fold int")

    class Memory:
        def __init__(self):
            self.seen = None

        def fit(self, df):
            seen = {r.row_id: r.label for r in df.collect()}
            model = Memory()
            model.seen = seen
            return model

        def transform(self, df):
            known = F.create_map(*[x for k, v in self.seen.items() for x in (F.lit(k), F.lit(v))])
            return df.withColumn("prediction", F.coalesce(F.try_element_at(known, F.col("row_id").cast("int")), F.lit(-1.0)))

    classifiers.FACTORIES["memory"] = Memory
    try:
        scores = EV.cross_validate(spark, data, ["memory"], k=4, parallelism=1).toPandas()
    finally:
        del classifiers.FACTORIES["memory"]
    assert (scores.train_accuracy == 1).all() and (scores.test_accuracy == 0).all()


def test_discriminants_with_large_means(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(1e7, 1, (200, 2)), rng.normal(1e7 + 6, 1, (200, 2))])
    df = spark.createDataFrame([(float(a), float(b), float(i >= 200)) for i, (a, b) in enumerate(x)], "a double, b double, label double")
    for kind in ("linear", "quadratic"):
        got = DiscriminantAnalysis(["a", "b"], kind=kind).fit(df).transform(df)
        assert got.where("prediction = label").count() >= 396
