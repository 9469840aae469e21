"""The model-ready features of the manifest: imputed, encoded numeric columns
plus one assembled vector.  ``FeatureModel`` is fitted once, on labelled rows,
and transforms any rows after that, also unlabelled ones alone (a stream's
micro-batch, say)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import conditional as C
from tessera.functions.fixed import RARE_TITLES, TITLE_CODES, TITLE_MERGES
from tessera.functions import strings as S
from tessera.operators.ordering import exact_percentiles
from tessera.session import keep

FEATURES = ["cls", "is_male", "age", "sibs", "parch", "fare", "port_code", "title_code",
            "family_size", "is_alone"]


@dataclass
class FeatureModel:
    """Fill values and codes: a median age per (sex, class), a median fare, the
    most frequent port and the sorted ports.  All are as many as the
    categories, not the rows, so they are kept on the driver."""
    ages: dict[tuple[str, int], float]
    fare: float | None
    port: str | None
    ports: list[str]

    @classmethod
    def fit(cls, train: DataFrame) -> FeatureModel:
        ages = exact_percentiles(train, "age", [0.5], ["sex", "cls"], ["m"]).collect()
        fare = exact_percentiles(train, "fare", [0.5], [], ["m"]).first()
        # a port's rows give both the mode and the codes; ports are few, as ages are
        ports = train.filter(F.col("port").isNotNull()).groupBy("port").count().collect()
        return cls({(r["sex"], r["cls"]): r["m"] for r in ages}, fare["m"] if fare else None,
                   min(ports, key=lambda r: (-r["count"], r["port"]))["port"] if ports else None, sorted(r["port"] for r in ports))

    def transform(self, m: DataFrame, features_col: str = "features") -> DataFrame:
        """row_id, split, label (double, null when unlabelled), the FEATURES
        columns (double) and ``features_col``."""
        age = F.lit(None).cast("double")
        for (sex, c), value in sorted(self.ages.items(), key=str):
            age = F.when((F.col("sex") == sex) & (F.col("cls") == c), F.lit(value)).otherwise(age)
        port = F.coalesce(F.col("port"), F.lit(self.port))
        coded = m.withColumn("port", port)
        title = C.collapse(C.collapse(S.title_by_regex("name"), {"Rare": RARE_TITLES}),
                           TITLE_MERGES)
        fam = F.col("sibs") + F.col("parch") + 1
        out = coded.select(
            "row_id", "split", F.col("label").cast("double").alias("label"),
            F.col("cls").cast("double").alias("cls"),
            (F.col("sex") == "male").cast("double").alias("is_male"),
            F.coalesce(F.col("age").cast("double"), age).alias("age"),
            F.col("sibs").cast("double").alias("sibs"),
            F.col("parch").cast("double").alias("parch"),
            (F.coalesce("fare", F.lit(self.fare)) / 1000.0).alias("fare"),
            F.coalesce(C.value_map("port", {p: i for i, p in enumerate(self.ports)}), F.lit(len(self.ports)))
            .cast("double").alias("port_code"),
            C.value_map(title, TITLE_CODES, 0).cast("double").alias("title_code"),
            fam.cast("double").alias("family_size"),
            (fam == 1).cast("double").alias("is_alone"))
        return VectorAssembler(inputCols=FEATURES, outputCol=features_col).transform(out)


def ml_frame(m: DataFrame, features_col: str = "features") -> DataFrame:
    """The features of all rows, with a ``FeatureModel`` of the train part."""
    # several fitted statistics read the same input: keep it (spilling to disk)
    m = keep(m.select("row_id", "split", "label", "cls", "sex", "age", "sibs", "parch", "fare", "port", "name"))
    return FeatureModel.fit(m.filter(F.col("split") == "train")).transform(m, features_col)
