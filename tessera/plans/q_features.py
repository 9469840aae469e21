"""Queries for encoders, target rates and household roles."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.functions import strings as S
from tessera.operators import encode as E
from tessera.operators import roles as RL
from tessera.operators.preprocess import num_cat_pipeline
from tessera.operators.joins import lookup_with_default
from tessera.operators.target_rate import key_rates, target_rate_encode
from tessera.plans.catalog import query
from tessera.sources.manifest import manifest
from tessera.session import keep


def R(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _m(spark, sf):
    return manifest(spark, sf)


def _train(spark, sf):
    return _m(spark, sf).filter(F.col("split") == "train")


# ---- 2.13 encoders ----------------------------------------------------------------------

@query("label_encode")
def q_label_encode(spark, sf):
    m = _m(spark, sf).select("row_id", "port", "sex", "cabin")
    return E.label_encode_many(m, ["port", "sex", "cabin"]).select("row_id", "port_code", "sex_code", "cabin_code")


@query("minmax_scale")
def q_minmax_scale(spark, sf):
    return E.minmax_scale(_m(spark, sf), "fare", "fare_scaled").select("row_id", R("fare_scaled").alias("fare_scaled"))


@query("standard_scale")
def q_standard_scale(spark, sf):
    out = E.standard_scale(_m(spark, sf), "fare", "fare_std", _train(spark, sf))
    return out.select("row_id", R("fare_std").alias("fare_std"))


@query("encode_ordinal")
def q_encode_ordinal(spark, sf):
    m = _m(spark, sf).withColumn("deck", S.first_char("cabin"))
    model = E.CategoricalEncoder(["sex", "deck", "cls"], encoding="ordinal").fit(_train(spark, sf).withColumn(
        "deck", S.first_char("cabin")))
    return model.transform(m).select("row_id", "sex_code", "deck_code", "cls_code")


@query("encode_onehot_sparse")
def q_encode_onehot_sparse(spark, sf):
    m = _m(spark, sf).withColumn("deck", S.first_char("cabin"))
    model = E.CategoricalEncoder(["cls", "sex", "deck"], encoding="onehot").fit(m)
    arr = vector_to_array(F.col("features"))
    active = F.filter(F.transform(arr, lambda x, i: F.when(x > 0, i)), lambda v: v.isNotNull())
    return model.transform(m).select("row_id", F.size(arr).alias("vec_size"), active.alias("active_idx"))


@query("encode_onehot_dense")
def q_encode_onehot_dense(spark, sf):
    model = E.CategoricalEncoder(["port"], encoding="onehot-dense", handle_unknown="ignore").fit(_m(spark, sf))
    return model.transform(_m(spark, sf)).select("row_id", *[f"port_{i + 1}" for i in range(model.sizes["port"])])


GIVEN_PORTS = ["FURNITURE", "AUTOMOBILE", "BUILDING"]


@query("encode_unknown")
def q_encode_unknown(spark, sf):
    model = E.CategoricalEncoder(["port"], encoding="onehot-dense", handle_unknown="ignore",
                                 categories={"port": GIVEN_PORTS}).fit(_train(spark, sf))
    return model.transform(_m(spark, sf)).select("row_id", "port_1", "port_2", "port_3")


@query("encode_given_categories")
def q_encode_given_categories(spark, sf):
    model = E.CategoricalEncoder(["cls"], encoding="ordinal", categories={"cls": [5, 4, 3, 2, 1]}).fit(
        _train(spark, sf))
    return model.transform(_m(spark, sf)).select("row_id", "cls_code")


def _target_rates(spark, sf):
    # only the needed columns (a persisted frame is not pruned below the cache); read
    # by both folds: keep it (spilling to disk)
    m = keep(_m(spark, sf).select("row_id", "split", "label", "ticket", S.surname_clean("name").alias("family"),
                                  (F.col("sibs") + F.col("parch") + 1).alias("family_size")))
    is_train = F.col("split") == "train"
    out = target_rate_encode(m, is_train, "family", "label", "family_size", "family_rate", "family_hit")
    # the size of a ticket is its number of rows; its fold reads the kept rows, too
    mean = m.filter(is_train).agg(F.avg("label").alias("__mean"))
    table = key_rates(m, is_train, "ticket", "label", None)
    return lookup_with_default(out.crossJoin(F.broadcast(mean)), table, "ticket", "__rate",  # one row
                               F.col("__mean"), "ticket_rate", "ticket_hit").drop("__mean")


@query("target_rate_encode")
def q_target_rate_encode(spark, sf):
    t = _target_rates(spark, sf)
    return t.select("row_id", R("family_rate").alias("family_rate"), "family_hit",
                    R("ticket_rate").alias("ticket_rate"), "ticket_hit")


@query("target_rate_combine")
def q_target_rate_combine(spark, sf):
    t = _target_rates(spark, sf)
    return t.select("row_id", R((F.col("ticket_rate") + F.col("family_rate")) / 2).alias("survival_rate"),
                    R((F.col("ticket_hit") + F.col("family_hit")) / 2).alias("survival_rate_na"))


@query("pipeline_num_cat")
def q_pipeline_num_cat(spark, sf):
    # every pipeline stage is fitted on the output of the previous ones: keep the input
    m = keep(_m(spark, sf).select("row_id", "split", "age", "fare", "port", "sex"))
    model = num_cat_pipeline(["age", "fare"], ["port", "sex"]).fit(m.filter(F.col("split") == "train"))
    arr = vector_to_array(F.col("features"))
    # as wide as the fitted model: the numbers, and the encoder's categories
    wide = 2 + next(st for st in model.stages if isinstance(st, E.CategoricalEncoderModel)).n_features
    return model.transform(m).select("row_id", *[R(arr[i]).alias(f"f{i}") for i in range(wide)])


# ---- 2.14 household roles -------------------------------------------------------------------

def _roles(spark, sf, outcomes=False):
    return RL.household_roles(_m(spark, sf), outcomes=outcomes)


@query("role_base")
def q_role_base(spark, sf):
    return _m(spark, sf).select("row_id", RL.role_base().alias("role"))


@query("role_older_child")
def q_role_older_child(spark, sf):
    r = _roles(spark, sf)
    step2 = F.when(F.col("role") == "Father", "Man").when(F.col("role") == "Mother", "Woman").otherwise(F.col("role"))
    return r.select("row_id", "child_sibs", step2.alias("role"))


@query("role_parents")
def q_role_parents(spark, sf):
    return _roles(spark, sf).select("row_id", "child_family_size", "role")


@query("role_child_with_adult")
def q_role_child_with_adult(spark, sf):
    return _roles(spark, sf).select("row_id", "child_w_adult")


@query("role_child_counts")
def q_role_child_counts(spark, sf):
    return _roles(spark, sf).select("row_id", "num_child", "num_young_child")


@query("role_parent_flags")
def q_role_parent_flags(spark, sf):
    return _roles(spark, sf).select("row_id", "has_mother", "has_father", "has_both")


@query("role_guardian_rate")
def q_role_guardian_rate(spark, sf):
    return RL.guardian_rates(_roles(spark, sf)).select("guardian", R("rate").alias("rate"))


@query("role_member_outcome")
def q_role_member_outcome(spark, sf):
    return _roles(spark, sf, outcomes=True).select("row_id", "is_mother_survived", "is_father_survived", "is_child_survived")


# ---- nearest neighbours ---------------------------------------------------------------------

def _scaled_codes(df, cols):
    """Label-encode each column (sorted distinct values) and min-max scale
    the codes to [0, 1] -> x_<col>."""
    return E.label_encode_many(df, cols, {c: f"x_{c}" for c in cols}, scaled=True)


@query("impute_knn")
def q_impute_knn(spark, sf):
    from tessera.operators.knn import knn_classify
    m = _m(spark, sf).select("row_id", "cls", "port", S.prefix_before_number("ticket").alias("tp"),
                             S.trailing_number("ticket").alias("tn"))
    s = keep(_scaled_codes(m, ["cls", "tp", "tn"]))
    feats = ["x_cls", "x_tp", "x_tn"]
    pred = knn_classify(s.filter(F.col("port").isNotNull()), s.filter(F.col("port").isNull()),
                        feats, "port", "row_id", k=3, weights="distance", out="__pred")
    return s.join(pred, "row_id", "left").select("row_id", F.coalesce("port", "__pred").alias("port"))


@query("clf_knn")
def q_clf_knn(spark, sf):
    from tessera.operators.knn import knn_classify
    s = keep(_scaled_codes(_m(spark, sf).select("row_id", "split", "label", "cls", "sibs", "parch"),
                           ["cls", "sibs", "parch"]))
    feats = ["x_cls", "x_sibs", "x_parch"]
    return knn_classify(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test"),
                        feats, "label", "row_id", k=5, weights="uniform")
