"""Queries for aggregates, group broadcasts, joins, sorting, reshaping and
imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import binning as B
from tessera.functions import strings as S
from tessera.functions.nulls import rate
from tessera.operators import impute as I
from tessera.operators import reshape as RS
from tessera.operators.aggregate import mode_table, top_n_per_group
from tessera.operators.groups import broadcast_to_rows, group_stats, join_back
from tessera.operators.joins import lookup_with_default
from tessera.operators.ordering import exact_median, exact_percentiles
from tessera.plans.catalog import query
from tessera.session import keep
from tessera.sources.manifest import manifest


def R(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _m(spark, sf):
    return manifest(spark, sf)


def _train(spark, sf):
    return _m(spark, sf).filter(F.col("split") == "train")


def _ticket_rate():
    return (rate(F.sum("label"), F.count("label")) * 100)


# ---- 2.7 aggregation ----------------------------------------------------------------

@query("agg_mean_by")
def q_agg_mean_by(spark, sf):
    return _m(spark, sf).groupBy("cls", "sex").agg(R(F.avg("fare")).alias("mean_fare"),
                                                   R(F.avg("age")).alias("mean_age"))


@query("agg_rate_nullaware")
def q_agg_rate_nullaware(spark, sf):
    return _m(spark, sf).groupBy("ticket").agg(R(_ticket_rate()).alias("rate"))


@query("agg_size_vs_count")
def q_agg_size_vs_count(spark, sf, limit=5):
    g = _m(spark, sf).groupBy("ticket").agg(F.count(F.lit(1)).alias("team_size"),
                                            F.count("label").alias("n_labelled"))
    return (g.withColumn("big_by_size", F.col("team_size") > limit)
            .withColumn("big_by_count", F.col("n_labelled") > limit)
            .filter(F.col("big_by_size") | F.col("big_by_count")))


@query("agg_mean_of_means")
def q_agg_mean_of_means(spark, sf):
    per_group = _m(spark, sf).groupBy("ticket").agg(F.count(F.lit(1)).alias("team_size"),
                                                    _ticket_rate().alias("rate"))
    return per_group.groupBy("team_size").agg(R(F.avg("rate")).alias("mean_rate"))


@query("agg_median_by")
def q_agg_median_by(spark, sf):
    med = exact_percentiles(_m(spark, sf), "fare", [0.5], ["cls", "parch", "sibs"], ["median_fare"])
    return med.select("cls", "parch", "sibs", R("median_fare").alias("median_fare"))


@query("agg_first_by")
def q_agg_first_by(spark, sf):
    m = _m(spark, sf)
    return m.groupBy("ticket").agg(
        F.min_by(F.col("cabin"), F.when(F.col("cabin").isNotNull(), F.col("row_id"))).alias("first_cabin"))


@query("agg_nunique_by")
def q_agg_nunique_by(spark, sf):
    kids = _m(spark, sf).filter((F.col("age") <= 15) & (F.col("sibs") > 0))
    per_group = kids.groupBy("ticket").agg(F.countDistinct("sibs").alias("n_distinct"))
    return per_group.groupBy("n_distinct").agg(F.count(F.lit(1)).alias("n_groups"))


@query("agg_any_by")
def q_agg_any_by(spark, sf):
    m = _m(spark, sf)
    hit = F.coalesce((F.col("age") <= 15) & (F.col("label") == 1), F.lit(False))
    per_group = m.groupBy("ticket").agg(F.bool_or(hit).alias("child_survived"))
    return per_group.groupBy("child_survived").agg(F.count(F.lit(1)).alias("n_groups"))


@query("agg_multi_by")
def q_agg_multi_by(spark, sf):
    return _m(spark, sf).groupBy("ticket").agg(F.max("parch").alias("max_parch"),
                                               F.min("sibs").alias("min_sibs"))


AGE_DECADES = list(range(0, 80, 10))


def _age_decade(df):
    return df.withColumn("age_bin", B.cut_index("age", AGE_DECADES))


@query("agg_by_bin")
def q_agg_by_bin(spark, sf):
    m = keep(_age_decade(_m(spark, sf)).groupBy("cls", "sex", "age_bin").agg(
        F.sum("label").cast("bigint").alias("survivors")))
    sums = m.filter(F.col("age_bin").isNotNull())
    return RS.complete_grid(sums, {"cls": m.select("cls").distinct(), "sex": m.select("sex").distinct(),
                                   "age_bin": list(range(len(AGE_DECADES) - 1))},
                            {"survivors": 0})


@query("agg_label_counts")
def q_agg_label_counts(spark, sf):
    return _m(spark, sf).groupBy("cls", "sex").agg(F.sum("label").cast("bigint").alias("survivors"),
                                                   F.count("label").alias("n_labelled"))


@query("agg_parent_total")
def q_agg_parent_total(spark, sf):
    child = _m(spark, sf).groupBy("cls", "sex").agg(F.count("label").alias("n_labelled"))
    return child.groupBy("cls").agg(F.sum("n_labelled").alias("n_labelled"))


@query("agg_ratio_child")
def q_agg_ratio_child(spark, sf):
    return _m(spark, sf).groupBy("cls", "sex").agg(R(rate(F.sum("label"), F.count("label"))).alias("rate"))


@query("agg_ratio_parent")
def q_agg_ratio_parent(spark, sf):
    from pyspark.sql import Window
    child = _m(spark, sf).groupBy("cls", "sex").agg(F.sum("label").alias("c"), F.count("label").alias("d"))
    # window over the (class, sex) aggregate: a handful of rows per class
    parent = F.sum("d").over(Window.partitionBy("cls"))
    return child.select("cls", "sex", R(rate(F.col("c"), parent)).alias("share"))


@query("agg_global_scalars")
def q_agg_global_scalars(spark, sf):
    t = _train(spark, sf)
    mom = t.agg(R(F.avg("age")).alias("mean_age"), R(F.stddev_samp("age")).alias("std_age"),
                F.sum(F.col("age").isNull().cast("bigint")).alias("null_age"))
    med = exact_median(t, "age", name="median_age").select(R("median_age").alias("median_age"))
    return mom.crossJoin(med)  # one row each


@query("agg_mode")
def q_agg_mode(spark, sf):
    t = _train(spark, sf)
    long = t.select("port", "cabin", "sex").unpivot([], ["port", "cabin", "sex"], "col_name", "value")
    return mode_table(long, ["col_name"], "value").withColumnRenamed("mode", "mode_value")


FARE_EDGES = [0, 100000, 200000, 300000, 400000, 500000, 600000]


@query("topn_value_counts_by")
def q_topn_value_counts_by(spark, sf):
    m = _m(spark, sf).withColumn("fare_bin", B.cut_index("fare", FARE_EDGES))
    counts = (m.filter(F.col("port").isNotNull() & F.col("fare_bin").isNotNull())
              .groupBy("cls", "fare_bin", "port").agg(F.count(F.lit(1)).alias("cnt")))
    return top_n_per_group(counts, ["cls", "fare_bin"], [F.col("cnt").desc(), F.col("port")], 3)


# ---- 2.8 group broadcasts (skew-safe aggregate + join back) ----------------------------

@query("win_group_size")
def q_win_group_size(spark, sf):
    return broadcast_to_rows(_m(spark, sf), "ticket", team_size=F.count(F.lit(1))).select("row_id", "team_size")


@query("win_group_count")
def q_win_group_count(spark, sf):
    return broadcast_to_rows(_m(spark, sf), "ticket", n_labelled=F.count("label")).select("row_id", "n_labelled")


@query("win_group_max")
def q_win_group_max(spark, sf):
    child_sibs = F.max(F.when(F.col("age") <= 15, F.col("sibs")).otherwise(0))
    return broadcast_to_rows(_m(spark, sf), "ticket", child_sibs=child_sibs).select("row_id", "child_sibs")


@query("win_nunique_gt1")
def q_win_nunique_gt1(spark, sf):
    m = _m(spark, sf).select("row_id", S.trailing_number("ticket").alias("ticket_num"),
                             S.prefix_before_number("ticket").alias("ticket_prefix"))
    out = broadcast_to_rows(m, "ticket_num", __lo=F.min("ticket_prefix"), __hi=F.max("ticket_prefix"))
    return out.filter(F.col("__lo") != F.col("__hi")).select("row_id", "ticket_num", "ticket_prefix")


@query("win_count_if")
def q_win_count_if(spark, sf):
    return broadcast_to_rows(_m(spark, sf), "ticket", n_child=F.count_if(F.col("age") <= 15)).select(
        "row_id", "n_child")


@query("win_any")
def q_win_any(spark, sf):
    out = broadcast_to_rows(_m(spark, sf), "ticket",
                            has_child=F.bool_or(F.coalesce(F.col("age") <= 15, F.lit(False))))
    return out.select("row_id", "has_child")


@query("win_first_nonnull")
def q_win_first_nonnull(spark, sf):
    m = _m(spark, sf).withColumn("ticket_num", S.trailing_number("ticket"))
    first = F.min_by(F.col("cabin"), F.when(F.col("cabin").isNotNull(), F.col("row_id")))
    out = broadcast_to_rows(m, "ticket_num", first_cabin=first)
    return out.select("row_id", F.coalesce("first_cabin", F.lit("Not Applicable")).alias("first_cabin"))


@query("win_credibility")
def q_win_credibility(spark, sf):
    out = broadcast_to_rows(_m(spark, sf), "ticket", credibility=rate(F.count("label"), F.count(F.lit(1))))
    return out.select("row_id", R("credibility").alias("credibility"))


@query("win_weighted_rate")
def q_win_weighted_rate(spark, sf):
    out = broadcast_to_rows(_m(spark, sf), "ticket", credibility=rate(F.count("label"), F.count(F.lit(1))),
                            rate=_ticket_rate())
    return out.select("row_id", R(F.col("credibility") * F.col("rate")).alias("weighted_rate"))


@query("topn_per_group")
def q_topn_per_group(spark, sf):
    m = _m(spark, sf)
    per_ticket = m.groupBy("ticket").agg(R(_ticket_rate()).alias("rate"), F.count(F.lit(1)).alias("team_size"))
    pairs = m.select("cls", "ticket").distinct().join(per_ticket, "ticket")
    return top_n_per_group(pairs, ["cls"], [F.col("rate").desc_nulls_last(), F.col("team_size").desc(),
                                            F.col("ticket")], 3)


# ---- 2.9 joins ---------------------------------------------------------------------------

@query("join_agg_back_inner")
def q_join_agg_back_inner(spark, sf):
    m = _m(spark, sf)
    out = broadcast_to_rows(m, "ticket", how="inner", rate=_ticket_rate())
    return out.select("row_id", "ticket", R("rate").alias("rate"))


@query("join_agg_back_left")
def q_join_agg_back_left(spark, sf):
    out = broadcast_to_rows(_m(spark, sf), "ticket", max_parch=F.max("parch"), min_sibs=F.min("sibs"))
    return out.select("row_id", "max_parch", "min_sibs")


@query("join_lookup_default")
def q_join_lookup_default(spark, sf):
    m = _m(spark, sf)
    train = F.col("split") == "train"
    # one fold of all rows: rates of the train part, and the row counts that salting needs
    table = group_stats(m.filter(F.col("ticket").isNotNull()), "ticket", F.avg(F.when(train, F.col("label"))).alias("r"),
                        F.count(F.when(train, F.col("label"))).alias("n")).filter(F.col("n") >= 2)
    mean = m.filter(train).agg(F.avg("label").alias("__mean"))
    out = lookup_with_default(m.crossJoin(F.broadcast(mean)), table, "ticket", "r", F.col("__mean"),
                              "ticket_rate", "ticket_hit")
    return out.select("row_id", R("ticket_rate").alias("ticket_rate"), "ticket_hit")


@query("join_semi")
def q_join_semi(spark, sf):
    m = _m(spark, sf)
    # one fold by key; member rows of a hot ticket are salted
    table = group_stats(m.filter(F.col("ticket").isNotNull()), "ticket",
                        F.count(F.when(F.col("split") == "test", 1)).alias("n_test")).filter(F.col("n_test") > 0)
    return join_back(m.filter(F.col("split") == "train").select("row_id", "ticket"), table, "ticket", how="inner",
                     salt_by=["row_id"]).select("row_id")


# ---- 2.10 sort ---------------------------------------------------------------------------

@query("sort_multi")
def q_sort_multi(spark, sf):
    return _m(spark, sf).select("row_id", "cls", "fare").orderBy(
        F.col("cls").asc_nulls_last(), F.col("fare").desc_nulls_last(), "row_id")


@query("sort_head")
def q_sort_head(spark, sf):
    return _m(spark, sf).select("row_id", "fare").orderBy(F.col("fare").desc_nulls_last(), "row_id").limit(10)


# ---- 2.11 reshape --------------------------------------------------------------------------

@query("melt")
def q_melt(spark, sf):
    return _m(spark, sf).select("row_id", "age", "fare").unpivot(["row_id"], ["age", "fare"], "variable", "value")


def _survivors_by_bin(spark, sf):
    m = _age_decade(_m(spark, sf)).filter(F.col("age_bin").isNotNull())
    return m.groupBy("cls", "sex", "age_bin").agg(F.sum("label").cast("bigint").alias("survivors"))


@query("pivot_sum")
def q_pivot_sum(spark, sf):
    m = _age_decade(_m(spark, sf)).filter(F.col("age_bin").isNotNull())
    return (m.groupBy("cls", "age_bin").pivot("sex", ["female", "male"])
            .agg(F.sum("label").cast("bigint")))


@query("stack_long")
def q_stack_long(spark, sf):
    wide = q_pivot_sum(spark, sf)
    return wide.unpivot(["cls", "age_bin"], ["female", "male"], "sex", "survivors")


@query("grid_complete")
def q_grid_complete(spark, sf):
    # one fold of the rows; key values and counts both follow from it
    m = keep(_age_decade(_m(spark, sf)).groupBy("cls", "sex", "age_bin").agg(F.count(F.lit(1)).alias("n")))
    counts = m.filter(F.col("age_bin").isNotNull())
    return RS.complete_grid(counts, {"cls": m.select("cls").distinct(), "sex": m.select("sex").distinct(),
                                     "age_bin": list(range(len(AGE_DECADES) - 1))}, {"n": 0})


@query("stacked_total")
def q_stacked_total(spark, sf):
    m = keep(_age_decade(_m(spark, sf)).groupBy("cls", "sex", "age_bin").agg(
        F.sum("label").cast("bigint").alias("survivors")))
    sums = m.filter(F.col("age_bin").isNotNull())
    grid = RS.complete_grid(sums, {"cls": m.select("cls").distinct(), "sex": m.select("sex").distinct(),
                                   "age_bin": list(range(len(AGE_DECADES) - 1))}, {"survivors": 0})
    return RS.stacked_total(grid, ["cls", "age_bin"], "sex", "survivors", ["female", "male"])


@query("param_sweep_rate")
def q_param_sweep_rate(spark, sf):
    return RS.cutoff_sweep(_m(spark, sf), range(1, 30))


# ---- 2.12 imputation -------------------------------------------------------------------------

@query("impute_constant")
def q_impute_constant(spark, sf):
    return I.fill_constant(_m(spark, sf), {"port": "S"}).select("row_id", "port")


@query("impute_global_median")
def q_impute_global_median(spark, sf):
    return I.fill_global_median(_m(spark, sf), "age", _train(spark, sf)).select("row_id", "age")


@query("impute_mode")
def q_impute_mode(spark, sf):
    return I.fill_mode(_m(spark, sf), ["port", "cabin"], _train(spark, sf)).select("row_id", "port", "cabin")


@query("impute_group_median")
def q_impute_group_median(spark, sf):
    return I.fill_group_median(_m(spark, sf), "age", ["sex", "cls"]).select("row_id", "age")


@query("impute_cell_median")
def q_impute_cell_median(spark, sf):
    cell = (F.col("cls") == 3) & (F.col("parch") == 0) & (F.col("sibs") == 0)
    return I.fill_cell_median(_m(spark, sf), "fare", cell).select("row_id", R("fare").alias("fare"))


@query("impute_random_range")
def q_impute_random_range(spark, sf):
    return I.fill_random_range(_m(spark, sf), "age", "row_id", 42, _train(spark, sf)).select("row_id", "age")
