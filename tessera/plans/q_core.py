"""Queries for sources, sets, profiling, projection, strings and bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import binning as B
from tessera.functions import conditional as C
from tessera.functions import strings as S
from tessera.functions.draws import draw_u32
from tessera.functions.fixed import DECK_GROUPS, FAMILY_MAP, RARE_TITLES, TITLE_CODES, TITLE_MERGES
from tessera.operators import encode as E
from tessera.operators import group_features as gf
from tessera.operators import profile as P
from tessera.operators.aggregate import value_counts
from tessera.operators.ordering import exact_percentiles, row_number
from tessera.operators.roles import role_base
from tessera.plans.catalog import query
from tessera.session import scratch_folder
from tessera.sources import files
from tessera.sources.manifest import manifest


def R(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _m(spark, sf):
    return manifest(spark, sf)


@query("group_rate_by_size")
def q_group_rate_by_size(spark, sf):
    return gf.group_rate_by_size(_m(spark, sf))


# ---- 2.1 sources and sinks -------------------------------------------------

@query("read_csv_typed")
def q_read_csv_typed(spark, sf):
    m = _m(spark, sf)
    path = scratch_folder(spark, "csv")
    files.write_csv(m, path)
    return files.read_csv_typed(spark, path, m.schema)


@query("write_csv")
def q_write_csv(spark, sf):
    m = _m(spark, sf).filter(F.col("split") == "train").select("row_id", "label", "name")
    path = scratch_folder(spark, "csv")
    files.write_csv(m, path)
    return files.read_csv_typed(spark, path, m.schema)


# ---- 2.2 union, split, sets ------------------------------------------------

def _parts(spark, sf):
    m = _m(spark, sf)
    return (m.filter(F.col("split") == "train"),
            m.filter(F.col("split") == "test").drop("label"))


@query("union_outer")
def q_union_outer(spark, sf):
    train, test = _parts(spark, sf)
    return (train.withColumn("dataset", F.lit("labelled"))
            .unionByName(test.withColumn("dataset", F.lit("unlabelled")), allowMissingColumns=True))


@query("union_same")
def q_union_same(spark, sf):
    train, test = _parts(spark, sf)
    cols = ["row_id", "sex", "cls"]
    return train.select(cols).unionByName(test.select(cols))


@query("split_labelled")
def q_split_labelled(spark, sf):
    return _parts(spark, sf)[1]


@query("keys_in_both")
def q_keys_in_both(spark, sf):
    train, test = _parts(spark, sf)
    # distinct before the intersection: a hot key is one row of each side
    return train.select("ticket").distinct().intersect(test.select("ticket").distinct())


@query("distinct_values")
def q_distinct_values(spark, sf):
    return _m(spark, sf).select("port").distinct()


@query("concat_columns")
def q_concat_columns(spark, sf):
    """Two frames that are built apart, the second without a key, side by side in
    the order of their row ids."""
    from tessera.operators.reshape import glue_columns
    m = _m(spark, sf)
    left = m.select("row_id", "age", "fare")
    sized = m.select("row_id", "sex", "port", (F.col("sibs") + F.col("parch") + 1).alias("family_size"))
    codes = E.CategoricalEncoder(["port"], "onehot-dense", "ignore").fit(m).transform(sized)
    ports = [f"port_{i + 1}" for i in range(len(codes.columns) - len(sized.columns))]
    right = row_number(codes, ["row_id"], name="place").select("place", "sex", "family_size", *ports)
    return glue_columns(left, right, ["row_id"], ["place"], drop=["place"])


# ---- 2.3 profiling -----------------------------------------------------------

@query("profile_shape")
def q_profile_shape(spark, sf):
    train, test = _parts(spark, sf)
    return P.shape(_m(spark, sf), "split", {"train": len(train.columns), "test": len(test.columns)})


@query("profile_info")
def q_profile_info(spark, sf):
    return P.info(_m(spark, sf)).withColumnRenamed("column", "col_name")


@query("profile_missing")
def q_profile_missing(spark, sf):
    return P.missing(_m(spark, sf), "split").withColumnRenamed("column", "col_name")


NUMERIC = ["row_id", "label", "cls", "age", "sibs", "parch", "fare"]
CATEGORICAL = ["split", "sex", "port", "cabin", "ticket", "name"]


@query("describe_numeric")
def q_describe_numeric(spark, sf):
    train = _parts(spark, sf)[0]
    d = P.describe_numeric(train, NUMERIC).withColumnRenamed("column", "col_name")
    return d.select("col_name", "count", *[R(c).alias(c) for c in
                                           ["mean", "std", "min", "p25", "p50", "p75", "max"]])


@query("describe_categorical")
def q_describe_categorical(spark, sf):
    train = _parts(spark, sf)[0]
    return P.describe_categorical(train, CATEGORICAL).withColumnRenamed("column", "col_name")


@query("value_counts")
def q_value_counts(spark, sf):
    return value_counts(_m(spark, sf), "port", "n")


@query("value_share")
def q_value_share(spark, sf):
    sizes = _m(spark, sf).groupBy("ticket").agg(F.count(F.lit(1)).alias("team_size"))
    dist = sizes.groupBy("team_size").agg(F.count(F.lit(1)).alias("n_groups"))
    total = dist.agg(F.sum("n_groups").alias("__t"))
    return (dist.crossJoin(F.broadcast(total))  # one row
            .select("team_size", "n_groups", R(F.col("n_groups") / F.col("__t") * 100).alias("pct")))


@query("nunique")
def q_nunique(spark, sf):
    return _m(spark, sf).agg(*[F.countDistinct(c).alias(f"n_{c}") for c in ["ticket", "port", "cabin"]])


@query("head_rows")
def q_head_rows(spark, sf):
    return _m(spark, sf).orderBy("row_id").limit(10)


@query("sample_groups")
def q_sample_groups(spark, sf, n=100, seed=7):
    m = _m(spark, sf)
    keys = (m.groupBy("ticket").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("h", draw_u32("ticket", seed)))
    sampled = keys.orderBy("h", "ticket").limit(n)
    chosen = sampled.filter(F.col("n") > 1).orderBy("h", "ticket").limit(1).select("ticket")
    return m.join(F.broadcast(chosen), "ticket", "left_semi").select("row_id", "ticket", "name")


@query("first_multi_group")
def q_first_multi_group(spark, sf):
    m = _m(spark, sf)
    first = (m.groupBy("ticket").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > 1).orderBy("ticket").limit(1).select("ticket"))
    return m.join(F.broadcast(first), "ticket", "left_semi").select("row_id", "ticket", "name")


@query("get_group")
def q_get_group(spark, sf):
    m = _m(spark, sf)
    return m.filter((F.col("cls") == 1) & (F.col("sex") == "female")).select("row_id", "name")


@query("five_number_summary")
def q_five_number_summary(spark, sf):
    m = _m(spark, sf)
    ends = m.groupBy("cls").agg(F.min("fare").alias("lo"), F.max("fare").alias("hi"))
    mid = exact_percentiles(m, "fare", [0.25, 0.5, 0.75], ["cls"], ["q1", "median", "q3"])
    return ends.join(mid, "cls").select("cls", *[R(c).alias(c) for c in ["lo", "q1", "median", "q3", "hi"]])


# ---- 2.4 projection, filter, conditional ----------------------------------------

@query("select_columns")
def q_select_columns(spark, sf):
    return _m(spark, sf).select("row_id", "name", "sex")


@query("drop_columns")
def q_drop_columns(spark, sf):
    return _m(spark, sf).drop("cabin", "name", "ticket")


RENAMES = {"sibs": "sib_sp", "parch": "par_ch", "port": "embarked"}


@query("rename_columns")
def q_rename_columns(spark, sf):
    return _m(spark, sf).withColumnsRenamed(RENAMES)


@query("filter_compare")
def q_filter_compare(spark, sf):
    m = _m(spark, sf)
    cond = (((F.col("sex") == "female") & (F.col("cls") <= 2))
            | (~(F.col("age") > 7) & (F.col("label") != 0)))
    return m.filter(cond).select("row_id")


@query("filter_in")
def q_filter_in(spark, sf):
    m = _m(spark, sf)
    return m.filter(F.col("port").isin("AUTOMOBILE", "BUILDING") & F.col("cls").isin(1, 2)).select("row_id")


@query("filter_between")
def q_filter_between(spark, sf):
    m = _m(spark, sf).filter(F.col("fare").between(100000, 125000))
    return value_counts(m, "port", "n")


@query("filter_null")
def q_filter_null(spark, sf):
    m = _m(spark, sf)
    return m.filter(F.col("age").isNull() & (F.col("split") == "train")).select("row_id", "fare")


@query("derive_arith")
def q_derive_arith(spark, sf):
    m = _m(spark, sf)
    fam = F.col("sibs") + F.col("parch") + 1
    return m.select("row_id", fam.alias("family_size"),
                    R(F.col("fare") / fam).alias("fare_pp"),
                    R((F.col("age") + F.col("fare")) / 2).alias("age_fare_mean"))


@query("derive_constant")
def q_derive_constant(spark, sf):
    return _m(spark, sf).select("row_id", F.lit("manifest").alias("dataset"), F.lit(1).alias("one"))


@query("cond_assign")
def q_cond_assign(spark, sf):
    m = _m(spark, sf)
    return m.select("row_id",
                    F.when(S.title_by_split("name") == "Mrs", 1).otherwise(0).alias("is_married"),
                    F.when(F.col("fare") > 400000, F.lit(400000.0)).otherwise(F.col("fare")).alias("fare_capped"))


@query("cond_select")
def q_cond_select(spark, sf):
    m = _m(spark, sf).withColumn("role", role_base())
    outcome = C.select_first([(F.col("role") != "Woman", "Not applicable"),
                              (F.col("label").isNull(), "Unknown"),
                              (F.col("label") == 1, "Yes"),
                              (F.col("label") == 0, "No")], default="0")
    return m.select("row_id", outcome.alias("outcome"))


@query("cond_mask")
def q_cond_mask(spark, sf):
    m = _m(spark, sf)
    return m.select("row_id", C.keep_where("fare", F.col("cls") == 1).alias("fare_first"))


@query("patch_rows")
def q_patch_rows(spark, sf):
    from tessera.operators.joins import patch_rows
    m = _m(spark, sf)
    patches = (m.filter(F.col("name").contains("(nee") & F.col("age").isNull())
               .select("row_id", F.lit(14.5).alias("age")))
    return patch_rows(m, patches, "row_id", ["age"]).select("row_id", "age")


def collapsed_title(name_col="name"):
    t = C.collapse(S.title_by_regex(name_col), {"Rare": RARE_TITLES})
    return C.collapse(t, TITLE_MERGES)


@query("value_map")
def q_value_map(spark, sf):
    m = _m(spark, sf)
    fam = F.col("sibs") + F.col("parch") + 1
    return m.select("row_id", fam.alias("family_size"),
                    C.value_map(fam, FAMILY_MAP).alias("size_group"),
                    C.value_map(collapsed_title(), TITLE_CODES, 0).alias("title_code"))


@query("value_collapse")
def q_value_collapse(spark, sf):
    m = _m(spark, sf)
    deck = C.collapse(C.collapse(S.first_char("cabin"), {"A": ["T"]}), DECK_GROUPS)
    return m.select("row_id", deck.alias("deck"), collapsed_title().alias("title"))


@query("cast_types")
def q_cast_types(spark, sf):
    m = _m(spark, sf)
    return m.select("row_id", F.col("fare").cast("int").alias("fare_int"),
                    F.col("ticket").try_cast("bigint").alias("ticket_no"),
                    F.col("cls").cast("string").alias("cls_str"))


# ---- 2.5 strings -----------------------------------------------------------------

def _str_query(name, col, fn, out):
    @query(name)
    def q(spark, sf):
        return _m(spark, sf).select("row_id", fn(col).alias(out))
    return q


_str_query("str_trailing_number", "ticket", S.trailing_number, "ticket_num")
_str_query("str_prefix", "ticket", S.prefix_before_number, "ticket_prefix")
_str_query("str_first_char", "cabin", S.first_char, "deck")
_str_query("str_last_name", "name", S.last_name, "last_name")
_str_query("str_title_split", "name", S.title_by_split, "title")
_str_query("str_title_regex", "name", S.title_by_regex, "title")
_str_query("str_surname_clean", "name", S.surname_clean, "family")


# ---- 2.6 bins ---------------------------------------------------------------------

AGE_EDGES = [0, 16, 32, 48, 64, 80]


@query("bin_explicit")
def q_bin_explicit(spark, sf):
    m = _m(spark, sf)
    return B.cut_explicit(m, "age", AGE_EDGES, "age_bin").select("row_id", "age_bin", "age_bin_lo", "age_bin_hi")


@query("bin_equal_width")
def q_bin_equal_width(spark, sf):
    return B.cut_equal_width(_m(spark, sf), "fare", 5, "fare_bin").select("row_id", "fare_bin")


@query("bin_quantile")
def q_bin_quantile(spark, sf):
    return B.cut_quantile(_m(spark, sf), "fare", 13, "fare_bin").select("row_id", "fare_bin")


@query("bin_floor")
def q_bin_floor(spark, sf):
    return _m(spark, sf).select("row_id", B.floor_bucket("age", 15).alias("age_bucket"))


@query("bin_threshold")
def q_bin_threshold(spark, sf):
    m = _m(spark, sf)
    return m.select("row_id", B.threshold_code("age", [16, 32, 48, 64]).alias("age_code"),
                    B.threshold_code(F.col("fare") / 10000, [7.91, 14.454, 31]).alias("fare_code"))


@query("histogram_facet")
def q_histogram_facet(spark, sf, width=5, top=75):
    m = _m(spark, sf).filter((F.col("age") >= 0) & (F.col("age") <= top))
    idx = F.least(F.floor(F.col("age") / width), F.lit(top // width - 1))
    counts = m.groupBy("cls", "sex", (idx * width).cast("int").alias("bin_lo")).agg(
        F.count(F.lit(1)).alias("cnt"))
    totals = m.groupBy("cls", "sex").agg(F.count(F.lit(1)).alias("__n"))
    return (counts.join(totals, ["cls", "sex"])
            .select("cls", "sex", "bin_lo", "cnt", R(F.col("cnt") / (F.col("__n") * width)).alias("density")))
