"""Household-role inference within travel groups.

Per row: ``Man``; female -> ``Woman``; age <= cutoff -> ``Child``.  Then per
group: a non-child whose sibling count equals the group's child sibling count
(non-zero) is an ``olderChild``; a non-child whose family size equals the
group's child family size is ``Father`` (if Man) or ``Mother``.  Group
counts/flags follow, and per group *number* the outcome of the first member
(row order) in a role.

Every group statistic depends on the rows only through (group, is_child, sex,
sibs, family size), so the rows are folded once to that compact table (a
partial aggregate), all group logic runs on it, and the per-group result is
joined back to the member rows once, with hot groups salted
(``groups.join_back``).  That is one shuffle of the rows instead of one window
pass per step, and no group is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.strings import trailing_number
from tessera.operators.groups import ROWS, group_stats, join_back
from tessera.session import keep

CHILD_ROLES = ["Child", "olderChild"]


def role_base(age: str = "age", sex: str = "sex", cutoff: float = 15) -> Column:
    return (F.when(F.col(age) <= cutoff, "Child")
            .when(F.col(sex) == "female", "Woman").otherwise("Man"))


def _roles(is_child: Column, sex: Column, sibs: Column, fam: Column,
           child_sibs: Column, child_fam: Column) -> Column:
    base = F.when(is_child, "Child").when(sex == "female", "Woman").otherwise("Man")
    r2 = F.when((base != "Child") & (sibs != 0) & (sibs == child_sibs), "olderChild").otherwise(base)
    return (F.when(~r2.isin(CHILD_ROLES) & (fam == child_fam),
                   F.when(r2 == "Man", "Father").otherwise("Mother"))
            .otherwise(r2))


def _state(label: Column) -> Column:
    return F.when(label.isNull(), "Unknown").when(label == 1, "Yes").otherwise("No")


def household_roles(df: DataFrame, group: str = "ticket", key: str = "row_id",
                    label: str = "label", cutoff: float = 15, outcomes: bool = True) -> DataFrame:
    """``df`` plus role, child_sibs, child_family_size, child_w_adult,
    num_child, num_young_child, has_mother, has_father, has_both and, with
    ``outcomes``, is_mother_survived, is_father_survived, is_child_survived."""
    fam = F.col("sibs") + F.col("parch") + 1
    rows = (df.withColumn("__is_child", F.coalesce(F.col("age") <= cutoff, F.lit(False)))
            .withColumn("__fam", fam))
    compact = rows.groupBy(group, "__is_child", "sex", "sibs", "__fam").agg(
        F.count(F.lit(1)).alias("__n"),
        F.min(key).alias("__first"),
        F.min_by(F.col(label), F.col(key)).alias("__first_label"))

    # group steps as windows over the compact table: a window partition holds
    # one row per distinct (is_child, sex, sibs, family size) of the group -
    # bounded by the attribute domains, not by the group's size
    g = Window.partitionBy(group)
    c2 = compact.withColumn(
        "child_sibs", F.max(F.when(F.col("__is_child"), F.col("sibs")).otherwise(0)).over(g))
    base = F.when(F.col("__is_child"), "Child").when(F.col("sex") == "female", "Woman").otherwise("Man")
    r2 = F.when((base != "Child") & (F.col("sibs") != 0) & (F.col("sibs") == F.col("child_sibs")),
                "olderChild").otherwise(base)
    # read by the group stats and the outcome table
    c3 = keep(c2.withColumn("child_family_size",
                            F.max(F.when(r2.isin(CHILD_ROLES), F.col("__fam")).otherwise(0)).over(g))
              .withColumn("__role", _roles(F.col("__is_child"), F.col("sex"), F.col("sibs"), F.col("__fam"),
                                           F.col("child_sibs"), F.col("child_family_size"))))

    per_group = c3.groupBy(group).agg(
        F.first("child_sibs").alias("child_sibs"),
        F.first("child_family_size").alias("child_family_size"),
        F.sum(F.when(F.col("__role").isin(CHILD_ROLES), F.col("__n")).otherwise(0)).alias("num_child"),
        F.sum(F.when(F.col("__role") == "Child", F.col("__n")).otherwise(0)).alias("num_young_child"),
        F.bool_or(F.col("__role") == "Mother").alias("has_mother"),
        F.bool_or(F.col("__role") == "Father").alias("has_father"),
        F.sum("__n").alias(ROWS))

    stats = _with_outcomes(per_group, c3, group) if outcomes else per_group

    # the member count per group (ROWS) drives hot-group salting in join_back
    return (join_back(rows, stats, group)
            .withColumn("role", _roles(F.col("__is_child"), F.col("sex"), F.col("sibs"), F.col("__fam"),
                                       F.col("child_sibs"), F.col("child_family_size")))
            .withColumn("child_w_adult",
                        F.when(F.col("role").isin(CHILD_ROLES),
                               F.when(F.col("__fam") > F.col("child_sibs") + 1, "Yes").otherwise("No"))
                        .otherwise("Not Applicable"))
            .withColumn("has_both", F.col("has_mother") & F.col("has_father"))
            .drop("__is_child", "__fam"))


def _with_outcomes(per_group: DataFrame, members: DataFrame, group: str) -> DataFrame:
    """Adds the outcome of the first member (smallest row key) in each role,
    per group number.  Groups without a number share one (-1); the join salts
    it."""
    num = trailing_number(F.col(group))
    firsts = (members.filter(F.col("__role").isin("Mother", "Father", "Child"))
              .withColumn("__num", num)
              .groupBy("__num").pivot("__role", ["Mother", "Father", "Child"])
              .agg(F.min_by(_state(F.col("__first_label")), F.col("__first"))))
    outcome = {"Mother": "is_mother_survived", "Father": "is_father_survived", "Child": "is_child_survived"}
    numbered = keep(per_group.withColumn("__num", num))  # one row per group, read twice
    sizes = group_stats(numbered.filter(F.col("__num").isNotNull()), "__num")
    return (join_back(numbered, sizes.join(firsts, "__num"), "__num", salt_by=[group])
            .withColumns({o: F.coalesce(F.col(r), F.lit("Not Applicable")) for r, o in outcome.items()})
            .drop("__num", *outcome))


def guardian_rates(roles: DataFrame, group: str = "ticket", label: str = "label",
                   max_age: float = 17) -> DataFrame:
    """Rows aged <= max_age, by (has_father, has_mother): mean over groups of
    the group's mean label."""
    case = (F.when(F.col("has_father") & ~F.col("has_mother"), "with Father")
            .when(F.col("has_father") & F.col("has_mother"), "with Both")
            .when(~F.col("has_father") & F.col("has_mother"), "with Mother")
            .otherwise("without Parents"))
    per_group = (roles.filter(F.col("age") <= max_age).withColumn("guardian", case)
                 .groupBy("guardian", group).agg(F.avg(label).alias("__r")))
    return per_group.groupBy("guardian").agg(F.avg("__r").alias("rate"))
