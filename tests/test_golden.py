"""Recorded facts of the reference notebooks, replayed on tiny inline frames."""

from pyspark.sql import functions as F

from tessera.functions import binning as B
from tessera.functions import strings as S
from tessera.operators.encode import CategoricalEncoder
from tessera.operators.ordering import exact_median
from tessera.operators.roles import household_roles

SCHEMA = "row_id long, ticket string, sex string, age double, sibs long, parch long, label int"


def test_ticket_parse(spark):
    df = spark.createDataFrame([("A/5 21171",), ("113803",), ("LINE",), ("STON/O 2. 3101294",)], "t string")
    got = df.select(S.trailing_number("t").alias("n"), S.prefix_before_number("t").alias("p")).collect()
    assert [(r.n, r.p) for r in got] == [(21171, "A/5"), (113803, "M"), (-1, "M"), (3101294, "STON/O 2.")]


def test_name_parts(spark):
    df = spark.createDataFrame([("Ryerson, Mrs. Arthur Larned (Emily Maria Borie)",),
                                ("Rothes, the Countess. of (Lucy Noel Martha Dyer-Edwards)",)], "n string")
    got = df.select(S.last_name("n").alias("l"), S.title_by_split("n").alias("t"),
                    S.title_by_regex("n").alias("r"), S.surname_clean("n").alias("f")).collect()
    assert [tuple(r) for r in got] == [("Ryerson", "Mrs", "Mrs", "Ryerson"),
                                       ("Rothes", "the Countess", "Countess", "Rothes")]


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(2.0,), (0.0,), (2.5,), (5.0,), (6.0,)], "x double")
    got = [r.b for r in df.select(B.cut_index("x", [0, 2, 5]).alias("b")).collect()]
    assert got == [0, None, 1, 1, None]   # 2.0 is in (0, 2]; 0 is outside (0, 2]


def test_exact_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    assert exact_median(df, "x").first()[0] == 2.5


def test_encoder_docstring_example(spark):
    from pyspark.ml.functions import vector_to_array
    fit = spark.createDataFrame([(0, 0, 3), (1, 1, 0), (0, 2, 1), (1, 0, 2)], "a int, b int, c int")
    tr = spark.createDataFrame([(0, 1, 1), (1, 0, 4)], "a int, b int, c int")
    model = CategoricalEncoder(["a", "b", "c"], handle_unknown="ignore").fit(fit)
    got = [list(map(int, r.f)) for r in model.transform(tr).select(vector_to_array("features").alias("f")).collect()]
    assert got == [[1, 0, 0, 1, 0, 0, 1, 0, 0], [0, 1, 1, 0, 0, 0, 0, 0, 0]]


def _group(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_roles_seven_person_group(spark):
    rows = [(312, "PC 17608", "female", 18.0, 2, 2, 1), (743, "PC 17608", "female", 21.0, 2, 2, 1),
            (916, "PC 17608", "female", 48.0, 1, 3, None), (951, "PC 17608", "female", 36.0, 0, 0, None),
            (956, "PC 17608", "male", 13.0, 2, 2, None), (1034, "PC 17608", "male", 61.0, 1, 3, None),
            (1267, "PC 17608", "female", 45.0, 0, 0, None)]
    got = {r.row_id: r.role for r in household_roles(_group(spark, rows)).collect()}
    assert got == {312: "olderChild", 743: "olderChild", 916: "Mother", 951: "Woman", 956: "Child",
                   1034: "Father", 1267: "Woman"}


def test_roles_four_person_group(spark):
    rows = [(449, "2666", "female", 5.0, 2, 1, 1), (470, "2666", "female", 0.75, 2, 1, 1),
            (645, "2666", "female", 0.75, 2, 1, 1), (859, "2666", "female", 24.0, 0, 3, 1)]
    out = household_roles(_group(spark, rows)).collect()
    assert {r.row_id: r.role for r in out} == {449: "Child", 470: "Child", 645: "Child", 859: "Mother"}
    assert all(r.has_mother and not r.has_father for r in out)


def test_first_child_rules_the_group(spark):
    rows = [(49, "347077", "female", 38.0, 1, 5, 1), (50, "347077", "male", 9.0, 4, 2, 0),
            (51, "347077", "female", 5.0, 4, 2, 1), (52, "347077", "male", 3.0, 4, 2, 1),
            (53, "347077", "male", 13.0, 4, 2, None), (54, "347077", "male", 40.0, 1, 5, None),
            (55, "347077", "male", 5.0, 4, 2, None)]
    out = household_roles(_group(spark, rows)).collect()
    assert {r.is_child_survived for r in out} == {"No"}
    assert {r.is_mother_survived for r in out} == {"Yes"}
    assert {r.is_father_survived for r in out} == {"Unknown"}
    assert {r.row_id: r.role for r in out}[54] == "Father"


def test_roles_survive_salting(spark, skew_low):
    rows = [(i, "BIG", "male" if i % 2 else "female", float(i % 30), i % 3, i % 2, i % 2) for i in range(40)]
    rows += [(100 + i, f"T{i}", "female", 10.0, 1, 1, 1) for i in range(5)]
    df = _group(spark, rows)
    salted = sorted(tuple(r) for r in household_roles(df).drop("ticket").collect())
    spark.conf.set("spark.tessera.skew.minRows", "100000000")
    plain = sorted(tuple(r) for r in household_roles(df).drop("ticket").collect())
    assert salted == plain
