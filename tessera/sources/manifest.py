"""The ``manifest`` fixture view: a passenger-manifest shaped table derived
from ``orders`` joined to ``customer`` (rules fixed by FIXTURES.md section 2).

Columns: row_id, split, label, cls, sex, age, sibs, parch, fare, port, cabin,
ticket, name.  ``label`` is a nullable integer (null on ``split='test'`` rows);
``age``, ``fare``, ``port`` and ``cabin`` carry nulls.

The same rules are written once more as a SQL CTE (``MANIFEST_CTE``) for the
independent DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import read_table

# Fixed values (must equal the fixture rules): honorifics chosen by
# o_orderkey % 9, in this order.
TITLES = ["Mr", "Mrs", "Miss", "Master", "Rev", "Mlle", "Mme", "Ms", "the Countess"]

MANIFEST_COLUMNS = ["row_id", "split", "label", "cls", "sex", "age", "sibs",
                    "parch", "fare", "port", "cabin", "ticket", "name"]


def _fixture_projection(ok: Column, ck: Column, status: Column, price: Column,
                        priority: Column, seg: Column, nation: Column,
                        cname: Column) -> list[Column]:
    whole = F.floor(price).cast("bigint")
    group_no = ((ck % 1400) * 3 + ok % 3).cast("string")
    title = F.element_at(F.array(*[F.lit(t) for t in TITLES]), (ok % 9 + 1).cast("int"))
    return [
        ok.alias("row_id"),
        F.when(status == "P", "test").otherwise("train").alias("split"),
        F.when(status == "F", 1).when(status == "O", 0).alias("label"),
        F.substring(priority, 1, 1).cast("int").alias("cls"),
        F.when(whole % 2 == 0, "female").otherwise("male").alias("sex"),
        F.when(ok % 5 != 0, (whole % 80).cast("double")).alias("age"),
        (ok % 4).alias("sibs"),
        (F.floor(price / 100).cast("bigint") % 3).alias("parch"),
        F.when(ok % 11 != 0, price).alias("fare"),
        F.when(ok % 97 != 0, seg).alias("port"),
        F.when(ok % 4 == 0, F.concat(F.substring(seg, 1, 1), nation.cast("string"))).alias("cabin"),
        F.when(ck % 200 == 0, "LINE")
        .when(ck % 3 == 0, group_no)
        .otherwise(F.concat(F.substring(seg, 1, 3), F.lit("/"), (ck % 2).cast("string"),
                            F.lit(" "), group_no)).alias("ticket"),
        F.concat(seg, nation.cast("string"),
                 F.when(ok % 7 == 0, "-X").otherwise(""),
                 F.lit(", "), title, F.lit(". "), cname,
                 F.when(ok % 6 == 0, " (nee A, B)").otherwise("")).alias("name"),
    ]


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer on the customer key.  Both sides grow with the
    data, so the join is left to the planner (AQE converts it to a broadcast
    join only when the customer side is measured small at run time)."""
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer",
                   ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(*_fixture_projection(
        F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"),
        F.col("o_totalprice"), F.col("o_orderpriority"), F.col("c_mktsegment"),
        F.col("c_nationkey"), F.col("c_name")))


MANIFEST_CTE = """manifest AS (
  SELECT o.o_orderkey AS row_id,
    CASE WHEN o.o_orderstatus = 'P' THEN 'test' ELSE 'train' END AS split,
    CASE WHEN o.o_orderstatus = 'F' THEN 1 WHEN o.o_orderstatus = 'O' THEN 0 END AS label,
    CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS cls,
    CASE WHEN CAST(floor(o.o_totalprice) AS BIGINT) % 2 = 0 THEN 'female' ELSE 'male' END AS sex,
    CASE WHEN o.o_orderkey % 5 <> 0 THEN CAST(CAST(floor(o.o_totalprice) AS BIGINT) % 80 AS DOUBLE) END AS age,
    o.o_orderkey % 4 AS sibs,
    CAST(floor(o.o_totalprice / 100) AS BIGINT) % 3 AS parch,
    CASE WHEN o.o_orderkey % 11 <> 0 THEN o.o_totalprice END AS fare,
    CASE WHEN o.o_orderkey % 97 <> 0 THEN c.c_mktsegment END AS port,
    CASE WHEN o.o_orderkey % 4 = 0 THEN substr(c.c_mktsegment, 1, 1) || CAST(c.c_nationkey AS VARCHAR) END AS cabin,
    CASE WHEN o.o_custkey % 200 = 0 THEN 'LINE'
         WHEN o.o_custkey % 3 = 0 THEN CAST((o.o_custkey % 1400) * 3 + o.o_orderkey % 3 AS VARCHAR)
         ELSE substr(c.c_mktsegment, 1, 3) || '/' || CAST(o.o_custkey % 2 AS VARCHAR) || ' '
              || CAST((o.o_custkey % 1400) * 3 + o.o_orderkey % 3 AS VARCHAR) END AS ticket,
    c.c_mktsegment || CAST(c.c_nationkey AS VARCHAR)
      || CASE WHEN o.o_orderkey % 7 = 0 THEN '-X' ELSE '' END || ', '
      || (['Mr', 'Mrs', 'Miss', 'Master', 'Rev', 'Mlle', 'Mme', 'Ms', 'the Countess'])[CAST(o.o_orderkey % 9 + 1 AS INTEGER)]
      || '. ' || c.c_name
      || CASE WHEN o.o_orderkey % 6 = 0 THEN ' (nee A, B)' ELSE '' END AS name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""
