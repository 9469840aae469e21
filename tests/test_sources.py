"""CSV quoting, bins of degenerate columns, and checkpoint folders."""

import os
import subprocess
import sys

import pandas as pd
import pytest

from tessera.functions import binning as B
from tessera.sources import files

ROWS = [(1, 'Nye, "Liz", Mrs.'), (2, "plain"), (3, None), (4, '"'), (5, "back\\slash"), (6, 'Miss. Susan Parker "Suzette"')]


def test_quotes_are_doubled_both_ways(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "id int, name string")
    files.write_csv(df.coalesce(1), str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("part-*"))
    back = pd.read_csv(part)
    assert dict(zip(back.id, back.name.where(back.name.notna(), None))) == dict(ROWS)
    assert sorted(map(tuple, files.read_csv_typed(spark, str(tmp_path / "out"), df.schema).collect())) == ROWS


def test_reads_foreign_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n2,"Nye, ""Liz"", Mrs."\n')
    (tmp_path / "b.csv").write_text('id,name\n3,"two\nlines"\n')
    schema = "id int, name string"
    assert files.read_csv_typed(spark, str(tmp_path / "a.csv"), schema).first().name == 'Nye, "Liz", Mrs.'
    assert files.read_csv_typed(spark, str(tmp_path / "b.csv"), schema, multi_line=True).first().name == "two\nlines"


@pytest.mark.parametrize("values", [[5.0, 5.0, None], [0.0], [-2.0, -2.0]])
def test_equal_width_bins_of_a_constant(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.b for r in B.cut_equal_width(df, "x", 4, "b").collect()]
    exp = [None if pd.isna(v) else int(v) for v in pd.cut(pd.Series(values), 4, labels=False)]
    assert got == exp


def test_equal_quantile_edges_are_an_error(spark):
    df = spark.createDataFrame([(1.0,)] * 8 + [(2.0,)], "x double")
    with pytest.raises(ValueError, match="not unique"):
        B.cut_quantile(df, "x", 4, "b")


SCRIPT = """
import sys
from pyspark.sql import SparkSession
from tessera.session import ensure_checkpoint_dir
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
if sys.argv[1] == "set":
    spark.sparkContext.setCheckpointDir(sys.argv[2])
    import __spark_entry__ as entry
    print("ROWS", entry.entry(spark).count(), ensure_checkpoint_dir(spark).startswith("file:" + sys.argv[2]))
else:
    try:
        print("DIR", ensure_checkpoint_dir(spark))
    except RuntimeError as e:
        print("RAISED", e)
"""


@pytest.mark.parametrize("how", ["set", "none"])
def test_checkpoint_folder_is_the_callers(how, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "conf").mkdir()  # no defaults of this machine
    env = os.environ | {"PYTHONPATH": root, "SPARK_CONF_DIR": str(tmp_path / "conf")}
    out = subprocess.run([sys.executable, "-c", SCRIPT, how, str(tmp_path / "ckpt")], env=env, cwd=tmp_path,
                         capture_output=True, text=True, timeout=200).stdout
    assert ("ROWS 15 True" in out) if how == "set" else ("RAISED no checkpoint folder" in out), out
