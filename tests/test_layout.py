import glob
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.plans.library import query
from tallyframe.sources import layout as S
from tallyframe.sources.catalog import Catalog


def plan(df):
    return df._jdf.queryExecution().toString()


def test_parse_delimited(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.DateType()), T.StructField("d", T.DecimalType(7, 2))])
    lines = spark.createDataFrame([("1|x|2000-01-02|3.50|",), ("||||",), ("z|y|2000-01-02|1|",)], "value string")
    found = [tuple(map(str, r)) for r in S.parse_delimited(lines, schema).collect()]
    assert found == [("1", "x", "2000-01-02", "3.50"), ("None",) * 4, ("None", "y", "2000-01-02", "1.00")]


def test_switch_types(spark):
    df = spark.sql("select cast(1.5 as decimal(5,2)) a, date '2000-01-01' b, 3 c")
    assert [t for _, t in S.switch_types(df, True, True).dtypes] == ["double", "string", "int"]
    assert [t for _, t in S.switch_types(df).dtypes] == ["decimal(5,2)", "date", "int"]


def test_write_partitioned(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 4 < 3, F.col("id") % 4).alias("k"))
    S.write_table(df, str(tmp_path / "t"), partition_by=["k"], drop_null_partitions=True)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 750
    assert all(len(glob.glob(str(tmp_path / "t" / f"k={k}" / "*.parquet"))) == 1 for k in range(3))
    S.write_table(df.limit(1), str(tmp_path / "t"), overwrite=False)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 750


def test_unknown_table(spark, data):
    with pytest.raises(ValueError):
        S.chosen_tables("tpcds", "nothing")
    with pytest.raises(KeyError):
        Catalog(spark, data, "tpcds").nothing


def test_register_and_analyze(spark, tmp_path):
    S.write_table(spark.range(20).select("id", (F.col("id") % 2).alias("k")), str(tmp_path / "tpch" / "part"), partition_by=["k"])
    S.create_database(spark, "layout_test")
    S.external_table(spark, "layout_test.part", str(tmp_path / "tpch" / "part"), partitioned=True)
    S.analyze_table(spark, "layout_test.part")
    assert spark.table("layout_test.part").count() == 20
    S.temp_view(spark, "part_view", str(tmp_path / "tpch" / "part"))
    assert spark.table("part_view").count() == 20
    spark.catalog.setCurrentDatabase("default")


def test_column_statistics(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "ccc")], "x int, y string")
    found = {r.column: r for r in S.column_statistics(df).collect()}
    assert (found["y"].rows, found["y"].nulls, found["y"].lowest, found["y"].max_length) == (3, 1, "a", 3)
    assert found["x"].approx_distinct == 2


def test_plans_push_down_and_prune(spark, data):
    scan = plan(query("tpch.q6").answer(Catalog(spark, data, "tpch")))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_shipdate:timestamp" in scan
    assert "PushedFilters: [IsNotNull" in scan
    ranked = plan(query("tpcds.q67").run(spark, data))
    assert "WindowGroupLimit" in ranked
    for key in ("tpch.q11", "tpcds.q14a", "tpcds.q77", "tpcds.q41", "tpcds.q10"):
        text = plan(query(key).run(spark, data))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, key


def test_plans_show_whole_filters(spark, tmp_path):
    """Filters beyond Spark's 100 letters, as those of written.impala.q7 once column numbers have six digits."""
    day = "day_" * 15
    spark.range(4).withColumn(day, F.col("id")).write.partitionBy(day).parquet(f"{tmp_path}/days")
    shown = plan(spark.read.parquet(f"{tmp_path}/days").where(f"{day} >= 1 AND {day} <= 2"))
    assert re.search(rf"PartitionFilters: \[isnotnull\({day}#\d+\), \({day}#\d+ >= 1\), \({day}#\d+ <= 2\)\]", shown)
