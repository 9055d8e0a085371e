import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyframe.functions import apply as A
from tallyframe.operators import generators as S
from tallyframe.operators import runlog as L


@pytest.mark.parametrize("kind,value", [("int", 3), ("double", 1.5), ("boolean", True), ("string", "x" * 1000)])
def test_list_apply(spark, kind, value):
    found = A.list_apply(spark, [value] * 50, kind, lambda v: v, kind, slices=3).collect()
    assert [r.value for r in found] == [value] * 50


@pytest.mark.parametrize("width", [1, 10, 100])
def test_partition_apply(spark, width):
    df = spark.range(100).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(width)])
    schema = ", ".join(f"c{i} long" for i in range(width))
    assert A.partition_apply(df, lambda batch: batch + 1, schema).agg(F.sum("c0")).first()[0] == sum(range(1, 101))
    assert len(A.partition_apply_collect(df, lambda batch: batch, schema)) == 100


def test_group_apply(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("int").alias("key"), F.col("id").cast("double").alias("val"))
    mean = lambda rows: pd.DataFrame({"key": [rows["key"].iloc[0]], "mean": [rows["val"].mean()]})
    expected = {r.key: r.m for r in df.groupBy("key").agg(F.avg("val").alias("m")).collect()}
    assert {r.key: r.mean for r in A.group_apply(df, ["key"], mean, "key int, mean double").collect()} == expected
    assert len(A.group_apply_collect(df, ["key"], mean, "key int, mean double")) == 10


def test_merged_groups_with_a_hot_and_a_null_key(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, (F.col("id") % 1000).cast("string")).alias("key"), F.col("id").alias("v"))

    def fold(rows, column):
        return rows.groupby("key", as_index=False, dropna=False).agg(total=(column, "sum"))

    found = A.group_apply_merged(df, ["key"], lambda rows: fold(rows, "v"), "key string, total long", lambda rows, last: fold(rows, "total"), "key string, total long", most_rows=50)
    assert sorted(map(str, found.collect())) == sorted(map(str, df.groupBy("key").agg(F.sum("v").alias("total")).collect()))


def test_aggregate_twins(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 8.0), ("b", 5.0)], "k string, v double")
    assert {r.k: (round(r.g, 9), r.m) for r in df.groupBy("k").agg(A.geometric_mean_udaf()("v").alias("g"), A.average_udaf()("v").alias("m")).collect()} == {"a": (4.0, 5.0), "b": (5.0, 5.0)}
    assert {r.k: round(r.g, 9) for r in df.groupBy("k").agg(L.geometric_mean(F.col("v")).alias("g")).collect()} == {"a": 4.0, "b": 5.0}


def test_vector_slices(spark):
    rows = S.continuous(spark.range(3), 7)
    parts = rows.select(vector_to_array("features").alias("whole"), *[vector_to_array(c).alias(f"p{i}") for i, c in enumerate(A.vector_slices("features", 7, 3))]).collect()
    assert all(r.whole == r.p0 + r.p1 + r.p2 for r in parts)
    with pytest.raises(ValueError):
        A.vector_slices("features", 2, 3)


def run(timestamp, iteration, results, version="3.0.0-SNAPSHOT"):
    filled = [{**{f"{p}Time": 0.0 for p in ("parsing", "analysis", "optimization", "planning")}, **r} for r in results]
    return {"timestamp": timestamp, "iteration": iteration, "tags": {"runtype": "daily", "database": "d"}, "configuration": {"sparkVersion": version}, "results": filled}


def test_baseline_lacks_a_query_and_one_failed(spark):
    log = spark.createDataFrame([
        run(1, 1, [{"name": "a", "executionTime": 10.0}, {"name": "gone", "executionTime": 5.0}]),
        run(2, 1, [{"name": "a", "executionTime": 15.0}, {"name": "new", "executionTime": 7.0}, {"name": "bad", "failure": {"className": "E", "message": "m"}}])], L.RUN)
    found = {r.name: (r.baselineTimeMs, r.thisRunTimeMs, r.percentChange) for r in L.baseline_compare(log, 1, 2).collect()}
    assert found == {"a": (10.0, 15.0, -50.0), "new": (None, 7.0, None)}
    assert [tuple(r) for r in L.failures(L.flatten(log)).select("name", "className").collect()] == [("bad", "E")]


def test_recent_runs_and_matrix(spark):
    log = spark.createDataFrame([run(t * 1000, i, [{"name": "q", "executionTime": 1000.0 * t}]) for t in range(1, 13) for i in (1, 2, 3)], L.RUN)
    recent = L.recent_runs(log)
    assert {r.runId for r in recent.collect()} == set(range(-10, 0)) and recent.first().sparkVersion == "3.0.0"
    totals = L.total_runtime(L.smoothed_median(L.base_data(recent.where("timestamp > 9000"))))
    matrix = [r.value for r in L.version_matrix(totals, "totalRunTime").orderBy("slot").collect()]
    assert matrix == [0.0] * 7 + [10.0, 11.0, 12.0]


def test_stack_lines(spark):
    samples = spark.createDataFrame([(["a.b.C.run(C.scala:12)", "x.Y.call(Y.scala)", "n.N.go(Native Method)"],)], "stack array<string>")
    assert [tuple(e) for e in L.stack_parse(samples).first().stack] == [("a.b.C", "run", "C.scala", 12), ("x.Y", "call", "Y.scala", 0), ("n.N", "go", "Native Method", 0)]


def test_benchmark_id_ignores_map_order(spark):
    ids = spark.sql("select map('a', '1', 'b', '2') m union all select map('b', '2', 'a', '1')").select(L.benchmark_id(F.lit("x"), F.col("m")).alias("i")).distinct()
    assert ids.count() == 1
