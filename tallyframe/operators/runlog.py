"""Reports over a log of timed runs: nested runs in, flat tables out.

A run has ``timestamp`` (ms), ``iteration``, ``tags`` (map), ``configuration`` (struct) and ``results`` (array of structs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRIC = T.StructType([T.StructField("metricName", T.StringType()), T.StructField("metricValue", T.DoubleType()), T.StructField("isLargerBetter", T.BooleanType())])
BREAKDOWN = T.StructType([T.StructField("nodeName", T.StringType()), T.StructField("nodeNameWithArgs", T.StringType()), T.StructField("index", T.IntegerType()),
                          T.StructField("children", T.ArrayType(T.IntegerType())), T.StructField("executionTime", T.DoubleType()), T.StructField("delta", T.DoubleType())])
FAILURE = T.StructType([T.StructField("className", T.StringType()), T.StructField("message", T.StringType())])
TEXT_MAP = T.MapType(T.StringType(), T.StringType())
RESULT = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("mode", T.StringType()), T.StructField("parameters", TEXT_MAP),
    T.StructField("joinTypes", T.ArrayType(T.StringType())), T.StructField("tables", T.ArrayType(T.StringType())),
    *[T.StructField(f"{p}Time", T.DoubleType()) for p in ("parsing", "analysis", "optimization", "planning", "execution")],
    T.StructField("result", T.LongType()), T.StructField("breakDown", T.ArrayType(BREAKDOWN)), T.StructField("queryExecution", T.StringType()),
    T.StructField("failure", FAILURE), T.StructField("mlResult", T.ArrayType(METRIC)), T.StructField("benchmarkId", T.StringType())])
CONFIGURATION = T.StructType([T.StructField("sparkVersion", T.StringType()), T.StructField("sqlConf", TEXT_MAP), T.StructField("sparkConf", TEXT_MAP),
                              T.StructField("defaultParallelism", T.IntegerType()), T.StructField("buildInfo", TEXT_MAP)])
RUN = T.StructType([T.StructField("timestamp", T.LongType()), T.StructField("iteration", T.IntegerType()), T.StructField("tags", TEXT_MAP),
                    T.StructField("configuration", CONFIGURATION), T.StructField("results", T.ArrayType(RESULT))])


def from_timings(timings: DataFrame) -> DataFrame:
    """Flat timing rows as nested runs. An iteration holds a fixed number of results, so the collected lists are bounded."""
    nodes = F.array(
        _node("Aggregate", 0, [1, 2], F.col("execution") + 30), _node("Scan left", 1, [], F.floor(F.col("execution") / 2)), _node("Join", 2, [3], F.floor(F.col("execution") / 4)),
        _node("Scan right", 3, [], F.floor(F.col("execution") / 8)))
    result = F.struct(
        F.col("name"), F.lit("collect").alias("mode"), F.create_map(F.lit("seed"), F.col("seed").cast("string")).alias("parameters"),
        F.array(F.lit("BroadcastHashJoin")).alias("joinTypes"), F.array(F.lit("events")).alias("tables"),
        *[F.col(p).cast("double").alias(f"{p}Time") for p in ("parsing", "analysis", "optimization", "planning", "execution")],
        F.col("seq").alias("result"), nodes.cast(T.ArrayType(BREAKDOWN)).alias("breakDown"), F.concat(F.lit("plan of "), F.col("seq").cast("string")).alias("queryExecution"),
        F.when(F.col("failed"), F.struct(F.lit("TimeoutException").alias("className"), F.concat(F.lit("event "), F.col("seq").cast("string")).alias("message"))).alias("failure"),
        F.array(_metric("train.score", F.col("planning") / 100, True), _metric("train.time", F.col("execution") / 1000, False)).alias("mlResult"),
        benchmark_id(F.col("name"), F.create_map(F.lit("seed"), F.col("seed").cast("string"))).alias("benchmarkId"))
    runs = timings.groupBy("run_ms", "iteration", "version", "run_type", "database").agg(F.collect_list(result).alias("results"))
    empty = F.create_map().cast(TEXT_MAP)
    return runs.select(
        F.col("run_ms").alias("timestamp"), "iteration", F.create_map(F.lit("runtype"), F.col("run_type"), F.lit("database"), F.col("database"), F.lit("jobname"), F.lit("daily")).alias("tags"),
        F.struct(F.col("version").alias("sparkVersion"), empty.alias("sqlConf"), empty.alias("sparkConf"), F.lit(8).alias("defaultParallelism"), empty.alias("buildInfo")).alias("configuration"), "results")


def _node(name: str, index: int, children: list[int], time: Column) -> Column:
    kids = F.array(*[F.lit(c) for c in children]).cast("array<int>")
    return F.struct(F.lit(name).alias("nodeName"), F.lit(name).alias("nodeNameWithArgs"), F.lit(index).alias("index"), kids.alias("children"), time.cast("double").alias("executionTime"), F.lit(None).cast("double").alias("delta"))


def _metric(name: str, value: Column, larger: bool) -> Column:
    return F.struct(F.lit(name).alias("metricName"), value.cast("double").alias("metricValue"), F.lit(larger).alias("isLargerBetter"))


def benchmark_id(name: Column, parameters: Column) -> Column:
    """Short name and a hash of the parameters; the order of the map's entries does not matter."""
    return F.concat_ws("_", name, F.xxhash64(F.array_sort(F.map_entries(parameters))).cast("string"))


def flatten(runs: DataFrame, *keep: str) -> DataFrame:
    """One row per result, result fields as columns."""
    return runs.select(*keep, F.explode("results").alias("result")).select(*keep, "result.*")


def runtime_no_parse(prefix: str = "") -> Column:
    """Analysis + optimization + planning + execution, in ms."""
    return sum((F.col(f"{prefix}{p}Time") for p in ("optimization", "planning", "execution")), F.col(f"{prefix}analysisTime"))


def runtime_full(prefix: str = "") -> Column:
    """All phases, parsing included, in seconds."""
    return (runtime_no_parse(prefix) + F.col(f"{prefix}parsingTime")) / 1000


def short_name(column: str = "name") -> Column:
    """The name from its second character on."""
    return F.substr(column, F.lit(2))


def normalize_version(version: Column) -> Column:
    return F.regexp_replace(version, "-SNAPSHOT$", "")


def geometric_mean(column: Column) -> Column:
    """exp(avg(log)): no product that could overflow."""
    return F.exp(F.avg(F.log(column)))


def summary(results: DataFrame) -> DataFrame:
    time = F.col("executionTime")
    return results.groupBy("name").agg(F.min(time).alias("minTimeMs"), F.max(time).alias("maxTimeMs"), F.avg(time).alias("avgTimeMs"), F.stddev(time).alias("stdDev"),
                                       (F.try_divide(F.stddev(time), F.avg(time)) * 100).alias("stdDevPercent"))


def baseline_compare(runs: DataFrame, baseline: int, current: int) -> DataFrame:
    """Average times of two runs per query; queries that the current run lacks are dropped."""
    results = flatten(runs.where(F.col("timestamp").isin(baseline, current)), "timestamp")
    before = F.when(F.col("timestamp") == baseline, F.col("executionTime"))
    now = F.when(F.col("timestamp") == current, F.col("executionTime"))
    return results.groupBy("name").agg(F.avg(before).alias("baselineTimeMs"), F.avg(now).alias("thisRunTimeMs"), F.stddev(before).alias("stddev")).withColumn(
        "percentChange", F.try_divide(F.col("baselineTimeMs") - F.col("thisRunTimeMs"), F.col("baselineTimeMs")) * 100).where("thisRunTimeMs is not null")


def recent_runs(runs: DataFrame, run_type: str = "daily", database: str | None = None, last: int = 10) -> DataFrame:
    """Runs of one type, numbered -1, -2, ... from the newest per version; the last ten timestamps of each version.

    Timestamps are ranked on their distinct values (few per version), then joined back: the wide runs are never sorted in one task.
    """
    chosen = runs.where(F.col("tags")["runtype"] == run_type)
    chosen = chosen if database is None else chosen.where(F.col("tags")["database"] == database)
    chosen = chosen.withColumn("sparkVersion", normalize_version(F.col("configuration.sparkVersion"))).withColumn("startTime", F.from_unixtime(F.col("timestamp") / 1000)).withColumn(
        "database", F.col("tags")["database"]).withColumn("jobname", F.col("tags")["jobname"])
    newest = W.partitionBy("sparkVersion").orderBy(F.desc("timestamp"))
    numbers = chosen.select("sparkVersion", "timestamp").distinct().withColumn("place", F.row_number().over(newest)).where(F.col("place") <= last)
    return chosen.join(numbers.withColumn("runId", -F.col("place")).drop("place"), ["sparkVersion", "timestamp"])


def base_data(recent: DataFrame) -> DataFrame:
    exploded = recent.withColumn("result", F.explode("results")).drop("results")
    return exploded.withColumn("day", F.concat_ws("-", F.month("startTime"), F.dayofmonth("startTime"))).withColumn("runtimeSeconds", runtime_no_parse("result.") / 1000).withColumn("queryName", F.col("result.name"))


def smoothed_median(base: DataFrame) -> DataFrame:
    """Median of whole seconds per run and query, without the warm-up iteration."""
    return base.where("iteration <> 1").groupBy("runId", "sparkVersion", "database", "queryName").agg(F.percentile(F.col("runtimeSeconds").cast("long"), 0.5).alias("medianRuntimeSeconds"))


def total_runtime(smoothed: DataFrame) -> DataFrame:
    return smoothed.groupBy("runId", "sparkVersion").agg(F.sum("medianRuntimeSeconds").alias("totalRunTime"))


def geomean_runtime(smoothed: DataFrame) -> DataFrame:
    return smoothed.groupBy("runId", "sparkVersion").agg(geometric_mean(F.col("medianRuntimeSeconds")).alias("score"))


def version_matrix(per_run: DataFrame, value: str, width: int = 10) -> DataFrame:
    """One row per version and slot: the values in run order at the right end, zeros before them."""
    slots = per_run.select("sparkVersion").distinct().select("sparkVersion", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("slot"))
    newest = W.partitionBy("sparkVersion").orderBy(F.desc("runId"))
    placed = per_run.withColumn("slot", F.lit(width) - F.row_number().over(newest)).select("sparkVersion", "slot", F.col(value).alias("value"))
    return slots.join(placed, ["sparkVersion", "slot"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))


def first_plan(base: DataFrame, name: str) -> DataFrame:
    """A recorded plan per version: the one of the earliest result, so that the answer is always the same."""
    order = F.struct("timestamp", "iteration", "result.result")
    return base.where(F.col("queryName") == name).groupBy("sparkVersion").agg(F.min_by("result.queryExecution", order).alias("plan"))


def failures(results: DataFrame) -> DataFrame:
    return results.where("failure is not null").select("name", "benchmarkId", "failure.*")


def ml_metrics(results: DataFrame) -> DataFrame:
    return results.select("name", "benchmarkId", "parameters", F.explode("mlResult").alias("metric")).select("name", "benchmarkId", "parameters", "metric.*")


def breakdown_delta(results: DataFrame, *keep: str) -> DataFrame:
    """Own time of each plan node: its time less that of its children, computed inside the row's array."""
    nodes = F.transform("breakDown", lambda node: F.struct(
        node["nodeName"].alias("nodeName"), node["index"].alias("index"), node["executionTime"].alias("executionTime"),
        (node["executionTime"] - F.aggregate(F.filter("breakDown", lambda other: F.array_contains(node["children"], other["index"])), F.lit(0.0), lambda total, child: total + child["executionTime"])).alias("delta")))
    return results.select(*keep, F.explode(nodes).alias("node")).select(*keep, "node.*")


def stack_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("stack").agg(F.count("*").alias("samples"))


def stack_hosts(samples: DataFrame) -> DataFrame:
    return samples.select(F.col("tags.hostName").alias("hostName")).distinct()


# Fixed value: the pattern of a stack line, "class.method(file:line)".
STACK_LINE = r"^(.*)\.([^\(]+)\(([^:]+?)(?::(\d+))?\)$"


def stack_parse(samples: DataFrame, column: str = "stack") -> DataFrame:
    """Each line as class, method, file and line number (0 when the line has none)."""
    def element(line):
        number = F.regexp_extract(line, STACK_LINE, 4)
        return F.struct(*[F.regexp_extract(line, STACK_LINE, i).alias(n) for i, n in ((1, "class"), (2, "method"), (3, "file"))], F.when(number == "", F.lit(0)).otherwise(number.try_cast("int")).alias("line"))

    return samples.withColumn(column, F.transform(column, element))


def throughput(timings: DataFrame, sizes: DataFrame) -> DataFrame:
    """Bytes per second per timing (time in microseconds); timings without a size stay, with NULL."""
    return timings.join(sizes, "name", "left").withColumn("throughput", F.round(F.try_divide(F.col("bytes") * F.lit(1000000.0), F.col("time").cast("double")), 2))


def mean_throughput(rows: DataFrame) -> DataFrame:
    return rows.groupBy("name").agg(F.avg("throughput").alias("throughput"))
