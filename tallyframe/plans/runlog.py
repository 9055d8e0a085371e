"""Run-log reports over the log derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import runlog as L
from tallyframe.plans.registry import Book

BOOK = Book()


def _add(key, build, out, sql=None, **rest):
    BOOK.add(f"log.{key}", build, out, sql, suite="misc", **rest)


def _runs(t):
    return L.from_timings(t.timings)


_PHASES = ["parsing", "analysis", "optimization", "planning", "execution"]
_add("flatten", lambda t, p: L.flatten(_runs(t), "timestamp", "iteration"), "timestamp:l iteration:i name:s result:l " + " ".join(f"{c}Time:d" for c in _PHASES),
     "SELECT run_ms AS timestamp, iteration, name, seq AS result, " + ", ".join(f"{c} AS {c}Time" for c in _PHASES) + " FROM timings")
_add("summary", lambda t, p: L.summary(L.flatten(_runs(t))), "name:s minTimeMs:d maxTimeMs:d avgTimeMs:d3 stdDev:d3 stdDevPercent:d3", """
SELECT name, min(execution) AS minTimeMs, max(execution) AS maxTimeMs, avg(execution) AS avgTimeMs, stddev_samp(execution) AS stdDev, stddev_samp(execution) / avg(execution) * 100 AS stdDevPercent
FROM timings GROUP BY name""", order="name")
_FIRST = 1704067200000
_add("baseline_compare", lambda t, p: L.baseline_compare(_runs(t), p.baseline, p.current), "name:s baselineTimeMs:d3 thisRunTimeMs:d3 stddev:d3 percentChange:d3", """
SELECT name, avg(execution) FILTER (WHERE run_ms = {baseline}) AS baselineTimeMs, avg(execution) FILTER (WHERE run_ms = {current}) AS thisRunTimeMs, stddev_samp(execution) FILTER (WHERE run_ms = {baseline}) AS stddev,
       (baselineTimeMs - thisRunTimeMs) / baselineTimeMs * 100 AS percentChange
FROM timings GROUP BY name HAVING thisRunTimeMs IS NOT NULL""", params={"baseline": _FIRST, "current": _FIRST + 3600000})
_add("runtime_no_parse", lambda t, p: L.flatten(_runs(t)).select("result", L.runtime_no_parse().alias("runtime")), "result:l runtime:d", "SELECT seq AS result, analysis + optimization + planning + execution AS runtime FROM timings")
_add("runtime_full", lambda t, p: L.flatten(_runs(t)).select("result", L.short_name().alias("short_name"), L.runtime_full().alias("runtime")), "result:l short_name:s runtime:d",
     "SELECT seq AS result, substr(name, 2) AS short_name, (parsing + analysis + optimization + planning + execution)::DOUBLE / 1000 AS runtime FROM timings")
_add("normalize_version", lambda t, p: t.timings.select(L.normalize_version(F.col("version")).alias("version")).groupBy("version").agg(F.count("*").alias("results")), "version:s results:l",
     "SELECT replace(version, '-SNAPSHOT', '') AS version, count(*) AS results FROM timings GROUP BY 1")
_RECENT_SQL = """
recent AS (SELECT *, replace(version, '-SNAPSHOT', '') AS sparkVersion, -dense_rank() OVER (PARTITION BY replace(version, '-SNAPSHOT', '') ORDER BY run_ms DESC) AS runId
           FROM timings WHERE run_type = 'daily' AND database = {database} QUALIFY runId >= -10),
smoothed AS (SELECT runId, sparkVersion, database, name AS queryName, median((analysis + optimization + planning + execution) // 1000) AS medianRuntimeSeconds FROM recent WHERE iteration <> 1 GROUP BY ALL)
"""
_DB = {"database": "tpcds1500"}


def _recent(t, p):
    return L.recent_runs(_runs(t), database=p.database)


def _smoothed(t, p):
    return L.smoothed_median(L.base_data(_recent(t, p)))


_add("recent_runs", _recent, "timestamp:l iteration:i sparkVersion:s startTime:s runId:i", "WITH " + _RECENT_SQL.strip() + """
SELECT DISTINCT run_ms AS timestamp, iteration, sparkVersion, strftime(make_timestamp(run_ms * 1000), '%Y-%m-%d %H:%M:%S') AS startTime, runId FROM recent""", params=_DB)
_add("base_data", lambda t, p: L.base_data(_recent(t, p)).withColumn("seq", F.col("result.result")), "seq:l runId:i day:s runtimeSeconds:d queryName:s", "WITH " + _RECENT_SQL.strip() + """
SELECT seq, runId, month(make_timestamp(run_ms * 1000)) || '-' || day(make_timestamp(run_ms * 1000)) AS day, (analysis + optimization + planning + execution)::DOUBLE / 1000 AS runtimeSeconds, name AS queryName FROM recent""", params=_DB)
_add("smoothed_median", _smoothed, "runId:i sparkVersion:s database:s queryName:s medianRuntimeSeconds:d", "WITH " + _RECENT_SQL.strip() + "\nSELECT * FROM smoothed", params=_DB, order="runId, sparkVersion")
_add("total_runtime", lambda t, p: L.total_runtime(_smoothed(t, p)), "runId:i sparkVersion:s totalRunTime:d", "WITH " + _RECENT_SQL.strip() + "\nSELECT runId, sparkVersion, sum(medianRuntimeSeconds) AS totalRunTime FROM smoothed GROUP BY ALL", params=_DB)
_add("geomean", lambda t, p: L.geomean_runtime(_smoothed(t, p).where("medianRuntimeSeconds > 0")), "runId:i sparkVersion:s score:d6", "WITH " + _RECENT_SQL.strip() + "\nSELECT runId, sparkVersion, geomean(medianRuntimeSeconds) AS score FROM smoothed WHERE medianRuntimeSeconds > 0 GROUP BY ALL", params=_DB)
_add("version_matrix", lambda t, p: L.version_matrix(L.total_runtime(_smoothed(t, p)), "totalRunTime"), "sparkVersion:s slot:i value:d", "WITH " + _RECENT_SQL.strip() + """,
totals AS (SELECT sparkVersion, 10 - row_number() OVER (PARTITION BY sparkVersion ORDER BY runId DESC) AS slot, sum(medianRuntimeSeconds) AS v FROM smoothed GROUP BY sparkVersion, runId)
SELECT vs.sparkVersion, s.slot, ifnull(v, 0) AS value FROM (SELECT DISTINCT sparkVersion FROM smoothed) vs CROSS JOIN (SELECT unnest(range(10)) AS slot) s LEFT JOIN totals ON totals.sparkVersion = vs.sparkVersion AND totals.slot = s.slot""", params=_DB)
_add("first_plan", lambda t, p: L.first_plan(L.base_data(_recent(t, p)), p.name), "sparkVersion:s plan:s", "WITH " + _RECENT_SQL.strip() + "\nSELECT sparkVersion, 'plan of ' || arg_min(seq, (run_ms, iteration, seq)) AS plan FROM recent WHERE name = {name} GROUP BY 1", params={**_DB, "name": "purchase"})
_add("failures", lambda t, p: L.failures(L.flatten(_runs(t))), "name:s className:s message:s", "SELECT name, 'TimeoutException' AS className, 'event ' || seq AS message FROM timings WHERE failed")
_add("ml_metrics", lambda t, p: L.ml_metrics(L.flatten(_runs(t))).withColumn("seed", F.col("parameters")["seed"]), "name:s seed:s metricName:s metricValue:d isLargerBetter:b",
     "SELECT name, seed, m AS metricName, CASE m WHEN 'train.score' THEN planning::DOUBLE / 100 ELSE execution::DOUBLE / 1000 END AS metricValue, m = 'train.score' AS isLargerBetter FROM timings, unnest(['train.score', 'train.time']) AS u(m)")
_add("breakdown_delta", lambda t, p: L.breakdown_delta(L.flatten(_runs(t)), "result"), "result:l nodeName:s index:i executionTime:d delta:d", """
SELECT seq AS result, nodeName, i AS "index", t AS executionTime, d AS delta
FROM (SELECT seq, execution AS e FROM timings), LATERAL (VALUES ('Aggregate', 0, e + 30, e + 30 - e // 2 - e // 4), ('Scan left', 1, e // 2, e // 2), ('Join', 2, e // 4, e // 4 - e // 8), ('Scan right', 3, e // 8, e // 8)) AS n(nodeName, i, t, d)""")


def _samples(t):
    return t.samples.select(F.array("caller", "callee").alias("stack"), F.struct(F.col("host").alias("hostName")).alias("tags"))


_add("stack_counts", lambda t, p: L.stack_counts(_samples(t)).withColumn("stack", F.array_join("stack", ";")), "stack:s samples:l", "SELECT caller || ';' || callee AS stack, count(*) AS samples FROM samples GROUP BY 1")
_add("stack_hosts", lambda t, p: L.stack_hosts(_samples(t)), "hostName:s", "SELECT DISTINCT host AS hostName FROM samples")
_add("stack_parse", lambda t, p: L.stack_parse(_samples(t)).select(F.explode("stack").alias("e")).groupBy(*[F.col(f"e.{c}").alias(c) for c in ("class", "method", "file", "line")]).agg(F.count("*").alias("samples")),
     "class:s method:s file:s line:i samples:l", """
SELECT 'org.engine.Runner' AS "class", 'run' AS "method", 'Runner.scala' AS "file", regexp_extract(caller, ':(\\d+)', 1)::INT AS line, count(*) AS samples FROM samples GROUP BY 4
UNION ALL SELECT 'org.engine.tasks.Task' || split_part(callee, '(', 2)[:-8], 'call', split_part(callee, '(', 2)[:-2], 0, count(*) FROM samples GROUP BY callee""")
_add("throughput", lambda t, p: L.mean_throughput(L.throughput(t.timings.select("name", F.col("execution").alias("time")), t.object_sizes)), "name:s throughput:d1", """
SELECT name, avg(round(bytes * 1000000.0::DOUBLE / execution, 2)) AS throughput FROM timings LEFT JOIN object_sizes USING (name) GROUP BY name""")
