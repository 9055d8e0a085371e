"""Table input and output, checks and user functions, asked of the given tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyframe.functions import apply as A
from tallyframe.operators import checks as C
from tallyframe.operators import runlog as L
from tallyframe.plans.registry import Book
from tallyframe.sources import layout as S
from tallyframe.sources.stored import scratch

BOOK = Book()


def _add(key, build, out, sql=None, suite="tpch", **rest):
    BOOK.add(key, build, out, sql, suite=suite, **rest)


_ORDERS = "o_orderkey:l o_custkey:l o_orderstatus:s o_totalprice:d o_orderdate:s o_orderpriority:s o_clerk:s o_shippriority:i o_comment:s"
_ORDER_NAMES = ", ".join(c.split(":")[0] for c in _ORDERS.split())
_add("io.parse_delimited", lambda t, p: S.parse_delimited(S.to_delimited(t.orders), t.orders.schema), _ORDERS, f"SELECT {_ORDER_NAMES} FROM orders")


def raw_lines(t, p):
    folder = scratch(t.spark, "text") + "/lines"
    S.to_delimited(t.supplier).write.text(folder)
    return S.raw_text(t.spark, folder)


_add("io.raw_text", raw_lines, "value:s", "SELECT s_suppkey || '|' || s_name || '|' || s_address || '|' || s_nationkey || '|' || s_phone || '|' || s_acctbal || '|' || s_comment || '|' AS value FROM supplier")
_add("io.type_switch", lambda t, p: S.switch_types(t.orders, True, True), _ORDERS, f"SELECT {_ORDER_NAMES} FROM orders")


def written(t, p):
    """Write one table by partition, clustered, and read it back: one partition through partition pruning, and the others."""
    folder = scratch(t.spark, "table") + "/orders"
    S.write_table(t.orders, folder, partition_by=["o_orderpriority"], drop_null_partitions=True)
    back = t.spark.read.parquet(folder)
    return back.where(F.col("o_orderpriority") == "2-HIGH").unionByName(back.where(F.col("o_orderpriority") != "2-HIGH"))


_add("io.write_partitioned", written, _ORDERS, f"SELECT {_ORDER_NAMES} FROM orders")


def without_null_partitions(t, p):
    """Write a fact by a key that has gaps, the gaps left out, and count what is in each folder."""
    folder = scratch(t.spark, "no-nulls") + "/store_sales"
    S.write_table(t.store_sales, folder, partition_by=["ss_store_sk"], drop_null_partitions=True)
    return t.spark.read.parquet(folder).groupBy("ss_store_sk").agg(F.count("*").alias("rows"), F.sum("ss_net_paid").alias("paid"))


_add("io.drop_null_partitions", without_null_partitions, "ss_store_sk:i rows:l paid:d", "SELECT ss_store_sk, count(*) AS rows, sum(ss_net_paid) AS paid FROM store_sales WHERE ss_store_sk IS NOT NULL GROUP BY 1", suite="tpcds")
_STAT = _ORDER_NAMES.split(", ")
_add("io.analyze_columns", lambda t, p: S.column_statistics(t.orders), "column:s rows:l nulls:l lowest:s highest:s avg_length:d4 max_length:i",
     " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, min({c})::VARCHAR AS lowest, max({c})::VARCHAR AS highest, avg(length({c}::VARCHAR)) AS avg_length, max(length({c}::VARCHAR)) AS max_length FROM orders" for c in _STAT))


def runs_round_trip(t, p):
    folder = scratch(t.spark, "runs") + "/runs"
    S.write_runs(L.from_timings(t.timings), folder)
    return L.flatten(S.read_runs(t.spark, folder, L.RUN), "timestamp", "iteration")


_add("io.results_json", runs_round_trip, "timestamp:l iteration:i name:s executionTime:d result:l", "SELECT run_ms AS timestamp, iteration, name, execution AS executionTime, seq AS result FROM timings", suite="misc")


def sink(t, p):
    return t.spark.read.parquet(S.save_result(t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("rows")), scratch(t.spark, "sink"), "status"))


_add("io.parquet_sink", sink, "o_orderstatus:s rows:l", "SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY 1")

_add("chk.hash_result", lambda t, p: C.content_hash(t.orders), "content_hash:l")
_add("chk.hash_null_safe", lambda t, p: C.content_hash(t.store_sales, null_safe=True), "content_hash:l", suite="tpcds")
_add("chk.as_check", C.as_check(lambda t, p: t.orders.groupBy("o_orderstatus").count()), "content_hash:l")
_add("chk.force_all_columns", lambda t, p: C.force_all_columns(t.lineitem), "all_columns:s rows:l")


# --- user functions -------------------------------------------------------------------------------


def _lengths(batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"o_orderkey": batch["o_orderkey"], "twice": batch["o_orderkey"] * 2, "letters": batch["o_comment"].str.len().astype("int64"), "is_open": batch["o_orderstatus"] == "O"})


_add("udf.partition_apply", lambda t, p: A.partition_apply(t.orders.select("o_orderkey", "o_comment", "o_orderstatus"), _lengths, "o_orderkey long, twice long, letters long, is_open boolean"),
     "o_orderkey:l twice:l letters:l is_open:b", "SELECT o_orderkey, o_orderkey * 2 AS twice, length(o_comment) AS letters, o_orderstatus = 'O' AS is_open FROM orders")


def _partial_mean(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.groupby("key", as_index=False, dropna=False).agg(total=("val", "sum"), n=("val", "count"))


def _merged_mean(rows: pd.DataFrame, last: bool) -> pd.DataFrame:
    folded = rows.groupby("key", as_index=False, dropna=False).agg(total=("total", "sum"), n=("n", "sum"))
    return folded.assign(mean=folded["total"] / folded["n"])[["key", "mean"]] if last else folded


def group_means(t, p):
    """Mean of a value per key by a user function. A key may hold any share of the rows, so the function works in mergeable
    steps; ``group_apply`` runs one that needs its whole group at once."""
    key = F.col(p.key).cast("string") if p.width else F.col(p.key)
    lines = t.lineitem.select((F.lpad(key, p.width, "0") if p.width else key).alias("key"), F.col("l_quantity").cast("double").alias("val"))
    kind = p.kind
    return A.group_apply_merged(lines, ["key"], _partial_mean, f"key {kind}, total double, n long", _merged_mean, f"key {kind}, mean double")


_add("udf.group_apply", group_means, "key:l mean:d6", "SELECT l_suppkey AS \"key\", avg(l_quantity) AS mean FROM lineitem GROUP BY 1", params={"key": "l_suppkey", "width": 0, "kind": "long"})
_add("udf.group_apply_10", group_means, "key:s mean:d6", "SELECT lpad(l_suppkey::VARCHAR, 10, '0') AS \"key\", avg(l_quantity) AS mean FROM lineitem GROUP BY 1", params={"key": "l_suppkey", "width": 10, "kind": "string"})
_add("udf.group_apply_100", group_means, "key:s mean:d6", "SELECT lpad(l_suppkey::VARCHAR, 100, '0') AS \"key\", avg(l_quantity) AS mean FROM lineitem GROUP BY 1", params={"key": "l_suppkey", "width": 100, "kind": "string"})
_add("udf.group_apply_hot", group_means, "key:s mean:d6", "SELECT lpad(l_returnflag, 1, '0') AS \"key\", avg(l_quantity) AS mean FROM lineitem GROUP BY 1", params={"key": "l_returnflag", "width": 1, "kind": "string"})
_add("udf.geomean", lambda t, p: t.orders.groupBy("o_orderpriority").agg(L.geometric_mean(F.col("o_totalprice").cast("double")).alias("geomean")), "o_orderpriority:s geomean:d4", "SELECT o_orderpriority, geomean(o_totalprice::DOUBLE) AS geomean FROM orders GROUP BY 1")
_add("udf.scalar", lambda t, p: t.orders.select("o_orderkey", A.strip_suffix(F.col("o_comment"), " requests").alias("comment")), "o_orderkey:l comment:s", "SELECT o_orderkey, CASE WHEN ends_with(o_comment, ' requests') THEN left(o_comment, length(o_comment) - 9) ELSE o_comment END AS comment FROM orders")


def applied_to_list(t, p):
    """A function over every element of a distributed list, the orders' priorities by key."""
    return A.list_apply(t.spark, t.orders.select(F.col("o_orderkey").alias("position"), F.col("o_orderpriority").alias("value")), "string", lambda v: v[::-1], "string")


_add("udf.list_apply", applied_to_list, "position:l value:s", "SELECT o_orderkey AS position, reverse(o_orderpriority) AS value FROM orders")


def consumed(t, p):
    """Every line item consumed on the executors and none kept; what passed by is counted on the way."""
    seen = Observation()
    C.run_everywhere(t.lineitem.observe(seen, F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity")))
    return t.spark.createDataFrame([(seen.get["rows"], seen.get["quantity"])], "rows long, quantity decimal(38,2)")


_add("chk.foreach", consumed, "rows:l quantity:d", "SELECT count(*) AS rows, sum(l_quantity) AS quantity FROM lineitem")
