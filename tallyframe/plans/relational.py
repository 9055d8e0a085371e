"""The relational building blocks, each asked once of the order-processing or retail tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import relational as R
from tallyframe.plans.registry import Book

BOOK = Book()


def _add(key, build, out, sql, suite="tpch", **rest):
    BOOK.add(f"rel.{key}", build, out, sql, suite=suite, **rest)


_add("star_join", lambda t, p: R.star_join(t.lineitem, [(t.part.where("p_size < 20"), "l_partkey = p_partkey"), (t.supplier, "l_suppkey = s_suppkey"), (t.nation, "s_nationkey = n_nationkey")], ["n_name", "p_brand"], [F.sum("l_quantity").alias("quantity")]),
     "n_name:s p_brand:s quantity:d", "SELECT n_name, p_brand, sum(l_quantity) AS quantity FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE p_size < 20 GROUP BY ALL")
_add("semi", lambda t, p: R.semi_join(t.customer, t.orders, "c_custkey = o_custkey").select("c_custkey"), "c_custkey:l", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
_add("anti", lambda t, p: R.anti_join(t.customer, t.orders, "c_custkey = o_custkey").select("c_custkey"), "c_custkey:l", "SELECT c_custkey FROM customer WHERE NOT EXISTS (FROM orders WHERE o_custkey = c_custkey)")
_add("exists_or", lambda t, p: R.exists_any(t.supplier, [t.lineitem.where("l_returnflag = 'R' and l_quantity > 49").select("l_suppkey"), t.partsupp.where("ps_availqty > 9990").select(F.col("ps_suppkey").alias("l_suppkey"))], "s_suppkey = l_suppkey"),
     "s_suppkey:l", "SELECT s_suppkey FROM supplier WHERE EXISTS (FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'R' AND l_quantity > 49) OR EXISTS (FROM partsupp WHERE ps_suppkey = s_suppkey AND ps_availqty > 9990)")
_add("not_in", lambda t, p: R.not_in(t.partsupp, "ps_suppkey", t.supplier.where("s_acctbal < 1000"), "s_suppkey").select("ps_partkey", "ps_suppkey"), "ps_partkey:l ps_suppkey:l", "SELECT ps_partkey, ps_suppkey FROM partsupp WHERE ps_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 1000)")
_add("corr_scalar", lambda t, p: R.versus_group(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), "l_partkey", F.try_divide(F.sum("l_quantity").cast("double"), F.count("l_quantity")), "usual", "l_quantity > 1.8 * usual"),
     "l_orderkey:l l_linenumber:i l_quantity:d", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem QUALIFY l_quantity > 1.8::DOUBLE * (sum(l_quantity) OVER (PARTITION BY l_partkey)::DOUBLE / count(*) OVER (PARTITION BY l_partkey))")
_add("uncorr_scalar", lambda t, p: R.versus_all(t.customer.select("c_custkey", "c_acctbal"), F.try_divide(F.sum("c_acctbal").cast("double"), F.count("c_acctbal")), "usual", "c_acctbal > 1.9 * usual"),
     "c_custkey:l c_acctbal:d", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 1.9::DOUBLE * (SELECT sum(c_acctbal)::DOUBLE / count(*) FROM customer)")
_add("rollup_grouping", lambda t, p: R.rollup_ranked(t.lineitem, "l_returnflag", "l_shipmode", F.sum("l_extendedprice"), "price"), "l_returnflag:s l_shipmode:s price:d level:i place:l", """
SELECT *, rank() OVER (PARTITION BY level, CASE WHEN level = 0 THEN l_returnflag END ORDER BY price DESC) AS place
FROM (SELECT l_returnflag, l_shipmode, sum(l_extendedprice) AS price, grouping(l_returnflag) + grouping(l_shipmode) AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_shipmode))""")
_add("ratio_to_group", lambda t, p: R.share_of_group(t.part, ["p_container", "p_brand"], "p_brand", "p_retailprice"), "p_container:s p_brand:s amount:d share:d",
     "SELECT p_container, p_brand, sum(p_retailprice) AS amount, sum(p_retailprice)::DOUBLE * 100 / sum(sum(p_retailprice)) OVER (PARTITION BY p_brand)::DOUBLE AS share FROM part GROUP BY p_container, p_brand")
_add("running", lambda t, p: R.running(t.orders.groupBy("o_custkey", "o_orderdate").agg(F.sum("o_totalprice").alias("price")), ["o_custkey"], "o_orderdate", "price"), "o_custkey:l o_orderdate:s price:d running_sum:d running_max:d",
     "SELECT *, sum(price) OVER w AS running_sum, max(price) OVER w AS running_max FROM (SELECT o_custkey, o_orderdate, sum(o_totalprice) AS price FROM orders GROUP BY ALL) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate ROWS UNBOUNDED PRECEDING)")
_add("top_n_per_group", lambda t, p: R.top_n_per_group(t.part.select("p_partkey", "p_brand", "p_size"), ["p_brand"], "p_size", 3), "p_partkey:l p_brand:s p_size:i place:l",
     "SELECT p_partkey, p_brand, p_size, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS place FROM part QUALIFY place <= 3")
_add("pivot_cond", lambda t, p: R.pivot_sums(t.lineitem, ["l_shipmode"], "l_returnflag", "l_quantity", {"A": "a", "N": "n", "R": "r"}), "l_shipmode:s a:d n:d r:d", "SELECT l_shipmode, " + ", ".join(f"sum(l_quantity) FILTER (WHERE l_returnflag = '{f}') AS {f.lower()}" for f in "ANR") + " FROM lineitem GROUP BY 1")
_add("latency_buckets", lambda t, p: R.latency_buckets(t.lineitem.select("l_shipmode", F.datediff("l_receiptdate", "l_shipdate").alias("delay")), ["l_shipmode"], "delay", [5, 10, 20]), "l_shipmode:s band_0:l band_1:l band_2:l band_3:l",
     "SELECT l_shipmode, " + ", ".join(f"count(*) FILTER (WHERE {w}) AS band_{i}" for i, w in enumerate(["d <= 5", "d BETWEEN 6 AND 10", "d BETWEEN 11 AND 20", "d >= 21"])) + " FROM (SELECT l_shipmode, l_receiptdate - l_shipdate AS d FROM lineitem) GROUP BY 1")
_add("channel_union", lambda t, p: R.tagged_union({"store": t.store_sales.select(F.col("ss_item_sk").alias("item")), "catalog": t.catalog_sales.select(F.col("cs_item_sk").alias("item")), "web": t.web_sales.select(F.col("ws_item_sk").alias("item"))}).groupBy("channel", "item").agg(F.count("*").alias("sales")),
     "channel:s item:i sales:l", "SELECT 'store' AS channel, ss_item_sk AS item, count(*) AS sales FROM store_sales GROUP BY 2 UNION ALL SELECT 'catalog', cs_item_sk, count(*) FROM catalog_sales GROUP BY 2 UNION ALL SELECT 'web', ws_item_sk, count(*) FROM web_sales GROUP BY 2", suite="tpcds")
_add("year_over_year", lambda t, p: R.year_over_year(t.orders.withColumn("year", F.year("o_orderdate")), ["o_custkey"], "year", "o_totalprice"), "o_custkey:l year:i amount:d amount_before:d",
     "SELECT * FROM (SELECT o_custkey, y AS year, v AS amount, CASE WHEN lag(y) OVER w = y - 1 THEN lag(v) OVER w END AS amount_before FROM (SELECT o_custkey, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders GROUP BY ALL) WINDOW w AS (PARTITION BY o_custkey ORDER BY y)) WHERE amount_before IS NOT NULL")


def _people(t):
    return [t.store_sales.select(F.col("ss_customer_sk").alias("who")), t.catalog_sales.select(F.col("cs_ship_customer_sk").alias("who")), t.web_sales.select(F.col("ws_bill_customer_sk").alias("who"))]


_WHO = "SELECT ss_customer_sk AS who FROM store_sales {0} SELECT cs_ship_customer_sk FROM catalog_sales {0} SELECT ws_bill_customer_sk FROM web_sales"
_add("in_all_sets", lambda t, p: R.in_all_sets(_people(t)), "who:i", _WHO.format("INTERSECT"), suite="tpcds")


def _people_items(t):
    return [df.select(F.expr(who).alias("who"), F.expr(item).alias("item")) for df, who, item in (
        (t.store_sales, "ss_customer_sk", "ss_item_sk"), (t.catalog_sales, "cs_ship_customer_sk", "cs_item_sk"), (t.web_sales, "ws_bill_customer_sk", "ws_item_sk"))]


_add("only_in_first", lambda t, p: R.only_in_first(_people_items(t)), "who:i item:i",
     "SELECT ss_customer_sk AS who, ss_item_sk AS item FROM store_sales EXCEPT SELECT cs_ship_customer_sk, cs_item_sk FROM catalog_sales EXCEPT SELECT ws_bill_customer_sk, ws_item_sk FROM web_sales", suite="tpcds")
_add("overlap_outer", lambda t, p: R.overlap(t.store_sales.select(F.col("ss_customer_sk").alias("who"), F.col("ss_item_sk").alias("item")), t.web_sales.select(F.col("ws_bill_customer_sk").alias("who"), F.col("ws_item_sk").alias("item")), ["who", "item"]),
     "left_only:l right_only:l both:l", """
WITH a AS (SELECT DISTINCT ss_customer_sk AS who, ss_item_sk AS item FROM store_sales), b AS (SELECT DISTINCT ws_bill_customer_sk AS who, ws_item_sk AS item FROM web_sales),
m AS (SELECT count(*) AS n FROM a JOIN b ON a.who = b.who AND a.item = b.item)
SELECT (SELECT count(*) FROM a) - n AS left_only, (SELECT count(*) FROM b) - n AS right_only, n AS both FROM m""", suite="tpcds")
_add("cov", lambda t, p: R.variation(t.inventory, ["inv_warehouse_sk", "inv_item_sk"], "inv_quantity_on_hand"), "inv_warehouse_sk:i inv_item_sk:i n:l mean:d4 deviation:d4 cov:d4",
     "SELECT inv_warehouse_sk, inv_item_sk, count(*) AS n, avg(inv_quantity_on_hand) AS mean, stddev_samp(inv_quantity_on_hand) AS deviation, stddev_samp(inv_quantity_on_hand) / nullif(avg(inv_quantity_on_hand), 0) AS cov FROM inventory GROUP BY 1, 2", suite="tpcds")
_add("deviation_filter", lambda t, p: R.deviating(t.orders.withColumn("month", F.month("o_orderdate")), ["month"], ["o_orderpriority"], "o_totalprice", 0.02), "o_orderpriority:s month:i amount:d usual:d",
     "SELECT o_orderpriority, month(o_orderdate) AS month, sum(o_totalprice) AS amount, sum(sum(o_totalprice)) OVER w::DOUBLE / count(*) OVER w AS usual FROM orders GROUP BY o_orderpriority, month(o_orderdate) WINDOW w AS (PARTITION BY o_orderpriority) QUALIFY abs((amount::DOUBLE - usual) / usual) > 0.02::DOUBLE")
_add("one_row_board", lambda t, p: R.one_row_board(t.lineitem, {f"q{i}": (f"band {i}", F.count(F.when(F.col("l_quantity").between(10 * i + 1, 10 * i + 10), 1))) for i in range(5)}), " ".join(f"q{i}:l" for i in range(5)),
     "SELECT " + ", ".join(f"(SELECT count(*) FROM lineitem WHERE l_quantity > {10 * i} AND l_quantity <= {10 * i + 10}) AS q{i}" for i in range(5)))
_PROFILED = [*(f"ss_{c}_sk" for c in ("sold_date", "sold_time", "item", "customer", "cdemo", "hdemo", "addr", "store", "promo")), "ss_ticket_number", "ss_quantity",
             *(f"ss_{c}" for c in ("wholesale_cost", "list_price", "sales_price", "ext_discount_amt", "ext_sales_price", "ext_wholesale_cost", "ext_list_price", "ext_tax", "coupon_amt", "net_paid", "net_paid_inc_tax", "net_profit"))]
_add("column_profile", lambda t, p: R.column_profile(t.store_sales, _PROFILED), "column:s rows:l filled:l distinct_values:l longest:i",
     " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS rows, count({c}) AS filled, count(DISTINCT {c}) AS distinct_values, max(length({c}::VARCHAR)) AS longest FROM store_sales" for c in _PROFILED), suite="tpcds")
_AUDITED = {"store": ("store_sales", ["ss_store_sk", "ss_addr_sk"]), "web": ("web_sales", ["ws_ship_customer_sk", "ws_promo_sk"]), "catalog": ("catalog_sales", ["cs_ship_addr_sk", "cs_call_center_sk"])}
_add("null_key_audit", lambda t, p: R.null_key_audit({n: (t.table(f), k) for n, (f, k) in _AUDITED.items()}), "table:s key:s gaps:l",
     " UNION ALL ".join(f"SELECT '{n}' AS \"table\", '{k}' AS \"key\", count(*) - count({k}) AS gaps FROM {f}" for n, (f, ks) in _AUDITED.items() for k in ks), suite="tpcds")
_add("segments", lambda t, p: R.segments(t.orders, "o_totalprice", 50000), "segment:i rows:l base:i", "SELECT trunc(o_totalprice::DOUBLE / 50000)::INT AS segment, count(*) AS rows, segment * 50000 AS base FROM orders GROUP BY 1")
