"""The 22 order-processing reports."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tallyframe.functions.verbs import anti, mean, on, one_row, ratio, semi, tally, total
from tallyframe.plans.registry import Book

BOOK = Book()
D = datetime.date

SALE = "l_extendedprice * (1 - l_discount)"


def _add(key, build, out, sql, **rest):
    BOOK.add(f"tpch.{key}", build, out, sql, suite="tpch", **rest)


def q1(t, p):
    return (t.lineitem.where(F.col("l_shipdate") <= p.until)
            .groupBy("l_returnflag", "l_linestatus")
            .agg(total("l_quantity", "sum_qty"), total("l_extendedprice", "sum_base_price"), total(SALE, "sum_disc_price"),
                 total(f"{SALE} * (1 + l_tax)", "sum_charge"), mean("l_quantity", "avg_qty"), mean("l_extendedprice", "avg_price"),
                 mean("l_discount", "avg_disc"), F.count("*").alias("count_order")))


_add("q1", q1, "l_returnflag:s l_linestatus:s sum_qty:d sum_base_price:d sum_disc_price:d sum_charge:d avg_qty:d avg_price:d avg_disc:d count_order:l", """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, sum(l_extendedprice) AS sum_base_price, sum(net) AS sum_disc_price,
       sum(net * (1 + l_tax)) AS sum_charge, sum(l_quantity)::DOUBLE / count(*) AS avg_qty, sum(l_extendedprice)::DOUBLE / count(*) AS avg_price,
       sum(l_discount)::DOUBLE / count(*) AS avg_disc, count(*) AS count_order
FROM (SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem WHERE l_shipdate <= {until})
GROUP BY ALL""", order="l_returnflag, l_linestatus", params={"until": D(1998, 9, 2)})


def _placed_suppliers(t, region):
    nations = semi(t.nation, t.region.where(F.col("r_name") == region), "n_regionkey = r_regionkey")
    return on(t.supplier, nations, "s_nationkey = n_nationkey")


def q2(t, p):
    parts = t.part.where((F.col("p_size") == p.size) & F.col("p_type").endswith(p.metal)).select("p_partkey", "p_mfgr")
    offers = on(on(t.partsupp, parts, "ps_partkey = p_partkey"), _placed_suppliers(t, p.region), "ps_suppkey = s_suppkey")
    cheapest = offers.groupBy(F.col("ps_partkey").alias("k")).agg(F.min("ps_supplycost").alias("low"))
    return on(offers, cheapest, "ps_partkey = k and ps_supplycost = low")


_add("q2", q2, "s_acctbal:d s_name:s n_name:s p_partkey:l p_mfgr:s s_address:s s_phone:s s_comment:s", """
SELECT s_acctbal, s_name, n_name, p_partkey, p_mfgr, s_address, s_phone, s_comment
FROM partsupp JOIN part ON ps_partkey = p_partkey AND p_size = {size} AND p_type LIKE '%' || {metal}
     JOIN supplier ON ps_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey AND r_name = {region}
QUALIFY ps_supplycost = min(ps_supplycost) OVER (PARTITION BY ps_partkey)""",
     order="s_acctbal desc, n_name, s_name, p_partkey", limit=100, params={"size": 15, "metal": "BRASS", "region": "EUROPE"})


def q3(t, p):
    orders = semi(t.orders.where(F.col("o_orderdate") < p.day), t.customer.where(F.col("c_mktsegment") == p.segment), "o_custkey = c_custkey")
    lines = t.lineitem.where(F.col("l_shipdate") > p.day)
    return on(lines, orders, "l_orderkey = o_orderkey").groupBy("l_orderkey", "o_orderdate", "o_shippriority").agg(total(SALE, "revenue"))


_add("q3", q3, "l_orderkey:l revenue:d o_orderdate:s o_shippriority:i", """
SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS revenue, o_orderdate, o_shippriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE l_shipdate > {day} AND o_orderdate < {day} AND c_mktsegment = {segment}
GROUP BY l_orderkey, o_orderdate, o_shippriority""", order="revenue desc, o_orderdate", limit=10,
     params={"segment": "BUILDING", "day": D(1995, 3, 15)}, tried={"segment": "MACHINERY", "day": D(1998, 3, 15)})


def q4(t, p):
    orders = t.orders.where((F.col("o_orderdate") >= p.day) & (F.col("o_orderdate") < F.add_months(F.lit(p.day), 3)))
    late = t.lineitem.where("l_commitdate < l_receiptdate").select("l_orderkey")
    return semi(orders, late, "l_orderkey = o_orderkey").groupBy("o_orderpriority").agg(F.count("*").alias("order_count"))


_add("q4", q4, "o_orderpriority:s order_count:l", """
SELECT o_orderpriority, count(*) AS order_count
FROM orders SEMI JOIN (SELECT l_orderkey FROM lineitem WHERE l_receiptdate > l_commitdate) late ON late.l_orderkey = o_orderkey
WHERE o_orderdate >= {day} AND o_orderdate < CAST({day} + INTERVAL 3 MONTH AS DATE)
GROUP BY o_orderpriority""", order="o_orderpriority", params={"day": D(1993, 7, 1)}, tried={"day": D(1997, 7, 1)})


def q5(t, p):
    orders = t.orders.where((F.col("o_orderdate") >= p.day) & (F.col("o_orderdate") < F.add_months(F.lit(p.day), 12)))
    bought = on(t.lineitem, on(orders, t.customer, "o_custkey = c_custkey"), "l_orderkey = o_orderkey")
    local = on(bought, _placed_suppliers(t, p.region), "l_suppkey = s_suppkey and c_nationkey = s_nationkey")
    return local.groupBy("n_name").agg(total(SALE, "revenue"))


_add("q5", q5, "n_name:s revenue:d", """
SELECT n_name, sum(l_extendedprice * (1 - l_discount)) AS revenue
FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey JOIN lineitem ON l_suppkey = s_suppkey
     JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey AND c_nationkey = s_nationkey
WHERE r_name = {region} AND o_orderdate >= {day} AND o_orderdate < CAST({day} + INTERVAL 1 YEAR AS DATE)
GROUP BY n_name""", order="revenue desc", params={"region": "ASIA", "day": D(1994, 1, 1)}, tried={"day": D(1997, 1, 1)})


def q6(t, p):
    lines = t.lineitem.where((F.col("l_shipdate") >= p.day) & (F.col("l_shipdate") < F.add_months(F.lit(p.day), 12)))
    return lines.where(f"l_discount between {p.discount} - 0.01 and {p.discount} + 0.01 and l_quantity < {p.quantity}").agg(
        total("l_extendedprice * l_discount", "revenue"))


_add("q6", q6, "revenue:d", """
SELECT sum(l_extendedprice * l_discount) AS revenue
FROM lineitem
WHERE date_trunc('day', l_shipdate) >= {day} AND l_shipdate < CAST({day} + INTERVAL 1 YEAR AS DATE)
  AND abs(l_discount - {discount}) <= 0.01 AND l_quantity < {quantity}""",
     params={"day": D(1994, 1, 1), "discount": 0.06, "quantity": 24}, tried={"day": D(1997, 1, 1)})


def q7(t, p):
    pair = F.col("n_name").isin(p.one, p.two)
    sellers = on(t.supplier, t.nation.where(pair), "s_nationkey = n_nationkey").select("s_suppkey", F.col("n_name").alias("supp_nation"))
    buyers = on(t.customer, t.nation.where(pair), "c_nationkey = n_nationkey").select("c_custkey", F.col("n_name").alias("cust_nation"))
    lines = t.lineitem.where(F.col("l_shipdate").between(p.since, p.until))
    shipped = on(on(lines, sellers, "l_suppkey = s_suppkey"), on(t.orders, buyers, "o_custkey = c_custkey"),
                 "l_orderkey = o_orderkey and supp_nation <> cust_nation")
    return shipped.groupBy("supp_nation", "cust_nation", F.year("l_shipdate").alias("l_year")).agg(total(SALE, "revenue"))


_add("q7", q7, "supp_nation:s cust_nation:s l_year:i revenue:d", """
SELECT sn.n_name AS supp_nation, cn.n_name AS cust_nation, year(l_shipdate) AS l_year, sum(l_extendedprice * (1 - l_discount)) AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
     JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
WHERE (sn.n_name, cn.n_name) IN (({one}, {two}), ({two}, {one})) AND l_shipdate BETWEEN {since} AND {until}
GROUP BY ALL""", order="supp_nation, cust_nation, l_year",
     params={"one": "FRANCE", "two": "GERMANY", "since": D(1995, 1, 1), "until": D(1996, 12, 31)}, tried={"one": "NATION_6", "two": "NATION_7"})


def q8(t, p):
    buyers = semi(t.customer, semi(t.nation, t.region.where(F.col("r_name") == p.region), "n_regionkey = r_regionkey"), "c_nationkey = n_nationkey")
    orders = semi(t.orders.where(F.col("o_orderdate").between(p.since, p.until)), buyers, "o_custkey = c_custkey")
    lines = semi(t.lineitem, t.part.where(F.col("p_type") == p.kind), "l_partkey = p_partkey")
    sold = on(on(on(lines, orders, "l_orderkey = o_orderkey"), t.supplier, "l_suppkey = s_suppkey"), t.nation, "s_nationkey = n_nationkey")
    own = F.sum(F.when(F.col("n_name") == p.nation, F.expr(SALE)).otherwise(0))
    return sold.groupBy(F.year("o_orderdate").alias("o_year")).agg(ratio(own, F.sum(F.expr(SALE))).alias("mkt_share"))


_add("q8", q8, "o_year:i mkt_share:d", """
SELECT year(o_orderdate) AS o_year,
       coalesce(sum(l_extendedprice * (1 - l_discount)) FILTER (WHERE seller.n_name = {nation}), 0)::DOUBLE / sum(l_extendedprice * (1 - l_discount))::DOUBLE AS mkt_share
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation buyer ON c_nationkey = buyer.n_nationkey
     JOIN region ON buyer.n_regionkey = r_regionkey AND r_name = {region}
     JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey AND p_type = {kind}
     JOIN supplier ON l_suppkey = s_suppkey JOIN nation seller ON s_nationkey = seller.n_nationkey
WHERE o_orderdate BETWEEN {since} AND {until}
GROUP BY 1""", order="o_year", params={"nation": "BRAZIL", "region": "AMERICA", "kind": "ECONOMY ANODIZED STEEL", "since": D(1995, 1, 1), "until": D(1996, 12, 31)},
     tried={"nation": "NATION_2", "until": D(1999, 12, 31)})


def q9(t, p):
    lines = semi(t.lineitem, t.part.where(F.col("p_name").contains(p.word)), "l_partkey = p_partkey")
    cost = on(lines, t.partsupp, "l_partkey = ps_partkey and l_suppkey = ps_suppkey")
    placed = on(on(cost, t.supplier, "l_suppkey = s_suppkey"), t.nation, "s_nationkey = n_nationkey")
    return (on(placed, t.orders, "l_orderkey = o_orderkey")
            .groupBy(F.col("n_name").alias("nation"), F.year("o_orderdate").alias("o_year"))
            .agg(total(f"{SALE} - ps_supplycost * l_quantity", "sum_profit")))


_add("q9", q9, "nation:s o_year:i sum_profit:d", """
SELECT n_name AS nation, year(o_orderdate) AS o_year, sum(l_extendedprice * (1 - l_discount) - l_quantity * ps_supplycost) AS sum_profit
FROM lineitem JOIN partsupp ON (ps_partkey, ps_suppkey) = (l_partkey, l_suppkey) JOIN part ON p_partkey = l_partkey
     JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
WHERE contains(p_name, {word})
GROUP BY 1, 2""", order="nation, o_year desc", params={"word": "green"}, tried={"word": "red"})


def q10(t, p):
    orders = t.orders.where((F.col("o_orderdate") >= p.day) & (F.col("o_orderdate") < F.add_months(F.lit(p.day), 3)))
    # Revenue per customer first: the wide customer columns join the sums, not the lines.
    spent = (on(t.lineitem.where("l_returnflag = 'R'"), orders, "l_orderkey = o_orderkey").groupBy("o_custkey").agg(total(SALE, "revenue")))
    return on(on(spent, t.customer, "o_custkey = c_custkey"), t.nation, "c_nationkey = n_nationkey")


_add("q10", q10, "c_custkey:l c_name:s revenue:d c_acctbal:d n_name:s c_address:s c_phone:s c_comment:s", """
SELECT c_custkey, c_name, sum(l_extendedprice * (1 - l_discount)) AS revenue, c_acctbal, n_name, c_address, c_phone, c_comment
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE l_returnflag = 'R' AND o_orderdate >= {day} AND o_orderdate < CAST({day} + INTERVAL 3 MONTH AS DATE)
GROUP BY ALL""", order="revenue desc", limit=20, params={"day": D(1993, 10, 1)}, tried={"day": D(1997, 10, 1)})


def q11(t, p):
    local = semi(t.supplier, t.nation.where(F.col("n_name") == p.nation), "s_nationkey = n_nationkey")
    stock = semi(t.partsupp, local, "ps_suppkey = s_suppkey").select("ps_partkey", F.expr("ps_supplycost * ps_availqty").alias("worth"))
    # The whole is the sum of the groups, so both come from one aggregation.
    groups = stock.groupBy("ps_partkey").agg(total("worth", "value"))
    return one_row(groups, groups.agg(total("value", "whole"))).where(f"value > whole * {p.fraction}")


_add("q11", q11, "ps_partkey:l value:d", """
SELECT ps_partkey, sum(ps_supplycost * ps_availqty) AS value
FROM partsupp JOIN supplier ON ps_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey AND n_name = {nation}
GROUP BY ps_partkey
QUALIFY sum(ps_supplycost * ps_availqty) > {fraction} * sum(sum(ps_supplycost * ps_availqty)) OVER ()""",
     order="value desc", params={"nation": "GERMANY", "fraction": 0.0001}, tried={"nation": "NATION_7"})


def q12(t, p):
    lines = t.lineitem.where(F.col("l_shipmode").isin(p.modes) & (F.col("l_receiptdate") >= p.day) & (F.col("l_receiptdate") < F.add_months(F.lit(p.day), 12)))
    late = lines.where("l_commitdate < l_receiptdate and l_shipdate < l_commitdate").select("l_orderkey", "l_shipmode")
    urgent = "o_orderpriority in ('1-URGENT', '2-HIGH')"
    return (on(late, t.orders, "l_orderkey = o_orderkey").groupBy("l_shipmode")
            .agg(tally(urgent, "high_line_count"), tally(f"not {urgent}", "low_line_count")))


_add("q12", q12, "l_shipmode:s high_line_count:l low_line_count:l", """
SELECT l_shipmode, count(*) FILTER (WHERE left(o_orderpriority, 1) IN ('1', '2')) AS high_line_count,
       count(*) FILTER (WHERE left(o_orderpriority, 1) NOT IN ('1', '2')) AS low_line_count
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE l_shipmode IN ({modes}) AND l_shipdate < l_commitdate AND l_commitdate < l_receiptdate AND year(l_receiptdate) = year({day})
GROUP BY l_shipmode""", order="l_shipmode", params={"modes": ["MAIL", "SHIP"], "day": D(1994, 1, 1)}, tried={"day": D(1997, 1, 1)})


def q13(t, p):
    plain = t.orders.where(~F.col("o_comment").like(f"%{p.one}%{p.two}%"))
    # Count per customer before the outer join: each customer then meets one row at most.
    counts = plain.groupBy("o_custkey").agg(F.count("*").alias("n"))
    per = on(t.customer.select("c_custkey"), counts, "c_custkey = o_custkey", "left").select(F.coalesce("n", F.lit(0)).alias("c_count"))
    return per.groupBy("c_count").agg(F.count("*").alias("custdist"))


_add("q13", q13, "c_count:l custdist:l", """
SELECT c_count, count(*) AS custdist
FROM (SELECT c_custkey, count(o_orderkey) AS c_count
      FROM customer LEFT JOIN (SELECT * FROM orders WHERE NOT regexp_matches(o_comment, {one} || '.*' || {two})) plain ON o_custkey = c_custkey
      GROUP BY c_custkey)
GROUP BY c_count""", order="custdist desc, c_count desc", params={"one": "special", "two": "requests"})


def q14(t, p):
    lines = t.lineitem.where((F.col("l_shipdate") >= p.day) & (F.col("l_shipdate") < F.add_months(F.lit(p.day), 1)))
    sold = on(lines, t.part.select("p_partkey", "p_type"), "l_partkey = p_partkey")
    promo = F.sum(F.when(F.col("p_type").startswith("PROMO"), F.expr(SALE)).otherwise(0))
    return sold.agg(ratio(promo * 100, F.sum(F.expr(SALE))).alias("promo_revenue"))


_add("q14", q14, "promo_revenue:d", """
SELECT (100 * sum(net) FILTER (WHERE starts_with(p_type, 'PROMO')))::DOUBLE / sum(net)::DOUBLE AS promo_revenue
FROM (SELECT l_partkey, l_extendedprice * (1 - l_discount) AS net FROM lineitem WHERE l_shipdate >= {day} AND l_shipdate < CAST({day} + INTERVAL 1 MONTH AS DATE))
     JOIN part ON p_partkey = l_partkey""", params={"day": D(1995, 9, 1)})


def q15(t, p):
    lines = t.lineitem.where((F.col("l_shipdate") >= p.day) & (F.col("l_shipdate") < F.add_months(F.lit(p.day), 3)))
    revenue = lines.groupBy("l_suppkey").agg(total(SALE, "total_revenue"))
    best = one_row(revenue, revenue.agg(F.max("total_revenue").alias("top"))).where("total_revenue = top")
    return on(t.supplier, best, "s_suppkey = l_suppkey")


_add("q15", q15, "s_suppkey:l s_name:s s_address:s s_phone:s total_revenue:d", """
SELECT s_suppkey, s_name, s_address, s_phone, total_revenue
FROM (SELECT l_suppkey, sum(l_extendedprice * (1 - l_discount)) AS total_revenue, rank() OVER (ORDER BY sum(l_extendedprice * (1 - l_discount)) DESC) AS place
      FROM lineitem WHERE l_shipdate >= {day} AND l_shipdate < CAST({day} + INTERVAL 3 MONTH AS DATE) GROUP BY l_suppkey) ranked
     JOIN supplier ON s_suppkey = l_suppkey
WHERE place = 1""", order="s_suppkey", params={"day": D(1996, 1, 1)})


def q16(t, p):
    parts = t.part.where((F.col("p_brand") != p.brand) & ~F.col("p_type").startswith(p.kind) & F.col("p_size").isin(p.sizes))
    # s_suppkey is a primary key, never NULL, so NOT IN is a plain anti join.
    good = anti(t.partsupp, t.supplier.where("s_comment like '%Customer%Complaints%'"), "ps_suppkey = s_suppkey")
    return on(good, parts, "ps_partkey = p_partkey").groupBy("p_brand", "p_type", "p_size").agg(F.count_distinct("ps_suppkey").alias("supplier_cnt"))


_add("q16", q16, "p_brand:s p_type:s p_size:i supplier_cnt:l", """
SELECT p_brand, p_type, p_size, count(DISTINCT ps_suppkey) AS supplier_cnt
FROM partsupp JOIN part ON ps_partkey = p_partkey
WHERE p_brand <> {brand} AND NOT starts_with(p_type, {kind}) AND p_size IN ({sizes})
  AND ps_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_comment LIKE '%Customer%Complaints%')
GROUP BY p_brand, p_type, p_size""", order="supplier_cnt desc, p_brand, p_type, p_size",
     params={"brand": "Brand#45", "kind": "MEDIUM POLISHED", "sizes": [49, 14, 23, 45, 19, 3, 36, 9]})


def q17(t, p):
    parts = t.part.where((F.col("p_brand") == p.brand) & (F.col("p_container") == p.box)).select("p_partkey")
    lines = on(t.lineitem.select("l_partkey", "l_quantity", "l_extendedprice"), parts, "l_partkey = p_partkey")
    usual = lines.groupBy(F.col("l_partkey").alias("k")).agg(mean("l_quantity", "usual"))
    return on(lines, usual, "l_partkey = k").where("l_quantity < 0.2 * usual").agg(ratio(F.sum("l_extendedprice"), F.lit(7.0)).alias("avg_yearly"))


_add("q17", q17, "avg_yearly:d", """
SELECT sum(l_extendedprice)::DOUBLE / 7.0 AS avg_yearly
FROM (SELECT l_extendedprice, l_quantity, 0.2::DOUBLE * (sum(l_quantity) OVER part_lines::DOUBLE / count(*) OVER part_lines) AS small
      FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand = {brand} AND p_container = {box}
      WINDOW part_lines AS (PARTITION BY l_partkey))
WHERE l_quantity < small""", params={"brand": "Brand#23", "box": "MED BOX"}, tried={"brand": "Brand#12"})


def q18(t, p):
    big = t.lineitem.groupBy("l_orderkey").agg(total("l_quantity", "sum_quantity")).where(f"sum_quantity > {p.quantity}")
    # The group sum already is the reported quantity: no second pass over the lines.
    return on(on(big, t.orders, "l_orderkey = o_orderkey"), t.customer, "o_custkey = c_custkey")


_add("q18", q18, "c_name:s c_custkey:l o_orderkey:l o_orderdate:s o_totalprice:d sum_quantity:d", """
SELECT c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice, sum(l_quantity) AS sum_quantity
FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY ALL HAVING sum(l_quantity) > {quantity}""", order="o_totalprice desc, o_orderdate", limit=100, params={"quantity": 300}, tried={"quantity": 200})


def _q19_branch(brand, kinds, low, size):
    return (f"(p_brand = '{brand}' and p_container in ({', '.join(repr(k) for k in kinds)}) and l_quantity between {low} and {low} + 10 and p_size between 1 and {size})")


def q19(t, p):
    lines = t.lineitem.where("l_shipmode in ('AIR', 'AIR REG') and l_shipinstruct = 'DELIVER IN PERSON'")
    branches = " or ".join(_q19_branch(b, k, low, size) for b, k, low, size in zip(p.brands, p.boxes, p.lows, p.sizes))
    return on(lines, t.part, f"l_partkey = p_partkey and ({branches})").agg(total(SALE, "revenue"))


_add("q19", q19, "revenue:d", """
WITH deal(brand, size_class, low, top_size) AS (SELECT unnest([{brands}]), unnest(['SM', 'MED', 'LG']), unnest([{lows}]), unnest([{sizes}]))
SELECT sum(l_extendedprice * (1 - l_discount)) AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey
     JOIN deal ON p_brand = brand AND split_part(p_container, ' ', 1) = size_class AND l_quantity >= low AND l_quantity <= low + 10 AND p_size BETWEEN 1 AND top_size
WHERE l_shipinstruct = 'DELIVER IN PERSON' AND l_shipmode IN ('AIR', 'AIR REG')
  AND CASE size_class WHEN 'MED' THEN split_part(p_container, ' ', 2) IN ('BAG', 'BOX', 'PKG', 'PACK') ELSE split_part(p_container, ' ', 2) IN ('CASE', 'BOX', 'PACK', 'PKG') END""",
     params={"brands": ["Brand#12", "Brand#23", "Brand#34"], "lows": [1, 10, 20], "sizes": [5, 10, 15],
             "boxes": [["SM CASE", "SM BOX", "SM PACK", "SM PKG"], ["MED BAG", "MED BOX", "MED PKG", "MED PACK"], ["LG CASE", "LG BOX", "LG PACK", "LG PKG"]]},
     tried={"brands": ["Brand#12", "Brand#23", "Brand#14"], "sizes": [50, 50, 50]})


def q20(t, p):
    lines = t.lineitem.where((F.col("l_shipdate") >= p.day) & (F.col("l_shipdate") < F.add_months(F.lit(p.day), 12)))
    sold = lines.groupBy("l_partkey", "l_suppkey").agg(total("l_quantity", "sold"))
    stock = semi(t.partsupp, t.part.where(F.col("p_name").startswith(p.word)), "ps_partkey = p_partkey")
    excess = on(stock, sold, "ps_partkey = l_partkey and ps_suppkey = l_suppkey").where("ps_availqty > 0.5 * sold").select("ps_suppkey")
    local = semi(t.supplier, t.nation.where(F.col("n_name") == p.nation), "s_nationkey = n_nationkey")
    return semi(local, excess, "s_suppkey = ps_suppkey")


_add("q20", q20, "s_name:s s_address:s", """
SELECT s_name, s_address
FROM supplier JOIN nation ON s_nationkey = n_nationkey AND n_name = {nation}
     SEMI JOIN (SELECT ps_suppkey
                FROM partsupp JOIN part ON ps_partkey = p_partkey AND starts_with(p_name, {word})
                     JOIN lineitem ON (l_partkey, l_suppkey) = (ps_partkey, ps_suppkey) AND l_shipdate >= {day} AND l_shipdate < CAST({day} + INTERVAL 1 YEAR AS DATE)
                GROUP BY ps_partkey, ps_suppkey, ps_availqty HAVING ps_availqty > sum(l_quantity) / 2) excess ON s_suppkey = ps_suppkey""",
     order="s_name", params={"word": "forest", "nation": "CANADA", "day": D(1994, 1, 1)}, tried={"word": "red", "nation": "NATION_4", "day": D(1997, 1, 1)})


def q21(t, p):
    lines = t.lineitem.select("l_orderkey", "l_suppkey", F.expr("l_receiptdate > l_commitdate").alias("late"))
    # Both existence tests ask about the suppliers of one order: two distinct counts answer them.
    # Per order, min and max of the supplier (all lines, late lines) tell "another one exists".
    per_order = lines.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("low"), F.max("l_suppkey").alias("high"),
        F.min(F.when(F.col("late"), F.col("l_suppkey"))).alias("late_low"), F.max(F.when(F.col("late"), F.col("l_suppkey"))).alias("late_high"),
        F.sum(F.col("late").cast("int")).alias("numwait"))
    # One late supplier only (late_low = late_high), somebody else on the order; its late lines are the count.
    kept = semi(per_order.where("late_low = late_high and low <> high"), t.orders.where("o_orderstatus = 'F'"), "l_orderkey = o_orderkey")
    local = semi(t.supplier, t.nation.where(F.col("n_name") == p.nation), "s_nationkey = n_nationkey")
    return on(kept, local, "late_low = s_suppkey").groupBy("s_name").agg(total("numwait", "numwait"))


_add("q21", q21, "s_name:s numwait:l", """
SELECT s_name, count(*) AS numwait
FROM lineitem late JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F' JOIN supplier ON s_suppkey = l_suppkey
     JOIN nation ON n_nationkey = s_nationkey AND n_name = {nation}
WHERE l_receiptdate > l_commitdate
  AND EXISTS (FROM lineitem o WHERE o.l_orderkey = late.l_orderkey AND o.l_suppkey <> late.l_suppkey)
  AND NOT EXISTS (FROM lineitem o WHERE o.l_orderkey = late.l_orderkey AND o.l_suppkey <> late.l_suppkey AND o.l_receiptdate > o.l_commitdate)
GROUP BY s_name""", order="numwait desc, s_name", limit=100, params={"nation": "SAUDI ARABIA"}, tried={"nation": "NATION_4"})


def q22(t, p):
    people = t.customer.select("c_custkey", "c_acctbal", F.substring("c_phone", 1, 2).alias("cntrycode")).where(F.col("cntrycode").isin(p.codes))
    usual = people.where("c_acctbal > 0").agg(mean("c_acctbal", "usual"))
    rich = one_row(people, usual).where("c_acctbal > usual")
    return anti(rich, t.orders, "c_custkey = o_custkey").groupBy("cntrycode").agg(F.count("*").alias("numcust"), total("c_acctbal", "totacctbal"))


_add("q22", q22, "cntrycode:s numcust:l totacctbal:d", """
WITH people AS (SELECT c_custkey, c_acctbal, left(c_phone, 2) AS cntrycode FROM customer WHERE left(c_phone, 2) IN ({codes}))
SELECT cntrycode, count(*) AS numcust, sum(c_acctbal) AS totacctbal
FROM people ANTI JOIN orders ON o_custkey = c_custkey
WHERE c_acctbal > (SELECT sum(c_acctbal)::DOUBLE / count(*) FROM people WHERE c_acctbal > 0)
GROUP BY cntrycode""", order="cntrycode", params={"codes": ["13", "31", "23", "29", "30", "18", "17"]},
     tried={"codes": ["10", "13", "31", "23", "29", "30", "18", "17"]})
