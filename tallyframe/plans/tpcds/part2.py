"""Retail reports 21 to 50."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.functions.verbs import mean, on, one_row, only, ratio, renamed, semi, tally, total
from tallyframe.operators.ordering import ranked
from tallyframe.plans.registry import Book, Raw
from tallyframe.plans.tpcds.part1 import PUBLISHED_ZIPS, brand_report, demographic_sales
from tallyframe.plans.tpcds.shared import (BUYER, CHANNELS, D, PLACE, WEEKDAYS, above_peers, dated, day_window, on_days, quoted, sold, take,
                                           weekday_sums, weekday_sums_sql)

BOOK = Book()


def _add(key, build, out, sql, **rest):
    BOOK.add(f"tpcds.{key}", build, out, sql, **rest)


def _around(day, value):
    """Sums before and from a day on."""
    before = F.col("d_date") < F.lit(day)
    return [F.sum(F.when(before, F.expr(value)).otherwise(0)), F.sum(F.when(before, 0).otherwise(F.expr(value)))]


def q21(t, p):
    counts = on(dated(t.inventory, t, "inv_date_sk", day_window(p.day, 30, 30)), t.item.where(f"i_current_price between {p.low} and {p.high}"), "inv_item_sk = i_item_sk")
    before, after = _around(p.day, "inv_quantity_on_hand")
    groups = on(counts, t.warehouse, "inv_warehouse_sk = w_warehouse_sk").groupBy("w_warehouse_name", "i_item_id").agg(before.alias("inv_before"), after.alias("inv_after"))
    return groups.where("inv_before > 0 and inv_after * 3 >= inv_before * 2 and inv_after * 2 <= inv_before * 3")


_add("q21", q21, "w_warehouse_name:s i_item_id:s inv_before:l inv_after:l", """
SELECT w_warehouse_name, i_item_id, coalesce(sum(inv_quantity_on_hand) FILTER (WHERE d_date < {day}), 0) AS inv_before, coalesce(sum(inv_quantity_on_hand) FILTER (WHERE d_date >= {day}), 0) AS inv_after
FROM inventory JOIN warehouse ON w_warehouse_sk = inv_warehouse_sk JOIN item ON i_item_sk = inv_item_sk JOIN date_dim ON d_date_sk = inv_date_sk
WHERE i_current_price BETWEEN {low} AND {high} AND d_date BETWEEN {day} - 30 AND {day} + 30
GROUP BY 1, 2 HAVING inv_before > 0 AND inv_after::DOUBLE / inv_before BETWEEN 2.0 / 3.0 AND 1.5""", order="w_warehouse_name, i_item_id", limit=100,
     params={"day": D(2000, 3, 11), "low": 0.99, "high": 1.49}, tried={"high": 9.49})


def q22(t, p):
    counts = on_days(t.inventory, t, "inv_date_sk", f"d_month_seq between {p.first} and {p.first} + 11")
    counts = semi(counts, t.warehouse, "inv_warehouse_sk = w_warehouse_sk")
    # Sum and count per item first: the rollup then expands items, not inventory rows.
    items = counts.groupBy("inv_item_sk").agg(total("inv_quantity_on_hand", "hand"), F.count("inv_quantity_on_hand").alias("n"))
    return (on(items, t.item, "inv_item_sk = i_item_sk").rollup("i_product_name", "i_brand", "i_class", "i_category")
            .agg(F.try_divide(F.sum("hand").cast("double"), F.sum("n")).alias("qoh")))


_add("q22", q22, "i_product_name:s i_brand:s i_class:s i_category:s qoh:d", """
SELECT i_product_name, i_brand, i_class, i_category, sum(inv_quantity_on_hand)::DOUBLE / count(inv_quantity_on_hand) AS qoh
FROM inventory JOIN date_dim ON d_date_sk = inv_date_sk JOIN item ON i_item_sk = inv_item_sk JOIN warehouse ON w_warehouse_sk = inv_warehouse_sk
WHERE d_month_seq >= {first} AND d_month_seq < {first} + 12
GROUP BY ROLLUP (i_product_name, i_brand, i_class, i_category)""", order="qoh, i_product_name, i_brand, i_class, i_category", limit=100, params={"first": 1200})


def _frequent(t, p):
    """Frequently sold items."""
    in_period = dated(t.store_sales, t, "ss_sold_date_sk", f"d_year between {p.year} and {p.year} + 3")
    return (on(in_period, t.item, "ss_item_sk = i_item_sk").groupBy(F.substring("i_item_desc", 1, 30).alias("desc"), "i_item_sk", "d_date")
            .agg(F.count("*").alias("n")).where(f"n > {p.often}").select("i_item_sk"))


def _rich(t, p):
    """Customers whose spending, ever, comes near the best spending of the period: both sums from one pass over the sales."""
    days = t.date_dim.where(f"d_year between {p.year} and {p.year} + 3").select("d_date_sk")
    lines = on(semi(t.store_sales, t.customer, "ss_customer_sk = c_customer_sk"), days, "ss_sold_date_sk = d_date_sk", "left")
    spent = lines.groupBy(F.col("ss_customer_sk").alias("rich")).agg(total("ss_quantity * ss_sales_price", "ever"), only(("d_date_sk is not null", "ss_quantity * ss_sales_price"), "lately"))
    best = spent.agg(F.max("lately").alias("best"), F.max("ever").alias("most"))
    # Both uses of the sums read both of them, so that the second is the first one's shuffle again.
    return one_row(spent, best).where(f"ever > {p.share} / 100.0 * best and ever <= most and (lately is null or lately <= best)").select("rich")


def _their_sales(t, p):
    """Catalog and web sales of frequent items to these customers in one month."""
    lines = functools.reduce(DataFrame.unionByName, [
        sold(t, c, day="~_sold_date_sk", item="~_item_sk", who=BUYER[c], value="~_quantity * ~_list_price").withColumn("channel", F.lit(c)) for c in ("catalog", "web")])
    lines = on_days(lines, t, "day", f"d_year = {p.year} and d_moy = {p.month}")
    return semi(semi(lines, _frequent(t, p), "item = i_item_sk"), _rich(t, p), "who = rich")


def q23a(t, p):
    return _their_sales(t, p).agg(total("value", "sales"))


def q23b(t, p):
    return on(_their_sales(t, p), t.customer, "who = c_customer_sk").groupBy("channel", "c_last_name", "c_first_name").agg(total("value", "sales")).drop("channel")


_Q23_SQL = """
WITH frequent AS (SELECT i_item_sk FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN item ON i_item_sk = ss_item_sk
                  WHERE d_year IN ({year}, {year} + 1, {year} + 2, {year} + 3) GROUP BY left(i_item_desc, 30), i_item_sk, d_date HAVING count(*) > {often}),
spent AS (SELECT c_customer_sk AS who, sum(ss_quantity * ss_sales_price) AS ever, sum(ss_quantity * ss_sales_price) FILTER (WHERE d_year BETWEEN {year} AND {year} + 3) AS lately
          FROM store_sales JOIN customer ON c_customer_sk = ss_customer_sk LEFT JOIN date_dim ON d_date_sk = ss_sold_date_sk GROUP BY 1),
rich AS (SELECT who FROM spent WHERE ever > {share} / 100.0 * (SELECT max(lately) FROM spent)),
theirs AS (SELECT 'c' AS channel, cs_bill_customer_sk AS who, cs_item_sk AS item, cs_sold_date_sk AS day, cs_quantity * cs_list_price AS value FROM catalog_sales
           UNION ALL SELECT 'w', ws_bill_customer_sk, ws_item_sk, ws_sold_date_sk, ws_quantity * ws_list_price FROM web_sales)
"""
_Q23_FROM = """ FROM theirs SEMI JOIN frequent ON i_item_sk = item SEMI JOIN rich USING (who) JOIN date_dim ON d_date_sk = day AND d_year = {year} AND d_moy = {month}"""
_Q23 = {"year": 2000, "month": 2, "often": 4, "share": 95}
_add("q23a", q23a, "sales:d", _Q23_SQL + "SELECT sum(value) AS sales" + _Q23_FROM, limit=100, params=_Q23, tried={"often": 0, "share": 50})
_add("q23b", q23b, "c_last_name:s c_first_name:s sales:d", _Q23_SQL + "SELECT c_last_name, c_first_name, sum(value) AS sales" + _Q23_FROM
     + " JOIN customer ON c_customer_sk = who GROUP BY channel, c_last_name, c_first_name", order="c_last_name, c_first_name, sales", limit=100, params=_Q23, tried={"often": 0, "share": 50})


def q24(t, p):
    """Amounts meet counts instead of rows: neither a line returned several times nor a zip with many addresses repeats a line."""
    returned = t.store_returns.groupBy("sr_ticket_number", "sr_item_sk").agg(F.count("*").alias("times"))
    lines = on(t.store_sales, returned, "ss_ticket_number = sr_ticket_number and ss_item_sk = sr_item_sk")
    lines = on(on(lines, t.customer, "ss_customer_sk = c_customer_sk"), t.item, "ss_item_sk = i_item_sk")
    lines = on(lines, t.store.where(f"s_market_id = {p.market}"), "ss_store_sk = s_store_sk")
    names = ["c_last_name", "c_first_name", "s_store_name", "s_state", "i_color", "i_current_price", "i_manager_id", "i_units", "i_size"]
    sums = lines.groupBy(*names, "c_birth_country", "s_zip").agg(total(F.col("ss_net_paid").cast("decimal(18,2)") * F.col("times"), "amount"))
    homes = t.customer_address.groupBy("ca_zip", "ca_state", F.upper("ca_country").alias("country")).agg(F.count("*").alias("homes"))
    met = on(sums, homes, "c_birth_country = country and s_zip = ca_zip")
    groups = met.groupBy(*names, "ca_state").agg(total(F.col("amount").cast("decimal(25,2)") * F.col("homes").cast("decimal(12,0)"), "netpaid"))
    paid = groups.where(F.col("i_color") == p.color).groupBy("c_last_name", "c_first_name", "s_store_name").agg(total("netpaid", "paid"))
    return one_row(paid, groups.agg(mean("netpaid", "usual"))).where("paid > 0.05 * usual")


_Q24_SQL = """
WITH sales AS (SELECT c_last_name, c_first_name, s_store_name, i_color, sum(ss_net_paid) AS netpaid
               FROM store_sales JOIN store_returns ON (sr_ticket_number, sr_item_sk) = (ss_ticket_number, ss_item_sk) JOIN customer ON c_customer_sk = ss_customer_sk
                    JOIN item ON i_item_sk = ss_item_sk JOIN store ON s_store_sk = ss_store_sk AND s_market_id = {market}
                    JOIN customer_address ON ca_zip = s_zip AND upper(ca_country) = c_birth_country
               GROUP BY c_last_name, c_first_name, s_store_name, ca_state, s_state, i_color, i_current_price, i_manager_id, i_units, i_size)
SELECT c_last_name, c_first_name, s_store_name, sum(netpaid) AS paid FROM sales WHERE i_color = {color}
GROUP BY ALL HAVING sum(netpaid) > 0.05::DOUBLE * (SELECT sum(netpaid)::DOUBLE / count(netpaid) FROM sales)"""
for _key, _color in (("q24a", "pale"), ("q24b", "chiffon")):
    _add(_key, q24, "c_last_name:s c_first_name:s s_store_name:s paid:d", _Q24_SQL, params={"market": 8, "color": _color})


def q27(t, p):
    people = t.customer_demographics.where((F.col("cd_gender") == p.gender) & (F.col("cd_marital_status") == p.marital) & (F.col("cd_education_status") == p.education))
    lines = semi(on_days(t.store_sales, t, "ss_sold_date_sk", f"d_year = {p.year}"), people, "ss_cdemo_sk = cd_demo_sk")
    lines = on(on(lines, t.store.where(F.col("s_state").isin(p.states)), "ss_store_sk = s_store_sk"), t.item, "ss_item_sk = i_item_sk")
    return lines.rollup("i_item_id", "s_state").agg(F.grouping("s_state").alias("g_state"), mean("ss_quantity", "agg1"), mean("ss_list_price", "agg2"), mean("ss_coupon_amt", "agg3"), mean("ss_sales_price", "agg4"))


_add("q27", q27, "i_item_id:s s_state:s g_state:i agg1:d agg2:d agg3:d agg4:d", """
SELECT i_item_id, s_state, grouping(s_state) AS g_state, sum(ss_quantity)::DOUBLE / count(ss_quantity) AS agg1, sum(ss_list_price)::DOUBLE / count(ss_list_price) AS agg2,
       sum(ss_coupon_amt)::DOUBLE / count(ss_coupon_amt) AS agg3, sum(ss_sales_price)::DOUBLE / count(ss_sales_price) AS agg4
FROM store_sales JOIN customer_demographics ON cd_demo_sk = ss_cdemo_sk JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk JOIN item ON i_item_sk = ss_item_sk
WHERE cd_gender = {gender} AND cd_marital_status = {marital} AND cd_education_status = {education} AND d_year = {year} AND list_contains([{states}], s_state)
GROUP BY ROLLUP (i_item_id, s_state)""", order="i_item_id, s_state", limit=100, params={"gender": "M", "marital": "S", "education": "College", "year": 2002, "states": ["TN"]})

_PRICE_BANDS = [(0, 5, 8, 459, 57), (6, 10, 90, 2323, 31), (11, 15, 142, 12214, 79), (16, 20, 135, 6071, 38), (21, 25, 122, 836, 17), (26, 30, 154, 7326, 7)]


def q28(t, p):
    """Six price bands in one row. The quantity ranges do not meet, so a row belongs to one band at most and one grouped pass does."""
    band = F.coalesce(*[F.when(F.expr(
        f"ss_quantity between {low} and {high} and (ss_list_price between {price} and {price} + 10 or ss_coupon_amt between {coupon} and {coupon} + 1000 or ss_wholesale_cost between {cost} and {cost} + 20)"
    ), i) for i, (low, high, price, coupon, cost) in enumerate(p.bands, 1)])
    bands = t.store_sales.select(band.alias("band"), "ss_list_price").where("band is not null").groupBy("band").agg(
        mean("ss_list_price", "lp"), F.count("ss_list_price").alias("cnt"), F.count_distinct("ss_list_price").alias("cntd"))
    shown = []
    for i in range(1, 7):
        here = F.col("band") == i
        shown += [F.max(F.when(here, F.col("lp"))).alias(f"b{i}_lp")] + [F.coalesce(F.max(F.when(here, F.col(c))), F.lit(0)).alias(f"b{i}_{c}") for c in ("cnt", "cntd")]
    return bands.agg(*shown)


_add("q28", q28, " ".join(f"b{i}_lp:d b{i}_cnt:l b{i}_cntd:l" for i in range(1, 7)), "SELECT * FROM " + ", ".join(
    f"(SELECT sum(ss_list_price)::DOUBLE / count(ss_list_price) AS b{i}_lp, count(ss_list_price) AS b{i}_cnt, count(DISTINCT ss_list_price) AS b{i}_cntd FROM store_sales "
    f"WHERE ss_quantity >= {a} AND ss_quantity <= {b} AND (ss_list_price - {lp} BETWEEN 0 AND 10 OR ss_coupon_amt - {c} BETWEEN 0 AND 1000 OR ss_wholesale_cost - {w} BETWEEN 0 AND 20)) band{i}"
    for i, (a, b, lp, c, w) in enumerate(_PRICE_BANDS, 1)), limit=100, params={"bands": _PRICE_BANDS})


def q30(t, p):
    """Also q81: customers of one state whose returns exceed those of their peers."""
    back = on(on_days(t.table(p.returns), t, f"{p.r}_returned_date_sk", f"d_year = {p.year}"), t.customer_address, f"{p.r}_returning_addr_sk = ca_address_sk")
    totals = back.groupBy(F.col(f"{p.r}_returning_customer_sk").alias("who"), F.col("ca_state").alias("group")).agg(total(p.amount, "total"))
    people = on(t.customer, t.customer_address.where(F.col("ca_state") == p.state), "c_current_addr_sk = ca_address_sk")
    return on(above_peers(totals, "group"), people, "who = c_customer_sk").withColumnRenamed("total", "ctr_total_return")


_RETURNERS_SQL = """
SELECT *, amt AS ctr_total_return
FROM (SELECT ~_returning_customer_sk AS who, ca_state AS st, sum(#) AS amt, 1.2::DOUBLE * (sum(sum(#)) OVER g::DOUBLE / count(sum(#)) OVER g) AS bar
      FROM @ JOIN date_dim ON d_date_sk = ~_returned_date_sk AND d_year = {year} JOIN customer_address ON ca_address_sk = ~_returning_addr_sk
      GROUP BY 1, 2 WINDOW g AS (PARTITION BY ca_state)) r JOIN customer ON c_customer_sk = who
     JOIN customer_address ON ca_address_sk = c_current_addr_sk AND ca_state = {state}
WHERE amt > bar"""
_Q30_OUT = "c_customer_id:s c_salutation:s c_first_name:s c_last_name:s c_preferred_cust_flag:s c_birth_day:i c_birth_month:i c_birth_year:i c_birth_country:s c_login:s c_email_address:s c_last_review_date:s ctr_total_return:d"
_Q81_OUT = "c_customer_id:s c_salutation:s c_first_name:s c_last_name:s ca_street_number:s ca_street_name:s ca_street_type:s ca_suite_number:s ca_city:s ca_county:s ca_state:s ca_zip:s ca_country:s ca_gmt_offset:d ca_location_type:s ctr_total_return:d"
for _key, _out, _table, _r, _amount, _year in (("q30", _Q30_OUT, "web_returns", "wr", "wr_return_amt", 2002), ("q81", _Q81_OUT, "catalog_returns", "cr", "cr_return_amt_inc_tax", 2000)):
    _add(_key, q30, _out, _RETURNERS_SQL.replace("@", _table).replace("~", _r).replace("#", _amount), order=", ".join(c.split(":")[0] for c in _out.split()), limit=100,
         params={"returns": _table, "r": _r, "amount": _amount, "year": _year, "state": "GA"})


def q31(t, p):
    """Counties by quarter: a column per quarter instead of six self-joins."""
    def quarters(channel):
        lines = dated(sold(t, channel, day="~_sold_date_sk", place=PLACE[channel], amount="~_ext_sales_price"), t, "day", f"d_year = {p.year} and d_qoy <= 3")
        return on(lines, t.customer_address, "place = ca_address_sk").groupBy(F.col("ca_county").alias(f"{channel}_county")).agg(
            *[F.sum(F.when(F.col("d_qoy") == q, F.col("amount"))).alias(f"{channel}{q}") for q in (1, 2, 3)])

    both = on(quarters("store"), quarters("web"), "store_county = web_county").select(
        F.col("store_county").alias("ca_county"), F.lit(p.year).alias("d_year"), *[ratio(f"{c}{b}", f"{c}{a}").alias(f"{c}_q{a}_q{b}_increase") for a, b in ((1, 2), (2, 3)) for c in ("web", "store")])
    return both.where("web_q1_q2_increase > store_q1_q2_increase and web_q2_q3_increase > store_q2_q3_increase")


_add("q31", q31, "ca_county:s d_year:i web_q1_q2_increase:d store_q1_q2_increase:d web_q2_q3_increase:d store_q2_q3_increase:d", """
WITH s AS (SELECT ca_county, d_qoy AS q, sum(ss_ext_sales_price)::DOUBLE AS v FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN customer_address ON ca_address_sk = ss_addr_sk WHERE d_year = {year} GROUP BY 1, 2),
w AS (SELECT ca_county, d_qoy AS q, sum(ws_ext_sales_price)::DOUBLE AS v FROM web_sales JOIN date_dim ON d_date_sk = ws_sold_date_sk JOIN customer_address ON ca_address_sk = ws_bill_addr_sk WHERE d_year = {year} GROUP BY 1, 2),
grown AS (SELECT ca_county, lead(s.v) OVER o / s.v AS s_up, lead(w.v) OVER o / w.v AS w_up, q FROM s JOIN w USING (ca_county, q) WHERE q <= 3 WINDOW o AS (PARTITION BY ca_county ORDER BY q))
SELECT a.ca_county, {year} AS d_year, a.w_up AS web_q1_q2_increase, a.s_up AS store_q1_q2_increase, b.w_up AS web_q2_q3_increase, b.s_up AS store_q2_q3_increase
FROM grown a JOIN grown b USING (ca_county) WHERE a.q = 1 AND b.q = 2 AND a.w_up > a.s_up AND b.w_up > b.s_up""", order="ca_county", params={"year": 2000})


def excess_discount(t, p):
    """q32, q92: discounts above 1.3 times the item's own average in the period."""
    lines = on_days(sold(t, p.channel, day="~_sold_date_sk", item="~_item_sk", off="~_ext_discount_amt"), t, "day", day_window(p.day, p.days))
    lines = semi(lines, t.item.where(f"i_manufact_id between {p.maker} and {p.maker} + {p.makers} - 1"), "item = i_item_sk")
    usual = lines.groupBy(F.col("item").alias("k")).agg(mean("off", "usual"))
    return on(lines, usual, "item = k").where("off > 1.3 * usual").agg(total("off", "excess_discount_amount"))


_EXCESS_SQL = """
SELECT sum(off) AS excess_discount_amount
FROM (SELECT ~_ext_discount_amt AS off, 1.3::DOUBLE * (sum(~_ext_discount_amt) OVER i::DOUBLE / count(~_ext_discount_amt) OVER i) AS bar
      FROM @ JOIN date_dim ON d_date_sk = ~_sold_date_sk AND d_date BETWEEN {day} AND {day} + {days} JOIN item ON i_item_sk = ~_item_sk AND i_manufact_id >= {maker} AND i_manufact_id < {maker} + {makers}
      WINDOW i AS (PARTITION BY i_item_sk)) WHERE off > bar"""
for _key, _channel, _maker in (("q32", "catalog", 977), ("q92", "web", 350)):
    _add(_key, excess_discount, "excess_discount_amount:d", _EXCESS_SQL.replace("@", CHANNELS[_channel][0]).replace("~", CHANNELS[_channel][1]), limit=100,
         params={"channel": _channel, "maker": _maker, "makers": 1, "day": D(2000, 1, 27), "days": 90}, tried={"makers": 20})


def three_channel_items(t, p):
    """q33, q56, q60: sales over three channels for items of some kind, buyers in one time zone."""
    kinds = t.item.where(F.col(p.test_column).isin(p.test_values)).select(F.col(p.key).alias("kind"))
    items = semi(t.item, kinds, f"{p.key} = kind").select("i_item_sk", p.key)
    near = t.customer_address.where("ca_gmt_offset = -5").select("ca_address_sk")

    def channel(name):
        lines = sold(t, name, day="~_sold_date_sk", item="~_item_sk", place=PLACE[name], amount="~_ext_sales_price")
        return semi(on_days(lines, t, "day", f"d_year = {p.year} and d_moy = {p.month}"), near, "place = ca_address_sk").groupBy("item").agg(total("amount", "amount"))

    lines = functools.reduce(DataFrame.unionByName, [channel(c) for c in CHANNELS])
    return on(lines, items, "item = i_item_sk").groupBy(p.key).agg(total("amount", "total_sales"))


_THREE_SQL = """
WITH lines AS (SELECT ss_sold_date_sk AS day, ss_item_sk AS item, ss_addr_sk AS place, ss_ext_sales_price AS amount FROM store_sales
               UNION ALL SELECT cs_sold_date_sk, cs_item_sk, cs_bill_addr_sk, cs_ext_sales_price FROM catalog_sales UNION ALL SELECT ws_sold_date_sk, ws_item_sk, ws_bill_addr_sk, ws_ext_sales_price FROM web_sales)
SELECT #, sum(amount) AS total_sales
FROM lines JOIN date_dim ON d_date_sk = day AND (d_year, d_moy) = ({year}, {month}) JOIN item ON i_item_sk = item JOIN customer_address ON ca_address_sk = place AND ca_gmt_offset = -5
WHERE # IN (SELECT i.# FROM item i WHERE i.@ IN ({test_values}))
GROUP BY #"""
for _key, _by, _column, _values, _year, _month, _order in (
        ("q33", "i_manufact_id", "i_category", ["Electronics"], 1998, 5, "total_sales"), ("q56", "i_item_id", "i_color", ["slate", "blanched", "burnished"], 2001, 2, "total_sales"),
        ("q60", "i_item_id", "i_category", ["Music"], 1998, 9, "i_item_id, total_sales")):
    _add(_key, three_channel_items, f"{_by}:{'i' if _by == 'i_manufact_id' else 's'} total_sales:d", _THREE_SQL.replace("#", _by).replace("@", _column), order=_order, limit=100,
         params={"key": _by, "test_column": _column, "test_values": _values, "year": _year, "month": _month})


def baskets(t, p):
    """q34, q73: tickets of some size from households of some kind."""
    homes = t.household_demographics.where("hd_vehicle_count > 0").where(F.col("hd_buy_potential").isin(p.potentials)).where(f"hd_dep_count / hd_vehicle_count > {p.per_vehicle}")
    lines = on_days(t.store_sales, t, "ss_sold_date_sk", f"({p.days}) and d_year in ({p.year}, {p.year} + 1, {p.year} + 2)")
    lines = semi(semi(lines, t.store.where(F.col("s_county").isin(p.counties)), "ss_store_sk = s_store_sk"), homes, "ss_hdemo_sk = hd_demo_sk")
    tickets = lines.groupBy("ss_ticket_number", "ss_customer_sk").agg(F.count("*").alias("cnt")).where(f"cnt between {p.low} and {p.high}")
    return on(tickets, t.customer, "ss_customer_sk = c_customer_sk")


_BASKET_SQL = """
SELECT c_last_name, c_first_name, c_salutation, c_preferred_cust_flag, ss_ticket_number, count(*) AS cnt
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk JOIN household_demographics ON hd_demo_sk = ss_hdemo_sk JOIN customer ON c_customer_sk = ss_customer_sk
WHERE d_year IN ({year}, {year} + 1, {year} + 2) AND <<days>> AND s_county IN ({counties}) AND hd_buy_potential IN ({potentials}) AND hd_vehicle_count > 0 AND hd_dep_count > {per_vehicle} * hd_vehicle_count
GROUP BY ss_ticket_number, c_customer_sk, ALL_NAMES HAVING count(*) BETWEEN {low} AND {high}""".replace("ALL_NAMES", "c_last_name, c_first_name, c_salutation, c_preferred_cust_flag")
BASKET_OUT = "c_last_name:s c_first_name:s c_salutation:s c_preferred_cust_flag:s ss_ticket_number:l cnt:l"
_add("q34", baskets, BASKET_OUT, _BASKET_SQL.replace("<<days>>", "d_dom IN (1, 2, 3, 25, 26, 27, 28)"), order="c_last_name, c_first_name, c_salutation, c_preferred_cust_flag desc, ss_ticket_number",
     params={"days": "d_dom between 1 and 3 or d_dom between 25 and 28", "potentials": [">10000", "unknown"], "per_vehicle": 1.2, "counties": ["Williamson County"], "year": 1999, "low": 15, "high": 20},
     tried={"low": 2, "potentials": [">10000", "Unknown"]})
_add("q73", baskets, BASKET_OUT, _BASKET_SQL.replace("<<days>>", "d_dom <= 2"), order="cnt desc, c_last_name",
     params={"days": "d_dom between 1 and 2", "potentials": [">10000", "unknown"], "per_vehicle": 1, "counties": ["Williamson County", "Franklin Parish", "Bronx County", "Orange County"], "year": 1999, "low": 1, "high": 5})


def q35(t, p):
    from tallyframe.plans.tpcds.part1 import active_people
    keys = ["ca_state", "cd_gender", "cd_marital_status", "cd_dep_count", "cd_dep_employed_count", "cd_dep_college_count"]
    active = active_people(t, f"d_year = {p.year} and d_qoy < 4", t.customer)
    people = on(on(active, t.customer_address, "c_current_addr_sk = ca_address_sk"), t.customer_demographics, "c_current_cdemo_sk = cd_demo_sk")
    groups = people.groupBy(*keys).agg(F.count("*").alias("n"))
    # The measured columns are grouping keys: min, max and average equal the key itself.
    measured = []
    for i, c in enumerate(keys[3:], 1):
        measured += [F.col("n").alias(f"cnt{i}"), F.col(c).alias(f"min{i}"), F.col(c).alias(f"max{i}"), F.col(c).cast("double").alias(f"avg{i}")]
    return groups.select(*keys, *measured)


_Q35_DEPS = ["cd_dep_count", "cd_dep_employed_count", "cd_dep_college_count"]


def _q35_sql():
    from tallyframe.plans.tpcds.part1 import _ACTIVE_SQL
    return ("SELECT ca_state, cd_gender, cd_marital_status, " + ", ".join(
        f"{c}, count(*) AS cnt{i}, min({c}) AS min{i}, max({c}) AS max{i}, avg({c}) AS avg{i}" for i, c in enumerate(_Q35_DEPS, 1))
        + "\nFROM " + _ACTIVE_SQL.replace("<<days>>", "d_year = {year} AND d_qoy IN (1, 2, 3)") + "\nGROUP BY ca_state, cd_gender, cd_marital_status, cd_dep_count, cd_dep_employed_count, cd_dep_college_count")


_add("q35", q35, "ca_state:s cd_gender:s cd_marital_status:s " + " ".join(f"{c}:i cnt{i}:l min{i}:i max{i}:i avg{i}:d" for i, c in enumerate(_Q35_DEPS, 1)), _q35_sql(),
     order="ca_state, cd_gender, cd_marital_status, cd_dep_count, cd_dep_employed_count, cd_dep_college_count", limit=100, params={"year": 2002})


def ranked_levels(groups: DataFrame, parent: str, child: str, measure: str, down: bool) -> DataFrame:
    """Rank inside the parent on each level of a two-key rollup; ``g_*`` are the grouping flags."""
    level = groups.withColumn("lochierarchy", F.expr("g_parent + g_child")).withColumn("in_parent", F.expr(f"case when g_child = 0 then {parent} end"))
    order = F.desc(measure) if down else F.asc(measure)
    return level.withColumn("rank_within_parent", F.rank().over(W.partitionBy("lochierarchy", "in_parent").orderBy(order))).withColumn(
        "shown_parent", F.expr(f"case when lochierarchy = 0 then {parent} end"))


def q36(t, p):
    lines = semi(on_days(t.store_sales, t, "ss_sold_date_sk", f"d_year = {p.year}"), t.store.where(F.col("s_state").isin(p.states)), "ss_store_sk = s_store_sk")
    groups = on(lines, t.item, "ss_item_sk = i_item_sk").rollup("i_category", "i_class").agg(
        ratio(F.sum("ss_net_profit"), F.sum("ss_ext_sales_price")).alias("gross_margin"), F.grouping("i_category").alias("g_parent"), F.grouping("i_class").alias("g_child"))
    return ranked_levels(groups, "i_category", "i_class", "gross_margin", down=False)


_add("q36", q36, "gross_margin:d i_category:s i_class:s lochierarchy:i rank_within_parent:l", """
SELECT gross_margin, i_category, i_class, lv AS lochierarchy, rank() OVER (PARTITION BY lv, CASE WHEN lv = 0 THEN i_category END ORDER BY gross_margin NULLS FIRST) AS rank_within_parent
FROM (SELECT sum(ss_net_profit)::DOUBLE / nullif(sum(ss_ext_sales_price), 0)::DOUBLE AS gross_margin, i_category, i_class, grouping(i_category) + grouping(i_class) AS lv
      FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk AND d_year = {year} JOIN item ON i_item_sk = ss_item_sk JOIN store ON s_store_sk = ss_store_sk AND s_state IN ({states})
      GROUP BY ROLLUP (i_category, i_class))""", order="lochierarchy desc, i_category, rank_within_parent", limit=100, params={"year": 2001, "states": ["TN"]})


def stocked_items(t, p):
    """q37, q82: sold items with stock in a range in a 60-day period."""
    items = t.item.where(F.col("i_manufact_id").isin(p.makers)).where(f"i_current_price between {p.price} and {p.price} + 30")
    stock = on_days(t.inventory.where("inv_quantity_on_hand between 100 and 500"), t, "inv_date_sk", day_window(p.day, 60))
    items = semi(items, stock, "i_item_sk = inv_item_sk")
    return semi(items, sold(t, p.channel, item="~_item_sk"), "i_item_sk = item").select("i_item_id", "i_item_desc", "i_current_price").distinct()


_STOCK_SQL = """
SELECT DISTINCT i_item_id, i_item_desc, i_current_price
FROM item JOIN inventory ON inv_item_sk = i_item_sk JOIN date_dim ON d_date_sk = inv_date_sk JOIN @ ON ~_item_sk = i_item_sk
WHERE i_current_price BETWEEN {price} AND {price} + 30 AND d_date BETWEEN {day} AND {day} + 60 AND i_manufact_id IN ({makers}) AND inv_quantity_on_hand BETWEEN 100 AND 500"""
STOCK_OUT = "i_item_id:s i_item_desc:s i_current_price:d"
_add("q37", stocked_items, STOCK_OUT, _STOCK_SQL.replace("@", "catalog_sales").replace("~", "cs"), order="i_item_id", limit=100,
     params={"channel": "catalog", "price": 68, "makers": [677, 940, 694, 808], "day": D(2000, 2, 1)}, tried={"makers": list(range(600, 700))})
_add("q82", stocked_items, STOCK_OUT, _STOCK_SQL.replace("@", "store_sales").replace("~", "ss"), order="i_item_id", limit=100,
     params={"channel": "store", "price": 62, "makers": [129, 270, 821, 423], "day": D(2000, 5, 25)}, tried={"makers": list(range(100, 200))})


def _buyers_on_days(t, p, channel):
    lines = dated(sold(t, channel, day="~_sold_date_sk", who=BUYER[channel]), t, "day", f"d_month_seq between {p.first} and {p.first} + 11")
    return on(lines.select("who", "d_date"), t.customer, "who = c_customer_sk").select("c_last_name", "c_first_name", "d_date")


def q38(t, p):
    return functools.reduce(DataFrame.intersect, [_buyers_on_days(t, p, c) for c in CHANNELS]).agg(F.count("*").alias("cnt"))


def q87(t, p):
    return functools.reduce(DataFrame.subtract, [_buyers_on_days(t, p, c) for c in CHANNELS]).agg(F.count("*").alias("cnt"))


_BUYERS_SQL = """
WITH visits AS (SELECT 1 AS channel, ss_customer_sk AS who, ss_sold_date_sk AS day FROM store_sales UNION ALL SELECT 2, cs_bill_customer_sk, cs_sold_date_sk FROM catalog_sales UNION ALL SELECT 4, ws_bill_customer_sk, ws_sold_date_sk FROM web_sales),
people AS (SELECT c_last_name, c_first_name, d_date, bit_or(channel) AS channels FROM visits JOIN customer ON c_customer_sk = who JOIN date_dim ON d_date_sk = day WHERE d_month_seq >= {first} AND d_month_seq < {first} + 12 GROUP BY ALL)
SELECT count(*) AS cnt FROM people WHERE channels = """
_add("q38", q38, "cnt:l", _BUYERS_SQL + "7", limit=100, params={"first": 1200})
_add("q87", q87, "cnt:l", _BUYERS_SQL + "1", params={"first": 1200})


def q39(t, p):
    """Month-over-month variation of stock: both months in one aggregation."""
    counts = dated(t.inventory, t, "inv_date_sk", f"d_year = {p.year} and d_moy in (1, 2)")
    counts = semi(semi(counts, t.warehouse, "inv_warehouse_sk = w_warehouse_sk"), t.item, "inv_item_sk = i_item_sk")

    def month(m):
        on_hand = F.when(F.col("d_moy") == m, F.col("inv_quantity_on_hand"))
        return [mean(on_hand, f"mean{m}"), F.stddev_samp(on_hand).alias(f"stdev{m}")]

    both = counts.groupBy("inv_warehouse_sk", "inv_item_sk").agg(*month(1), *month(2))
    both = both.select("*", F.try_divide("stdev1", "mean1").alias("cov1"), F.try_divide("stdev2", "mean2").alias("cov2")).where(f"cov1 > {p.least} and cov2 > 1")
    return take(both, **{f"{c}{m}": e for m in (1, 2) for c, e in (("w_warehouse_sk", "inv_warehouse_sk"), ("i_item_sk", "inv_item_sk"), ("d_moy", str(m)), ("mean", f"mean{m}"), ("cov", f"cov{m}"))})


_Q39_SQL = """
WITH months AS (SELECT inv_warehouse_sk AS w, inv_item_sk AS i, d_moy AS m, sum(inv_quantity_on_hand)::DOUBLE / count(inv_quantity_on_hand) AS mean, stddev_samp(inv_quantity_on_hand) / nullif(avg(inv_quantity_on_hand), 0) AS cov
                FROM inventory JOIN item ON i_item_sk = inv_item_sk JOIN warehouse ON w_warehouse_sk = inv_warehouse_sk JOIN date_dim ON d_date_sk = inv_date_sk WHERE d_year = {year} GROUP BY ALL HAVING cov > 1)
SELECT a.w AS w_warehouse_sk1, a.i AS i_item_sk1, a.m AS d_moy1, a.mean AS mean1, a.cov AS cov1, b.w AS w_warehouse_sk2, b.i AS i_item_sk2, b.m AS d_moy2, b.mean AS mean2, b.cov AS cov2
FROM months a JOIN months b USING (w, i) WHERE a.m = 1 AND b.m = 2 AND a.cov > {least}"""
for _key, _least in (("q39a", 1), ("q39b", 1.5)):
    _add(_key, q39, " ".join(f"w_warehouse_sk{m}:i i_item_sk{m}:i d_moy{m}:i mean{m}:d cov{m}:d6" for m in (1, 2)), _Q39_SQL, order="w_warehouse_sk1, i_item_sk1, d_moy1, mean1, cov1, d_moy2, mean2, cov2",
         params={"year": 2001, "least": _least})


def q40(t, p):
    refunds = t.catalog_returns.select("cr_order_number", "cr_item_sk", "cr_refunded_cash")
    lines = on(dated(t.catalog_sales, t, "cs_sold_date_sk", day_window(p.day, 30, 30)), t.item.where(f"i_current_price between {p.low} and {p.high}"), "cs_item_sk = i_item_sk")
    lines = on(on(lines, refunds, "cs_order_number = cr_order_number and cs_item_sk = cr_item_sk", "left"), t.warehouse, "cs_warehouse_sk = w_warehouse_sk")
    before, after = _around(p.day, "cs_sales_price - coalesce(cr_refunded_cash, 0)")
    return lines.groupBy("w_state", "i_item_id").agg(before.alias("sales_before"), after.alias("sales_after"))


_add("q40", q40, "w_state:s i_item_id:s sales_before:d sales_after:d", """
SELECT w_state, i_item_id, sum(if(d_date < {day}, net, 0)) AS sales_before, sum(if(d_date < {day}, 0, net)) AS sales_after
FROM (SELECT cs_item_sk, cs_warehouse_sk, cs_sold_date_sk, cs_sales_price - ifnull(cr_refunded_cash, 0) AS net FROM catalog_sales LEFT JOIN catalog_returns ON (cr_order_number, cr_item_sk) = (cs_order_number, cs_item_sk))
     JOIN warehouse ON w_warehouse_sk = cs_warehouse_sk JOIN item ON i_item_sk = cs_item_sk JOIN date_dim ON d_date_sk = cs_sold_date_sk
WHERE i_current_price BETWEEN {low} AND {high} AND d_date BETWEEN {day} - 30 AND {day} + 30
GROUP BY w_state, i_item_id""", order="w_state, i_item_id", limit=100, params={"day": D(2000, 3, 11), "low": 0.99, "high": 1.49}, tried={"high": 9.49})

# Attribute combinations of the published parameter set, (category, colors, units, sizes).
WANTED = [("Women", ["powder", "khaki"], ["Ounce", "Oz"], ["medium", "extra large"]), ("Women", ["brown", "honeydew"], ["Bunch", "Ton"], ["N/A", "small"]),
          ("Men", ["floral", "deep"], ["N/A", "Dozen"], ["petite", "large"]), ("Men", ["light", "cornflower"], ["Box", "Pound"], ["medium", "extra large"]),
          ("Women", ["midnight", "snow"], ["Pallet", "Gross"], ["medium", "extra large"]), ("Women", ["cyan", "papaya"], ["Cup", "Dram"], ["N/A", "small"]),
          ("Men", ["orange", "frosted"], ["Each", "Tbl"], ["petite", "large"]), ("Men", ["forest", "ghost"], ["Lb", "Bundle"], ["medium", "extra large"])]


def q41(t, p):
    wanted = " or ".join(f"(i_category = '{c}' and i_color in ({quoted(colors)}) and i_units in ({quoted(units)}) and i_size in ({quoted(sizes)}))" for c, colors, units, sizes in p.wanted)
    makers = t.item.where(wanted).select(F.col("i_manufact").alias("maker"))
    return semi(t.item.where(f"i_manufact_id between {p.low} and {p.low} + {p.span}"), makers, "i_manufact = maker").select("i_product_name").distinct()


_add("q41", q41, "i_product_name:s", "WITH wanted(c, colors, units, sizes) AS (VALUES " + ", ".join(f"('{c}', [{quoted(k)}], [{quoted(u)}], [{quoted(s)}])" for c, k, u, s in WANTED) + """),
makers AS (SELECT i_manufact FROM item JOIN wanted ON c = i_category AND list_contains(colors, i_color) AND list_contains(units, i_units) AND list_contains(sizes, i_size))
SELECT i_product_name FROM item SEMI JOIN makers USING (i_manufact) WHERE i_manufact_id >= {low} AND i_manufact_id <= {low} + {span} GROUP BY 1""", order="i_product_name", limit=100,
     params={"low": 738, "span": 40, "wanted": WANTED}, tried={"low": 1, "span": 1000})

_add("q42", brand_report, "d_year:i i_category_id:i i_category:s sum_sales:d", """
SELECT d_year, i_category_id, i_category, sum(ss_ext_sales_price) AS sum_sales FROM store_sales JOIN item ON i_item_sk = ss_item_sk JOIN date_dim ON d_date_sk = ss_sold_date_sk
WHERE {items} AND {days} GROUP BY ALL""", order="sum_sales desc, d_year, i_category_id, i_category", limit=100,
     params={"items": Raw("i_manager_id = 1"), "days": Raw("d_moy = 11 and d_year = 2000"), "keys": ["d_year", "i_category_id", "i_category"],
             "shown": {"d_year": "d_year", "i_category_id": "i_category_id", "i_category": "i_category", "sum_sales": "sales"}})


def q43(t, p):
    return (on(dated(t.store_sales, t, "ss_sold_date_sk", f"d_year = {p.year}"), t.store.where("s_gmt_offset = -5"), "ss_store_sk = s_store_sk")
            .groupBy("s_store_name", "s_store_id").agg(*weekday_sums("ss_sales_price")))


DAY_SALES = [f"{d[:3].lower()}_sales" for d in WEEKDAYS]
_add("q43", q43, "s_store_name:s s_store_id:s " + " ".join(f"{d}:d" for d in DAY_SALES), f"SELECT s_store_name, s_store_id, {weekday_sums_sql('ss_sales_price')}" + """
FROM store_sales JOIN store ON s_store_sk = ss_store_sk JOIN date_dim ON d_date_sk = ss_sold_date_sk WHERE d_year = {year} AND s_gmt_offset = -5 GROUP BY ALL""",
     order=", ".join(["s_store_name", "s_store_id", *DAY_SALES]), limit=100, params={"year": 2000})


def q44(t, p):
    here = t.store_sales.where(f"ss_store_sk = {p.store}").select("ss_item_sk", "ss_addr_sk", "ss_net_profit")
    bar = here.where("ss_addr_sk is null").agg(mean("ss_net_profit", "bar"))
    items = one_row(here.groupBy("ss_item_sk").agg(mean("ss_net_profit", "profit")), bar).where("profit > 0.9 * bar").select("ss_item_sk", "profit")

    def ends(order, name):
        # rank < 11 lets Spark keep only the leading rows of each partition before the single-partition rank.
        ranked = items.withColumn("rnk", F.rank().over(W.orderBy(order))).where("rnk < 11")
        return on(ranked, renamed(t.item, f"{name}_", "i_item_sk", "i_product_name"), f"ss_item_sk = {name}_i_item_sk").select(F.col("rnk").alias(f"{name}_rnk"), F.col(f"{name}_i_product_name").alias(f"{name}_performing"))

    return on(ends(F.asc("profit"), "best"), ends(F.desc("profit"), "worst"), "best_rnk = worst_rnk").withColumnRenamed("best_rnk", "rnk")


_add("q44", q44, "rnk:l best_performing:s worst_performing:s", """
WITH items AS (SELECT ss_item_sk AS item, sum(ss_net_profit)::DOUBLE / count(ss_net_profit) AS profit FROM store_sales WHERE ss_store_sk = {store} GROUP BY 1
               HAVING profit > 0.9::DOUBLE * (SELECT sum(ss_net_profit)::DOUBLE / count(ss_net_profit) FROM store_sales WHERE ss_store_sk = {store} AND ss_addr_sk IS NULL)),
places AS (SELECT i_product_name, rank() OVER (ORDER BY profit) AS up, rank() OVER (ORDER BY profit DESC) AS down FROM items JOIN item ON i_item_sk = item)
SELECT a.up AS rnk, a.i_product_name AS best_performing, d.i_product_name AS worst_performing FROM places a JOIN places d ON a.up = d.down WHERE a.up <= 10""",
     order="rnk", limit=100, params={"store": 4}, tried={"store": 10})


def q45(t, p):
    chosen = t.item.where(F.col("i_item_sk").isin(p.items)).select(F.col("i_item_id").alias("chosen")).distinct()
    lines = on(on_days(t.web_sales, t, "ws_sold_date_sk", f"d_qoy = {p.quarter} and d_year = {p.year}"), on(t.item, chosen, "i_item_id = chosen", "left"), "ws_item_sk = i_item_sk")
    lines = on(on(lines, t.customer, "ws_bill_customer_sk = c_customer_sk"), t.customer_address, "c_current_addr_sk = ca_address_sk")
    return lines.where(F.substring("ca_zip", 1, 5).isin(p.zips) | F.col("chosen").isNotNull()).groupBy("ca_zip", "ca_city").agg(total("ws_sales_price", "sales"))


_add("q45", q45, "ca_zip:s ca_city:s sales:d", """
SELECT ca_zip, ca_city, sum(ws_sales_price) AS sales
FROM web_sales JOIN item ON i_item_sk = ws_item_sk JOIN customer ON c_customer_sk = ws_bill_customer_sk JOIN customer_address ON ca_address_sk = c_current_addr_sk JOIN date_dim ON d_date_sk = ws_sold_date_sk
WHERE d_year = {year} AND d_qoy = {quarter} AND (left(ca_zip, 5) IN ({zips}) OR i_item_id IN (SELECT i.i_item_id FROM item i WHERE i.i_item_sk IN ({items})))
GROUP BY ALL""", order="ca_zip, ca_city", limit=100, params={"zips": PUBLISHED_ZIPS, "items": [2, 3, 5, 7, 11, 13, 17, 19, 23, 29], "quarter": 2, "year": 2001}, tried={"zips": ["16330", "41650"]})


def other_city(t, p):
    """q46, q68: tickets bought in another city than the buyer's own."""
    homes = t.household_demographics.where(f"hd_dep_count = {p.dependents} or hd_vehicle_count = {p.vehicles}")
    lines = on_days(t.store_sales, t, "ss_sold_date_sk", f"{p.days} and d_year between {p.year} and {p.year} + 2")
    lines = semi(semi(lines, t.store.where(F.col("s_city").isin(p.cities)), "ss_store_sk = s_store_sk"), homes, "ss_hdemo_sk = hd_demo_sk")
    lines = on(lines, t.customer_address.select("ca_address_sk", F.col("ca_city").alias("bought_city")), "ss_addr_sk = ca_address_sk").drop("ca_address_sk")
    tickets = lines.groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "bought_city").agg(*[total(c, n) for c, n in p.sums])
    people = on(t.customer, t.customer_address, "c_current_addr_sk = ca_address_sk")
    return on(tickets, people, "ss_customer_sk = c_customer_sk and ca_city <> bought_city")


def _other_city_report(key, sums, days, days_sql, cities, order):
    _add(key, other_city, "c_last_name:s c_first_name:s ca_city:s bought_city:s ss_ticket_number:l " + " ".join(f"{n}:d" for _, n in sums),
         "SELECT c_last_name, c_first_name, own.ca_city AS ca_city, b.ca_city AS bought_city, ss_ticket_number, " + ", ".join(f"sum({c}) AS {n}" for c, n in sums) + """
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk JOIN household_demographics ON hd_demo_sk = ss_hdemo_sk
     JOIN customer_address b ON b.ca_address_sk = ss_addr_sk JOIN customer ON c_customer_sk = ss_customer_sk JOIN customer_address own ON own.ca_address_sk = c_current_addr_sk
WHERE b.ca_city <> own.ca_city AND """ + days_sql + """ AND d_year IN ({year}, {year} + 1, {year} + 2) AND s_city IN ({cities}) AND ({dependents} = hd_dep_count OR {vehicles} = hd_vehicle_count)
GROUP BY ss_ticket_number, c_customer_sk, b.ca_address_sk, c_last_name, c_first_name, own.ca_city, b.ca_city""", order=order, limit=100,
         params={"sums": sums, "days": days, "cities": cities, "dependents": 4, "vehicles": 3, "year": 1999})


_other_city_report("q46", [("ss_coupon_amt", "amt"), ("ss_net_profit", "profit")], "d_dow in (6, 0)", "d_day_name IN ('Saturday', 'Sunday')", ["Fairview", "Midway"], "c_last_name, c_first_name, ca_city, bought_city, ss_ticket_number")
_other_city_report("q68", [("ss_ext_sales_price", "extended_price"), ("ss_ext_tax", "extended_tax"), ("ss_ext_list_price", "list_price")], "d_dom between 1 and 2", "d_dom <= 2", ["Midway", "Fairview"], "c_last_name, ss_ticket_number")


def unusual_months(t, p):
    """q47, q57: months that deviate from the year average, with the months before and after.

    The neighbours of rank n in the published text are ranks n-1 and n+1 of a gap-free order, which is what lag and lead read.
    """
    lines = dated(sold(t, p.channel, day="~_sold_date_sk", item="~_item_sk", desk=p.desk_key, price="~_sales_price"), t, "day",
                  f"d_year = {p.year} or (d_year = {p.year} - 1 and d_moy = 12) or (d_year = {p.year} + 1 and d_moy = 1)")
    lines = on(on(lines, t.item, "item = i_item_sk"), t.table(p.desk), f"desk = {p.desk_sk}")
    keys = ["i_category", "i_brand", *p.names]
    months = lines.groupBy(*keys, "d_year", "d_moy").agg(total("price", "sum_sales"))
    line, year = W.partitionBy(*keys).orderBy("d_year", "d_moy"), W.partitionBy(*keys, "d_year")
    months = months.select("*", F.try_divide(F.sum("sum_sales").over(year).cast("double"), F.count("sum_sales").over(year)).alias("avg_monthly_sales"),
                           F.lag("sum_sales").over(line).alias("psum"), F.lead("sum_sales").over(line).alias("nsum"),
                           F.row_number().over(line).alias("n"), F.count("*").over(W.partitionBy(*keys)).alias("of"))
    return months.where(f"d_year = {p.year} and n > 1 and n < of and avg_monthly_sales > 0 and abs(cast(sum_sales as double) - avg_monthly_sales) / avg_monthly_sales > 0.1").withColumn(
        "off", F.expr("cast(sum_sales as double) - avg_monthly_sales"))


def _unusual_report(key, channel, desk, desk_key, desk_sk, names):
    shown, (table, s, *_) = ["i_category", "i_brand", *names], CHANNELS[channel]
    _add(key, unusual_months, " ".join(f"{c}:s" for c in shown) + " d_year:i d_moy:i avg_monthly_sales:d sum_sales:d psum:d nsum:d off:d",
         f"WITH months AS (SELECT {', '.join(shown)}, d_year, d_moy, sum({s}_sales_price) AS v, rank() OVER (PARTITION BY {', '.join(shown)} ORDER BY d_year, d_moy) AS rn,"
         f" sum(sum({s}_sales_price)) OVER y::DOUBLE / count(*) OVER y AS usual\n FROM {table} JOIN item ON i_item_sk = {s}_item_sk JOIN date_dim ON d_date_sk = {s}_sold_date_sk JOIN {desk} ON {desk_sk} = {desk_key}"
         f"\n WHERE (d_year * 12 + d_moy) BETWEEN {{year}} * 12 AND {{year}} * 12 + 13 GROUP BY {', '.join(shown)}, d_year, d_moy WINDOW y AS (PARTITION BY {', '.join(shown)}, d_year))"
         f"\nSELECT {', '.join('m.' + c for c in shown)}, m.d_year, m.d_moy, m.usual AS avg_monthly_sales, m.v AS sum_sales, b.v AS psum, a.v AS nsum, m.v::DOUBLE - m.usual AS off"
         f"\nFROM months m JOIN months b ON {' AND '.join(f'b.{c} = m.{c}' for c in shown)} AND b.rn = m.rn - 1 JOIN months a ON {' AND '.join(f'a.{c} = m.{c}' for c in shown)} AND a.rn = m.rn + 1"
         f"\nWHERE m.d_year = {{year}} AND m.usual > 0 AND abs(m.v::DOUBLE - m.usual) / m.usual > 0.1::DOUBLE", order=f"off, {names[0]}", limit=100,
         params={"channel": channel, "desk": desk, "desk_key": desk_key, "desk_sk": desk_sk, "names": names, "year": 1999})


_unusual_report("q47", "store", "store", "ss_store_sk", "s_store_sk", ["s_store_name", "s_company_name"])
_unusual_report("q57", "catalog", "call_center", "cs_call_center_sk", "cc_call_center_sk", ["cc_name"])


def q48(t, p):
    return demographic_sales(t, p).agg(total("ss_quantity", "sum_quantity"))


_add("q48", q48, "sum_quantity:l", """
WITH people(ms, es, low, high) AS (VALUES ('M', '4 yr Degree', 100, 150), ('D', '2 yr Degree', 50, 100), ('S', 'College', 150, 200)),
places(states, least, most) AS (VALUES (['CO', 'OH', 'TX'], 0, 2000), (['OR', 'MN', 'KY'], 150, 3000), (['VA', 'CA', 'MS', 'TN', 'GA'], 50, 25000))
SELECT sum(ss_quantity) AS sum_quantity
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk AND d_year = {year} JOIN store ON s_store_sk = ss_store_sk JOIN customer_demographics ON cd_demo_sk = ss_cdemo_sk JOIN customer_address ON ca_address_sk = ss_addr_sk
WHERE ca_country = 'United States' AND EXISTS (FROM people WHERE ms = cd_marital_status AND es = cd_education_status AND ss_sales_price >= low AND ss_sales_price <= high)
  AND EXISTS (FROM places WHERE list_contains(states, ca_state) AND ss_net_profit >= least AND ss_net_profit <= most)""",
     params={"year": 2000, "households": False, "people": [("M", "4 yr Degree", 100, 150), ("D", "2 yr Degree", 50, 100), ("S", "College", 150, 200)],
             "places": [(["CO", "OH", "TX"], 0, 2000), (["OR", "MN", "KY"], 150, 3000), (["VA", "CA", "MS"], 50, 25000)]},
     tried={"places": [(["CO", "OH", "TX"], 0, 2000), (["OR", "MN", "KY"], 150, 3000), (["VA", "CA", "MS", "TN", "GA"], 50, 25000)]})


def q49(t, p):
    def channel(name):
        _, s, returns, r, number = CHANNELS[name]
        amount = "cr_return_amount" if r == "cr" else f"{r}_return_amt"
        lines = on_days(t.table(CHANNELS[name][0]).where(f"{s}_net_profit > 1 and {s}_net_paid > 0 and {s}_quantity > 0"), t, f"{s}_sold_date_sk", f"d_year = {p.year} and d_moy in ({', '.join(map(str, p.months))})")
        # The test on the returned amount drops unmatched sales, so the outer join of the text is an inner one.
        lines = on(lines, t.table(returns).where(f"{amount} > {p.least}"), f"{s}_{number} = {r}_{number} and {s}_item_sk = {r}_item_sk")
        items = lines.groupBy(F.col(f"{s}_item_sk").alias("item")).agg(
            ratio(F.sum(F.coalesce(f"{r}_return_quantity", F.lit(0))), F.sum(F.coalesce(f"{s}_quantity", F.lit(0)))).alias("return_ratio"),
            ratio(F.sum(F.coalesce(amount, F.lit(0))), F.sum(F.coalesce(f"{s}_net_paid", F.lit(0)))).alias("currency_ratio"))
        return items.select(F.lit(name).alias("channel"), "item", "return_ratio", "currency_ratio")

    items = functools.reduce(DataFrame.unionByName, [channel(c) for c in ("web", "catalog", "store")])
    # One row per item and measure, so that both ranks of all channels come from one pass.
    measures = items.select("channel", "item", "return_ratio", F.expr("stack(2, 'return', return_ratio, 'currency', currency_ratio) as (measure, ratio)"))
    placed = ranked(measures, ["channel", "measure"], "ratio", "place")
    both = placed.groupBy("channel", "item", "return_ratio").agg(
        *[F.max(F.when(F.col("measure") == m, F.col("place"))).alias(f"{m}_rank") for m in ("return", "currency")])
    return both.where("return_rank <= 10 or currency_rank <= 10").distinct()


def _q49_sql():
    parts = []
    for name in ("web", "catalog", "store"):
        table, s, returns, r, number = CHANNELS[name]
        amount = "cr_return_amount" if r == "cr" else f"{r}_return_amt"
        parts.append(f"SELECT '{name}' AS channel, {s}_item_sk AS item, sum({r}_return_quantity)::DOUBLE / sum({s}_quantity)::DOUBLE AS return_ratio, sum({amount})::DOUBLE / sum({s}_net_paid)::DOUBLE AS currency_ratio "
                     f"FROM {table} JOIN {returns} ON {r}_{number} = {s}_{number} AND {r}_item_sk = {s}_item_sk JOIN date_dim ON d_date_sk = {s}_sold_date_sk "
                     f"WHERE {amount} > {{least}} AND {s}_net_profit > 1 AND {s}_net_paid > 0 AND {s}_quantity > 0 AND d_year = {{year}} AND d_moy IN ({{months}}) GROUP BY 2")
    return ("WITH ratios AS (" + "\nUNION ALL ".join(parts) + """),
placed AS (SELECT channel, item, return_ratio, rank() OVER (PARTITION BY channel ORDER BY return_ratio) AS return_rank, rank() OVER (PARTITION BY channel ORDER BY currency_ratio) AS currency_rank FROM ratios)
SELECT DISTINCT * FROM placed WHERE least(return_rank, currency_rank) <= 10""")


_add("q49", q49, "channel:s item:i return_ratio:d return_rank:l currency_rank:l", _q49_sql(), order="channel, return_rank, currency_rank", limit=100,
     params={"year": 2001, "months": [12], "least": 10000}, tried={"least": 100, "months": [10, 11, 12]})

DELAYS = [("days_30", "delay <= 30"), ("days_31_60", "delay > 30 and delay <= 60"), ("days_61_90", "delay > 60 and delay <= 90"), ("days_91_120", "delay > 90 and delay <= 120"), ("days_over_120", "delay > 120")]
DELAYS_OUT = " ".join(f"{n}:l" for n, _ in DELAYS)


def delays_sql(delay: str) -> str:
    return (f"sum(({delay} <= 30)::INT) AS days_30, " + ", ".join(f"sum(({delay} - {a} BETWEEN 1 AND 30)::INT) AS days_{a + 1}_{a + 30}" for a in (30, 60, 90)) + f", sum(({delay} > 120)::INT) AS days_over_120")


def q50(t, p):
    back = on_days(t.store_returns, t, "sr_returned_date_sk", f"d_year = {p.year} and d_moy = {p.month}")
    lines = on(semi(t.store_sales, t.date_dim, "ss_sold_date_sk = d_date_sk"), back, "ss_ticket_number = sr_ticket_number and ss_item_sk = sr_item_sk and ss_customer_sk = sr_customer_sk")
    # Count per store key; the ten descriptive columns join twelve or a few thousand sums.
    sums = lines.select("ss_store_sk", F.expr("sr_returned_date_sk - ss_sold_date_sk").alias("delay")).groupBy("ss_store_sk").agg(*[tally(c, n) for n, c in DELAYS])
    names = _Q50_NAMES
    return on(sums, t.store, "ss_store_sk = s_store_sk").groupBy(*names).agg(*[total(n, n) for n, _ in DELAYS])


_Q50_NAMES = ["s_store_name", "s_company_id", "s_street_number", "s_street_name", "s_street_type", "s_suite_number", "s_city", "s_county", "s_state", "s_zip"]
_add("q50", q50, " ".join(f"{c}:{'i' if c == 's_company_id' else 's'}" for c in _Q50_NAMES) + " " + DELAYS_OUT, f"SELECT {', '.join(_Q50_NAMES)}, {delays_sql('(sr_returned_date_sk - ss_sold_date_sk)')}" + """
FROM store_sales JOIN store_returns ON sr_customer_sk = ss_customer_sk AND (sr_ticket_number, sr_item_sk) = (ss_ticket_number, ss_item_sk) JOIN store ON s_store_sk = ss_store_sk
     JOIN date_dim a ON a.d_date_sk = ss_sold_date_sk JOIN date_dim b ON b.d_date_sk = sr_returned_date_sk
WHERE b.d_year = {year} AND b.d_moy = {month} GROUP BY ALL""", order=", ".join(_Q50_NAMES), limit=100, params={"year": 2001, "month": 8})
