"""Retail reports 51 to 99 and the column profiles."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.functions.verbs import anti, mean, on, one_row, ratio, renamed, semi, tally, total
from tallyframe.plans.registry import Book, Raw
from tallyframe.plans.tpcds.part1 import SHIP_OUT, _CHANNEL_OUT, _GROWTH_OUT, _people_case, _place_case, brand_report, channel_rollup, growth, shipped_orders
from tallyframe.plans.tpcds.part2 import DELAYS, DELAYS_OUT, delays_sql, ranked_levels
from tallyframe.plans.tpcds.shared import (BUYER, CHANNELS, D, MONTHS, SHORT_DAYS, dated, day_window, on_days, sent_back, sold, take,
                                           weekday_sums, weekday_sums_sql)

BOOK = Book()


def _add(key, build, out, sql, **rest):
    BOOK.add(f"tpcds.{key}", build, out, sql, **rest)


def q51(t, p):
    def running(channel):
        days = dated(sold(t, channel, day="~_sold_date_sk", item="~_item_sk", price="~_sales_price"), t, "day", f"d_month_seq between {p.first} and {p.first} + 11")
        daily = days.where("item is not null").groupBy("item", "d_date").agg(total("price", "price"))
        so_far = W.partitionBy("item").orderBy("d_date").rowsBetween(W.unboundedPreceding, W.currentRow)
        return daily.select(F.col("item").alias("item_sk"), "d_date", F.sum("price").over(so_far).alias(f"{channel}_sales"))

    both = running("web").join(running("store"), ["item_sk", "d_date"], "full")
    so_far = W.partitionBy("item_sk").orderBy("d_date").rowsBetween(W.unboundedPreceding, W.currentRow)
    return both.select("*", *[F.max(f"{c}_sales").over(so_far).alias(f"{c}_cumulative") for c in ("web", "store")]).where("web_cumulative > store_cumulative")


_add("q51", q51, "item_sk:i d_date:s web_sales:d store_sales:d web_cumulative:d store_cumulative:d", """
WITH daily AS (SELECT 'w' AS ch, ws_item_sk AS item_sk, ws_sold_date_sk AS day, ws_sales_price AS price FROM web_sales UNION ALL SELECT 's', ss_item_sk, ss_sold_date_sk, ss_sales_price FROM store_sales),
sums AS (SELECT ch, item_sk, d_date, sum(price) AS price FROM daily JOIN date_dim ON d_date_sk = day WHERE d_month_seq >= {first} AND d_month_seq < {first} + 12 AND item_sk IS NOT NULL GROUP BY ALL),
cume AS (SELECT ch, item_sk, d_date, sum(price) OVER (PARTITION BY ch, item_sk ORDER BY d_date) AS c FROM sums),
flat AS (SELECT item_sk, d_date, max(c) FILTER (WHERE ch = 'w') AS web_sales, max(c) FILTER (WHERE ch = 's') AS store_sales FROM cume GROUP BY ALL)
SELECT *, max(web_sales) OVER w AS web_cumulative, max(store_sales) OVER w AS store_cumulative FROM flat WINDOW w AS (PARTITION BY item_sk ORDER BY d_date)
QUALIFY web_cumulative > store_cumulative""", order="item_sk, d_date", limit=100, params={"first": 1200})

_add("q52", brand_report, "d_year:i brand_id:i brand:s ext_price:d", """
SELECT d_year, i_brand_id AS brand_id, i_brand AS brand, sum(ss_ext_sales_price) AS ext_price FROM store_sales JOIN item ON i_item_sk = ss_item_sk JOIN date_dim ON d_date_sk = ss_sold_date_sk
WHERE {items} AND {days} GROUP BY ALL""", order="d_year, ext_price desc, brand_id", limit=100,
     params={"items": Raw("i_manager_id = 1"), "days": Raw("d_moy = 11 and d_year = 2000"), "keys": ["d_year", "i_brand", "i_brand_id"],
             "shown": {"d_year": "d_year", "brand_id": "i_brand_id", "brand": "i_brand", "ext_price": "sales"}})
_add("q55", brand_report, "brand_id:i brand:s ext_price:d", """
SELECT i_brand_id AS brand_id, i_brand AS brand, sum(ss_ext_sales_price) AS ext_price FROM store_sales JOIN item ON i_item_sk = ss_item_sk JOIN date_dim ON d_date_sk = ss_sold_date_sk
WHERE {items} AND {days} GROUP BY ALL""", order="ext_price desc, brand_id", limit=100,
     params={"items": Raw("i_manager_id = 28"), "days": Raw("d_moy = 11 and d_year = 1999"), "keys": ["i_brand", "i_brand_id"], "shown": {"brand_id": "i_brand_id", "brand": "i_brand", "ext_price": "sales"}})

# Item kinds of the published parameter set.
_KINDS = ("(i_category in ('Books', 'Children', 'Electronics') and i_class in ('personal', 'portable', 'reference', 'self-help') and i_brand in "
          "('scholaramalgamalg #14', 'scholaramalgamalg #7', 'exportiunivamalg #9', 'scholaramalgamalg #9')) or (i_category in ('Women', 'Music', 'Men') and i_class in "
          "('accessories', 'classical', 'fragrances', 'pants') and i_brand in ('amalgimporto #1', 'edu packscholar #1', 'exportiimporto #1', 'importoamalg #1'))")
_KINDS_89 = ("(i_category in ('Books', 'Electronics', 'Sports') and i_class in ('computers', 'stereo', 'football')) or "
             "(i_category in ('Men', 'Jewelry', 'Women') and i_class in ('shirts', 'birdal', 'dresses'))")


def deviating(t, p):
    """q53, q63, q89: period sums that deviate more than 10 % from the average of their group."""
    lines = on(dated(t.store_sales, t, "ss_sold_date_sk", p.days), t.item.where(p.kinds), "ss_item_sk = i_item_sk")
    periods = on(lines, t.store, "ss_store_sk = s_store_sk").groupBy(*p.keys).agg(total("ss_sales_price", "sum_sales"))
    group = W.partitionBy(*p.group)
    periods = periods.withColumn("usual", F.try_divide(F.sum("sum_sales").over(group).cast("double"), F.count("sum_sales").over(group)))
    return periods.where(f"usual {p.test} 0 and abs(cast(sum_sales as double) - usual) / usual > 0.1").select(
        "*", F.col("usual").alias(p.name), F.expr("cast(sum_sales as double) - usual").alias("off"))


def _deviating_report(key, keys, group, name, out, days, kinds, test, order):
    _add(key, deviating, out, f"SELECT *, sum_sales::DOUBLE - {name} AS off FROM (SELECT {', '.join(keys)}, sum(ss_sales_price) AS sum_sales, sum(sum(ss_sales_price)) OVER g::DOUBLE / count(*) OVER g AS {name}\n"
         f"FROM store_sales JOIN item ON i_item_sk = ss_item_sk JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk\nWHERE ({days}) AND ({kinds}) GROUP BY {', '.join(keys)} WINDOW g AS (PARTITION BY {', '.join(group)}))\n"
         f"WHERE {name} {test} 0 AND abs(sum_sales::DOUBLE - {name}) / {name} > 0.1::DOUBLE", order=order, limit=100,
         params={"keys": keys, "group": group, "name": name, "days": days, "kinds": kinds, "test": test})


_YEAR_2000 = "d_month_seq between 1200 and 1211"
_deviating_report("q53", ["i_manufact_id", "d_qoy"], ["i_manufact_id"], "avg_quarterly_sales", "i_manufact_id:i sum_sales:d avg_quarterly_sales:d", _YEAR_2000, _KINDS, ">", "avg_quarterly_sales, sum_sales, i_manufact_id")
_deviating_report("q63", ["i_manager_id", "d_moy"], ["i_manager_id"], "avg_monthly_sales", "i_manager_id:i sum_sales:d avg_monthly_sales:d", _YEAR_2000, _KINDS, ">", "i_manager_id, avg_monthly_sales, sum_sales")
_deviating_report("q89", ["i_category", "i_class", "i_brand", "s_store_name", "s_company_name", "d_moy"], ["i_category", "i_brand", "s_store_name", "s_company_name"], "avg_monthly_sales",
                  "i_category:s i_class:s i_brand:s s_store_name:s s_company_name:s d_moy:i sum_sales:d avg_monthly_sales:d off:d", "d_year = 1999", _KINDS_89, "<>", "off, s_store_name")


def q54(t, p):
    sales = sold(t, "catalog", day="~_sold_date_sk", who=BUYER["catalog"], item="~_item_sk").unionByName(sold(t, "web", day="~_sold_date_sk", who=BUYER["web"], item="~_item_sk"))
    chosen = t.item.where((F.col("i_category") == p.category) & F.col("i_class").isin(p.kinds))
    buyers = semi(on_days(sales, t, "day", f"d_moy = {p.month} and d_year = {p.year}"), chosen, "item = i_item_sk").select("who")
    people = on(semi(t.customer, buyers, "c_customer_sk = who"), t.customer_address, "c_current_addr_sk = ca_address_sk")
    # Stores in the customer's county: the number of matching stores weighs every sale.
    people = on(people, t.store, "ca_county = s_county and ca_state = s_state").groupBy("c_customer_sk").agg(F.count("*").alias("stores"))
    start = t.date_dim.where(f"d_year = {p.year} and d_moy = {p.month}").select(F.col("d_month_seq").alias("m")).distinct()
    months = one_row(t.date_dim.select("d_date_sk", "d_month_seq"), start).where(f"d_month_seq between m + 1 and m + {p.after}")
    lines = semi(t.store_sales, months, "ss_sold_date_sk = d_date_sk")
    revenue = on(lines, people, "ss_customer_sk = c_customer_sk").groupBy("c_customer_sk").agg(total("ss_ext_sales_price * stores", "revenue"))
    segments = revenue.select(F.expr("cast(revenue / 50 as int)").alias("segment")).groupBy("segment").agg(F.count("*").alias("num_customers"))
    return segments.withColumn("segment_base", F.expr("segment * 50"))


_add("q54", q54, "segment:i num_customers:l segment_base:i", """
WITH buyers AS (SELECT DISTINCT who FROM (SELECT cs_sold_date_sk AS day, cs_bill_customer_sk AS who, cs_item_sk AS item FROM catalog_sales UNION ALL SELECT ws_sold_date_sk, ws_bill_customer_sk, ws_item_sk FROM web_sales)
                JOIN item ON i_item_sk = item JOIN date_dim ON d_date_sk = day WHERE i_category = {category} AND i_class IN ({kinds}) AND d_moy = {month} AND d_year = {year}),
revenue AS (SELECT c_customer_sk, sum(ss_ext_sales_price) AS revenue
            FROM customer SEMI JOIN buyers ON who = c_customer_sk JOIN customer_address ON ca_address_sk = c_current_addr_sk JOIN store ON s_county = ca_county AND s_state = ca_state
                 JOIN store_sales ON ss_customer_sk = c_customer_sk JOIN date_dim ON d_date_sk = ss_sold_date_sk
            WHERE d_month_seq - (SELECT max(d_month_seq) FROM date_dim WHERE d_year = {year} AND d_moy = {month}) BETWEEN 1 AND {after} GROUP BY 1)
SELECT trunc(revenue::DOUBLE / 50)::INT AS segment, count(*) AS num_customers, segment * 50 AS segment_base FROM revenue GROUP BY 1""", order="segment, num_customers", limit=100,
     params={"category": "Women", "kinds": ["maternity"], "month": 12, "year": 1998, "after": 3},
     tried={"kinds": ["maternity", "fragrances", "dresses", "swimwear"], "after": 14})


def close_channels(t, p):
    """q58: items whose revenue is within 10 % over three channels in one week."""
    week = t.date_dim.where(F.col("d_date") == p.day).select(F.col("d_week_seq").alias("w"))
    days = semi(t.date_dim, week, f"d_week_seq between w and w + {p.weeks} - 1")

    def revenue(channel):
        s = CHANNELS[channel][1]
        lines = semi(sold(t, channel, day="~_sold_date_sk", item="~_item_sk", amount="~_ext_sales_price"), days, "day = d_date_sk")
        return on(lines, t.item, "item = i_item_sk").groupBy("i_item_id").agg(total("amount", f"{s}_item_rev")).withColumnRenamed("i_item_id", f"{s}_item")

    low, high = 1 - p.within, 1 + p.within
    three = on(on(revenue("store"), revenue("catalog"), "ss_item = cs_item"), revenue("web"), "ss_item = ws_item")
    for a in ("ss", "cs", "ws"):
        for b in ("ss", "cs", "ws"):
            if a != b:
                three = three.where(f"{a}_item_rev between {low} * {b}_item_rev and {high} * {b}_item_rev")
    whole = "cast(ss_item_rev + cs_item_rev + ws_item_rev as double)"
    return take(three, item_id="ss_item", **{n: e for s in ("ss", "cs", "ws") for n, e in ((f"{s}_item_rev", f"{s}_item_rev"), (f"{s}_dev", f"cast({s}_item_rev as double) / {whole} / 3 * 100"))}, average=f"{whole} / 3")


_add("q58", close_channels, "item_id:s ss_item_rev:d ss_dev:d cs_item_rev:d cs_dev:d ws_item_rev:d ws_dev:d average:d", """
WITH days AS (SELECT d_date_sk FROM date_dim WHERE d_week_seq - (SELECT d_week_seq FROM date_dim WHERE d_date = {day}) BETWEEN 0 AND {weeks} - 1),
lines(ch, item, day, v) AS (SELECT 's', ss_item_sk, ss_sold_date_sk, ss_ext_sales_price FROM store_sales UNION ALL SELECT 'c', cs_item_sk, cs_sold_date_sk, cs_ext_sales_price FROM catalog_sales
                            UNION ALL SELECT 'w', ws_item_sk, ws_sold_date_sk, ws_ext_sales_price FROM web_sales),
revs AS (SELECT i_item_id AS item_id, sum(v) FILTER (WHERE ch = 's') AS s, sum(v) FILTER (WHERE ch = 'c') AS c, sum(v) FILTER (WHERE ch = 'w') AS w FROM lines SEMI JOIN days ON d_date_sk = day JOIN item ON i_item_sk = item GROUP BY 1)
SELECT item_id, s AS ss_item_rev, s::DOUBLE / (s + c + w)::DOUBLE / 3 * 100 AS ss_dev, c AS cs_item_rev, c::DOUBLE / (s + c + w)::DOUBLE / 3 * 100 AS cs_dev, w AS ws_item_rev, w::DOUBLE / (s + c + w)::DOUBLE / 3 * 100 AS ws_dev,
       (s + c + w)::DOUBLE / 3 AS average
FROM revs WHERE greatest(s, c, w) <= (1 + {within}) * least(s, c, w) AND least(s, c, w) >= (1 - {within}) * greatest(s, c, w) AND s IS NOT NULL AND c IS NOT NULL AND w IS NOT NULL""",
     order="item_id, ss_item_rev", limit=100, params={"day": D(2000, 1, 3), "within": 0.1, "weeks": 1}, tried={"within": 0.25, "weeks": 156})


def q59(t, p):
    weeks = dated(t.store_sales, t, "ss_sold_date_sk").groupBy("d_week_seq", "ss_store_sk").agg(*weekday_sums("ss_sales_price"))

    def of(first, shown):
        days = t.date_dim.where(f"d_month_seq between {first} and {first} + 11").select(F.col("d_week_seq").alias("w"))
        stores = on(on(weeks, days, "d_week_seq = w"), t.store, "ss_store_sk = s_store_sk")
        return stores.select(F.col("s_store_name").alias(f"s_store_name{shown}"), F.col("s_store_id").alias(f"s_store_id{shown}"), F.col("d_week_seq").alias(f"d_week_seq{shown}"),
                             *[F.col(f"{d}_sales").alias(f"{d}{shown}") for d in SHORT_DAYS])

    both = on(of(p.first, 1), of(p.first + 12, 2), "s_store_id1 = s_store_id2 and d_week_seq1 = d_week_seq2 - 52")
    return both.select("s_store_name1", "s_store_id1", "d_week_seq1", *[ratio(f"{d}1", f"{d}2").alias(f"{d}_ratio") for d in SHORT_DAYS])


_add("q59", q59, "s_store_name1:s s_store_id1:s d_week_seq1:i " + " ".join(f"{d}_ratio:d" for d in SHORT_DAYS), f"""
WITH weeks AS (SELECT s_store_name AS s_store_name1, s_store_id AS s_store_id1, d_week_seq AS wk, {weekday_sums_sql('ss_sales_price')} FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk GROUP BY 1, 2, 3),
copies AS (SELECT d_week_seq AS wk, count(*) FILTER (WHERE d_month_seq - {{first}} BETWEEN 0 AND 11) AS now, count(*) FILTER (WHERE d_month_seq - {{first}} BETWEEN 12 AND 23) AS later FROM date_dim GROUP BY 1)
SELECT s_store_name1, s_store_id1, a.wk AS d_week_seq1, {', '.join(f'a.{d}_sales::DOUBLE / nullif(b.{d}_sales, 0)::DOUBLE AS {d}_ratio' for d in SHORT_DAYS)}
FROM weeks a JOIN weeks b USING (s_store_name1, s_store_id1) JOIN copies ca ON ca.wk = a.wk JOIN copies cb ON cb.wk = b.wk, range(ca.now * cb.later)
WHERE b.wk = a.wk + 52""", order="s_store_name1, s_store_id1, d_week_seq1", limit=100, params={"first": 1212})


def q61(t, p):
    """Promotional share: both totals from one pass; the promotion is a flag on the line."""
    promoted = t.promotion.where("p_channel_dmail = 'Y' or p_channel_email = 'Y' or p_channel_tv = 'Y'").select("p_promo_sk")
    lines = on_days(t.store_sales, t, "ss_sold_date_sk", f"d_year = {p.year} and d_moy = {p.month}")
    lines = semi(semi(lines, t.store.where("s_gmt_offset = -5"), "ss_store_sk = s_store_sk"), t.item.where(F.col("i_category") == p.category), "ss_item_sk = i_item_sk")
    people = semi(t.customer, t.customer_address.where("ca_gmt_offset = -5"), "c_current_addr_sk = ca_address_sk")
    lines = on(semi(lines, people, "ss_customer_sk = c_customer_sk"), promoted, "ss_promo_sk = p_promo_sk", "left")
    sums = lines.agg(F.sum(F.when(F.col("p_promo_sk").isNotNull(), F.col("ss_ext_sales_price"))).alias("promotions"), total("ss_ext_sales_price", "total"))
    return sums.withColumn("percent", ratio("promotions", "total") * 100)


_add("q61", q61, "promotions:d total:d percent:d", """
WITH lines AS (SELECT ss_promo_sk, ss_ext_sales_price AS v FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk AND (d_year, d_moy) = ({year}, {month}) JOIN store ON s_store_sk = ss_store_sk AND s_gmt_offset = -5
                    JOIN customer ON c_customer_sk = ss_customer_sk JOIN customer_address ON ca_address_sk = c_current_addr_sk AND ca_gmt_offset = -5 JOIN item ON i_item_sk = ss_item_sk AND i_category = {category})
SELECT promotions, total, promotions::DOUBLE / total::DOUBLE * 100 AS percent
FROM (SELECT sum(v) AS promotions FROM lines JOIN promotion ON p_promo_sk = ss_promo_sk WHERE p_channel_dmail = 'Y' OR p_channel_email = 'Y' OR p_channel_tv = 'Y'), (SELECT sum(v) AS total FROM lines)""",
     order="promotions, total", limit=100, params={"category": "Jewelry", "year": 1998, "month": 11})


def ship_delays(t, p):
    """q62, q99: shipping delay bands by warehouse, mode and site."""
    lines = on_days(sold(t, p.channel, day="~_sold_date_sk", shipped="~_ship_date_sk", warehouse="~_warehouse_sk", mode="~_ship_mode_sk", desk=p.desk_key), t, "shipped", f"d_month_seq between {p.first} and {p.first} + 11")
    # Count per key triple first: names join the few sums.
    sums = lines.withColumn("delay", F.expr("shipped - day")).groupBy("warehouse", "mode", "desk").agg(*[tally(c, n) for n, c in DELAYS])
    named = on(on(on(sums, t.warehouse, "warehouse = w_warehouse_sk"), t.ship_mode, "mode = sm_ship_mode_sk"), t.table(p.desk), f"desk = {p.desk_sk}")
    return named.groupBy(F.substring("w_warehouse_name", 1, 20).alias("warehouse_name"), "sm_type", p.desk_name).agg(*[total(n, n) for n, _ in DELAYS])


for _key, _channel, _desk, _desk_key, _desk_sk, _desk_name in (("q62", "web", "web_site", "ws_web_site_sk", "web_site_sk", "web_name"), ("q99", "catalog", "call_center", "cs_call_center_sk", "cc_call_center_sk", "cc_name")):
    _table, _s, *_ = CHANNELS[_channel]
    _add(_key, ship_delays, f"warehouse_name:s sm_type:s {_desk_name}:s {DELAYS_OUT}", f"SELECT left(w_warehouse_name, 20) AS warehouse_name, sm_type, {_desk_name}, {delays_sql(f'({_s}_ship_date_sk - {_s}_sold_date_sk)')}\n"
         f"FROM {_table} JOIN warehouse ON w_warehouse_sk = {_s}_warehouse_sk JOIN ship_mode ON sm_ship_mode_sk = {_s}_ship_mode_sk JOIN {_desk} ON {_desk_sk} = {_desk_key} JOIN date_dim ON d_date_sk = {_s}_ship_date_sk\n"
         "WHERE d_month_seq >= {first} AND d_month_seq < {first} + 12 GROUP BY ALL", order=f"warehouse_name, sm_type, {_desk_name}", limit=100,
         params={"channel": _channel, "desk": _desk, "desk_key": _desk_key, "desk_sk": _desk_sk, "desk_name": _desk_name, "first": 1200})


def q64(t, p):
    refunds = on(t.catalog_sales.select("cs_item_sk", "cs_order_number", "cs_ext_list_price"), t.catalog_returns, "cs_item_sk = cr_item_sk and cs_order_number = cr_order_number")
    profitable = refunds.groupBy(F.col("cs_item_sk").alias("good_item")).agg(total("cs_ext_list_price", "sale"), total("cr_refunded_cash + cr_reversed_charge + cr_store_credit", "refund")).where("sale > 2 * refund")
    items = t.item.where(F.col("i_color").isin(p.colors)).where(f"i_current_price between {p.price} and {p.price} + {p.width} and i_current_price between {p.price} + 1 and {p.price} + {p.width} + 5")
    items = semi(items, profitable, "i_item_sk = good_item").select("i_item_sk", "i_product_name")
    homes = semi(t.household_demographics, t.income_band, "hd_income_band_sk = ib_income_band_sk").select("hd_demo_sk")

    def address(prefix):
        return renamed(t.customer_address, prefix, "ca_address_sk", "ca_street_number", "ca_street_name", "ca_city", "ca_zip")

    lines = on(on(t.store_sales, t.date_dim.where(f"d_year in ({p.year}, {p.year} + 1)").select("d_date_sk", F.col("d_year").alias("syear")), "ss_sold_date_sk = d_date_sk").drop("d_date_sk"), items, "ss_item_sk = i_item_sk")
    lines = semi(lines, t.store_returns, "ss_item_sk = sr_item_sk and ss_ticket_number = sr_ticket_number") if p.single_return else on(
        lines, t.store_returns.select("sr_item_sk", "sr_ticket_number"), "ss_item_sk = sr_item_sk and ss_ticket_number = sr_ticket_number")
    lines = semi(semi(lines, homes, "ss_hdemo_sk = hd_demo_sk"), t.promotion, "ss_promo_sk = p_promo_sk")
    lines = on(on(lines, t.customer, "ss_customer_sk = c_customer_sk"), t.store.select("s_store_sk", "s_store_name", "s_zip"), "ss_store_sk = s_store_sk")
    lines = semi(lines, homes, "c_current_hdemo_sk = hd_demo_sk")
    for role, key in (("fs", "c_first_sales_date_sk"), ("s2", "c_first_shipto_date_sk")):
        lines = on(lines, t.date_dim.select(F.col("d_date_sk").alias(f"{role}_sk"), F.col("d_year").alias(f"{role}year")), f"{key} = {role}_sk")
    lines = on(lines, renamed(t.customer_demographics, "then_", "cd_demo_sk", "cd_marital_status"), "ss_cdemo_sk = then_cd_demo_sk")
    lines = on(lines, renamed(t.customer_demographics, "now_", "cd_demo_sk", "cd_marital_status"), "c_current_cdemo_sk = now_cd_demo_sk and then_cd_marital_status <> now_cd_marital_status")
    lines = on(on(lines, address("b_"), "ss_addr_sk = b_ca_address_sk"), address("c_"), "c_current_addr_sk = c_ca_address_sk")
    place = [f"{r}_ca_{c}" for r in ("b", "c") for c in ("street_number", "street_name", "city", "zip")]
    groups = lines.groupBy("i_product_name", "i_item_sk", "s_store_name", "s_zip", *place, "syear", "fsyear", "s2year").agg(
        F.count("*").alias("cnt"), total("ss_wholesale_cost", "s1"), total("ss_list_price", "s2"), total("ss_coupon_amt", "s3"))
    first = groups.where(f"syear = {p.year}")
    second = renamed(groups.where(f"syear = {p.year} + 1"), "next_", "i_item_sk", "s_store_name", "s_zip", "syear", "cnt", "s1", "s2", "s3")
    return on(first, second, "i_item_sk = next_i_item_sk and s_store_name = next_s_store_name and s_zip = next_s_zip and next_cnt <= cnt").withColumnsRenamed({
        "i_product_name": "product_name", "s_store_name": "store_name", "s_zip": "store_zip", **{f"{r}_ca_{c}": f"{r}_{c}" for r in ("b", "c") for c in ("street_number", "street_name", "city", "zip")}})


_Q64_PLACE = [f"{r}_{c}" for r in ("b", "c") for c in ("street_number", "street_name", "city", "zip")]
_add("q64", q64, "product_name:s store_name:s store_zip:s " + " ".join(f"{c}:s" for c in _Q64_PLACE) + " syear:i cnt:l s1:d s2:d s3:d next_s1:d next_s2:d next_s3:d next_syear:i next_cnt:l", """
WITH good AS (SELECT cs_item_sk FROM catalog_sales JOIN catalog_returns ON (cr_item_sk, cr_order_number) = (cs_item_sk, cs_order_number) GROUP BY 1 HAVING sum(cs_ext_list_price) > 2 * sum(cr_refunded_cash + cr_reversed_charge + cr_store_credit)),
homes AS (SELECT hd_demo_sk FROM household_demographics JOIN income_band ON ib_income_band_sk = hd_income_band_sk),
sales AS (SELECT i_product_name AS product_name, i_item_sk, s_store_name AS store_name, s_zip AS store_zip, """ + ", ".join(f"{r}.ca_{c} AS {r}_{c}" for r in ("b", "c") for c in ("street_number", "street_name", "city", "zip")) + """,
                 d1.d_year AS syear, d2.d_year AS fsyear, d3.d_year AS s2year, count(*) AS cnt, sum(ss_wholesale_cost) AS s1, sum(ss_list_price) AS s2, sum(ss_coupon_amt) AS s3
          FROM store_sales JOIN store_returns ON (sr_item_sk, sr_ticket_number) = (ss_item_sk, ss_ticket_number) JOIN item ON i_item_sk = ss_item_sk SEMI JOIN good ON cs_item_sk = ss_item_sk JOIN store ON s_store_sk = ss_store_sk
               JOIN customer ON c_customer_sk = ss_customer_sk JOIN promotion ON p_promo_sk = ss_promo_sk JOIN homes h1 ON h1.hd_demo_sk = ss_hdemo_sk JOIN homes h2 ON h2.hd_demo_sk = c_current_hdemo_sk
               JOIN customer_demographics p1 ON p1.cd_demo_sk = ss_cdemo_sk JOIN customer_demographics p2 ON p2.cd_demo_sk = c_current_cdemo_sk AND p2.cd_marital_status <> p1.cd_marital_status
               JOIN customer_address b ON b.ca_address_sk = ss_addr_sk JOIN customer_address c ON c.ca_address_sk = c_current_addr_sk
               JOIN date_dim d1 ON d1.d_date_sk = ss_sold_date_sk JOIN date_dim d2 ON d2.d_date_sk = c_first_sales_date_sk JOIN date_dim d3 ON d3.d_date_sk = c_first_shipto_date_sk
          WHERE i_color IN ({colors}) AND i_current_price BETWEEN {price} + 1 AND {price} + {width} GROUP BY ALL)
SELECT o.*, n.s1 AS next_s1, n.s2 AS next_s2, n.s3 AS next_s3, n.syear AS next_syear, n.cnt AS next_cnt
FROM sales o JOIN sales n ON (n.i_item_sk, n.store_name, n.store_zip) = (o.i_item_sk, o.store_name, o.store_zip) AND n.cnt <= o.cnt WHERE o.syear = {year} AND n.syear = {year} + 1""",
     order="product_name, store_name, next_cnt", params={"colors": ["purple", "burlywood", "indian", "spring", "floral", "medium"], "price": 64, "width": 10, "year": 1999, "single_return": False},
     tried={"price": 1, "width": 97, "colors": ["purple", "burlywood", "indian", "spring", "floral", "medium", "pale", "snow", "cyan", "deep"]})


def q65(t, p):
    lines = on_days(t.store_sales, t, "ss_sold_date_sk", f"d_month_seq between {p.first} and {p.first} + 11")
    revenue = lines.groupBy("ss_store_sk", "ss_item_sk").agg(total("ss_sales_price", "revenue"))
    usual = revenue.groupBy(F.col("ss_store_sk").alias("k")).agg(mean("revenue", "usual"))
    poor = on(revenue, usual, "ss_store_sk = k").where(f"revenue <= {p.share} * usual")
    return on(on(poor, t.store, "ss_store_sk = s_store_sk"), t.item, "ss_item_sk = i_item_sk")


_add("q65", q65, "s_store_name:s i_item_desc:s revenue:d i_current_price:d i_wholesale_cost:d i_brand:s", """
WITH r AS (SELECT ss_store_sk AS s, ss_item_sk AS i, sum(ss_sales_price) AS revenue, sum(sum(ss_sales_price)) OVER w::DOUBLE / count(sum(ss_sales_price)) OVER w AS usual FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk
           WHERE d_month_seq >= {first} AND d_month_seq < {first} + 12 GROUP BY ss_store_sk, ss_item_sk WINDOW w AS (PARTITION BY ss_store_sk))
SELECT s_store_name, i_item_desc, revenue, i_current_price, i_wholesale_cost, i_brand FROM r JOIN store ON s_store_sk = s JOIN item ON i_item_sk = i WHERE revenue <= {share}::DOUBLE * usual""",
     order="s_store_name, i_item_desc", limit=100, params={"first": 1176, "share": 0.1})

_W = ["w_warehouse_name", "w_warehouse_sq_ft", "w_city", "w_county", "w_state", "w_country"]


def q66(t, p):
    def channel(name, sale, net):
        lines = sold(t, name, day="~_sold_date_sk", moment="~_sold_time_sk", warehouse="~_warehouse_sk", mode="~_ship_mode_sk", sale=f"{sale} * ~_quantity", net=f"{net} * ~_quantity")
        lines = semi(semi(lines, t.ship_mode.where(F.col("sm_carrier").isin(p.carriers)), "mode = sm_ship_mode_sk"), t.time_dim.where(f"t_time between {p.since} and {p.since} + 28800"), "moment = t_time_sk")
        return dated(lines, t, "day", f"d_year = {p.year}").select("warehouse", "d_year", "d_moy", "sale", "net")

    lines = channel("web", "~_ext_sales_price", "~_net_paid").unionByName(channel("catalog", "~_sales_price", "~_net_paid_inc_tax"))
    sums = lines.groupBy("warehouse", "d_year").agg(*[F.sum(F.when(F.col("d_moy") == i, F.col(v)).otherwise(0)).alias(f"{m}_{n}") for v, n in (("sale", "sales"), ("net", "net")) for i, m in enumerate(MONTHS, 1)])
    return on(sums, t.warehouse, "warehouse = w_warehouse_sk").select(
        *_W, F.lit(",".join(p.carriers)).alias("ship_carriers"), F.col("d_year").alias("year"), *[f"{m}_sales" for m in MONTHS],
        *[ratio(f"{m}_sales", "w_warehouse_sq_ft").alias(f"{m}_sales_per_sq_foot") for m in MONTHS], *[f"{m}_net" for m in MONTHS])


_add("q66", q66, " ".join(f"{c}:{'i' if c.endswith('ft') else 's'}" for c in _W) + " ship_carriers:s year:i " + " ".join(f"{m}_sales:d" for m in MONTHS) + " "
     + " ".join(f"{m}_sales_per_sq_foot:d" for m in MONTHS) + " " + " ".join(f"{m}_net:d" for m in MONTHS), """
WITH lines(w, day, moment, mode, sale, net) AS (SELECT ws_warehouse_sk, ws_sold_date_sk, ws_sold_time_sk, ws_ship_mode_sk, ws_ext_sales_price * ws_quantity, ws_net_paid * ws_quantity FROM web_sales
                       UNION ALL SELECT cs_warehouse_sk, cs_sold_date_sk, cs_sold_time_sk, cs_ship_mode_sk, cs_sales_price * cs_quantity, cs_net_paid_inc_tax * cs_quantity FROM catalog_sales)
SELECT """ + ", ".join(_W) + ", 'DHL,BARIAN' AS ship_carriers, d_year AS year, " + ", ".join(f"sum(if(d_moy = {i}, sale, 0)) AS {m}_sales, sum(if(d_moy = {i}, sale, 0))::DOUBLE / w_warehouse_sq_ft AS {m}_sales_per_sq_foot, sum(if(d_moy = {i}, net, 0)) AS {m}_net" for i, m in enumerate(MONTHS, 1)) + """
FROM lines JOIN warehouse ON w_warehouse_sk = w JOIN date_dim ON d_date_sk = day JOIN time_dim ON t_time_sk = moment JOIN ship_mode ON sm_ship_mode_sk = mode
WHERE d_year = {year} AND t_time >= {since} AND t_time <= {since} + 28800 AND sm_carrier IN ({carriers}) GROUP BY """ + ", ".join(_W) + ", d_year",
     order="w_warehouse_name", limit=100, params={"carriers": ["DHL", "BARIAN"], "year": 2001, "since": 30838})

_Q67 = ["i_category", "i_class", "i_brand", "i_product_name", "d_year", "d_qoy", "d_moy", "s_store_id"]


def q67(t, p):
    lines = dated(t.store_sales, t, "ss_sold_date_sk", f"d_month_seq between {p.first} and {p.first} + 11")
    # Sums per item, day-month and store before the rollup multiplies rows by nine.
    base = lines.groupBy("ss_item_sk", "d_year", "d_qoy", "d_moy", "ss_store_sk").agg(total("coalesce(ss_sales_price * ss_quantity, 0)", "amount"))
    base = on(on(base, t.item, "ss_item_sk = i_item_sk"), t.store, "ss_store_sk = s_store_sk")
    sums = base.rollup(*_Q67).agg(total("amount", "sumsales"))
    return sums.withColumn("rk", F.rank().over(W.partitionBy("i_category").orderBy(F.desc("sumsales")))).where("rk <= 100")


_add("q67", q67, " ".join(f"{c}:{'i' if c.startswith('d_') else 's'}" for c in _Q67) + " sumsales:d rk:l", f"SELECT {', '.join(_Q67)}, sumsales, rank() OVER (PARTITION BY i_category ORDER BY sumsales DESC) AS rk FROM (SELECT {', '.join(_Q67)}, " + """sum(ifnull(ss_sales_price * ss_quantity, 0)) AS sumsales
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk JOIN item ON i_item_sk = ss_item_sk
WHERE d_month_seq >= {first} AND d_month_seq < {first} + 12 GROUP BY ROLLUP (""" + ", ".join(_Q67) + ")) QUALIFY rk <= 100", order=", ".join(_Q67) + ", sumsales, rk", limit=100, params={"first": 1200})

_Q69 = ["cd_gender", "cd_marital_status", "cd_education_status", "cd_purchase_estimate", "cd_credit_rating"]


def q69(t, p):
    days = f"d_year = {p.year} and d_moy between {p.month} and {p.month} + 2"

    def who(channel, key):
        return on_days(sold(t, channel, who=key, day="~_sold_date_sk"), t, "day", days).select("who")

    people = semi(t.customer, t.customer_address.where(F.col("ca_state").isin(p.states)), "c_current_addr_sk = ca_address_sk")
    people = semi(people, who("store", "ss_customer_sk"), "c_customer_sk = who")
    people = anti(people, who("web", "ws_bill_customer_sk").unionByName(who("catalog", "cs_ship_customer_sk")), "c_customer_sk = who")
    groups = on(people, t.customer_demographics, "c_current_cdemo_sk = cd_demo_sk").groupBy(*_Q69).agg(F.count("*").alias("cnt1"))
    return groups.select("*", F.col("cnt1").alias("cnt2"), F.col("cnt1").alias("cnt3"))


_add("q69", q69, "cd_gender:s cd_marital_status:s cd_education_status:s cnt1:l cd_purchase_estimate:i cnt2:l cd_credit_rating:s cnt3:l", f"SELECT {', '.join(_Q69)}, count(*) AS cnt1, count(*) AS cnt2, count(*) AS cnt3" + """
FROM customer JOIN customer_address ON ca_address_sk = c_current_addr_sk AND ca_state IN ({states}) JOIN customer_demographics ON cd_demo_sk = c_current_cdemo_sk
WHERE EXISTS (FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk WHERE ss_customer_sk = c_customer_sk AND d_year = {year} AND d_moy - {month} IN (0, 1, 2))
  AND NOT EXISTS (FROM web_sales JOIN date_dim ON d_date_sk = ws_sold_date_sk WHERE ws_bill_customer_sk = c_customer_sk AND d_year = {year} AND d_moy - {month} IN (0, 1, 2))
  AND NOT EXISTS (FROM catalog_sales JOIN date_dim ON d_date_sk = cs_sold_date_sk WHERE cs_ship_customer_sk = c_customer_sk AND d_year = {year} AND d_moy - {month} IN (0, 1, 2))
GROUP BY ALL""", order=", ".join(_Q69), limit=100, params={"states": ["KY", "GA", "NM"], "year": 2001, "month": 4})


def q70(t, p):
    lines = on(on_days(t.store_sales, t, "ss_sold_date_sk", f"d_month_seq between {p.first} and {p.first} + 11"), t.store, "ss_store_sk = s_store_sk").select("s_state", "s_county", "ss_net_profit")
    # The text ranks each state within its own partition, so that every state with a sale is ranked first.
    best = lines.groupBy("s_state").agg(total("ss_net_profit", "profit")).withColumn("ranking", F.rank().over(W.partitionBy("s_state").orderBy(F.desc("profit")))).where("ranking <= 5").select(F.col("s_state").alias("best"))
    groups = semi(lines, best, "s_state = best").rollup("s_state", "s_county").agg(total("ss_net_profit", "total_sum"), F.grouping("s_state").alias("g_parent"), F.grouping("s_county").alias("g_child"))
    return ranked_levels(groups, "s_state", "s_county", "total_sum", down=True)


_LEVELS_SQL = """
SELECT total_sum, #a, #b, lv AS lochierarchy, rank() OVER (PARTITION BY lv, CASE WHEN lv = 0 THEN #a END ORDER BY total_sum DESC) AS rank_within_parent
FROM (SELECT sum(@) AS total_sum, #a, #b, grouping(#a) + grouping(#b) AS lv FROM $ WHERE d_month_seq >= {first} AND d_month_seq < {first} + 12 GROUP BY ROLLUP (#a, #b))"""


def _levels_sql(measure, parent, child, source):
    return _LEVELS_SQL.replace("#a", parent).replace("#b", child).replace("@", measure).replace("$", source)


_add("q70", q70, "total_sum:d s_state:s s_county:s lochierarchy:i rank_within_parent:l",
     _levels_sql("ss_net_profit", "s_state", "s_county", "store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk AND s_state IS NOT NULL"), order="lochierarchy desc, s_state, rank_within_parent", limit=100, params={"first": 1200})


def q86(t, p):
    lines = on(on_days(t.web_sales, t, "ws_sold_date_sk", f"d_month_seq between {p.first} and {p.first} + 11"), t.item, "ws_item_sk = i_item_sk")
    groups = lines.rollup("i_category", "i_class").agg(total("ws_net_paid", "total_sum"), F.grouping("i_category").alias("g_parent"), F.grouping("i_class").alias("g_child"))
    return ranked_levels(groups, "i_category", "i_class", "total_sum", down=True)


_add("q86", q86, "total_sum:d i_category:s i_class:s lochierarchy:i rank_within_parent:l", _levels_sql("ws_net_paid", "i_category", "i_class", "web_sales JOIN date_dim ON d_date_sk = ws_sold_date_sk JOIN item ON i_item_sk = ws_item_sk"),
     order="lochierarchy desc, i_category, rank_within_parent", limit=100, params={"first": 1200})


def q71(t, p):
    lines = functools.reduce(DataFrame.unionByName, [sold(t, c, day="~_sold_date_sk", moment="~_sold_time_sk", item="~_item_sk", price="~_ext_sales_price") for c in CHANNELS])
    lines = on(on_days(lines, t, "day", f"d_moy = {p.month} and d_year = {p.year}"), t.item.where(F.col("i_manager_id").isin(p.managers)), "item = i_item_sk")
    lines = on(lines, t.time_dim.where("t_meal_time in ('breakfast', 'dinner')"), "moment = t_time_sk")
    return lines.groupBy("i_brand", "i_brand_id", "t_hour", "t_minute").agg(total("price", "ext_price")).withColumnsRenamed({"i_brand": "brand", "i_brand_id": "brand_id"})


_add("q71", q71, "brand_id:i brand:s t_hour:i t_minute:i ext_price:d", """
SELECT i_brand_id AS brand_id, i_brand AS brand, t_hour, t_minute, sum(price) AS ext_price
FROM (SELECT ss_sold_date_sk AS day, ss_sold_time_sk AS moment, ss_item_sk AS item, ss_ext_sales_price AS price FROM store_sales UNION ALL SELECT cs_sold_date_sk, cs_sold_time_sk, cs_item_sk, cs_ext_sales_price FROM catalog_sales
      UNION ALL SELECT ws_sold_date_sk, ws_sold_time_sk, ws_item_sk, ws_ext_sales_price FROM web_sales) JOIN date_dim ON d_date_sk = day JOIN time_dim ON t_time_sk = moment JOIN item ON i_item_sk = item
WHERE d_moy = {month} AND d_year = {year} AND i_manager_id IN ({managers}) AND t_meal_time <> 'lunch' GROUP BY ALL""", order="ext_price desc, brand_id", params={"month": 11, "year": 1999, "managers": [1]}, tried={"managers": list(range(1, 11))})


def q72(t, p):
    orders = on(t.catalog_sales, t.date_dim.where(f"d_year = {p.year}").select("d_date_sk", "d_week_seq", F.col("d_date").alias("sold_on")), "cs_sold_date_sk = d_date_sk").drop("d_date_sk")
    orders = semi(semi(orders, t.customer_demographics.where(F.col("cd_marital_status") == p.marital), "cs_bill_cdemo_sk = cd_demo_sk"), t.household_demographics.where(F.col("hd_buy_potential") == p.potential), "cs_bill_hdemo_sk = hd_demo_sk")
    orders = on(orders, t.date_dim.select("d_date_sk", F.col("d_date").alias("shipped_on")), "cs_ship_date_sk = d_date_sk and shipped_on > date_add(sold_on, 5)").drop("d_date_sk")
    # Only counts of weeks in which orders can be.
    weeks = semi(t.date_dim.select("d_date_sk", F.col("d_week_seq").alias("stock_week")), t.date_dim.where(f"d_year = {p.year}").select("d_week_seq"), "stock_week = d_week_seq")
    # No order asks for more than the most that was ever sold at once: counts above that need no shuffle.
    most = t.catalog_sales.agg(F.max("cs_quantity")).scalar()
    stock = on(t.inventory.where(F.col("inv_quantity_on_hand") < most), weeks, "inv_date_sk = d_date_sk").drop("d_date_sk")
    # Item and week together are the join key: an order meets the counts of its own week only.
    short = on(orders, stock, "cs_item_sk = inv_item_sk and d_week_seq = stock_week and inv_quantity_on_hand < cs_quantity")
    short = on(short, t.promotion.select("p_promo_sk"), "cs_promo_sk = p_promo_sk", "left")
    short = on(short, t.catalog_returns.select("cr_item_sk", "cr_order_number"), "cr_item_sk = cs_item_sk and cr_order_number = cs_order_number", "left")
    sums = short.groupBy("cs_item_sk", "inv_warehouse_sk", "d_week_seq").agg(tally("p_promo_sk is null", "no_promo"), tally("p_promo_sk is not null", "promo"), F.count("*").alias("total_cnt"))
    named = on(on(sums, t.warehouse, "w_warehouse_sk = inv_warehouse_sk"), t.item, "i_item_sk = cs_item_sk")
    return named.groupBy("i_item_desc", "w_warehouse_name", "d_week_seq").agg(*[total(c, c) for c in ("no_promo", "promo", "total_cnt")])


_add("q72", q72, "i_item_desc:s w_warehouse_name:s d_week_seq:i no_promo:l promo:l total_cnt:l", """
SELECT i_item_desc, w_warehouse_name, a.d_week_seq, count(*) - count(p_promo_sk) AS no_promo, count(p_promo_sk) AS promo, count(*) AS total_cnt
FROM catalog_sales JOIN date_dim a ON a.d_date_sk = cs_sold_date_sk JOIN date_dim s ON s.d_date_sk = cs_ship_date_sk AND s.d_date > a.d_date + 5
     JOIN date_dim b ON b.d_week_seq = a.d_week_seq JOIN inventory ON inv_date_sk = b.d_date_sk AND inv_item_sk = cs_item_sk AND inv_quantity_on_hand < cs_quantity
     JOIN warehouse ON w_warehouse_sk = inv_warehouse_sk JOIN item ON i_item_sk = cs_item_sk JOIN customer_demographics ON cd_demo_sk = cs_bill_cdemo_sk JOIN household_demographics ON hd_demo_sk = cs_bill_hdemo_sk
     LEFT JOIN promotion ON p_promo_sk = cs_promo_sk LEFT JOIN catalog_returns ON cr_item_sk = cs_item_sk AND cr_order_number = cs_order_number
WHERE a.d_year = {year} AND cd_marital_status = {marital} AND hd_buy_potential = {potential} GROUP BY ALL""", order="total_cnt desc, i_item_desc, w_warehouse_name, d_week_seq", limit=100,
     params={"year": 1999, "marital": "D", "potential": ">10000"})

BOOK.add("tpcds.q74", **growth("q74", "q74", ["web", "store"], _GROWTH_OUT[:3]))


def q75(t, p):
    def channel(name):
        _, s, returns, r, number = CHANNELS[name]
        amount = "cr_return_amount" if r == "cr" else f"{r}_return_amt"
        lines = dated(t.table(CHANNELS[name][0]), t, f"{s}_sold_date_sk", f"d_year in ({p.year} - 1, {p.year})").select("d_year", f"{s}_item_sk", f"{s}_{number}", f"{s}_quantity", f"{s}_ext_sales_price")
        lines = on(lines, t.item.where(F.col("i_category") == p.category), f"{s}_item_sk = i_item_sk")
        lines = on(lines, t.table(returns).select(f"{r}_item_sk", f"{r}_{number}", f"{r}_return_quantity", amount), f"{s}_{number} = {r}_{number} and {s}_item_sk = {r}_item_sk", "left")
        return take(lines, **{c: c for c in _Q75}, sales_cnt=f"{s}_quantity - coalesce({r}_return_quantity, 0)", sales_amt=f"{s}_ext_sales_price - coalesce({amount}, 0)")

    # UNION of the text removes equal detail rows, within and across channels.
    rows = functools.reduce(DataFrame.unionByName, [channel(c) for c in CHANNELS]).distinct()
    years = rows.groupBy(*_Q75).agg(total("sales_cnt", "cnt"), total("sales_amt", "amt"))
    now, then = years.where(f"d_year = {p.year}"), renamed(years.where(f"d_year = {p.year} - 1"), "prev_", *_Q75, "cnt", "amt")
    both = on(now, then, " and ".join(f"{c} = prev_{c}" for c in _Q75[1:])).where("cast(cnt as double) / nullif(cast(prev_cnt as double), 0) < 0.9")
    return take(both, prev_year="prev_d_year", year="d_year", **{c: c for c in _Q75[1:]}, prev_yr_cnt="prev_cnt", curr_yr_cnt="cnt", sales_cnt_diff="cnt - prev_cnt", sales_amt_diff="amt - prev_amt")


_Q75 = ["d_year", "i_brand_id", "i_class_id", "i_category_id", "i_manufact_id"]


def _q75_sql():
    parts = []
    for name, (table, s, returns, r, number) in CHANNELS.items():
        amount = "cr_return_amount" if r == "cr" else f"{r}_return_amt"
        parts.append(f"SELECT {', '.join(_Q75)}, {s}_quantity - ifnull({r}_return_quantity, 0) AS c, {s}_ext_sales_price - ifnull({amount}, 0) AS a FROM {table} JOIN item ON i_item_sk = {s}_item_sk AND i_category = {{category}} "
                     f"JOIN date_dim ON d_date_sk = {s}_sold_date_sk LEFT JOIN {returns} ON ({r}_{number}, {r}_item_sk) = ({s}_{number}, {s}_item_sk)")
    return "WITH detail AS (" + "\nUNION ".join(parts) + f"""),
years AS (SELECT {', '.join(_Q75)}, sum(c) AS c, sum(a) AS a FROM detail GROUP BY ALL)
SELECT o.d_year AS prev_year, n.d_year AS year, {', '.join('n.' + c for c in _Q75[1:])}, o.c AS prev_yr_cnt, n.c AS curr_yr_cnt, n.c - o.c AS sales_cnt_diff, n.a - o.a AS sales_amt_diff
FROM years n JOIN years o ON {' AND '.join(f'o.{c} = n.{c}' for c in _Q75[1:])} AND n.d_year = {{year}} AND o.d_year = {{year}} - 1 WHERE n.c::DOUBLE / nullif(o.c, 0)::DOUBLE < 0.9::DOUBLE"""


_add("q75", q75, "prev_year:i year:i i_brand_id:i i_class_id:i i_category_id:i i_manufact_id:i prev_yr_cnt:l curr_yr_cnt:l sales_cnt_diff:l sales_amt_diff:d", _q75_sql(), order="sales_cnt_diff", limit=100, params={"category": "Books", "year": 2002})


def q76(t, p):
    rows = [sold(t, c, channel=f"'{c}'", missing=k, day="~_sold_date_sk", item="~_item_sk", price="~_ext_sales_price").where("missing is null")
            for c, k in (("store", "ss_store_sk"), ("web", "ws_ship_customer_sk"), ("catalog", "cs_ship_addr_sk"))]
    lines = on(dated(functools.reduce(DataFrame.unionByName, rows), t, "day"), t.item, "item = i_item_sk")
    return lines.groupBy("channel", F.col("missing").alias("col_name"), "d_year", "d_qoy", "i_category").agg(F.count("*").alias("sales_cnt"), total("price", "sales_amt"))


_add("q76", q76, "channel:s col_name:i d_year:i d_qoy:i i_category:s sales_cnt:l sales_amt:d", """
SELECT channel, col_name, d_year, d_qoy, i_category, count(*) AS sales_cnt, sum(price) AS sales_amt
FROM (SELECT 'store' AS channel, ss_store_sk AS col_name, ss_sold_date_sk AS day, ss_item_sk AS item, ss_ext_sales_price AS price FROM store_sales UNION ALL SELECT 'web', ws_ship_customer_sk, ws_sold_date_sk, ws_item_sk, ws_ext_sales_price FROM web_sales
      UNION ALL SELECT 'catalog', cs_ship_addr_sk, cs_sold_date_sk, cs_item_sk, cs_ext_sales_price FROM catalog_sales) JOIN date_dim ON d_date_sk = day JOIN item ON i_item_sk = item
WHERE col_name IS NULL GROUP BY ALL""", order="channel, col_name, d_year, d_qoy, i_category", limit=100)


def q77(t, p):
    days = day_window(p.day, 30)

    def per(df, key, names, place=None, sk=None):
        df = on_days(df, t, "day", days)
        df = df if place is None else semi(df, place, f"{key} = {sk}")
        return df.groupBy(key).agg(*[total(c, n) for c, n in names.items()])

    def matched(channel, key, place, sk):
        amount = "~_return_amt"
        out = per(sold(t, channel, day="~_sold_date_sk", place=key, sale="~_ext_sales_price", gain="~_net_profit"), "place", {"sale": "sales", "gain": "gain"}, place, sk)
        back = per(sent_back(t, channel, day="~_returned_date_sk", back_place=key, back=amount, loss="~_net_loss"), "back_place", {"back": "returns", "loss": "loss"}, place, sk)
        return take(on(out, back, "place = back_place", "left"), channel=f"'{channel} channel'", id="place", sales="sales", returns="coalesce(returns, 0)", profit="gain - coalesce(loss, 0)")

    # Catalog: the text pairs every sales row with every returns row. Summed per sales row that is
    # sales * n, the sum of returns, and profit * n - the sum of losses; the pairs are never built.
    out = per(sold(t, "catalog", day="~_sold_date_sk", place="cs_call_center_sk", sale="~_ext_sales_price", gain="~_net_profit"), "place", {"sale": "sales", "gain": "gain"})
    back = per(sent_back(t, "catalog", day="~_returned_date_sk", back_place="cr_call_center_sk", back="~_return_amount", loss="~_net_loss"), "back_place", {"back": "returns", "loss": "loss"})
    if p.one_returns_row:
        back = back.agg(total("returns", "returns"), total("loss", "loss"))
    back = back.agg(F.count("*").alias("n"), total("returns", "returns"), F.count("loss").alias("n_loss"), total("loss", "loss"))
    paired = take(one_row(out, back), channel="'catalog channel'", id="place", sales="sales * nullif(n, 0)", returns="returns", profit="gain * nullif(n_loss, 0) - loss")
    return channel_rollup([matched("store", "~_store_sk", t.store, "s_store_sk"), paired, matched("web", "~_web_page_sk", t.web_page, "wp_web_page_sk")])


def _q77_side(s, table, day, key, sums, place=""):
    return f"SELECT {key} AS k, {sums} FROM {table} JOIN date_dim ON d_date_sk = {day} AND d_date >= {{day}} AND d_date <= {{day}} + 30 {place} GROUP BY 1"


_add("q77", q77, "channel:s id:i sales:d returns:d profit:d", "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in (
    ("ss", _q77_side("ss", "store_sales", "ss_sold_date_sk", "s_store_sk", "sum(ss_ext_sales_price) AS v, sum(ss_net_profit) AS g", "JOIN store ON s_store_sk = ss_store_sk")),
    ("sr", _q77_side("sr", "store_returns", "sr_returned_date_sk", "s_store_sk", "sum(sr_return_amt) AS r, sum(sr_net_loss) AS l", "JOIN store ON s_store_sk = sr_store_sk")),
    ("cs", _q77_side("cs", "catalog_sales", "cs_sold_date_sk", "cs_call_center_sk", "sum(cs_ext_sales_price) AS v, sum(cs_net_profit) AS g")),
    ("cr", _q77_side("cr", "catalog_returns", "cr_returned_date_sk", "cr_call_center_sk", "sum(cr_return_amount) AS r, sum(cr_net_loss) AS l")),
    ("ws", _q77_side("ws", "web_sales", "ws_sold_date_sk", "wp_web_page_sk", "sum(ws_ext_sales_price) AS v, sum(ws_net_profit) AS g", "JOIN web_page ON wp_web_page_sk = ws_web_page_sk")),
    ("wr", _q77_side("wr", "web_returns", "wr_returned_date_sk", "wp_web_page_sk", "sum(wr_return_amt) AS r, sum(wr_net_loss) AS l", "JOIN web_page ON wp_web_page_sk = wr_web_page_sk")))) + """
SELECT channel, id, sum(v) AS sales, sum(r) AS returns, sum(g) AS profit
FROM (SELECT 'store channel' AS channel, k AS id, v, ifnull(r, 0) AS r, g - ifnull(l, 0) AS g FROM ss LEFT JOIN sr USING (k) UNION ALL SELECT 'catalog channel', cs.k, v, r, g - l FROM cs, cr
      UNION ALL SELECT 'web channel', k, v, ifnull(r, 0), g - ifnull(l, 0) FROM ws LEFT JOIN wr USING (k)) GROUP BY ROLLUP (channel, id)""", order="channel, id", limit=100, params={"day": D(2000, 8, 23), "one_returns_row": False})


def q78(t, p):
    def kept(channel):
        table, s, returns, r, number = CHANNELS[channel]
        lines = anti(on_days(t.table(table), t, f"{s}_sold_date_sk", f"d_year = {p.year}"), t.table(returns), f"{s}_{number} = {r}_{number} and {s}_item_sk = {r}_item_sk")
        return lines.groupBy(F.col(f"{s}_item_sk").alias(f"{s}_item"), F.col(BUYER[channel]).alias(f"{s}_who")).agg(*[total(f"{s}_{c}", f"{s}_{n}") for c, n in (("quantity", "qty"), ("wholesale_cost", "wc"), ("sales_price", "sp"))])

    both = on(on(kept("store"), kept("web"), "ws_item = ss_item and ws_who = ss_who", "left"), kept("catalog"), "cs_item = ss_item and cs_who = ss_who", "left")
    both = both.where(f"coalesce(ws_qty, 0) > 0 {p.link} coalesce(cs_qty, 0) > 0")
    other = {n: f"coalesce(ws_{c}, 0) + coalesce(cs_{c}, 0)" for c, n in (("qty", "other_chan_qty"), ("wc", "other_chan_wholesale_cost"), ("sp", "other_chan_sales_price"))}
    return take(both, ss_sold_year=str(p.year), ss_item_sk="ss_item", ss_customer_sk="ss_who", ratio=f"round(cast(ss_qty as double) / ({other['other_chan_qty']}), 2)", store_qty="ss_qty", store_wholesale_cost="ss_wc", store_sales_price="ss_sp", **other)


def _q78_side(channel):
    table, s, returns, r, number = CHANNELS[channel]
    return (f"{s} AS (SELECT {s}_item_sk AS i, {BUYER[channel]} AS c, sum({s}_quantity) AS q, sum({s}_wholesale_cost) AS w, sum({s}_sales_price) AS p FROM {table} ANTI JOIN {returns} ON ({r}_{number}, {r}_item_sk) = ({s}_{number}, {s}_item_sk) "
            f"JOIN date_dim ON d_date_sk = {s}_sold_date_sk AND d_year = {{year}} GROUP BY 1, 2)")


_add("q78", q78, "ss_sold_year:i ss_item_sk:i ss_customer_sk:i ratio:d store_qty:l store_wholesale_cost:d store_sales_price:d other_chan_qty:l other_chan_wholesale_cost:d other_chan_sales_price:d",
     "WITH " + ",\n".join(_q78_side(c) for c in CHANNELS) + """
SELECT {year} AS ss_sold_year, ss.i AS ss_item_sk, ss.c AS ss_customer_sk, ((200 * ss.q + ifnull(ws.q, 0) + ifnull(cs.q, 0)) // (2 * (ifnull(ws.q, 0) + ifnull(cs.q, 0))))::DOUBLE / 100 AS ratio, ss.q AS store_qty, ss.w AS store_wholesale_cost, ss.p AS store_sales_price,
       ifnull(ws.q, 0) + ifnull(cs.q, 0) AS other_chan_qty, ifnull(ws.w, 0) + ifnull(cs.w, 0) AS other_chan_wholesale_cost, ifnull(ws.p, 0) + ifnull(cs.p, 0) AS other_chan_sales_price
FROM ss LEFT JOIN ws ON ws.i = ss.i AND ws.c = ss.c LEFT JOIN cs ON cs.i = ss.i AND cs.c = ss.c WHERE greatest(ws.q, cs.q) > 0""",
     order="ss_sold_year, ss_item_sk, ss_customer_sk, store_qty desc, store_wholesale_cost desc, store_sales_price desc, other_chan_qty, other_chan_wholesale_cost, other_chan_sales_price, ratio", limit=100, params={"year": 2000, "link": "or"})


def q79(t, p):
    homes = t.household_demographics.where("hd_dep_count = 6 or hd_vehicle_count > 2")
    lines = semi(on_days(t.store_sales, t, "ss_sold_date_sk", f"d_dow = 1 and d_year between {p.year} and {p.year} + 2"), homes, "ss_hdemo_sk = hd_demo_sk")
    lines = on(lines, t.store.where("s_number_employees between 200 and 295"), "ss_store_sk = s_store_sk")
    tickets = lines.groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "s_city").agg(total("ss_coupon_amt", "amt"), total("ss_net_profit", "profit"))
    return on(tickets, t.customer, "ss_customer_sk = c_customer_sk").withColumn("city", F.substring("s_city", 1, 30))


_add("q79", q79, "c_last_name:s c_first_name:s city:s ss_ticket_number:l amt:d profit:d", """
SELECT c_last_name, c_first_name, left(s_city, 30) AS city, ss_ticket_number, sum(ss_coupon_amt) AS amt, sum(ss_net_profit) AS profit
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk JOIN household_demographics ON hd_demo_sk = ss_hdemo_sk JOIN customer ON c_customer_sk = ss_customer_sk
WHERE d_day_name = 'Monday' AND d_year IN ({year}, {year} + 1, {year} + 2) AND s_number_employees >= 200 AND s_number_employees <= 295 AND (hd_dep_count = 6 OR hd_vehicle_count > 2)
GROUP BY ss_ticket_number, ss_addr_sk, c_customer_sk, c_last_name, c_first_name, s_city""", order="c_last_name, c_first_name, city, profit", limit=100, params={"year": 1999})

_PLACES_80 = {"store": ("~_store_sk", "store", "s_store_sk", "s_store_id", "store"), "catalog": ("~_catalog_page_sk", "catalog_page", "cp_catalog_page_sk", "cp_catalog_page_id", "catalog_page"),
              "web": ("~_web_site_sk", "web_site", "web_site_sk", "web_site_id", "web_site")}


def q80(t, p):
    def channel(name):
        _, s, returns, r, number = CHANNELS[name]
        key, place, sk, ident, label = _PLACES_80[name]
        amount = "cr_return_amount" if r == "cr" else f"{r}_return_amt"
        lines = sold(t, name, day="~_sold_date_sk", item="~_item_sk", number=f"~_{number}", promo="~_promo_sk", place=key, sale="~_ext_sales_price", gain="~_net_profit")
        lines = semi(on_days(lines, t, "day", day_window(p.day, 30)), t.item.where("i_current_price > 50"), "item = i_item_sk")
        lines = semi(lines, t.promotion.where("p_channel_tv = 'N'"), "promo = p_promo_sk")
        lines = on(lines, t.table(returns).select(f"{r}_item_sk", f"{r}_{number}", amount, f"{r}_net_loss"), f"item = {r}_item_sk and number = {r}_{number}", "left")
        sums = lines.groupBy("place").agg(total("sale", "sales"), total(f"coalesce({amount}, 0)", "returns"), total(f"gain - coalesce({r}_net_loss, 0)", "profit"))
        return take(on(sums, t.table(place), f"place = {sk}"), channel=f"'{name} channel'", id=f"concat('{label}', {ident})", sales="sales", returns="returns", profit="profit")

    return channel_rollup([channel(c) for c in CHANNELS])


def _q80_sql():
    parts = []
    for name, (table, s, returns, r, number) in CHANNELS.items():
        key, place, sk, ident, label = _PLACES_80[name]
        amount = "cr_return_amount" if r == "cr" else f"{r}_return_amt"
        parts.append(f"SELECT '{name} channel' AS channel, '{label}' || {ident} AS id, {s}_ext_sales_price AS v, ifnull({amount}, 0) AS r, {s}_net_profit - ifnull({r}_net_loss, 0) AS g FROM {table} "
                     f"LEFT JOIN {returns} ON ({r}_item_sk, {r}_{number}) = ({s}_item_sk, {s}_{number}) JOIN date_dim ON d_date_sk = {s}_sold_date_sk AND d_date BETWEEN {{day}} AND {{day}} + 30 JOIN {place} ON {sk} = {key.replace('~', s)} "
                     f"JOIN item ON i_item_sk = {s}_item_sk AND i_current_price > 50 JOIN promotion ON p_promo_sk = {s}_promo_sk AND p_channel_tv = 'N'")
    return "SELECT channel, id, sum(v) AS sales, sum(r) AS returns, sum(g) AS profit FROM (" + "\nUNION ALL ".join(parts) + ") GROUP BY ROLLUP (channel, id)"


_add("q80", q80, _CHANNEL_OUT, _q80_sql(), order="channel, id", limit=100, params={"day": D(2000, 8, 23)})


def q83(t, p):
    weeks = t.date_dim.where(F.col("d_date").isin([F.lit(d) for d in p.dates])).select(F.col("d_week_seq").alias("w"))
    days = semi(t.date_dim, weeks, "d_week_seq = w")

    def quantity(channel):
        r = CHANNELS[channel][3]
        lines = semi(sent_back(t, channel, day="~_returned_date_sk", item="~_item_sk", q="~_return_quantity"), days, "day = d_date_sk")
        return on(lines, t.item, "item = i_item_sk").groupBy(F.col("i_item_id").alias(f"{r}_item")).agg(total("q", f"{r}_item_qty"))

    three = on(on(quantity("store"), quantity("catalog"), "sr_item = cr_item"), quantity("web"), "sr_item = wr_item")
    whole = "(sr_item_qty + cr_item_qty + wr_item_qty)"
    return take(three, item_id="sr_item", **{n: e for r in ("sr", "cr", "wr") for n, e in ((f"{r}_item_qty", f"{r}_item_qty"), (f"{r}_dev", f"cast({r}_item_qty as double) / {whole} / 3 * 100"))}, average=f"cast({whole} as double) / 3")


_add("q83", q83, "item_id:s sr_item_qty:l sr_dev:d cr_item_qty:l cr_dev:d wr_item_qty:l wr_dev:d average:d", """
WITH days AS (SELECT d_date_sk FROM date_dim SEMI JOIN (SELECT d_week_seq FROM date_dim WHERE d_date IN ({dates})) w USING (d_week_seq)),
lines(ch, item, day, q) AS (SELECT 's', sr_item_sk, sr_returned_date_sk, sr_return_quantity FROM store_returns UNION ALL SELECT 'c', cr_item_sk, cr_returned_date_sk, cr_return_quantity FROM catalog_returns UNION ALL SELECT 'w', wr_item_sk, wr_returned_date_sk, wr_return_quantity FROM web_returns),
q AS (SELECT i_item_id AS item_id, sum(q) FILTER (WHERE ch = 's') AS s, sum(q) FILTER (WHERE ch = 'c') AS c, sum(q) FILTER (WHERE ch = 'w') AS w FROM lines SEMI JOIN days ON d_date_sk = day JOIN item ON i_item_sk = item GROUP BY 1 HAVING count(DISTINCT ch) = 3)
SELECT item_id, s AS sr_item_qty, s::DOUBLE / (s + c + w) / 3 * 100 AS sr_dev, c AS cr_item_qty, c::DOUBLE / (s + c + w) / 3 * 100 AS cr_dev, w AS wr_item_qty, w::DOUBLE / (s + c + w) / 3 * 100 AS wr_dev, (s + c + w)::DOUBLE / 3 AS average FROM q""",
     order="item_id, sr_item_qty", limit=100, params={"dates": [D(2000, 6, 30), D(2000, 9, 27), D(2000, 11, 17)]}, tried={"dates": [D(y, m, d) for y in (1999, 2000) for m in range(1, 13) for d in (7, 17, 27)]})


def q84(t, p):
    bands = t.income_band.where(f"ib_lower_bound >= {p.income} and ib_upper_bound <= {p.income} + 50000")
    homes = semi(t.household_demographics, bands, "hd_income_band_sk = ib_income_band_sk")
    people = semi(semi(t.customer, t.customer_address.where(F.col("ca_city") == p.city), "c_current_addr_sk = ca_address_sk"), homes, "c_current_hdemo_sk = hd_demo_sk")
    people = semi(people, t.customer_demographics, "c_current_cdemo_sk = cd_demo_sk")
    names = on(people, t.store_returns.select("sr_cdemo_sk"), "sr_cdemo_sk = c_current_cdemo_sk")
    return take(names, customer_id="c_customer_id", customername="concat(coalesce(c_last_name, ''), ', ', coalesce(c_first_name, ''))")


_add("q84", q84, "customer_id:s customername:s", """
SELECT c_customer_id AS customer_id, ifnull(c_last_name, '') || ', ' || ifnull(c_first_name, '') AS customername
FROM store_returns JOIN customer_demographics ON cd_demo_sk = sr_cdemo_sk JOIN customer ON c_current_cdemo_sk = cd_demo_sk JOIN customer_address ON ca_address_sk = c_current_addr_sk
     JOIN household_demographics ON hd_demo_sk = c_current_hdemo_sk JOIN income_band ON ib_income_band_sk = hd_income_band_sk
WHERE ca_city = {city} AND ib_lower_bound >= {income} AND ib_upper_bound <= {income} + 50000""", order="customer_id", limit=100, params={"city": "Edgewood", "income": 38128})


def q85(t, p):
    lines = on(on_days(t.web_sales, t, "ws_sold_date_sk", f"d_year = {p.year}"), t.web_returns, "ws_item_sk = wr_item_sk and ws_order_number = wr_order_number")
    lines = semi(lines, t.web_page, "ws_web_page_sk = wp_web_page_sk")
    lines = on(lines, t.customer_demographics, f"wr_refunded_cdemo_sk = cd_demo_sk and ({_people_case(p.people, 'ws_sales_price')})")
    lines = semi(lines, renamed(t.customer_demographics, "other_", "cd_demo_sk", "cd_marital_status", "cd_education_status"),
                 "wr_returning_cdemo_sk = other_cd_demo_sk and cd_marital_status = other_cd_marital_status and cd_education_status = other_cd_education_status")
    lines = on(lines, t.customer_address, f"wr_refunded_addr_sk = ca_address_sk and ({_place_case(p.places, 'ws_net_profit')})")
    return on(lines, t.reason, "wr_reason_sk = r_reason_sk").groupBy("r_reason_desc").agg(mean("ws_quantity", "avg_quantity"), mean("wr_refunded_cash", "avg_refunded_cash"), mean("wr_fee", "avg_fee")).withColumn("reason", F.substring("r_reason_desc", 1, 20))


_add("q85", q85, "reason:s avg_quantity:d avg_refunded_cash:d avg_fee:d", """
WITH people(ms, es, low, high) AS (VALUES ('M', 'Advanced Degree', 100, 150), ('S', 'College', 50, 100), ('W', '2 yr Degree', 150, 200)),
places(states, least, most) AS (VALUES (['IN', 'OH', 'NJ', 'TN', 'GA'], -20000, 20000), (['WI', 'CT', 'KY'], 150, 300), (['LA', 'IA', 'AR'], 50, 250))
SELECT left(r_reason_desc, 20) AS reason, sum(ws_quantity)::DOUBLE / count(*) AS avg_quantity, sum(wr_refunded_cash)::DOUBLE / count(*) AS avg_refunded_cash, sum(wr_fee)::DOUBLE / count(*) AS avg_fee
FROM web_sales JOIN web_returns ON (wr_item_sk, wr_order_number) = (ws_item_sk, ws_order_number) JOIN web_page ON wp_web_page_sk = ws_web_page_sk JOIN customer_demographics a ON a.cd_demo_sk = wr_refunded_cdemo_sk
     JOIN customer_demographics b ON b.cd_demo_sk = wr_returning_cdemo_sk AND b.cd_marital_status = a.cd_marital_status AND b.cd_education_status = a.cd_education_status
     JOIN customer_address ON ca_address_sk = wr_refunded_addr_sk JOIN date_dim ON d_date_sk = ws_sold_date_sk JOIN reason ON r_reason_sk = wr_reason_sk
WHERE d_year BETWEEN {year} AND {year} AND ca_country = 'United States' AND EXISTS (FROM people WHERE ms = a.cd_marital_status AND es = a.cd_education_status AND ws_sales_price >= low AND ws_sales_price <= high)
  AND EXISTS (FROM places WHERE list_contains(states, ca_state) AND ws_net_profit >= least AND ws_net_profit <= most)
GROUP BY r_reason_desc""", order="reason, avg_quantity, avg_refunded_cash, avg_fee", limit=100,
     params={"year": 2000, "people": [("M", "Advanced Degree", 100, 150), ("S", "College", 50, 100), ("W", "2 yr Degree", 150, 200)], "places": [(["IN", "OH", "NJ"], 100, 200), (["WI", "CT", "KY"], 150, 300), (["LA", "IA", "AR"], 50, 250)]},
     tried={"places": [(["IN", "OH", "NJ", "TN", "GA"], -20000, 20000), (["WI", "CT", "KY"], 150, 300), (["LA", "IA", "AR"], 50, 250)]})

_HALF_HOURS = [("h8_30_to_9", 8, 1), ("h9_to_9_30", 9, 0), ("h9_30_to_10", 9, 1), ("h10_to_10_30", 10, 0), ("h10_30_to_11", 10, 1), ("h11_to_11_30", 11, 0), ("h11_30_to_12", 11, 1), ("h12_to_12_30", 12, 0)]
_HOMES_88 = "(hd_dep_count = 4 and hd_vehicle_count <= 6) or (hd_dep_count = 2 and hd_vehicle_count <= 4) or (hd_dep_count = 0 and hd_vehicle_count <= 2)"


def q88(t, p):
    """Eight half hours as conditional counts of one scan."""
    lines = semi(semi(t.store_sales, t.store.where(F.col("s_store_name") == p.store), "ss_store_sk = s_store_sk"), t.household_demographics.where(_HOMES_88), "ss_hdemo_sk = hd_demo_sk")
    lines = on(lines, t.time_dim.where("t_hour between 8 and 12"), "ss_sold_time_sk = t_time_sk")
    return lines.agg(*[F.count(F.when(F.expr(f"t_hour = {h} and t_minute {'>=' if late else '<'} 30"), 1)).alias(n) for n, h, late in _HALF_HOURS])


_add("q88", q88, " ".join(f"{n}:l" for n, *_ in _HALF_HOURS), "SELECT " + ", ".join(f"count(*) FILTER (WHERE t_time // 1800 = {h * 2 + late}) AS {n}" for n, h, late in _HALF_HOURS) + """
FROM store_sales JOIN time_dim ON t_time_sk = ss_sold_time_sk JOIN household_demographics ON hd_demo_sk = ss_hdemo_sk JOIN store ON s_store_sk = ss_store_sk
WHERE s_store_name = {store} AND hd_dep_count IN (0, 2, 4) AND hd_vehicle_count <= hd_dep_count + 2""", params={"store": "ese"})


def q90(t, p):
    lines = semi(semi(t.web_sales, t.household_demographics.where("hd_dep_count = 6"), "ws_ship_hdemo_sk = hd_demo_sk"), t.web_page.where("wp_char_count between 5000 and 5200"), "ws_web_page_sk = wp_web_page_sk")
    lines = on(lines, t.time_dim.where(f"t_hour between {p.morning} and {p.morning} + 1 or t_hour between {p.evening} and {p.evening} + 1"), "ws_sold_time_sk = t_time_sk")
    half = lines.agg(*[F.count(F.when(F.col("t_hour").between(h, h + 1), 1)).alias(n) for n, h in (("amc", p.morning), ("pmc", p.evening))])
    return half.select(ratio("amc", "pmc").alias("am_pm_ratio"))


_add("q90", q90, "am_pm_ratio:d", """
SELECT count(*) FILTER (WHERE t_hour - {morning} IN (0, 1))::DOUBLE / nullif(count(*) FILTER (WHERE t_hour - {evening} IN (0, 1)), 0) AS am_pm_ratio
FROM web_sales JOIN time_dim ON t_time_sk = ws_sold_time_sk JOIN household_demographics ON hd_demo_sk = ws_ship_hdemo_sk JOIN web_page ON wp_web_page_sk = ws_web_page_sk
WHERE hd_dep_count = 6 AND wp_char_count >= 5000 AND wp_char_count <= 5200""", order="am_pm_ratio", limit=100, params={"morning": 8, "evening": 19})


def q91(t, p):
    back = on(on_days(t.catalog_returns, t, "cr_returned_date_sk", f"d_year = {p.year} and d_moy between {p.month} and {p.last}"), t.call_center, "cr_call_center_sk = cc_call_center_sk")
    people = semi(semi(t.customer, t.customer_address.where("ca_gmt_offset = -7"), "c_current_addr_sk = ca_address_sk"), t.household_demographics.where(F.col("hd_buy_potential").startswith("Unknown")), "c_current_hdemo_sk = hd_demo_sk")
    kinds = t.customer_demographics.where("(cd_marital_status = 'M' and cd_education_status = 'Unknown') or (cd_marital_status = 'W' and cd_education_status = 'Advanced Degree')")
    lines = on(on(back, people, "cr_returning_customer_sk = c_customer_sk"), kinds, "c_current_cdemo_sk = cd_demo_sk")
    return lines.groupBy("cc_call_center_id", "cc_name", "cc_manager", "cd_marital_status", "cd_education_status").agg(total("cr_net_loss", "returns_loss")).withColumnsRenamed({"cc_call_center_id": "call_center", "cc_name": "call_center_name", "cc_manager": "manager"})


_add("q91", q91, "call_center:s call_center_name:s manager:s returns_loss:d", """
SELECT cc_call_center_id AS call_center, cc_name AS call_center_name, cc_manager AS manager, sum(cr_net_loss) AS returns_loss
FROM catalog_returns JOIN call_center ON cc_call_center_sk = cr_call_center_sk JOIN date_dim ON d_date_sk = cr_returned_date_sk JOIN customer ON c_customer_sk = cr_returning_customer_sk
     JOIN customer_demographics ON cd_demo_sk = c_current_cdemo_sk JOIN household_demographics ON hd_demo_sk = c_current_hdemo_sk JOIN customer_address ON ca_address_sk = c_current_addr_sk
WHERE d_year = {year} AND d_moy BETWEEN {month} AND {last} AND ca_gmt_offset = -7 AND hd_buy_potential LIKE 'Unknown%' AND (cd_marital_status, cd_education_status) IN (('M', 'Unknown'), ('W', 'Advanced Degree'))
GROUP BY cc_call_center_id, cc_name, cc_manager, cd_marital_status, cd_education_status""", order="returns_loss desc", params={"year": 1998, "month": 11, "last": 11}, tried={"month": 1, "last": 12})


def q93(t, p):
    back = semi(t.store_returns, t.reason.where(F.col("r_reason_desc") == p.reason), "sr_reason_sk = r_reason_sk")
    # The test on the return's reason drops unmatched sales, so the outer join of the text is an inner one.
    lines = on(t.store_sales, back, "sr_item_sk = ss_item_sk and sr_ticket_number = ss_ticket_number")
    return lines.groupBy("ss_customer_sk").agg(total("case when sr_return_quantity is not null then (ss_quantity - sr_return_quantity) * ss_sales_price else ss_quantity * ss_sales_price end", "sumsales"))


_add("q93", q93, "ss_customer_sk:i sumsales:d", """
SELECT ss_customer_sk, sum((ss_quantity - ifnull(sr_return_quantity, 0)) * ss_sales_price) AS sumsales
FROM store_sales JOIN store_returns ON (sr_item_sk, sr_ticket_number) = (ss_item_sk, ss_ticket_number) JOIN reason ON r_reason_sk = sr_reason_sk WHERE r_reason_desc = {reason}
GROUP BY ss_customer_sk""", order="sumsales, ss_customer_sk", limit=100, params={"reason": "reason 28"})

_add("q94", shipped_orders, SHIP_OUT, """
SELECT count(DISTINCT ws_order_number) AS order_count, sum(ws_ext_ship_cost) AS total_shipping_cost, sum(ws_net_profit) AS total_net_profit
FROM web_sales one JOIN date_dim ON d_date_sk = ws_ship_date_sk JOIN customer_address ON ca_address_sk = ws_ship_addr_sk JOIN web_site ON web_site_sk = ws_web_site_sk
WHERE d_date BETWEEN {day} AND {day} + {days} AND ca_state = {state} AND web_company_name = 'pri'
  AND EXISTS (FROM web_sales o WHERE o.ws_order_number = one.ws_order_number AND o.ws_warehouse_sk <> one.ws_warehouse_sk) AND one.ws_order_number NOT IN (SELECT wr_order_number FROM web_returns)""", limit=100,
     params={"channel": "web", "day": D(1999, 2, 1), "days": 60, "state": "IL", "desk": "web_site", "desk_key": "ws_web_site_sk", "desk_sk": "web_site_sk", "desk_test": "web_company_name = 'pri'"}, tried={"state": "TN", "days": 730})


def q95(t, p):
    lines = t.web_sales.select("ws_order_number", "ws_warehouse_sk", "ws_ship_date_sk", "ws_ship_addr_sk", "ws_web_site_sk", "ws_ext_ship_cost", "ws_net_profit")
    spread = lines.groupBy(F.col("ws_order_number").alias("n")).agg(F.min("ws_warehouse_sk").alias("low"), F.max("ws_warehouse_sk").alias("high")).where("low <> high").select("n")
    lines = semi(on_days(lines, t, "ws_ship_date_sk", day_window(p.day, p.days)), t.customer_address.where(F.col("ca_state") == p.state), "ws_ship_addr_sk = ca_address_sk")
    lines = semi(lines, t.web_site.where("web_company_name = 'pri'"), "ws_web_site_sk = web_site_sk")
    kept = semi(semi(lines, spread, "ws_order_number = n"), t.web_returns.select(F.col("wr_order_number").alias("n")), "ws_order_number = n")
    orders = kept.groupBy("ws_order_number").agg(total("ws_ext_ship_cost", "freight"), total("ws_net_profit", "gain"))
    return orders.agg(F.count("*").alias("order_count"), total("freight", "total_shipping_cost"), total("gain", "total_net_profit"))


_add("q95", q95, SHIP_OUT, """
WITH spread AS (SELECT ws_order_number FROM web_sales GROUP BY 1 HAVING count(DISTINCT ws_warehouse_sk) > 1)
SELECT count(DISTINCT ws_order_number) AS order_count, sum(ws_ext_ship_cost) AS total_shipping_cost, sum(ws_net_profit) AS total_net_profit
FROM web_sales SEMI JOIN spread USING (ws_order_number) JOIN date_dim ON d_date_sk = ws_ship_date_sk JOIN customer_address ON ca_address_sk = ws_ship_addr_sk JOIN web_site ON web_site_sk = ws_web_site_sk
WHERE d_date BETWEEN {day} AND {day} + {days} AND ca_state = {state} AND web_company_name = 'pri' AND ws_order_number IN (SELECT wr_order_number FROM web_returns)""", limit=100,
     params={"day": D(1999, 2, 1), "days": 60, "state": "IL"}, tried={"state": "TN", "days": 730})


def q96(t, p):
    lines = semi(semi(t.store_sales, t.store.where(F.col("s_store_name") == p.store), "ss_store_sk = s_store_sk"), t.household_demographics.where(f"hd_dep_count = {p.dependents}"), "ss_hdemo_sk = hd_demo_sk")
    return semi(lines, t.time_dim.where(f"t_hour = {p.hour} and t_minute >= 30"), "ss_sold_time_sk = t_time_sk").agg(F.count("*").alias("cnt"))


_add("q96", q96, "cnt:l", """
SELECT count(*) AS cnt FROM store_sales JOIN time_dim ON t_time_sk = ss_sold_time_sk JOIN household_demographics ON hd_demo_sk = ss_hdemo_sk JOIN store ON s_store_sk = ss_store_sk
WHERE t_hour = {hour} AND t_minute BETWEEN 30 AND 59 AND hd_dep_count = {dependents} AND s_store_name = {store}""", limit=100, params={"hour": 20, "dependents": 7, "store": "ese"})


def q97(t, p):
    def pairs(channel):
        lines = on_days(sold(t, channel, day="~_sold_date_sk", who=BUYER[channel], item="~_item_sk"), t, "day", f"d_month_seq between {p.first} and {p.first} + 11")
        return lines.select(F.col("who").alias(f"{channel}_who"), F.col("item").alias(f"{channel}_item")).distinct()

    both = on(pairs("store"), pairs("catalog"), "store_who = catalog_who and store_item = catalog_item", "full")
    return both.agg(tally("store_who is not null and catalog_who is null", "store_only"), tally("store_who is null and catalog_who is not null", "catalog_only"), tally("store_who is not null and catalog_who is not null", "store_and_catalog"))


_add("q97", q97, "store_only:l catalog_only:l store_and_catalog:l", """
WITH pairs AS (SELECT who, item, bit_or(ch) AS chs FROM (SELECT 1 AS ch, ss_customer_sk AS who, ss_item_sk AS item, ss_sold_date_sk AS day FROM store_sales UNION ALL SELECT 2, cs_bill_customer_sk, cs_item_sk, cs_sold_date_sk FROM catalog_sales)
               JOIN date_dim ON d_date_sk = day WHERE d_month_seq >= {first} AND d_month_seq < {first} + 12 AND who IS NOT NULL AND item IS NOT NULL GROUP BY 1, 2)
SELECT count(*) FILTER (WHERE chs = 1) AS store_only, count(*) FILTER (WHERE chs = 2) AS catalog_only, count(*) FILTER (WHERE chs = 3) AS store_and_catalog FROM pairs""", limit=100, params={"first": 1200})

_PROFILED = ["ss_sold_date_sk", "ss_sold_time_sk", "ss_item_sk", "ss_customer_sk", "ss_cdemo_sk", "ss_hdemo_sk", "ss_addr_sk", "ss_store_sk", "ss_promo_sk"]


def column_profile(t, p):
    """ss_max, ss_maxb: totals, non-NULL count, distinct days and maxima of the sales keys."""
    distinct = [F.count_distinct("ss_sold_date_sk").alias("unique_days")] if p.distinct else []
    return t.store_sales.agg(F.count("*").alias("total"), F.count("ss_sold_date_sk").alias("not_null_total"), *distinct, *[F.max(c).alias(f"max_{c}") for c in _PROFILED])


_MAXES, _MAXES_OUT = ", ".join(f"max({c}) AS max_{c}" for c in _PROFILED), " ".join(f"max_{c}:i" for c in _PROFILED)
_add("ss_max", column_profile, f"total:l not_null_total:l unique_days:l {_MAXES_OUT}", f"SELECT count(*) AS total, count(ss_sold_date_sk) AS not_null_total, (SELECT count(*) FROM (SELECT DISTINCT ss_sold_date_sk FROM store_sales WHERE ss_sold_date_sk IS NOT NULL)) AS unique_days, {_MAXES} FROM store_sales", params={"distinct": True})
_add("ss_maxb", column_profile, f"total:l not_null_total:l {_MAXES_OUT}", f"SELECT count(*) AS total, count(ss_sold_date_sk) AS not_null_total, {_MAXES} FROM store_sales", params={"distinct": False})
