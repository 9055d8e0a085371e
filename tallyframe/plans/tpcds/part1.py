"""Retail reports 1 to 20."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.verbs import anti, mean, on, one_row, only, ratio, renamed, semi, tally, total
from tallyframe.plans.registry import Book, Raw
from tallyframe.plans.tpcds.shared import (BUYER, CHANNELS, D, SHORT_DAYS, above_peers, dated, day_window, on_days, quoted, sent_back,
                                           share_of_class, sold, take, weekday_sums, weekday_sums_sql)
from tallyframe.sources.stored import written

BOOK = Book()


def _add(key, build, out, sql, **rest):
    BOOK.add(f"tpcds.{key}", build, out, sql, **rest)


def q1(t, p):
    back = on_days(t.store_returns, t, "sr_returned_date_sk", f"d_year = {p.year}")
    totals = back.groupBy("sr_customer_sk", "sr_store_sk").agg(total("sr_return_amt", "total"))
    local = semi(above_peers(totals, "sr_store_sk"), t.store.where(F.col("s_state") == p.state), "sr_store_sk = s_store_sk")
    return on(local, t.customer, "sr_customer_sk = c_customer_sk")


_add("q1", q1, "c_customer_id:s", """
SELECT c_customer_id
FROM (SELECT sr_customer_sk, sr_store_sk, sum(sr_return_amt) AS amt,
             sum(sum(sr_return_amt)) OVER of_store::DOUBLE / count(sum(sr_return_amt)) OVER of_store AS usual
      FROM store_returns JOIN date_dim ON d_date_sk = sr_returned_date_sk WHERE d_year = {year}
      GROUP BY sr_customer_sk, sr_store_sk WINDOW of_store AS (PARTITION BY sr_store_sk)) r
     JOIN store ON s_store_sk = sr_store_sk AND s_state = {state} JOIN customer ON c_customer_sk = sr_customer_sk
WHERE amt > 1.2::DOUBLE * usual""", order="c_customer_id", limit=100, params={"year": 2000, "state": "TN"})


def q2(t, p):
    both = sold(t, "web", day="~_sold_date_sk", price="~_ext_sales_price").unionByName(sold(t, "catalog", day="~_sold_date_sk", price="~_ext_sales_price"))
    weeks = dated(both, t, "day").groupBy("d_week_seq").agg(*weekday_sums("price"))

    def of(year, shown):
        in_year = t.date_dim.where(f"d_year = {year}").select(F.col("d_week_seq").alias("w"))
        return on(weeks, in_year, "d_week_seq = w").select(F.col("d_week_seq").alias(f"d_week_seq{shown}"), *[F.col(f"{d}_sales").alias(f"{d}{shown}") for d in SHORT_DAYS])

    pairs = on(of(p.year, 1), of(p.year + 1, 2), "d_week_seq1 = d_week_seq2 - 53")
    return pairs.select("d_week_seq1", *[F.round(ratio(f"{d}1", f"{d}2"), 2).alias(f"{d}_ratio") for d in SHORT_DAYS])


_add("q2", q2, "d_week_seq1:i " + " ".join(f"{d}_ratio:d" for d in SHORT_DAYS), """
WITH weekly AS (SELECT d_week_seq, <<sums>>
                FROM (SELECT ws_sold_date_sk AS day, ws_ext_sales_price AS price FROM web_sales UNION ALL FROM (SELECT cs_sold_date_sk, cs_ext_sales_price FROM catalog_sales)) s
                     JOIN date_dim ON d_date_sk = day GROUP BY d_week_seq)
SELECT a.d_week_seq AS d_week_seq1, <<ratios>>
FROM weekly a JOIN weekly b ON b.d_week_seq = a.d_week_seq + 53
     JOIN date_dim da ON da.d_week_seq = a.d_week_seq AND da.d_year = {year} JOIN date_dim db ON db.d_week_seq = b.d_week_seq AND db.d_year = {year} + 1
""".replace("<<sums>>", weekday_sums_sql("price")).replace("<<ratios>>", ", ".join(f"round(a.{d}_sales::DOUBLE / nullif(b.{d}_sales, 0)::DOUBLE, 2) AS {d}_ratio" for d in SHORT_DAYS)),
     order="d_week_seq1", params={"year": 2001})


def brand_report(t, p):
    """q3, q42, q52, q55: sales of some items in one month."""
    items = t.item.where(p.items)
    return (on(dated(t.store_sales, t, "ss_sold_date_sk", p.days), items, "ss_item_sk = i_item_sk")
            .groupBy(*p.keys).agg(total("ss_ext_sales_price", "sales")).select(*[F.expr(c).alias(n) for n, c in p.shown.items()]))


_add("q3", brand_report, "d_year:i brand_id:i brand:s sum_agg:d", """
SELECT d_year, i_brand_id AS brand_id, i_brand AS brand, sum(ss_ext_sales_price) AS sum_agg
FROM store_sales JOIN item ON i_item_sk = ss_item_sk JOIN date_dim ON d_date_sk = ss_sold_date_sk
WHERE {items} AND {days} GROUP BY ALL""", order="d_year, sum_agg desc, brand_id", limit=100,
     params={"items": Raw("i_manufact_id = 128"), "days": Raw("d_moy = 11"), "keys": ["d_year", "i_brand", "i_brand_id"],
             "shown": {"d_year": "d_year", "brand_id": "i_brand_id", "brand": "i_brand", "sum_agg": "sales"}})

YEARLY_COLUMNS = ["c_customer_id", "c_first_name", "c_last_name", "c_preferred_cust_flag", "c_birth_country", "c_login", "c_email_address"]
# Amount of a line, per report.
YEARLY = {"q4": "((~_ext_list_price - ~_ext_wholesale_cost - ~_ext_discount_amt) + ~_ext_sales_price) / 2", "q11": "~_ext_list_price - ~_ext_discount_amt", "q74": "~_net_paid"}


def customer_growth(t, p):
    """q4, q11, q74: buyers whose spending grew faster in the first channel than in the others.

    One aggregation per channel with a column per year takes the place of the self-joins of a yearly table: a
    customer key stands for one customer id, so the totals are grouped by key and the names joined last.
    """
    def years(channel):
        lines = dated(sold(t, channel, who=BUYER[channel], day="~_sold_date_sk", amount=p.amount), t, "day", f"d_year in ({p.year}, {p.year + 1})")
        return lines.groupBy(F.col("who").alias(f"{channel}_who")).agg(
            *[F.sum(F.when(F.col("d_year") == p.year + i, F.col("amount"))).alias(f"{channel}_{n}") for i, n in enumerate(("first", "second"))]
        ).where(f"{channel}_first > 0 and {channel}_second is not null")

    lead, *others = p.channels
    joined = years(lead)
    for other in others:
        joined = on(joined, years(other), f"{lead}_who = {other}_who").where(
            ratio(f"{lead}_second", f"{lead}_first") > ratio(f"{other}_second", f"{other}_first"))
    return on(t.customer, joined, f"c_customer_sk = {lead}_who")


def _growth_sql(columns, amount, channels):
    parts = "\n     ".join(
        f"{'JOIN ' if i else ''}(SELECT {BUYER[c]} AS who, sum({amount.replace('~', CHANNELS[c][1])}) FILTER (WHERE d_year = {{year}})::DOUBLE AS a, "
        f"sum({amount.replace('~', CHANNELS[c][1])}) FILTER (WHERE d_year = {{year}} + 1)::DOUBLE AS b FROM {CHANNELS[c][0]} JOIN date_dim ON d_date_sk = {CHANNELS[c][1]}_sold_date_sk GROUP BY 1) {c}"
        + (f" ON {c}.who = {channels[0]}.who AND {c}.a > 0 AND {channels[0]}.b / {channels[0]}.a > {c}.b / {c}.a" if i else "")
        for i, c in enumerate(channels))
    return f"SELECT {columns}\nFROM {parts}\n     JOIN customer ON c_customer_sk = {channels[0]}.who\nWHERE {channels[0]}.a > 0"


_GROWTH_OUT = ["customer_id:c_customer_id", "customer_first_name:c_first_name", "customer_last_name:c_last_name", "customer_preferred_cust_flag:c_preferred_cust_flag",
               "customer_birth_country:c_birth_country", "customer_login:c_login", "customer_email_address:c_email_address"]


def growth(key, year_key, channels, shown):
    names = [c.split(":") for c in shown]
    columns = ", ".join(f"{src} AS {n}" for n, src in names)

    def build(t, p):
        return customer_growth(t, p).select(*[F.col(src).alias(n) for n, src in names])

    return dict(build=build, out=" ".join(f"{n}:s" for n, _ in names), sql=_growth_sql(columns, YEARLY[year_key], channels),
                order=", ".join(n for n, _ in names), limit=100, params={"year": 2001, "amount": YEARLY[year_key], "channels": channels})


BOOK.add("tpcds.q4", **growth("q4", "q4", ["catalog", "store", "web"], _GROWTH_OUT[:4]))


def channel_rollup(rows: list[DataFrame]) -> DataFrame:
    """Three channel tables of (channel, id, sales, returns, profit) under one rollup."""
    return (functools.reduce(DataFrame.unionByName, rows).rollup("channel", "id")
            .agg(total("sales", "sales"), total("returns", "returns"), total("profit", "profit")))


def q5(t, p):
    zero = "cast(0 as decimal(7,2))"

    def channel(name, sales, returns, place, key, ident, label):
        both = sales.select("*", F.expr(zero).alias("back"), F.expr(zero).alias("loss")).unionByName(
            returns.select("*", F.expr(zero).alias("sale"), F.expr(zero).alias("gain")))
        both = on(on_days(both, t, "day", day_window(p.day, 14)), place, f"place = {key}")
        sums = both.groupBy(ident).agg(total("sale", "sales"), total("back", "returns"), total("gain", "gain"), total("loss", "loss"))
        return take(sums, channel=f"'{name} channel'", id=f"concat('{label}', {ident})", sales="sales", returns="returns", profit="gain - loss")

    columns = dict(day="~_sold_date_sk", sale="~_ext_sales_price", gain="~_net_profit")
    web_returns = on(sent_back(t, "web", item="~_item_sk", number="~_order_number", day="~_returned_date_sk", back="~_return_amt", loss="~_net_loss"),
                     sold(t, "web", place="~_web_site_sk", sold_item="~_item_sk", sold_number="~_order_number"),
                     "item = sold_item and number = sold_number", "left").select("day", "back", "loss", "place")
    return channel_rollup([
        channel("store", sold(t, "store", place="~_store_sk", **columns),
                sent_back(t, "store", place="~_store_sk", day="~_returned_date_sk", back="~_return_amt", loss="~_net_loss"), t.store, "s_store_sk", "s_store_id", "store"),
        channel("catalog", sold(t, "catalog", place="~_catalog_page_sk", **columns),
                sent_back(t, "catalog", place="~_catalog_page_sk", day="~_returned_date_sk", back="~_return_amount", loss="~_net_loss"),
                t.catalog_page, "cp_catalog_page_sk", "cp_catalog_page_id", "catalog_page"),
        channel("web", sold(t, "web", place="~_web_site_sk", **columns), web_returns, t.web_site, "web_site_sk", "web_site_id", "web_site")])


_CHANNEL_OUT = "channel:s id:s sales:d returns:d profit:d"
_add("q5", q5, _CHANNEL_OUT, """
WITH days AS (SELECT d_date_sk FROM date_dim WHERE d_date >= {day} AND d_date <= {day} + 14),
moves(channel, id, sale, gain, back, loss) AS (
    SELECT 'store channel', 'store' || s_store_id, ss_ext_sales_price, ss_net_profit, 0, 0 FROM store_sales SEMI JOIN days ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk
    UNION ALL SELECT 'store channel', 'store' || s_store_id, 0, 0, sr_return_amt, sr_net_loss FROM store_returns SEMI JOIN days ON d_date_sk = sr_returned_date_sk JOIN store ON s_store_sk = sr_store_sk
    UNION ALL SELECT 'catalog channel', 'catalog_page' || cp_catalog_page_id, cs_ext_sales_price, cs_net_profit, 0, 0 FROM catalog_sales SEMI JOIN days ON d_date_sk = cs_sold_date_sk JOIN catalog_page ON cp_catalog_page_sk = cs_catalog_page_sk
    UNION ALL SELECT 'catalog channel', 'catalog_page' || cp_catalog_page_id, 0, 0, cr_return_amount, cr_net_loss FROM catalog_returns SEMI JOIN days ON d_date_sk = cr_returned_date_sk JOIN catalog_page ON cp_catalog_page_sk = cr_catalog_page_sk
    UNION ALL SELECT 'web channel', 'web_site' || web_site_id, ws_ext_sales_price, ws_net_profit, 0, 0 FROM web_sales SEMI JOIN days ON d_date_sk = ws_sold_date_sk JOIN web_site ON web_site_sk = ws_web_site_sk
    UNION ALL SELECT 'web channel', 'web_site' || web_site_id, 0, 0, wr_return_amt, wr_net_loss FROM web_returns SEMI JOIN days ON d_date_sk = wr_returned_date_sk
              JOIN web_sales ON (ws_item_sk, ws_order_number) = (wr_item_sk, wr_order_number) JOIN web_site ON web_site_sk = ws_web_site_sk)
SELECT channel, id, sum(sale) AS sales, sum(back) AS returns, sum(gain) - sum(loss) AS profit FROM moves GROUP BY ROLLUP (channel, id)""",
     order="channel, id", limit=100, params={"day": D(2000, 8, 23)})


def q6(t, p):
    usual = t.item.groupBy(F.col("i_category").alias("of_category")).agg(mean("i_current_price", "usual"))
    dear = on(t.item, usual, "i_category = of_category").where("i_current_price > 1.2 * usual").select("i_item_sk")
    bought = semi(on_days(t.store_sales, t, "ss_sold_date_sk", f"d_year = {p.year} and d_moy = {p.month}"), dear, "ss_item_sk = i_item_sk")
    placed = on(on(bought, t.customer, "ss_customer_sk = c_customer_sk"), t.customer_address, "c_current_addr_sk = ca_address_sk")
    return placed.groupBy(F.col("ca_state").alias("state")).agg(F.count("*").alias("cnt")).where(f"cnt >= {p.least}")


_add("q6", q6, "state:s cnt:l", """
WITH dear AS (SELECT i_item_sk FROM item WHERE i_category IS NOT NULL WINDOW c AS (PARTITION BY i_category)
              QUALIFY i_current_price > 1.2::DOUBLE * (sum(i_current_price) OVER c::DOUBLE / count(i_current_price) OVER c))
SELECT ca_state AS state, count(*) AS cnt
FROM store_sales SEMI JOIN dear ON i_item_sk = ss_item_sk JOIN customer ON c_customer_sk = ss_customer_sk JOIN customer_address ON ca_address_sk = c_current_addr_sk
     JOIN date_dim ON d_date_sk = ss_sold_date_sk
WHERE d_month_seq = (SELECT max(d_month_seq) FROM date_dim WHERE d_year = {year} AND d_moy = {month})
GROUP BY ca_state HAVING count(*) >= {least}""", order="cnt", limit=100, params={"year": 2001, "month": 1, "least": 10})


def item_averages(t, p):
    """q7, q26: average measures per item for one demographic group and promotion flag."""
    _, s, *_ = CHANNELS[p.channel]
    people = t.customer_demographics.where((F.col("cd_gender") == p.gender) & (F.col("cd_marital_status") == p.marital) & (F.col("cd_education_status") == p.education))
    lines = sold(t, p.channel, day="~_sold_date_sk", item="~_item_sk", who="ss_cdemo_sk" if s == "ss" else "~_bill_cdemo_sk", promo="~_promo_sk",
                 quantity="~_quantity", list="~_list_price", coupon="~_coupon_amt", price="~_sales_price")
    lines = semi(on_days(lines, t, "day", f"d_year = {p.year}"), people, "who = cd_demo_sk")
    lines = semi(lines, t.promotion.where("p_channel_email = 'N' or p_channel_event = 'N'"), "promo = p_promo_sk")
    return on(lines, t.item, "item = i_item_sk").groupBy("i_item_id").agg(mean("quantity", "agg1"), mean("list", "agg2"), mean("coupon", "agg3"), mean("price", "agg4"))


_AVERAGES_OUT = "i_item_id:s agg1:d agg2:d agg3:d agg4:d"
_AVERAGES_SQL = """
SELECT i_item_id, sum(~_quantity)::DOUBLE / count(~_quantity) AS agg1, sum(~_list_price)::DOUBLE / count(~_list_price) AS agg2,
       sum(~_coupon_amt)::DOUBLE / count(~_coupon_amt) AS agg3, sum(~_sales_price)::DOUBLE / count(~_sales_price) AS agg4
FROM #sales JOIN item ON i_item_sk = ~_item_sk
WHERE ~_sold_date_sk IN (SELECT d_date_sk FROM date_dim WHERE d_year = {year})
  AND ~_#cdemo_sk IN (SELECT cd_demo_sk FROM customer_demographics WHERE (cd_gender, cd_marital_status, cd_education_status) = ({gender}, {marital}, {education}))
  AND ~_promo_sk IN (SELECT p_promo_sk FROM promotion WHERE NOT (p_channel_email <> 'N' AND p_channel_event <> 'N'))
GROUP BY i_item_id"""
_AVERAGES = {"year": 2000, "gender": "M", "marital": "S", "education": "College"}
_add("q7", item_averages, _AVERAGES_OUT, _AVERAGES_SQL.replace("#sales", "store_sales").replace("~_#", "ss_").replace("~", "ss"), order="i_item_id", limit=100, params={"channel": "store", **_AVERAGES})
_add("q26", item_averages, _AVERAGES_OUT, _AVERAGES_SQL.replace("#sales", "catalog_sales").replace("~_#", "cs_bill_").replace("~", "cs"), order="i_item_id", limit=100, params={"channel": "catalog", **_AVERAGES})

# The zip list is a parameter; by default every 211th number from 10000 on.
ZIPS = [str(10000 + 211 * i) for i in range(400)]


def q8(t, p):
    listed = t.customer_address.select(F.substring("ca_zip", 1, 5).alias("zip")).where(F.col("zip").isin(p.zips))
    preferred = on(t.customer.where("c_preferred_cust_flag = 'Y'"), t.customer_address, "c_current_addr_sk = ca_address_sk")
    busy = preferred.groupBy(F.substring("ca_zip", 1, 5).alias("zip")).agg(F.count("*").alias("n")).where(f"n > {p.least}").select("zip")
    near = on(t.store, listed.intersect(busy), "substring(s_zip, 1, 2) = substring(zip, 1, 2)").select("s_store_sk", "s_store_name")
    return on(on_days(t.store_sales, t, "ss_sold_date_sk", f"d_qoy = {p.quarter} and d_year = {p.year}"), near, "ss_store_sk = s_store_sk").groupBy("s_store_name").agg(total("ss_net_profit", "profit"))


_add("q8", q8, "s_store_name:s profit:d", """
WITH zips AS (SELECT left(ca_zip, 5) AS zip FROM customer_address LEFT JOIN customer ON c_current_addr_sk = ca_address_sk AND c_preferred_cust_flag = 'Y'
              WHERE left(ca_zip, 5) IN ({zips}) GROUP BY 1 HAVING count(c_customer_sk) > {least})
SELECT s_store_name, sum(ss_net_profit) AS profit
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk JOIN zips ON left(zip, 2) = left(s_zip, 2)
WHERE d_year = {year} AND d_qoy = {quarter} GROUP BY s_store_name""", order="s_store_name", limit=100, params={"zips": ZIPS, "least": 10, "quarter": 2, "year": 1998})


def q9(t, p):
    """Five quantity bands in one scan: counts decide between two averages."""
    def band(i):
        inside = F.col("ss_quantity").between(20 * i + 1, 20 * i + 20)
        count = F.sum(inside.cast("int"))
        pick = [mean(F.when(inside, F.col(c))) for c in ("ss_ext_discount_amt", "ss_net_paid")]
        return F.when(count > p.limits[i], pick[0]).otherwise(pick[1]).alias(f"bucket{i + 1}")

    board = t.store_sales.agg(*[band(i) for i in range(5)])
    return one_row(t.reason.where("r_reason_sk = 1"), board)


_add("q9", q9, " ".join(f"bucket{i}:d" for i in range(1, 6)), """
WITH bands AS (SELECT (ss_quantity - 1) // 20 AS band, count(*) AS n, sum(ss_ext_discount_amt)::DOUBLE / count(ss_ext_discount_amt) AS off, sum(ss_net_paid)::DOUBLE / count(ss_net_paid) AS paid
               FROM store_sales GROUP BY 1),
chosen AS (SELECT band, CASE WHEN n > [{limits}][band + 1] THEN off ELSE paid END AS v FROM bands)
SELECT """ + ", ".join(f"max(v) FILTER (WHERE band = {i}) AS bucket{i + 1}" for i in range(5)) + " FROM chosen WHERE EXISTS (FROM reason WHERE r_reason_sk = 1)",
     params={"limits": [74129, 122840, 56580, 10097, 165306]}, tried={"limits": [1000, 122840, 2000, 10097, 165306]})


def active_people(t, days, since):
    """Keys of customers with a store sale, and with a web or catalog sale, in a period."""
    def who(channel, key):
        return on_days(sold(t, channel, who=key, day="~_sold_date_sk"), t, "day", days).select("who")

    people = semi(since, who("store", "ss_customer_sk"), "c_customer_sk = who")
    return semi(people, who("web", "ws_bill_customer_sk").unionByName(who("catalog", "cs_ship_customer_sk")), "c_customer_sk = who")


_ACTIVE_SQL = """customer JOIN customer_address ON ca_address_sk = c_current_addr_sk JOIN customer_demographics ON cd_demo_sk = c_current_cdemo_sk
     SEMI JOIN (SELECT ss_customer_sk FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk WHERE <<days>>) s ON s.ss_customer_sk = c_customer_sk
     SEMI JOIN (SELECT ws_bill_customer_sk AS c FROM web_sales JOIN date_dim ON d_date_sk = ws_sold_date_sk WHERE <<days>>
                UNION SELECT cs_ship_customer_sk FROM catalog_sales JOIN date_dim ON d_date_sk = cs_sold_date_sk WHERE <<days>>) o ON o.c = c_customer_sk"""
_Q10_KEYS = ["cd_gender", "cd_marital_status", "cd_education_status", "cd_purchase_estimate", "cd_credit_rating", "cd_dep_count", "cd_dep_employed_count", "cd_dep_college_count"]


def q10(t, p):
    people = semi(t.customer, t.customer_address.where(F.col("ca_county").isin(p.counties)), "c_current_addr_sk = ca_address_sk")
    active = active_people(t, f"d_year = {p.year} and d_moy between {p.month} and {p.month} + 3", people)
    groups = on(active, t.customer_demographics, "c_current_cdemo_sk = cd_demo_sk").groupBy(*_Q10_KEYS).agg(F.count("*").alias("n"))
    return groups.select(*_Q10_KEYS, *[F.col("n").alias(f"cnt{i}") for i in range(1, 7)])


_add("q10", q10, "cd_gender:s cd_marital_status:s cd_education_status:s cnt1:l cd_purchase_estimate:i cnt2:l cd_credit_rating:s cnt3:l cd_dep_count:i cnt4:l cd_dep_employed_count:i cnt5:l cd_dep_college_count:i cnt6:l",
     f"SELECT {', '.join(_Q10_KEYS)}, " + ", ".join(f"count(*) AS cnt{i}" for i in range(1, 7)) + "\nFROM " + _ACTIVE_SQL.replace("<<days>>", "d_year = {year} AND d_moy - {month} IN (0, 1, 2, 3)")
     + "\nWHERE ca_county IN ({counties})\nGROUP BY ALL", order=", ".join(_Q10_KEYS), limit=100,
     params={"counties": ["Rush County", "Toole County", "Jefferson County", "Dona Ana County", "La Porte County"], "year": 2002, "month": 1})

BOOK.add("tpcds.q11", **growth("q11", "q11", ["web", "store"], _GROWTH_OUT[:4]))


def class_share(t, p):
    """q12, q20, q98: item revenue and its share of the class."""
    lines = sold(t, p.channel, day="~_sold_date_sk", item="~_item_sk", amount="~_ext_sales_price")
    lines = on(on_days(lines, t, "day", day_window(p.day, 30)), t.item.where(F.col("i_category").isin(p.categories)), "item = i_item_sk")
    return share_of_class(lines.groupBy("i_item_id", "i_item_desc", "i_category", "i_class", "i_current_price").agg(total("amount", "itemrevenue")))


_SHARE_SQL = """
SELECT i_item_id, i_item_desc, i_category, i_class, i_current_price, sum(~_ext_sales_price) AS itemrevenue,
       sum(~_ext_sales_price)::DOUBLE * 100 / sum(sum(~_ext_sales_price)) OVER (PARTITION BY i_class)::DOUBLE AS revenueratio
FROM #sales JOIN item ON i_item_sk = ~_item_sk JOIN date_dim ON d_date_sk = ~_sold_date_sk
WHERE i_category IN ({categories}) AND d_date BETWEEN {day} AND {day} + 30
GROUP BY i_item_id, i_item_desc, i_category, i_class, i_current_price"""
SHARE_OUT = "i_item_id:s i_item_desc:s i_category:s i_class:s i_current_price:d itemrevenue:d revenueratio:d"
_SHARE = {"categories": ["Sports", "Books", "Home"], "day": D(1999, 2, 22)}
for _key, _channel in (("q12", "web"), ("q20", "catalog"), ("q98", "store")):
    _add(_key, class_share, SHARE_OUT if _key != "q98" else SHARE_OUT.replace("i_item_id:s", "i_item_id:s!"), _SHARE_SQL.replace("#sales", CHANNELS[_channel][0]).replace("~", CHANNELS[_channel][1]),
         order="i_category, i_class, i_item_id, i_item_desc, revenueratio",
         limit=None if _key == "q98" else 100, params={"channel": _channel, **_SHARE})


def _people_case(cases, price, extra=""):
    return " or ".join(f"(cd_marital_status = '{m}' and cd_education_status = '{e}' and {price} between {low} and {high}{extra.format(*rest)})" for m, e, low, high, *rest in cases)


def _place_case(cases, profit):
    return " or ".join(f"(ca_country = 'United States' and ca_state in ({quoted(states)}) and {profit} between {low} and {high})" for states, low, high in cases)


def demographic_sales(t, p):
    """q13, q48: store sales under OR-of-AND tests across people and places; the shared keys are the join keys."""
    lines = semi(on_days(t.store_sales, t, "ss_sold_date_sk", f"d_year = {p.year}"), t.store, "ss_store_sk = s_store_sk")
    if p.households:
        lines = on(lines, t.household_demographics, "ss_hdemo_sk = hd_demo_sk")
    lines = on(lines, t.customer_demographics, f"ss_cdemo_sk = cd_demo_sk and ({_people_case(p.people, 'ss_sales_price', ' and hd_dep_count = {}' if p.households else '')})")
    return on(lines, t.customer_address, f"ss_addr_sk = ca_address_sk and ({_place_case(p.places, 'ss_net_profit')})")


def q13(t, p):
    return demographic_sales(t, p).agg(mean("ss_quantity", "avg_quantity"), mean("ss_ext_sales_price", "avg_ext_sales_price"),
                                       mean("ss_ext_wholesale_cost", "avg_ext_wholesale_cost"), total("ss_ext_wholesale_cost", "sum_ext_wholesale_cost"))


_add("q13", q13, "avg_quantity:d avg_ext_sales_price:d avg_ext_wholesale_cost:d sum_ext_wholesale_cost:d", """
WITH people(ms, es, low, high, dep) AS (VALUES ('M', 'Advanced Degree', 100, 150, 3), ('S', 'College', 50, 100, 1), ('W', '2 yr Degree', 150, 200, 1)),
places(states, least, most) AS (VALUES (['TX', 'OH', 'TN'], -20000, 20000), (['OR', 'NM', 'KY'], 150, 300), (['VA', 'TX', 'MS'], 50, 250))
SELECT sum(ss_quantity)::DOUBLE / count(*) AS avg_quantity, sum(ss_ext_sales_price)::DOUBLE / count(*) AS avg_ext_sales_price,
       sum(ss_ext_wholesale_cost)::DOUBLE / count(*) AS avg_ext_wholesale_cost, sum(ss_ext_wholesale_cost) AS sum_ext_wholesale_cost
FROM store_sales JOIN date_dim ON d_date_sk = ss_sold_date_sk AND d_year = {year} JOIN store ON s_store_sk = ss_store_sk
     JOIN customer_demographics ON cd_demo_sk = ss_cdemo_sk JOIN household_demographics ON hd_demo_sk = ss_hdemo_sk JOIN customer_address ON ca_address_sk = ss_addr_sk
WHERE ca_country = 'United States'
  AND EXISTS (FROM people WHERE ms = cd_marital_status AND es = cd_education_status AND ss_sales_price >= low AND ss_sales_price <= high AND hd_dep_count >= 0)
  AND EXISTS (FROM places WHERE list_contains(states, ca_state) AND ss_net_profit >= least AND ss_net_profit <= most)""",
     params={"year": 2001, "households": True, "people": [("M", "Advanced Degree", 100, 150, 3), ("S", "College", 50, 100, 1), ("W", "2 yr Degree", 150, 200, 1)],
             "places": [(["TX", "OH"], 100, 200), (["OR", "NM", "KY"], 150, 300), (["VA", "TX", "MS"], 50, 250)]},
     # Any dependent count and a wide profit range: few sales of the small data meet the published values.
     tried={"people": [("M", "Advanced Degree", 100, 150, "hd_dep_count"), ("S", "College", 50, 100, "hd_dep_count"), ("W", "2 yr Degree", 150, 200, "hd_dep_count")],
            "places": [(["TX", "OH", "TN"], -20000, 20000), (["OR", "NM", "KY"], 150, 300), (["VA", "TX", "MS"], 50, 250)]})

_BRAND_KEY = ["i_brand_id", "i_class_id", "i_category_id"]


def kinds_by_channel(t, p, **periods):
    """One row for each channel and kind (brand, class, category) with what three years of sales add up to, and with sums (``sales_x``) and counts
    (``lines_x``) of the periods x, conditions on days: each sales fact is read once."""
    days = t.date_dim.where(f"d_year between {p.year} and {p.year} + 2").select("d_date_sk", *[c.alias(f"in_{x}") for x, c in periods.items()])

    def channel(place, name):
        lines = on(sold(t, name, day="~_sold_date_sk", item="~_item_sk", value="~_quantity * ~_list_price"), days, "day = d_date_sk")
        return lines.groupBy("item").agg(total("value", "amount"), F.count("value").alias("valued"), *[m for x in periods for m in (only((f"in_{x}", "value"), f"sales_{x}"), tally(f"in_{x}", f"lines_{x}"))]).withColumn("channel", F.lit(name)).withColumn("bit", F.lit(1 << place))

    items = functools.reduce(DataFrame.unionByName, [channel(i, n) for i, n in enumerate(CHANNELS)])
    # Item sums first: item keys are far fewer than sales. Sales of unknown items count in the average alone.
    sums = ["amount", "valued", *[f"{m}_{x}" for x in periods for m in ("sales", "lines")]]
    return on(items, t.item.select("i_item_sk", *_BRAND_KEY), "item = i_item_sk", "left").groupBy("channel", "bit", *_BRAND_KEY).agg(*[total(c, c) for c in sums])


def _big_groups(t, kinds, period, channels):
    """Kinds sold in all channels whose sales in a period beat the average sale; ``kinds`` is a written table, as it is asked three things."""
    everywhere = kinds.groupBy(*[F.col(k).alias(f"of_{k}") for k in _BRAND_KEY]).agg(F.bit_or("bit").alias("mask")).where(f"mask = {(1 << len(CHANNELS)) - 1}")
    average = kinds.agg(ratio(F.sum("amount"), F.sum("valued")).alias("average_sales"))
    groups = semi(kinds.where(F.col("channel").isin(channels)).where(f"lines_{period} > 0"), everywhere, " and ".join(f"{k} = of_{k}" for k in _BRAND_KEY))
    return one_row(groups, average).where(f"sales_{period} > average_sales").select("channel", *_BRAND_KEY, F.col(f"sales_{period}").alias("sales"), F.col(f"lines_{period}").alias("number_sales"))


def q14a(t, p):
    kinds = written(kinds_by_channel(t, p, month=F.expr(f"d_year = {p.year} + 2 and d_moy = 11")), "kinds")
    rows = _big_groups(t, kinds, "month", list(CHANNELS))
    return rows.rollup("channel", *_BRAND_KEY).agg(total("sales", "sum_sales"), total("number_sales", "sum_number_sales"))


def q14b(t, p):
    def week(year):
        return F.col("d_week_seq") == t.date_dim.where(f"d_year = {year} and d_moy = 12 and d_dom = 11").select("d_week_seq").scalar()

    kinds = written(kinds_by_channel(t, p, old=week(p.year), new=week(p.year + 1)), "kinds")
    new, old = _big_groups(t, kinds, "new", ["store"]), _big_groups(t, kinds, "old", ["store"])
    old = old.toDF(*["last_" + c for c in old.columns])
    return on(new.withColumnsRenamed({c: "this_" + c for c in new.columns}), old, " and ".join(f"this_{c} = last_{c}" for c in _BRAND_KEY))


_EVERYWHERE_SQL = """
WITH lines AS (SELECT 'store' AS channel, ss_sold_date_sk AS day, ss_item_sk AS item, ss_quantity * ss_list_price AS value FROM store_sales
               UNION ALL SELECT 'catalog', cs_sold_date_sk, cs_item_sk, cs_quantity * cs_list_price FROM catalog_sales
               UNION ALL SELECT 'web', ws_sold_date_sk, ws_item_sk, ws_quantity * ws_list_price FROM web_sales),
full_lines AS (SELECT * FROM lines JOIN date_dim ON d_date_sk = day JOIN item ON i_item_sk = item),
kinds AS (SELECT i_brand_id, i_class_id, i_category_id FROM full_lines WHERE d_year BETWEEN {year} AND {year} + 2 GROUP BY ALL HAVING count(DISTINCT channel) = 3),
usual AS (SELECT sum(value)::DOUBLE / count(value) AS v FROM lines JOIN date_dim ON d_date_sk = day WHERE d_year BETWEEN {year} AND {year} + 2),
"""
_add("q14a", q14a, "channel:s i_brand_id:i i_class_id:i i_category_id:i sum_sales:d sum_number_sales:l", _EVERYWHERE_SQL + """
big AS (SELECT channel, i_brand_id, i_class_id, i_category_id, sum(value) AS sales, count(*) AS n
        FROM full_lines SEMI JOIN kinds USING (i_brand_id, i_class_id, i_category_id) WHERE d_year = {year} + 2 AND d_moy = 11
        GROUP BY ALL HAVING sum(value) > (SELECT v FROM usual))
SELECT channel, i_brand_id, i_class_id, i_category_id, sum(sales) AS sum_sales, sum(n) AS sum_number_sales
FROM big GROUP BY ROLLUP (channel, i_brand_id, i_class_id, i_category_id)""", order="channel, i_brand_id, i_class_id, i_category_id", limit=100, params={"year": 1999})
_Q14B = [("channel", "s"), ("i_brand_id", "i"), ("i_class_id", "i"), ("i_category_id", "i"), ("sales", "d"), ("number_sales", "l")]
_add("q14b", q14b, " ".join(f"{side}_{c}:{k}" for side in ("this", "last") for c, k in _Q14B), _EVERYWHERE_SQL + """
big AS (SELECT d_week_seq AS week, 'store' AS channel, i_brand_id, i_class_id, i_category_id, sum(value) AS sales, count(*) AS number_sales
        FROM full_lines SEMI JOIN kinds USING (i_brand_id, i_class_id, i_category_id) WHERE channel = 'store'
        GROUP BY ALL HAVING sum(value) > (SELECT v FROM usual)),
weeks AS (SELECT d_year, d_week_seq AS week FROM date_dim WHERE d_moy = 12 AND d_dom = 11)
SELECT """ + ", ".join(f"{a}.{c} AS {side}_{c}" for a, side in (("n", "this"), ("o", "last")) for c, _ in _Q14B) + """
FROM big n JOIN big o USING (i_brand_id, i_class_id, i_category_id)
WHERE n.week = (SELECT week FROM weeks WHERE d_year = {year} + 1) AND o.week = (SELECT week FROM weeks WHERE d_year = {year})""",
     order="this_channel, this_i_brand_id, this_i_class_id, this_i_category_id", limit=100, params={"year": 1999})

# Zip prefixes of the published parameter set.
PUBLISHED_ZIPS = ["85669", "86197", "88274", "83405", "86475", "85392", "85460", "80348", "81792"]


def q15(t, p):
    lines = on(on_days(t.catalog_sales, t, "cs_sold_date_sk", f"d_qoy = {p.quarter} and d_year = {p.year}"), t.customer, "cs_bill_customer_sk = c_customer_sk")
    return on(lines, t.customer_address, f"c_current_addr_sk = ca_address_sk and (substr(ca_zip, 1, 5) in ({quoted(p.zips)}) or ca_state in ({quoted(p.states)}) or cs_sales_price > 500)"
              ).groupBy("ca_zip").agg(total("cs_sales_price", "sales"))


_add("q15", q15, "ca_zip:s sales:d", """
SELECT ca_zip, sum(cs_sales_price) AS sales
FROM catalog_sales JOIN customer ON c_customer_sk = cs_bill_customer_sk JOIN customer_address ON ca_address_sk = c_current_addr_sk JOIN date_dim ON d_date_sk = cs_sold_date_sk
WHERE d_year = {year} AND d_qoy = {quarter} AND (list_contains([{zips}], left(ca_zip, 5)) OR list_contains([{states}], ca_state) OR cs_sales_price > 500)
GROUP BY ca_zip""", order="ca_zip", limit=100, params={"zips": PUBLISHED_ZIPS, "states": ["CA", "WA", "GA"], "quarter": 2, "year": 2001}, tried={"zips": ["16330", "41650"]})


def shipped_orders(t, p):
    """q16, q94: orders that left more than one warehouse and never came back.

    "Another line of the order has another warehouse" is one min/max per order instead of a self-join.
    """
    _, s, returns, r, _ = CHANNELS[p.channel]
    lines = sold(t, p.channel, number="~_order_number", warehouse="~_warehouse_sk", shipped="~_ship_date_sk", place="~_ship_addr_sk", desk=p.desk_key, freight="~_ext_ship_cost", gain="~_net_profit")
    spread = lines.groupBy(F.col("number").alias("n")).agg(F.min("warehouse").alias("low"), F.max("warehouse").alias("high")).where("low <> high").select("n")
    lines = on_days(lines.where("warehouse is not null"), t, "shipped", day_window(p.day, p.days))
    lines = semi(semi(lines, t.customer_address.where(F.col("ca_state") == p.state), "place = ca_address_sk"), t.table(p.desk).where(p.desk_test), f"desk = {p.desk_sk}")
    kept = anti(semi(lines, spread, "number = n"), t.table(returns).select(F.col(f"{r}_order_number").alias("n")), "number = n")
    # One row per order, so that the distinct count needs no second shuffle.
    orders = kept.groupBy("number").agg(total("freight", "freight"), total("gain", "gain"))
    return orders.agg(F.count("*").alias("order_count"), total("freight", "total_shipping_cost"), total("gain", "total_net_profit"))


SHIP_OUT = "order_count:l total_shipping_cost:d total_net_profit:d"
_add("q16", shipped_orders, SHIP_OUT, """
SELECT count(DISTINCT cs_order_number) AS order_count, sum(cs_ext_ship_cost) AS total_shipping_cost, sum(cs_net_profit) AS total_net_profit
FROM catalog_sales one JOIN date_dim ON d_date_sk = cs_ship_date_sk JOIN customer_address ON ca_address_sk = cs_ship_addr_sk JOIN call_center ON cc_call_center_sk = cs_call_center_sk
WHERE d_date BETWEEN {day} AND {day} + {days} AND ca_state = {state} AND cc_county = 'Williamson County'
  AND EXISTS (FROM catalog_sales o WHERE o.cs_order_number = one.cs_order_number AND o.cs_warehouse_sk <> one.cs_warehouse_sk)
  AND one.cs_order_number NOT IN (SELECT cr_order_number FROM catalog_returns)""", limit=100,
     params={"channel": "catalog", "day": D(2002, 2, 1), "days": 60, "state": "GA", "desk": "call_center", "desk_key": "cs_call_center_sk", "desk_sk": "cc_call_center_sk",
             "desk_test": "cc_county = 'Williamson County'"}, tried={"day": D(1999, 2, 1), "days": 730})


def rebought(t, p):
    """q17, q25, q29: store sale, its return, and a later catalog purchase of the item by the same customer."""
    sales = semi(on_days(t.store_sales, t, "ss_sold_date_sk", p.sold_on), t.store, "ss_store_sk = s_store_sk")
    back = on_days(t.store_returns, t, "sr_returned_date_sk", p.returned_on)
    again = on_days(t.catalog_sales, t, "cs_sold_date_sk", p.again_on)
    lines = on(sales, back, "ss_customer_sk = sr_customer_sk and ss_item_sk = sr_item_sk and ss_ticket_number = sr_ticket_number")
    lines = on(lines, again, "sr_customer_sk = cs_bill_customer_sk and sr_item_sk = cs_item_sk")
    return on(on(lines, t.store, "ss_store_sk = s_store_sk"), t.item, "ss_item_sk = i_item_sk")


_REBOUGHT_SQL = """
FROM store_sales JOIN store_returns ON sr_customer_sk = ss_customer_sk AND (sr_item_sk, sr_ticket_number) = (ss_item_sk, ss_ticket_number)
     JOIN catalog_sales ON cs_bill_customer_sk = sr_customer_sk AND cs_item_sk = sr_item_sk
     JOIN date_dim a ON a.d_date_sk = ss_sold_date_sk JOIN date_dim b ON b.d_date_sk = sr_returned_date_sk JOIN date_dim c ON c.d_date_sk = cs_sold_date_sk
     JOIN store ON s_store_sk = ss_store_sk JOIN item ON i_item_sk = ss_item_sk
"""


def q17(t, p):
    def block(column, name):
        deviation = F.stddev_samp(column)
        return [F.count(column).alias(f"{name}_quantitycount"), mean(column, f"{name}_quantityave"), deviation.alias(f"{name}_quantitystdev"),
                F.try_divide(deviation, mean(column)).alias(f"{name}_quantitycov")]

    groups = rebought(t, p).groupBy("i_item_id", "i_item_desc", "s_state").agg(
        *block("ss_quantity", "store_sales"), *block("sr_return_quantity", "store_returns"), *block("cs_quantity", "catalog_sales"))
    # The published text reports stddev / average under the name of the catalog deviation.
    return groups.withColumn("catalog_sales_quantitystdev", F.col("catalog_sales_quantitycov"))


_Q17_BLOCKS = [("ss_quantity", "store_sales"), ("sr_return_quantity", "store_returns"), ("cs_quantity", "catalog_sales")]
_add("q17", q17, "i_item_id:s i_item_desc:s s_state:s " + " ".join(f"{n}_quantitycount:l {n}_quantityave:d {n}_quantitystdev:d6 {n}_quantitycov:d6" for _, n in _Q17_BLOCKS),
     "SELECT i_item_id, i_item_desc, s_state, " + ", ".join(
         f"count({c}) AS {n}_quantitycount, sum({c})::DOUBLE / count({c}) AS {n}_quantityave, "
         + (f"stddev_samp({c}) / avg({c})" if c == "cs_quantity" else f"stddev_samp({c})") + f" AS {n}_quantitystdev, stddev_samp({c}) / avg({c}) AS {n}_quantitycov" for c, n in _Q17_BLOCKS)
     + _REBOUGHT_SQL + "WHERE a.d_year = {year} AND b.d_year = {year} AND c.d_year = {year}\nGROUP BY i_item_id, i_item_desc, s_state",
     order="i_item_id, i_item_desc, s_state", limit=100,
     params={"year": 2001, "sold_on": "d_quarter_name = '2001Q1'", "returned_on": "d_quarter_name in ('2001Q1', '2001Q2', '2001Q3')", "again_on": "d_quarter_name in ('2001Q1', '2001Q2', '2001Q3')"},
     tried={"sold_on": "d_year = 2001", "returned_on": "d_year = 2001", "again_on": "d_year = 2001"})


def q25(t, p):
    return rebought(t, p).groupBy("i_item_id", "i_item_desc", "s_store_id", "s_store_name").agg(*[total(c, n) for c, n in p.sums])


def _rebought_report(key, sums, days, tried, where, year):
    _add(key, q25, "i_item_id:s i_item_desc:s s_store_id:s s_store_name:s " + " ".join(f"{n}:d" for _, n in sums),
         "SELECT i_item_id, i_item_desc, s_store_id, s_store_name, " + ", ".join(f"sum({c}) AS {n}" for c, n in sums) + _REBOUGHT_SQL + f"WHERE {where}\nGROUP BY ALL",
         order="i_item_id, i_item_desc, s_store_id, s_store_name", limit=100, params={"sums": sums, "year": year, **days}, tried=tried)


_rebought_report("q25", [("ss_net_profit", "store_sales_profit"), ("sr_net_loss", "store_returns_loss"), ("cs_net_profit", "catalog_sales_profit")],
                 {"sold_on": "d_moy = 4 and d_year = 2001", "returned_on": "d_moy between 4 and 10 and d_year = 2001", "again_on": "d_moy between 4 and 10 and d_year = 2001"},
                 {"sold_on": "d_moy < 9 and d_year = 2001"}, "(a.d_year, b.d_year, c.d_year) = ({year}, {year}, {year}) AND a.d_moy < 9 AND b.d_moy >= 4 AND b.d_moy <= 10 AND c.d_moy >= 4 AND c.d_moy <= 10", 2001)
_rebought_report("q29", [("ss_quantity", "store_sales_quantity"), ("sr_return_quantity", "store_returns_quantity"), ("cs_quantity", "catalog_sales_quantity")],
                 {"sold_on": "d_moy = 9 and d_year = 1999", "returned_on": "d_moy between 9 and 12 and d_year = 1999", "again_on": "d_year in (1999, 2000, 2001)"},
                 {}, "a.d_year = {year} AND a.d_moy = 9 AND b.d_year = {year} AND b.d_moy >= 9 AND c.d_year >= {year} AND c.d_year <= {year} + 2", 1999)


def q18(t, p):
    cuts = [("cs_quantity", "agg1"), ("cs_list_price", "agg2"), ("cs_coupon_amt", "agg3"), ("cs_sales_price", "agg4"), ("cs_net_profit", "agg5"), ("c_birth_year", "agg6"), ("cd_dep_count", "agg7")]
    people = t.customer_demographics.where((F.col("cd_gender") == p.gender) & (F.col("cd_education_status") == p.education))
    buyers = semi(t.customer.where(F.col("c_birth_month").isin(p.months)), renamed(t.customer_demographics, "own_", "cd_demo_sk"), "c_current_cdemo_sk = own_cd_demo_sk")
    lines = on(on_days(t.catalog_sales, t, "cs_sold_date_sk", f"d_year = {p.year}"), people, "cs_bill_cdemo_sk = cd_demo_sk")
    lines = on(on(lines, buyers, "cs_bill_customer_sk = c_customer_sk"), t.customer_address.where(F.col("ca_state").isin(p.states)), "c_current_addr_sk = ca_address_sk")
    return on(lines, t.item, "cs_item_sk = i_item_sk").rollup("i_item_id", "ca_country", "ca_state", "ca_county").agg(*[mean(c, n) for c, n in cuts])


_add("q18", q18, "i_item_id:s ca_country:s ca_state:s ca_county:s " + " ".join(f"agg{i}:d" for i in range(1, 8)),
     "SELECT i_item_id, ca_country, ca_state, ca_county, " + ", ".join(f"sum({c})::DOUBLE / count({c}) AS agg{i}" for i, c in enumerate(
         ["cs_quantity", "cs_list_price", "cs_coupon_amt", "cs_sales_price", "cs_net_profit", "c_birth_year", "buyer.cd_dep_count"], 1)) + """
FROM catalog_sales JOIN customer_demographics buyer ON buyer.cd_demo_sk = cs_bill_cdemo_sk JOIN customer ON c_customer_sk = cs_bill_customer_sk
     JOIN customer_demographics own ON own.cd_demo_sk = c_current_cdemo_sk JOIN customer_address ON ca_address_sk = c_current_addr_sk
     JOIN date_dim ON d_date_sk = cs_sold_date_sk JOIN item ON i_item_sk = cs_item_sk
WHERE d_year = {year} AND buyer.cd_gender = {gender} AND buyer.cd_education_status = {education} AND c_birth_month IN ({months}) AND ca_state IN ({states})
GROUP BY ROLLUP (i_item_id, ca_country, ca_state, ca_county)""", order="ca_country, ca_state, ca_county, i_item_id", limit=100,
     params={"gender": "F", "education": "Unknown", "months": [1, 6, 8, 9, 12, 2], "states": ["MS", "IN", "ND", "OK", "NM", "VA"], "year": 1998},
     tried={"states": ["MS", "IN", "ND", "OK", "NM", "VA", "TN", "GA"]})


def q19(t, p):
    lines = on(dated(t.store_sales, t, "ss_sold_date_sk", f"d_moy = {p.month} and d_year = {p.year}"), t.item.where(f"i_manager_id = {p.manager}"), "ss_item_sk = i_item_sk")
    lines = on(on(lines, t.customer, "ss_customer_sk = c_customer_sk"), t.customer_address, "c_current_addr_sk = ca_address_sk")
    away = on(lines, t.store, "ss_store_sk = s_store_sk and substr(ca_zip, 1, 5) <> substr(s_zip, 1, 5)")
    return away.groupBy("i_brand", "i_brand_id", "i_manufact_id", "i_manufact").agg(total("ss_ext_sales_price", "ext_price")).withColumnsRenamed({"i_brand_id": "brand_id", "i_brand": "brand"})


_add("q19", q19, "brand_id:i brand:s i_manufact_id:i i_manufact:s ext_price:d", """
SELECT i_brand_id AS brand_id, i_brand AS brand, i_manufact_id, i_manufact, sum(ss_ext_sales_price) AS ext_price
FROM store_sales JOIN item ON i_item_sk = ss_item_sk JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk
     JOIN customer ON c_customer_sk = ss_customer_sk JOIN customer_address ON ca_address_sk = c_current_addr_sk
WHERE i_manager_id = {manager} AND (d_year, d_moy) = ({year}, {month}) AND left(ca_zip, 5) <> left(s_zip, 5)
GROUP BY ALL""", order="ext_price desc, brand, brand_id, i_manufact_id, i_manufact", limit=100, params={"manager": 8, "month": 11, "year": 1998})
