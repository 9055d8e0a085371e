"""The older report set (v1.4), the interactive-kit sets and the scan/join probes, mostly as parameter sets of the same plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.verbs import mean, on, semi, total
from tallyframe.plans.registry import Book, Raw
from tallyframe.plans.tpcds import part1, part2, part3
from tallyframe.plans.tpcds.shared import D, dated, on_days

BOOK = Book()
_ALL = {**part1.BOOK, **part2.BOOK, **part3.BOOK}


def _base(name):
    return _ALL[f"tpcds.{name}"]


# --- v1.4 -----------------------------------------------------------------------------------------

_LONG_4, _LONG_11 = part1.growth("q4", "q4", ["catalog", "store", "web"], part1._GROWTH_OUT), part1.growth("q11", "q11", ["web", "store"], part1._GROWTH_OUT[3:4])


def q72_counts(t, p):
    """COUNT of an expression that is never NULL: all three counts are the number of rows."""
    return part3.q72(t, p).withColumn("no_promo", F.col("total_cnt")).withColumn("promo", F.col("total_cnt"))


def _q78_both_sql():
    return "WITH " + ",\n".join(part3._q78_side(c) for c in part3.CHANNELS) + """
SELECT ((200 * ss.q + ws.q + cs.q) // (2 * (ws.q + cs.q)))::DOUBLE / 100 AS ratio, ss.q AS store_qty, ss.w AS store_wholesale_cost, ss.p AS store_sales_price, ws.q + cs.q AS other_chan_qty,
       ifnull(ws.w, 0) + ifnull(cs.w, 0) AS other_chan_wholesale_cost, ifnull(ws.p, 0) + ifnull(cs.p, 0) AS other_chan_sales_price
FROM ss JOIN ws ON ws.i = ss.i AND ws.c = ss.c JOIN cs ON cs.i = ss.i AND cs.c = ss.c WHERE ws.q > 0 AND cs.q > 0"""


def q84_concat(t, p):
    """A NULL part of the name makes the whole name NULL."""
    return part3.q84(t, p).withColumn("customername", F.when(~F.col("customername").startswith(", ") & ~F.col("customername").endswith(", "), F.col("customername")))


_SHARE_14 = part1.SHARE_OUT.replace("i_item_id:s", "i_item_id:s!")
_CHANGED = {
    "q4": {k: v for k, v in _LONG_4.items() if k != "build"} | {"build": _LONG_4["build"]},
    "q6": {"params": {"year": 2000}, "tried": {"year": 2000}},
    "q9": {"params": {"limits": [1000000] * 5}, "tried": {"limits": [1000000] * 5}},
    "q11": _LONG_11,
    "q12": {"out": _SHARE_14},
    "q20": {"out": _SHARE_14},
    "q23a": {"params": {"share": 50}},
    "q23b": {"params": {"share": 50}},
    "q34": {"order": "c_last_name, c_first_name, c_salutation, c_preferred_cust_flag desc"},
    "q35": {"out": _base("q35").out.replace("cd_dep_count:i ", "cd_dep_count:i! ")},
    "q48": {"params": {"year": 2001}},
    "q63": {"params": {"kinds": part3._KINDS.replace("reference", "refernece")}, "sql": _base("q63").sql.replace("reference", "refernece")},
    "q72": {"build": q72_counts, "sql": _base("q72").sql.replace("count(*) - count(p_promo_sk) AS no_promo, count(p_promo_sk) AS promo", "count(*) AS no_promo, count(*) AS promo")},
    "q73": {"order": "cnt desc"},
    "q77": {"params": {"day": D(2000, 8, 3), "one_returns_row": True},
            "sql": _base("q77").sql.replace("SELECT 'catalog channel', cs.k, v, r, g - l FROM cs, cr", "SELECT 'catalog channel', cs.k, v, r, g - l FROM cs, (SELECT sum(r) AS r, sum(l) AS l FROM cr)")},
    "q78": {"params": {"link": "and"}, "sql": _q78_both_sql(), "out": "ratio:d store_qty:l store_wholesale_cost:d store_sales_price:d other_chan_qty:l other_chan_wholesale_cost:d other_chan_sales_price:d",
            "order": "ratio, store_qty desc, store_wholesale_cost desc, store_sales_price desc, other_chan_qty, other_chan_wholesale_cost, other_chan_sales_price"},
    "q84": {"build": q84_concat, "sql": _base("q84").sql.replace("ifnull(c_last_name, '') || ', ' || ifnull(c_first_name, '')", "c_last_name || ', ' || c_first_name")},
}
for _key in list(_ALL):
    _name = _key.removeprefix("tpcds.")
    if _name != "ss_maxb":
        BOOK.put(_ALL[_key].variant(f"tpcds14.{'qSsMax' if _name == 'ss_max' else _name}", **_CHANGED.get(_name, {})))

# The older queries that the published list marks as runnable (all but these).
NOT_RUNNABLE_14 = ["q6", "q10", "q14a", "q14b", "q16", "q23a", "q23b", "q24a", "q24b", "q30", "q32", "q33", "q35", "q41", "q45", "q56", "q58", "q60", "q69", "q70", "q81", "q83", "q92", "q94", "q95"]

# --- interactive kit ------------------------------------------------------------------------------

YEAR_98, YEAR_99, YEAR_00, YEAR_01 = (2450815, 2451179), (2451180, 2451544), (2451545, 2451910), (2451911, 2452275)
QUARTER_99 = (2451180, 2451269)
_PRIMARY = {"gender": "F", "marital": "W", "education": "Primary", "year": 1998}
_COUNTIES_34 = ["Saginaw County", "Sumner County", "Appanoose County", "Daviess County", "Fairfield County", "Raleigh County", "Ziebach County", "Williamson County"]
_DECEMBERS = " or ".join(f"d_date_sk between {a} and {b}" for a, b in ((2451149, 2451179), (2451514, 2451544), (2451880, 2451910), (2452245, 2452275), (2452610, 2452640)))


def plain_periods(t, p):
    """q53, q63, q89 of the kit: period sums without the deviation window."""
    lines = on(dated(t.store_sales, t, "ss_sold_date_sk", p.days), t.item.where(p.kinds), "ss_item_sk = i_item_sk")
    return on(lines, t.store, "ss_store_sk = s_store_sk").groupBy(*p.keys).agg(total("ss_sales_price", "sum_sales"))


def plain_items(t, p):
    """q98 of the kit: item revenue of one month."""
    lines = on(on_days(t.store_sales, t, "ss_sold_date_sk", p.days), t.item.where(F.col("i_category").isin(p.categories)), "ss_item_sk = i_item_sk")
    return lines.groupBy("i_item_id", "i_item_desc", "i_category", "i_class", "i_current_price").agg(total("ss_ext_sales_price", "itemrevenue"))


def plain_averages(t, p):
    """q27 of the kit: averages per item and state, no rollup."""
    people = t.customer_demographics.where((F.col("cd_gender") == p.gender) & (F.col("cd_marital_status") == p.marital) & (F.col("cd_education_status") == p.education))
    lines = semi(on_days(t.store_sales, t, "ss_sold_date_sk", f"d_year = {p.year}"), people, "ss_cdemo_sk = cd_demo_sk")
    lines = on(on(lines, t.store.where(F.col("s_state").isin(p.states)), "ss_store_sk = s_store_sk"), t.item, "ss_item_sk = i_item_sk")
    return lines.groupBy("i_item_id", "s_state").agg(mean("ss_quantity", "agg1"), mean("ss_list_price", "agg2"), mean("ss_coupon_amt", "agg3"), mean("ss_sales_price", "agg4"))


def zip_join(t, p):
    """q8 of the kit: the common zips by a join of distinct values instead of INTERSECT."""
    listed = t.customer_address.select(F.substring("ca_zip", 1, 5).alias("zip")).where(F.col("zip").isin(p.zips)).distinct()
    preferred = on(t.customer.where("c_preferred_cust_flag = 'Y'"), t.customer_address, "c_current_addr_sk = ca_address_sk")
    busy = preferred.groupBy(F.substring("ca_zip", 1, 5).alias("busy")).agg(F.count("*").alias("n")).where(f"n > {p.least}")
    near = on(t.store, on(listed, busy, "zip = busy"), "substring(s_zip, 1, 2) = substring(zip, 1, 2)").select("s_store_sk", "s_store_name")
    return on(on_days(t.store_sales, t, "ss_sold_date_sk", f"d_qoy = {p.quarter} and d_year = {p.year}"), near, "ss_store_sk = s_store_sk").groupBy("s_store_name").agg(total("ss_net_profit", "profit"))


def _plain_sql(keys, kinds, days):
    return (f"SELECT {', '.join(keys)}, sum(ss_sales_price) AS sum_sales FROM store_sales JOIN item ON i_item_sk = ss_item_sk JOIN date_dim ON d_date_sk = ss_sold_date_sk JOIN store ON s_store_sk = ss_store_sk\n"
            f"WHERE ({days}) AND ({kinds}) GROUP BY ALL")


def _kit(name, base, **changes):
    BOOK.put(_base(base).variant(name, **changes))


def _shared(prefix, kit):
    """Reports that both kits have; the modified kit adds a partition range."""
    def pruned(low_high):
        return {"pruned": low_high} if kit else {}

    _kit(f"{prefix}.q3", "q3", params={"items": Raw("i_manufact_id = 436"), "days": Raw(f"d_moy = 12 and ({_DECEMBERS})" if kit else "d_moy = 12")})
    _kit(f"{prefix}.q7", "q7", params=_PRIMARY, **pruned(YEAR_98))
    _kit(f"{prefix}.q19", "q19", params={"manager": 7, "month": 11, "year": 1999}, **pruned((2451484, 2451513)))
    _kit(f"{prefix}.q42", "q42", params={"items": Raw("i_manager_id = 1"), "days": Raw("d_moy = 12 and d_year = 1998")}, **pruned((2451149, 2451179)))
    _kit(f"{prefix}.q43", "q43", params={"year": 1998}, **pruned(YEAR_98))
    _kit(f"{prefix}.q52", "q52", params={"items": Raw("i_manager_id = 1"), "days": Raw("d_moy = 12 and d_year = 1998")}, **pruned((2451149, 2451179)))
    _kit(f"{prefix}.q55", "q55", params={"items": Raw("i_manager_id = 36"), "days": Raw("d_moy = 12 and d_year = 2001")}, **pruned((2452245, 2452275)))
    _kit(f"{prefix}.q46", "q46", params={"dependents": 5, "cities": ["Midway", "Concord", "Spring Hill", "Brownsville", "Greenville"] if kit else ["Midway", "Fairview"]}, **pruned((2451181, 2452274)))
    # The kit reads one year of sales for both years it compares, so no pair is left 52 weeks apart but at the seam.
    _kit(f"{prefix}.q59", "q59", params={"first": 1185}, pruned=(2451088, 2451452), tried={"first": 1185})


_shared("impala", True)
_shared("impala_orig", False)

_kit("impala_orig.q27", "q27", params={**_PRIMARY, "states": ["TN"]})
_kit("impala_orig.q34", "q34", params={"year": 1998})
_kit("impala_orig.q68", "q68", params={"dependents": 5})
_kit("impala_orig.q73", "q73", params={"year": 1998, "low": 5, "high": 10}, tried={"low": 1})
_kit("impala_orig.qSsMax", "ss_max")


def q79_kit(t, p):
    homes = t.household_demographics.where("hd_dep_count = 8 or hd_vehicle_count > 0")
    lines = semi(on_days(t.store_sales, t, "ss_sold_date_sk", p.days), homes, "ss_hdemo_sk = hd_demo_sk")
    lines = on(lines, t.store.where("s_number_employees between 200 and 295"), "ss_store_sk = s_store_sk")
    tickets = lines.groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "s_city").agg(total("ss_coupon_amt", "amt"), total("ss_net_profit", "profit"))
    return on(tickets, t.customer, "ss_customer_sk = c_customer_sk").withColumn("city", F.substring("s_city", 1, 30))


_Q79_SQL = _base("q79").sql.replace("d_day_name = 'Monday' AND d_year IN ({year}, {year} + 1, {year} + 2)", "{days}").replace("(hd_dep_count = 6 OR hd_vehicle_count > 2)", "(hd_dep_count = 8 OR hd_vehicle_count > 0)")
_kit("impala_orig.q79", "q79", build=q79_kit, sql=_Q79_SQL, params={"days": Raw("d_dow = 1 and d_year in (1998, 1999, 2000)")})
_kit("impala.q79", "q79", build=q79_kit, sql=_Q79_SQL, params={"days": Raw("d_dow = 1 and d_year in (1998, 1999, 2000) and d_date between date '1999-01-01' and date '1999-03-31'")}, pruned=QUARTER_99)

BOOK.add("impala.q27", plain_averages, "i_item_id:s s_state:s agg1:d agg2:d agg3:d agg4:d", _base("q27").sql.replace("ROLLUP (i_item_id, s_state)", "i_item_id, s_state").replace("grouping(s_state) AS g_state, ", ""),
         order="i_item_id, s_state", limit=100, params={**_PRIMARY, "states": ["WI", "CA", "TX", "FL", "WA", "TN"]}, pruned=YEAR_98)
_kit("impala.q34", "q34", params={"year": 1998, "counties": _COUNTIES_34}, limit=1000, order="c_last_name, c_first_name, c_salutation, c_preferred_cust_flag desc, ss_ticket_number, cnt", pruned=(2450816, 2451910))
_kit("impala.q65", "q65", params={"first": 1212}, pruned=YEAR_01)
_kit("impala.q68", "q68", params={"dependents": 5, "days": "d_date between date '1999-01-01' and date '1999-03-31'"}, sql=_base("q68").sql.replace("d_dom <= 2", "quarter(d_date) = 1 AND d_year = 1999"), pruned=QUARTER_99)
_kit("impala.q73", "q73", params={"year": 1998, "days": "d_date_sk > 0"}, sql=_base("q73").sql.replace("d_dom <= 2", "true"), limit=1000, order="cnt desc", pruned=QUARTER_99)
_kit("impala.q8", "q8", build=zip_join, params={"year": 1999}, pruned=(2451271, 2451361))
# The kit filters inventory by a column the schema lacks; the day comes from the calendar here.
_kit("impala.q82", "q82", params={"price": 30, "makers": [437, 129, 727, 663], "day": D(2002, 5, 30)}, tried={"makers": list(range(400, 500))})
_kit("impala.ss_max", "ss_max")
_YEAR_2001 = "d_month_seq between 1212 and 1223"
for _key, _keys, _kinds, _days, _out, _order, _pruned in (
        ("q53", ["i_manufact_id", "d_qoy"], part3._KINDS, _YEAR_2001, "i_manufact_id:i sum_sales:d", "sum_sales, i_manufact_id", YEAR_01),
        ("q63", ["i_manager_id", "d_moy"], part3._KINDS.replace("reference", "refernece"), _YEAR_2001, "i_manager_id:i sum_sales:d", "i_manager_id, sum_sales", YEAR_01),
        ("q89", ["i_category", "i_class", "i_brand", "s_store_name", "s_company_name", "d_moy"],
         "(i_category in ('Home', 'Books', 'Electronics') and i_class in ('wallpaper', 'parenting', 'musical')) or (i_category in ('Shoes', 'Jewelry', 'Men') and i_class in ('womens', 'birdal', 'pants'))",
         "d_year = 2000", "i_category:s i_class:s i_brand:s s_store_name:s s_company_name:s d_moy:i sum_sales:d", "sum_sales, s_store_name", YEAR_00)):
    BOOK.add(f"impala.{_key}", plain_periods, _out, _plain_sql(_keys, _kinds, _days), order=_order, limit=100, params={"keys": _keys, "kinds": _kinds, "days": _days}, pruned=_pruned)
BOOK.add("impala.q98", plain_items, "i_item_id:s! i_item_desc:s i_category:s i_class:s i_current_price:d itemrevenue:d", """
SELECT i_item_id, i_item_desc, i_category, i_class, i_current_price, sum(ss_ext_sales_price) AS itemrevenue
FROM store_sales JOIN item ON i_item_sk = ss_item_sk JOIN date_dim ON d_date_sk = ss_sold_date_sk WHERE i_category IN ({categories}) AND {days}
GROUP BY ALL""", order="i_category, i_class, i_item_id, i_item_desc", limit=1000,
         params={"categories": ["Jewelry", "Sports", "Books"], "days": Raw("d_date between date '2001-01-01' and date '2001-01-31'")}, pruned=(2451911, 2451941))

# Name lists of the kit.
INTERACTIVE = [f"impala.q{n}" for n in (19, 42, 52, 55, 63, 68, 73, 98)]
REPORTING = [f"impala.q{n}" for n in (3, 7, 27, 43, 53, 89)]
DEEP_ANALYTIC = [f"impala.q{n}" for n in (34, 46, 59, 65, 79)] + ["impala.ss_max"]

# --- scan and join probes -------------------------------------------------------------------------


def scan_item(t, p):
    return t.store_sales.where(f"ss_item_sk = {p.item}")


def fact_fact(t, p):
    return on(t.store_sales.select("ss_item_sk", "ss_ticket_number"), t.store_returns.select("sr_item_sk", "sr_ticket_number"), "ss_item_sk = sr_item_sk and ss_ticket_number = sr_ticket_number").agg(F.count("*").alias("cnt"))


_SCAN = ["ss_quantity", "ss_list_price", "ss_coupon_amt", "ss_cdemo_sk", "ss_item_sk", "ss_promo_sk", "ss_sold_date_sk"]
_OUT = {"ss_quantity": "i", "ss_list_price": "d", "ss_coupon_amt": "d", "ss_cdemo_sk": "i", "ss_item_sk": "i", "ss_promo_sk": "i", "ss_sold_date_sk": "i", "ss_sales_price": "d", "i_item_id": "s"}


def _out(columns):
    return " ".join(f"{c}:{_OUT[c]}" for c in columns)


def date_scan(t, p):
    return t.store_sales.select(*_SCAN).select("*", F.col("ss_coupon_amt").alias("ss_coupon_amt_2"))


def _primary_buyers(t):
    return t.customer_demographics.where("cd_gender = 'F' and cd_marital_status = 'W' and cd_education_status = 'Primary'")


def two_joins(t, p):
    return on(semi(t.store_sales, _primary_buyers(t), "ss_cdemo_sk = cd_demo_sk"), t.item, "ss_item_sk = i_item_sk")


def four_joins(t, p):
    lines = semi(two_joins(t, p), t.promotion.where("p_channel_email = 'N' or p_channel_event = 'N'"), "ss_promo_sk = p_promo_sk")
    return on_days(lines, t, "ss_sold_date_sk", "d_year = 1998")


def _year_98(t):
    return t.store_sales.where(f"ss_sold_date_sk between {YEAR_98[0]} and {YEAR_98[1]}")


def _repeated(df, block: int = 65536):
    """Each row ``n`` times, by two levels of blocks, so that no row carries an array as long as a hot key is frequent."""
    blocks = df.select("*", F.explode(F.expr(f"sequence(0L, (n - 1) div {block})")).alias("b"))
    return blocks.select(*_SCAN, F.explode(F.expr(f"sequence(1L, least({block}, n - b * {block}))")).alias("match")).select(*_SCAN)


def self_join_many(t, p):
    """Every sale once per sale of the same item.

    The right side contributes only its number of matches, so it is counted per item and each row repeated locally:
    a hot item costs no shuffle of its pairs.
    """
    matches = t.store_sales.groupBy(F.col("ss_item_sk").alias("k")).agg(F.count("*").alias("n"))
    return _repeated(on(_year_98(t).select(*_SCAN), matches, "ss_item_sk = k"))


def self_join_pk(t, p):
    matches = t.store_sales.groupBy(F.col("ss_item_sk").alias("k"), F.col("ss_ticket_number").alias("ticket")).agg(F.count("*").alias("n"))
    return _repeated(on(_year_98(t), matches, "ss_item_sk = k and ss_ticket_number = ticket"))


BOOK.add("simple.scan", scan_item, "ss_sold_date_sk:i ss_sold_time_sk:i ss_item_sk:i ss_customer_sk:i ss_cdemo_sk:i ss_hdemo_sk:i ss_addr_sk:i ss_store_sk:i ss_promo_sk:i ss_ticket_number:l ss_quantity:i "
         + " ".join(f"ss_{c}:d" for c in ("wholesale_cost", "list_price", "sales_price", "ext_discount_amt", "ext_sales_price", "ext_wholesale_cost", "ext_list_price", "ext_tax", "coupon_amt", "net_paid", "net_paid_inc_tax", "net_profit")),
         "SELECT * FROM store_sales WHERE ss_item_sk = {item}", params={"item": 1})
BOOK.add("simple.fact_fact", fact_fact, "cnt:l", "SELECT count(*) AS cnt FROM store_sales JOIN store_returns ON (sr_item_sk, sr_ticket_number) = (ss_item_sk, ss_ticket_number)")
BOOK.add("simple.q7_scan", date_scan, _out(_SCAN) + " ss_coupon_amt_2:d", f"SELECT {', '.join(_SCAN)}, ss_coupon_amt AS ss_coupon_amt_2 FROM store_sales", pruned=YEAR_98)
_TWO = ["i_item_id", "ss_quantity", "ss_list_price", "ss_coupon_amt", "ss_sales_price", "ss_promo_sk", "ss_sold_date_sk"]
_TWO_SQL = "FROM store_sales JOIN item ON i_item_sk = ss_item_sk JOIN customer_demographics ON cd_demo_sk = ss_cdemo_sk AND (cd_gender, cd_marital_status, cd_education_status) = ('F', 'W', 'Primary')"
_FOUR_SQL = _TWO_SQL + "\n     JOIN promotion ON p_promo_sk = ss_promo_sk AND (p_channel_email = 'N' OR p_channel_event = 'N') JOIN date_dim ON d_date_sk = ss_sold_date_sk AND d_year = 1998"
BOOK.add("simple.q7_two_joins", two_joins, _out(_TWO), f"SELECT {', '.join(_TWO)} {_TWO_SQL}", pruned=YEAR_98)
BOOK.add("simple.q7_four_joins", four_joins, _out(_TWO[:5]), f"SELECT {', '.join(_TWO[:5])} {_FOUR_SQL}", pruned=YEAR_98)
BOOK.put(_base("q7").variant("simple.q7_no_order", params=_PRIMARY, order="", limit=None, pruned=YEAR_98))
BOOK.put(_base("q7").variant("simple.q7", params=_PRIMARY, pruned=YEAR_98))
for _key, _build, _on in (("selfjoin_many", self_join_many, "b.ss_item_sk = a.ss_item_sk"), ("selfjoin_pk", self_join_pk, "b.ss_item_sk = a.ss_item_sk AND b.ss_ticket_number = a.ss_ticket_number")):
    BOOK.add(f"simple.{_key}", _build, _out(_SCAN), f"SELECT {', '.join('a.' + c for c in _SCAN)} FROM (SELECT * FROM store_sales WHERE ss_sold_date_sk BETWEEN {YEAR_98[0]} AND {YEAR_98[1]}) a JOIN store_sales b ON {_on}")
