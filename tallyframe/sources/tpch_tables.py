"""The eight order-processing tables, completed from the narrower tables that are given.

Every missing column is a fixed rule over keys, so that any engine gets the same value without a
lookup. ``partsupp`` is the distinct (part, supplier) pairs of ``lineitem``.
"""

from __future__ import annotations

from tallyframe.sources.wording import columns, idiv, pick

# Word lists of the public order-processing benchmark.
FINISHES = ["ANODIZED", "BURNISHED", "PLATED", "POLISHED", "BRUSHED"]
METALS = ["TIN", "NICKEL", "BRASS", "STEEL", "COPPER"]
BOX_SIZES = ["SM", "MED", "LG", "JUMBO", "WRAP"]
BOX_KINDS = ["CASE", "BOX", "PACK", "PKG", "BAG", "JAR", "DRUM", "CAN"]
SHIP_MODES = ["REG AIR", "AIR", "RAIL", "SHIP", "TRUCK", "MAIL", "FOB", "AIR REG"]
SHIP_INSTRUCTIONS = ["DELIVER IN PERSON", "COLLECT COD", "NONE", "TAKE BACK RETURN"]

MONEY = "decimal(12,2)"


def _phone(key: str, nation: str) -> str:
    return f"concat(cast({nation} + 10 as string), '-', lpad(cast({key} % 1000 as string), 3, '0'), '-', lpad(cast(({key} * 7) % 10000 as string), 4, '0'))"


_SHIPPED = "cast(l_shipdate as date)"

TABLES: dict[str, str] = {
    "region": "select " + columns({
        "r_regionkey": ("bigint", "r_regionkey"),
        "r_name": ("string", "r_name"),
        "r_comment": ("string", "concat('region ', r_name)"),
    }) + " from {region}",
    "nation": "select " + columns({
        "n_nationkey": ("bigint", "n_nationkey"),
        "n_name": ("string", "n_name"),
        "n_regionkey": ("bigint", "n_regionkey"),
        "n_comment": ("string", "concat('nation ', n_name)"),
    }) + " from {nation}",
    "part": "select " + columns({
        "p_partkey": ("bigint", "p_partkey"),
        "p_name": ("string", "p_name"),
        "p_mfgr": ("string", "concat('Manufacturer#', cast(p_partkey % 5 + 1 as string))"),
        "p_brand": ("string", "p_brand"),
        "p_type": ("string", f"concat(p_type, ' ', {pick(FINISHES, 'p_partkey % 5')}, ' ', {pick(METALS, idiv('p_partkey', 5) + ' % 5')})"),
        "p_size": ("int", "p_size"),
        "p_container": ("string", f"concat({pick(BOX_SIZES, 'p_partkey % 5')}, ' ', {pick(BOX_KINDS, idiv('p_partkey', 3) + ' % 8')})"),
        "p_retailprice": (MONEY, "p_retailprice"),
        "p_comment": ("string", "concat('part ', p_name)"),
    }) + " from {part}",
    "supplier": "select " + columns({
        "s_suppkey": ("bigint", "s_suppkey"),
        "s_name": ("string", "s_name"),
        "s_address": ("string", "concat('Dock ', cast(s_suppkey * 3 as string))"),
        "s_nationkey": ("bigint", "s_nationkey"),
        "s_phone": ("string", _phone("s_suppkey", "s_nationkey")),
        "s_acctbal": (MONEY, "s_acctbal"),
        "s_comment": ("string", "case when s_suppkey % 20 = 7 then 'slow Customer service, Complaints' else 'steady supplier' end"),
    }) + " from {supplier}",
    "partsupp": "select " + columns({
        "ps_partkey": ("bigint", "pk"),
        "ps_suppkey": ("bigint", "sk"),
        "ps_availqty": ("int", "(pk * 7 + sk * 13) % 9999 + 1"),
        "ps_supplycost": (MONEY, "cast((pk * 31 + sk * 17) % 100000 as decimal(12,0)) * 0.01"),
        "ps_comment": ("string", "concat('stock ', cast(pk as string))"),
    }) + " from (select distinct l_partkey as pk, l_suppkey as sk from {lineitem}) pairs",
    "customer": "select " + columns({
        "c_custkey": ("bigint", "c_custkey"),
        "c_name": ("string", "c_name"),
        "c_address": ("string", "concat('Street ', cast(c_custkey * 11 as string))"),
        "c_nationkey": ("bigint", "c_nationkey"),
        "c_phone": ("string", _phone("c_custkey", "c_nationkey")),
        "c_acctbal": (MONEY, "c_acctbal"),
        "c_mktsegment": ("string", "c_mktsegment"),
        "c_comment": ("string", "concat('buyer ', c_mktsegment)"),
    }) + " from {customer}",
    "orders": "select " + columns({
        "o_orderkey": ("bigint", "o_orderkey"),
        # Customers with a key divisible by three never order.
        "o_custkey": ("bigint", "o_custkey + case when o_custkey % 3 = 0 then 1 else 0 end"),
        "o_orderstatus": ("string", "o_orderstatus"),
        "o_totalprice": (MONEY, "o_totalprice"),
        "o_orderdate": ("date", "o_orderdate"),
        "o_orderpriority": ("string", "o_orderpriority"),
        "o_clerk": ("string", "concat('Clerk#', lpad(cast(o_orderkey % 1000 as string), 9, '0'))"),
        "o_shippriority": ("int", "0"),
        "o_comment": ("string", "case when o_orderkey % 9 = 4 then 'has special delivery requests' else 'plain order' end"),
    }) + " from {orders}",
    "lineitem": "select " + columns({
        "l_orderkey": ("bigint", "l_orderkey"),
        "l_partkey": ("bigint", "l_partkey"),
        "l_suppkey": ("bigint", "l_suppkey"),
        "l_linenumber": ("int", "l_linenumber"),
        "l_quantity": (MONEY, "l_quantity"),
        "l_extendedprice": (MONEY, "l_extendedprice"),
        "l_discount": (MONEY, "l_discount"),
        "l_tax": (MONEY, "l_tax"),
        "l_returnflag": ("string", "l_returnflag"),
        "l_linestatus": ("string", "l_linestatus"),
        "l_shipdate": ("date", "l_shipdate"),
        "l_commitdate": ("date", f"{_SHIPPED} + cast((l_orderkey * 3 + l_linenumber) % 60 - 30 as int)"),
        "l_receiptdate": ("date", f"{_SHIPPED} + cast(1 + (l_orderkey + l_linenumber) % 30 as int)"),
        "l_shipinstruct": ("string", pick(SHIP_INSTRUCTIONS, "l_partkey % 4")),
        "l_shipmode": ("string", pick(SHIP_MODES, "(l_orderkey + l_linenumber) % 8")),
        "l_comment": ("string", "concat('line ', cast(l_linenumber as string))"),
    }) + " from {lineitem}",
}
