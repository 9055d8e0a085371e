"""Tables that are written, registered, recovered, bucketed, analysed and described, and reports on them."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.verbs import on, one_row, total
from tallyframe.plans import micro, tpch
from tallyframe.plans.registry import Book
from tallyframe.plans.tpcds import part1, part2, part3, variants
from tallyframe.sources import layout as S
from tallyframe.sources import stored
from tallyframe.sources.catalog import SUITES

BOOK = Book()
_REPORTS = {**tpch.BOOK, **part1.BOOK, **part2.BOOK, **part3.BOOK, **variants.BOOK}


def _add(key, build, out, sql=None, suite="tpch", **rest):
    BOOK.add(key, build, out, sql, suite=suite, **rest)


# --- registration and recovery --------------------------------------------------------------------


def external(t, p):
    """A sales fact in a folder for each day, registered where it lies, its partitions recovered, read back whole."""
    store = stored.store_of(t)
    return store.spark.table(store.partitioned("store_sales"))


_scan = variants.BOOK["simple.scan"]
_add("io.external_table", external, _scan.out, "SELECT * FROM store_sales", suite="tpcds")


def recovered(t, p):
    """Stock counts by day: what the catalog shows of folders that came after registration, before and after recovery."""
    store = stored.store_of(t)
    folder, table = stored.scratch(t.spark, "recover") + "/inventory", f"{store.database}.inventory_{uuid.uuid4().hex[:8]}"
    S.write_table(t.inventory.where(f"inv_date_sk <= {p.until}"), folder, partition_by=["inv_date_sk"])
    S.external_table(t.spark, table, folder, partitioned=True)
    S.append_table(t.inventory.where(f"inv_date_sk > {p.until}"), folder, ["inv_date_sk"])

    def days(state):
        return t.spark.table(table).groupBy("inv_date_sk").agg(F.count("*").alias("rows"), total("inv_quantity_on_hand", "on_hand")).select(F.lit(state).alias("state"), "*")

    before = S.save_result(days("before"), stored.scratch(t.spark, "recover"), "before")
    S.recover_partitions(t.spark, table)
    return t.spark.read.parquet(before).unionByName(days("after"))


_add("io.recover_partitions", recovered, "state:s inv_date_sk:i rows:l on_hand:l", """
SELECT state, inv_date_sk, count(*) AS rows, sum(inv_quantity_on_hand) AS on_hand FROM inventory, (VALUES ('before', {until}), ('after', 9999999)) AS states(state, until)
WHERE inv_date_sk <= until GROUP BY 1, 2""", suite="tpcds", params={"until": 2452000})


def viewed(t, p):
    store = stored.store_of(t)
    store.plain("supplier")
    view = f"supplier_{uuid.uuid4().hex[:8]}"
    S.temp_view(t.spark, view, store.path("supplier_plain"))
    return t.spark.table(view)


_SUPPLIER = "s_suppkey:l s_name:s s_address:s s_nationkey:l s_phone:s s_acctbal:d s_comment:s"
_add("io.temp_view", viewed, _SUPPLIER, "SELECT * FROM supplier")


def filtered(t, p):
    """Only one table of a suite written; the others are not there."""
    folder = stored.scratch(t.spark, "filtered")
    S.write_suite(t, folder, only="supplier")
    assert not any(stored.is_complete(t.spark, f"{folder}/tpch/{n}") for n in SUITES["tpch"] if n != "supplier")
    return stored.written_suite(t.spark, folder, t.folder, "tpch", ["supplier"]).supplier


_add("io.table_filter", filtered, _SUPPLIER, "SELECT * FROM supplier")


def database(t, p):
    """A database over the written tables of a suite: what it lists, and how many rows each name gives."""
    store, name = stored.store_of(t), f"tallyframe_{uuid.uuid4().hex[:12]}"
    session = stored.session_like(t.spark)
    S.create_database(session, name)
    for table in p.tables:
        store.plain(table)
        S.external_table(session, f"{name}.{table}", store.path(f"{table}_plain"))
    listed = session.sql(f"SHOW TABLES IN {name}").select(F.col("tableName").alias("name"))
    counts = functools.reduce(DataFrame.unionByName, [session.table(f"{name}.{n}").agg(F.count("*").alias("rows")).select(F.lit(n).alias("counted"), "rows") for n in p.tables])
    return on(listed, counts, "name = counted")


_TABLES = ["nation", "part", "supplier", "customer"]
_add("io.create_db", database, "name:s rows:l", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS rows FROM {n}" for n in _TABLES), params={"tables": _TABLES})


# --- statistics and descriptions ------------------------------------------------------------------


def analysed_columns(t, p):
    """What the catalog knows of every column of the analysed tables: NULLs, extremes, and whether it has a histogram."""
    store = stored.store_of(t)
    facts = [stored.column_facts(t.spark, store.analysed(n)).select(F.lit(n).alias("table"), "column", "nulls", "lowest", "highest", (F.col("bins") > 0).alias("histogram")) for n in p.tables]
    return functools.reduce(DataFrame.unionByName, facts)


def _facts_sql(names):
    numeric = ("int", "bigint", "decimal", "double", "date", "timestamp")
    parts = []
    for n in names:
        for c, kind in _KINDS[n]:
            shown = (f"min({c})::VARCHAR", f"max({c})::VARCHAR", "true") if kind.startswith(numeric) else ("NULL", "NULL", "false")
            parts.append(f"SELECT '{n}' AS \"table\", '{c}' AS \"column\", count(*) - count({c}) AS nulls, {shown[0]} AS lowest, {shown[1]} AS highest, {shown[2]} AS histogram FROM {n}")
    return " UNION ALL ".join(parts)


_KINDS = {"inventory": [(c, "int") for c in ("inv_date_sk", "inv_item_sk", "inv_warehouse_sk", "inv_quantity_on_hand")],
          "warehouse": [("w_warehouse_sk", "int"), ("w_warehouse_id", "string"), ("w_warehouse_name", "string"), ("w_warehouse_sq_ft", "int"), *[(f"w_{c}", "string") for c in (
              "street_number", "street_name", "street_type", "suite_number", "city", "county", "state", "zip", "country")], ("w_gmt_offset", "decimal")]}
_add("io.analyze_table", analysed_columns, "table:s column:s nulls:l lowest:s highest:s histogram:b", _facts_sql(_KINDS), suite="tpcds", params={"tables": list(_KINDS)})


def described(t, p):
    """Rows, columns and partitions of every table of the suite, some of them in a folder for each key, from footers and folder names."""
    store, paths = stored.store_of(t), {}
    for name in SUITES[t.suite]:
        by_key = name in p.by_key
        (store.partitioned if by_key else store.plain)(name)
        paths[name] = store.path(f"{name}_by_key" if by_key else f"{name}_plain"), S.PARTITIONS[t.suite][name] if by_key else []
    return stored.row_counts(t.spark, paths)


_BY_KEY = {n: S.PARTITIONS["tpch"][n][0] for n in ("part", "customer")}
_WIDTHS = {"region": 3, "nation": 4, "part": 9, "supplier": 7, "partsupp": 5, "customer": 8, "orders": 9, "lineitem": 16}
_add("io.describe", described, "name:s rows:l columns:i partition_columns:s partitions:l", " UNION ALL ".join(
    f"SELECT '{n}' AS name, count(*) AS rows, {w} AS columns, '{_BY_KEY.get(n, '')}' AS partition_columns, {f'count(DISTINCT {_BY_KEY[n]})' if n in _BY_KEY else 0} AS partitions FROM {n}" for n, w in _WIDTHS.items()),
     params={"by_key": list(_BY_KEY)})


def exact_files(t, p):
    """Orders in files of an exact number of rows: how many files have how many."""
    folder = stored.scratch(t.spark, "exact") + "/orders"
    stored.write_exact(t.orders, folder, p.rows)
    files = t.spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows_in_file"), total("o_orderkey", "keys"))
    return one_row(files.groupBy("rows_in_file").agg(F.count("*").alias("files")), files.agg(total("keys", "all_keys")))


_add("io.coalesce_by_rows", exact_files, "rows_in_file:l files:l all_keys:l", """
SELECT least({rows}, n - i * {rows}) AS rows_in_file, count(*) AS files, any_value(k) AS all_keys FROM (SELECT count(*) AS n, sum(o_orderkey) AS k FROM orders), range(100000) AS r(i) WHERE i * {rows} < n GROUP BY 1""",
     params={"rows": 1000})


_MISSING_TEXT = "SELECT c_custkey, c_name, lines, amount FROM busy_customers JOIN customer_names USING (c_custkey)"


def built_when_missing(t, p):
    """A statement over tables that are not there: they are built in the order in which they need one another."""
    session, name = stored.session_like(t.spark), f"tallyframe_{uuid.uuid4().hex[:12]}"
    S.create_database(session, name)
    session.catalog.setCurrentDatabase(name)
    folder = t.folder

    def given(table):
        return session.read.parquet(f"{folder}/{table}.parquet")

    builders = {
        "order_sums": lambda s: given("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"), total(F.col("l_extendedprice").cast("decimal(18,2)"), "amount")),
        "busy_customers": lambda s: on(given("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")), s.table("order_sums"), "o_orderkey = l_orderkey").groupBy("c_custkey").agg(
            total("lines", "lines"), total("amount", "amount")).where(f"lines > {p.lines}"),
        "customer_names": lambda s: given("customer").select("c_custkey", "c_name"),
    }
    stored.build_missing(session, _MISSING_TEXT, builders, stored.scratch(t.spark, "missing"))
    return session.sql(_MISSING_TEXT)


_add("io.materialize_missing", built_when_missing, "c_custkey:l c_name:s lines:l amount:d", """
SELECT c_custkey, c_name, count(*) AS lines, sum(l_extendedprice::DECIMAL(18,2)) AS amount FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY c_custkey, c_name HAVING count(*) > {lines}""", suite="given", params={"lines": 60})


# --- reports on written, analysed and bucketed tables ---------------------------------------------


def _on_written(query, *facts):
    """The same report on facts with a folder for each day: its days become partition filters or dynamic pruning."""
    def build(t, p):
        store = stored.store_of(t)
        view = store.on(**{f: store.partitioned(f) for f in facts})
        return query.build(view.pruned("store_sales", "ss_sold_date_sk", *query.pruned) if query.pruned else view, p)

    return build


for _key, _facts in (("tpcds.q3", ["store_sales"]), ("tpcds.q64", ["store_sales"]), ("tpcds.q72", ["inventory", "catalog_sales"]), ("impala.q7", ["store_sales"])):
    BOOK.put(_REPORTS[_key].variant(f"written.{_key}", build=_on_written(_REPORTS[_key], *_facts)))


def _by_cost(query, *names):
    """The same report planned by the statistics of analysed tables."""
    def build(t, p):
        store = stored.store_of(t)
        return query.build(store.on(stored.cost_session(t.spark), **store.all_analysed(names)), p)

    return build


Q72_TABLES = ["catalog_sales", "catalog_returns", "inventory", "warehouse", "item", "customer_demographics", "household_demographics", "date_dim", "promotion"]
BOOK.put(_REPORTS["tpcds.q72"].variant("analyzed.tpcds.q72", build=_by_cost(_REPORTS["tpcds.q72"], *Q72_TABLES)))


def _on_buckets(query, **keys):
    """The same report on tables bucketed and sorted by their join keys."""
    def build(t, p):
        store = stored.store_of(t)
        return query.build(store.on(**{n: store.bucketed(n, k, p.buckets) for n, k in keys.items()}), p)

    return build


_TICKET = {"store_sales": ["ss_item_sk", "ss_ticket_number"], "store_returns": ["sr_item_sk", "sr_ticket_number"]}
_ORDER = {"catalog_sales": ["cs_item_sk", "cs_order_number"], "catalog_returns": ["cr_item_sk", "cr_order_number"]}
for _key, _bucketed in (("simple.fact_fact", _TICKET), ("tpcds.q64", _TICKET | _ORDER), ("tpch.q18", {"lineitem": ["l_orderkey"], "orders": ["o_orderkey"]})):
    BOOK.put(_REPORTS[_key].variant(f"bucketed.{_key}", build=_on_buckets(_REPORTS[_key], **_bucketed), params={"buckets": 16}))


def bucketed_counts(t, p):
    """The nine joins of the id tables, each table bucketed by its id: no shuffle below the joins."""
    store = stored.store_of(t)
    frames = {size: store.spark.table(store.bucketed(f"ids_{size}", ["id"], p.buckets, micro.ids(t, size))) for size in micro.SIZES}
    return micro.joined_pair_counts(frames, p.how)


for _how in ("inner", "right", "left", "full"):
    BOOK.put(micro.BOOK[f"join.single_key.{_how}"].variant(f"bucketed.join.single_key.{_how}", build=bucketed_counts, params={"buckets": 16}))
