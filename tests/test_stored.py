import re


import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.operators import ordering as O
from tallyframe.plans import stored as P
from tallyframe.plans.library import query
from tallyframe.plans.tpcds.part1 import kinds_by_channel
from tallyframe.plans.tpcds.part2 import q24
from tallyframe.sources import layout as S
from tallyframe.sources import stored
from tallyframe.sources.catalog import Catalog


def plan(df):
    return df._jdf.queryExecution().toString()


def ran(df):
    """The plan as it ran, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def retail(spark, data):
    return Catalog(spark, data, "tpcds")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def answers(q, catalog):
    return q.build(catalog, q.values(**q.tried))


def test_written_facts_are_pruned(spark, data, retail):
    fixed = plan(query("written.impala.q7").run(spark, data))
    assert re.search(r"PartitionFilters: \[isnotnull\(ss_sold_date_sk#\d+\), \(ss_sold_date_sk#\d+ >= 2450815\), \(ss_sold_date_sk#\d+ <=", fixed)
    for key, day in (("written.tpcds.q3", "ss_sold_date_sk"), ("written.tpcds.q64", "ss_sold_date_sk"), ("written.tpcds.q72", "inv_date_sk")):
        text = plan(query(key).run(spark, data))
        assert re.search(rf"PartitionFilters: \[[^\]]*{day}[^\]]*dynamicpruning", text), key
    pruned = ran(query("written.tpcds.q3").run(spark, data))
    assert "dynamicpruning" in pruned


def test_bucketed_joins_do_not_shuffle(spark, data, no_broadcast):
    joined = ran(answers(query("bucketed.simple.fact_fact"), Catalog(spark, data, "tpcds")))
    assert "SortMergeJoin" in joined and "Exchange hashpartitioning" not in joined and "Bucketed: true" in joined
    counts = ran(answers(query("bucketed.join.single_key.full"), Catalog(spark, data, "given")))
    assert counts.count("SortMergeJoin") == 3 and "Exchange hashpartitioning" not in counts
    groups = ran(answers(query("bucketed.tpch.q18"), Catalog(spark, data, "tpch")))
    assert "Exchange hashpartitioning(l_orderkey" not in groups and "Exchange hashpartitioning(o_orderkey" not in groups
    plain = ran(answers(query("simple.fact_fact"), Catalog(spark, data, "tpcds")))
    assert plain.count("Exchange hashpartitioning") == 2


def test_statistics_change_the_join_order(spark, data, retail):
    store = stored.store_of(retail)
    names, q = store.all_analysed(P.Q72_TABLES), query("tpcds.q72")

    def order(view):
        text = answers(q, view)._jdf.queryExecution().optimizedPlan().toString()
        return re.findall(r"Relation \S+\.(\w+)_plain\[", text)

    by_cost, plain = order(store.on(stored.cost_session(spark), **names)), order(store.on(**names))
    assert sorted(by_cost) == sorted(plain) and by_cost != plain
    facts = {r.column: r for r in stored.column_facts(spark, names["inventory"]).collect()}
    assert facts["inv_quantity_on_hand"].bins > 0 and facts["inv_date_sk"].nulls == 0 and facts["inv_date_sk"].distinct > 100


def test_an_unfinished_table_is_rebuilt_and_a_finished_one_is_not(spark, tmp_path):
    session = stored.session_like(spark)
    session.sql("CREATE DATABASE build_test")
    session.catalog.setCurrentDatabase("build_test")
    calls = []

    def base(s):
        calls.append("base")
        return s.range(10).select("id", (F.col("id") % 3).alias("k"))

    def sums(s):
        calls.append("sums")
        return s.table("base").groupBy("k").agg(F.sum("id").alias("total"))

    builders = {"base": base, "sums": sums, "round_a": lambda s: s.table("round_b"), "round_b": lambda s: s.table("round_a")}
    # What a broken-off job leaves: rows, and no commit.
    session.range(1000).select("id", F.lit(0).alias("k")).write.parquet(str(tmp_path / "base"))
    (tmp_path / "base" / "_SUCCESS").unlink()
    text = "SELECT k, total FROM sums"
    assert stored.build_missing(session, text, builders, str(tmp_path)) == ["base", "sums"]
    assert sorted(map(tuple, session.sql(text).collect())) == [(0, 18), (1, 12), (2, 15)]
    made = list(calls)
    assert stored.build_missing(session, text, builders, str(tmp_path)) == []
    session.sql("DROP TABLE sums")
    assert stored.build_missing(session, text, builders, str(tmp_path)) == [] and calls == made
    with pytest.raises(ValueError, match="needs itself"):
        stored.build_missing(session, "SELECT * FROM round_a", builders, str(tmp_path))
    with pytest.raises(ValueError, match="no builder"):
        stored.build_missing(session, "SELECT * FROM nowhere", builders, str(tmp_path))


@pytest.mark.parametrize(("rows", "most"), [(1000, 300), (900, 300), (5, 300), (0, 10), (4001, 7)])
def test_files_of_an_exact_number_of_rows(spark, tmp_path, rows, most):
    uneven = spark.range(0, rows, 1, 5).where("id >= 0").select("id", F.lit("x").alias("file_number")).repartition(3, (F.col("id") % 2))
    stored.write_exact(uneven, str(tmp_path / "t"), most)
    back = spark.read.parquet(str(tmp_path / "t"))
    sizes = sorted(r["count"] for r in back.groupBy(F.col("_metadata.file_path")).count().collect())
    assert sizes == sorted([most] * (rows // most) + [rows % most] * (rows % most > 0))
    assert back.columns == ["id", "file_number"] and {r.id for r in back.collect()} == set(range(rows))


def test_counts_come_from_footers(spark, tmp_path):
    spark.range(1000).select("id", (F.col("id") % 7).cast("int").alias("k")).write.partitionBy("k").parquet(str(tmp_path / "t"))
    spark.range(5).write.parquet(str(tmp_path / "u"))
    found = stored.row_counts(spark, {"t": (str(tmp_path / "t"), ["k"]), "u": (str(tmp_path / "u"), [])})
    assert "PushedAggregation: [COUNT(*)]" in found._jdf.queryExecution().explainString(found.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert sorted(map(tuple, found.collect())) == [("t", 1000, 2, "k", 7), ("u", 5, 1, "", 0)]


def test_written_suite_must_be_complete(spark, data, tmp_path, retail):
    from tallyframe.sources import layout as S
    S.write_suite(retail, str(tmp_path), only="warehouse")
    assert stored.written_suite(spark, str(tmp_path), data, "tpcds", ["warehouse"]).warehouse.count() == 5
    (tmp_path / "tpcds" / "warehouse" / "_SUCCESS").unlink()
    with pytest.raises(ValueError):
        stored.written_suite(spark, str(tmp_path), data, "tpcds", ["warehouse"])


# --- prefix sums ----------------------------------------------------------------------------------


def hot(spark, rows=20_000):
    """One key holds nine tenths of the rows, NULL is a key, some values are frequent."""
    key = F.when(F.col("id") % 10 < 9, F.lit("hot")).when(F.col("id") % 20 == 9, F.lit("cold"))
    value = F.when(F.col("id") % 3 == 0, 0.5).when(F.col("id") % 50 != 1, F.pmod(F.xxhash64("id"), F.lit(997)) / 997)
    return spark.range(rows).select("id", key.alias("g"), value.alias("v"))


@pytest.mark.parametrize("descending", [False, True])
def test_ranked_is_rank(spark, descending):
    df = hot(spark)
    order = F.desc_nulls_last("v") if descending else F.asc_nulls_first("v")
    wanted = df.withColumn("place", F.rank().over(W.partitionBy("g").orderBy(order)))
    found = O.ranked(df, ["g"], "v", "place", descending)
    assert found.columns == wanted.columns and found.exceptAll(wanted).isEmpty() and found.count() == df.count()


def test_cumulated_is_a_running_window(spark):
    df = hot(spark).withColumn("n", F.col("v").cast("decimal(20,15)"))
    frame = W.partitionBy("g").orderBy("id")
    wanted = df.withColumn("s", F.sum("n").over(frame)).withColumn("m", F.max("v").over(frame))
    assert O.cumulated(df, ["g"], [F.asc("id")], {"s": "n"}, {"m": "v"}).exceptAll(wanted).isEmpty()
    before = W.partitionBy("g").orderBy("id").rowsBetween(W.unboundedPreceding, -1)
    found = O.cumulated(df, ["g"], [F.asc("id")], {"s": "n"}, with_own=False)
    assert found.exceptAll(df.withColumn("s", F.sum("n").over(before))).isEmpty()
    assert O.cumulated(df.limit(0), ["g"], [F.asc("id")], {"s": "n"}).count() == 0


def test_no_band_holds_more_than_its_share(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [r["count"] for r in O.banded(hot(spark), ["g"], [F.asc("id")]).groupBy(O.BAND).count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4 and max(sizes) < 2.5 * sum(sizes) / len(sizes)


# --- plans ----------------------------------------------------------------------------------------


def test_every_sales_fact_is_read_once(spark, data, retail):
    q = query("tpcds.q14a")
    text = kinds_by_channel(retail, q.values(**q.tried), month=F.expr("d_moy = 11"))._jdf.queryExecution().executedPlan().toString()
    assert text.count("/lineitem.parquet") == 3
    spent = ran(query("tpcds.q23a").run(spark, data))
    assert "ReusedExchange" in spent or "ReusedSubquery" in spent


def test_twins_and_crowded_zips_multiply_sums_not_rows(spark, data, retail):
    """All addresses in one zip, every return twice: the answer of the plain joins, with no row for each address or return."""
    q = query("tpcds.q24a")
    zip_of = retail.store.where("s_market_id = 8").first()["s_zip"]
    homes = retail.customer_address.withColumn("ca_zip", F.lit(zip_of))
    view = retail.replaced(customer_address=homes, store_returns=retail.store_returns.unionAll(retail.store_returns))
    found = {tuple(r)[:3]: r["paid"] for r in q24(view, q.values(**q.tried)).collect()}
    lines = view.store_sales.join(view.store_returns, F.expr("ss_ticket_number = sr_ticket_number and ss_item_sk = sr_item_sk")).join(view.customer, F.expr("ss_customer_sk = c_customer_sk"))
    lines = lines.join(view.item, F.expr("ss_item_sk = i_item_sk")).join(view.store.where("s_market_id = 8"), F.expr("ss_store_sk = s_store_sk"))
    wide = lines.join(view.customer_address, F.expr("c_birth_country = upper(ca_country) and s_zip = ca_zip"))
    names = ["c_last_name", "c_first_name", "s_store_name"]
    groups = wide.groupBy(*names, "ca_state", "s_state", "i_color", "i_current_price", "i_manager_id", "i_units", "i_size").agg(F.sum("ss_net_paid").alias("netpaid"))
    usual = groups.agg(F.avg(F.col("netpaid").cast("double"))).first()[0]
    wanted = {tuple(r)[:3]: r["paid"] for r in groups.where(F.col("i_color") == q.values(**q.tried).color).groupBy(*names).agg(F.sum("netpaid").alias("paid")).collect() if float(r["paid"]) > 0.05 * usual}
    assert found and found == wanted


def test_metadata_is_read_back(spark):
    from tallyframe.operators import generators as S
    df = S.with_label_metadata(S.mixed(spark.range(50), [3, 0, 2]).withColumn("label", F.when(F.col("id") == 0, 9.0).otherwise(1.0)), 4)
    assert [tuple(r) for r in S.attribute_report(df, ["features", "label"]).orderBy("column", "position").collect()] == [
        ("features", 0, "nominal", 3, 50, 0), ("features", 1, "numeric", 0, 50, 0), ("features", 2, "nominal", 2, 50, 0), ("label", 0, "nominal", 4, 50, 1)]


def test_group_function_with_keys_of_several_types(spark):
    from tallyframe.functions import apply as A
    big = 2**53
    df = spark.range(400).select((F.lit(big) + F.col("id") % 2).alias("k"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("x"), F.col("id") % 2)).alias("s"), F.lit(1).alias("v"))
    partial = lambda rows: rows.groupby(["k", "s"], as_index=False, dropna=False).agg(n=("v", "sum"))
    merged = lambda rows, last: rows.groupby(["k", "s"], as_index=False, dropna=False).agg(n=("n", "sum"))
    found = A.group_apply_merged(df, ["k", "s"], partial, "k long, s string, n long", merged, "k long, s string, n long").collect()
    assert sorted((r.k, r.s or "", r.n) for r in found) == sorted((r.k, r.s or "", r["count"]) for r in df.groupBy("k", "s").count().collect())



def test_stock_counts_are_made_by_all_tasks(spark, data, retail):
    assert retail.inventory.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_appended_rows_are_brought_together(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 8).selectExpr("id", "id % 5 AS day")
    S.write_table(rows.where("day < 3"), str(tmp_path / "t"), partition_by=["day"])
    S.append_table(rows.where("day >= 3"), str(tmp_path / "t"), ["day"])
    files = {f.name: len(list(f.glob("*.parquet"))) for f in (tmp_path / "t").glob("day=*")}
    assert files == {f"day={d}": 1 for d in range(5)}
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("day").count().where("count = 800").count() == 5


def test_sales_are_clustered_before_their_columns_are_made(retail):
    for name in ("store_sales", "catalog_sales", "web_sales"):
        narrow, whole = retail.clustered(name), retail.table(name)
        assert re.search(r"RebalancePartitions \[sold_day#", plan(narrow)) and narrow.columns == whole.columns
        assert narrow.exceptAll(whole).isEmpty() and whole.exceptAll(narrow).isEmpty()
    assert retail.clustered("inventory") is None and retail.replaced(store_sales=retail.store_sales).clustered("store_sales") is None
