import hashlib

from tallyframe.llm.exact_dedup import deduplicated, exact_dedup
from tallyframe.llm.queries import op6_exact_dedup, oracle_sql

ROWS = [(1, "a"), (2, "b"), (3, "a"), (3, "a"), (4, None), (5, ""), (None, "a"), (7, "long " * 50_000), (8, "long " * 50_000), (9, "A")]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as digest", "1 as run", "2L as n")


def test_matches_sql(spark, oracle, data):
    found = op6_exact_dedup(spark, data).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, found)) == sorted(oracle.execute(oracle_sql()["op6_exact_dedup"]).fetchall())


def test_brute_force(spark):
    for runs, fan, keep, pick in ((16, 4, "largest", max), (5, 2, "largest", max), (1, 2, "largest", max), (16, 4, "smallest", min)):
        found = exact_dedup(docs(spark), runs=runs, fan=fan, keep=keep).collect()
        groups = {}
        for i, t in ROWS:
            groups.setdefault(t or "", []).append(-1 if i is None else i)
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], -1 if r["keep_id"] is None else r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == sorted(
            (i, pick(ids), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)
        assert sum(r["kept"] for r in found) == len(groups)


def test_kept_rows(spark):
    found = deduplicated(docs(spark))
    assert found.columns == docs(spark).columns
    assert sorted(r["doc_id"] for r in found.collect()) == [2, 3, 5, 8, 9]


def test_empty_table(spark):
    assert exact_dedup(docs(spark, [])).count() == 0
    assert deduplicated(docs(spark, [])).count() == 0


def test_hot_group(spark):
    rows = spark.range(30_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', cast(id as string)) as text")
    found = exact_dedup(rows).where("text_sha256 = sha2('hot', 256)").groupBy("keep_id", "group_size").count().collect()
    assert [tuple(r) for r in found] == [(29_997, 10_000, 10_000)]
