import re

import pytest

from tallyframe.llm import mixing as M
from tallyframe.llm.queries import op4_entropy_mixing


def plain_targets(by_source, weights=(3, 1, 2), share=1.5, most=2.0):
    """Shares by weight; what is above a cap is shared anew among the others, until nothing is above."""
    names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(by_source.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left, w = total - sum(capped.values()), sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / w > most * by_source[s]]
        if not above:
            return {s: capped[s] if s in capped else left * weight[s] / w for s in names}
        capped |= {s: most * by_source[s] for s in above}


def check(rows, found, near):
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    by_source = {}
    for i, _, s in rows:
        by_source[s] = by_source.get(s, 0) + sizes[i]
    wanted, taken, source = plain_targets(by_source), {}, {i: s for i, _, s in rows}
    assert sorted(r["doc_id"] for r in found) == sorted(sizes)
    for r in found:
        s = source[r["doc_id"]]
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == by_source[s] and r["target"] == pytest.approx(wanted[s], rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in wanted:
        largest = max(sizes[i] for i in sizes if source[i] == s)
        assert abs(taken[s] - wanted[s]) <= max(near * wanted[s], largest / 2 + 1), s
    return taken, wanted


def test_every_document(spark, data):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    found = op4_entropy_mixing(spark, data).collect()
    taken, wanted = check(rows, found, 0.02)
    assert abs(sum(taken.values()) - sum(wanted.values())) <= 0.02 * sum(wanted.values())
    assert sorted(map(tuple, found)) == sorted(map(tuple, op4_entropy_mixing(spark, data).collect()))


def test_the_partitioning_changes_nothing(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    answers = [sorted(map(tuple, M.mix(df).select("doc_id", "size", "target", "copies").collect())) for df in (docs.coalesce(1), docs.repartition(7), docs.repartition(3, "text"))]
    assert answers[0] == answers[1] == answers[2]


def test_odd_tables(spark):
    rows = [(i, "w " * (i % 17), ["b", "a", None, "é", "Z", "empty"][i % 6]) for i in range(600)] + [(1000, None, "a"), (1001, "", "only empty"), (1002, "x " * 100_000, "long"), (1003, None, None)]
    rows = [(i, None if s == "empty" else t, s) for i, t, s in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as key", "2 as size", "3 as target")
    check(rows, M.mix(docs).collect(), 0.02)
    assert M.mix(docs.limit(0)).count() == 0
    twice = M.mix(docs.union(docs)).groupBy("source_size").count().collect()
    assert sum(r["count"] for r in twice) == 2 * len(rows)


def test_hot_source(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "repeat('w ', cast(if(id % 2 = 0, 5, id % 50) as int)) as text", "if(id % 3 > 0, 'hot', concat('s', id % 7)) as source")
    rows = [tuple(r) for r in docs.collect()]
    check(rows, M.mix(docs).collect(), 0.001)
