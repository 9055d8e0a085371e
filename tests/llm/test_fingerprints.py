import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import fingerprints as P
from tallyframe.llm.queries import op3_iblt_fingerprints


def cells(text):
    return {c for c in re.findall(r"(?:\S+[^\S\n]*){1,24}", text, re.A)}


def jaccard(a, b):
    a, b = cells(a), cells(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, found):
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    wanted = []
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edit = text[:len(text) - half] + after[:half]
        wanted.append((str(i), len(text), hashlib.sha256(edit.encode()).hexdigest(), round(jaccard(text, edit), 9), round(jaccard(text, after), 9)))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in found) == sorted(wanted)


def test_every_document(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    found = op3_iblt_fingerprints(spark, data).collect()
    check(rows, found)
    texts, prints = dict(rows), {}
    for r in found:
        assert prints.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    near = [r for r in found if r["n_chars"] > 400]
    assert sum(r["near_edited"] > r["near_next"] for r in near) >= 0.95 * len(near)


ROWS = [(5, "é𝒳 one two\nthree"), (1, None), (2, ""), (9, "same text"), (7, "same text"), (7, "same text"), (7, "other"), (None, "no id"), (20, "".join(f"w{i} " for i in range(30_000)))]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 as band", "2 as guest", "'x' as next_text")
    check(ROWS, P.fingerprints(docs).collect())
    check(ROWS[:1], P.fingerprints(docs.where("doc_id = 5")).collect())
    assert P.fingerprints(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bands", [1, 2, 7, 300])
def test_next_rows(spark, bands):
    docs = spark.range(200).selectExpr("id * id as doc_id", "cast(id as string) as text").repartition(5)
    found = {int(r["text"]): int(r["next_text"]) for r in P.with_next(docs, bands).collect()}
    assert found == {i: (i + 1) % 200 for i in range(200)}


def test_peeling_recovers_differences_and_retries(spark):
    rows = [(list(range(0, n)), list(range(k, n + k))) for n in (0, 1, 5, 40, 900) for k in (0, 1, 2, 30, 2000)]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    first = df.select("a", "b", P.peeled(P.subtracted(P.sketch(F.col("a"), 4), P.sketch(F.col("b"), 4)), 4).alias("small"), P.differing(F.col("a"), F.col("b")).alias("all")).collect()
    for r in first:
        wanted = sorted([(1, x) for x in set(r["a"]) - set(r["b"])] + [(-1, x) for x in set(r["b"]) - set(r["a"])])
        assert sorted(map(tuple, r["all"])) == wanted
        assert r["small"] is None or sorted(map(tuple, r["small"])) == wanted
    assert any(r["small"] is None for r in first) and any(r["small"] for r in first)
