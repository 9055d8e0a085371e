import corpus_pipeline as C
from tallyframe.llm import language_id, mixing
from tests.llm.test_jaccard_join import brute
from tests.llm.test_packing import check, tokenizer  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame([(9001, "12345 678", "en"), (9002, None, "en"), (9003, "", None)], "doc_id long, text string, lang string").selectExpr("*", "'src0' as source", "0L as n_chars")
    docs = docs.unionByName(extra)
    kept = [docs] + [None] * 4
    for i, (name, stage) in enumerate(C.STAGES[:4], 1):
        kept[i] = C.written(stage(spark, kept[i - 1], FOLDER), name)
        assert kept[i].columns == docs.columns
    rows = [[(r["doc_id"], r["text"]) for r in k.collect()] for k in kept]

    known = language_id.profiles(docs.where(~language_id.held_out("doc_id")))
    judged = {r["doc_id"]: r for r in language_id.identify(docs, known).collect()}
    assert sorted(rows[1]) == sorted((i, t) for i, t in rows[0] if judged[i]["lang_pred"] != "und" and judged[i]["score"] >= 0.2)
    assert {i for i, _ in rows[0]} - {i for i, _ in rows[1]} >= {9001, 9002, 9003}
    assert len(rows[1]) == len(rows[0]) - 3

    last = {}
    for i, t in rows[1]:
        last[t] = max(last.get(t, i), i)
    assert sorted(rows[2]) == sorted((i, t) for t, i in last.items())

    assert sorted(i for i, _ in rows[3]) == sorted({c for _, _, c in brute(rows[2])})

    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(kept[3]).collect()}
    assert sorted(i for i, _ in rows[4]) == sorted(i for i, n in taken.items() for _ in range(n))

    packed = C.STAGES[4][1](spark, kept[4], FOLDER).collect()
    assert sum(r["length"] for r in packed) == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows[4])
    once = kept[4].dropDuplicates(["doc_id"])
    check(C.STAGES[4][1](spark, once, FOLDER).collect(), {r["doc_id"]: r["text"] for r in once.collect()}, tokenizer, 1024)


def test_run_and_registration(spark):
    import __spark_entry__
    assert [n for n, _ in C.STAGES] == ["language", "exact_copies", "near_copies", "mix_sources", "pack"] and C.ORACLE_SQL is None
    found = __spark_entry__.queries()["pipeline"](spark, FOLDER)
    assert found.count() > 0 and "sequence_id" in found.columns


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in C.STAGES:
        docs = C.written(stage(spark, docs, FOLDER), name)
        assert docs.count() == 0


def test_columns_of_any_name_survive(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    named = docs.selectExpr("*", "doc_id + 1 as row_key", "doc_id + 2 as Row_Key_", "doc_id + 3 as copy_number", "doc_id + 4 as copy_count", "doc_id + 5 as _row", "doc_id + 6 as file")
    for name, stage in C.STAGES[1:4]:
        kept = stage(spark, named, FOLDER)
        assert kept.columns == named.columns
        assert kept.where("row_key <> doc_id + 1 or Row_Key_ <> doc_id + 2 or copy_number <> doc_id + 3 or copy_count <> doc_id + 4 or _row <> doc_id + 5").isEmpty(), name
