import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyframe.llm import packing
from tallyframe.llm.queries import PATTERN, RANKS, VOCABULARY, op2_harmonic_packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts, tokenizer, capacity):
    """Exact round trip: pieces of a document join without gap, sequences have neither gap nor padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert sorted(by_doc) == sorted(texts)
    for doc_id, pieces in by_doc.items():
        ids = np.array(tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity and {p["length"] for p in pieces} <= set(packing.classes(capacity))


def test_all_documents_round_trip(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op2_harmonic_packing(spark, folder).collect()
    check(rows, texts, tokenizer, 1024)
    tokens, sequences = sum(r["length"] for r in rows), len({r["sequence_id"] for r in rows})
    workers = len({r["sequence_id"] // packing.SEQUENCES_PER_WORKER for r in rows})
    assert 1 - tokens / (1024 * (sequences - workers)) < 0.03
    assert len(rows) / len(texts) < 2 + tokens / len(texts) / 1024 + 3


def test_odd_texts(spark, tokenizer):
    texts = {1: None, 2: "", 3: "a  b\n\n c \x1c x\x85", 4: "<|endoftext|> hi", 5: "don't 日本語 123", 6: "word " * 5000, 7: "x" * 3000, 8: "same", 9: "same", 10: " " * 1_000_000, 11: "a <|endoftext|><|endoftext|>", 12: "\u00a0" * 60_000 + "b"}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "1 as start", "2 as sequence_id").repartition(3)
    check(packing.harmonic_pack(rows, VOCABULARY, RANKS, PATTERN, capacity=64).collect(), texts, tokenizer, 64)


def test_empty_table_null_and_repeated_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.harmonic_pack(empty, VOCABULARY, RANKS, PATTERN).count() == 0
    rows = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string").coalesce(1)
    found = packing.harmonic_pack(rows, VOCABULARY, RANKS, PATTERN).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "1", "None"]
    assert sum(r["length"] for r in found) == 6
    with pytest.raises(ValueError):
        packing.harmonic_pack(rows, VOCABULARY, RANKS, PATTERN, capacity=0)


def test_cut():
    for capacity in (32, 100, 1024):
        lengths = packing.classes(capacity)
        for tokens in range(1, 3000):
            pieces = packing.cut(tokens, lengths)
            assert sum(pieces) == tokens and set(pieces) <= set(lengths) and pieces == sorted(pieces, reverse=True)
        assert sum(len(packing.cut(n, lengths)) for n in range(capacity)) / capacity < 4
    assert packing.classes(10) == [10, 5, 3, 2, 1]
