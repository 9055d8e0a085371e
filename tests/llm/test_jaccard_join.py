import random
import re

import numpy as np
import pytest

from tallyframe.llm import jaccard_join as J
from tallyframe.llm.components import components
from tallyframe.llm.queries import op8_jaccard_join


def plain_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent=80):
    """Components by comparing the sets of all pairs that share a shingle."""
    sets, root = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for shingle in s:
            where.setdefault(shingle, []).append(i)
    for i, j in {(i, j) for those in where.values() for j in those for i in those if i < j}:
        common = len(sets[i] & sets[j])
        if 100 * common >= percent * len(sets[i] | sets[j]):
            root[top(j)] = top(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), least[top(i)]) for i, (doc_id, _) in enumerate(rows))


def found(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def test_every_document(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    assert found(op8_jaccard_join(spark, data)) == brute(rows)


def near_copies(rng, n, size, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        yield " ".join(copy)


def test_near_groups_and_long_lists(spark, monkeypatch):
    rng = random.Random(3)
    texts = [t for n, size, edits in ((30, 60, 3), (40, 12, 1), (25, 200, 9), (20, 8, 1)) for t in near_copies(rng, n, size, edits)]
    shared = " ".join(f"p{i}" for i in range(40))
    texts += [f"{shared} {' '.join(f'u{rng.randrange(10**6)}' for _ in range(rng.randrange(1, 60)))}" for _ in range(60)]
    texts += ["a b c", "a b c", "A  b\tc", "a b", "", None, " \n", "é b c d e f", "É b c d e f", "x " * 3000] + texts[:5]
    rows = list(enumerate(texts, 100))
    rng.shuffle(rows)
    wanted = brute(rows)
    for short in (64, 5):
        monkeypatch.setattr(J, "SHORT_LIST", short)
        docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as n", "3 as token")
        assert found(J.jaccard_join(docs)) == wanted


def test_empty_table_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "one two"), (4, "one two"), (4, "one two"), (None, None)], "doc_id long, text string")
    assert J.jaccard_join(docs.limit(0)).count() == 0
    assert sorted(str(r["component_id"]) for r in J.jaccard_join(docs).collect()) == ["4", "4", "4", "None"]


@pytest.mark.parametrize("text", [b"One  two\nthree four five six one two three four five", b"x", b"a b c", b"  ", b"", ("é" * 40_000).encode() + b" y"])
def test_shingle_sets(text):
    assert len(J.shingles(text)) == len(plain_set(text.decode()))
    assert (J.shingles(text) == J.shingles(text.upper().lower())).all()


def test_words_that_a_polynomial_confuses_do_not_link(spark):
    """The Thue-Morse word and its swap have one hash by any polynomial modulo a power of two."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    docs = spark.createDataFrame([(1, word), (2, word.translate(str.maketrans("ab", "ba")))], "doc_id long, text string")
    assert sorted((r["doc_id"], r["component_id"]) for r in J.jaccard_join(docs).collect()) == [(1, 1), (2, 2)]


def test_parities_never_exceed_the_difference():
    rng = random.Random(8)
    for _ in range(200):
        a = {rng.getrandbits(64) for _ in range(rng.randrange(1, 400))}
        b = {x for x in a if rng.random() < 0.9} | {rng.getrandbits(64) for _ in range(rng.randrange(40))} or {1}
        off = sum((int(x) ^ int(y)).bit_count() for x, y in zip(*(J.parities(np.array(sorted(s), np.uint64)).view(np.uint64) for s in (a, b))))
        assert off <= len(a ^ b)


def test_a_passage_shared_by_unlike_texts(spark, monkeypatch):
    monkeypatch.setattr(J, "SHORT_LIST", 8)
    rng = random.Random(12)
    shared = " ".join(f"p{i}" for i in range(60))
    texts = [f"{shared} {' '.join(f'u{rng.randrange(10**6)}' for _ in range(rng.randrange(5, 25)))}" for _ in range(300)]
    rows = list(enumerate(texts))
    assert found(J.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_components(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (502, 500), (7, 7)] + [(1000, 1000 + i) for i in range(1, 60)]
    labels = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert labels == {**{i: 0 for i in range(201)}, **{i: 500 for i in (500, 501, 502)}, **{1000 + i: 1000 for i in range(60)}}
