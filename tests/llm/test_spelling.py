import random
import re
import zlib
from collections import Counter

import pytest

from tallyframe.llm import spelling as S
from tallyframe.llm.queries import op12_spelling_variants


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def holes(word):
    return {(word[:i], word[i + 1:]) for i in range(len(word))}


def brute(counts):
    """Near words by writing out all words with a letter less and all with a hole."""
    by_hole, by_less = {}, {}
    for w in counts:
        for h in holes(w):
            by_hole.setdefault(h, set()).add(w)
            by_less.setdefault("".join(h), set()).add(w)
    rows = {}
    for w, n in counts.items():
        near = set().union(*(by_hole[h] for h in holes(w)), by_less.get(w, set()), {x for h in holes(w) if (x := "".join(h)) in counts}) - {w}
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        good = best is not None and counts[best] >= 10 * n
        rows[w] = (w, best if good else None, n, len(near), counts[best] if good else None)

    def root(w):
        while rows[w][1]:
            w = rows[w][1]
        return w

    return sorted(((w, f, root(w), n, near, fn) for w, f, n, near, fn in rows.values()), key=str)


def found(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_every_document(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    wanted = brute(plain_words(rows))
    assert found(op12_spelling_variants(spark, data)) == wanted
    assert sum(r[1] is not None for r in wanted) > 10


def near_words(rng, n):
    """Words over few letters, so that many are near, with chains of counts."""
    out = {}
    for _ in range(n):
        word = "".join(rng.choice("abé") for _ in range(rng.randrange(7, 10)))
        for _ in range(4):
            at = rng.randrange(len(word))
            word = rng.choice((word[:at] + rng.choice("abcé") + word[at:], word[:at] + rng.choice("abcé") + word[at + 1:], word[:at] + word[at + 1:]))
            if len(word) >= 7:
                out[word] = rng.choice((2, 3, 20, 25, 300, 300, 4000))
    return out


@pytest.mark.parametrize("most", [4096, 50, 3])
def test_near_words_in_blocks_of_any_size(spark, monkeypatch, most):
    monkeypatch.setattr(S, "MOST", most)
    rng = random.Random(11)
    counts = near_words(rng, 400) | {"x" * n: 10 ** (n % 5) + 1 for n in range(7, 40)} | {"y" * 5000 + "z": 2, "y" * 5000: 30}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(7)
    assert found(S.variants(words)) == brute(counts)


def test_nulls_repeated_rows_and_other_columns(spark):
    rows = [(1, "Spelling spelling speling SPELLING"), (1, "Spelling spelling speling SPELLING"), (None, "spelling ÉCLAIRS éclairs éclairs"), (None, None), (3, ""), (4, "çà×÷ÿÀ " * 500), (5, "q" * 100_000 + " " + "q" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as half")
    assert found(S.spelling_variants(docs)) == brute(plain_words(rows))
    assert S.spelling_variants(docs.limit(0)).count() == 0


def test_index_against_edit_distance():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice((5, 6)))) for _ in range(60)})
    index = S.Index(words, 5)

    def one_off(a, b):
        return any(a[:i] + a[i + 1:] == b for i in range(len(a))) or any(b[:i] + b[i + 1:] == a for i in range(len(b))) or len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1

    for a in words:
        bits = index.near(a)
        assert {w for i, w in enumerate(words) if bits >> i & 1} == {b for b in words if (len(a), len(b)) != (6, 6) and one_off(a, b)}
