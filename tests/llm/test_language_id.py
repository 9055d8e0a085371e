import zlib
from collections import Counter

import numpy as np

from tallyframe.llm import language_id as L
from tallyframe.llm.queries import op5_language_id


def plain_ngrams(text):
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        w = f" {word} "
        out.update([*word, *[w[i:i + 2] for i in range(len(w) - 1)], *[w[i:i + 3] for i in range(len(w) - 2)]])
    return out


def number(gram):
    n = 0
    for c in gram:
        n = n << L.SHIFT | ord(c)
    return n


def test_ngrams_match_plain_count():
    for text in ("Ab, abc! É 1x", "", "...", " a ", "日本 é𝒳", "İ ß x" * 50):
        grams, counts = L.ngrams(text)
        assert dict(zip(grams.tolist(), counts.tolist())) == {number(g): n for g, n in plain_ngrams(text).items()}


def test_held_out_accuracy(spark, data):
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    found = op5_language_id(spark, data).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    judged = [r for r in found if r["held_out"] and rows[r["doc_id"]]["lang"]]
    assert sum(r["lang_pred"] == rows[r["doc_id"]]["lang"] for r in judged) >= 0.97 * len(judged)


def test_matches_brute_force(spark):
    texts = [(1, "the cat and the hat", "en"), (2, "der hund und die katze", "de"), (3, "the end", "en"), (4, None, "en"), (5, "123", "de"), (6, "x", None), (6, "die die the", None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").selectExpr("*", "1 as gram", "2 as n")
    known = L.profiles(docs, size=10)
    assert set(known) == {"en", "de"}
    sums = {lang: sum((plain_ngrams(t) for _, t, x in texts if x == lang and t), Counter()) for lang in known}
    for lang in known:
        assert known[lang] == [number(g) for g, _ in sorted(sums[lang].items(), key=lambda g: (-g[1], number(g[0])))][:10]
    for r in L.identify(docs, known, size=10).collect():
        options = [t for i, t, _ in texts if i == r["doc_id"]]
        wanted = set()
        for text in options:
            own = [number(g) for g, _ in sorted(plain_ngrams(text or "").items(), key=lambda g: (-g[1], number(g[0])))][:10]
            far = {lang: sum(abs(known[lang].index(g) - i) if g in known[lang] else 10 for i, g in enumerate(own)) for lang in known}
            wanted.add(min(sorted(far), key=far.get) if own else "und")
        assert r["lang_pred"] in wanted


def test_empty_and_unlabelled(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.profiles(empty) == {} and L.identify(empty, {}).count() == 0
    one = spark.createDataFrame([(1, "word")], "doc_id long, text string")
    assert [tuple(r) for r in L.identify(one, {}).collect()] == [(1, "und", 0.0)]
    long = spark.createDataFrame([(None, "the end " * 200_000)], "doc_id long, text string")
    assert L.identify(long, {"en": [number(g) for g in plain_ngrams("the end")]}).first()["lang_pred"] == "en"
    assert np.all(L.letters()[[ord("é"), ord("a")]])
