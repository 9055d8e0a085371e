import re

import pytest

from tallyframe.llm import license_scan as L
from tallyframe.llm.queries import op1_license_scan


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def base(text):
    """All places of the phrases, word by word."""
    w = words(text)
    return sorted((i, label) for phrase, label in L.PHRASES.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split())


def test_every_document(spark, data):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    found = op1_license_scan(spark, data).collect()
    assert len(found) == len(texts)
    for r in found:
        spots = base(texts[r["doc_id"]])
        assert r["n_words"] == len(words(texts[r["doc_id"]]))
        assert (r["n_base"], r["first_word"], r["last_word"]) == (len(spots), spots[0][0] if spots else None, spots[-1][0] if spots else None)
        assert r["base_labels"] == ",".join(sorted({s[1] for s in spots}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


TEXTS = ["Under the MIT License under the mit license", "x Apache License, Version 2.0", "CC-BY-NC", "ÄPFEL under the mit licenseé", None, "", "under the\nmit\x00license " * 20_000]


def test_odd_texts(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0])], "doc_id long, text string").selectExpr("*", "1 as base", "2 as score")
    for r in L.summary(L.license_scan(rows)).collect():
        spots = base(TEXTS[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (len(words(TEXTS[r["doc_id"]])), len(spots))
        assert (r["first_word"], r["last_word"]) == (spots[0][0] if spots else None, spots[-1][0] if spots else None)
    assert L.summary(L.license_scan(rows.limit(0))).count() == 0


def brute(template, w):
    """Spans of a template by backtracking over its parts."""
    parts = re.split(r"<<(.*?)>>", template)
    items = []
    for i, part in enumerate(parts):
        items += words(part) if i % 2 == 0 else ["<" + part]

    def ends(k, at):
        if k == len(items):
            return {at}
        item = items[k]
        if not item.startswith("<"):
            return ends(k + 1, at + 1) if w[at:at + 1] == [item] else set()
        if item == "<endOptional":
            return ends(k + 1, at)
        if item == "<beginOptional":
            close = next(j for j in range(k, len(items)) if items[j] == "<endOptional")
            return ends(k + 1, at) | ends(close + 1, at)
        most = int(re.search(r'words="(\d+)"', item)[1])
        match = re.search(r'match="([^"]*)"', item)
        out = set()
        for n in range(most + 1):
            if at + n > len(w) or n and match and not re.fullmatch(match[1], w[at + n - 1]):
                break
            out |= ends(k + 1, at + n)
        return out

    spans, at = [], 0
    while at < len(w):
        found = ends(0, at)
        if found:
            spans.append((at, max(found)))
            at = max(found)
        else:
            at += 1
    return spans


@pytest.mark.parametrize("template, text", [
    ('<<beginOptional>>a b <<endOptional>>c <<var;name="x";words="3">> d', "a b c d c x y d c 1 2 3 4 d b c d a b c z d"),
    ('<<var;name="x";match="[0-9]";words="2">> go <<beginOptional>>on<<endOptional>>', "1 2 3 go on go go on 4 go"),
    ("one two one", "one two one two one two one one two one"),
    ('go <<var;name="x";words="2">>', "go go go go a b c go"),
])
def test_automaton_matches_backtracking(template, text):
    w = [x.encode() for x in text.split()]
    assert L.Automaton("x", template).matches(w, b" " + b" ".join(w) + b" ")[0] == brute(template, text.split())


def test_method_adds_labels(spark):
    texts = {1: "Released under the terms of the MIT License.", 2: "licensed under the GNU General Public License, version 3", 3: "Permission is hereby granted, free of charge, but not to all",
             4: "Neither the name of The Good People, Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."}
    found = {r["doc_id"]: r for r in L.summary(L.license_scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))).collect()}
    assert [found[i]["labels"] for i in (1, 2, 3, 4)] == ["mit", "gpl-3", "", "bsd-3-clause"]
    assert found[1]["base_labels"] == "" and 0 < found[3]["score"] < 1
    with pytest.raises(ValueError):
        L.Automaton("x", "<<beginOptional>>never<<endOptional>>")


def test_a_long_text_of_anchors_takes_linear_time():
    """Twice the text, about twice the time: anchors are counted on from one another."""
    import time
    automaton = next(a for a in (L.Automaton(label, text) for label, text in L.TEMPLATES) if a.anchor)

    def seconds(times):
        line = automaton.anchor * times + b" "
        words, start = line.split(), time.process_time()
        automaton.matches(words, line)
        return time.process_time() - start

    size = len(automaton.anchor)
    seconds(1000)
    assert seconds(2_000_000 // size) < 6 * max(0.2, seconds(500_000 // size))
