import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyframe.llm import lm_scoring as M
from tallyframe.llm.queries import PATTERN, RANKS, op7_attention_lm


def base(rows, out):
    """Word unigrams by dictionary."""
    counts = Counter(w for i, t in rows if not out(i) for w in M.tokens((t or "").encode()))
    total, distinct = sum(counts.values()), len(counts)
    return {i: (len(w := M.tokens((t or "").encode())), sum(counts[x] > 0 for x in w), total, sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w)) for i, t in rows}


def test_every_document(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    wanted, found = base(rows, out), op7_attention_lm(spark, data).collect()
    assert len(found) == len(rows)
    for r in found:
        n, known, total, score = wanted[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out(r["doc_id"]), n, known, total)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0


def plain_score(net, subwords, text):
    """log10 probability of a text, place by place with loops over the context."""
    w = {name: x.astype(np.float64) for name, x in net.weights.items()}
    ids = [i for word in M.tokens(text) if word for i in subwords.ids([word])]
    codes, total = [min(int(subwords.rank[i]), M.INPUTS - 1) for i in ids] + [0], sum(subwords.rest_log10[i] for i in ids)
    for place, code in enumerate(codes):
        row = 0 if place < M.WINDOW else -(-(place - M.WINDOW + 1) // M.STRIDE)
        start = row * M.STRIDE
        before = [([0] + codes)[p] for p in range(start, place + 1)]
        x = [w["embed"][c] + w["place"][j] for j, c in enumerate(before)]
        qkv = [v @ w["qkv"] for v in x]
        near = np.exp([qkv[-1][:M.WIDTH] @ v[M.WIDTH:2 * M.WIDTH] / M.WIDTH ** 0.5 for v in qkv])
        h = x[-1] + sum(n * v[2 * M.WIDTH:] for n, v in zip(near / near.sum(), qkv)) @ w["o"]
        target = min(code, M.HEAD - 1)
        for logits, at in ((h @ w["classes"] + w["class_bias"], target // M.SIZE), (h @ w["codes"][target // M.SIZE] + w["code_bias"][target // M.SIZE], target % M.SIZE)):
            total += (logits[at] - np.log(np.exp(logits).sum())) / np.log(10)
    return total


def counted(texts):
    subwords, counts = M.Subwords(RANKS, PATTERN), np.zeros(50_256, np.int64)
    for text in texts:
        for word in text.lower().split():
            np.add.at(counts, subwords.ids([word]), 1)
    return subwords.fitted(counts, len(texts))


def test_scores_match_a_plain_loop(spark):
    rows = [(i, f"Alpha beta w{i} gamma {'delta ' * (i % 50)}{chr(200 + i)} {i ** 5}") for i in range(60)] + [(70, None), (71, " "), (72, "one"), (73, "x" * 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    subwords = counted([(t or "").encode() for _, t in rows])
    ids = M.encoded(docs.selectExpr("*", "false as held_out", "doc_id as rid"), subwords, {})
    net = M.trained(ids, subwords, 1)
    assert any(not np.array_equal(w, M.Attention(subwords.heads).weights[n]) for n, w in net.weights.items())
    found = M.scored(ids, net, subwords).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["score"] == pytest.approx(plain_score(net, subwords, (dict(rows)[r["doc_id"]] or "").encode()), rel=1e-4)


def test_attention_beats_frequencies_on_held_out_texts(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("length(text) > 300").select("doc_id", "text")
    held = [r["text"].encode() for r in docs.where("doc_id % 10 = 3").collect()]
    training = docs.where("doc_id % 10 <> 3")
    subwords = counted([r["text"].encode() for r in training.collect()])
    ids = M.encoded(training.selectExpr("*", "false as held_out", "doc_id as rid"), subwords, {})
    net, windows = M.trained(ids, subwords, 1), M.Windows([subwords.codes(subwords.text_ids(t)) for t in held])
    _, targets, used = windows.some(np.arange(len(windows.row)))
    mean = np.concatenate([net.log_probs(*windows.some(np.arange(a, min(a + 64, len(windows.row))))) for a in range(0, len(windows.row), 64)]).mean()
    assert mean > np.log(subwords.heads / subwords.heads.sum())[targets[used]].mean() + 0.5


def test_long_words_and_slices():
    coder = M.Subwords(RANKS, PATTERN)
    assert len(coder.ids(["\u00a0".encode() * 300_000])) > 0 and len(coder.ids(["\u00a0".encode()] * 300_000)) > 0
    words = ["ab", "don't", "é1", "x" * 3000]
    assert coder.ids([w.encode() for w in words]).tolist() == [i for w in words for i in coder.ids([w.encode()]).tolist()]
    text = b"Some words  of\ttext\n" * 50
    assert [w for words in M.word_lists(text, 16) for w in words] == [*text.lower().split(), M.END] == M.tokens(text)


def test_joined_words_and_odd_rows(spark):
    rows = [(i, f"the cat {'sat' if i % 2 else 'ran'} w{i} w{i} É") for i in range(40)] + [(100, None), (101, ""), (102, " \n"), (103, "long " * 40_000), (104, "x" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as rid", "'x' as word", "2 as c")
    from pyspark.sql import functions as F
    found = M.lm_scores(docs, lambda c: F.col(c) % 5 == 0, RANKS, PATTERN, most_frequent=3, every=2).collect()
    wanted = base(rows, lambda i: i % 5 == 0)
    for r in found:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == wanted[r["doc_id"]][:3] and r["base_score"] == pytest.approx(wanted[r["doc_id"]][3], rel=1e-9)
    assert M.lm_scores(docs.limit(0), lambda c: F.col(c) % 5 == 0, RANKS, PATTERN).count() == 0
    alone = M.lm_scores(docs.limit(1), lambda c: F.lit(True), RANKS, PATTERN).first()
    assert (alone["train_tokens"], alone["n_known"]) == (0, 0) and alone["base_score"] == 0


@pytest.mark.parametrize("stride", [M.STRIDE, M.WINDOW, 1])
def test_every_target_counts_once(stride):
    texts = [np.arange(1, n + 1).astype(np.uint16) for n in (1, 2, 16, 31, 32, 33, 48, 49, 200, 1)]
    windows = M.Windows(texts, stride)
    inputs, targets, counts = windows.some(np.arange(len(windows.row)))
    assert inputs[counts].tolist() == [x for t in texts for x in (0, *t[:-1])] and targets[counts].tolist() == [x for t in texts for x in t]
    assert (np.argmax(counts, 1)[windows.row > 0] == M.WINDOW - stride).all()


def test_no_look_ahead_and_normalised():
    net, rng = M.Attention(), np.random.default_rng(1)
    inputs = rng.integers(0, M.INPUTS, (1, M.WINDOW))
    h = net.forward(inputs)[-1]
    changed = inputs.copy()
    changed[0, 20:] = 5
    assert np.allclose(h[:20], net.forward(changed)[-1][:20], atol=1e-6)
    every = np.repeat(inputs, M.HEAD, 0)
    targets, counts = np.tile(np.arange(M.HEAD)[:, None], (1, M.WINDOW)), np.ones((M.HEAD, M.WINDOW), bool)
    assert np.allclose(np.exp(net.log_probs(every, targets, counts).reshape(M.HEAD, M.WINDOW)).sum(0), 1, atol=1e-4)
    shares = M.Subwords(RANKS, PATTERN).fitted(rng.integers(0, 9, 5000))
    assert 10 ** shares.rest_log10[shares.rank >= M.HEAD - 1] @ np.ones((shares.rank >= M.HEAD - 1).sum()) == pytest.approx(1)


def test_gradients_match_differences():
    net, rng = M.Attention(), np.random.default_rng(2)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    inputs, targets, counts = rng.integers(0, 50, (3, M.WINDOW)), rng.integers(0, M.HEAD, (3, M.WINDOW)), rng.random((3, M.WINDOW)) < 0.7
    _, slopes = net.gradients(inputs, targets, counts)
    for name, w in net.weights.items():
        at = np.unravel_index(np.argmax(np.abs(slopes[name])), w.shape)
        near = []
        for off in (1e-4, -1e-4):
            w[at] += off
            near.append(net.gradients(inputs, targets, counts)[0])
            w[at] -= off
        assert slopes[name][at] == pytest.approx((near[0] - near[1]) / 2e-4, rel=1e-2, abs=1e-5)


def test_query_takes_every_window(spark, monkeypatch, tmp_path):
    """Every id of every training text is a target once in the passes of the query."""
    rows = [(i, f"alpha beta w{i} " * (i % 30)) for i in range(90)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    taken, fit = [], M.trained
    monkeypatch.setattr(M, "trained", lambda training, subwords, every: taken.append(every) or fit(training, subwords, every))
    assert op7_attention_lm(spark, str(tmp_path)).count() == 90 and taken == [1]
    windows = M.Windows([np.arange(1, n + 1).astype(np.uint16) for n in (1, 40, 700)], M.WINDOW)
    assert windows.some(np.arange(len(windows.row)))[2].sum() == 741
