"""Language-model scoring: a small causal self-attention model on subword ids, beside a word unigram model.

A text is the sequence of the subword ids of its words (each with the space before it), then an end. One attention layer reads the ids
before a place and gives the next one in two steps: a class of ids of like frequency, then the id within the class. The last code
stands for all rarer ids; each of those has its share of their counts in the corpus, so that the probabilities of all ids add up to 1. A
text's score is the sum over its ids, and of nothing else.

Every text is encoded once; its ids are kept as a table, which the counts, the passes and the scores read. What is learned covers all
training texts: word and id counts are summed by Spark. The weights start from the id counts and are fitted in
passes, each over other texts, so that every training text is met in exactly one, with all its windows: in each task numpy steps over the
windows of its texts from the weights that all tasks share, and Spark averages the tasks' weights by the ids they have met. Work and
shuffle grow with the corpus. Texts of any length are scored in windows that overlap: every id is scored once, with at least the overlap
as context, in batches of windows with masked attention.
"""

from __future__ import annotations

import base64
import ctypes
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, fields
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import byte_texts, picked, sub_batches, written

CLASSES, SIZE, INPUTS, WIDTH, WINDOW, STRIDE = 32, 32, 2048, 32, 32, 27
HEAD = CLASSES * SIZE
END = b""  # no word is empty
BLANK = re.compile(rb"[\x20\x09-\x0d]")
WIDE_BLANKS = re.compile(r"\s{2000}")
# Texts are dealt to 32 parts; each pass has its parts and its rate.
PASSES = ((range(0, 1), 0.01), (range(1, 2), 0.01), (range(2, 4), 0.008), (range(4, 8), 0.006), (range(8, 16), 0.005), (range(16, 32), 0.003))


def one_thread() -> None:
    """Numpy's matrix products in the task's own thread, as a task has one core: Spark gives a Python worker as many threads as the executor has cores."""
    for library in (Path(np.__file__).parent.parent / "numpy.libs").glob("*openblas*"):
        loaded = ctypes.CDLL(str(library))
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(loaded, name):
                getattr(loaded, name)(1)
                break


def word_lists(text: bytes, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words between ASCII white space, A-Z in lower case, then the end; a list for each ``most`` bytes of text."""
    start = 0
    while start < len(text):
        found = BLANK.search(text, start + most)
        stop = found.start() if found else len(text)
        yield text[start:stop].lower().split()
        start = stop
    yield [END]


def tokens(text: bytes) -> list[bytes]:
    return [word for words in word_lists(text) for word in words]


def word_counts(training: DataFrame, most_held: int = 200_000) -> DataFrame:
    """(word, c) over all training texts: counted in each task, added up by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def given_out():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in sub_batches(batches, "text"):
            for text in byte_texts(batch, "text"):
                for words in word_lists(text):
                    held.update(words)
                    if len(held) > most_held:
                        yield given_out()
        yield given_out()

    return written(training.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "word-counts")


@dataclass
class Subwords:
    """Ids of words as codes: 0 is the end, then the ids by falling frequency; as targets the codes from HEAD - 1 on are one."""

    ranks_path: str
    pattern: str
    rank: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rest_log10: np.ndarray = field(default_factory=lambda: np.zeros(0))
    short_rank: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint16))
    heads: np.ndarray = field(default_factory=lambda: np.ones(HEAD))
    encoding = None

    def plain(self) -> dict:
        """The fields as plain values: what travels to tasks is read there without this package."""
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def ids(self, words: list[bytes], most: int = 512) -> np.ndarray:
        """Ids of words, each after a space. Where blanks beyond ASCII stand in a long run, in pieces of ``most`` code points, as the pattern takes no such run."""
        if self.encoding is None:
            with open(self.ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.encoding = tiktoken.Encoding("vocabulary", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        text = b" ".join([b"", *words]).decode()
        if not WIDE_BLANKS.search(text):
            return self.encoding.encode_to_numpy(text, disallowed_special=())
        return np.array([i for start in range(0, len(text), most) for i in self.encoding.encode_ordinary(text[start:start + most])], np.uint32)

    def fitted(self, counts: np.ndarray, ends: int = 1) -> "Subwords":
        """Codes in order of counts; the counts of all ids beyond the head give their shares of the rest, each plus 1."""
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(counts), np.int64)
        rank[order] = np.arange(1, len(counts) + 1)
        rest = rank >= HEAD - 1
        shares = np.where(rest, np.log10((counts + 1) / (counts[rest] + 1).sum()), 0.0)
        heads = np.bincount(np.minimum(rank, HEAD - 1), counts, HEAD) + 1
        heads[0] += ends
        return Subwords(self.ranks_path, self.pattern, rank, shares, np.minimum(rank, INPUTS - 1).astype(np.uint16), heads)

    def text_ids(self, text: bytes) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint32)] + [self.ids(words) for words in word_lists(text) if words and words != [END]])

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """Codes of a text's ids, then the end."""
        return np.append(self.short_rank[ids], np.uint16(0))


def encoded(rows: DataFrame, subwords: Subwords, frequent: dict[bytes, float]) -> DataFrame:
    """Per row: rid, doc_id, held_out, the ids of its text (unsigned 32-bit, little-endian), n_tokens, and of the word model the part of the ``frequent`` words (log10 of their counts + 1) and the other words with their counts."""
    shared = rows.sparkSession.sparkContext.broadcast((subwords.plain(), frequent))
    names = ["rid", "doc_id", "held_out", "ids", "n_tokens", "n_frequent", "log_frequent", "others"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, often = shared.value
        coder = Subwords(**given)
        for batch in sub_batches(batches, "text", 2_000_000):
            ids, sums, words_, ns, offsets = [], [], [], [], [0]
            for text in byte_texts(batch, "text"):
                some, n, n_held, held, unknown = [], 0, 0, 0.0, Counter()
                for words in word_lists(text):
                    if words and words != [END]:
                        some.append(coder.ids(words).astype("<u4").tobytes())
                    logs = [often.get(word) for word in words]
                    if None in logs:
                        unknown.update([w for w, log in zip(words, logs) if log is None])
                        logs = [log for log in logs if log is not None]
                    n, n_held, held = n + len(words), n_held + len(logs), held + sum(logs)
                ids.append(b"".join(some))
                sums.append((n, n_held, held))
                words_ += unknown.keys()
                ns += unknown.values()
                offsets.append(len(ns))
            n, n_held, held = (np.array(c) for c in zip(*sums))
            others = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(words_, pa.binary()), pa.array(ns, pa.int64())], ["word", "n"]))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(ids, pa.binary()), pa.array(n, pa.int64()), pa.array(n_held, pa.int64()),
                                              pa.array(held, pa.float64()), others], names=names)

    return rows.select("rid", "doc_id", "held_out", "text").mapInArrow(run, "rid long, doc_id long, held_out boolean, ids binary, n_tokens long, n_frequent long, log_frequent double, others array<struct<word:binary,n:bigint>>")


def text_ids(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(ids, "<u4") for ids in batch.column("ids").to_pylist()]


def id_counts(training: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in the training texts. At most ``size`` numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for batch in sub_batches(batches, "ids"):
            sums += np.bincount(np.concatenate(text_ids(batch)), minlength=size)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["id", "n"])

    found = training.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(size, np.int64)
    sums[found["id"].to_numpy()] = found["n"].to_numpy()
    return sums


class Windows:
    """Windows over texts: rows of WINDOW places, each ``stride`` further on in its text. The input of a place is the code before it, the
    end for the first. Every place counts as a target in exactly one row, after a text's first row with WINDOW - stride codes before it.
    Inputs beyond a text's end are those of the next text: places before them don't see them, and places there don't count."""

    def __init__(self, texts: list[np.ndarray], stride: int = STRIDE):
        self.stride, self.sizes = stride, np.array([len(t) for t in texts], np.int64)
        self.flat = np.concatenate([x for t in texts for x in (np.zeros(1, np.uint16), t)] + [np.zeros(WINDOW + 1, np.uint16)])
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        rows = 1 + np.maximum(0, -(-(self.sizes - WINDOW) // stride))
        self.owner = np.repeat(np.arange(len(texts)), rows)
        self.row = np.arange(len(self.owner)) - np.repeat(np.cumsum(rows) - rows, rows)

    def some(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(inputs, targets, which targets count) of rows."""
        owner, row = self.owner[which][:, None], self.row[which][:, None]
        place = row * self.stride + np.arange(WINDOW)
        at = np.minimum(self.starts[owner] + place, len(self.flat) - 2)
        return self.flat[at], np.minimum(self.flat[at + 1], HEAD - 1).astype(np.int64), (place < self.sizes[owner]) & ((np.arange(WINDOW) >= WINDOW - self.stride) | (row == 0))


class Attention:
    """One causal self-attention layer with a residual; the next code by its class, then within the class."""

    def __init__(self, heads: np.ndarray | None = None, seed: int = 7):
        rng = np.random.default_rng(seed)
        shapes = {"embed": (INPUTS, WIDTH), "place": (WINDOW, WIDTH), "qkv": (WIDTH, 3 * WIDTH), "o": (WIDTH, WIDTH), "classes": (WIDTH, CLASSES), "codes": (CLASSES, WIDTH, SIZE)}
        self.weights = {name: (rng.standard_normal(shape) * 0.2).astype(np.float32) for name, shape in shapes.items()}
        shares = np.ones(HEAD) if heads is None else heads
        by_class = shares.reshape(CLASSES, SIZE)
        self.weights["class_bias"] = np.log(by_class.sum(1) / shares.sum()).astype(np.float32)
        self.weights["code_bias"] = np.log(by_class / by_class.sum(1, keepdims=True)).astype(np.float32)
        self.seen = np.tril(np.ones((WINDOW, WINDOW), np.float32))

    def forward(self, inputs: np.ndarray):
        w = self.weights
        x = (w["embed"][inputs] + w["place"]).reshape(-1, WIDTH)
        qkv = (x @ w["qkv"]).reshape(-1, WINDOW, 3 * WIDTH)
        q, k, v = qkv[..., :WIDTH], qkv[..., WIDTH:2 * WIDTH], qkv[..., 2 * WIDTH:]
        near = q @ k.transpose(0, 2, 1)
        near *= np.float32(WIDTH ** -0.5)
        np.minimum(near, 60, out=near)
        np.exp(near, out=near)
        near *= self.seen
        near /= near.sum(-1, keepdims=True)
        mixed = (near @ v).reshape(-1, WIDTH)
        return x, q, k, v, near, mixed, x + mixed @ w["o"]

    @staticmethod
    def softmax(logits: np.ndarray, chosen: np.ndarray, shares: bool = False) -> np.ndarray:
        """Logarithms of the chosen ones; with ``shares`` the logits become the probabilities."""
        np.minimum(logits, 60, out=logits)
        said = logits[np.arange(len(logits)), chosen]
        np.exp(logits, out=logits)
        sums = logits.sum(-1)
        if shares:
            logits /= sums[:, None]
        return said - np.log(sums)

    def by_class(self, targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Rows in order of their targets' class, and (class, first, last) of each that occurs."""
        kinds = targets // SIZE
        order = np.argsort(kinds, kind="stable")
        cuts = np.searchsorted(kinds[order], np.arange(CLASSES + 1))
        return order, [(c, cuts[c], cuts[c + 1]) for c in range(CLASSES) if cuts[c] < cuts[c + 1]]

    def log_probs(self, inputs: np.ndarray, targets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Natural logarithms for the targets that count, row after row."""
        w, targets = self.weights, targets[counts]
        h = self.forward(inputs)[-1][counts.reshape(-1)]
        found = self.softmax(h @ w["classes"] + w["class_bias"], targets // SIZE).astype(np.float64)
        order, runs = self.by_class(targets)
        h, inner = h[order], targets[order] % SIZE
        for c, a, b in runs:
            found[order[a:b]] += self.softmax(h[a:b] @ w["codes"][c] + w["code_bias"][c], inner[a:b])
        return found

    def gradients(self, inputs: np.ndarray, targets: np.ndarray, counts: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the targets that count, and its slopes."""
        w, kind = self.weights, self.weights["o"].dtype.type
        x, q, k, v, near, mixed, h = self.forward(inputs)
        used, targets = np.flatnonzero(counts.reshape(-1)), targets[counts]
        share = kind(1 / max(1, len(targets)))
        order, runs = self.by_class(targets)
        used, outer, inner = used[order], targets[order] // SIZE, targets[order] % SIZE
        seen = h[used]
        off = seen @ w["classes"] + w["class_bias"]
        loss = float(self.softmax(off, outer, True).sum())
        off[np.arange(len(off)), outer] -= 1
        off *= share
        d_seen = off @ w["classes"].T
        slopes = {"classes": seen.T @ off, "class_bias": off.sum(0), "codes": np.zeros_like(w["codes"]), "code_bias": np.zeros_like(w["code_bias"])}
        for c, a, b in runs:
            off = seen[a:b] @ w["codes"][c] + w["code_bias"][c]
            loss += float(self.softmax(off, inner[a:b], True).sum())
            off[np.arange(b - a), inner[a:b]] -= 1
            off *= share
            slopes["codes"][c], slopes["code_bias"][c] = seen[a:b].T @ off, off.sum(0)
            d_seen[a:b] += off @ w["codes"][c].T
        d_h = np.zeros_like(h)
        d_h[used] = d_seen
        d_mixed = (d_h @ w["o"].T).reshape(-1, WINDOW, WIDTH)
        d_near = d_mixed @ v.transpose(0, 2, 1)
        d_near -= (d_near * near).sum(-1, keepdims=True)
        d_near *= near
        d_near *= kind(WIDTH ** -0.5)
        d_qkv = np.concatenate([d_near @ k, d_near.transpose(0, 2, 1) @ q, near.transpose(0, 2, 1) @ d_mixed], -1).reshape(-1, 3 * WIDTH)
        d_x = d_h + d_qkv @ w["qkv"].T
        flat = inputs.reshape(-1)
        order = np.argsort(flat, kind="stable")
        firsts = np.flatnonzero(np.diff(flat[order].astype(np.int64), prepend=-1))
        embed = np.zeros_like(w["embed"])
        embed[flat[order[firsts]]] = np.add.reduceat(d_x[order], firsts)
        slopes |= {"embed": embed, "place": d_x.reshape(-1, WINDOW, WIDTH).sum(0), "qkv": x.T @ d_qkv, "o": mixed.T @ d_h}
        return -loss * float(share), slopes


class Steps:
    """Adam over batches of windows, with a short warm-up."""

    def __init__(self, net: Attention, rate: float, batch: int = 48):
        self.net, self.rate, self.batch, self.step, self.met = net, rate, batch, 0, 0
        self.first, self.second = ({name: np.zeros_like(w) for name, w in net.weights.items()} for _ in range(2))

    def over(self, windows: Windows, which: np.ndarray) -> None:
        """Steps over the given rows, in an order that depends on their number only."""
        which = np.random.default_rng(11).permutation(which)
        for start in range(0, len(which), self.batch):
            inputs, targets, counts = windows.some(which[start:start + self.batch])
            self.step += 1
            self.met += int(counts.sum())
            rate = self.rate * min(1.0, self.step / 10)
            for name, g in self.net.gradients(inputs, targets, counts)[1].items():
                m, s = self.first[name], self.second[name]
                m += np.float32(0.1) * (g - m)
                s += np.float32(0.01) * (g * g - s)
                self.net.weights[name] -= np.float32(rate / (1 - 0.9 ** self.step)) * m / (np.sqrt(s / np.float32(1 - 0.99 ** self.step)) + np.float32(1e-8))


def one_pass(rows: DataFrame, net: Attention, subwords: Subwords, every: int, rate: float) -> Attention:
    """The average of the weights that each task reaches on its rows (ids, salt), by the number of ids it has met."""
    shared = rows.sparkSession.sparkContext.broadcast((net.weights, subwords.plain()))
    size = sum(w.size for w in net.weights.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        weights, given = shared.value
        coder = Subwords(**given)
        mine = Attention()
        mine.weights = {name: w.copy() for name, w in weights.items()}
        steps = Steps(mine, rate)
        for batch in sub_batches(batches, "ids", 2_000_000):
            windows = Windows([coder.codes(ids) for ids in text_ids(batch)], WINDOW)
            salts = batch.column("salt").to_numpy()
            steps.over(windows, np.flatnonzero((windows.row + salts[windows.owner]) % every == 0))
        if steps.met:
            sums = np.concatenate([mine.weights[name].reshape(-1) for name in sorted(weights)] + [np.ones(1)]).astype(np.float64) * steps.met
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(sums)], names=["at", "v"])

    found = rows.select("ids", "salt").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    shared.unpersist()
    after = Attention()
    after.weights = net.weights
    if found.num_rows:
        sums = np.empty(size + 1)
        sums[found["at"].to_numpy()] = found["v"].to_numpy()
        flat, at, after.weights = (sums[:-1] / sums[-1]).astype(np.float32), 0, {}
        for name in sorted(net.weights):
            after.weights[name] = flat[at:at + net.weights[name].size].reshape(net.weights[name].shape)
            at += net.weights[name].size
    return after


def trained(training: DataFrame, subwords: Subwords, every: int) -> Attention:
    """The model after all passes over (doc_id, ids). A pass over a share of the rows runs in the like share of twice the tasks, so that all tasks take about as many steps and their number grows with the rows."""
    net, dealt, tasks = Attention(subwords.heads), F.xxhash64("doc_id", F.lit("pass")), training.rdd.getNumPartitions()
    rows = training.select("ids", F.pmod(dealt, F.lit(32)).alias("part"), F.pmod(F.xxhash64("doc_id", F.lit("window")), F.lit(every)).alias("salt"))
    for parts, rate in PASSES:
        net = one_pass(rows.where(F.col("part").between(parts[0], parts[-1])).coalesce(max(1, tasks * len(parts) // 16)), net, subwords, every, rate)
    return net


def scored(rows: DataFrame, model: Attention, subwords: Subwords, chunk: int = 64) -> DataFrame:
    """The rows of ``encoded`` without their ids and words, with the model's score."""
    shared = rows.sparkSession.sparkContext.broadcast((model.weights, subwords.plain()))
    kept = ["rid", "doc_id", "held_out", "n_tokens", "n_frequent", "log_frequent"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        weights, given = shared.value
        coder = Subwords(**given)
        net = Attention()
        net.weights = weights
        for batch in sub_batches(batches, "ids", 2_000_000):
            texts = text_ids(batch)
            windows, scores = Windows([coder.codes(ids) for ids in texts]), np.zeros(len(texts))
            for a in range(0, len(windows.row), chunk):
                which = np.arange(a, min(a + chunk, len(windows.row)))
                inputs, targets, counts = windows.some(which)
                scores += np.bincount(np.repeat(windows.owner[which], counts.sum(1)), net.log_probs(inputs, targets, counts), len(texts))
            rest = [coder.rest_log10[ids].sum() for ids in texts]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(scores / np.log(10) + rest, pa.float64())], names=[*kept, "score"])

    return rows.select(*kept, "ids").mapInArrow(run, "rid long, doc_id long, held_out boolean, n_tokens long, n_frequent long, log_frequent double, score double")


def lm_scores(docs: DataFrame, held_out, ranks_path: str, pattern: str, most_frequent: int = 100_000, every: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every text by a word unigram model and by the attention model, both learned from the rows where ``held_out`` is false.

    Result: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of the whole text, by the word counts
    and by the attention model alone). doc_id is a whole number. Null and empty texts are the end alone; repeated rows are scored each; with
    no row to learn from every count is 0 and the attention model has its first weights; an empty table gives an empty result; other columns
    are ignored. Counts cover all training texts. Every training text is met in one pass, over all its windows; ``every`` above 1 takes one
    in so many of them (which ones comes from doc_id). The counts of the ``most_frequent`` words of at most 64 bytes travel to the tasks, all others are joined.
    """
    rows = picked(docs, doc_id=id_col, text=text_col).withColumn("held_out", held_out("doc_id"))
    training = rows.where("not held_out")
    counts = word_counts(training)
    total, distinct, ends = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.octet_length("word") == 0, F.col("c"))), F.lit(0))).first()
    subwords = Subwords(ranks_path, pattern)
    with open(ranks_path, "rb") as lines:
        size = 1 + max(int(line.split()[1]) for line in lines)
    top = counts.where(F.octet_length("word") <= 64).orderBy(F.desc("c"), "word").limit(most_frequent).toArrow()
    frequent = dict(zip(top["word"].to_pylist(), np.log10(top["c"].to_numpy() + 1.0).tolist()))
    found = written(encoded(rows.withColumn("rid", F.monotonically_increasing_id()), subwords, frequent), "encoded")
    learnt = found.where("not held_out")
    subwords = subwords.fitted(id_counts(learnt, size), ends)
    model = trained(learnt, subwords, every)
    others = found.select("rid", F.explode("others").alias("o")).select("rid", "o.word", "o.n").join(counts, "word")
    more = others.groupBy("rid").agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more_log"))
    joined = scored(found, model, subwords).join(more, "rid", "left").fillna(0, ["more_known"]).fillna(0.0, ["more_log"])
    base = F.col("log_frequent") + F.col("more_log") - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))
    return joined.select("doc_id", "held_out", "n_tokens", (F.col("n_frequent") + F.col("more_known")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
