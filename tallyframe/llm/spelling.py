"""Spelling variants: words that differ by one letter, grouped under the frequent one, with a bit-sliced position index.

Words of which one is the other with a letter put in, taken out or replaced share their first or their last half, so words meet in blocks:
of words with equal first halves, whose tails are compared, and of words with equal last halves, whose heads are compared. A block
holds words of two lengths, ``size`` and ``size + 1``. Its index has, for every position and letter, a set of words as the bits of one
number. A word goes through all words of a block at once: letter by letter, one number holds the words without an error so far, and
three others those with one: a letter replaced (positions as they are), a letter more (positions one ahead), a letter less (one behind).

The bits are in order of the words' counts, so that the lowest bit of a result is the best word and its number of bits the number of near
words: no pair is ever written. Blocks with more than ``MOST`` words are cut into indexes of about that many, each of which all words of
the block go through.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import byte_texts, picked, sub_batches, written

LEAST_LETTERS, LEAST_COUNT, TIMES, MOST, HELD = 7, 2, 10, 4096, 200_000
# What counts as a letter, and one in how many runs loses one.
LETTERS, ONE_IN = "A-Za-zÀ-ÿ", 31


def damaged(doc_id: str, run: str) -> str:
    """The run as it stands, or without one letter, by the hash of document and run."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    at = h % len(run)
    return run if h % ONE_IN else run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, least: int = LEAST_LETTERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words with ``least`` letters and ``LEAST_COUNT`` occurrences. Tasks count first; what they hold is bounded."""
    find = re.compile(f"[{LETTERS}]{{{least},}}").finditer

    def emitted(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in sub_batches(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch, "text")):
                for match in find(text.lower().decode()):
                    word = damaged(doc_id or "", match[0])
                    if len(word) >= least:
                        counts[word] += 1
                    if len(counts) >= HELD:
                        yield emitted(counts)
                        counts = Counter()
        yield emitted(counts)

    rows = picked(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("string"), "text").mapInArrow(run, "word string, n long")
    return written(rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT), "vocabulary")


class Index:
    """The letters of the words of a block, after their common half is taken off: ``ends`` are what is left, in the order of the bits."""

    def __init__(self, ends: list[str], size: int):
        self.size, self.at, self.of_size = size, [{} for _ in range(size + 2)], 0
        for i, end in enumerate(ends):
            bit = 1 << i
            if len(end) == size:
                self.of_size |= bit
            for at, letter in zip(self.at, end):
                at[letter] = at.get(letter, 0) | bit
        self.all = (1 << len(ends)) - 1

    def near(self, end: str, skip: int = 0) -> int:
        """The words with exactly one error that are of this block's sizes with ``end``: two of the smaller size, or one of each. With ``skip``, without those
        whose first ``skip`` letters are the same."""
        longer = len(end) > self.size
        none, replaced, more, less, same = self.all, 0, 0, 0, 0
        for i, letter in enumerate(end):
            if skip and i == skip:
                same = none
            here = self.at[i].get(letter, 0)
            if longer:
                less = less & (self.at[i - 1].get(letter, 0) if i else 0) | none
            else:
                more = (more | none) & self.at[i + 1].get(letter, 0)
                replaced = replaced & here | none & ~here
            none &= here
        if skip and skip >= len(end):
            same = none
        found = less & self.of_size if longer else replaced & self.of_size | (more | none) & ~self.of_size & self.all
        return found & ~same


def blocks(words: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """(size, side, half, part, indexed, word, n): every word in the four blocks where it can meet others. Blocks of one word are left out; those of more than
    ``MOST`` have several parts: a word is indexed in one and goes through all."""
    sizes = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size")
    halves = words.select("word", "n", sizes).where(F.col("size") >= least).withColumn("k", F.floor(F.col("size") / 2).cast("int"))
    sides = F.inline(F.array(F.struct(F.lit(0).alias("side"), F.xxhash64(F.substr("word", F.lit(1), F.col("k"))).alias("half")),
                             F.struct(F.lit(1).alias("side"), F.xxhash64(F.substr("word", F.length("word") - F.col("k") + 1, F.col("k"))).alias("half"))))
    rows = written(halves.select("word", "n", "size", sides), "spelling-blocks")
    key = ["size", "side", "half"]
    parts = rows.groupBy(key).agg(F.count("*").alias("c")).where("c > 1").select(*key, F.ceil(F.col("c") / MOST).cast("int").alias("parts"))
    met = rows.join(parts, key).select(*key, "word", "n", F.pmod(F.xxhash64("word"), F.col("parts")).alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return met.select(*key, "part", (F.col("own") == F.col("part")).alias("indexed"), "word", "n")


def searched(rows: DataFrame) -> DataFrame:
    """(word, near, best_n, best): for each word and part of a block in which it has near words, how many and the best. Memory follows the part's index."""
    key = ["size", "side", "half", "part"]

    def answers(size: int, side: int, words: list[tuple[str, int]], asked: list[str]) -> Iterator[tuple]:
        k, halves = size // 2, {}
        for word, n in words:  # other halves with the same hash are told apart here
            halves.setdefault(word[-k:] if side else word[:k], []).append((-n, word))
        indexes = {}
        for word in asked:
            half = word[-k:] if side else word[:k]
            if half not in indexes:
                ordered = sorted(halves.get(half, ()))
                indexes[half] = ordered, Index([w[:-k] if side else w[k:] for _, w in ordered], size - k)
            ordered, index = indexes[half]
            if found := index.near(word[:-k] if side else word[k:], k if side else 0):
                n, best = ordered[(found & -found).bit_length() - 1]
                yield word, found.bit_count(), -n, best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, words, asked, out = None, [], [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*key, "indexed", "word", "n")]
            for *now, indexed, word, n in zip(*columns):
                if now != at:
                    if asked:
                        out += answers(at[0], at[1], words, asked)
                    at, words, asked = now, [], []
                if indexed:
                    words.append((word, n))
                asked.append(word)
                if len(asked) > 4 * MOST and not indexed:  # sorted: the index is complete
                    out += answers(at[0], at[1], words, asked)
                    asked = []
            if len(out) > 10_000:
                yield answered(out)
                out = []
        if asked:
            out += answers(at[0], at[1], words, asked)
        yield answered(out)

    def answered(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "near", "best_n", "best"])

    return rows.repartition(*key).sortWithinPartitions(*key, F.desc("indexed")).mapInArrow(run, "word string, near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form. Counts grow tenfold along a chain, so few doublings reach its end."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = written(now.join(then, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return now


def variants(words: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of (word, n), words of ``least`` letters (two at least): ``form`` is the near word with the largest count (ties: the smallest in code-point order) if that is
    at least ``TIMES`` the word's own, ``root`` the end of the chain of forms, the word itself without one."""
    best = F.min(F.struct((-F.col("best_n")).alias("down"), F.col("best").alias("form")))
    near = searched(blocks(words, least)).groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    good = -F.col("best.down") >= TIMES * F.col("n")
    found = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("best.form")).alias("form"), F.when(good, -F.col("best.down")).alias("form_n")), "variants")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The words of all texts, damaged by the rule of ``damaged``, with their forms, roots and numbers of near words; see ``variants``.

    Null text has no words and a null doc_id is an empty one; a repeated row counts twice; texts and words may have any length; an empty table
    gives an empty result; other columns are ignored.
    """
    return variants(vocabulary(docs, id_col=id_col, text_col=text_col))
