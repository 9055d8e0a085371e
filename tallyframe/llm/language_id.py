"""Language identification by rank-order profiles.

A profile is a language's most frequent letter n-grams (1 to 3 letters, words padded with a space) in order of their counts over all
labelled training texts. A document's own most frequent n-grams are compared with each profile by the out-of-place distance: the
sum of the differences in rank, with the profile's length for an n-gram that the profile lacks. The least distance wins.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.shared import over_batches, picked, sub_batches

SPACE, SHIFT = 32, 21  # a code point has 21 bits, three fit a 64-bit number
_TABLES: dict[str, np.ndarray] = {}


def letters() -> np.ndarray:
    """Which code points are letters; one table per Python worker."""
    if not _TABLES:
        _TABLES["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _TABLES["letters"]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as numbers, ascending; their counts) of a whole text; none if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    codes = np.concatenate(([SPACE], np.where(letters()[codes], codes, SPACE), [SPACE])).astype(np.int64)
    codes = codes[np.concatenate(([True], (codes[1:] != SPACE) | (codes[:-1] != SPACE)))]
    inner = codes != SPACE
    pairs = codes[:-1] << SHIFT | codes[1:]
    triples = (pairs[:-1] << SHIFT | codes[2:])[inner[1:-1]]
    found = np.sort(np.concatenate((codes[inner], pairs, triples))) if inner.any() else codes[:0]
    starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(found) else found
    return found[starts], np.diff(np.append(starts, len(found)))


def most_frequent(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties by number."""
    return grams[np.argsort(-counts, kind="stable")[:size]]


def profiles(labelled: DataFrame, size: int = 300, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, list[int]]:
    """Each language's profile, from all rows with a language.

    Every task counts the n-grams of its rows by language, Spark adds the counts up, and only ``size`` n-grams per language come
    to the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = defaultdict(list)
        waiting = 0

        def given_out():
            for lang, parts in held.items():
                grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                sums = np.bincount(back, np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(sums)], names=["lang", "gram", "n"])
            held.clear()

        for batch in sub_batches(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if text and len((found := ngrams(text))[0]):
                    held[lang].append(found)
                    waiting += len(found[0])
            if waiting > 4_000_000:
                yield from given_out()
                waiting = 0
        yield from given_out()

    rows = picked(labelled, text=text_col, lang=lang_col).where("lang is not null")
    sums = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = sums.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("place") <= size)
    found: dict[str, list[int]] = defaultdict(list)
    for lang, gram, _ in sorted(ranked.select("lang", "gram", "place").collect(), key=lambda r: (r["lang"], r["place"])):
        found[lang].append(gram)
    return dict(found)


def judge_of(known: dict[str, list[int]], size: int):
    """A function from a text to its language and score."""
    names = sorted(known)
    sorted_grams = [np.sort(np.array(known[name], np.int64)) for name in names]
    ranks = [np.argsort(np.array(known[name], np.int64)) for name in names]  # rank of the n-gram at each place of the sorted ones

    def judged(text: str | None) -> tuple[str, float]:
        grams, counts = ngrams(text) if text else (np.zeros(0, np.int64),) * 2
        if not len(grams) or not names:
            return "und", 0.0
        own = most_frequent(grams, counts, size)
        places, best, pick = np.arange(len(own)), None, 0
        for i, there in enumerate(sorted_grams):
            at = np.minimum(np.searchsorted(there, own), len(there) - 1)
            distance = int(np.where(there[at] == own, np.abs(ranks[i][at] - places), size).sum())
            if best is None or distance < best:
                best, pick = distance, i
        return names[pick], max(0.0, 1.0 - best / (size * len(own)))

    return judged


def identify(docs: DataFrame, known: dict[str, list[int]], size: int = 300, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of every text.

    Result: doc_id, lang_pred, score (1 for a text whose n-grams have exactly the profile's order, 0 for one that shares none). Null
    texts, texts without a letter, and all texts if no language is known get ``und`` and score 0. Equal distances go to the
    language that comes first by name. Repeated rows are judged each; an empty table gives an empty result; other columns are ignored.
    """
    judged = judge_of(known, size)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [judged(text) for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                          names=["doc_id", "lang_pred", "score"])

    return over_batches(picked(docs, doc_id=id_col, text=text_col), work, "doc_id long, lang_pred string, score double")


def held_out(doc_id, folds: int = 4, fold: int = 2):
    """Whether a document is kept from learning, by its identifier's CRC."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def recognised(docs: DataFrame, known: dict[str, list[int]], least: float = 0.2, size: int = 300, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is in a known language: not ``und``, and with a score of ``least`` or more."""
    judge = judge_of(known, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, text_col):
            found = [judge(text) for text in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array([lang != "und" and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
