"""Expectation-maximisation of topics over term counts, as passes of Arrow batches.

The same steps as MLlib's EM on a graph of one edge for each text and term, from the same random start, so that the topics are the same up to
the rounding of sums. A text is one row here: a pass goes once over the rows and shuffles only sums per term, not a message for each edge.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml import Estimator
from pyspark.ml.clustering import LocalLDAModel
from pyspark.ml.linalg import DenseMatrix, DenseVector, MatrixUDT, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from tallyframe.sources.stored import scratch

# After so many passes the texts' topic counts are kept, so that a pass never repeats more steps than these.
KEPT_EVERY = 8
# Numbers of a pass that a task holds at a time (a text at least), and of the random start that it makes at a time.
HELD, BLOCK = 1 << 17, 1 << 16
STEP, ADD, BITS = 0x5DEECE66D, 0xB, (1 << 48) - 1


class Uniform:
    """The doubles of a java.util.Random, many at a time."""

    def __init__(self, seed: int):
        self.state = np.uint64((seed ^ STEP) & BITS)
        self.scale, self.shift = np.array([STEP], np.uint64), np.array([ADD], np.uint64)
        while len(self.scale) < BLOCK:
            self.scale, self.shift = np.append(self.scale, self.scale * self.scale[-1]), np.append(self.shift, self.scale * self.shift[-1] + self.shift)

    def some(self, n: int) -> np.ndarray:
        found = [np.zeros(0)]
        for start in range(0, n, BLOCK // 2):
            m = 2 * min(BLOCK // 2, n - start)
            states = (self.scale[:m] * self.state + self.shift[:m]) & np.uint64(BITS)
            self.state = states[-1]
            found.append((((states[::2] >> np.uint64(22)) << np.uint64(27)) + (states[1::2] >> np.uint64(21))) * 2.0**-53)
        return np.concatenate(found)


# Topics are rows and texts or terms columns, as sums over a few topics are then sums of long rows.


def shares(weights: np.ndarray) -> np.ndarray:
    weights /= weights.sum(0)
    return weights


def by_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive columns; texts without any have 0."""
    sums, some = np.zeros((len(values), len(sizes))), sizes > 0
    if some.any():
        sums[:, some] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[some], 1)
    return sums


def counts_of(features: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and counts other than 0 of all vectors, text after text, and how many of them each text has."""
    kinds, _, indices, lists = features.flatten()
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    values, sparse = lists.flatten().to_numpy(zero_copy_only=False), np.repeat(kinds.to_numpy(zero_copy_only=False) == 0, sizes)
    terms = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    terms[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
    used = values != 0
    return terms[used], values[used], np.bincount(np.repeat(np.arange(len(sizes)), sizes)[used], minlength=len(sizes))


def runs(sizes: np.ndarray, most: int) -> Iterator[tuple[slice, slice]]:
    """Texts in runs of at most ``most`` terms (a text at least), and where their terms are."""
    ends = np.append(0, np.cumsum(sizes))
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + most, "right")) - 1)
        yield slice(first, last), slice(int(ends[first]), int(ends[last]))
        first = last


class TopicsByEM(Estimator):
    """Topics of term counts in ``features``. The model is MLlib's, and so are the concentrations that it takes by default."""

    def __init__(self, k: int, iterations: int, seed: int):
        super().__init__()
        self.k, self.iterations, self.seed = k, iterations, seed
        self.alpha, self.eta = 50 / k + 1, 1.1

    def _fit(self, dataset: DataFrame) -> LocalLDAModel:
        first = dataset.select("features").first()
        if first is None:
            raise ValueError("no texts to learn from")
        return self.model(dataset.sparkSession, self.topics(dataset.select("features"), first[0].size))

    def topics(self, rows: DataFrame, terms: int) -> np.ndarray:
        """How much of each term is in each topic after all iterations; only sums for each term and topic leave the tasks."""
        given, held = [], None
        found = self.sums(rows, given, terms)
        for _ in range(self.iterations):
            given.append((found + self.eta - 1) / (found.sum(1, keepdims=True) + terms * (self.eta - 1)))
            found = self.sums(rows, given, terms)
            if len(given) == KEPT_EVERY:
                rows, before = self.kept(rows, given).persist(StorageLevel.MEMORY_AND_DISK), held
                rows.count()
                given, held = [], rows
                if before:
                    before.unpersist()
        if held:
            held.unpersist()
        return found

    def steps(self, rows: DataFrame, given: list[np.ndarray]):
        """For the batches of a task: the features, terms, numbers of terms and shares of topics in each term of a run of texts, after the steps with the ``given`` weights of terms."""
        shared, k, alpha, seed, known = rows.sparkSession.sparkContext.broadcast(given), self.k, self.alpha, self.seed, "topics" in rows.columns

        def run(batches: Iterator[pa.RecordBatch]):
            start = Uniform(seed + TaskContext.get().partitionId())
            for batch in batches:
                all_terms, all_counts, all_sizes = counts_of(batch.column("features"))
                before = batch.column("topics").flatten().to_numpy().reshape(-1, k).T if known else None
                for texts, at in runs(all_sizes, HELD // k):
                    terms, counts, sizes = all_terms[at], all_counts[at], all_sizes[texts]
                    # With kept topics the first step begins from them, else from a random share of each term.
                    parts, topics = None, before[:, texts] if known else None
                    if not known:
                        parts = shares(np.ascontiguousarray(start.some(len(terms) * k).reshape(-1, k).T)) * counts
                    for weights in shared.value:
                        topics = topics if parts is None else by_text(parts, sizes)
                        parts = shares(weights.take(terms, 1) * np.repeat(topics + alpha - 1, sizes, 1)) * counts
                    yield batch.column("features")[texts], terms, sizes, parts

        return run

    def sums(self, rows: DataFrame, given: list[np.ndarray], terms: int) -> np.ndarray:
        steps, k = self.steps(rows, given), self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((k, terms))
            for _, words, _, parts in steps(batches):
                for topic in range(k):
                    sums[topic] += np.bincount(words, parts[topic], terms)
            used = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums.reshape(-1)[used])], names=["at", "v"])

        # Added in order of size, so that the rounding does not depend on which task ends first.
        in_order = F.aggregate(F.array_sort(F.collect_list("v")), F.lit(0.0), lambda a, b: a + b)
        found = rows.mapInArrow(run, "at long, v double").groupBy("at").agg(in_order.alias("v")).toArrow()
        sums = np.zeros(k * terms)
        sums[found["at"].to_numpy()] = found["v"].to_numpy()
        return sums.reshape(k, terms)

    def kept(self, rows: DataFrame, given: list[np.ndarray]) -> DataFrame:
        """The rows with their topic counts after the steps."""
        steps, k = self.steps(rows, given), self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for features, _, sizes, parts in steps(batches):
                topics = by_text(parts, sizes).T
                yield pa.RecordBatch.from_arrays([features, pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * k, pa.int32()), pa.array(topics.reshape(-1)))], names=["features", "topics"])

        return rows.mapInArrow(run, "features struct<type:tinyint,size:int,indices:array<int>,values:array<double>>, topics array<double>")

    def model(self, spark, topics: np.ndarray) -> LocalLDAModel:
        """The topics as a model of MLlib, by way of the files that it reads."""
        folder, terms = scratch(spark, "topics"), topics.shape[1]
        params = {"k": self.k, "seed": self.seed, "maxIter": self.iterations, "optimizer": "em", "featuresCol": "features", "topicDistributionCol": "topicDistribution"}
        about = {"class": "org.apache.spark.ml.clustering.LocalLDAModel", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": self.uid, "paramMap": params, "defaultParamMap": {}}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{folder}/metadata")
        schema = StructType().add("vocabSize", IntegerType()).add("topicsMatrix", MatrixUDT()).add("docConcentration", VectorUDT()).add("topicConcentration", DoubleType()).add("gammaShape", DoubleType())
        row = (terms, DenseMatrix(terms, self.k, topics.reshape(-1)), DenseVector([self.alpha] * self.k), self.eta, 100.0)
        spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{folder}/data")
        return LocalLDAModel.load(folder)
