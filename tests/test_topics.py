"""Topics by passes, against MLlib's EM on a graph."""

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyframe.operators import generators as S
from tallyframe.operators import learning as M
from tallyframe.operators import topics as T


def test_random_numbers_of_the_jvm(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 64)
    mine, theirs = T.Uniform(45), spark._jvm.java.util.Random(45)
    assert [*mine.some(70), *mine.some(0), *mine.some(5)] == [theirs.nextDouble() for _ in range(75)]


def docs(spark, partitions):
    odd = spark.createDataFrame([(Vectors.dense([0.0] * 30),), (Vectors.dense([float(i % 4) for i in range(30)]),), (Vectors.sparse(30, [3, 5], [0.0, 2.0]),), (Vectors.sparse(30, [], []),)], ["features"]).coalesce(1)
    return S.bag_of_words(spark.range(0, 400, 1, partitions), 30, 12).select("features").union(odd)


@pytest.mark.parametrize("kept_every,held", [(8, 1 << 21), (2, 90), (1, 1)])
def test_same_topics_as_the_graph(spark, monkeypatch, kept_every, held):
    monkeypatch.setattr(T, "KEPT_EVERY", kept_every)
    monkeypatch.setattr(T, "HELD", held)
    rows = docs(spark, 3)
    theirs = LDA(k=4, seed=42, maxIter=5, optimizer="em").fit(rows)
    mine = T.TopicsByEM(4, 5, 42).fit(rows)
    assert np.allclose(mine.topicsMatrix().toArray(), theirs.topicsMatrix().toArray(), rtol=1e-9)
    assert mine.estimatedDocConcentration() == theirs.estimatedDocConcentration()
    both = [np.array([r[0] for r in m.transform(rows).select(vector_to_array("topicDistribution")).collect()]) for m in (mine, theirs.toLocal())]
    assert np.allclose(*both, rtol=1e-9)


def test_reruns_agree_and_no_graph(spark):
    runs = [M.run_stage("lda", spark.range(0, 2000, 1, 5), spark.range(60), optimizer="em")[1] for _ in range(2)]
    assert runs[0] == runs[1] and isinstance(M.STAGES["lda"].stage({"k": 2, "iterations": 1, "optimizer": "em"}), T.TopicsByEM)
    with pytest.raises(ValueError):
        T.TopicsByEM(2, 1, 42).fit(docs(spark, 1).where(F.lit(False)))
