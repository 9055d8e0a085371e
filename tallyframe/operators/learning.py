"""Learning stages: planted data, one fit or transform, a score on training and on test rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Estimator, Transformer
from pyspark.ml import classification as C
from pyspark.ml import clustering as K
from pyspark.ml import feature as X
from pyspark.ml import regression as G
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.util import HasTrainingSummary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.apply import vector_slices
from tallyframe.operators import generators as S
from tallyframe.operators.topics import TopicsByEM
from tallyframe.sources.stored import scratch

SEED = 42
# Word2Vec trains a partition in one task and averages the partitions: so many texts at most in each.
ROWS_A_TASK = 1_000_000


@dataclass(frozen=True)
class Stage:
    """``data(ids, seed, p)`` makes rows, ``stage(p)`` the estimator or transformer, ``score`` the evaluator."""

    data: Callable[[DataFrame, int, dict], DataFrame]
    stage: Callable[[dict], Estimator | Transformer]
    score: Callable[[], Evaluator] | None = None
    params: dict = field(default_factory=dict)
    pair: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]] | None = None


def _multiclass():
    return MulticlassClassificationEvaluator(metricName="f1")


def _rmse():
    return RegressionEvaluator(metricName="rmse")


def _linear(classes: bool):
    def data(ids, seed, p):
        weights, intercept = S.linear_truth(p["features"], SEED)
        return S.planted_linear(S.continuous(ids, p["features"], seed), weights, intercept, classes)

    return data


def _glm(ids, seed, p):
    weights, intercept = S.linear_truth(p["features"], SEED)
    return S.planted_glm(S.continuous(ids, p["features"], seed), weights, intercept, p["link"])


def _tree(classes: bool, extra: int = 0):
    def data(ids, seed, p):
        arity, kinds = S.tree_arity(p["features"]), p.get("classes", 0) if classes else 0
        labelled = S.planted_tree(S.mixed(ids, arity, seed), S.random_tree(arity, p["depth"] + extra, kinds, SEED))
        return S.with_label_metadata(labelled, kinds)

    return data


def _naive_bayes(ids, seed, p):
    arity = [2 + i * 17 // max(1, p["features"] - 1) for i in range(p["features"])]
    return S.planted_nb(S.mixed(ids, arity, seed), *S.naive_bayes_truth(p["classes"], p["features"], SEED))


def _mixture(ids, seed, p):
    return S.gaussian_mixture(ids, p["k"], p["features"], SEED).select("features") if seed == SEED else S.gaussian_mixture(ids.select((F.col("id") + 10**12).alias("id")), p["k"], p["features"], SEED).select("features")


def _continuous(ids, seed, p):
    return S.continuous(ids, p["features"], seed)


def _first_feature(ids, seed, p):
    return S.continuous(ids, 1, seed).select("id", vector_to_array("features")[0].alias("input"))


def _words(ids, seed, p):
    return S.docs(ids, p["vocabulary"], p["length"], seed).select("id", F.split(F.ltrim("text"), " ").alias("words"))


def _slices(ids, seed, p):
    rows = S.continuous(ids, p["features"], seed)
    return rows.select("id", *[c.alias(f"part{i}") for i, c in enumerate(vector_slices("features", p["features"], p["pieces"]))])


def _non_empty_sets(ids, seed, p):
    # MinHash needs a non-zero entry; the first feature is set for every row.
    rows = S.mixed(ids, [2] * p["features"], seed)
    return rows.select("id", S.array_to_vector(F.transform(vector_to_array("features"), lambda v, j: F.when(j == 0, 1.0).otherwise(v))).alias("features"))


def _topics(p):
    # MLlib's EM has a graph edge and two messages for each text and term; the same steps here are passes over the texts.
    return TopicsByEM(p["k"], p["iterations"], SEED) if p["optimizer"] == "em" else K.LDA(k=p["k"], seed=SEED, maxIter=p["iterations"], optimizer=p["optimizer"])


STAGES: dict[str, Stage] = {
    "tree_class": Stage(_tree(True), lambda p: C.DecisionTreeClassifier(maxDepth=p["depth"], seed=SEED), _multiclass, {"features": 12, "depth": 3, "classes": 4}),
    "gbt_class": Stage(_tree(True, 1), lambda p: C.GBTClassifier(maxDepth=p["depth"], maxIter=p["iterations"], seed=SEED), _multiclass, {"features": 12, "depth": 2, "classes": 2, "iterations": 5}),
    "rf_class": Stage(_tree(True), lambda p: C.RandomForestClassifier(maxDepth=p["depth"], numTrees=p["iterations"], seed=SEED), _multiclass, {"features": 12, "depth": 4, "classes": 4, "iterations": 10}),
    "logreg": Stage(_linear(True), lambda p: C.LogisticRegression(tol=p["tol"], maxIter=p["iterations"], regParam=p["reg"]), _multiclass, {"features": 10, "tol": 1e-6, "iterations": 20, "reg": 0.001}),
    "svc": Stage(_linear(True), lambda p: C.LinearSVC(tol=p["tol"], maxIter=p["iterations"], regParam=p["reg"]), _multiclass, {"features": 10, "tol": 1e-6, "iterations": 10, "reg": 0.001}),
    "nb": Stage(_naive_bayes, lambda p: C.NaiveBayes(smoothing=p["smoothing"]), _multiclass, {"features": 10, "classes": 5, "smoothing": 1.0}),
    "gmm": Stage(_mixture, lambda p: K.GaussianMixture(k=p["k"], seed=SEED, maxIter=p["iterations"], tol=p["tol"]), None, {"features": 5, "k": 3, "iterations": 5, "tol": 0.01}),
    "kmeans": Stage(_mixture, lambda p: K.KMeans(k=p["k"], seed=SEED, maxIter=p["iterations"], tol=p["tol"]), None, {"features": 5, "k": 5, "iterations": 10, "tol": 1e-4}),
    "lda": Stage(lambda ids, seed, p: S.bag_of_words(ids, p["vocabulary"], p["length"], seed), _topics, None,
                 {"vocabulary": 100, "length": 20, "k": 4, "iterations": 5, "optimizer": "online"}),
    "lsh_projection": Stage(_continuous, lambda p: X.BucketedRandomProjectionLSH(inputCol="features", outputCol="out", numHashTables=p["tables"], bucketLength=p["bucket"], seed=SEED), None, {"features": 10, "tables": 2, "bucket": 0.5}),
    "lsh_minhash": Stage(_non_empty_sets, lambda p: X.MinHashLSH(inputCol="features", outputCol="out", numHashTables=p["tables"], seed=SEED), None, {"features": 20, "tables": 2}),
    "bucketizer": Stage(_first_feature, lambda p: X.Bucketizer(splits=[-float("inf"), *p["splits"], float("inf")], inputCol="input", outputCol="out"), None, {"splits": [-0.7, -0.2, 0.1, 0.6]}),
    "quantiles": Stage(_first_feature, lambda p: X.QuantileDiscretizer(numBuckets=p["buckets"], relativeError=p["error"], inputCol="input", outputCol="out"), None, {"buckets": 4, "error": 0.001}),
    "hashing_tf": Stage(_words, lambda p: X.HashingTF(numFeatures=p["slots"], inputCol="words", outputCol="out"), None, {"vocabulary": 1000, "length": 20, "slots": 256}),
    "one_hot": Stage(lambda ids, seed, p: S.mixed(ids, [p["arity"]], seed).select("id", vector_to_array("features")[0].alias("input")), lambda p: X.OneHotEncoder(inputCols=["input"], outputCols=["out"]), None, {"arity": 10}),
    "string_index": Stage(lambda ids, seed, p: S.rand_string(ids, p["distinct"], seed, "input"), lambda p: X.StringIndexer(inputCol="input", outputCol="out", handleInvalid="skip"), None, {"distinct": 50}),
    "tokenizer": Stage(lambda ids, seed, p: S.docs(ids, p["vocabulary"], p["length"], seed), lambda p: X.Tokenizer(inputCol="text", outputCol="out"), None, {"vocabulary": 1000, "length": 20}),
    "vector_assembler": Stage(_slices, lambda p: X.VectorAssembler(inputCols=[f"part{i}" for i in range(p["pieces"])], outputCol="out"), None, {"features": 12, "pieces": 4}),
    "vector_slicer": Stage(_continuous, lambda p: X.VectorSlicer(inputCol="features", outputCol="out", indices=list(range(0, p["features"], 2))), None, {"features": 12}),
    "word2vec": Stage(_words, lambda p: X.Word2Vec(vectorSize=p["size"], seed=SEED, inputCol="words", outputCol="out", minCount=0, numPartitions=1 + p.get("rows", 0) // ROWS_A_TASK), None, {"vocabulary": 100, "length": 10, "size": 8}),
    "fpgrowth": Stage(lambda ids, seed, p: S.item_sets(ids, p["items"], p["size"], seed), lambda p: FPGrowth(itemsCol="items"), None, {"items": 30, "size": 4}),
    "als": Stage(lambda ids, seed, p: S.ratings(ids, p["users"], p["items"], False, seed), lambda p: ALS(seed=SEED, regParam=p["reg"], rank=p["rank"], maxIter=p["iterations"], numUserBlocks=p["blocks"], numItemBlocks=p["blocks"], coldStartStrategy="drop"),
                 lambda: RegressionEvaluator(metricName="rmse", labelCol="rating"), {"users": 200, "items": 100, "reg": 0.1, "rank": 5, "iterations": 3, "blocks": 4}, S.ratings_split),
    "tree_reg": Stage(_tree(False), lambda p: G.DecisionTreeRegressor(maxDepth=p["depth"], seed=SEED), _rmse, {"features": 12, "depth": 3}),
    "gbt_reg": Stage(_tree(False), lambda p: G.GBTRegressor(maxDepth=p["depth"], maxIter=p["iterations"], seed=SEED), _rmse, {"features": 12, "depth": 2, "iterations": 5}),
    "rf_reg": Stage(_tree(False), lambda p: G.RandomForestRegressor(maxDepth=p["depth"], numTrees=p["iterations"], seed=SEED), _rmse, {"features": 12, "depth": 4, "iterations": 10}),
    "glm": Stage(_glm, lambda p: G.GeneralizedLinearRegression(link=p["link"], family=p["family"], regParam=p["reg"], maxIter=p["iterations"], tol=p["tol"]), _rmse, {"features": 10, "link": "log", "family": "gaussian", "reg": 0.0, "iterations": 10, "tol": 1e-6}),
    "linreg": Stage(_linear(False), lambda p: G.LinearRegression(solver="l-bfgs", regParam=p["reg"], maxIter=p["iterations"], tol=p["tol"]), _rmse, {"features": 10, "reg": 0.0, "iterations": 20, "tol": 1e-6}),
}


def evaluate(model: Transformer, rows: DataFrame, evaluator: Evaluator) -> tuple[float, bool]:
    """The metric of a model on some rows, and whether larger is better."""
    return evaluator.evaluate(model.transform(rows)), evaluator.isLargerBetter()


def stage_data(name: str, train_ids: DataFrame, test_ids: DataFrame, **changes) -> tuple[DataFrame, DataFrame, dict]:
    """Training rows, and test rows by the same generator with the next seed."""
    stage = STAGES[name]
    p = {**stage.params, **changes}
    train, test = stage.data(train_ids, SEED, p), stage.data(test_ids, SEED + 1, p)
    if stage.pair:
        train, test = stage.pair(train, test)
    return train, test, p


def without_summary(spark: SparkSession, model: Transformer) -> Transformer:
    """The model; one of two classes with a summary is written and read again, which leaves the summary behind.

    Such a summary holds the session, so that the session travels to the tasks with the model. It can't once a frame in it has been observed.
    """
    if not (isinstance(model, C.ClassificationModel) and isinstance(model, HasTrainingSummary) and model.hasSummary and model.numClasses <= 2):
        return model
    folder = scratch(spark, "model")
    model.write().session(spark).save(folder)
    return type(model).read().session(spark).load(folder)


def fitted(name: str, train: DataFrame, p: dict) -> Transformer:
    stage = STAGES[name].stage(p)
    return without_summary(train.sparkSession, stage.fit(train)) if isinstance(stage, Estimator) else stage


def run_stage(name: str, train_ids: DataFrame, test_ids: DataFrame, **changes) -> tuple[Transformer, list[tuple[str, float, bool]]]:
    """Fit on cached training rows and score both sets; returns the model and (metric, value, larger is better) rows.

    The cached rows may spill to disk and are given back at the end. Iterative estimators read them many times.
    """
    train, test, p = stage_data(name, train_ids, test_ids, **changes)
    train, test = train.persist(StorageLevel.MEMORY_AND_DISK), test.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = [("train.rows", float(train.count()), True), ("test.rows", float(test.count()), True)]
        model = fitted(name, train, {**p, "rows": int(rows[0][1])})
        if STAGES[name].score:
            evaluator = STAGES[name].score()
            for which, df in (("train", train), ("test", test)):
                value, larger = evaluate(model, df, evaluator)
                rows.append((f"{which}.score", value, larger))
        elif hasattr(model, "transform"):
            columns = [c for c in model.transform(test).columns if c not in test.columns]
            hashed = model.transform(test).select(F.crc32(F.to_json(F.struct(*columns))).alias("h"))
            found = hashed.agg(F.count("*"), F.count_distinct("h"), F.sum(F.col("h").cast("decimal(20,0)") % 10007)).first()
            rows += [("test.transformed", float(found[0]), True), ("test.distinct", float(found[1]), True), ("test.content", float(found[2] or 0), True)]
        return model, rows
    finally:
        train.unpersist()
        test.unpersist()


def synonyms(model, train_words: DataFrame, count: int) -> DataFrame:
    """Words nearest to a vector of the model: the extra method of the word-embedding stage."""
    anchor = model.getVectors().orderBy("word").first()["vector"]
    return model.findSynonyms(anchor, count)


def rules(model) -> DataFrame:
    """Association rules of the item-set stage."""
    return model.associationRules
