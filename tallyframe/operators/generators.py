"""Synthetic rows as column expressions over an ``id`` column.

Every random number is a hash of (id, position, seed): the rows depend neither on the number of partitions nor on a retried
task. ``ids`` may be ``spark.range(n)`` or the keys of any table.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ints(source: SparkSession | DataFrame, rows: int | str, partitions: int | None = None) -> DataFrame:
    """Whole numbers as ``id``: so many from 0 on, or those in a column of a table."""
    return source.select(F.col(rows).alias("id")) if isinstance(source, DataFrame) else source.range(0, rows, 1, partitions)


def group_ints(ids: DataFrame, per_group: int = 10000) -> DataFrame:
    """``a`` is the group (from 1), ``b`` counts from 1 inside it; ids count from 0."""
    return ids.select((F.expr(f"id div {per_group}") + 1).alias("a"), (F.col("id") % per_group + 1).alias("b"))


def two_groups(ids: DataFrame) -> DataFrame:
    return ids.select((F.col("id") % 2).alias("a"), F.col("id").alias("b"))


def uniform(seed: int, *position: Column | int, key: str = "id") -> Column:
    """Uniform in [0, 1): the upper 53 bits of a hash."""
    parts = [F.col(key), *[p if isinstance(p, Column) else F.lit(p) for p in position], F.lit(seed)]
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


def below(limit: int | Column, seed: int, *position: Column | int, key: str = "id") -> Column:
    """Uniform whole number in [0, limit)."""
    return F.floor(uniform(seed, *position, key=key) * limit)


def gaussian(seed: int, *position: Column | int) -> Column:
    """Standard normal by two uniforms; the first is kept off zero."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(seed, *position, 1)))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(seed, *position, 2))


def _positions(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def _literals(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def continuous(ids: DataFrame, features: int, seed: int = 42) -> DataFrame:
    """Uniform features in [-1, 1)."""
    return ids.select("id", array_to_vector(F.transform(_positions(features), lambda j: uniform(seed, j) * 2 - 1)).alias("features"))


def tree_arity(features: int) -> list[int]:
    """A quarter binary, a quarter with 20 categories, the rest continuous (0)."""
    quarter = features // 4
    return [2] * quarter + [20] * quarter + [0] * (features - 2 * quarter)


def mixed(ids: DataFrame, arity: list[int], seed: int = 42) -> DataFrame:
    """Per feature: arity 0 is uniform in [-1, 1), arity a > 0 a whole number in [0, a)."""
    if min(arity) < 0:
        raise ValueError("an arity must not be negative")
    value = lambda a, j: F.when(a == 0, uniform(seed, j) * 2 - 1).otherwise(below(a, seed, j))
    values = F.transform(_positions(len(arity)), lambda j: value(F.element_at(_literals(arity), j + 1), j).cast("double"))
    attributes = {"numeric": [{"idx": i} for i, a in enumerate(arity) if a == 0], "nominal": [{"idx": i, "vals": [str(v) for v in range(a)]} for i, a in enumerate(arity) if a > 0]}
    metadata = {"ml_attr": {"attrs": {k: v for k, v in attributes.items() if v}, "num_attrs": len(arity)}}
    return ids.select("id", array_to_vector(values).alias("features", metadata=metadata))


def attribute_table(df: DataFrame, column: str) -> list[tuple[str, int, str, int]]:
    """(column, position, kind, arity) of every attribute that a column's metadata declares; a nominal one has as many values as its arity, a numeric one 0."""
    declared = df.schema[column].metadata.get("ml_attr", {})
    if "attrs" not in declared:
        return [(column, 0, declared["type"], len(declared.get("vals", [])))] if declared else []
    return sorted((column, a["idx"], kind, len(a.get("vals", []))) for kind, those in declared["attrs"].items() for a in those)


def attribute_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, position, kind, arity, rows, misfits): what the columns' metadata declares, next to how many rows there are and how many values are not whole
    numbers below the arity. One pass over the rows."""
    declared = [a for c in columns for a in attribute_table(df, c)]

    def value(column, position):
        return vector_to_array(F.col(column))[position] if isinstance(df.schema[column].dataType, VectorUDT) else F.col(column)

    parts = []
    for column, position, kind, arity in declared:
        v = value(column, position)
        misfit = (v < 0) | (v >= arity) | (v != F.floor(v)) if arity else F.lit(False)
        parts.append(F.struct(F.lit(column).alias("column"), F.lit(position).alias("position"), F.lit(kind).alias("kind"), F.lit(arity).alias("arity"), F.count("*").alias("rows"), F.count(F.when(misfit, 1)).alias("misfits")))
    return df.agg(F.array(*parts).alias("attributes")).select(F.inline("attributes"))


def with_label_metadata(df: DataFrame, classes: int = 0) -> DataFrame:
    """Mark the label as nominal with so many classes, or as numeric for 0."""
    attribute = {"type": "nominal", "vals": [str(c) for c in range(classes)], "name": "label"} if classes else {"type": "numeric", "name": "label"}
    return df.withMetadata("label", {"ml_attr": attribute})


def gaussian_mixture(ids: DataFrame, centers: int, features: int, seed: int = 42) -> DataFrame:
    """Unit-variance clouds around random centers (each scaled by a whole number in [-10, 10)) with random weights."""
    rng = random.Random(seed)
    scales = [rng.randrange(20) - 10 for _ in range(centers)]
    weights = [rng.random() for _ in range(centers)]
    points = [[(2 * rng.random() - 1) * s for _ in range(features)] for s in scales]
    steps = list(itertools.accumulate(w / sum(weights) for w in weights))
    which = F.size(F.filter(_literals(steps[:-1]), lambda s: s < uniform(seed + 24, 0))) + 1
    table = F.array(*[_literals(p) for p in points])
    return ids.withColumn("center", which).select("id", (F.col("center") - 1).alias("center"), array_to_vector(F.transform(F.element_at(table, F.col("center")), lambda c, j: c + gaussian(seed, j))).alias("features"))


def ratings(ids: DataFrame, users: int, items: int, implicit: bool = False, seed: int = 42) -> DataFrame:
    """Distinct (user, item) pairs; ratings uniform in [0, 5), or 0/1."""
    u = uniform(seed, 3)
    rating = F.when(u < 0.5, 0.0).otherwise(1.0) if implicit else u * 5
    drawn = ids.select("id", below(users, seed, 1).cast("int").alias("user"), below(items, seed, 2).cast("int").alias("item"), rating.cast("float").alias("rating"))
    # The rating of the lowest id: which duplicate survives must not depend on the order of arrival.
    return drawn.groupBy("user", "item").agg(F.min_by("rating", "id").alias("rating"))


def ratings_split(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train without the pairs of test; test with the users and items that train still has.

    Where test has drawn every pair of train, nothing would be left to learn from: then test gives up four in five of its pairs, by a hash
    of the pair, and train keeps those.
    """
    pruned = train.join(test.select("user", "item"), ["user", "item"], "left_anti")
    if pruned.isEmpty():
        test = test.where(F.pmod(F.xxhash64("user", "item"), F.lit(5)) == 0)
        pruned = train.join(test.select("user", "item"), ["user", "item"], "left_anti")
    kept = test.join(pruned.select("user").distinct(), "user", "left_semi").join(pruned.select("item").distinct(), "item", "left_semi")
    return pruned, kept.select("user", "item", "rating")


def rand_string(ids: DataFrame, distinct: int, seed: int = 42, name: str = "text") -> DataFrame:
    return ids.select("id", below(distinct, seed, 0).cast("string").alias(name))


def _poisson_steps(mean: float, low: int, high: int) -> tuple[int, list[float]]:
    """Cumulative weights of a Poisson variable limited to [low, high]: what drawing again until it fits amounts to.

    Values whose weight is below 1e-15 of the largest add nothing to a double and end the table.
    """
    logs = {k: k * math.log(mean) - mean - math.lgamma(k + 1) for k in range(low, min(high, int(mean + 40 * math.sqrt(mean) + 40)) + 1)}
    top = max(logs.values())
    kept = {k: math.exp(v - top) for k, v in logs.items() if v - top > -34.5}
    total = sum(kept.values())
    return min(kept), list(itertools.accumulate(w / total for w in kept.values()))


def poisson(mean: float, low: int, high: int, u: Column) -> Column:
    """Poisson in [low, high] for each of an array of uniform numbers, by the inverse of its distribution: a search by halves in the table of its steps."""
    first, steps = _poisson_steps(mean, low, high)

    def place(a: int, b: int, drawn: Column) -> Column:
        if a == b:
            return F.lit(first + a)
        middle = (a + b) // 2
        return F.when(F.lit(steps[middle]) < drawn, place(middle + 1, b, drawn)).otherwise(place(a, middle, drawn))

    return F.transform(u, lambda drawn: place(0, len(steps) - 1, drawn))


def docs(ids: DataFrame, vocabulary: int, mean_length: int, seed: int = 42, longest: int = 65535) -> DataFrame:
    """Documents of word numbers with a leading space; Poisson lengths in (0, longest]."""
    length = poisson(mean_length, 1, longest, F.array(uniform(seed, -1)))[0]
    words = F.transform(F.sequence(F.lit(1), F.col("length")), lambda j: F.concat(F.lit(" "), below(vocabulary, seed, j).cast("string")))
    return ids.withColumn("length", length).select("id", F.array_join(words, "").alias("text"))


def item_sets(ids: DataFrame, items: int, mean_size: int, seed: int = 42) -> DataFrame:
    """Poisson-sized sets of Poisson items around items / 2, each set with two items that follow from its first ones."""
    size = poisson(mean_size, 1, items, F.array(uniform(seed, -1)))[0]

    def draws(last: Column) -> Column:
        return poisson(items / 2, 0, items - 1, F.transform(F.sequence(F.lit(0), last), lambda j: uniform(seed, j)))

    sets = ids.withColumn("size", size).withColumn("first", F.array_distinct(draws(F.col("size") * 2 + 4)))
    # Where the first draws are too few numbers, more are drawn; numbers never drawn stand behind the drawn ones, so that a set is full even when draws repeat.
    more = F.array_union(draws(F.col("size") * 6 + 20), _positions(items))
    sets = sets.withColumn("picked", F.slice(F.when(F.size("first") >= F.col("size"), F.col("first")).otherwise(more), 1, F.col("size")))
    sets = sets.withColumn("picked", F.array_union("picked", F.array((F.col("picked")[0] + items // 2) % items)))
    sets = sets.withColumn("picked", F.when(F.size("picked") >= 2, F.array_union("picked", F.array((F.col("picked")[0] + F.get("picked", F.lit(1))) % items))).otherwise(F.col("picked")))
    return sets.select("id", F.transform("picked", lambda v: v.cast("string")).alias("items"))


def bag_of_words(ids: DataFrame, vocabulary: int, length: int, seed: int = 42) -> DataFrame:
    """Sparse word counts of documents of a fixed length."""
    words = ids.select(F.col("id").alias("docIndex"), F.transform(_positions(length), lambda j: below(vocabulary, seed, j, key="id").cast("string")).alias("words"))
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(vocabulary)], "words", "features")
    return counter.transform(words).select("docIndex", "features")


# --- labels of a known model ----------------------------------------------------------------------


def linear_truth(features: int, seed: int = 42) -> tuple[list[float], float]:
    """Coefficients uniform in [-1, 1), a small intercept."""
    rng = random.Random(seed)
    return [2 * rng.random() - 1 for _ in range(features)], 0.01 * (2 * rng.random() - 1)


def dot(features: str, weights: list[float], intercept: float = 0.0) -> Column:
    products = F.zip_with(vector_to_array(features), _literals(weights), lambda x, w: x * w)
    return F.aggregate(products, F.lit(float(intercept)), lambda total, x: total + x)


def planted_linear(df: DataFrame, weights: list[float], intercept: float, classes: bool = False) -> DataFrame:
    """The linear prediction, or the class on its positive side (probability above one half)."""
    margin = dot("features", weights, intercept)
    return df.withColumn("label", (margin > 0).cast("double") if classes else margin)


# Inverse link functions.
INVERSE_LINKS = {"identity": lambda x: x, "log": F.exp, "inverse": lambda x: 1 / x, "logit": lambda x: 1 / (1 + F.exp(-x)), "sqrt": lambda x: x * x}


def planted_glm(df: DataFrame, weights: list[float], intercept: float, link: str) -> DataFrame:
    return df.withColumn("label", INVERSE_LINKS[link](dot("features", weights, intercept)))


def random_tree(arity: list[int], depth: int, classes: int = 0, seed: int = 42) -> dict:
    """A balanced tree: no feature twice on a path, thresholds in [0, 1), or a set of categories to the left.

    Leaves are class numbers (siblings differ) or values in [0, 1).
    """
    rng = random.Random(seed)

    def leaf():
        return float(rng.randrange(classes)) if classes else rng.random()

    def node(level, free):
        if level == 0 or not free:
            return leaf()
        feature = rng.choice(sorted(free))
        split = {"feature": feature}
        if arity[feature] == 0:
            split["threshold"] = rng.random()
        else:
            categories = list(range(arity[feature]))
            rng.shuffle(categories)
            split["left_categories"] = sorted(categories[:max(1, len(categories) // 2)])
        split["left"], split["right"] = node(level - 1, free - {feature}), node(level - 1, free - {feature})
        if classes > 1 and not isinstance(split["left"], dict) and not isinstance(split["right"], dict) and split["left"] == split["right"]:
            split["right"] = float((int(split["left"]) + 1 + rng.randrange(classes - 1)) % classes)
        return split

    return node(depth, frozenset(range(len(arity))))


def planted_tree(df: DataFrame, tree: dict, deepest: int = 8) -> DataFrame:
    """Label by a tree: nested CASE for shallow ones, array look-ups in Arrow batches for deep ones."""
    return df.withColumn("label", _case(tree, vector_to_array("features"))) if _depth(tree) <= deepest else _batched_tree(df, tree)


def _depth(tree) -> int:
    return 1 + max(_depth(tree["left"]), _depth(tree["right"])) if isinstance(tree, dict) else 0


def _case(tree, values: Column) -> Column:
    if not isinstance(tree, dict):
        return F.lit(float(tree))
    value = F.element_at(values, tree["feature"] + 1)
    goes_left = value <= tree["threshold"] if "threshold" in tree else value.isin([float(c) for c in tree["left_categories"]])
    return F.when(goes_left, _case(tree["left"], values)).otherwise(_case(tree["right"], values))


def tree_labels(tree: dict, rows: np.ndarray) -> np.ndarray:
    """Labels of feature rows; each node passes its rows on as index arrays."""
    labels = np.empty(len(rows))

    def walk(node, index):
        if not isinstance(node, dict):
            labels[index] = node
        elif len(index):
            value = rows[index, node["feature"]]
            left = value <= node["threshold"] if "threshold" in node else np.isin(value, node["left_categories"])
            walk(node["left"], index[left])
            walk(node["right"], index[~left])

    walk(tree, np.arange(len(rows)))
    return labels


def _batched_tree(df: DataFrame, tree: dict) -> DataFrame:
    flat = df.select("id", vector_to_array("features").alias("values"))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(label=tree_labels(tree, np.array(batch["values"].tolist()).reshape(len(batch), -1)))

    labelled = flat.mapInPandas(label, "id long, values array<double>, label double")
    metadata = df.schema["features"].metadata
    return labelled.select("id", array_to_vector("values").alias("features", metadata=metadata), "label")


def naive_bayes_truth(classes: int, features: int, seed: int = 42) -> tuple[list[float], list[list[float]]]:
    """Class log-priors, and per class feature log-weights with 0.7 of the mass on the feature of its own number."""
    if classes > features:
        raise ValueError("naive Bayes truth needs at least as many features as classes")
    rng = random.Random(seed)
    priors = [rng.random() + 0.01 for _ in range(classes)]
    rest = 0.3 / max(1, features - 1)
    return [math.log(p / sum(priors)) for p in priors], [[math.log(0.7 if i == c else rest) for i in range(features)] for c in range(classes)]


def planted_nb(df: DataFrame, priors: list[float], weights: list[list[float]]) -> DataFrame:
    """The class of the highest score; the lowest number wins a tie."""
    scores = F.array(*[dot("features", w, p) for p, w in zip(priors, weights)])
    return df.withColumn("scores", scores).withColumn("label", (F.array_position("scores", F.array_max("scores")) - 1).cast("double")).drop("scores")
