import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyframe.operators import generators as S
from tallyframe.operators import learning as M


def test_rows_do_not_depend_on_partitions(spark):
    one, many = S.continuous(spark.range(0, 200, 1, 1), 4), S.continuous(spark.range(0, 200, 1, 7), 4)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    low, high, mean = S.continuous(spark.range(5000), 1).select(vector_to_array("features")[0].alias("v")).agg(F.min("v"), F.max("v"), F.avg("v")).first()
    assert -1 <= low < -0.99 and 0.99 < high < 1 and abs(mean) < 0.05


def test_mixed(spark):
    rows = S.mixed(spark.range(2000), [3, 0, 2]).select(vector_to_array("features").alias("v")).collect()
    assert {r.v[0] for r in rows} == {0.0, 1.0, 2.0} and {r.v[2] for r in rows} == {0.0, 1.0} and len({r.v[1] for r in rows}) > 1900
    with pytest.raises(ValueError):
        S.mixed(spark.range(1), [-1])
    assert S.tree_arity(10) == [2, 2, 20, 20, 0, 0, 0, 0, 0, 0]


def test_integer_tables(spark):
    groups = S.group_ints(spark.range(300), 100).groupBy("a").agg(F.count("*").alias("n"), F.min("b"), F.max("b")).orderBy("a").collect()
    assert [tuple(r) for r in groups] == [(1, 100, 1, 100), (2, 100, 1, 100), (3, 100, 1, 100)]
    assert S.two_groups(spark.range(10)).where("a = 0").count() == 5 and S.ints(spark, 7, 2).count() == 7


def test_ratings(spark):
    train, test = S.ratings(spark.range(2000), 40, 30, seed=1), S.ratings(spark.range(300), 60, 40, seed=2)
    assert train.count() == train.select("user", "item").distinct().count()
    kept, final = S.ratings_split(train, test)
    assert kept.join(test, ["user", "item"]).count() == 0
    assert final.join(kept.select("user").distinct(), "user", "left_anti").count() == 0
    assert 0 < final.count() < test.count()
    assert {r.rating for r in S.ratings(spark.range(100), 9, 9, True).collect()} == {0.0, 1.0}


def test_documents_and_item_sets(spark):
    texts = [r.text for r in S.docs(spark.range(2000), 50, 6).collect()]
    lengths = [len(t.split()) for t in texts]
    assert all(t.startswith(" ") for t in texts) and min(lengths) >= 1 and abs(np.mean(lengths) - 6) < 0.3
    for row in S.item_sets(spark.range(200), 12, 3).collect():
        items = [int(v) for v in row["items"]]
        assert len(items) == len(set(items)) and (items[0] + 6) % 12 in items and (items[0] + items[1]) % 12 in items
    words = S.bag_of_words(spark.range(50), 20, 15).collect()
    assert all(sum(r.features.values) == 15 for r in words)


def test_poisson_table():
    first, steps = S._poisson_steps(4.0, 1, 100)
    share = lambda k: math.exp(-4) * 4**k / math.factorial(k) / (1 - math.exp(-4))
    assert first == 1 and abs(steps[0] - share(1)) < 1e-12 and abs(steps[2] - steps[1] - share(3)) < 1e-12


def test_planted_tree_three_ways(spark):
    arity = S.tree_arity(12)
    tree = S.random_tree(arity, 3, classes=3)
    rows = S.mixed(spark.range(500), arity)
    by_case = {r.id: r.label for r in S.planted_tree(rows, tree).collect()}
    by_batch = {r.id: r.label for r in S.planted_tree(rows, tree, deepest=0).collect()}
    assert by_case == by_batch and len(set(by_case.values())) > 1

    def check(node, used):
        if isinstance(node, dict):
            assert node["feature"] not in used
            check(node["left"], used | {node["feature"]}), check(node["right"], used | {node["feature"]})
            if not isinstance(node["left"], dict) and not isinstance(node["right"], dict):
                assert node["left"] != node["right"]

    check(tree, set())


def test_naive_bayes_truth_needs_features():
    with pytest.raises(ValueError):
        S.naive_bayes_truth(5, 4)


@pytest.mark.parametrize("name,check", [("linreg", lambda s: s < 0.01), ("logreg", lambda s: s > 0.95), ("tree_class", lambda s: s > 0.7), ("tree_reg", lambda s: s < 0.25)])
def test_stages_recover_the_planted_model(spark, name, check):
    _, rows = M.run_stage(name, spark.range(3000), spark.range(500))
    scores = {metric: value for metric, value, _ in rows}
    assert check(scores["train.score"]) and check(scores["test.score"]) and scores["test.score"] != scores["train.score"]


@pytest.mark.parametrize("name,changes", [("logreg", {}), ("svc", {}), ("rf_class", {"classes": 2})])
def test_two_classes_are_scored_in_a_session_with_an_observed_frame(spark, name, changes):
    plain, rows = M.run_stage(name, spark.range(300), spark.range(50), **changes)
    session = spark.newSession()
    seen = Observation()
    session.range(3).observe(seen, F.count("*").alias("rows")).collect()
    assert seen.get == {"rows": 3}
    model, found = M.run_stage(name, session.range(300), session.range(50), **changes)
    assert found == rows and model.uid != plain.uid
    assert {k.name: v for k, v in model.extractParamMap().items()} == {k.name: v for k, v in plain.extractParamMap().items()}


def test_extra_methods(spark):
    model, _ = M.run_stage("word2vec", spark.range(300), spark.range(50), vocabulary=20)
    assert M.synonyms(model, None, 3).count() == 3
    model, _ = M.run_stage("fpgrowth", spark.range(300), spark.range(50), items=10)
    assert M.rules(model).count() > 0
    _, rows = M.run_stage("lda", spark.range(200), spark.range(20), optimizer="em", iterations=2)
    assert dict((m, v) for m, v, _ in rows)["train.rows"] == 200
