"""Generators over table keys, and the learning stages on them."""

from __future__ import annotations

import functools

from pyspark.ml import feature as X
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators import generators as S
from tallyframe.operators import learning as M
from tallyframe.plans.registry import Book

BOOK = Book()


def _train(t):
    return S.ints(t.orders, "o_orderkey")


def _test(t):
    return S.ints(t.customer, "c_custkey")


def _add(key, build, out, sql=None, **rest):
    BOOK.add(key, build, out, sql, suite="given", **rest)


# --- generators: summaries of rows made from order keys -------------------------------------------

_add("gen.ints", lambda t, p: S.ints(t.orders, "o_orderkey"), "id:l", "SELECT o_orderkey AS id FROM orders")
_add("gen.group_ints", lambda t, p: S.group_ints(S.ints(t.orders, "o_orderkey"), p.per_group), "a:l b:l",
     "SELECT o_orderkey // {per_group} + 1 AS a, o_orderkey % {per_group} + 1 AS b FROM orders", params={"per_group": 1000})
_add("gen.two_groups", lambda t, p: S.two_groups(S.ints(t.orders, "o_orderkey")), "a:l b:l", "SELECT o_orderkey % 2 AS a, o_orderkey AS b FROM orders")


def _spread(df, column="features"):
    """Row count, lowest, highest and mean entry per vector position."""
    entries = df.select(F.posexplode(vector_to_array(column)).alias("position", "value"))
    return entries.groupBy("position").agg(F.count("*").alias("rows"), F.min("value").alias("lowest"), F.max("value").alias("highest"), F.avg("value").alias("average"))


_SPREAD = "position:i rows:l lowest:d6 highest:d6 average:d6"
_add("gen.continuous", lambda t, p: _spread(S.continuous(_train(t), 10)), _SPREAD)
_add("gen.mixed", lambda t, p: _spread(S.mixed(_train(t), S.tree_arity(12))), _SPREAD)
_add("gen.gaussian_mixture", lambda t, p: _spread(S.gaussian_mixture(_train(t), 4, 5)), _SPREAD)
_add("gen.ratings", lambda t, p: S.ratings(_train(t), 200, 100).agg(F.count("*").alias("rows"), F.count_distinct("user").alias("users"), F.max("rating").alias("highest")), "rows:l users:l highest:d4")


def _split(t, p):
    train, test = S.ratings_split(S.ratings(_train(t), 200, 100, seed=1), S.ratings(_test(t), 300, 120, seed=2))
    return train.select(F.lit("train").alias("part"), "user", "item", "rating").unionByName(test.select(F.lit("test").alias("part"), "user", "item", "rating")).groupBy("part").agg(F.count("*").alias("rows"))


_add("gen.ratings_split", _split, "part:s rows:l")
_add("gen.rand_string", lambda t, p: S.rand_string(_train(t), 20).groupBy("text").agg(F.count("*").alias("rows")), "text:s rows:l")
_add("gen.docs", lambda t, p: S.docs(_train(t), 100, 20).agg(F.count("*").alias("rows"), F.min(F.length("text")).alias("shortest"), F.max(F.length("text")).alias("longest")), "rows:l shortest:i longest:i")
_add("gen.item_sets", lambda t, p: S.item_sets(_train(t), 30, 4).groupBy(F.size("items").alias("size")).agg(F.count("*").alias("rows")), "size:i rows:l")
_add("gen.bag_of_words", lambda t, p: S.bag_of_words(_train(t), 50, 20).agg(F.count("*").alias("rows"), F.sum(F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, b: a + b)).alias("words")), "rows:l words:d")


def _planted(name):
    def build(t, p):
        train, _, _ = M.stage_data(name, _train(t), _test(t))
        return train.agg(F.count("*").alias("rows"), F.count_distinct("label").alias("labels"), F.min("label").alias("lowest"), F.max("label").alias("highest"))

    return build


for _key, _stage in (("planted_linear", "linreg"), ("planted_logistic", "logreg"), ("planted_glm", "glm"), ("planted_tree_class", "tree_class"), ("planted_tree_reg", "tree_reg"), ("planted_nb", "nb")):
    _add(f"gen.{_key}", _planted(_stage), "rows:l labels:l lowest:d6 highest:d6")


def _attributes(t, p):
    """What the metadata of planted features and labels declares, and whether the rows keep to it."""
    parts = []
    for name in ("tree_class", "gbt_class", "tree_reg", "nb"):
        train, _, _ = M.stage_data(name, _train(t), _test(t))
        parts.append(S.attribute_report(train, ["features", "label"]).select(F.lit(name).alias("stage"), "*"))
    return functools.reduce(DataFrame.unionByName, parts)


def _attributes_sql():
    tree = [2] * 3 + [20] * 3 + [0] * 6
    declared = [(n, "features", i, a) for n in ("tree_class", "gbt_class", "tree_reg") for i, a in enumerate(tree)] + [("tree_class", "label", 0, 4), ("gbt_class", "label", 0, 2), ("tree_reg", "label", 0, 0)]
    declared += [("nb", "features", i, 2 + i * 17 // 9) for i in range(10)]
    values = ", ".join(f"('{n}', '{c}', {i}, '{'nominal' if a else 'numeric'}', {a})" for n, c, i, a in declared)
    return f"SELECT stage, \"column\", position, kind, arity, n AS rows, 0 AS misfits FROM (VALUES {values}) AS d(stage, \"column\", position, kind, arity), (SELECT count(*) AS n FROM orders)"


_add("gen.label_metadata", _attributes, "stage:s column:s position:i kind:s arity:i rows:l misfits:l", _attributes_sql())


def _test_rows(t, p):
    """Test rows come from the training generator with the next seed: the same shape, other values, and no row in both."""
    train, test, _ = M.stage_data("linreg", _train(t), _test(t))
    rows = [df.select(F.lit(n).alias("part"), F.crc32(vector_to_array("features").cast("string")).alias("h"), F.size(vector_to_array("features")).alias("width")) for n, df in (("train", train), ("test", test))]
    both = rows[0].unionByName(rows[1])
    shared = both.groupBy("h").agg(F.count_distinct("part").alias("parts")).where("parts > 1")
    return both.join(shared, "h", "left").groupBy("part").agg(F.count("*").alias("rows"), F.max("width").alias("features"), (F.count("parts") < F.count("*") / 100).alias("other_values"))


_add("gen.test_from_train", _test_rows, "part:s rows:l features:i other_values:b", "SELECT 'train' AS part, count(*) AS rows, 10 AS features, true AS other_values FROM orders UNION ALL SELECT 'test', count(*), 10, true FROM customer")

# --- stages ---------------------------------------------------------------------------------------


def _stage_report(name):
    def build(t, p):
        _, rows = M.run_stage(name, _train(t), _test(t))
        return t.spark.createDataFrame([(name, *r) for r in rows], "stage string, metricName string, metricValue double, isLargerBetter boolean")

    return build


for _name in M.STAGES:
    _add(f"ml.{_name}", _stage_report(_name), "stage:s metricName:s metricValue:d4 isLargerBetter:b")

_add("ml.lda_em", lambda t, p: t.spark.createDataFrame([("lda", *r) for r in M.run_stage("lda", _train(t), _test(t), optimizer="em")[1]], "stage string, metricName string, metricValue double, isLargerBetter boolean"),
     "stage:s metricName:s metricValue:d4 isLargerBetter:b")


def _scored(t, p):
    """The score of a model that is given: is a supplier above a balance? F1 by the evaluator, from the same counts in SQL."""
    rows = t.supplier.select((F.col("s_acctbal") > p.least).cast("double").alias("prediction"), (F.col("s_suppkey") % 2).cast("double").alias("label"))
    value, larger = M.evaluate(X.SQLTransformer(statement="SELECT * FROM __THIS__"), rows, M._multiclass())
    return t.spark.createDataFrame([("f1", value, larger)], "metricName string, metricValue double, isLargerBetter boolean")


_add("ml.score_evaluator", _scored, "metricName:s metricValue:d6 isLargerBetter:b", """
WITH rows AS (SELECT (s_acctbal > {least})::INT AS p, s_suppkey % 2 AS l FROM supplier),
classes AS (SELECT c, count(*) FILTER (WHERE l = c) AS actual, count(*) FILTER (WHERE p = c) AS said, count(*) FILTER (WHERE p = c AND l = c) AS hit, count(*) AS n FROM rows, (VALUES (0), (1)) AS v(c) GROUP BY c)
SELECT 'f1' AS metricName, sum(actual::DOUBLE / n * CASE WHEN hit = 0 THEN 0 ELSE 2.0 * hit / (actual + said) END) AS metricValue, true AS isLargerBetter FROM classes""", params={"least": 4000})

# Stages whose answer plain SQL can give, on the given tables.
_add("ml.tokenizer_words", lambda t, p: X.Tokenizer(inputCol="text", outputCol="words").transform(t.documents).select("doc_id", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("uses")), "word:s uses:l",
     "SELECT word, count(*) AS uses FROM (SELECT unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\x0b\\f\\r]')) AS word FROM documents) GROUP BY word")


def _indexed(t, p):
    model = X.StringIndexer(inputCol="p_brand", outputCol="place", handleInvalid="skip").fit(t.part)
    return model.transform(t.part)


_add("ml.string_index_brands", _indexed, "p_partkey:l place:d", "WITH places AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS place FROM part GROUP BY 1) SELECT p_partkey, place FROM part JOIN places USING (p_brand)")
_EDGES = [50000.0, 150000.0, 300000.0, 450000.0]
_add("ml.bucketizer_prices", lambda t, p: X.Bucketizer(splits=[-float("inf"), *_EDGES, float("inf")], inputCol="o_totalprice", outputCol="bucket").transform(t.orders), "o_orderkey:l bucket:d",
     "SELECT o_orderkey, (SELECT count(*) FROM unnest([{edges}]) AS u(e) WHERE o_totalprice >= e) AS bucket FROM orders", params={"edges": _EDGES})
_add("ml.one_hot_region", lambda t, p: X.OneHotEncoder(inputCols=["n_regionkey"], outputCols=["hot"], dropLast=False).fit(t.nation).transform(t.nation).select("n_nationkey", F.array_join(F.transform(vector_to_array("hot"), lambda v: v.cast("int").cast("string")), "").alias("hot")),
     "n_nationkey:i hot:s", "SELECT n_nationkey, repeat('0', n_regionkey) || '1' || repeat('0', (SELECT max(n_regionkey) FROM nation) - n_regionkey) AS hot FROM nation")
_add("ml.vector_slicer_embedding", lambda t, p: X.VectorSlicer(inputCol="v", outputCol="even", indices=list(range(0, 64, 2))).transform(t.embeddings.select("vec_id", S.array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))).select("vec_id", F.explode(vector_to_array("even")).alias("value")),
     "vec_id:l value:d", "SELECT vec_id, unnest(embedding[1:64:2]) AS value FROM embeddings")


def _frequent(t, p):
    """Return flags and states that share orders: frequent item sets."""
    from pyspark.ml.fpm import FPGrowth
    baskets = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(F.concat("l_returnflag", "l_linestatus")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=p.support).fit(baskets)
    return model.freqItemsets.select(F.array_join(F.array_sort("items"), ",").alias("items"), "freq")


_add("ml.fpgrowth_flags", _frequent, "items:s freq:l", """
WITH baskets AS (SELECT l_orderkey AS o, list(DISTINCT l_returnflag || l_linestatus) AS has FROM lineitem GROUP BY 1), n AS (SELECT count(*) AS n FROM baskets),
kinds AS (SELECT list_sort(list(DISTINCT l_returnflag || l_linestatus)) AS k FROM lineitem), masks AS (SELECT k, unnest(range(1, (1 << len(k))::BIGINT)) AS m FROM kinds),
wanted AS (SELECT list_filter(k, lambda x, i: (m >> (i - 1)) & 1 = 1) AS items FROM masks),
sets AS (SELECT array_to_string(w.items, ',') AS items, count(*) AS freq FROM wanted w JOIN baskets ON list_has_all(has, w.items) GROUP BY 1)
SELECT items, freq FROM sets, n WHERE freq >= ceil({support} * n)""", params={"support": 0.3})
