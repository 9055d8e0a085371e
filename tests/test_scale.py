"""Steps that must not grow faster than their input: their plans, and their results on rows made here."""

from types import SimpleNamespace

import pandas as pd
from pyspark.sql import functions as F

from tallyframe.functions import apply as A
from tallyframe.operators import generators as S
from tallyframe.operators import learning as M
from tallyframe.plans import micro
from tallyframe.sources import layout as L


def plan(df):
    return df._jdf.queryExecution().toString()


def test_payload_sides_are_not_broadcast(spark):
    tables = {"orders": spark.range(50).select(F.col("id").alias("o_orderkey"))}
    found = micro.join_payload(SimpleNamespace(table=tables.get), SimpleNamespace(sizes=[1, 8]))
    text = plan(found)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert {(r.size, r.rows, r.bytes) for r in found.collect()} == {(1, 50, 100), (8, 50, 800)}


def test_split_leaves_rows_to_learn_from(spark):
    train, test = S.ratings(spark.range(2000), 6, 5, seed=1), S.ratings(spark.range(2000), 6, 5, seed=2)
    assert train.count() == test.count() == 30
    kept, final = S.ratings_split(train, test)
    assert kept.count() > final.count() > 0 and kept.join(final, ["user", "item"]).count() == 0
    assert S.ratings_split(train.limit(0), test)[1].count() == 0


def test_poisson_places(spark):
    first, steps = S._poisson_steps(3.0, 1, 12)
    drawn = [0.0, 0.5, 1 - 2**-53, *steps, *(s + 1e-12 for s in steps[:-1])]
    found = spark.createDataFrame([(drawn,)], "u array<double>").select(S.poisson(3.0, 1, 12, F.col("u"))).first()[0]
    assert found == [first + sum(s < u for s in steps[:-1]) for u in drawn]


def test_item_sets_of_many_draws(spark):
    """First draws are enough for most sets, not for all; both ways give what all draws give."""
    rows, items, mean_size, seed = spark.range(300), 5, 4, 42
    size = S.poisson(mean_size, 1, items, F.array(S.uniform(seed, -1)))[0]
    everything = S.poisson(items / 2, 0, items - 1, F.transform(F.sequence(F.lit(0), F.col("size") * 6 + 20), lambda j: S.uniform(seed, j)))
    first = rows.withColumn("size", size).select("id", "size", everything.alias("draws")).collect()
    wanted = {r.id: [str(v) for v in list(dict.fromkeys([*r.draws, *range(items)]))[:r.size]] for r in first}
    found = {r.id: r["items"] for r in S.item_sets(rows, items, mean_size).collect()}
    assert all(found[i][:len(w)] == w for i, w in wanted.items())
    assert 0 < sum(len(set(r.draws[:r.size * 2 + 5])) < r.size for r in first) < 300


def test_word_vectors_train_in_more_tasks_with_more_rows(spark, monkeypatch):
    made, stage = [], M.STAGES["word2vec"]
    spied = lambda p: made.append(stage.stage(p)) or made[-1]
    monkeypatch.setitem(M.STAGES, "word2vec", M.Stage(stage.data, spied, stage.score, stage.params))
    M.run_stage("word2vec", spark.range(300), spark.range(20), vocabulary=20)
    monkeypatch.setattr(M, "ROWS_A_TASK", 100)
    _, rows = M.run_stage("word2vec", spark.range(300), spark.range(20), vocabulary=20)
    assert [e.getNumPartitions() for e in made] == [1, 4] and dict((m, v) for m, v, _ in rows)["test.transformed"] == 20


def test_merging_grows_with_the_rows():
    """What a task holds is folded a number of times that does not grow with its batches."""
    merged = []

    def merge(rows, last):
        merged.append(len(rows))
        return rows.groupby("key", as_index=False).agg(n=("n", "sum"))

    frames = []

    class Frame:
        def mapInPandas(self, function, schema):
            frames.append(function)
            return self

        def repartition(self, *keys):
            return self

        sortWithinPartitions = repartition

    A.group_apply_merged(Frame(), ["key"], lambda rows: rows, "key long, n long", merge, "key long, n long")
    batches = [pd.DataFrame({"key": [(i * 1000 + j) % 30_000 for j in range(1000)], "n": 1}) for i in range(300)]
    out = pd.concat(list(frames[0](iter(batches))))
    assert out.n.sum() == 300_000 and len(out) == 30_000 and sum(merged) <= 4 * 300_000


def test_runs_of_a_folder_become_one_file(spark, tmp_path):
    runs = spark.range(0, 400, 1, 8).select((F.col("id") % 5).alias("timestamp"), F.col("id").cast("int").alias("iteration"))
    L.write_runs(runs, f"{tmp_path}/runs")
    assert sum(1 for _ in tmp_path.glob("runs/timestamp=*/*.json")) == 5
    assert L.read_runs(spark, f"{tmp_path}/runs").agg(F.sum("iteration")).first()[0] == sum(range(400))
