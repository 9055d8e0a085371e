import zlib

from pyspark.sql import functions as F

from tallyframe.operators import checks as C
from tallyframe.operators import relational as R


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_not_in_with_nulls(spark):
    left = frame(spark, [(1,), (2,), (None,)], "a int")
    listed = frame(spark, [(2,), (3,)], "b int")
    assert values(R.not_in(left, "a", listed, "b")) == [(1,)]
    assert values(R.not_in(left, "a", frame(spark, [(2,), (None,)], "b int"), "b")) == []
    assert values(R.not_in(left, "a", listed.where("b > 9"), "b")) == [(1,), (2,), (None,)]


def test_null_keys_match_nothing(spark):
    left, right = frame(spark, [(1,), (None,)], "a int"), frame(spark, [(1,), (None,)], "b int")
    assert values(R.semi_join(left, right, "a = b")) == [(1,)]
    assert values(R.anti_join(left, right, "a = b")) == [(None,)]
    assert values(R.exists_any(left, [right.where("b is null"), right], "a = b")) == [(1,)]
    assert R.overlap(left, right.withColumnRenamed("b", "a"), ["a"]).first().asDict() == {"left_only": 1, "right_only": 1, "both": 1}


def test_set_operations_treat_nulls_as_equal(spark):
    a, b = frame(spark, [(1,), (None,), (None,)], "a int"), frame(spark, [(None,), (2,)], "a int")
    assert values(R.in_all_sets([a, b])) == [(None,)]
    assert values(R.only_in_first([a, b])) == [(1,)]


def test_rollup_over_data_nulls(spark):
    df = frame(spark, [("x", None, 1), ("x", "p", 2), (None, "p", 4)], "g string, h string, v int")
    found = {(r.g, r.h, r.level): r.v for r in R.rollup_ranked(df, "g", "h", F.sum("v"), "v").collect()}
    assert found == {("x", None, 0): 1, ("x", "p", 0): 2, (None, "p", 0): 4, ("x", None, 1): 3, (None, None, 1): 4, (None, None, 2): 7}


def test_ties_are_kept_in_top_n(spark):
    df = frame(spark, [("a", 3), ("a", 3), ("a", 2), ("a", 1)], "g string, v int")
    assert values(R.top_n_per_group(df, ["g"], "v", 2).select("v")) == [(3,), (3,)]


def test_zero_divisors(spark):
    df = frame(spark, [("a", 0), ("a", 0)], "g string, v int")
    assert R.variation(df, ["g"], "v").first().cov is None
    assert R.share_of_group(df, ["g"], "g", "v").first().share is None
    assert R.deviating(df, ["v"], ["g"], "v", 0.1).count() == 0


def test_wide_decimal_sums(spark):
    df = spark.range(100).select(F.lit("99999999999999.99").cast("decimal(16,2)").alias("v"))
    assert str(df.agg(F.sum("v")).first()[0]) == "9999999999999999.00"


def test_content_hash(spark):
    df = frame(spark, [(1, "a"), (None, "b"), (3, None)], "x int, y string")
    assert C.content_hash(df).first()[0] == sum(zlib.crc32(t) for t in (b"1,a", b"b", b"3"))
    assert C.content_hash(df.orderBy(F.desc("x"))).first() == C.content_hash(df).first()
    assert C.content_hash(df.where("false")).first()[0] is None
    swapped = frame(spark, [(None, "a"), ("a", None)], "x string, y string")
    one, two = swapped.where("x is null"), swapped.where("y is null")
    assert C.content_hash(one).first() == C.content_hash(two).first()
    assert C.content_hash(one, True).first() != C.content_hash(two, True).first()


def test_consuming(spark):
    C.run_everywhere(spark.range(10))
    assert C.force_all_columns(spark.range(10)).first().rows == 10
