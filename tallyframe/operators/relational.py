"""Relational building blocks behind the reports, usable on any DataFrame.

Each takes and gives DataFrames; nothing here fixes a join strategy. Broadcasts are left to Spark, which decides by size.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.functions.verbs import one_row
from tallyframe.operators.ordering import cumulated, ranked


def star_join(fact: DataFrame, dimensions: list[tuple[DataFrame, str]], keys: list[str], measures: list[Column]) -> DataFrame:
    """Fact joined to filtered dimensions on SQL conditions, then aggregated."""
    joined = functools.reduce(lambda df, d: df.join(d[0], F.expr(d[1])), dimensions, fact)
    return joined.groupBy(*keys).agg(*measures)


def semi_join(left: DataFrame, right: DataFrame, condition: str) -> DataFrame:
    return left.join(right, F.expr(condition), "left_semi")


def anti_join(left: DataFrame, right: DataFrame, condition: str) -> DataFrame:
    return left.join(right, F.expr(condition), "left_anti")


def exists_any(left: DataFrame, rights: list[DataFrame], condition: str) -> DataFrame:
    """EXISTS (a) OR EXISTS (b): a semi-join with the union; the rights share their column names."""
    return semi_join(left, functools.reduce(DataFrame.unionByName, rights), condition)


def not_in(left: DataFrame, column: str, right: DataFrame, right_column: str) -> DataFrame:
    """SQL NOT IN: nothing passes once the list holds a NULL; a NULL passes only an empty list.

    A plain anti-join on the keys plus a one-row summary of the list (is it empty, has it a NULL) instead of a
    null-aware join, so that the list may be of any size.
    """
    listed = right.select(F.col(right_column).alias("listed"))
    summary = listed.agg(F.count("*").alias("listed_rows"), F.count("listed").alias("listed_values"))
    kept = one_row(left.join(listed.where("listed is not null"), F.col(column) == F.col("listed"), "left_anti"), summary)
    test = (F.col("listed_rows") == 0) | ((F.col("listed_rows") == F.col("listed_values")) & F.col(column).isNotNull())
    return kept.where(test).select(*left.columns)


def versus_group(df: DataFrame, key: str, value: Column, name: str, test: str) -> DataFrame:
    """Rows compared with an aggregate of their own group (a correlated scalar subquery)."""
    groups = df.groupBy(F.col(key).alias("group_key")).agg(value.alias(name))
    return df.join(groups, F.col(key) == F.col("group_key")).where(test).drop("group_key")


def versus_all(df: DataFrame, value: Column, name: str, test: str) -> DataFrame:
    """Rows compared with a global aggregate (an uncorrelated scalar subquery)."""
    return one_row(df, df.agg(value.alias(name))).where(test)


def rollup_ranked(df: DataFrame, parent: str, child: str, measure: Column, name: str) -> DataFrame:
    """Two-level rollup with grouping level and rank inside the parent level (highest first)."""
    levels = df.rollup(parent, child).agg(measure.alias(name), (F.grouping(parent) + F.grouping(child)).alias("level"), F.grouping(child).alias("is_total"))
    levels = levels.withColumn("ranked_in", F.when(F.col("is_total") == 0, F.col(parent)))
    return ranked(levels, ["level", "ranked_in"], name, "place", descending=True).drop("is_total", "ranked_in")


def share_of_group(df: DataFrame, keys: list[str], group: str, value: str) -> DataFrame:
    """Sum per key and its percentage of the group; group sums are joined back, not windowed."""
    items = df.groupBy(*dict.fromkeys([*keys, group])).agg(F.sum(value).alias("amount"))
    groups = items.groupBy(F.col(group).alias("of_group")).agg(F.sum("amount").alias("group_amount"))
    share = F.try_divide(F.col("amount").cast("double") * 100, F.col("group_amount").cast("double"))
    return items.join(groups, F.col(group).eqNullSafe(F.col("of_group"))).withColumn("share", share).drop("of_group", "group_amount")


def running(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Running sum and running maximum, rows frame; a key may hold any share of the rows."""
    return cumulated(df, keys, [F.asc_nulls_first(order)], sums={"running_sum": value}, maxima={"running_max": value})


def top_n_per_group(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """rank <= n, ties kept; the filter next to the rank lets Spark drop rows before the shuffle."""
    return df.withColumn("place", F.rank().over(W.partitionBy(*keys).orderBy(F.desc(value)))).where(F.col("place") <= n)


def pivot_sums(df: DataFrame, keys: list[str], column: str, value: str, names: dict[object, str]) -> DataFrame:
    """One conditional sum per listed value of a column."""
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(column) == v, F.col(value))).alias(n) for v, n in names.items()])


def latency_buckets(df: DataFrame, keys: list[str], delay: str, edges: list[int]) -> DataFrame:
    """Row counts per delay band; the last band is open."""
    bands = [f"{delay} <= {edges[0]}"] + [f"{delay} > {a} and {delay} <= {b}" for a, b in zip(edges, edges[1:])] + [f"{delay} > {edges[-1]}"]
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.expr(b), 1).otherwise(0)).alias(f"band_{i}") for i, b in enumerate(bands)])


def tagged_union(frames: dict[str, DataFrame], tag: str = "channel") -> DataFrame:
    """UNION ALL with the source's name in a column."""
    return functools.reduce(DataFrame.unionByName, [df.select(F.lit(name).alias(tag), "*") for name, df in frames.items()])


def year_over_year(df: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """Every yearly sum next to the sum of the year before."""
    years = df.groupBy(*keys, year).agg(F.sum(value).alias("amount"))
    before = years.select(*[F.col(k).alias(f"before_{k}") for k in keys], (F.col(year) + 1).alias("next_year"), F.col("amount").alias("amount_before"))
    same = functools.reduce(lambda a, b: a & b, [F.col(k) == F.col(f"before_{k}") for k in keys], F.col(year) == F.col("next_year"))
    return years.join(before, same).select(*keys, year, "amount", "amount_before")


def in_all_sets(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.intersect, frames)


def only_in_first(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.subtract, frames)


def overlap(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """How many distinct keys are on the left only, on the right only, on both sides. NULL keys match nothing."""
    a = left.select(*keys).distinct().withColumn("on_left", F.lit(True))
    b = right.select(*keys).distinct().withColumn("on_right", F.lit(True))
    both = a.join(b, keys, "full")
    def count(test):
        return F.sum(F.when(F.expr(test), 1).otherwise(0))

    return both.agg(count("on_left and on_right is null").alias("left_only"), count("on_right and on_left is null").alias("right_only"), count("on_left and on_right").alias("both"))


def variation(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean, deviation and their ratio; NULL where the mean is zero."""
    stats = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(F.col(value).cast("double")).alias("mean"), F.stddev_samp(value).alias("deviation"))
    return stats.withColumn("cov", F.try_divide("deviation", "mean"))


def deviating(df: DataFrame, keys: list[str], group: list[str], value: str, threshold: float) -> DataFrame:
    """Sums per key that differ from their group's average by more than a share of it."""
    sums = df.groupBy(*dict.fromkeys([*group, *keys])).agg(F.sum(value).alias("amount"))
    averages = sums.groupBy(*[F.col(g).alias(f"of_{g}") for g in group]).agg(F.try_divide(F.sum("amount").cast("double"), F.count("amount")).alias("usual"))
    same = functools.reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"of_{g}")) for g in group])
    return sums.join(averages, same).select(*sums.columns, "usual").where(F.abs(F.try_divide(F.col("amount").cast("double") - F.col("usual"), F.col("usual"))) > threshold)


def one_row_board(df: DataFrame, cells: dict[str, tuple[str, Column]]) -> DataFrame:
    """Several filtered aggregates side by side in one scan; each cell is (filter, aggregate over ``when(filter, ...)``)."""
    return df.agg(*[value.alias(name) for name, (_, value) in cells.items()])


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, non-NULL, distinct, lowest and highest per column, one row each.

    All columns become (column, value) rows of one shuffle; values of equal text are counted once per partition first.
    """
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p")).select("p.*")
    values = pairs.groupBy("column", "value").agg(F.count("*").alias("n"))
    return values.groupBy("column").agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("filled"),
                                        F.count("value").alias("distinct_values"), F.max(F.length("value")).alias("longest"))


def null_key_audit(frames: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Rows with a NULL in each listed key, per table."""
    parts = [df.select(F.lit(name).alias("table"), F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).isNull().alias("gap")) for k in keys])).alias("g")) for name, (df, keys) in frames.items()]
    return functools.reduce(DataFrame.unionByName, parts).groupBy("table", F.col("g.key").alias("key")).agg(F.sum(F.col("g.gap").cast("int")).alias("gaps"))


def segments(df: DataFrame, value: str, width: float) -> DataFrame:
    """Histogram by whole multiples of a width."""
    return df.select((F.col(value) / width).cast("int").alias("segment")).groupBy("segment").agg(F.count("*").alias("rows")).withColumn("base", F.col("segment") * width)
