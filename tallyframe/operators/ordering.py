"""Ranks and running totals without gathering a key in one task: prefix sums over bands.

Rows are dealt by ranges of (keys, order), so that every task holds about as many rows whatever the keys' shares; a range is a band. Totals of
the bands, one row for each key in it, become offsets, and inside a band a window does the rest. The banded rows are a written table:
the ranges come from a sample, and both steps have to see the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.sources.stored import written

BAND = "band_of_rows"


def banded(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The rows with the number of their band; bands follow keys and order."""
    return written(df.repartitionByRange(*[F.asc_nulls_first(k) for k in keys], *order).withColumn(BAND, F.spark_partition_id()), "bands")


def _same(keys: list[str]) -> Column:
    test = F.col(f"r.{BAND}") == F.col(f"o.{BAND}")
    for k in keys:
        test &= F.col(f"r.`{k}`").eqNullSafe(F.col(f"o.`{k}`"))
    return test


def cumulated(df: DataFrame, keys: list[str], order: list[Column], sums: dict[str, str] | None = None, maxima: dict[str, str] | None = None, with_own: bool = True) -> DataFrame:
    """Running sums and maxima (``name=column``) per key in the given order, over the rows up to each one; without its own for ``with_own=False``.

    A sum over no value is NULL, as a window's is; rows that are equal in keys and order share a task.
    """
    sums, maxima = sums or {}, maxima or {}
    every = {**{n: (F.sum, c) for n, c in sums.items()}, **{n: (F.max, c) for n, c in maxima.items()}}
    rows = banded(df, keys, order)
    ahead = W.partitionBy(*keys).orderBy(BAND).rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, BAND).agg(*[f(c).alias(n) for n, (f, c) in every.items()])
    offsets = totals.select(*keys, BAND, *[every[n][0](n).over(ahead).alias(n) for n in every])
    inside = W.partitionBy(*keys, BAND).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow if with_own else -1)
    local = rows.select("*", *[f(c).over(inside).alias(f"{n}_inside") for n, (f, c) in every.items()])
    joined = local.alias("r").join(offsets.alias("o"), _same(keys))

    def both(n):
        here, before = F.col(f"r.{n}_inside"), F.col(f"o.{n}")
        return F.coalesce(before + here, before, here) if n in sums else F.greatest(before, here)

    return joined.select(*[F.col(f"r.`{c}`") for c in df.columns], *[both(n).alias(n) for n in every])


def ranked(df: DataFrame, keys: list[str], value: str, name: str, descending: bool = False) -> DataFrame:
    """``rank() over (partition by keys order by value)``; equal values are counted before they are ordered, so that a frequent one is a single row.
    NULL comes first, or last when descending."""
    order = [F.desc_nulls_last(value) if descending else F.asc_nulls_first(value)]
    places = cumulated(df.groupBy(*keys, value).agg(F.count("*").alias("at_value")), keys, order, {"rows_before": "at_value"}, with_own=False)
    test = F.lit(True)
    for c in (*keys, value):
        test &= F.col(f"d.`{c}`").eqNullSafe(F.col(f"p.`{c}`"))
    return df.alias("d").join(places.alias("p"), test).select("d.*", (F.coalesce("p.rows_before", F.lit(0)) + 1).alias(name))
