"""Short DataFrame verbs shared by all plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def on(left: DataFrame, right: DataFrame, condition: str, how: str = "inner") -> DataFrame:
    """Join on a condition over distinct column names."""
    return left.join(right, F.expr(condition), how)


def semi(left: DataFrame, right: DataFrame, condition: str) -> DataFrame:
    """EXISTS: rows of ``left`` with a match."""
    return left.join(right, F.expr(condition), "left_semi")


def anti(left: DataFrame, right: DataFrame, condition: str) -> DataFrame:
    """NOT EXISTS: rows of ``left`` without a match."""
    return left.join(right, F.expr(condition), "left_anti")


def total(column: str | Column, name: str) -> Column:
    return F.sum(_c(column)).alias(name)


def mean(column: str | Column, name: str | None = None) -> Column:
    """Average from an exact sum: order of addition cannot change the last digits."""
    c = _c(column)
    value = F.try_divide(F.sum(c).cast("double"), F.count(c))
    return value.alias(name) if name else value


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b in doubles, NULL for a zero divisor."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def only(values, name: str) -> Column:
    """Sum of ``value`` where ``condition`` holds, for ``(condition, value)``."""
    condition, value = values
    return F.sum(F.when(F.expr(condition), F.expr(value))).alias(name)


def tally(condition: str, name: str) -> Column:
    """Number of rows that meet a condition; 0 for none, as a sum of ones and zeros gives."""
    return F.sum(F.when(F.expr(condition), 1).otherwise(0)).alias(name)


def renamed(df: DataFrame, prefix: str, *columns: str) -> DataFrame:
    """Some columns under prefixed names, for a second role of the same table."""
    return df.select(*[F.col(c).alias(prefix + c) for c in columns])


def one_row(df: DataFrame, single: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate as a scalar subquery: computed once, then a constant of the plan."""
    packed = single.select(F.struct(*single.columns).alias("row")).scalar()
    return df.withColumn("one_row", packed).select(*df.columns, "one_row.*")


def _c(column: str | Column) -> Column:
    return F.expr(column) if isinstance(column, str) else column
