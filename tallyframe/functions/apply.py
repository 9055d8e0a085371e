"""User functions over lists, partitions and groups, by Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_apply(spark: SparkSession, values: list | DataFrame, kind: str, function: Callable, out_kind: str, slices: int | None = None) -> DataFrame:
    """``function`` over a distributed list, given as a list or as (position, value) rows; (position, value) rows."""
    rows = values if isinstance(values, DataFrame) else spark.createDataFrame(list(enumerate(values)), f"position long, value {kind}")
    rows = rows if slices is None else rows.repartition(slices)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"position": batch["position"], "value": [function(v) for v in batch["value"]]})

    return rows.mapInPandas(each, f"position long, value {out_kind}")


def partition_apply(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``function`` over the Arrow batches of each partition."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(each, schema)


def partition_apply_collect(df: DataFrame, function, schema: str) -> pd.DataFrame:
    """The same on the driver; for small results."""
    return partition_apply(df, function, schema).toPandas()


def group_apply(df: DataFrame, keys: list[str], function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``function`` over whole groups. A group must fit in a task: for keys that may be hot use ``group_apply_merged``."""
    return df.groupBy(*keys).applyInPandas(function, schema)


def group_apply_merged(df: DataFrame, keys: list[str], partial: Callable[[pd.DataFrame], pd.DataFrame], partial_schema: str,
                       merge: Callable[[pd.DataFrame, bool], pd.DataFrame], schema: str, most_rows: int = 100_000) -> DataFrame:
    """A group function in mergeable steps, for groups of any size and any number of groups.

    ``partial`` turns a batch of rows, many groups at once, into one row of ``partial_schema`` per group. ``merge`` folds such
    rows, again to one per group: with ``False`` in the partial schema, with ``True`` in the final one. Partitions are reduced
    before the shuffle, so that a hot key crosses it as a few rows per task; afterwards the sorted rows stream through, and
    only the group at the end of a batch is carried on. No task holds a whole group. What a task holds is folded when it has
    doubled since the last time, so that the folding grows with the rows, however many groups there are.
    """
    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n, folded = [], 0, 0
        for batch in batches:
            held.append(partial(batch))
            n += len(held[-1])
            if len(held) > 1 and n > 2 * folded + min(10_000, most_rows):
                held = [merge(pd.concat(held, ignore_index=True), False)]
                n = folded = len(held[0])
            if n > most_rows and len(held) == 1:
                yield held[0]
                held, n, folded = [], 0, 0
        if held:
            yield held[0] if len(held) == 1 else merge(pd.concat(held, ignore_index=True), False)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried = None
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if carried is None else pd.concat([carried, batch], ignore_index=True)
            folded = merge(rows, False)
            # Column by column: keys of several types in one Series would lose theirs.
            same = pd.Series(True, index=folded.index)
            for k in keys:
                end = rows[k].iloc[-1]
                same &= folded[k].isna() if pd.isna(end) else folded[k] == end
            if not same.all():
                yield merge(folded[~same], True)
            carried = folded[same]
        if carried is not None:
            yield merge(carried, True)

    reduced = df.mapInPandas(shrink, partial_schema)
    return reduced.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(finish, schema)


def group_apply_collect(df: DataFrame, keys: list[str], function, schema: str) -> pd.DataFrame:
    return group_apply(df, keys, function, schema).toPandas()


def geometric_mean_udaf():
    """Grouped-aggregate twin of ``exp(avg(log x))``, for small groups."""
    @F.pandas_udf("double")
    def geometric_mean(values: pd.Series) -> float:
        return math.exp(values.map(math.log).mean()) if len(values) else float("nan")

    return geometric_mean


def average_udaf():
    """Grouped-aggregate twin of ``avg``, for small groups."""
    @F.pandas_udf("double")
    def average(values: pd.Series) -> float:
        return float(values.mean())

    return average


def strip_suffix(column: Column, suffix: str) -> Column:
    """Text without a literal ending, if it has it."""
    return F.when(F.endswith(column, F.lit(suffix)), F.left(column, F.length(column) - len(suffix))).otherwise(column)


def vector_slices(column: str | Column, size: int, pieces: int) -> list[Column]:
    """A vector of ``size`` entries cut into ``pieces`` consecutive vectors; the first ones take the remainder."""
    if not 0 < pieces <= size:
        raise ValueError("the number of pieces must be between 1 and the vector size")
    values, bounds = vector_to_array(column), [round(i * size / pieces) for i in range(pieces + 1)]
    return [array_to_vector(F.slice(values, a + 1, b - a)) for a, b in zip(bounds, bounds[1:])]
