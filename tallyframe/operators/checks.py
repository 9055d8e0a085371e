"""Content hashes that do not depend on row order, and ways to consume a result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def content_hash(df: DataFrame, null_safe: bool = False) -> DataFrame:
    """One row: the sum of the CRCs of the comma-joined rows; NULL for no rows.

    The plain form skips NULLs, so that ``(NULL, 'a')`` and ``('a', NULL)`` are equal; the null-safe form writes them out.
    """
    texts = [F.col(f"`{c}`").cast("string") for c in df.columns]
    if null_safe:
        texts = [F.coalesce(t, F.lit("\\N")) for t in texts]
    return df.select(F.crc32(F.concat_ws(",", *texts)).cast("decimal(20,0)").alias("crc")).agg(F.sum("crc").alias("content_hash"))


def as_check(build, null_safe: bool = False):
    """A query builder whose answer is the hash of another one's answer."""
    return lambda *args, **named: content_hash(build(*args, **named), null_safe)


def run_everywhere(df: DataFrame) -> None:
    """Compute every row on the executors and keep none."""
    df.write.format("noop").mode("overwrite").save()


def force_all_columns(df: DataFrame) -> DataFrame:
    """One row that depends on every output column, so that none can be pruned away.

    Hashes are summed as decimals: 64-bit sums would overflow under ANSI rules.
    """
    return df.select(F.xxhash64(*df.columns).cast("decimal(20,0)").alias("h")).agg(F.sum("h").alias("all_columns"), F.count("*").alias("rows"))
