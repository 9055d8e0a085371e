"""Helpers of the operators of this subpackage: written intermediate tables and batches of texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share: under ``spark.checkpoint.dir``, or under the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tallyframe-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives lost executors, and fixes row numbers."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def picked(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names the operator uses; any other column is left out."""
    return docs.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def free_name(columns: list[str], name: str) -> str:
    """A column name that is not among the given ones, in any letter case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def null_safe_key(column: str):
    """A never-null string that is equal for equal values only, and null's own value for null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("-"))


def sub_batches(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of about ``most_bytes`` of text (one row at least), so that memory follows neither row counts nor batch sizes."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if len(sizes) > start:
            yield batch.slice(start)


def byte_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch as UTF-8, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def over_batches(docs: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, column: str = "text") -> DataFrame:
    """``work`` on each slice of the rows, on the executors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sub_batches(batches, column):
            yield work(part)

    return docs.mapInArrow(run, schema)
