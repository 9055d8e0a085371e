"""Delimited text in, partitioned tables out; registration and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.sources.catalog import SUITES, Catalog

# Partition columns of the suites' big tables.
PARTITIONS: dict[str, dict[str, list[str]]] = {
    "tpch": {"part": ["p_brand"], "customer": ["c_mktsegment"], "orders": ["o_orderdate"], "lineitem": ["l_shipdate"]},
    "tpcds": {"catalog_sales": ["cs_sold_date_sk"], "catalog_returns": ["cr_returned_date_sk"], "inventory": ["inv_date_sk"], "store_sales": ["ss_sold_date_sk"],
              "store_returns": ["sr_returned_date_sk"], "web_sales": ["ws_sold_date_sk"], "web_returns": ["wr_returned_date_sk"]},
    "misc": {},
}


def parse_delimited(lines: DataFrame, schema: T.StructType, separator: str = "|") -> DataFrame:
    """``value`` lines to typed columns. The separator ends every field, so what follows the last one is ignored; an
    empty field and one that does not fit its type are NULL."""
    fields = F.split("value", "\\" + separator, -1)
    return lines.select(*[F.nullif(F.get(fields, F.lit(i)), F.lit("")).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def to_delimited(df: DataFrame, separator: str = "|") -> DataFrame:
    """The inverse: one ``value`` line per row, each field followed by the separator, NULL as nothing."""
    return df.select(F.concat(*[F.concat(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(separator)) for c in df.columns]).alias("value"))


def raw_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def switched_schema(schema: T.StructType, double_for_decimal: bool = False, string_for_date: bool = False) -> T.StructType:
    def switch(kind):
        if double_for_decimal and isinstance(kind, T.DecimalType):
            return T.DoubleType()
        return T.StringType() if string_for_date and isinstance(kind, T.DateType) else kind

    return T.StructType([T.StructField(f.name, switch(f.dataType), f.nullable) for f in schema.fields])


def switch_types(df: DataFrame, double_for_decimal: bool = False, string_for_date: bool = False) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in switched_schema(df.schema, double_for_decimal, string_for_date).fields])


def write_table(df: DataFrame, path: str, file_format: str = "parquet", partition_by: list[str] | None = None, overwrite: bool = True,
                cluster: bool = True, drop_null_partitions: bool = False, max_records: int = 0) -> None:
    """Write one table; ``overwrite=False`` keeps an existing one. ``stored.write_exact`` makes files of an exact number of rows.

    Clustering brings the rows of a partition together before the write, so that each partition becomes few files. It is a
    rebalance rather than a plain shuffle by key: adaptive execution splits a partition value that holds too many rows for one task.
    """
    keys = partition_by or []
    if drop_null_partitions:
        for key in keys:
            df = df.where(F.col(key).isNotNull())
    if keys and cluster:
        df = df.hint("rebalance", *keys)
    writer = df.write.format(file_format).mode("overwrite" if overwrite else "ignore")
    if max_records > 0:
        writer = writer.option("maxRecordsPerFile", max_records)
    (writer.partitionBy(*keys) if keys else writer).save(path)


def write_from(catalog: Catalog, name: str, path: str, keys: list[str] | None, cluster: bool = True, **options) -> None:
    """``write_table`` for a suite's table and its partition keys; what the catalog can cluster more cheaply is not shuffled again."""
    narrow = catalog.clustered(name) if keys and cluster else None
    write_table(catalog.table(name) if narrow is None else narrow, path, partition_by=keys, cluster=cluster and narrow is None, **options)


def append_table(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Add rows to a partitioned table, clustered as ``write_table`` does it: a task sorts a share of the rows for its folders, not all that it has read."""
    df.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def chosen_tables(suite: str, only: str | None = None) -> list[str]:
    """All tables of a suite, or the one asked for; an unknown name is an error."""
    names = list(SUITES[suite])
    if only is None:
        return names
    if only not in names:
        raise ValueError(f"suite {suite} has no table {only}")
    return [only]


def write_suite(catalog: Catalog, folder: str, only: str | None = None, **options) -> list[str]:
    """Materialize a suite's tables under ``<folder>/<suite>/<name>``; ``stored.written_suite`` reads them."""
    paths = []
    for name in chosen_tables(catalog.suite, only):
        path = f"{folder}/{catalog.suite}/{name}"
        write_from(catalog, name, path, PARTITIONS[catalog.suite].get(name), **options)
        paths.append(path)
    return paths


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.catalog.setCurrentDatabase(database)


def external_table(spark: SparkSession, name: str, path: str, file_format: str = "parquet", partitioned: bool = False) -> None:
    """Create or replace a table over files that exist; its partition folders are found."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source=file_format)
    if partitioned:
        recover_partitions(spark, name)


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Register the partition folders under a table's location."""
    spark.catalog.recoverPartitions(name)


def external_suite(spark: SparkSession, database: str, suite: str, folder: str, only: str | None = None, file_format: str = "parquet") -> None:
    create_database(spark, database)
    for name in chosen_tables(suite, only):
        external_table(spark, f"{database}.{name}", f"{folder}/{suite}/{name}", file_format, partitioned=name in PARTITIONS[suite])


def temp_view(spark: SparkSession, name: str, path: str, file_format: str = "parquet") -> None:
    spark.read.format(file_format).load(path).createOrReplaceTempView(name)


def analyze_table(spark: SparkSession, name: str, columns: bool = False) -> None:
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS" + (" FOR ALL COLUMNS" if columns else ""))


def analyze_suite(spark: SparkSession, database: str, suite: str, only: str | None = None, columns: bool = True) -> None:
    for name in chosen_tables(suite, only):
        analyze_table(spark, f"{database}.{name}", columns)


def column_statistics(df: DataFrame) -> DataFrame:
    """One row per column: rows, NULLs, approximate distinct count, lowest, highest, average and longest text length.

    A single scan with partial aggregates; the one wide row is turned into a row per column.
    """
    parts = []
    for c in df.columns:
        text = F.col(c).cast("string")
        parts.append(F.struct(F.lit(c).alias("column"), F.count("*").alias("rows"), (F.count("*") - F.count(c)).alias("nulls"), F.approx_count_distinct(c).alias("approx_distinct"),
                              F.min(c).cast("string").alias("lowest"), F.max(c).cast("string").alias("highest"), F.avg(F.length(text)).alias("avg_length"), F.max(F.length(text)).alias("max_length")))
    return df.agg(F.array(*parts).alias("columns")).select(F.inline("columns"))


def write_runs(runs: DataFrame, folder: str) -> None:
    """Append runs as JSON under ``timestamp=<ms>`` folders, the runs of a folder brought together first: a file for each, not one for each task that has some."""
    runs.hint("rebalance", "timestamp").write.mode("append").partitionBy("timestamp").json(folder)


def read_runs(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """All runs back; the schema is inferred over every run unless given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(folder)


def save_result(df: DataFrame, folder: str, name: str) -> str:
    path = f"{folder}/{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path
