"""Tables kept as files and registered in the session's catalog: written once, recovered, bucketed, analysed, described, built when missing.

A written table counts only once its writer has committed it (``_SUCCESS``); what a broken-off job has left is written again, never read.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.sources.catalog import Catalog
from tallyframe.sources.layout import PARTITIONS, analyze_table, external_table, write_from


_SCRATCH: dict[str, list[str]] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share: under ``spark.checkpoint.dir``; where that is unset, under the warehouse of a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/tallyframe/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch folders of this application; frames that read them are of no use afterwards."""
    for folder in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        remove(spark, folder)


def _located(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop sees them."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a writer has committed a table there."""
    system, place = _located(spark, f"{path}/_SUCCESS")
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _located(spark, path)
    system.delete(place, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a scratch table: computed once, whatever then asks for it."""
    folder = scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def session_like(spark: SparkSession, **settings: str) -> SparkSession:
    """Another session on the same catalog tables, with this one's settings and some more (underscores for dots). Frames made in it are planned by them."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, value in settings.items():
        session.conf.set(key.replace("__", "."), value)
    return session


def cost_session(spark: SparkSession) -> SparkSession:
    """A session that orders joins by the statistics of analysed tables."""
    return session_like(spark, spark__sql__cbo__enabled="true", spark__sql__cbo__joinReorder__enabled="true", spark__sql__statistics__histogram__enabled="true")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session whose Parquet reader answers counts from the files' footers."""
    return session_like(spark, spark__sql__sources__useV1SourceList="", spark__sql__parquet__aggregatePushdown="true")


class Store:
    """Tables of one suite as files under a root, registered in a database of their own: each a snapshot of when it was first asked for."""

    def __init__(self, catalog: Catalog, root: str | None = None):
        self.catalog, self.spark = catalog, catalog.spark
        self.root = root or scratch(self.spark, f"store-{catalog.suite}")
        self.database = f"tallyframe_{uuid.uuid4().hex[:12]}"
        self.analysed_tables: set[str] = set()
        self.spark.sql(f"CREATE DATABASE {self.database} LOCATION '{self.root}/database'")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _external(self, name: str, table: str, keys: list[str]) -> str:
        full = f"{self.database}.{name}"
        if not self.spark.catalog.tableExists(full):
            if not is_complete(self.spark, self.path(name)):
                write_from(self.catalog, table, self.path(name), keys)
            external_table(self.spark, full, self.path(name), partitioned=bool(keys))
        return full

    def plain(self, name: str) -> str:
        """The registered name of a table in one folder."""
        return self._external(f"{name}_plain", name, [])

    def partitioned(self, name: str) -> str:
        """The registered name of a table in a folder for each value of its suite's partition column, all recovered into the catalog."""
        return self._external(f"{name}_by_key", name, PARTITIONS[self.catalog.suite][name])

    def bucketed(self, name: str, keys: list[str], buckets: int, df: DataFrame | None = None) -> str:
        """The registered name of a table (of the suite, or the frame given) in ``buckets`` files by the hash of the keys, sorted by them: joins and groups on the keys need no shuffle."""
        full = f"{self.database}.{name}_in_{buckets}_by_{'_'.join(keys)}"
        if not self.spark.catalog.tableExists(full):
            writer = (self.catalog.table(name) if df is None else df).repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
            writer.format("parquet").option("path", self.path(f"bucketed-{uuid.uuid4().hex}")).saveAsTable(full)
        return full

    def analysed(self, name: str) -> str:
        """The registered name of a table with statistics and histograms of all its columns."""
        full = self.plain(name)
        if full not in self.analysed_tables:
            analyze_table(cost_session(self.spark), full, columns=True)
            self.analysed_tables.add(full)
        return full

    def all_analysed(self, names: list[str], at_once: int = 6) -> dict[str, str]:
        """The same for several tables, some at a time: their statistics are many short jobs."""
        with ThreadPoolExecutor(at_once) as pool:
            return dict(zip(names, pool.map(self.analysed, names)))

    def on(self, spark: SparkSession | None = None, **tables: str) -> Catalog:
        """The suite's catalog, in a session, with some tables read from the store: ``table=registered name``."""
        spark = spark or self.spark
        return Catalog(spark, self.catalog.folder, self.catalog.suite).replaced(**{n: spark.table(full) for n, full in tables.items()})


_STORES: dict[tuple[str, str, str], Store] = {}


def store_of(catalog: Catalog) -> Store:
    """The application's store for the tables of a folder and suite."""
    key = (catalog.spark.sparkContext.applicationId, catalog.folder, catalog.suite)
    if key not in _STORES:
        _STORES[key] = Store(Catalog(catalog.spark, catalog.folder, catalog.suite))
    return _STORES[key]


def written_suite(spark: SparkSession, folder: str, given: str, suite: str, names: list[str]) -> Catalog:
    """A suite's catalog that reads the named tables from ``<folder>/<suite>/<name>`` (see ``layout.write_suite``); one that is not there whole is an error."""
    frames = {}
    for name in names:
        path = f"{folder}/{suite}/{name}"
        if not is_complete(spark, path):
            raise ValueError(f"no complete table at {path}")
        frames[name] = spark.read.parquet(path)
    return Catalog(spark, given, suite).replaced(**frames)


def column_facts(spark: SparkSession, table: str) -> DataFrame:
    """(column, nulls, distinct, lowest, highest, bins) as the catalog has them: what ANALYZE has left there, no scan."""
    rows = []
    for column in spark.catalog.listColumns(table):
        facts = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} `{column.name}`").collect()}
        known = {k: None if facts.get(k) in (None, "NULL") else facts[k] for k in ("num_nulls", "distinct_count", "min", "max")}
        bins = sum(k.startswith("bin_") for k in facts)
        rows.append((column.name, known["num_nulls"], known["distinct_count"], known["min"], known["max"], bins))
    found = spark.createDataFrame(rows, "column string, nulls string, distinct string, lowest string, highest string, bins int")
    return found.withColumns({c: F.col(c).cast("long") for c in ("nulls", "distinct")})


def row_counts(spark: SparkSession, paths: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """(name, rows, columns, partition_columns, partitions) of Parquet tables, name -> (path, partition columns), in one job: footers give the counts,
    folder names the partitions."""
    reader, parts = footer_session(spark).read, []
    for name, (path, keys) in paths.items():
        df = reader.parquet(path)
        counted = df.groupBy(*keys).agg(F.count("*").alias("n")) if keys else df.agg(F.count("*").alias("n"))
        parts.append(counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("partitions")).select(
            F.lit(name).alias("name"), "rows", F.lit(len(df.columns)).alias("columns"), F.lit(",".join(keys)).alias("partition_columns"), (F.col("partitions") if keys else F.lit(0)).alias("partitions")))
    return functools.reduce(DataFrame.unionByName, parts)


def write_exact(df: DataFrame, path: str, max_records: int) -> None:
    """Write files of exactly ``max_records`` rows, the last one excepted.

    The plan runs once, into a staged table. A row's number is its place in its staged file after the rows of the files before, of which only
    footers are counted; rows are then dealt by the number of the file they belong to, and every task cuts its files at ``max_records``.
    """
    staged = scratch(df.sparkSession, "staged")
    df.write.parquet(staged)
    rows = df.sparkSession.read.schema(df.schema).parquet(staged)
    counts = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    # One row for each staged file, of which there are as many as the plan had tasks.
    before = counts.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    name = next(n for n in ("file_number", *(f"file_number_{i}" for i in range(len(df.columns)))) if n not in df.columns)
    placed = rows.select("*", F.col("_metadata.file_path").alias(f"{name}_file"), F.col("_metadata.row_index").alias(f"{name}_row"))
    dealt = placed.join(before, F.col(f"{name}_file") == F.col("file")).withColumn(name, F.floor((F.col("before") + F.col(f"{name}_row")) / max_records))
    dealt.repartition(name).sortWithinPartitions(name).select(*[F.col(f"`{c}`") for c in df.columns]).write.option("maxRecordsPerFile", max_records).mode("overwrite").parquet(path)
    remove(df.sparkSession, staged)


def build_missing(spark: SparkSession, text: str, builders: dict[str, Callable[[SparkSession], DataFrame]], root: str) -> list[str]:
    """Build the tables that a statement names and the catalog lacks, in the order in which they need one another; returns their names in that order.

    A builder may read tables that are missing too; they are found as the statement's are, from what the analyser cannot resolve. A table is
    written under ``root``, committed, and only then registered; one that is there and complete is registered as it is, one that is not complete
    is written again. Names without a builder and tables that need themselves are errors.
    """
    made: list[str] = []

    def need(attempt: Callable[[], DataFrame], waiting: tuple[str, ...]) -> DataFrame:
        while True:
            try:
                return attempt()
            except AnalysisException as error:
                if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
                    raise
                name = error.getMessageParameters()["relationName"].replace("`", "")
            if name in waiting:
                raise ValueError(f"table {name} needs itself, by way of {', '.join(waiting)}")
            if name not in builders:
                raise ValueError(f"no builder for table {name}")
            path = f"{root}/{name}"
            if not is_complete(spark, path):
                need(lambda: builders[name](spark), (*waiting, name)).write.mode("overwrite").parquet(path)
                made.append(name)
            external_table(spark, name, path)

    need(lambda: spark.sql(text), ())
    return made
