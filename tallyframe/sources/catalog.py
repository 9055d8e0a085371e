"""Name → DataFrame for one data folder, and the same names → SQL for an oracle engine."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sources import misc_tables, tpcds_tables, tpch_tables

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
         "benchmark", "labels", "conversations")

SUITES: dict[str, dict[str, str]] = {"tpch": tpch_tables.TABLES, "tpcds": tpcds_tables.TABLES, "misc": misc_tables.TABLES, "given": {}}

# What the two engines spell differently: an element of a constant list, and a row per week of the five selling years.
_SPARK_WORDS = {"{list}": "try_element_at(array(", "{at}": "), cast((", "{end}": ") + 1 as int))", "{each_week}": "explode(sequence(0L, 260L))"}
_ORACLE_WORDS = {"{list}": "([", "{at}": "])[cast((", "{end}": ") + 1 as bigint)]", "{each_week}": "unnest(range(0, 261))"}

_SLOT = re.compile(r"\{(\w+)\}")


def _spelled(text: str, words: dict[str, str]) -> str:
    for slot, word in words.items():
        text = text.replace(slot, word)
    return text


class Catalog:
    """Tables of one suite in one folder, reached as attributes: ``Catalog(spark, folder, "tpcds").store_sales``.

    Tables are derived from the given ones on the fly, unless ``replaced`` names others, such as written, partitioned or bucketed ones
    (see ``tallyframe.sources.stored``).
    """

    def __init__(self, spark: SparkSession, folder: str, suite: str = "given"):
        self.spark, self.folder, self.suite = spark, folder.rstrip("/"), suite
        self._frames: dict[str, DataFrame] = {}
        self._others: set[str] = set()

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def _load(self, name: str) -> DataFrame:
        rules = SUITES[self.suite]
        if name not in rules:
            if name in GIVEN:
                return self.given(name)
            raise KeyError(f"suite {self.suite} has no table {name}; it has {', '.join(sorted(rules) or GIVEN)}")
        text = _spelled(rules[name], _SPARK_WORDS)
        frames = {slot: self.given(slot) for slot in set(_SLOT.findall(text))}
        if "{each_week}" in rules[name]:
            # A small file is read by one task; its rows become 261 each, so they are dealt to all before that.
            frames = {slot: df.repartition(self.spark.sparkContext.defaultParallelism) for slot, df in frames.items()}
        return self.spark.sql(text, **frames)

    def replaced(self, **frames: DataFrame) -> Catalog:
        """The same tables with some of them read from elsewhere."""
        view = Catalog(self.spark, self.folder, self.suite)
        view._frames, view._others = {**self._frames, **frames}, self._others | set(frames)
        return view

    def clustered(self, name: str) -> DataFrame | None:
        """A sales fact with the rows of a day brought together before its columns are derived, so that few and narrow columns are shuffled; None for any other table."""
        if self.suite != "tpcds" or name not in tpcds_tables.SALES or name in self._others:
            return None
        lines = self.given("lineitem").where(f"l_linenumber % 3 = {tpcds_tables.SALES[name]}").selectExpr(*tpcds_tables.LINE, f"{tpcds_tables.SOLD_DAY} AS sold_day")
        return self.spark.sql(_spelled(SUITES[self.suite][name], _SPARK_WORDS), lineitem=lines.hint("rebalance", "sold_day"))

    def pruned(self, name: str, key: str, low: int, high: int) -> Catalog:
        """The same tables with one of them limited to a range of its partition key."""
        return self.replaced(**{name: self.table(name).where(f"{key} between {low} and {high}")})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)


def oracle_tables(suite: str, body: str) -> str:
    """``WITH`` list that defines, for an engine with the given tables as views, the suite's tables used in ``body``."""
    rules = SUITES[suite]
    used = [n for n in rules if re.search(rf"\b{n}\b", body)]
    texts = {n: _spelled(rules[n], _ORACLE_WORDS) for n in used}
    raw = sorted({slot for text in texts.values() for slot in _SLOT.findall(text)})
    parts = [f"given_{r} AS (SELECT * FROM {r})" for r in raw]
    parts += [f"{n} AS ({_SLOT.sub(lambda m: 'given_' + m.group(1), text)})" for n, text in texts.items()]
    return ",\n".join(parts)
