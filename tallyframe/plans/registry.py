"""A query: DataFrame builder, the shape of its answer, and the same question in SQL for an oracle."""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sources.catalog import Catalog, oracle_tables

_SPARK_TYPE = {"s": "string", "i": "int", "l": "bigint", "d": "double", "b": "boolean"}
_ORACLE_TYPE = {"s": "VARCHAR", "i": "INTEGER", "l": "BIGINT", "d": "DOUBLE", "b": "BOOLEAN"}


@dataclass(frozen=True)
class Query:
    """``out`` lists ``name:type`` (s, i, l, d, b; ``d4`` is a double rounded to 4 digits); dates go out as ISO text.

    ``order`` is applied after the casts and completed by the other columns, so that a limit never cuts through
    a tie; NULLs sort as Spark sorts them.
    """

    key: str
    build: Callable[[Catalog, SimpleNamespace], DataFrame]
    out: str
    sql: str | None = None
    suite: str = "tpcds"
    order: str = ""
    limit: int | None = None
    params: dict = field(default_factory=dict)
    tried: dict = field(default_factory=dict)
    pruned: tuple[int, int] | None = None

    def columns(self) -> list[tuple[str, str, str]]:
        """(name, type letter, digits) of every column, hidden ones included."""
        split = [part.rsplit(":", 1) for part in self.out.split()]
        return [(name, kind[0], kind[1:].rstrip("!")) for name, kind in split]

    def shown(self) -> list[str]:
        return [part.rsplit(":", 1)[0] for part in self.out.split() if not part.endswith("!")]

    def values(self, **override) -> SimpleNamespace:
        return SimpleNamespace(**{**self.params, **override})

    def answer(self, catalog: Catalog, **override) -> DataFrame:
        """The reference's own parameters unless overridden."""
        if self.pruned:
            catalog = catalog.pruned("store_sales", "ss_sold_date_sk", *self.pruned)
        df = self.build(catalog, self.values(**override))
        df = df.select(*[_cast(F.col(f"`{n}`"), k, digits).alias(n) for n, k, digits in self.columns()])
        if self.limit is not None or self.order:
            df = df.orderBy(*[F.desc(n) if down else F.asc(n) for n, down in self._keys()])
        if self.limit is not None:
            df = df.limit(self.limit)
        return df if len(self.shown()) == len(df.columns) else df.select(*self.shown())

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        """On the given tables, with the parameters that hit them."""
        return self.answer(Catalog(spark, folder, self.suite), **self.tried)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        shown = {k: _literal(v) for k, v in {**self.params, **self.tried}.items()}
        body = self.sql.format(**shown).strip()
        tables = oracle_tables(self.suite, body)
        if self.pruned:
            body = re.sub(r"\bstore_sales\b(?! [<>,)])", "pruned_sales", body)
            tables += f",\npruned_sales AS (SELECT * FROM store_sales WHERE ss_sold_date_sk BETWEEN {self.pruned[0]} AND {self.pruned[1]})"
        with_list = f"WITH {tables},\nanswer AS (\n{body}\n)" if tables else f"WITH answer AS (\n{body}\n)"
        picked = ", ".join(_oracle_cast(n, k, digits) for n, k, digits in self.columns())
        visible = ", ".join(f'"{n}"' for n in self.shown())
        text = f"{with_list},\nshown AS (SELECT {picked} FROM answer)\nSELECT {visible} FROM shown"
        if self.limit is None:
            return text
        keys = ", ".join(f'"{n}" DESC NULLS LAST' if down else f'"{n}" ASC NULLS FIRST' for n, down in self._keys())
        return f"{text}\nORDER BY {keys}\nLIMIT {self.limit}"

    def _keys(self) -> list[tuple[str, bool]]:
        stated = [p.split() for p in self.order.split(",") if p.strip()]
        keys = [(" ".join(p[:-1]), True) if p[-1] == "desc" else (" ".join(p), False) for p in stated]
        if self.limit is not None:
            keys += [(n, False) for n, _, _ in self.columns() if n not in {k for k, _ in keys}]
        return keys

    def variant(self, key: str, **changes) -> "Query":
        """The same plan under another name, with other parameters or another answer shape."""
        if "params" in changes:
            changes["params"] = {**self.params, **changes["params"]}
        if "tried" in changes:
            changes["tried"] = {**self.tried, **changes["tried"]}
        return replace(self, key=key, **changes)


def _cast(col, kind: str, digits: str):
    cast = col.cast(_SPARK_TYPE[kind[0]])
    return F.round(cast, int(digits)) if digits else cast


def _oracle_cast(name: str, kind: str, digits: str) -> str:
    cast = f'CAST("{name}" AS {_ORACLE_TYPE[kind[0]]})'
    return f'round({cast}, {digits}) AS "{name}"' if digits else f'{cast} AS "{name}"'


class Raw(str):
    """A piece of SQL that both engines read, used as a parameter."""


def _literal(value) -> str:
    if isinstance(value, Raw):
        return str(value)
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (list, tuple)):
        return ", ".join(_literal(v) for v in value)
    return str(value)


literal = _literal


class Book(dict):
    """Queries by key; adding one twice is an error."""

    def add(self, key: str, build, out: str, sql: str | None = None, **rest) -> Query:
        if key in self:
            raise KeyError(f"query {key} is already there")
        self[key] = Query(key, build, out, sql, **rest)
        return self[key]

    def put(self, query: Query) -> Query:
        if query.key in self:
            raise KeyError(f"query {query.key} is already there")
        self[query.key] = query
        return query
