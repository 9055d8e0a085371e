"""All queries by key."""

from __future__ import annotations

from tallyframe.plans import learning, micro, relational, runlog, stored, tables, tpch
from tallyframe.plans.registry import Book, Query
from tallyframe.plans.tpcds import part1, part2, part3, variants

_BOOKS = (tpch.BOOK, part1.BOOK, part2.BOOK, part3.BOOK, variants.BOOK, micro.BOOK, relational.BOOK, runlog.BOOK, tables.BOOK, stored.BOOK, learning.BOOK)


def library() -> Book:
    book = Book()
    for part in _BOOKS:
        for query in part.values():
            book.put(query)
    return book


def query(key: str) -> Query:
    for part in _BOOKS:
        if key in part:
            return part[key]
    raise KeyError(f"no query {key}")


__all__ = ["library", "query"]
