"""Small text builders for SQL expressions that Spark and DuckDB read the same way."""

from __future__ import annotations


def idiv(a: str, b: int | str) -> str:
    """Whole-number division; ``/`` gives a double in both engines."""
    return f"cast(floor(({a}) / {b}) as bigint)"


def money(cents: str, precision: int = 7) -> str:
    """Whole cents as a decimal with two digits, exact in both engines."""
    return f"cast(cast({cents} as decimal({precision + 2},0)) * 0.01 as decimal({precision},2))"


def pick(values: list[str], index: str) -> str:
    """The ``index``-th of a short list of words, NULL beyond its end.

    The three slots are the engine's spelling of a list element; the list itself is a constant.
    """
    words = ", ".join(f"'{v}'" for v in values)
    return f"{{list}}{words}{{at}}{index}{{end}}"


def ident(prefix: str, number: str) -> str:
    """Fixed-width business key such as ``ITEM000000000042``."""
    return f"concat('{prefix}', lpad(cast({number} as string), 12, '0'))"


def gap(expr: str, when: str) -> str:
    """``expr`` with NULL where ``when`` holds."""
    return f"case when {when} then null else {expr} end"


def columns(spec: dict[str, tuple[str, str]]) -> str:
    """Select list from ``{name: (type, expression)}``."""
    return ", ".join(f"cast({expr} as {kind}) as {name}" for name, (kind, expr) in spec.items())
