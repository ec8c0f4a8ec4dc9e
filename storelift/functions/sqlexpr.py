"""SQL-text building blocks for wide expression lists.

A report has dozens of derived columns; writing them as SQL expression text
and handing them to Spark in one ``F.expr`` each keeps plan construction
cheap (one JVM call per column instead of one per sub-expression).  The text
is plain Spark SQL, evaluated inside whole-stage codegen like any built-in
expression.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Quote an identifier."""
    return "`" + name.replace("`", "``") + "`"


def cols(mapping: Mapping[str, str]) -> list[Column]:
    """``{name: sql}`` -> Columns aliased to ``name``."""
    return [F.expr(f"{sql} AS {q(name)}") for name, sql in mapping.items()]


def sql_flag(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def sql_ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF({den}, 0)"


def sums(names: Iterable[str], cast: str | None = None) -> dict[str, str]:
    if cast:
        return {n: f"CAST(sum({q(n)}) AS {cast})" for n in names}
    return {n: f"sum({q(n)})" for n in names}
