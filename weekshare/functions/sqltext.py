"""Quoting for the SQL expression text the rule data compiles to.

Row-level rules (classification ladders, labels, the lagged pivot) are
written as Spark SQL expression text and handed to Spark's own parser with
``F.expr`` / ``selectExpr``: one call per expression instead of one JVM call
per literal and operator, which keeps plan construction cheap. The parsed
expressions are the same Catalyst trees the Column API builds.
"""

from __future__ import annotations


def lit(value) -> str:
    """A SQL literal for a Python str, int, float, bool or None."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return f"{value}L" if abs(value) > 2**31 - 1 else str(value)
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def ident(name: str) -> str:
    """A quoted column name."""
    return "`" + name.replace("`", "``") + "`"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"
