"""Collapse bucketed carriers into report rows and rank them.

One ``groupBy(part, cls, OwnerGrpd)`` replaces the three branch aggregates:
the home row, each named competitor (already unique, so its sums pass
through) and the merged others bucket. ``Rank`` is 0 for home, 99 for the
bucket and 1.. for competitors by the newest week (ties by carrier code).
A group without home rows gets no home row, one without tail carriers no
bucket row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.sqltext import ident
from .pivot import resum
from .topn import NAMED


def collapse_buckets(df: DataFrame, part: list[str], weeks: int = 5) -> DataFrame:
    return rank_rows(resum(df, [*part, "cls", "OwnerGrpd"], weeks), part)


def rank_rows(rows: DataFrame, part: list[str]) -> DataFrame:
    """``Rank`` from ``cls``: competitors first in the window, numbered 1.."""
    keys = ", ".join(ident(c) for c in part)
    named = f"(cls = {NAMED})"
    rank = (f"CAST(CASE WHEN {named} THEN row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY (NOT {named}) ASC, `W` DESC NULLS LAST, `OwnerGrpd` ASC) "
            "ELSE cls END AS BIGINT) AS Rank")
    return rows.selectExpr(*[ident(c) for c in rows.columns if c != "cls"], rank)
