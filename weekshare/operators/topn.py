"""Top-N competitors per group with an "others" bucket.

Input: one row per (group, carrier) with the week sums. Output adds
``OwnerGrpd``, ``cls`` (0 home carrier, 1 named competitor, 99 others) and
``rn``, the competitor's row number (NULL for the home carrier).

Competitors are numbered within the group by the newest week only, NULLs
last, ties broken by carrier code (N9-N11). One window partitioned by the
group alone serves both home and competitor rows: home rows sort after all
competitors, so a competitor's row number is its position among competitors.
A row number ``>= threshold`` goes to the bucket (N8); a carrier whose code
is the bucket name joins the bucket wherever it ranks (N12).

The window holds one group's carriers after aggregation, a number bounded by
the carriers in the market, never by the fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.sqltext import ident, lit

HOME, NAMED, BUCKET = 0, 1, 99


def bucket_topn(df: DataFrame, part: list[str], threshold: str,
                home: str = "LA", others: str = "Otros") -> DataFrame:
    """``threshold`` is a SQL expression (may depend on the group's label)."""
    keys = ", ".join(ident(c) for c in part)
    is_home = f"(`Owner` = {lit(home)})"
    ranked = df.selectExpr(
        "*", f"row_number() OVER (PARTITION BY {keys} ORDER BY {is_home} ASC, "
             "`W` DESC NULLS LAST, `Owner` ASC NULLS LAST) AS _rn")
    to_bucket = f"(_rn >= {threshold} OR `Owner` = {lit(others)})"
    return ranked.selectExpr(
        *[ident(c) for c in df.columns],
        f"CASE WHEN {is_home} THEN `Owner` WHEN _rn >= {threshold} THEN {lit(others)} "
        "ELSE `Owner` END AS OwnerGrpd",
        f"CASE WHEN {is_home} THEN {HOME} WHEN {to_bucket} THEN {BUCKET} ELSE {NAMED} END AS cls",
        f"CAST(CASE WHEN NOT {is_home} THEN _rn END AS BIGINT) AS rn")
