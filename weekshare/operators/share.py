"""Share of group per week and the report key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.arith import ieee_divide_sql
from ..functions.sqltext import ident
from ..sources.schema import share_columns, week_columns


def share_of_group(df: DataFrame, part: list[str], weeks: int = 5) -> DataFrame:
    """Each row's tons over the group's total, per week, as IEEE division.

    Totals include every report row of the group (home, named, bucket); rows
    of NULL carriers never reached the report, so they are not in the total
    (N1). All week totals share one unordered window over the group.
    """
    keys = ", ".join(ident(c) for c in part)
    wk = week_columns(weeks)
    totals = df.selectExpr(
        "*", *[f"sum({ident(w)}) OVER (PARTITION BY {keys}) AS _t{i}" for i, w in enumerate(wk)])
    return totals.selectExpr(
        *[ident(c) for c in df.columns],
        *[f"{ieee_divide_sql(ident(w), f'_t{i}')} AS {ident(r)}"
          for i, (w, r) in enumerate(zip(wk, share_columns(weeks)))])


# ``excelKEY``: the rank as text followed by the group label.
REPORT_KEY_SQL = "concat(CAST(`Rank` AS STRING), `Grupo`)"


def format_report(df: DataFrame) -> DataFrame:
    """Sink form of a report: NaN shares become NULL (empty CSV fields)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            c = ident(f.name)
            cols.append(f"CASE WHEN isnan({c}) THEN CAST(NULL AS DOUBLE) ELSE {c} END AS {c}")
        else:
            cols.append(ident(f.name))
    return df.selectExpr(*cols)
