"""Five-week conditional pivot with per-destination reporting lag (A1, A2).

Every row gets one integer ``offset = anchor - lag(Destino) - RelWeek``: the
row belongs to week column ``i`` exactly when ``offset == i``, which is the
same truth table as "matching week, shifted two weeks back for late
airports" (F5, P12, P14). Each week column is
``sum(when(offset == i, Tons).otherwise(0))``: a matching row with NULL tons
adds nothing, and a key whose every row matches with NULL tons sums to NULL
(N4). There is no week filter before grouping: a carrier with zero tons in
all five weeks still forms a row (N5).

Sums decompose, so the pivot may run in stages: a partial aggregate on each
map task, a final one per key, and a re-aggregation after keys are merged
(``resum``) give the same values and the same NULLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import ident, lit
from ..sources.schema import week_columns


def lag_sql(dest: str, lag_weeks: dict[str, int]) -> str:
    if not lag_weeks:
        return "0"
    arms = " ".join(f"WHEN {dest} = {lit(a)} THEN {int(n)}" for a, n in lag_weeks.items())
    return f"CASE {arms} ELSE 0 END"


def offset_sql(anchor: int, lag_weeks: dict[str, int], dest: str = "`Destino`",
               rel_week: str = "`RelWeek`") -> str:
    """Week column index of a row: 0 for the newest reported week."""
    return f"({int(anchor)} - {lag_sql(dest, lag_weeks)} - {rel_week})"


def week_sums_sql(anchor: int, lag_weeks: dict[str, int], weeks: int = 5,
                  dest: str = "`Destino`", tons: str = "`Tons`",
                  rel_week: str = "`RelWeek`", tons_type: str = "double") -> list[str]:
    """``sum(CASE WHEN offset = i THEN Tons ELSE 0 END) AS <week i>``.

    ``tons_type`` is the type summed in: ``double`` (default) or a decimal,
    whose sums do not depend on the order rows are added in (exact duplicate
    removal across views, N22). A decimal rounds each row's tons half up to
    its scale, and a row beyond its range stops the report with an error:
    ``decimal(38,6)`` holds tons below 1e32 to a millionth.
    """
    offset = offset_sql(anchor, lag_weeks, dest, rel_week)
    # NaN tons count as NULL even if the loader was bypassed.
    tons = f"nanvl(CAST({tons} AS DOUBLE), CAST(NULL AS DOUBLE))"
    return [f"sum(CASE WHEN {offset} = {i} THEN CAST({tons} AS {tons_type}) "
            f"ELSE CAST(0 AS {tons_type}) END) AS {ident(w)}"
            for i, w in enumerate(week_columns(weeks))]


def lagged_pivot(rows: DataFrame, keys: list, anchor: int,
                 lag_weeks: dict[str, int], weeks: int = 5,
                 tons_type: str = "double") -> DataFrame:
    """``groupBy(keys)`` with the five lagged week sums; needs ``Destino``,
    ``RelWeek`` and ``Tons`` columns. ``anchor`` is the newest week."""
    sums = week_sums_sql(anchor, lag_weeks, weeks, tons_type=tons_type)
    return rows.groupBy(*keys).agg(*[F.expr(e) for e in sums])


def resum(df: DataFrame, keys: list, weeks: int = 5) -> DataFrame:
    """Merge week sums of rows that share ``keys``."""
    return df.groupBy(*keys).agg(*[F.expr(f"sum({ident(c)}) AS {ident(c)}")
                                   for c in week_columns(weeks)])
