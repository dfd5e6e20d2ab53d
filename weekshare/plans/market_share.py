"""Weekly market share per route group (C1-C5), one view or many in one scan.

Plan, for any number of views over one base table:

1. Scan with one pushed predicate: tracked destination, some view's origin
   rule holds, carrier not NULL. Rows no view keeps never leave the reader.
2. Per row, classify destination and one origin per distinct rule set, then
   a partial + final hash aggregate on (origins, destination, flight type,
   raw carrier) with the five lagged week sums. This is the only step whose
   work grows with the fact table; map-side partial aggregation leaves at
   most (route classes x carriers) rows per task, so a carrier or route that
   holds a third of all rows costs no more than any other.
3. On that small result: label each view's group, expand one row per view
   that keeps it, trim carrier codes and re-sum by (view, group, carrier).
4. One hash exchange by group label on that small result; the re-sum,
   top-N bucket, collapse, rank, shares, key and the reports' cross-view
   deduplication all reuse it. Two exchanges in all, both after map-side
   reduction.

No Python UDF, no collect, no sort before the sink (O1 is the sink's job).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions import rules as R
from ..functions.calendar import anchor_value
from ..functions.sqltext import ident, lit
from ..functions.text import UNICODE_WHITE_SPACE
from ..operators.collapse import collapse_buckets
from ..operators.pivot import lagged_pivot, resum
from ..operators.share import REPORT_KEY_SQL, share_of_group
from ..operators.topn import bucket_topn
from ..sources.schema import report_columns, week_columns
from .views import ViewSpec

PART = ["view", "Grupo"]


def _as_list(views) -> list[ViewSpec]:
    views = [views] if isinstance(views, ViewSpec) else list(views)
    if not views:
        raise ValueError("no views given")
    names = [v.name for v in views]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate view names {names}")
    first = views[0]
    for v in views[1:]:
        if (v.lag_weeks, v.weeks, v.home, v.others) != (first.lag_weeks, first.weeks, first.home, first.others):
            raise ValueError("views in one scan must share lag_weeks, weeks, home and others")
    return views


def _origin_sets(views: list[ViewSpec]) -> list[R.RuleSet]:
    sets: list[R.RuleSet] = []
    for v in views:
        if v.origin not in sets:
            sets.append(v.origin)
    return sets


def scan_predicate_sql(views: Sequence[ViewSpec]) -> str:
    """Raw-column filter that keeps every row some view can use.

    Written only with ``=``, ``!=``, ``IN``, ``AND``, ``OR`` and ``IS NOT
    NULL`` on base columns, so Parquet receives it as pushed filters.
    """
    tests = []
    for v in _as_list(views):
        test = f"{R.destination_tracked_sql(v.only_destinations)} AND ({v.origin.any_sql()})"
        if test not in tests:
            tests.append(test)
    return f"`Owner` IS NOT NULL AND ({' OR '.join(f'({t})' for t in tests)})"


def route_classes(base: DataFrame, views, as_of, back_weeks: int = 1,
                  tons_type: str = "double") -> DataFrame:
    """Step 1-2: the big aggregate. One row per (origin classes, Destino,
    flight type if a label uses it, raw Owner) with the week sums."""
    views = _as_list(views)
    sets = _origin_sets(views)
    need_flight = any(v.label.uses_flight_type for v in views)
    anchor, lags, weeks = anchor_value(as_of, back_weeks), views[0].lag_weeks, views[0].weeks
    rows = base.where(scan_predicate_sql(views)).selectExpr(
        f"{R.destination_sql()} AS Destino",
        *[f"{rs.sql()} AS _o{i}" for i, rs in enumerate(sets)],
        *(["`TipoVuelo`"] if need_flight else []),
        "`Owner`", "`Tons`", "`RelWeek`")
    keys = ["Destino", *[f"_o{i}" for i in range(len(sets))],
            *(["TipoVuelo"] if need_flight else []), "Owner"]
    return lagged_pivot(rows, keys, anchor, lags, weeks, tons_type)


def group_rows(base: DataFrame, views, as_of, back_weeks: int = 1,
               tons_type: str = "double") -> DataFrame:
    """Step 3: ``view, Grupo, Owner, W..Wm4`` (the pivoted carriers per
    group, A1-A2) for every view, from one scan."""
    views = _as_list(views)
    sets = _origin_sets(views)
    weeks = week_columns(views[0].weeks)
    classes = route_classes(base, views, as_of, back_weeks, tons_type)
    flight = "`TipoVuelo`" if "TipoVuelo" in classes.columns else "CAST(NULL AS STRING)"
    trim = f"trim(BOTH {lit(UNICODE_WHITE_SPACE)} FROM `Owner`) AS Owner"

    def label(v: ViewSpec):
        origin = f"_o{sets.index(v.origin)}"
        return v.in_view_sql(origin, "`Destino`"), v.label.sql(origin, "`Destino`", flight)

    if len(views) == 1:
        keep, grupo = label(views[0])
        labelled = classes.where(keep).selectExpr(
            f"{lit(views[0].name)} AS view", f"{grupo} AS Grupo", trim, *weeks)
    else:
        # Grupo may be NULL (N2), so membership travels as its own flag.
        entries = []
        for v in views:
            keep, grupo = label(v)
            entries.append(f"named_struct('view', {lit(v.name)}, 'Grupo', {grupo}, 'keep', {keep})")
        labelled = (classes
                    .selectExpr(f"explode(array({', '.join(entries)})) AS e", "`Owner`", *weeks)
                    .where("e.keep")
                    .selectExpr("e.view AS view", "e.Grupo AS Grupo", trim, *weeks))
    # One hash partitioning by group label serves the re-sum below, every
    # later window and aggregate (all keyed by view and group) and the
    # report's cross-view deduplication; the rows are few (route classes x
    # carriers), and a label's rows from all views are only a few times that.
    return resum(labelled.repartition("Grupo"), ["view", "Grupo", "Owner"], views[0].weeks)


def _threshold_sql(views: list[ViewSpec]) -> str:
    if len(views) == 1:
        return views[0].threshold_sql("`Grupo`")
    arms = " ".join(f"WHEN `view` = {lit(v.name)} THEN {v.threshold_sql('`Grupo`')}" for v in views)
    return f"(CASE {arms} END)"


def bucketed_rows(base: DataFrame, views, as_of, back_weeks: int = 1,
                  tons_type: str = "double") -> DataFrame:
    """Group rows with ``OwnerGrpd``, ``cls`` and ``rn``."""
    views = _as_list(views)
    rows = group_rows(base, views, as_of, back_weeks, tons_type)
    return bucket_topn(rows, PART, _threshold_sql(views), views[0].home, views[0].others)


def market_share(base: DataFrame, views, as_of, back_weeks: int = 1,
                 tons_type: str = "double") -> DataFrame:
    """Market-share report rows.

    ``views`` is one ``ViewSpec`` (result: the 14 report columns) or several
    (result: ``view`` plus the 14 columns, all from one scan of ``base``).
    ``as_of`` (a date) fixes the calendar; ``back_weeks`` picks the newest
    week. A decimal ``tons_type`` sums exactly (results are still reported as
    doubles); see ``operators.pivot`` for its range and rounding.
    """
    single = isinstance(views, ViewSpec)
    views = _as_list(views)
    weeks = views[0].weeks
    bucketed = bucketed_rows(base, views, as_of, back_weeks, tons_type)
    ranked = collapse_buckets(bucketed, PART, weeks)
    shared = share_of_group(ranked, PART, weeks)
    cols = [f"{REPORT_KEY_SQL} AS excelKEY"] + [
        f"CAST({ident(c)} AS DOUBLE) AS {ident(c)}" if c in week_columns(weeks) else ident(c)
        for c in report_columns(weeks)[1:]]
    return shared.selectExpr(*cols) if single else shared.selectExpr("`view`", *cols)


def classified_rows(base: DataFrame, view: ViewSpec) -> DataFrame:
    """Base rows one view keeps, with ``Origen``, ``Destino`` and ``Grupo``
    (P3-P7, F1, F2). Row level, for inspection; the report path classifies
    inside its first aggregate instead."""
    rows = base.selectExpr("*", f"{view.origin.sql()} AS Origen", f"{R.destination_sql()} AS Destino")
    return rows.where(view.in_view_sql()).selectExpr("*", f"{view.label.sql()} AS Grupo")
