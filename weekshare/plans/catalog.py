"""Registered queries: one per operator group of the inventory.

Each takes ``(spark, sf_dir)``, reads the driver's tables under ``sf_dir``,
derives the export and base table from them (FIXTURES.md §4) and returns a
DataFrame; ``weekshare.oracle.ORACLE`` holds the DuckDB statement of each.
All run over the whole tables. Shares go through ``format_report`` (NaN as
NULL), the form the report files carry.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.calendar import (anchor_week, expected_week_sql, iso_year, rel_week,
                                  week_monday_sql, weeks_in_year, year_delta)
from ..functions.text import recode, unicode_trim
from ..operators.collapse import collapse_buckets
from ..operators.share import format_report
from ..sources.export import export_summary, mark_rows, prepare_base
from ..sources.fixture import export_from_tables, rendered_export
from ..session import shared_dir
from ..sources.schema import REPORT_COLUMNS, share_columns, week_columns
from ..sources.warehouse import ensure_table, read_base, save_base
from . import quality
from .market_share import (PART, bucketed_rows, classified_rows, group_rows,
                           market_share)
from .reports import REPORTS, read_report_files, report, write_reports
from .views import AWB, FEEDER, GATEWAY, VIEWS

# Fixed calendar of the checks: the test data's ship dates end in 2001-11,
# so this date puts the five reported weeks inside the data.
AS_OF = "2001-06-15"
BACK_WEEKS = 1

ALL = list(VIEWS.values())


def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_from_tables(spark, sf_dir)


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_base(export_from_tables(spark, sf_dir), AS_OF)


def q_export_parse(spark, d):
    return (mark_rows(rendered_export(spark, d)).where("_kind = 'data'")
            .select("_file", "Year", "Semana", "PostaDestinoAWB", "TipoVuelo", "Owner", "Tons",
                    "_unfit_week", "_unfit_tons", "_malformed"))


def q_export_rejects(spark, d):
    return export_summary(mark_rows(rendered_export(spark, d)))


def _count(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


# --- scans, calendar, cleaning -------------------------------------------

def q_base_scan(spark, d):
    return base(spark, d)


def q_weeks_in_year(spark, d):
    return (base(spark, d).select("Year").distinct()
            .select("Year", weeks_in_year("Year").alias("weeks")))


def q_year_delta(spark, d):
    return (base(spark, d).select("Year").distinct()
            .select("Year", iso_year(AS_OF).alias("current_year"),
                    year_delta("Year", AS_OF).alias("delta")))


def q_relative_week(spark, d):
    return (export(spark, d).select("Year", "Semana").distinct()
            .select("Year", "Semana", rel_week("Semana", "Year", AS_OF).alias("RelWeek"),
                    anchor_week(AS_OF, BACK_WEEKS).alias("anchor_week")))


def q_owner_clean(spark, d):
    return (export(spark, d).select("Owner").distinct()
            .select("Owner", unicode_trim(recode("Owner")).alias("OwnerClean")))


# --- classification ------------------------------------------------------

def q_origin_awb(spark, d):
    return _count(base(spark, d).withColumn("Origen", AWB.origin_column()),
                  "RegionOrigenAWB", "Origen")


def q_origin_gateway(spark, d):
    return _count(base(spark, d).withColumn("Origen", GATEWAY.origin_column()),
                  "RegionOrigenSegmento", "RegionOrigenAWB", "PaisOrigenSegmento",
                  "PaisOrigenAWB", "Origen")


def q_origin_feeder(spark, d):
    return _count(base(spark, d).withColumn("Origen", FEEDER.origin_column()),
                  "ZonaOrigenAWB", "RegionOrigenAWB", "PaisOrigenAWB", "Origen")


def q_destination(spark, d):
    return _count(base(spark, d).withColumn("Destino", R.destination()),
                  "PaisDestinoAWB", "PostaDestinoAWB", "Destino")


def _label(view_name):
    def q(spark, d):
        rows = classified_rows(base(spark, d), VIEWS[view_name])
        return _count(rows, "Origen", "Destino", "TipoVuelo", "Grupo")
    q.__name__ = f"q_label_{view_name}"
    return q


def q_tracked_rows(spark, d):
    # One pass with a conditional count per view, then the single row is
    # unpivoted: no per-row expansion of the facts.
    b = base(spark, d).selectExpr(f"{R.destination_sql()} AS Destino",
                                  *[f"{v.origin.sql()} AS o_{v.name}" for v in ALL])
    counts = b.selectExpr(*[f"count_if({v.in_view_sql(f'o_{v.name}')}) AS n_{v.name}" for v in ALL])
    pairs = ", ".join(f"'{v.name}', n_{v.name}" for v in ALL)
    return counts.selectExpr(f"stack({len(ALL)}, {pairs}) AS (view, n)")


# --- pivot, top-N, branches, shares ----------------------------------------

def q_lagged_pivot(spark, d):
    return group_rows(base(spark, d), ALL, AS_OF, BACK_WEEKS)


def q_owners_present(spark, d):
    return quality.owners_present(base(spark, d))


def _topn(view_name):
    def q(spark, d):
        rows = bucketed_rows(base(spark, d), VIEWS[view_name], AS_OF, BACK_WEEKS)
        return rows.where(F.col("cls") != 0).select("Grupo", "Owner", "W", "rn", "OwnerGrpd")
    return q


def _ranked(spark, d):
    return collapse_buckets(bucketed_rows(base(spark, d), ALL, AS_OF, BACK_WEEKS), PART)


def _branch(test):
    def q(spark, d):
        return _ranked(spark, d).where(test(F.col("Rank"))).select(
            "view", "Rank", "Grupo", "OwnerGrpd", *week_columns())
    return q


def q_three_branch_union(spark, d):
    # All three branches from one pass; the literal union is in tests/.
    return _ranked(spark, d).select("view", "Rank", "Grupo", "OwnerGrpd", *week_columns())


def q_share_of_group(spark, d):
    rows = market_share(base(spark, d), ALL, AS_OF, BACK_WEEKS)
    return format_report(rows.select("view", "Grupo", "OwnerGrpd", *share_columns()))


def q_report_key(spark, d):
    rows = market_share(base(spark, d), ALL, AS_OF, BACK_WEEKS)
    return rows.select("view", "excelKEY", "Rank", "Grupo")


# --- views and reports ------------------------------------------------------

def _view(view_name):
    def q(spark, d):
        return format_report(market_share(base(spark, d), VIEWS[view_name], AS_OF, BACK_WEEKS))
    return q


def q_all_views(spark, d):
    return format_report(market_share(base(spark, d), ALL, AS_OF, BACK_WEEKS))


def _report(name):
    def q(spark, d):
        return format_report(report(base(spark, d), name, AS_OF, BACK_WEEKS)
                             .select(*REPORT_COLUMNS))
    return q


# --- sinks ---------------------------------------------------------------------

def q_base_roundtrip(spark, d):
    """The base table created by name, replaced by all rows, and scanned."""
    table = f"weekshare_base_{uuid.uuid4().hex}"
    ensure_table(spark, table)
    save_base(base(spark, d), table)
    return read_base(spark, table)


def q_report_file(spark, d):
    """The three report files as written, line by line in their order."""
    written = write_reports(base(spark, d), shared_dir(spark, f"reports-{uuid.uuid4().hex}"), AS_OF, BACK_WEEKS)
    return read_report_files(spark, written)


# --- quality -------------------------------------------------------------------

def q_latest_week(spark, d):
    return quality.latest_week(base(spark, d), AS_OF, BACK_WEEKS)


def q_lagged_weeks(spark, d):
    return quality.lagged_weeks(base(spark, d))


def q_bad_weeks(spark, d):
    # Over the rendered export, whose rows hold weeks that do not exist.
    rows = mark_rows(rendered_export(spark, d)).where("_kind = 'data'")
    return quality.bad_weeks(prepare_base(rows, AS_OF))


def q_week_validity(spark, d):
    return quality.week_validity(base(spark, d))


def q_expected_week(spark, d):
    year, week = expected_week_sql("run_date", BACK_WEEKS)
    return (base(spark, d).select("Year", "Semana").distinct()
            .selectExpr("Year", "Semana", f"{week_monday_sql('Semana', 'Year')} AS run_date")
            .selectExpr("Year", "Semana", "CAST(run_date AS STRING) AS run_date",
                        f"{year} AS expected_year", f"{week} AS expected_week"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "base_scan": q_base_scan,
    "export_parse": q_export_parse,
    "export_rejects": q_export_rejects,
    "weeks_in_year": q_weeks_in_year,
    "year_delta": q_year_delta,
    "relative_week": q_relative_week,
    "owner_clean": q_owner_clean,
    "origin_awb": q_origin_awb,
    "origin_gateway": q_origin_gateway,
    "origin_feeder": q_origin_feeder,
    "destination": q_destination,
    **{f"label_{name}": _label(name) for name in VIEWS},
    "tracked_rows": q_tracked_rows,
    "lagged_pivot": q_lagged_pivot,
    "owners_present": q_owners_present,
    "topn_others": _topn("gateway"),
    "topn_by_group": _topn("feeder"),
    "home_split": _branch(lambda r: r == 0),
    "tail_bucket": _branch(lambda r: r == 99),
    "rank_over_sum": _branch(lambda r: r.between(1, 98)),
    "three_branch_union": q_three_branch_union,
    "share_of_group": q_share_of_group,
    "report_key": q_report_key,
    **{f"view_{name}": _view(name) for name in VIEWS},
    "all_views": q_all_views,
    **{f"report_{name}": _report(name) for name in REPORTS},
    "base_roundtrip": q_base_roundtrip,
    "report_file": q_report_file,
    "latest_week": q_latest_week,
    "lagged_weeks": q_lagged_weeks,
    "bad_weeks": q_bad_weeks,
    "week_validity": q_week_validity,
    "expected_week": q_expected_week,
}
