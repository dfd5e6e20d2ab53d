"""Report files (C7-C9): views appended, whole-row duplicates removed, CSV.

A report is one or two views. All requested reports come from one scan of
the base table: the views are computed together, each row is tagged with its
report and part (0: first view, 1: second), and one small aggregate keeps
one copy of each whole row with the first part it occurs in (U2, U3). Rows
of the first view come first in the file, then rows of the second that are
not an exact copy of a row already written; inside each part rows are
ordered by group and rank (O1). The order is applied only at the sink.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import DateLike
from ..functions.sqltext import ident, lit
from ..operators.share import format_report
from ..sources.files import Files
from ..sources.schema import REPORT_COLUMNS, REPORT_SCHEMA
from .market_share import market_share
from .views import AWB, AWB_SAO, FEEDER, GATEWAY, GATEWAY_SAO

# Report files and the views they hold, in append order.
REPORTS = {
    "awb": ("dfWeekAWB", (AWB, AWB_SAO)),
    "feeder": ("dfWeekFeeder", (FEEDER,)),
    "gateway": ("dfWeekGTWY", (GATEWAY, GATEWAY_SAO)),
}


def report_rows(base: DataFrame, names, as_of: DateLike, back_weeks: int = 1,
                tons_type: str = "double") -> DataFrame:
    """``report, part`` plus the 14 report columns for the named reports,
    from one scan of ``base``. With fractional tons, a decimal ``tons_type``
    makes the sums of the two views of a report bit-identical, so shared
    rows always deduplicate (N22)."""
    names = list(names)
    views, tag = [], {}
    for name in names:
        for part, v in enumerate(REPORTS[name][1]):
            if v.name in tag:
                raise ValueError(f"view {v.name} is in two requested reports")
            views.append(v)
            tag[v.name] = (name, part)
    rows = market_share(base, views, as_of, back_weeks, tons_type)
    report_of = " ".join(f"WHEN {lit(v)} THEN {lit(r)}" for v, (r, _) in tag.items())
    part_of = " ".join(f"WHEN {lit(v)} THEN {p}" for v, (_, p) in tag.items())
    tagged = rows.selectExpr(f"CASE `view` {report_of} END AS report",
                             f"CASE `view` {part_of} END AS part",
                             *[ident(c) for c in REPORT_COLUMNS])
    # Grouping treats NULL = NULL and NaN = NaN, as whole-row deduplication does.
    return tagged.groupBy("report", *REPORT_COLUMNS).agg(F.min("part").alias("part"))


def report(base: DataFrame, name: str, as_of: DateLike, back_weeks: int = 1,
           tons_type: str = "double") -> DataFrame:
    """One report's rows with its ``part`` ordinal."""
    return report_rows(base, [name], as_of, back_weeks, tons_type).drop("report")


def write_reports(base: DataFrame, out_dir: str, as_of: DateLike, back_weeks: int = 1,
                  names=None, tons_type: str = "double") -> dict[str, str]:
    """Write the report files in one job; returns ``{report: path}``.

    Each report is one CSV file ``<out_dir>/<file name>.csv`` with a header and
    no index column, replaced on every run: a report without rows is a file
    with the header alone. NaN shares are empty fields. A report is small
    (groups x shown carriers), so each is written by one task.

    The job writes to its own folder beside the targets and each file is
    swapped in by renames (``Files.swap``), so no reader finds a report missing for
    longer than a rename takes; the folder is removed whatever happens. Nothing else in
    ``out_dir`` (such as the workbook) is touched.
    """
    spark = base.sparkSession
    names = list(names or REPORTS)
    rows = report_rows(base, names, as_of, back_weeks, tons_type)
    file_of = " ".join(f"WHEN {lit(n)} THEN {lit(REPORTS[n][0])}" for n in names)
    out = (format_report(rows)
           .withColumn("report", F.expr(f"CASE `report` {file_of} END"))
           .repartition("report")
           .sortWithinPartitions("report", "part", "Grupo", "Rank")
           .select("report", *REPORT_COLUMNS))
    root = out_dir.rstrip("/")
    staging = f"{root}/_weekshare_reports_{uuid.uuid4().hex}"
    fs = Files(spark, root)
    try:
        _csv(out.write.partitionBy("report"), staging)
        written = {}
        for n in names:
            name = REPORTS[n][0]
            part = fs.only_file(f"{staging}/report={name}", ".csv")
            if part is None:                     # no rows: the header alone
                _csv(out.where("false").drop("report").coalesce(1).write, f"{staging}/empty_{name}")
                part = fs.only_file(f"{staging}/empty_{name}", ".csv")
            written[n] = f"{root}/{name}.csv"
            fs.swap(part, written[n])
        return written
    finally:
        fs.remove(staging)


def read_report_files(spark: SparkSession, written: dict[str, str]) -> DataFrame:
    """Report files back as rows: ``report``, ``line`` (1 after the header) and
    the report columns; an empty field is NULL.

    A file's lines are numbered by place; a report is small (groups x shown
    carriers), so one window per file is."""
    out = None
    for name, path in written.items():
        rows = (spark.read.schema(REPORT_SCHEMA).option("header", True).option("enforceSchema", False)
                .csv(path)
                .selectExpr("*", "_metadata.file_block_start AS block", "monotonically_increasing_id() AS at"))
        line = F.row_number().over(Window.partitionBy("report").orderBy("block", "at"))
        rows = rows.withColumn("report", F.lit(name)).select("report", line.alias("line"), *REPORT_COLUMNS)
        out = rows if out is None else out.unionByName(rows)
    return out


def _csv(writer, path: str) -> None:
    (writer.option("header", True)
     .option("nullValue", "")
     .option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))
