"""Weekly source export -> base fact table (C6: S1-S4, P11, T4, D5).

An export is one CSV snapshot: preamble lines, a header row, then data rows
with twelve cells matched by position. It may come as a declared list of
parts, each with its own preamble and header. A load is exact or refused:

* one pass reads the cells as text, types them, marks every row and writes
  the result to the shared folder;
* a small aggregate over the marks of that table gives one summary row per
  file; any file with a fault (no or a second header, stray rows among the
  data, cells that do not fit the declared types, short or long rows, weeks
  that do not exist) refuses the whole load with the counts;
* otherwise the same table, read back, is the base table's rows; its folder
  belongs to the caller, who removes it when the rows are saved.

Nothing is parsed twice and no unfit cell becomes NULL unnoticed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.calendar import DateLike, rel_week_sql, weeks_in_year_sql
from ..functions.sqltext import ident, lit
from ..functions.text import CARRIER_RECODE, clean_header_sql
from ..session import shared_dir
from .files import Files
from .schema import BASE_COLUMNS, BASE_SCHEMA, EXPECTED_HEADER, EXPORT_COLUMNS, EXPORT_TEXT_SCHEMA

CELLS = [f"_c{i}" for i in range(len(EXPORT_COLUMNS))]
# Faults of a file, in the order they are reported.
FAULTS = ("header_missing", "second_header", "stray_rows", "malformed_rows", "unfit_week",
          "unfit_tons", "invalid_weeks")


class ExportFormatError(ValueError):
    """The export cannot be loaded exactly. ``failures`` (one row per failing
    file, see ``export_summary``) has the counts."""

    def __init__(self, message: str, failures: list[Row] | None = None):
        super().__init__(message)
        self.failures = failures


@dataclass
class Load:
    """One loaded snapshot: the base table's rows, and the staged folder they
    are read from. Whoever holds it owns the folder: ``release`` it (or leave
    the ``with`` block) once the rows are saved."""

    base: DataFrame
    folder: str

    def release(self) -> None:
        Files(self.base.sparkSession, self.folder).remove(self.folder)

    def __enter__(self) -> Load:
        return self

    def __exit__(self, *_) -> None:
        self.release()


# The grammar of a number cell: nothing that only a programming language takes
# for a number (type suffixes, hexadecimal, names of infinity) is one.
NUMBER = "^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *$"
WHOLE = "^ *[+-]?[0-9]+([.]0*)? *$"


def long_sql(cell: str) -> str:
    """A whole number, also in the form ``12.0`` that spreadsheets write; else NULL."""
    return (f"CASE WHEN {cell} RLIKE {lit(WHOLE)} "
            f"THEN try_cast(split_part(trim({cell}), '.', 1) AS BIGINT) END")


def decimal_sql(cell: str, decimal_mark: str = ".") -> str:
    """A finite number with the declared decimal mark and no other marks, or the
    spreadsheet's ``NaN``; else NULL."""
    if decimal_mark not in (".", ","):
        raise ValueError(f"decimal_mark must be '.' or ',', got {decimal_mark!r}")
    text = cell if decimal_mark == "." else f"translate({cell}, ',.', '.,')"
    number = f"try_cast({text} AS DOUBLE)"
    return (f"CASE WHEN {text} RLIKE {lit(NUMBER)} THEN "
            f"CASE WHEN abs({number}) < CAST('Infinity' AS DOUBLE) THEN {number} END "
            f"WHEN trim({cell}) = 'NaN' THEN CAST('NaN' AS DOUBLE) END")


def read_export_text(spark: SparkSession, path: str | list[str],
                     encoding: str = "UTF-8") -> DataFrame:
    """All rows as text cells, with their file, their place in it (``_at``) and
    the raw line of rows with more or fewer cells (``_line``).

    ``encoding`` is the files' character set. Spreadsheet CSV exports are
    often Windows-1252; ``ISO-8859-1`` reads their letters (such as "ñ" in
    "Año") the same way, and it is one of the charsets Spark's CSV reader
    accepts. A quote inside a quoted cell is doubled, as spreadsheets write
    it (RFC 4180); backslashes are ordinary characters.
    """
    return (spark.read.schema(StructType([*EXPORT_TEXT_SCHEMA.fields, StructField("_line", StringType())]))
            .option("header", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_line")
            .option("encoding", encoding).option("quote", '"').option("escape", '"')
            .csv(path)
            .selectExpr(*CELLS, "_line", "_metadata.file_path AS _file",
                        "struct(_metadata.file_block_start AS block, "
                        "monotonically_increasing_id() AS row) AS _at"))


def mark_rows(text: DataFrame, decimal_mark: str = ".") -> DataFrame:
    """Typed export rows with marks: ``_kind`` (data, header, other) and, for
    data rows, ``_unfit_week``, ``_unfit_tons``, ``_malformed``.

    A row is data when its first cell is a year. The header is the row whose
    cleaned names fit and whose cells are all filled (S2).
    """
    header = " AND ".join([f"{clean_header_sql(f'_c{i}')} = {lit(name)}" for i, name in EXPECTED_HEADER.items()]
                          + [f"coalesce({c}, '') != ''" for c in CELLS])
    year, week, tons = long_sql("_c0"), long_sql("_c1"), decimal_sql("_c11", decimal_mark)
    typed = {"Year": year, "Semana": week, "Tons": tons}
    return text.selectExpr(
        *[f"{typed.get(name, cell)} AS {ident(name)}" for cell, name in zip(CELLS, EXPORT_COLUMNS)],
        "_file", "_at",
        f"CASE WHEN {year} IS NOT NULL THEN 'data' WHEN coalesce({header}, FALSE) THEN 'header' "
        "ELSE 'other' END AS _kind",
        f"trim(coalesce(_c1, '')) != '' AND {week} IS NULL AS _unfit_week",
        f"trim(coalesce(_c11, '')) != '' AND ({tons}) IS NULL AS _unfit_tons",
        "_line IS NOT NULL AS _malformed")


def export_summary(marked: DataFrame) -> DataFrame:
    """One row per file (D5): ``_file``, counts of data and reject rows, one
    count per fault, and ``ok``.

    Rows before the header that are no data are the preamble, however many
    there are (blank lines included). Any other row that is neither data nor
    the header is a stray row, and so is data before the header.
    """
    data, other, head = "_kind = 'data'", "_kind = 'other'", "_kind = 'header'"
    per_file = marked.groupBy("_file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"count_if({data})").alias("data_rows"),
        F.expr(f"count_if(NOT {data})").alias("rejects"),
        F.expr(f"count_if({head})").alias("headers"),
        F.expr(f"min(_at) FILTER (WHERE {head})").alias("head"),
        F.expr(f"max(_at) FILTER (WHERE {other})").alias("last_other"),
        F.expr(f"min(_at) FILTER (WHERE {data})").alias("first_data"),
        F.expr(f"count_if({data} AND _malformed)").alias("malformed_rows"),
        F.expr(f"count_if({data} AND _unfit_week)").alias("unfit_week"),
        F.expr(f"count_if({data} AND _unfit_tons)").alias("unfit_tons"),
        F.expr(f"count_if({data} AND NOT _unfit_week AND NOT coalesce("
               f"Semana BETWEEN 1 AND {weeks_in_year_sql('Year')}, FALSE))").alias("invalid_weeks"))
    faults = per_file.selectExpr(
        "_file", "rows", "data_rows", "rejects",
        "CAST(headers = 0 AS BIGINT) AS header_missing",
        "greatest(headers - 1, 0) AS second_header",
        "CAST(coalesce(last_other > head, FALSE) AS BIGINT) "
        "+ CAST(coalesce(first_data < head, FALSE) AS BIGINT) AS stray_rows",
        "malformed_rows", "unfit_week", "unfit_tons", "invalid_weeks")
    return faults.withColumn("ok", F.expr(" + ".join(FAULTS) + " = 0"))


def refuse_faults(summary: DataFrame, one_file: bool) -> None:
    """Raise if a file has a fault, or if an undeclared second file is there.
    One row of totals reaches the driver, and of a refused snapshot one row per
    failing part."""
    totals = summary.agg(F.count(F.lit(1)).alias("files"), F.expr("count_if(NOT ok)").alias("failing"),
                         *[F.sum(f).alias(f) for f in FAULTS]).first()
    if totals["files"] == 0:
        raise ExportFormatError("the export holds no rows")
    if totals["failing"]:
        counts = {f: totals[f] for f in FAULTS if totals[f]}
        raise ExportFormatError(f"{totals['failing']} export file(s) cannot be loaded exactly: {counts}",
                                summary.where("NOT ok").collect())
    if one_file and totals["files"] > 1:
        raise ExportFormatError(f"{totals['files']} files found: an export is one snapshot; "
                                "name its parts as a list")


def prepare_base(export: DataFrame, as_of: DateLike,
                 carrier_recode: dict[str, str] = CARRIER_RECODE) -> DataFrame:
    """Export rows -> base table rows (C6 body).

    Carrier codes are recoded on the raw, still padded value (N14); NaN tons
    become NULL (N11); ``RelWeek`` is computed from one explicit ``as_of``
    date, never from the clock (N20).
    """
    cols = []
    for field in BASE_SCHEMA.fields:
        name = ident(field.name)
        if field.name == "Owner":
            arms = " ".join(f"WHEN {name} = {lit(a)} THEN {lit(b)}" for a, b in carrier_recode.items())
            expr = f"CASE {arms} ELSE {name} END" if arms else name
        elif field.name == "Tons":
            expr = f"CASE WHEN isnan(CAST({name} AS DOUBLE)) THEN NULL ELSE {name} END"
        elif field.name == "RelWeek":
            expr = rel_week_sql("`Semana`", "`Year`", as_of)
        else:
            expr = name
        cols.append(f"CAST({expr} AS {field.dataType.simpleString()}) AS {name}")
    return export.selectExpr(*cols)


def load_base(spark: SparkSession, path: str | list[str], as_of: DateLike,
              encoding: str = "UTF-8", decimal_mark: str = ".") -> Load:
    """Read one export snapshot into base-table rows (C6), or refuse it.

    ``path`` is one file (or a folder holding one), or the list of the
    snapshot's parts. Two snapshots are never added up. The rows are staged in
    a folder that belongs to the result; a refused load leaves none behind.
    """
    marked = mark_rows(read_export_text(spark, path, encoding), decimal_mark)
    folder = shared_dir(spark, f"export-{uuid.uuid4().hex}")
    rows = spark.read.schema(marked.schema)
    try:
        marked.write.parquet(folder)
        refuse_faults(export_summary(rows.parquet(folder)), one_file=isinstance(path, str))
    except BaseException:
        Files(spark, folder).remove(folder)
        raise
    base = prepare_base(rows.parquet(folder).where("_kind = 'data'"), as_of)
    return Load(base.select(*BASE_COLUMNS), folder)
