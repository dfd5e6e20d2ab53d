"""Schemas of the source export, the base fact table and the report."""

from __future__ import annotations

from pyspark.sql import types as T

# Base table columns, in load order (the export has the first
# twelve, matched by position; RelWeek is derived at load).
BASE_COLUMNS = (
    "Year", "Semana", "RegionOrigenAWB", "RegionOrigenSegmento", "ZonaOrigenAWB",
    "PaisOrigenAWB", "PaisOrigenSegmento", "PaisDestinoAWB", "PostaDestinoAWB",
    "TipoVuelo", "Owner", "Tons", "RelWeek",
)
EXPORT_COLUMNS = BASE_COLUMNS[:-1]

_LONG = {"Year", "Semana", "RelWeek"}
_DOUBLE = {"Tons"}


def _type(name: str) -> T.DataType:
    if name in _LONG:
        return T.LongType()
    if name in _DOUBLE:
        return T.DoubleType()
    return T.StringType()


BASE_SCHEMA = T.StructType([T.StructField(c, _type(c), True) for c in BASE_COLUMNS])
EXPORT_SCHEMA = T.StructType([T.StructField(c, _type(c), True) for c in EXPORT_COLUMNS])

# The export is first read as text, so that preamble rows can be recognised
# and counted instead of silently parsed as data.
EXPORT_TEXT_SCHEMA = T.StructType(
    [T.StructField(f"_c{i}", T.StringType(), True) for i in range(len(EXPORT_COLUMNS))])

# Cleaned header names the loader relies on, by position
# (year, week, carrier). The rest of the original header is not known.
EXPECTED_HEADER = {0: "Año", 1: "Semana", 10: "Owner"}


def week_columns(weeks: int = 5) -> list[str]:
    """``W, Wm1, ..., Wm{weeks-1}``: newest week first."""
    return ["W"] + [f"Wm{i}" for i in range(1, weeks)]


def share_columns(weeks: int = 5) -> list[str]:
    return [f"{c}r" for c in week_columns(weeks)]


def report_columns(weeks: int = 5) -> list[str]:
    return ["excelKEY", "Rank", "Grupo", "OwnerGrpd", *share_columns(weeks), *week_columns(weeks)]


REPORT_COLUMNS = tuple(report_columns())
REPORT_SCHEMA = T.StructType([
    T.StructField(c, T.LongType() if c == "Rank" else
                  T.StringType() if c in ("excelKEY", "Grupo", "OwnerGrpd") else T.DoubleType(), True)
    for c in REPORT_COLUMNS])
