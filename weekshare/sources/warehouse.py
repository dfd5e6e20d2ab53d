"""The base fact table in the warehouse.

Each weekly run replaces the whole table. By default the table is
unpartitioned (the reports read every week, N5), but rows are clustered
within each file by destination so that the Parquet min/max statistics let
the reports' pushed destination filter skip row groups of untracked
destinations.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.sqltext import ident, lit
from .files import Files
from .schema import BASE_COLUMNS, BASE_SCHEMA

CLUSTER_COLUMNS = ("PaisDestinoAWB", "PostaDestinoAWB")


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _quoted(table: str) -> str:
    """A dotted name, quoted part by part."""
    return ".".join(ident(p.strip("`")) for p in table.split("."))


def ensure_table(spark: SparkSession, table: str) -> None:
    """Create the table if missing (S5); a no-op for a path target."""
    if _is_path(table):
        return
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in BASE_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({cols}) USING parquet")


def _table_folder(spark: SparkSession, table: str) -> str:
    """Where the catalog says the table's files are. The entry must be a plain
    Parquet table with the base columns: another one is not ours to replace."""
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").collect()}
    if detail.get("Provider", "").lower() != "parquet" or "# Partition Information" in detail \
            or spark.table(_quoted(table)).schema != BASE_SCHEMA:
        raise ValueError(f"{table} is no unpartitioned Parquet table with the base table's columns")
    return detail["Location"]


def save_base(df: DataFrame, target: str, cluster: bool = True) -> None:
    """Replace the table or Parquet folder with ``df``.

    The write does not shuffle: a hot week, even a third of all rows, stays
    spread over the tasks that read it. A lost executor only re-runs its
    tasks. The rows are written beside the old ones; when they are complete,
    a folder is swapped in, and a table's catalog entry is pointed to them. So
    a failed load leaves the old table as it was, for a table name too.
    """
    spark = df.sparkSession
    out = df.select(*BASE_COLUMNS)
    if cluster:
        out = out.sortWithinPartitions(*CLUSTER_COLUMNS)
    by_name = not _is_path(target)
    if by_name:
        ensure_table(spark, target)
        old = _table_folder(spark, target)
    else:
        old = target.rstrip("/")
    files = Files(spark, old)
    new = f"{_without_run(old) if by_name else old}.new-{uuid.uuid4().hex}"
    try:
        out.write.parquet(new)
        if not by_name:
            files.swap(new, old)
            return
        spark.sql(f"ALTER TABLE {_quoted(target)} SET LOCATION {lit(new)}")
        spark.catalog.refreshTable(_quoted(target))
    except BaseException:
        files.remove(new)
        raise
    files.remove(old)


def _without_run(folder: str) -> str:
    """The table's own folder name, without the mark of the run that wrote it."""
    return folder.rstrip("/").split(".new-")[0]


def read_base(spark: SparkSession, source: str) -> DataFrame:
    """Scan the base table (S7); a dotted name is quoted part by part."""
    if _is_path(source):
        return spark.read.schema(BASE_SCHEMA).parquet(source)
    return spark.table(_quoted(source))
