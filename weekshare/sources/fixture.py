"""Market export rows derived from the TPC-H-like test tables.

The reporting pipeline reads a weekly fact table of cargo tons by route and
carrier. The test data ships TPC-H-like tables instead, so this module maps
them onto the export's twelve columns (FIXTURES.md §4): every ``lineitem`` row
becomes one export row, its destination from the ordering customer's nation,
its carrier from the part's brand and its origin from the part and supplier
keys. The DuckDB oracle states the same mapping in SQL.

Plan: ``lineitem`` first meets ``part`` and the origin table, whose filters
(no carrier, untracked origins) drop rows before anything is shuffled;
``orders`` meets ``customer`` (keeping one small integer per order); the
surviving rows of both are then joined. Only the columns used are read. The two fact tables are never broadcast: ``lineitem`` joins orders as a
sort-merge join (both sides spill to disk if a partition outgrows memory,
and AQE splits a skewed partition; a hash join could not spill). The
dimension joins are left to Catalyst's size check
(``spark.sql.autoBroadcastJoinThreshold``, re-checked at runtime by AQE): a
small ``customer`` or ``part`` is broadcast, a large one is shuffled. The
25-row origin table is a literal dimension, broadcast (its size is fixed);
as a join, filters on its columns stay above the join instead of being
inlined into the ``lineitem`` scan as lookup expressions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import iso_week_sql, iso_year_sql
from ..functions.sqltext import lit
from ..session import shared_dir
from .export import read_export_text
from .schema import EXPECTED_HEADER, EXPORT_COLUMNS

# Origin lookup by ``l_partkey % 25``: region, zone, country.
ORIGIN_TABLE = (
    ("Europe", "EU_DE", "ALEMANIA"), ("Europe", "EU_ES", "ESPANA"),
    ("Europe", "EU_NL", "PAISES BAJOS"), ("Europe", "EU_IT", "ITALIA"),
    ("Europe", "EU_FR", "FRANCIA"), ("Europe", "EU_BE", "BELGICA"),
    ("Europe", "EU_UK", "REINO UNIDO"), ("Europe", "EU_SE", "SUECIA"),
    ("Europe", "EU_PL", "POLONIA"), ("North America", "NA_USA_Florida", "USA"),
    ("North America", "NA_USA_NewYork", "USA"), ("North America", "NA_USA_West", "USA"),
    ("North America", "NA_USA_Midwest", "USA"), ("North America", "NA_Canada", "CANADA"),
    ("North America", "NA_Mexico", "MEXICO"), ("Asia", "AS_India", "INDIA"),
    ("Asia", "AS_China", "CHINA"), ("Asia", "AS_Japan", "JAPON"),
    ("Asia", None, "COREA"), ("Oceania", "OC", "AUSTRALIA"),
    ("Africa", "AF", "KENIA"), ("Arfica", "AF", "SUDAFRICA"),
    ("South America", "SA", "PERU"), ("Europe", "EU_DK", "DINAMARCA"),
    (None, None, None),
)
# Segment region and country by ``l_suppkey % 5`` (4 -> NULL).
SEGMENT_REGION = ("Europe", "Europe", "North America", "Asia", None)
SEGMENT_COUNTRY = ("ESPANA", "ALEMANIA", "USA", "CHINA", None)
# Destination country and airport by ``c_nationkey % 5``.
DEST_COUNTRY = ("CHILE", "BRASIL", "BRASIL", "PERU", "ARGENTINA")
DEST_AIRPORT = ("SCL", "GRU", "VCP", "LIM", "EZE")
# Carrier codes by part brand.
BRAND_CARRIER = {"Brand#1": "LA ", "Brand#2": "QT ", "Brand#3": None}

# Columns read from the test tables, with their types: an explicit read
# schema skips schema inference and reads nothing else.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_returnflag STRING, l_linestatus STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "part": "p_partkey BIGINT, p_brand STRING",
}


def _pick_sql(values, index: str, default=None) -> str:
    """``values[index]`` for a small constant list, else ``default``."""
    arms = " ".join(f"WHEN {i} THEN CAST({lit(v)} AS STRING)" for i, v in enumerate(values))
    return f"CASE {index} {arms} ELSE CAST({lit(default)} AS STRING) END"


def _carrier_sql(brand: str) -> str:
    arms = " ".join(f"WHEN {brand} = {lit(b)} THEN CAST({lit(c)} AS STRING)"
                    for b, c in BRAND_CARRIER.items())
    return f"CASE {arms} ELSE concat(replace({brand}, 'Brand#', 'B'), ' ') END"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def origin_table(spark: SparkSession) -> DataFrame:
    """The fixed origin lookup as a 25-row DataFrame (a literal relation)."""
    rows = ", ".join(
        f"named_struct('origin_code', {i}, 'RegionOrigenAWB', CAST({lit(r)} AS STRING), "
        f"'ZonaOrigenAWB', CAST({lit(z)} AS STRING), 'PaisOrigenAWB', CAST({lit(p)} AS STRING))"
        for i, (r, z, p) in enumerate(ORIGIN_TABLE))
    return spark.range(1).selectExpr(f"inline(array({rows}))")


def export_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve export columns, one row per ``lineitem`` row that joins."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    part = read_table(spark, sf_dir, "part")

    order_dest = (orders.join(customer, orders.o_custkey == customer.c_custkey)
                  .selectExpr("o_orderkey", "c_nationkey % 5 AS dest_code"))
    rows = (lineitem
            .selectExpr("*", f"CAST(l_partkey % {len(ORIGIN_TABLE)} AS INT) AS origin_code")
            .join(part, lineitem.l_partkey == part.p_partkey)
            .join(origin_table(spark).hint("broadcast"), "origin_code")
            .join(order_dest.hint("merge"), lineitem.l_orderkey == order_dest.o_orderkey))

    ship = "CAST(l_shipdate AS DATE)"
    return rows.selectExpr(
        f"{iso_year_sql(ship)} AS Year",
        f"{iso_week_sql(ship)} AS Semana",
        "RegionOrigenAWB",
        f"{_pick_sql(SEGMENT_REGION, 'l_suppkey % 5')} AS RegionOrigenSegmento",
        "ZonaOrigenAWB",
        "PaisOrigenAWB",
        f"{_pick_sql(SEGMENT_COUNTRY, 'l_suppkey % 5')} AS PaisOrigenSegmento",
        f"{_pick_sql(DEST_COUNTRY[:-1], 'dest_code', DEST_COUNTRY[-1])} AS PaisDestinoAWB",
        f"{_pick_sql(DEST_AIRPORT[:-1], 'dest_code', DEST_AIRPORT[-1])} AS PostaDestinoAWB",
        "CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN CAST(NULL AS STRING) "
        "WHEN l_linestatus = 'O' THEN 'PAX' ELSE 'CAO' END AS TipoVuelo",
        f"{_carrier_sql('p_brand')} AS Owner",
        "CAST(l_quantity AS DOUBLE) AS Tons",
    )


# Tons that are no number, and one per week number in turn.
UNFIT_TONS = ("n/a", "12d", "3F", "0x1p3", "Infinity", "1e400")
# A flight type that needs quoting.
QUOTED_TYPE = 'P "A", X'


# Faults that the rendered files hold, by the last digit of the whole tons: 1
# decimal comma, 2 tons that are no number, 3 a word or a typed literal for a
# week, 4 a week that does not exist, 5 a long line, 6 no header, 7 two headers,
# 8 stray rows, 9 data before the header. Files of digit 0 are clean, and hold
# quoted cells.
def rendered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived export as CSV lines ``name, place, line``: one file per year
    and last digit of the tons, with preamble, header and the faults above.

    The fact table is read once: the first row of each file carries the file's
    preamble and headers, and is exploded into them and itself. As an export
    file is written by one task anyway, so is its window.
    """
    cells = {
        "Year": "CASE WHEN f = 8 AND Semana > 50 THEN 'year' WHEN Semana % 2 = 0 "
                "THEN concat(Year, '.0') ELSE CAST(Year AS STRING) END",
        "Semana": "CASE WHEN f = 3 AND Semana = 51 THEN 'last' WHEN f = 3 AND Semana = 10 THEN '10d' "
                  "WHEN f = 4 AND Semana = 50 THEN '60' ELSE CAST(Semana AS STRING) END",
        "TipoVuelo": f"CASE WHEN f = 0 AND Semana = 7 THEN {lit(QUOTED_TYPE)} ELSE TipoVuelo END",
        "Tons": f"CASE WHEN f = 1 THEN replace(CAST(Tons AS STRING), '.', ',') WHEN f = 2 "
                f"THEN element_at(array({', '.join(map(lit, UNFIT_TONS))}), "
                f"CAST(Semana % {len(UNFIT_TONS)} AS INT) + 1) ELSE CAST(Tons AS STRING) END"}
    quoted = "concat('\"', replace({0}, '\"', '\"\"'), '\"')"
    line = ", ',', ".join(f"CASE WHEN {{0}} RLIKE '[\",]' THEN {quoted} ELSE coalesce({{0}}, '') END".format(c)
                          for c in (f"c{i}" for i in range(len(EXPORT_COLUMNS))))
    names = [EXPECTED_HEADER.get(i, c) for i, c in enumerate(EXPORT_COLUMNS)]
    names[0], names[1] = "1 (A\u00f1o)", " Sem ana&"
    header = lit(",".join(names))
    tops = ", ".join(f"struct({place} AS place, {text} AS line)" for place, text in (
        ("0", "'Market export'"), ("1", "'weekly'"),
        ("CASE f WHEN 6 THEN -1 WHEN 9 THEN 500 ELSE 2 END", header), ("IF(f = 7, 3, -1)", header)))
    first = Window.partitionBy("name").orderBy("Semana")
    return (export_from_tables(spark, sf_dir).withColumn("f", F.expr("CAST(Tons AS INT) % 10"))
            .withColumn("name", F.expr("concat(Year, '-', f, '.csv')"))
            .withColumn("n", F.row_number().over(first))
            .selectExpr("name", "n", "f", "Semana", *[f"{cells.get(c, c)} AS c{i}" for i, c in enumerate(EXPORT_COLUMNS)])
            .selectExpr("name", "n", "f", f"concat({line}, IF(f = 5 AND Semana = 9, ',13th', '')) AS line")
            .selectExpr("name", f"inline(concat(array(struct(100 AS place, line)), IF(n = 1, array({tops}), array())))")
            .where("place >= 0"))


def rendered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered lines as files in the shared folder, read back through the
    export reader: text cells, with the file's name as ``_file``."""
    folder = shared_dir(spark, f"rendered-{uuid.uuid4().hex}")
    (rendered_lines(spark, sf_dir).repartition("name").sortWithinPartitions("name", "place")
     .select("name", "line").write.partitionBy("name").text(folder))
    return read_export_text(spark, folder).withColumn(
        "_file", F.regexp_extract("_file", "name=([^/]+)/", 1))
