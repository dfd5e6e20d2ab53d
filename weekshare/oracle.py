"""DuckDB restatement of every registered query, for the correctness gate.

Written by hand in SQL, independent of the Spark rule data: the driver runs
these next to the Spark queries on the same tables and compares rows,
schemas and values. The base table comes from the driver's tables through
the mapping of FIXTURES.md §4 plus the load steps (carrier recode, NaN tons,
relative week). Rules: ``||`` instead of ``concat()`` (NULL must propagate),
explicit ``NULLS LAST`` and carrier tie-break, ``Rank`` as BIGINT, no
``current_date``; shares are plain division (DuckDB returns inf and nan)
with NaN reported as NULL.
"""

from __future__ import annotations

AS_OF = "2001-06-15"
BACK_WEEKS = 1

ANCHOR = f"(weekofyear(DATE '{AS_OF}') - {BACK_WEEKS})"
CUR_YEAR = f"isoyear(DATE '{AS_OF}')"

EXPORT = """
export AS (
  SELECT isoyear(l_shipdate)::BIGINT AS Year, weekofyear(l_shipdate)::BIGINT AS Semana,
    g.reg AS RegionOrigenAWB,
    CASE l_suppkey % 5 WHEN 0 THEN 'Europe' WHEN 1 THEN 'Europe' WHEN 2 THEN 'North America'
      WHEN 3 THEN 'Asia' ELSE NULL END AS RegionOrigenSegmento,
    g.zona AS ZonaOrigenAWB, g.pais AS PaisOrigenAWB,
    CASE l_suppkey % 5 WHEN 0 THEN 'ESPANA' WHEN 1 THEN 'ALEMANIA' WHEN 2 THEN 'USA'
      WHEN 3 THEN 'CHINA' ELSE NULL END AS PaisOrigenSegmento,
    CASE c_nationkey % 5 WHEN 0 THEN 'CHILE' WHEN 1 THEN 'BRASIL' WHEN 2 THEN 'BRASIL'
      WHEN 3 THEN 'PERU' ELSE 'ARGENTINA' END AS PaisDestinoAWB,
    CASE c_nationkey % 5 WHEN 0 THEN 'SCL' WHEN 1 THEN 'GRU' WHEN 2 THEN 'VCP'
      WHEN 3 THEN 'LIM' ELSE 'EZE' END AS PostaDestinoAWB,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN NULL
      WHEN l_linestatus = 'O' THEN 'PAX' ELSE 'CAO' END AS TipoVuelo,
    CASE WHEN p_brand = 'Brand#1' THEN 'LA ' WHEN p_brand = 'Brand#2' THEN 'QT '
      WHEN p_brand = 'Brand#3' THEN NULL ELSE replace(p_brand, 'Brand#', 'B') || ' ' END AS Owner,
    l_quantity::DOUBLE AS Tons
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
  JOIN (VALUES
    (0,'Europe','EU_DE','ALEMANIA'),(1,'Europe','EU_ES','ESPANA'),(2,'Europe','EU_NL','PAISES BAJOS'),
    (3,'Europe','EU_IT','ITALIA'),(4,'Europe','EU_FR','FRANCIA'),(5,'Europe','EU_BE','BELGICA'),
    (6,'Europe','EU_UK','REINO UNIDO'),(7,'Europe','EU_SE','SUECIA'),(8,'Europe','EU_PL','POLONIA'),
    (9,'North America','NA_USA_Florida','USA'),(10,'North America','NA_USA_NewYork','USA'),
    (11,'North America','NA_USA_West','USA'),(12,'North America','NA_USA_Midwest','USA'),
    (13,'North America','NA_Canada','CANADA'),(14,'North America','NA_Mexico','MEXICO'),
    (15,'Asia','AS_India','INDIA'),(16,'Asia','AS_China','CHINA'),(17,'Asia','AS_Japan','JAPON'),
    (18,'Asia',NULL,'COREA'),(19,'Oceania','OC','AUSTRALIA'),(20,'Africa','AF','KENIA'),
    (21,'Arfica','AF','SUDAFRICA'),(22,'South America','SA','PERU'),(23,'Europe','EU_DK','DINAMARCA'),
    (24,NULL,NULL,NULL)
  ) AS g(oc, reg, zona, pais) ON l_partkey % 25 = g.oc
)"""

BASE = f"""
base AS (
  SELECT Year, Semana, RegionOrigenAWB, RegionOrigenSegmento, ZonaOrigenAWB, PaisOrigenAWB,
    PaisOrigenSegmento, PaisDestinoAWB, PostaDestinoAWB, TipoVuelo,
    CASE WHEN Owner = 'QT ' THEN 'AV ' ELSE Owner END AS Owner,
    CASE WHEN isnan(Tons) THEN NULL ELSE Tons END AS Tons,
    (Semana - (CASE WHEN d < 0 THEN 0 ELSE d END))::BIGINT AS RelWeek
  FROM (SELECT *, datediff('day', date_trunc('week', make_date(Year::INT, 1, 4)),
          date_trunc('week', make_date({CUR_YEAR}::INT, 1, 4))) // 7 AS d FROM export) e
)"""

# The reporting rules below (destination, origins, labels and
# thresholds) must equal the source system's codes and labels.
DESTINO = ("CASE WHEN PaisDestinoAWB IN ('CHILE') THEN PaisDestinoAWB "
           "WHEN PostaDestinoAWB IN ('GRU', 'VCP', 'LIM') THEN PostaDestinoAWB ELSE 'Otros' END")

ORIGIN_AWB = "CASE WHEN RegionOrigenAWB = 'Europe' THEN 'EUR' ELSE 'Otros' END"

ORIGIN_GATEWAY = """CASE
  WHEN RegionOrigenSegmento = 'Europe' AND RegionOrigenAWB IN ('Europe', 'Arfica', 'Asia') THEN 'EUR'
  WHEN RegionOrigenSegmento <> 'Europe' AND RegionOrigenAWB = 'Europe' AND PaisOrigenSegmento <> 'USA' THEN 'EUR'
  WHEN PaisOrigenSegmento = 'USA' OR (PaisOrigenSegmento <> 'USA' AND PaisOrigenAWB = 'USA') THEN 'USA'
  ELSE 'Otros' END"""

ORIGIN_FEEDER = """CASE
  WHEN ZonaOrigenAWB = 'NA_USA_Florida' THEN 'FL'
  WHEN ZonaOrigenAWB IN ('NA_Canada', 'NA_USA_Midwest', 'NA_USA_NorthEast', 'NA_USA_South', 'NA_USA_SouthEast') THEN 'GSA NA'
  WHEN ZonaOrigenAWB = 'NA_USA_NewYork' THEN 'JFK'
  WHEN ZonaOrigenAWB = 'NA_USA_West' THEN 'WEST'
  WHEN ZonaOrigenAWB = 'AS_India' THEN 'INDIA'
  WHEN RegionOrigenAWB = 'Asia' AND ZonaOrigenAWB <> 'AS_India' THEN 'ASIA'
  WHEN PaisOrigenAWB = 'MEXICO' THEN 'MEX'
  WHEN RegionOrigenAWB = 'Oceania' THEN 'OCEANIA'
  WHEN PaisOrigenAWB = 'ALEMANIA' THEN 'DE'
  WHEN PaisOrigenAWB = 'ESPANA' THEN 'ES'
  WHEN PaisOrigenAWB = 'PAISES BAJOS' THEN 'NL'
  WHEN PaisOrigenAWB = 'ITALIA' THEN 'IT'
  WHEN PaisOrigenAWB = 'FRANCIA' THEN 'FR'
  WHEN PaisOrigenAWB = 'BELGICA' THEN 'BE'
  WHEN PaisOrigenAWB = 'REINO UNIDO' THEN 'UK'
  WHEN PaisOrigenAWB IN ('DINAMARCA', 'SUECIA', 'FINLANDIA', 'NORUEGA') THEN 'SK'
  WHEN RegionOrigenAWB = 'Europe' THEN 'OTROS EU'
  ELSE 'Otros' END"""

# Per view: origin CASE, label over (Origen, Destino, TipoVuelo), extra filter,
# competitor threshold over Grupo.
VIEW_SQL = {
    "awb": dict(origin=ORIGIN_AWB, label="Origen || ' - ' || Destino", extra="TRUE",
                threshold="5"),
    "awb_sao": dict(origin=ORIGIN_AWB,
                    label="CASE WHEN Destino IN ('VCP', 'GRU') THEN Origen || ' - SAO' ELSE 'Otros' END",
                    extra="Destino IN ('VCP', 'GRU')", threshold="5"),
    "gateway": dict(origin=ORIGIN_GATEWAY,
                    label="CASE WHEN Destino = 'CHILE' OR (Origen = 'USA' AND Destino = 'LIM') "
                          "THEN Origen || ' - ' || Destino || ' ' || TipoVuelo "
                          "ELSE Origen || ' - ' || Destino END",
                    extra="TRUE", threshold="5"),
    "gateway_sao": dict(origin=ORIGIN_GATEWAY,
                        label="CASE WHEN Destino IN ('VCP', 'GRU') THEN Origen || ' - SAO' "
                              "ELSE Origen || ' - ' || Destino END",
                        extra="TRUE", threshold="5"),
    "feeder": dict(origin=ORIGIN_FEEDER,
                   label="CASE WHEN Origen = 'FL' AND Destino = 'CHILE' AND TipoVuelo = 'PAX' "
                         "THEN 'FL - CHILE PAX' ELSE Origen || ' - ' || Destino END",
                   extra="TRUE",
                   threshold="CASE WHEN Grupo NOT LIKE 'ASIA%' THEN 5 ELSE 10 END"),
}

WEEKS = ["W", "Wm1", "Wm2", "Wm3", "Wm4"]
SHARES = [f"{w}r" for w in WEEKS]
REPORT = "excelKEY, Rank, Grupo, OwnerGrpd, " + ", ".join(SHARES) + ", " + ", ".join(WEEKS)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join([EXPORT, BASE, *ctes]) + "\n"


def _week_sums() -> str:
    parts = []
    for i, w in enumerate(WEEKS):
        parts.append(
            f"sum(CASE WHEN RelWeek = {ANCHOR} - {i} - (CASE WHEN Destino IN ('GRU', 'VCP') "
            f"THEN 2 ELSE 0 END) THEN Tons ELSE 0 END) AS {w}")
    return ",\n    ".join(parts)


def view_ctes(view: str, tag: str = "") -> list[str]:
    """CTEs ``rows{tag}`` .. ``report{tag}`` computing one view."""
    v = VIEW_SQL[view]
    sums = ", ".join(f"sum({w}) AS {w}" for w in WEEKS)
    wk = ", ".join(WEEKS)
    shares = ",\n    ".join(
        f"CASE WHEN isnan({w} / sum({w}) OVER (PARTITION BY Grupo)) THEN NULL "
        f"ELSE {w} / sum({w}) OVER (PARTITION BY Grupo) END AS {w}r" for w in WEEKS)
    return [
        f"""
classified{tag} AS (
  SELECT *, {v['origin']} AS Origen, {DESTINO} AS Destino,
    regexp_replace(Owner, '^\\s+|\\s+$', '', 'g') AS Own
  FROM base
)""", f"""
carrier_weeks{tag} AS (
  SELECT {v['label']} AS Grupo, Own AS Owner,
    {_week_sums()}
  FROM classified{tag}
  WHERE Origen <> 'Otros' AND Destino <> 'Otros' AND ({v['extra']})
  GROUP BY 1, 2
)""", f"""
numbered{tag} AS (
  SELECT *, row_number() OVER (PARTITION BY Grupo ORDER BY W DESC NULLS LAST, Owner) AS rn
  FROM carrier_weeks{tag} WHERE Owner <> 'LA'
)""", f"""
bucketed{tag} AS (
  SELECT Grupo, Owner, rn, CASE WHEN rn >= {v['threshold']} THEN 'Otros' ELSE Owner END AS OwnerGrpd, {wk}
  FROM numbered{tag}
  UNION ALL
  SELECT Grupo, Owner, NULL AS rn, Owner AS OwnerGrpd, {wk} FROM carrier_weeks{tag} WHERE Owner = 'LA'
)""", f"""
collapsed{tag} AS (
  SELECT Grupo, OwnerGrpd,
    CASE WHEN OwnerGrpd = 'LA' THEN 0 WHEN OwnerGrpd = 'Otros' THEN 99 ELSE 1 END AS cls, {sums}
  FROM bucketed{tag} GROUP BY Grupo, OwnerGrpd
)""", f"""
ranked{tag} AS (
  SELECT Grupo, OwnerGrpd, {wk},
    (CASE WHEN cls = 1 THEN row_number() OVER (PARTITION BY Grupo, cls ORDER BY W DESC NULLS LAST, OwnerGrpd)
      ELSE cls END)::BIGINT AS Rank
  FROM collapsed{tag}
)""", f"""
report{tag} AS (
  SELECT CAST(Rank AS VARCHAR) || Grupo AS excelKEY, Rank, Grupo, OwnerGrpd,
    {shares},
    {wk}
  FROM ranked{tag}
)"""]


def view_sql(view: str) -> str:
    return _with(*view_ctes(view)) + f"SELECT {REPORT} FROM report"


def all_views_sql() -> str:
    ctes, selects = [], []
    for name in VIEW_SQL:
        ctes += view_ctes(name, f"_{name}")
        selects.append(f"SELECT '{name}' AS view, {REPORT} FROM report_{name}")
    return _with(*ctes) + "\nUNION ALL\n".join(selects)


def report_sql(first: str, second: str | None) -> str:
    if second is None:
        return view_sql(first)
    ctes = view_ctes(first, "_a") + view_ctes(second, "_b")
    return _with(*ctes) + (f"SELECT DISTINCT {REPORT} FROM ("
                           f"SELECT {REPORT} FROM report_a UNION ALL SELECT {REPORT} FROM report_b)")


def stage_sql(view: str, select: str) -> str:
    """Run ``select`` over the CTEs of one view (names without a tag)."""
    return _with(*view_ctes(view)) + select


def base_sql(select: str) -> str:
    return _with() + select


def _per_view(select) -> str:
    """``select(name, tag)`` for each view, appended with UNION ALL."""
    ctes, selects = [], []
    for name in VIEW_SQL:
        tag = f"_{name}"
        ctes += view_ctes(name, tag)
        selects.append(select(name, tag))
    return _with(*ctes) + "\nUNION ALL\n".join(selects)


_WK = ", ".join(WEEKS)
_ISO_WEEKS_BEFORE = ("(SELECT coalesce(sum(weekofyear(make_date(t.r::INT, 12, 28))), 0) "
                     f"FROM range(Year, {CUR_YEAR}) t(r))")


def _label_sql(name: str) -> str:
    v = VIEW_SQL[name]
    return stage_sql(name, f"""SELECT Origen, Destino, TipoVuelo, {v['label']} AS Grupo, count(*) AS n
FROM classified WHERE Origen <> 'Otros' AND Destino <> 'Otros' AND ({v['extra']}) GROUP BY ALL""")


def _tracked_sql() -> str:
    selects = []
    for name, v in VIEW_SQL.items():
        selects.append(
            f"SELECT '{name}' AS view, count(*) AS n FROM (SELECT {v['origin']} AS Origen, "
            f"{DESTINO} AS Destino FROM base) c "
            f"WHERE Origen <> 'Otros' AND Destino <> 'Otros' AND ({v['extra']})")
    return _with() + "\nUNION ALL\n".join(selects)


# A row's week is a real ISO week.
VALID = "Semana BETWEEN 1 AND weekofyear(make_date(Year::INT, 12, 28))"
# The day whose ISO week a run reports as its newest.
REPORTED = f"(DATE '{AS_OF}' - {7 * BACK_WEEKS})"
# The rendered export files: one per year and last digit of the tons, with the week as loaded.
_RENDERED = """rendered AS (SELECT * REPLACE (CASE WHEN f = 0 AND Semana = 7 THEN 'P "A", X' ELSE TipoVuelo END AS TipoVuelo),
  Year || '-' || f || '.csv' AS _file, f = 8 AND Semana > 50 AS stray, f = 3 AND Semana IN (10, 51) AS bad_week,
  CASE f WHEN 6 THEN 0 WHEN 7 THEN 2 ELSE 1 END::BIGINT AS heads,
  CASE WHEN f = 3 AND Semana IN (10, 51) THEN NULL WHEN f = 4 AND Semana = 50 THEN 60 ELSE Semana END AS loaded
  FROM (SELECT *, trunc(Tons)::INT % 10 AS f FROM export) e)"""


def report_file_sql() -> str:
    """All reports, each with its views' rows in file order."""
    ctes, selects = [], []
    for name, views in (("awb", ("awb", "awb_sao")), ("feeder", ("feeder",)), ("gateway", ("gateway", "gateway_sao"))):
        rows = []
        for part, view in enumerate(views):
            ctes += view_ctes(view, f"_{view}")
            rows.append(f"SELECT {part} AS part, {REPORT} FROM report_{view}")
        selects.append(f"""SELECT '{name}' AS report, (row_number() OVER (ORDER BY part, Grupo NULLS FIRST, Rank))::INT AS line, {REPORT}
FROM (SELECT min(part) AS part, {REPORT} FROM ({" UNION ALL ".join(rows)}) u GROUP BY {REPORT}) r""")
    return _with(*ctes) + "\nUNION ALL\n".join(selects)


ORACLE: dict[str, str] = {
    "base_scan": base_sql("SELECT * FROM base"),
    "weeks_in_year": base_sql(
        "SELECT DISTINCT Year, weekofyear(make_date(Year::INT, 12, 28))::BIGINT AS weeks FROM base"),
    "year_delta": base_sql(
        f"SELECT Year, {CUR_YEAR}::BIGINT AS current_year, {_ISO_WEEKS_BEFORE}::BIGINT AS delta "
        "FROM (SELECT DISTINCT Year FROM base) y"),
    "relative_week": base_sql(
        f"SELECT Year, Semana, (Semana - {_ISO_WEEKS_BEFORE})::BIGINT AS RelWeek, "
        f"{ANCHOR}::BIGINT AS anchor_week FROM (SELECT DISTINCT Year, Semana FROM export) e"),
    "owner_clean": base_sql(
        "SELECT DISTINCT Owner, regexp_replace(CASE WHEN Owner = 'QT ' THEN 'AV ' ELSE Owner END, "
        "'^\\s+|\\s+$', '', 'g') AS OwnerClean FROM export"),
    "origin_awb": base_sql(
        f"SELECT RegionOrigenAWB, {ORIGIN_AWB} AS Origen, count(*) AS n FROM base GROUP BY ALL"),
    "origin_gateway": base_sql(
        "SELECT RegionOrigenSegmento, RegionOrigenAWB, PaisOrigenSegmento, PaisOrigenAWB, "
        f"{ORIGIN_GATEWAY} AS Origen, count(*) AS n FROM base GROUP BY ALL"),
    "origin_feeder": base_sql(
        f"SELECT ZonaOrigenAWB, RegionOrigenAWB, PaisOrigenAWB, {ORIGIN_FEEDER} AS Origen, "
        "count(*) AS n FROM base GROUP BY ALL"),
    "destination": base_sql(
        f"SELECT PaisDestinoAWB, PostaDestinoAWB, {DESTINO} AS Destino, count(*) AS n "
        "FROM base GROUP BY ALL"),
    **{f"label_{name}": _label_sql(name) for name in VIEW_SQL},
    "tracked_rows": _tracked_sql(),
    "lagged_pivot": _per_view(lambda n, t: (
        f"SELECT '{n}' AS view, Grupo, Owner, {_WK} FROM carrier_weeks{t} WHERE Owner IS NOT NULL")),
    "owners_present": base_sql("SELECT DISTINCT Owner FROM base"),
    "topn_others": stage_sql("gateway", "SELECT Grupo, Owner, W, rn, OwnerGrpd FROM bucketed WHERE Owner <> 'LA'"),
    "topn_by_group": stage_sql("feeder", "SELECT Grupo, Owner, W, rn, OwnerGrpd FROM bucketed WHERE Owner <> 'LA'"),
    "home_split": _per_view(lambda n, t: (
        f"SELECT '{n}' AS view, Rank, Grupo, OwnerGrpd, {_WK} FROM ranked{t} WHERE Rank = 0")),
    "tail_bucket": _per_view(lambda n, t: (
        f"SELECT '{n}' AS view, Rank, Grupo, OwnerGrpd, {_WK} FROM ranked{t} WHERE Rank = 99")),
    "rank_over_sum": _per_view(lambda n, t: (
        f"SELECT '{n}' AS view, Rank, Grupo, OwnerGrpd, {_WK} FROM ranked{t} WHERE Rank BETWEEN 1 AND 98")),
    "three_branch_union": _per_view(lambda n, t: (
        f"SELECT '{n}' AS view, Rank, Grupo, OwnerGrpd, {_WK} FROM ranked{t}")),
    "share_of_group": _per_view(lambda n, t: (
        f"SELECT '{n}' AS view, Grupo, OwnerGrpd, {', '.join(SHARES)} FROM report{t}")),
    "report_key": _per_view(lambda n, t: (
        f"SELECT '{n}' AS view, excelKEY, Rank, Grupo FROM report{t}")),
    **{f"view_{name}": view_sql(name) for name in VIEW_SQL},
    "all_views": all_views_sql(),
    "report_awb": report_sql("awb", "awb_sao"),
    "report_feeder": report_sql("feeder", None),
    "report_gateway": report_sql("gateway", "gateway_sao"),
    "latest_week": base_sql(
        f"SELECT Year, max(Semana) AS Semana, isoyear({REPORTED})::BIGINT AS expected_year, "
        f"weekofyear({REPORTED})::BIGINT AS expected_week, "
        f"coalesce(Year = isoyear({REPORTED}) AND max(Semana) = weekofyear({REPORTED}), FALSE) AS is_current "
        f"FROM base WHERE {VALID} AND Year = (SELECT max(Year) FROM base WHERE {VALID}) GROUP BY Year"),
    "lagged_weeks": base_sql(
        "SELECT Year, PostaDestinoAWB, Semana, count(*) AS n FROM base "
        "WHERE PostaDestinoAWB IN ('GRU', 'VCP') AND Year = (SELECT max(Year) FROM base) GROUP BY ALL"),
    "week_validity": base_sql(
        "SELECT Year, Semana, weekofyear(make_date(Year::INT, 12, 28))::BIGINT AS weeks, "
        f"coalesce({VALID}, FALSE) AS valid, count(*) AS n FROM base GROUP BY Year, Semana"),
    "expected_week": base_sql(
        "SELECT Year, Semana, strftime(run, '%Y-%m-%d') AS run_date, "
        f"isoyear(run - {7 * BACK_WEEKS})::BIGINT AS expected_year, "
        f"weekofyear(run - {7 * BACK_WEEKS})::BIGINT AS expected_week FROM (SELECT DISTINCT Year, Semana, "
        "(date_trunc('week', make_date(Year::INT, 1, 4))::DATE + (7 * (Semana - 1))::INT)::DATE AS run "
        "FROM base) r"),
    "export_parse": _with(_RENDERED) + """SELECT _file, Year, loaded AS Semana, PostaDestinoAWB, TipoVuelo, Owner,
  CASE WHEN f IN (1, 2) THEN NULL ELSE Tons END AS Tons, bad_week AS _unfit_week,
  f IN (1, 2) AS _unfit_tons, f = 5 AND Semana = 9 AS _malformed
FROM rendered WHERE NOT stray""",
    "export_rejects": _with(_RENDERED) + """SELECT *, header_missing + second_header + stray_rows + malformed_rows
  + unfit_week + unfit_tons + invalid_weeks = 0 AS ok FROM (
  SELECT _file, count(*) + 2 + heads AS rows, count(*) FILTER (WHERE NOT stray) AS data_rows,
    count(*) FILTER (WHERE stray) + 2 + heads AS rejects,
    CASE WHEN heads = 0 THEN 1 ELSE 0 END::BIGINT AS header_missing,
    CASE WHEN heads = 2 THEN 1 ELSE 0 END::BIGINT AS second_header,
    (CASE WHEN heads > 0 AND f <> 9 AND count(*) FILTER (WHERE stray) > 0 THEN 1 ELSE 0 END
     + CASE WHEN f = 9 AND count(*) FILTER (WHERE NOT stray) > 0 THEN 1 ELSE 0 END)::BIGINT AS stray_rows,
    count(*) FILTER (WHERE f = 5 AND Semana = 9) AS malformed_rows,
    count(*) FILTER (WHERE bad_week) AS unfit_week,
    count(*) FILTER (WHERE f IN (1, 2)) AS unfit_tons,
    count(*) FILTER (WHERE f = 4 AND Semana = 50) AS invalid_weeks
  FROM rendered GROUP BY _file, f, heads) s""",
    "bad_weeks": _with(_RENDERED) + """SELECT Year, loaded AS Semana, count(*) AS n FROM rendered WHERE NOT stray
  AND NOT coalesce(loaded BETWEEN 1 AND weekofyear(make_date(Year::INT, 12, 28)), FALSE) GROUP BY ALL""",
    "base_roundtrip": base_sql("SELECT * FROM base"),
    "report_file": report_file_sql(),
}


def view_sql_on(table: str, view: str, as_of: str = AS_OF, back_weeks: int = BACK_WEEKS) -> str:
    """One view's report over a ready base table ``table`` (for randomized
    cross-engine checks), with its own calendar."""
    anchor = f"(weekofyear(DATE '{as_of}') - {back_weeks})"
    ctes = [c.replace(ANCHOR, anchor) for c in view_ctes(view)]
    return ("WITH base AS (SELECT * FROM " + table + ")," + ",".join(ctes)
            + f"\nSELECT {REPORT} FROM report")
