"""Physical plan shape: one scan, pushed filters, few exchanges, no Python."""

import re

import pytest

from weekshare.plans import catalog
from weekshare.plans.market_share import market_share
from weekshare.plans.reports import report
from weekshare.plans.views import VIEWS
from weekshare.session import shared_dir
from weekshare.sources.export import prepare_base
from weekshare.sources.fixture import export_from_tables, rendered_lines
from weekshare.sources.warehouse import read_base, save_base

from conftest import SF0001


@pytest.fixture(scope="module")
def base_path(spark):
    path = shared_dir(spark, "test_plan_base")
    save_base(prepare_base(export_from_tables(spark, SF0001), catalog.AS_OF), path)
    return path


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def initial_plan(df):
    return df._sc._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def simple_plan(df):
    return df._sc._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "simple")


def test_all_views_one_scan_two_exchanges(spark, base_path):
    df = market_share(read_base(spark, base_path), list(VIEWS.values()), catalog.AS_OF, 1)
    text = initial_plan(df)
    physical = text.split("\n\n")[0]
    assert physical.count("Scan parquet") == 1
    exchanges = re.findall(r"Exchange (\w+)\(", simple_plan(df))
    assert exchanges == ["hashpartitioning", "hashpartitioning"]
    assert "rangepartitioning" not in text.lower()
    assert "EvalPython" not in text and "PythonUDF" not in text
    # The fact-side aggregate is partial before its exchange (map-side combine).
    assert re.search(r"Exchange hashpartitioning\(Destino.*\n.*HashAggregate\(keys=.*partial_sum",
                     simple_plan(df))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "IsNotNull(Owner)" in pushed
    assert "PostaDestinoAWB" in pushed and "PaisDestinoAWB" in pushed
    read_schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "Year" not in read_schema and "Semana" not in read_schema
    df.collect()


def test_reports_need_no_extra_exchange(spark, base_path):
    from weekshare.plans.reports import REPORTS, report_rows
    df = report_rows(read_base(spark, base_path), list(REPORTS), catalog.AS_OF, 1)
    assert re.findall(r"Exchange (\w+)\(", simple_plan(df)) == ["hashpartitioning", "hashpartitioning"]


def test_single_view_prunes_unused_columns(spark, base_path):
    df = market_share(read_base(spark, base_path), VIEWS["awb"], catalog.AS_OF, 1)
    text = initial_plan(df)
    read_schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    for col in ("TipoVuelo", "ZonaOrigenAWB", "PaisOrigenSegmento", "Year", "Semana"):
        assert col not in read_schema
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(RegionOrigenAWB,Europe)" in pushed


def test_report_is_one_scan(spark, base_path):
    df = report(read_base(spark, base_path), "gateway", catalog.AS_OF, 1)
    text = initial_plan(df).split("\n\n")[0]
    assert text.count("Scan parquet") == 1


def test_fixture_never_broadcasts_fact_tables(spark):
    df = catalog.QUERIES["view_gateway"](spark, SF0001)
    df.collect()
    text = plan_text(df)
    # lineitem meets orders in a shuffled join, whatever their sizes.
    assert "ShuffledHashJoin" in text or "SortMergeJoin" in text
    lines = text.splitlines()
    indent = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for i, line in enumerate(lines):
        if "FileScan parquet [l_orderkey" in line or "FileScan parquet [o_orderkey" in line:
            j = i - 1
            while j >= 0 and not ("Exchange" in lines[j] and indent[j] < indent[i]):
                j -= 1
            assert j >= 0 and "BroadcastExchange" not in lines[j], lines[j]


def test_sao_view_alone_pushes_its_own_destinations(spark, base_path):
    df = market_share(read_base(spark, base_path), VIEWS["awb_sao"], catalog.AS_OF, 1)
    pushed = re.search(r"PushedFilters: \[(.*)\]", initial_plan(df)).group(1)
    assert "In(PostaDestinoAWB, [GRU,VCP])" in pushed.replace("VCP,GRU", "GRU,VCP")
    assert "CHILE" not in pushed and "LIM" not in pushed


def test_fixture_filters_rows_before_the_fact_shuffle(spark):
    text = simple_plan(catalog.QUERIES["view_gateway"](spark, SF0001)).split("== Initial Plan ==")[-1]
    lines = text.splitlines()
    indent = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    at = next(i for i, line in enumerate(lines) if "FileScan parquet [l_orderkey" in line)
    above, level = [], indent[at]
    for i in range(at - 1, -1, -1):
        if indent[i] < level:
            level = indent[i]
            above.append(lines[i])
    joins = [x for x in above if "Join" in x or "Exchange hashpartitioning(l_orderkey" in x]
    first = next(i for i, x in enumerate(joins) if "Exchange" in x)
    assert first == 2, joins          # part and origin first, then the shuffle by order


def test_three_branches_need_one_scan_in_the_initial_plan(spark):
    text = initial_plan(catalog.QUERIES["three_branch_union"](spark, SF0001)).split("\n\n")[0]
    assert text.count("Scan parquet") == 4    # lineitem, part, orders, customer


def test_the_rendered_export_scans_each_table_once(spark):
    text = initial_plan(rendered_lines(spark, SF0001)).split("\n\n")[0]
    assert text.count("Scan parquet") == 4    # lineitem, part, orders, customer


def test_every_registered_query_scans_the_fact_table_once(spark):
    for name, q in catalog.QUERIES.items():
        df = q(spark, SF0001)
        df.collect()
        final = plan_text(df).split("== Initial Plan ==")[0]
        # At most once: AQE may replace a plan whose result is empty.
        assert len(re.findall(r"FileScan parquet \[l_orderkey", final)) <= 1, name
        assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final, name
