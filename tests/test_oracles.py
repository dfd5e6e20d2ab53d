"""Every registered query against its DuckDB statement, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare, duck  # noqa: E402

from conftest import SF0001  # noqa: E402
from weekshare.plans import catalog  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql())
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    _, n_spark, n_duck, status, _ = compare(spark, con, name, SF0001)
    assert status == "OK", status


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["excelKEY", "Rank", "Grupo", "OwnerGrpd"]


def test_without_the_optional_part(spark, tmp_path):
    """The rest imports and answers when the training-data part is deleted."""
    import shutil
    import subprocess
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(e.queries()) == sorted(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert said.stdout.split() == [str(len(catalog.QUERIES)), "True"], said.stderr
