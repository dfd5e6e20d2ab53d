"""Print the formatted physical plans of the headline queries.

Usage: python tools/show_plans.py [sf_dir]  (default /root/testdata/sf0.01)
Writes the base table once under spark.checkpoint.dir, then explains the
five views together, the three reports together, and one registered query
straight from the test tables.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weekshare.plans import catalog  # noqa: E402
from weekshare.plans.market_share import market_share  # noqa: E402
from weekshare.plans.reports import REPORTS, report_rows  # noqa: E402
from weekshare.plans.views import VIEWS  # noqa: E402
from weekshare.session import local_session, shared_dir  # noqa: E402
from weekshare.sources.export import prepare_base  # noqa: E402
from weekshare.sources.fixture import export_from_tables  # noqa: E402
from weekshare.sources.warehouse import read_base, save_base  # noqa: E402


def explain(df) -> str:
    return df._sc._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    path = shared_dir(spark, "plans_base")
    save_base(prepare_base(export_from_tables(spark, sf_dir), catalog.AS_OF), path)
    base = read_base(spark, path)
    for title, df in [
        ("all five views over the base table", market_share(base, list(VIEWS.values()), catalog.AS_OF, 1)),
        ("three reports over the base table", report_rows(base, list(REPORTS), catalog.AS_OF, 1)),
        ("registered query view_gateway (from the test tables)", catalog.QUERIES["view_gateway"](spark, sf_dir)),
    ]:
        print(f"===== {title} =====")
        print(explain(df))


if __name__ == "__main__":
    main()
