"""Scale probe: the report pipeline over a base table k times larger.

Builds the sf base from the test tables, replicates every row k times with
shifted carrier codes (so carriers and groups stay realistic) into a scratch
table under spark.checkpoint.dir, then times all five views and the three
reports over it. Usage: python tools/scale_probe.py [sf_dir] [k ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weekshare.plans import catalog  # noqa: E402
from weekshare.plans.market_share import market_share  # noqa: E402
from weekshare.plans.reports import REPORTS, report_rows  # noqa: E402
from weekshare.plans.views import VIEWS  # noqa: E402
from weekshare.session import local_session, shared_dir  # noqa: E402
from weekshare.sources.export import prepare_base  # noqa: E402
from weekshare.sources.fixture import export_from_tables  # noqa: E402
from weekshare.sources.warehouse import read_base, save_base  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    ks = [int(a) for a in args if not a.startswith("/")] or [1, 10, 50]
    spark = local_session(8, shuffle_partitions=8, app_name="weekshare-scale")
    base = prepare_base(export_from_tables(spark, sf_dir), catalog.AS_OF)
    out = {}
    for k in ks:
        path = shared_dir(spark, f"scale_base_x{k}")
        # Copy i of a row gets carrier code suffix i % 7, so the number of
        # carriers grows a little while tons and routes keep their shape.
        big = (base.selectExpr("*", f"explode(sequence(0, {k - 1})) AS copy")
               .selectExpr(*[c if c != "Owner" else
                             "CASE WHEN copy % 7 = 0 OR Owner IS NULL THEN Owner "
                             "ELSE concat(Owner, CAST(copy % 7 AS STRING)) END AS Owner"
                             for c in base.columns]))
        save_base(big.repartition(8 * max(1, k // 10)), path)
        rows = read_base(spark, path).count()
        times = {}
        for name, fn in {
            "all_views": lambda: market_share(read_base(spark, path), list(VIEWS.values()),
                                              catalog.AS_OF, 1).collect(),
            "all_reports": lambda: report_rows(read_base(spark, path), list(REPORTS),
                                               catalog.AS_OF, 1).collect(),
        }.items():
            fn()
            xs = []
            for _ in range(3):
                t0 = time.perf_counter()
                fn()
                xs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(xs), 3)
        out[k] = {"rows": rows, **times,
                  "rows_per_sec_all_views": round(rows / times["all_views"])}
        print(json.dumps({k: out[k]}), flush=True)


if __name__ == "__main__":
    main()
