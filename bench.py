"""Benchmark of the weekly market-share run.

Mirrors the weekly job: derive the export from the test tables and load the
base table once (``base_load``), then answer the views and reports over that
table, then write the three report files. ``*_from_tables`` variants run the
whole chain from the raw tables in one plan (the form the correctness
queries use). Every timed run builds a fresh DataFrame (re-collecting one
DataFrame would reuse finished shuffle stages); one warm-up run, then the
median of ``BENCH_RUNS`` runs.

Prints one JSON line. ``value`` is the weekly run: ``base_load`` plus
``write_reports`` (medians).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weekshare.plans import catalog  # noqa: E402
from weekshare.plans.market_share import market_share  # noqa: E402
from weekshare.plans.reports import REPORTS, report, report_rows, write_reports  # noqa: E402
from weekshare.plans.views import VIEWS  # noqa: E402
from weekshare.session import local_session, shared_dir  # noqa: E402
from weekshare.sources.export import prepare_base  # noqa: E402
from weekshare.sources.fixture import export_from_tables  # noqa: E402
from weekshare.sources.warehouse import read_base, save_base  # noqa: E402

AS_OF, BACK = catalog.AS_OF, catalog.BACK_WEEKS


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    warm = int(os.environ.get("BENCH_WARMUP", "2"))
    spark = local_session(cpus, shuffle_partitions=cpus, app_name="weekshare-bench")
    base_path = shared_dir(spark, "bench_base")
    out_root = shared_dir(spark, "bench_reports")
    counter = iter(range(10**6))

    def load():
        save_base(prepare_base(export_from_tables(spark, sf_dir), AS_OF), base_path)

    def base():
        return read_base(spark, base_path)

    work = {"base_load": load}
    for name, view in VIEWS.items():
        work[f"view_{name}"] = lambda v=view: market_share(base(), v, AS_OF, BACK).collect()
    work["all_views"] = lambda: market_share(base(), list(VIEWS.values()), AS_OF, BACK).collect()
    for name in ("awb", "gateway", "feeder"):
        work[f"report_{name}"] = lambda n=name: report(base(), n, AS_OF, BACK).collect()
    work["all_reports"] = lambda: report_rows(base(), list(REPORTS), AS_OF, BACK).collect()
    work["write_reports"] = lambda: write_reports(base(), f"{out_root}/run{next(counter)}", AS_OF, BACK)
    work["all_views_from_tables"] = lambda: catalog.QUERIES["all_views"](spark, sf_dir).collect()
    work["view_gateway_from_tables"] = lambda: catalog.QUERIES["view_gateway"](spark, sf_dir).collect()

    # Warm the JVM (JIT, code-generation cache) on every query first, then
    # time rounds over all queries so that no query is measured cold.
    for _ in range(warm):
        for fn in work.values():
            fn()
    secs = {name: [] for name in work}
    for _ in range(runs):
        for name, fn in work.items():
            t0 = time.perf_counter()
            fn()
            secs[name].append(time.perf_counter() - t0)
    q = {name: round(statistics.median(xs), 3) for name, xs in secs.items()}

    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "weekly_run_sec",
        "value": round(q["base_load"] + q["write_reports"], 3),
        "unit": "sec",
        "queries": q,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
