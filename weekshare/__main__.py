"""The weekly run from the command line (C6 then C7-C9).

    python -m weekshare --exports FILE [FILE ...] --base TABLE_OR_PATH --out DIR \
        [--as-of YYYY-MM-DD] [--back-weeks 1]

Loads one export snapshot (several files are its declared parts), stops if
any row cannot be loaded exactly or has a week that does not exist (D4, D5),
creates the base table if it is missing and replaces its rows (the staged rows
are removed then, or when that fails), prints the newest week loaded against the week being
reported (D2) and the weeks present for the late airports (D3), and writes
the three report files from one scan of the new table. Uses the active or
default Spark session (``spark-submit`` supplies the cluster's).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans.quality import lagged_weeks, latest_week
from .plans.reports import write_reports
from .sources.export import load_base
from .sources.warehouse import ensure_table, read_base, save_base


def main(argv=None) -> dict[str, str]:
    ap = argparse.ArgumentParser(prog="weekshare", description=__doc__.splitlines()[0])
    ap.add_argument("--exports", required=True, nargs="+",
                    help="the export CSV file, or the parts of one snapshot")
    ap.add_argument("--base", required=True, help="base table name or Parquet path")
    ap.add_argument("--out", required=True, help="report folder")
    ap.add_argument("--as-of", default=None, help="run date (default: today, UTC)")
    ap.add_argument("--back-weeks", type=int, default=1, help="weeks back of the newest week")
    ap.add_argument("--encoding", default="UTF-8", help="export character set (e.g. ISO-8859-1)")
    ap.add_argument("--decimal-mark", default=".", choices=[".", ","], help="decimal mark of the tons")
    args = ap.parse_args(argv)
    as_of = (dt.date.fromisoformat(args.as_of) if args.as_of
             else dt.datetime.now(dt.timezone.utc).date())
    spark = SparkSession.builder.appName("weekshare-weekly").getOrCreate()
    exports = args.exports[0] if len(args.exports) == 1 else args.exports
    ensure_table(spark, args.base)
    with load_base(spark, exports, as_of, encoding=args.encoding, decimal_mark=args.decimal_mark) as load:
        save_base(load.base, args.base)
    base = read_base(spark, args.base)
    fresh = latest_week(base, as_of, args.back_weeks).first()  # one row (D2)
    print(f"newest week loaded: {fresh.Year}-W{fresh.Semana}; reporting "
          f"{fresh.expected_year}-W{fresh.expected_week}; current: {fresh.is_current}")
    # One row per late airport: at most 53 weeks each (D3).
    late = lagged_weeks(base).groupBy("Year", "PostaDestinoAWB").agg(
        F.sort_array(F.collect_list("Semana")).alias("weeks"))
    for r in late.orderBy("PostaDestinoAWB").collect():
        print(f"late airport {r.PostaDestinoAWB}, {r.Year}: weeks {r.weeks}")
    written = write_reports(base, args.out, as_of, args.back_weeks)
    for name, path in written.items():
        print(f"{name}: {path}")
    return written


if __name__ == "__main__":
    main()
