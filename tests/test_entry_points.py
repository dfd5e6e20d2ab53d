import os

from test_io import DATA, write_export

from weekshare.__main__ import main
from weekshare.plans.sql_views import register_views
from weekshare.sources.warehouse import read_base


def test_command_line_weekly_run(spark, tmp_path):
    exports = tmp_path / "exports"
    exports.mkdir()
    write_export(exports / "w.csv", DATA)
    base, out = str(tmp_path / "base"), str(tmp_path / "out")
    written = main(["--exports", str(exports), "--base", base, "--out", out,
                    "--as-of", "2026-03-11", "--back-weeks", "1"])
    assert read_base(spark, base).count() == 4
    assert all(os.path.isfile(p) and p.endswith(".csv") for p in written.values())


def test_sql_views(spark, tmp_path):
    from helpers import export_df
    from weekshare.sources.export import prepare_base
    base = prepare_base(export_df(spark, [dict(Owner="LA ", Tons=3.0), dict(Owner="A ", Tons=1.0)]),
                        "2026-03-11")
    names = register_views(spark, base, "2026-03-11", 1)
    assert "ms_gateway" in names and "ms_report_awb" in names
    rows = spark.sql("SELECT OwnerGrpd, Rank, Wr FROM ms_awb ORDER BY Grupo, Rank").collect()
    assert [(r.OwnerGrpd, r.Rank, r.Wr) for r in rows] == [("LA", 0, 0.75), ("A", 1, 0.25)]
    assert spark.sql("SELECT count(*) AS n FROM ms_all").first().n == 8
