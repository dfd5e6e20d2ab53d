"""Export loader (S1-S4, D5), table sink (S5-S7) and CSV report sink."""

import os

import pytest

from weekshare.plans.reports import REPORTS, report, write_reports
from weekshare.session import shared_dir
from weekshare.sources.export import ExportFormatError, load_base, read_export_text
from weekshare.sources.schema import BASE_COLUMNS, BASE_SCHEMA, REPORT_COLUMNS
from weekshare.sources.warehouse import ensure_table, read_base, save_base

HEADER = ("Año,Semana,Region Origen AWB,Region Origen Segmento,Zona (Origen) AWB,Pais Origen AWB,"
          "Pais Origen Segmento,Pais Destino AWB,Posta Destino AWB,Tipo Vuelo,Owner,Tons")


def write_export(path, lines, header=HEADER):
    with open(path, "w", encoding="utf-8") as f:
        f.write("Market export\n,,generated weekly\n")
        f.write(header + "\n")
        for line in lines:
            f.write(line + "\n")


DATA = [
    "2026,10,Europe,Europe,EU_DE,ALEMANIA,ALEMANIA,PERU,LIM,PAX,LA ,40",
    "2026,10,Europe,Europe,EU_DE,ALEMANIA,ALEMANIA,PERU,LIM,PAX,QT ,15",
    "2026,10,Europe,Europe,EU_DE,ALEMANIA,ALEMANIA,PERU,LIM,PAX,B ,NaN",
    "2025,52.0,Europe,Europe,EU_DE,ALEMANIA,ALEMANIA,PERU,LIM,PAX,C ,3",
]


AS_OF = "2026-03-11"


def refused(spark, path, **kw):
    with pytest.raises(ExportFormatError) as e:
        load_base(spark, path if isinstance(path, list) else str(path), AS_OF, **kw)
    return e.value


def test_load_export(spark, tmp_path):
    a, b = tmp_path / "part1.csv", tmp_path / "part2.csv"
    write_export(a, DATA[:2])
    write_export(b, DATA[2:])
    base = load_base(spark, [str(a), str(b)], AS_OF).base
    assert base.schema == BASE_SCHEMA
    rows = sorted(base.collect(), key=lambda r: r.Owner)
    assert [r.Owner for r in rows] == ["AV ", "B ", "C ", "LA "]
    by_owner = {r.Owner: r for r in rows}
    assert by_owner["B "].Tons is None  # NaN tons become NULL
    assert by_owner["C "].Semana == 52 and by_owner["C "].RelWeek == 52 - 52
    assert by_owner["LA "].RelWeek == 10


def test_two_snapshots_are_not_added_up(spark, tmp_path):
    write_export(tmp_path / "week10.csv", DATA[:2])
    assert load_base(spark, str(tmp_path), AS_OF).base.count() == 2      # one file: fine
    write_export(tmp_path / "week11.csv", DATA)
    assert "one snapshot" in str(refused(spark, tmp_path))


def test_preamble_of_any_length(spark, tmp_path):
    for name, top in (("none", ""), ("blank", "Market export\n\n,,weekly\n\n"), ("long", "a\nb\nc\nd\n")):
        path = tmp_path / f"{name}.csv"
        path.write_text(top + HEADER + "\n" + DATA[0] + "\n", encoding="utf-8")
        assert load_base(spark, str(path), AS_OF).base.count() == 1, name


@pytest.mark.parametrize("fault,text", [
    ("header_missing", "Market export\n" + DATA[0]),
    ("header_missing", HEADER.replace("Año,Semana", "Semana,Año") + "\n" + DATA[0]),
    ("header_missing", HEADER.replace("Tipo Vuelo", "") + "\n" + DATA[0]),
    ("second_header", HEADER + "\n" + DATA[0] + "\n" + HEADER),
    ("stray_rows", HEADER + "\n" + DATA[0] + "\n" + DATA[1].replace("2026", "xx")),
    ("stray_rows", DATA[0] + "\n" + HEADER),
    ("unfit_tons", HEADER + "\n" + DATA[0].replace(",40", ',"1.234,5"')),
    ("unfit_tons", HEADER + "\n" + DATA[0].replace(",40", ',"1,234.5"')),
    ("unfit_tons", HEADER + "\n" + DATA[0].replace(",40", ",n/a")),
    ("unfit_week", HEADER + "\n" + DATA[0].replace("2026,10", "2026,xx")),
    ("malformed_rows", HEADER + "\n2026,10,Europe"),
    ("malformed_rows", HEADER + "\n" + DATA[0] + ",13th"),
    ("invalid_weeks", HEADER + "\n" + DATA[0].replace("2026,10", "2026,54")),
    ("invalid_weeks", HEADER + "\n" + DATA[0].replace("2026,10", "99999,10")),
    ("invalid_weeks", HEADER + "\n" + DATA[0].replace("2026,10", "2026,")),
])
def test_what_does_not_fit_refuses_the_load(spark, tmp_path, fault, text):
    path = tmp_path / "w.csv"
    path.write_text(text + "\n", encoding="utf-8")
    good = tmp_path / "good.csv"
    write_export(good, DATA)
    error = refused(spark, [str(path), str(good)])
    assert f"'{fault}': 1" in str(error) and "1 export file(s)" in str(error)
    failures = error.failures
    assert [os.path.basename(r._file) for r in failures] == ["w.csv"]
    assert failures[0][fault] == 1


@pytest.mark.parametrize("cell", ["12d", "3F", "0x1p3", "Infinity", "-Infinity", "1e400", "1_0", "1e", ".", "+", "5%",
                                  "nan", "١"])
def test_tons_outside_the_grammar_are_unfit(spark, tmp_path, cell):
    write_export(tmp_path / "w.csv", [DATA[0], DATA[1].replace(",15", f",{cell}")])
    assert "'unfit_tons': 1" in str(refused(spark, tmp_path / "w.csv"))


def test_tons_inside_the_grammar(spark, tmp_path):
    cells = {"12": 12.0, "-3.5": -3.5, "+4.": 4.0, ".5": 0.5, "1e3": 1000.0, "2.5E-1": 0.25, " 7 ": 7.0, "": None,
             "NaN": None}
    write_export(tmp_path / "w.csv", [DATA[0].replace("LA ,40", f"C{i},{c}") for i, c in enumerate(cells)])
    with load_base(spark, str(tmp_path / "w.csv"), AS_OF) as load:
        got = {r.Owner: r.Tons for r in load.base.collect()}
    assert got == {f"C{i}": v for i, v in enumerate(cells.values())}


@pytest.mark.parametrize("cell,fits", [("10", True), ("10.0", True), ("10.", True), (" 10", True), ("10d", False),
                                       ("1e1", False), ("0xA", False), ("10.5", False)])
def test_the_grammar_of_weeks(spark, tmp_path, cell, fits):
    write_export(tmp_path / "w.csv", [DATA[0].replace("2026,10", f"2026,{cell}")])
    if fits:
        assert [r.Semana for r in load_base(spark, str(tmp_path / "w.csv"), AS_OF).base.collect()] == [10]
    else:
        assert "'unfit_week': 1" in str(refused(spark, tmp_path / "w.csv"))
    write_export(tmp_path / "w.csv", [DATA[0], DATA[1].replace("2026,10", "2026d,10")])
    assert "stray_rows" in str(refused(spark, tmp_path / "w.csv"))      # no year: no data row


def test_quotes_as_spreadsheets_write_them(spark, tmp_path):
    path = tmp_path / "w.csv"
    write_export(path, [DATA[0].replace("PAX,LA ", '"P ""A"", X","L""A"'), DATA[1].replace("PAX", '"C:\\ a\\"'),
                        DATA[1].replace("PAX", '""""')])
    text = read_export_text(spark, str(path)).where("_c0 = '2026'").collect()
    assert [(r._c9, r._c10) for r in text] == [('P "A", X', 'L"A'), ("C:\\ a\\", "QT "), ('"', "QT ")]
    with load_base(spark, str(path), AS_OF) as load:
        assert sorted(r.TipoVuelo for r in load.base.collect()) == ['"', "C:\\ a\\", 'P "A", X']


def test_the_staged_rows_belong_to_the_load(spark, tmp_path):
    write_export(tmp_path / "w.csv", DATA)
    load = load_base(spark, str(tmp_path / "w.csv"), AS_OF)
    assert os.path.isdir(load.folder) and load.base.count() == 4
    load.release()
    assert not os.path.exists(load.folder)
    with pytest.raises(RuntimeError):
        with load_base(spark, str(tmp_path / "w.csv"), AS_OF) as again:
            raise RuntimeError("stop")
    assert not os.path.exists(again.folder)


def staged_exports(spark):
    root = os.path.dirname(shared_dir(spark, "x")).removeprefix("file:")
    return sorted(f for f in os.listdir(root) if f.startswith("export-")) if os.path.isdir(root) else []


def test_the_weekly_run_leaves_no_staged_rows(spark, tmp_path, monkeypatch):
    import weekshare.__main__ as run
    write_export(tmp_path / "w.csv", DATA)
    args = ["--exports", str(tmp_path / "w.csv"), "--base", str(tmp_path / "base"), "--out", str(tmp_path / "out"),
            "--as-of", AS_OF]
    before = staged_exports(spark)
    run.main(args)
    assert staged_exports(spark) == before
    refused(spark, [str(tmp_path / "w.csv"), __file__])                 # a refused load removes its own
    assert staged_exports(spark) == before

    def fails(*_):
        assert len(staged_exports(spark)) == len(before) + 1
        raise OSError("disk full")

    monkeypatch.setattr(run, "save_base", fails)
    with pytest.raises(OSError):
        run.main(args)
    assert staged_exports(spark) == before


def test_the_weekly_run_into_a_table(spark, tmp_path):
    from weekshare.__main__ import main
    write_export(tmp_path / "w.csv", DATA)
    args = ["--exports", str(tmp_path / "w.csv"), "--base", "weekshare_weekly", "--out", str(tmp_path / "out"),
            "--as-of", AS_OF]
    for _ in range(2):
        main(args)
        assert read_base(spark, "weekshare_weekly").count() == 4
    spark.sql("DROP TABLE weekshare_weekly")


def test_declared_decimal_comma(spark, tmp_path):
    path = tmp_path / "w.csv"
    write_export(path, [DATA[0].replace(",40", ',"1234,5"'), DATA[1]])
    assert "unfit_tons" in str(refused(spark, path))
    base = load_base(spark, str(path), AS_OF, decimal_mark=",").base
    assert sorted(r.Tons for r in base.collect()) == [15.0, 1234.5]
    write_export(path, [DATA[0].replace(",40", ',"1.234,5"')])
    assert "unfit_tons" in str(refused(spark, path, decimal_mark=","))


def test_empty_export_is_refused(spark, tmp_path):
    (tmp_path / "w.csv").write_text("")
    assert "no rows" in str(refused(spark, tmp_path / "w.csv"))


def test_save_and_read_base_table(spark, tmp_path):
    d = tmp_path / "exports"
    d.mkdir()
    write_export(d / "w.csv", DATA)
    base = load_base(spark, str(d), "2026-03-11").base
    path = shared_dir(spark, "test_io_base")
    save_base(base, path)
    save_base(base, path)  # a second run replaces, never appends
    back = read_base(spark, path)
    assert back.count() == 4 and back.columns == list(BASE_COLUMNS)
    ensure_table(spark, "weekshare_test_base")
    ensure_table(spark, "weekshare_test_base")
    save_base(base, "weekshare_test_base")
    assert read_base(spark, "weekshare_test_base").count() == 4


def test_write_reports_files(spark, tmp_path):
    from helpers import export_df
    from weekshare.sources.export import prepare_base
    base = prepare_base(export_df(spark, [dict(Owner="LA ", Tons=2.0), dict(Owner="A ", Tons=1.0),
                                          dict(Owner="B ", Tons=1.0, PaisDestinoAWB="BRASIL",
                                               PostaDestinoAWB="GRU", Semana=8)]), "2026-03-11")
    (tmp_path / "workbook.xlsx").write_bytes(b"keep me")
    written = write_reports(base, str(tmp_path), "2026-03-11", 1)
    assert set(written) == set(REPORTS)
    assert (tmp_path / "workbook.xlsx").read_bytes() == b"keep me"  # other files are kept
    # (the local file system keeps hidden .crc checksum files next to them)
    assert sorted(f for f in os.listdir(tmp_path) if not f.startswith(".")) == [
        "dfWeekAWB.csv", "dfWeekFeeder.csv", "dfWeekGTWY.csv", "workbook.xlsx"]
    awb = report(base, "awb", "2026-03-11", 1).collect()
    # EUR - GRU (base view) and EUR - SAO (SAO view) both appear once.
    assert sorted(r.Grupo for r in awb) == ["EUR - GRU", "EUR - LIM", "EUR - LIM", "EUR - SAO"]
    assert sorted(os.path.basename(p) for p in written.values()) == [
        "dfWeekAWB.csv", "dfWeekFeeder.csv", "dfWeekGTWY.csv"]
    lines = open(written["awb"], encoding="utf-8").read().splitlines()
    assert lines[0] == ",".join(REPORT_COLUMNS) and len(lines) == 1 + len(awb)
    # Part 0 (AWB view) rows first, then the SAO view's rows.
    assert [line.split(",")[2] for line in lines[1:]] == ["EUR - GRU", "EUR - LIM", "EUR - LIM", "EUR - SAO"]
    # A second run replaces the files.
    write_reports(base, str(tmp_path), "2026-03-11", 1)
    assert sorted(f for f in os.listdir(tmp_path) if f.endswith(".csv")) == [
        "dfWeekAWB.csv", "dfWeekFeeder.csv", "dfWeekGTWY.csv"]


def test_reports_are_published_every_week(spark, tmp_path):
    from helpers import export_df
    from weekshare.sources.export import prepare_base
    rows = prepare_base(export_df(spark, [dict(Owner="LA ", Tons=2.0), dict(Owner="A ", Tons=1.0)]), AS_OF)
    write_reports(rows, str(tmp_path), AS_OF, 1)
    full = {n: (tmp_path / f"{REPORTS[n][0]}.csv").read_text() for n in REPORTS}
    assert all(len(t.splitlines()) > 1 for t in full.values())
    # Without rows each file is the header alone, and nothing else is left.
    written = write_reports(rows.where("Owner = 'nobody'"), str(tmp_path), AS_OF, 1)
    for n, path in written.items():
        assert open(path, encoding="utf-8").read().splitlines() == [",".join(REPORT_COLUMNS)]
    visible = sorted(f for f in os.listdir(tmp_path) if not f.startswith("."))
    assert visible == ["dfWeekAWB.csv", "dfWeekFeeder.csv", "dfWeekGTWY.csv"]
    # One report with rows, the others without.
    feeder = prepare_base(export_df(spark, [dict(RegionOrigenAWB="Asia", ZonaOrigenAWB="AS_China",
                                                 RegionOrigenSegmento=None, PaisOrigenSegmento=None)]), AS_OF)
    write_reports(feeder, str(tmp_path), AS_OF, 1)
    sizes = {f: len((tmp_path / f).read_text().splitlines()) for f in visible}
    assert sizes == {"dfWeekAWB.csv": 1, "dfWeekFeeder.csv": 2, "dfWeekGTWY.csv": 1}


def test_nan_and_infinite_shares_in_the_file(spark, tmp_path):
    from helpers import export_df
    from weekshare.sources.export import prepare_base
    rows = [dict(Owner="LA ", Tons=5.0), dict(Owner="X ", Tons=-5.0)]
    written = write_reports(prepare_base(export_df(spark, rows), AS_OF), str(tmp_path), AS_OF, 1, ["awb"])
    lines = [x.split(",") for x in open(written["awb"], encoding="utf-8").read().splitlines()]
    by_rank = {x[1]: x for x in lines[1:]}
    assert by_rank["0"][4:6] == ["Infinity", ""] and by_rank["1"][4:6] == ["-Infinity", ""]


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    from helpers import export_df
    from pyspark.sql import functions as F
    from weekshare.sources.export import prepare_base
    path = str(tmp_path / "base")
    base = prepare_base(export_df(spark, [dict(Owner="LA "), dict(Owner="A ")]), AS_OF)
    save_base(base, path)
    with pytest.raises(Exception):
        save_base(base.withColumn("Owner", F.raise_error(F.lit("stop"))), path)
    assert read_base(spark, path).count() == 2
    assert sorted(os.listdir(tmp_path)) == ["base"]


def test_a_failed_write_leaves_the_old_table_of_that_name(spark, tmp_path):
    from helpers import export_df
    from pyspark.sql import functions as F
    from weekshare.sources.export import prepare_base
    from weekshare.sources.warehouse import _table_folder
    base = prepare_base(export_df(spark, [dict(Owner="LA "), dict(Owner="A ")]), AS_OF)
    name = "weekshare_replaced"
    save_base(base, name)                                   # also without ensure_table
    first = _table_folder(spark, name)
    with pytest.raises(Exception):
        save_base(base.withColumn("Owner", F.raise_error(F.lit("stop"))), name)
    assert read_base(spark, name).count() == 2 and _table_folder(spark, name) == first
    save_base(read_base(spark, name).where("Owner = 'A '"), name)       # from its own old rows
    assert [r.Owner for r in read_base(spark, name).collect()] == ["A "]
    folder = _table_folder(spark, name).removeprefix("file:")
    near = [f for f in os.listdir(os.path.dirname(folder)) if f.startswith(name)]
    assert near == [os.path.basename(folder)]               # neither old nor half-written folders
    spark.sql(f"DROP TABLE {name}")
    # An entry of another kind is refused, not replaced.
    spark.sql("CREATE TABLE weekshare_other (a INT) USING parquet")
    with pytest.raises(ValueError):
        save_base(base, "weekshare_other")
    spark.sql("DROP TABLE weekshare_other")


def test_report_files_come_back_in_order(spark, tmp_path):
    from helpers import export_df
    from weekshare.plans.reports import read_report_files
    from weekshare.sources.export import prepare_base
    rows = prepare_base(export_df(spark, [
        dict(Owner="LA ", Tons=2.0), dict(Owner="A ", Tons=1.0),
        dict(Owner="B ", PaisDestinoAWB="BRASIL", PostaDestinoAWB="GRU", Semana=8)]), AS_OF)
    written = write_reports(rows, str(tmp_path), AS_OF, 1)
    back = read_report_files(spark, written).collect()
    for name, path in written.items():
        lines = open(path, encoding="utf-8").read().splitlines()[1:]
        assert [r.excelKEY for r in sorted((r for r in back if r.report == name), key=lambda r: r.line)] == \
            [line.split(",")[0] for line in lines]


def test_weekly_run_from_the_command_line(spark, tmp_path, capsys):
    from weekshare.__main__ import main
    write_export(tmp_path / "w.csv", DATA + [DATA[0].replace("PERU,LIM", "BRASIL,GRU")])
    args = ["--base", str(tmp_path / "base"), "--out", str(tmp_path / "out"), "--as-of", AS_OF]
    main(["--exports", str(tmp_path / "w.csv"), *args])
    said = capsys.readouterr().out
    assert "newest week loaded: 2026-W10; reporting 2026-W10; current: True" in said
    assert "late airport GRU, 2026: weeks [10]" in said
    before = read_base(spark, str(tmp_path / "base")).count()
    write_export(tmp_path / "bad.csv", DATA + [DATA[0].replace("2026,10", "99999,10")])
    with pytest.raises(ExportFormatError, match="invalid_weeks"):
        main(["--exports", str(tmp_path / "bad.csv"), *args])
    assert read_base(spark, str(tmp_path / "base")).count() == before


def test_windows_1252_export(spark, tmp_path):
    d = tmp_path / "exports"
    d.mkdir()
    text = "Market export\n,,weekly\n" + HEADER + "\n" + DATA[0] + "\n"
    (d / "w.csv").write_bytes(text.encode("cp1252"))
    with pytest.raises(ExportFormatError):
        load_base(spark, str(d), "2026-03-11")  # "Año" does not decode as UTF-8
    base = load_base(spark, str(d), AS_OF, encoding="ISO-8859-1").base
    assert [r.Owner for r in base.collect()] == ["LA "]
