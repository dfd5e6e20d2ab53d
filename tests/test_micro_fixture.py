"""The hand-checked micro fixture of FIXTURES.md §3 and further edge cases."""

import math

from helpers import export_df, rows_by, same

from weekshare.plans.market_share import market_share
from weekshare.plans.views import AWB, AWB_SAO, FEEDER, GATEWAY, GATEWAY_SAO
from weekshare.sources.export import prepare_base

# ISO week 11 of 2026, one week back: the newest reported week is 10.
AS_OF = "2026-03-11"

LIM = dict(PaisDestinoAWB="PERU", PostaDestinoAWB="LIM")
GRU = dict(PaisDestinoAWB="BRASIL", PostaDestinoAWB="GRU")
SCL = dict(PaisDestinoAWB="CHILE", PostaDestinoAWB="SCL")
EZE = dict(PaisDestinoAWB="ARGENTINA", PostaDestinoAWB="EZE")


def micro_rows():
    rows = [dict(LIM, Owner="LA ", Tons=40.0)]
    rows += [dict(LIM, Owner=o, Tons=t) for o, t in (("A ", 30.0), ("B ", 20.0), ("C ", 10.0))]
    rows += [dict(LIM, Owner="QT ", Tons=15.0), dict(LIM, Owner="E ", Tons=5.0),
             dict(LIM, Owner="D ", Tons=5.0), dict(LIM, Owner=None, Tons=1000.0)]
    rows += [dict(GRU, Owner="LA ", Tons=10.0, Semana=8), dict(GRU, Owner="LA ", Tons=99.0),
             dict(GRU, Owner="Z ", Tons=None, Semana=8)]
    rows += [dict(SCL, Owner="LA ", Tons=5.0), dict(SCL, Owner="X ", Tons=-5.0)]
    rows += [dict(EZE, Owner="LA ", Tons=7.0)]
    return rows


def run(spark, view, rows, as_of=AS_OF, back=1):
    base = prepare_base(export_df(spark, rows), as_of)
    return market_share(base, view, as_of, back)


def test_awb_view_by_hand(spark):
    got = rows_by(run(spark, AWB, micro_rows()), "excelKEY")
    expected = {
        "0EUR - CHILE": (0, "LA", 5.0, math.inf),
        "1EUR - CHILE": (1, "X", -5.0, -math.inf),
        "0EUR - GRU": (0, "LA", 10.0, 1.0),
        "1EUR - GRU": (1, "Z", None, None),
        "0EUR - LIM": (0, "LA", 40.0, 0.32),
        "1EUR - LIM": (1, "A", 30.0, 0.24),
        "2EUR - LIM": (2, "B", 20.0, 0.16),
        "3EUR - LIM": (3, "AV", 15.0, 0.12),
        "4EUR - LIM": (4, "C", 10.0, 0.08),
        "99EUR - LIM": (99, "Otros", 10.0, 0.08),
    }
    assert set(got) == set(expected)
    for key, (rank, owner, w, wr) in expected.items():
        r = got[key]
        assert (r["Rank"], r["OwnerGrpd"]) == (rank, owner), key
        assert same(r["W"], w) and same(r["Wr"], wr), (key, r)
        # Older weeks are all zero: 0 / 0 is NaN (IEEE), not NULL.
        assert r["Wm1"] == 0.0 and math.isnan(r["Wm1r"]), key
    assert list(run(spark, AWB, micro_rows()).columns) == [
        "excelKEY", "Rank", "Grupo", "OwnerGrpd", "Wr", "Wm1r", "Wm2r", "Wm3r", "Wm4r",
        "W", "Wm1", "Wm2", "Wm3", "Wm4"]


def test_sao_view_merges_late_airports(spark):
    rows = [dict(GRU, Owner="LA ", Tons=10.0, Semana=8),
            dict(PaisDestinoAWB="BRASIL", PostaDestinoAWB="VCP", Owner="LA ", Tons=30.0, Semana=8),
            dict(LIM, Owner="LA ", Tons=1.0)]
    got = rows_by(run(spark, AWB_SAO, rows), "excelKEY")
    assert set(got) == {"0EUR - SAO"}
    assert got["0EUR - SAO"]["W"] == 40.0


def test_null_flight_type_forms_null_group(spark):
    rows = [dict(SCL, TipoVuelo=None, Owner="LA ", Tons=3.0),
            dict(SCL, TipoVuelo="PAX", Owner="LA ", Tons=2.0)]
    got = run(spark, GATEWAY, rows).collect()
    labels = sorted((r.Grupo is None, r.Grupo, r.excelKEY) for r in got)
    assert labels == [(False, "EUR - CHILE PAX", "0EUR - CHILE PAX"), (True, None, None)]
    # Without the flight type in the label (SAO view) both rows share a group.
    got = run(spark, GATEWAY_SAO, rows).collect()
    assert [(r.Grupo, r.W) for r in got] == [("EUR - CHILE", 5.0)]


def test_carrier_named_otros_joins_bucket_and_ranks_close_up(spark):
    rows = [dict(LIM, Owner=o, Tons=t) for o, t in
            (("Otros ", 50.0), ("A ", 40.0), ("B ", 30.0), ("C ", 20.0), ("D ", 10.0), ("E ", 5.0))]
    got = rows_by(run(spark, AWB, rows), "OwnerGrpd")
    # "Otros" is first by tons but goes to the bucket; A..C keep ranks 1..3
    # without a gap; D (row number 5) and E go to the bucket too.
    assert {k: v["Rank"] for k, v in got.items()} == {"A": 1, "B": 2, "C": 3, "Otros": 99}
    assert got["Otros"]["W"] == 65.0


def test_recode_needs_the_blank_and_trim_is_unicode(spark):
    rows = [dict(LIM, Owner="QT", Tons=1.0), dict(LIM, Owner="QT ", Tons=2.0),
            dict(LIM, Owner="\tLA ", Tons=4.0)]
    got = {r.OwnerGrpd: (r.Rank, r.W) for r in run(spark, AWB, rows).collect()}
    assert got == {"LA": (0, 4.0), "AV": (1, 2.0), "QT": (2, 1.0)}


def test_misspelt_region_and_null_zone(spark):
    rows = [dict(SCL, RegionOrigenSegmento="Europe", RegionOrigenAWB="Africa", PaisOrigenSegmento="ESPANA",
                 PaisOrigenAWB="KENIA", Owner="LA ", Tons=1.0),
            dict(SCL, RegionOrigenSegmento="Europe", RegionOrigenAWB="Arfica", PaisOrigenSegmento="ESPANA",
                 PaisOrigenAWB="SUDAFRICA", Owner="LA ", Tons=2.0)]
    got = [(r.Grupo, r.W) for r in run(spark, GATEWAY, rows).collect()]
    # Only the misspelt region is European at the gateway; "Africa" falls
    # through to neither EUR nor USA.
    assert got == [("EUR - CHILE PAX", 2.0)]
    rows = [dict(LIM, RegionOrigenAWB="Asia", ZonaOrigenAWB=None, PaisOrigenAWB="COREA", Owner="LA ", Tons=1.0),
            dict(LIM, RegionOrigenAWB="Asia", ZonaOrigenAWB="AS_China", PaisOrigenAWB="CHINA", Owner="LA ", Tons=2.0)]
    got = [(r.Grupo, r.W) for r in run(spark, FEEDER, rows).collect()]
    # A NULL zone makes "zone != AS_India" unknown: the row is not ASIA.
    assert got == [("ASIA - LIM", 2.0)]


def test_asia_groups_show_nine_competitors(spark):
    asia = dict(LIM, RegionOrigenAWB="Asia", ZonaOrigenAWB="AS_China", PaisOrigenAWB="CHINA")
    de = dict(LIM)
    rows = [dict(asia, Owner=f"C{i:02d} ", Tons=100.0 - i) for i in range(12)]
    rows += [dict(de, Owner=f"C{i:02d} ", Tons=100.0 - i) for i in range(12)]
    got = run(spark, FEEDER, rows).collect()
    ranks = {}
    for r in got:
        ranks.setdefault(r.Grupo, []).append(r.Rank)
    assert sorted(ranks["ASIA - LIM"]) == list(range(1, 10)) + [99]
    assert sorted(ranks["DE - LIM"]) == [1, 2, 3, 4, 99]


def test_zero_weeks_carrier_still_shown_and_window_crosses_year(spark):
    # Anchor 0 (as_of in ISO week 1 of 2021): week 53 of 2020 is RelWeek 0.
    rows = [dict(LIM, Year=2020, Semana=53, Owner="LA ", Tons=7.0),
            dict(LIM, Year=2020, Semana=49, Owner="B ", Tons=3.0),
            dict(LIM, Year=2019, Semana=10, Owner="Z ", Tons=1.0)]
    got = rows_by(run(spark, AWB, rows, as_of="2021-01-06", back=1), "OwnerGrpd")
    assert got["LA"]["W"] == 7.0
    assert got["B"]["Wm4"] == 3.0
    # Z has no tons in the five weeks but still forms a row (no week filter).
    assert got["Z"]["W"] == 0.0 and got["Z"]["Rank"] == 2


def test_views_in_one_scan_equal_views_alone(spark):
    views = [AWB, AWB_SAO, GATEWAY, GATEWAY_SAO, FEEDER]
    base = prepare_base(export_df(spark, micro_rows()), AS_OF)
    together = {(r.view, r.excelKEY): r.asDict() for r in market_share(base, views, AS_OF, 1).collect()}
    alone = {}
    for v in views:
        for r in market_share(base, v, AS_OF, 1).collect():
            alone[(v.name, r.excelKEY)] = r.asDict()
    assert set(together) == set(alone)
    for k, r in alone.items():
        assert all(same(r[c], together[k][c]) for c in r), k


def test_decimal_sums_make_shared_rows_identical(spark):
    from weekshare.plans.reports import report
    # Fractional tons whose double sum depends on the order of addition.
    rows = [dict(LIM, Owner="LA ", Tons=t, TipoVuelo=f) for t, f in
            ((0.1, "PAX"), (0.2, "CAO"), (0.3, None), (1e16, "PAX"), (-1e16, "CAO"))]
    rows += [dict(LIM, Owner="A ", Tons=0.7)]
    base = prepare_base(export_df(spark, rows), AS_OF)
    exact = report(base, "gateway", AS_OF, 1, tons_type="decimal(38,6)").collect()
    # Gateway and Gateway-SAO both hold EUR - LIM: one copy per row survives.
    assert sorted((r.Grupo, r.OwnerGrpd, r.part) for r in exact) == [
        ("EUR - LIM", "A", 0), ("EUR - LIM", "LA", 0)]
    la = [r for r in exact if r.OwnerGrpd == "LA"][0]
    assert la.W == 0.6 and isinstance(la.W, float)


def test_country_beats_airport_and_null_segment_country(spark):
    rows = [dict(PaisDestinoAWB="CHILE", PostaDestinoAWB="GRU", Owner="LA ", Tons=1.0),
            # NULL segment country: "!= 'USA'" is unknown, so only the waybill
            # country could still make the row USA, and here it is not.
            dict(SCL, RegionOrigenSegmento="North America", RegionOrigenAWB="North America",
                 PaisOrigenSegmento=None, PaisOrigenAWB="CANADA", Owner="LA ", Tons=2.0),
            dict(SCL, RegionOrigenSegmento="North America", RegionOrigenAWB="North America",
                 PaisOrigenSegmento="MEXICO", PaisOrigenAWB="USA", Owner="LA ", Tons=4.0)]
    got = sorted((r.Grupo, r.W) for r in run(spark, GATEWAY, rows).collect())
    # Row 1 is CHILE (country first), not GRU, and lands in EUR - CHILE PAX.
    assert got == [("EUR - CHILE PAX", 1.0), ("USA - CHILE PAX", 4.0)]


def test_nan_tons_count_as_null_even_without_the_loader(spark):
    from weekshare.sources.schema import BASE_COLUMNS, BASE_SCHEMA
    from helpers import DEFAULTS
    rows = []
    for owner, tons in (("LA", 5.0), ("A", float("nan")), ("B", 1.0)):
        d = dict(DEFAULTS, Owner=owner, Tons=tons, RelWeek=10)
        rows.append(tuple(d[c] for c in BASE_COLUMNS))
    base = spark.createDataFrame(rows, BASE_SCHEMA)
    got = {r.OwnerGrpd: (r.Rank, r.W) for r in market_share(base, AWB, AS_OF, 1).collect()}
    assert got == {"LA": (0, 5.0), "B": (1, 1.0), "A": (2, None)}


def test_single_pass_equals_the_literal_union(spark):
    from helpers import three_branch
    from weekshare.operators.collapse import collapse_buckets
    from weekshare.plans.market_share import PART, bucketed_rows
    views = [AWB, AWB_SAO, GATEWAY, GATEWAY_SAO, FEEDER]
    bucketed = bucketed_rows(prepare_base(export_df(spark, micro_rows()), AS_OF), views, AS_OF, 1)
    cols = ["view", "Rank", "Grupo", "OwnerGrpd", "W", "Wm1", "Wm2", "Wm3", "Wm4"]
    one = collapse_buckets(bucketed, PART).select(*cols).collect()
    three = three_branch(bucketed, PART).select(*cols).collect()
    assert sorted(map(str, one)) == sorted(map(str, three))


def test_threshold_of_a_null_label_by_number_of_prefixes(spark):
    from dataclasses import replace
    want = {0: {None: 5, "ASIA - X": 5, "EUR - X": 5, "Z": 5},
            1: {None: 10, "ASIA - X": 10, "EUR - X": 5, "Z": 5},
            2: {None: 10, "ASIA - X": 10, "EUR - X": 7, "Z": 5}}
    for n, expected in want.items():
        view = replace(FEEDER, topn_prefix=(("ASIA", 10), ("EUR", 7))[:n])
        df = spark.createDataFrame([(g,) for g in expected], "Grupo string")
        got = df.selectExpr("Grupo", f"{view.threshold_sql()} AS n").collect()
        assert {r.Grupo: r.n for r in got} == expected


def test_old_carriers_keep_their_rank(spark):
    # A carrier without tons in the five weeks still takes a place.
    rows = [dict(LIM, Owner=f"{o} ", Tons=t) for o, t in (("A", 9.0), ("B", 8.0), ("M", 1.0))]
    rows += [dict(LIM, Owner="OLD ", Tons=5.0, Semana=2), dict(LIM, Owner="N ", Tons=0.5)]
    got = {r.OwnerGrpd: (r.Rank, r.W) for r in run(spark, AWB, rows).collect()}
    assert got == {"A": (1, 9.0), "B": (2, 8.0), "M": (3, 1.0), "N": (4, 0.5), "Otros": (99, 0.0)}


def test_newest_week_across_the_year_boundary(spark):
    from weekshare.plans.quality import lagged_weeks, latest_week
    rows = [dict(LIM, Year=2020, Semana=53), dict(GRU, Year=2020, Semana=52), dict(LIM, Year=2019, Semana=52)]
    bad = [dict(LIM, Year=99999, Semana=10), dict(LIM, Year=2020, Semana=54), dict(LIM, Year=None, Semana=1)]
    base = prepare_base(export_df(spark, rows + bad), "2021-01-06")
    r = latest_week(base, "2021-01-06", 1).first()
    assert tuple(r) == (2020, 53, 2020, 53, True)
    assert tuple(latest_week(base, "2021-01-13", 1).first()) == (2020, 53, 2021, 1, False)
    assert tuple(latest_week(base.where("Year = 99999"), "2021-01-13", 1).first()) == (None, None, 2021, 1, False)
    assert [tuple(x) for x in lagged_weeks(base).collect()] == [(2020, "GRU", 52, 1)]
