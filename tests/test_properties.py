"""Random inputs against a brute-force model of the report, plus invariants.

The model restates the AWB and AWB-SAO views in plain Python: SQL sums that
ignore NULL (NULL when every value is NULL), competitor order by newest week
(NULLs last) then carrier, bucket at row number >= 5, IEEE shares.
"""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import export_df, same

from weekshare.plans.market_share import market_share
from weekshare.plans.views import AWB, AWB_SAO
from weekshare.sources.export import prepare_base

AS_OF = "2026-03-11"   # newest reported week 10
ANCHOR = 10

DESTS = [("CHILE", "SCL"), ("BRASIL", "GRU"), ("BRASIL", "VCP"), ("PERU", "LIM"), ("ARGENTINA", "EZE")]
OWNERS = ["LA ", "LA", "A ", "B", "C ", "D", "E ", "F", "Otros ", " G", None]

row_st = st.fixed_dictionaries({
    "RegionOrigenAWB": st.sampled_from(["Europe", "Europe", "Asia", None]),
    "dest": st.sampled_from(DESTS),
    "Owner": st.sampled_from(OWNERS),
    "Tons": st.one_of(st.none(), st.integers(-3, 30).map(float)),
    "Semana": st.integers(ANCHOR - 8, ANCHOR + 1),
})


def sql_sum(values):
    vals = [v for v in values if v is not None]
    return sum(vals) if vals else None


def ieee(x, t):
    if x is None or t is None:
        return None
    if t == 0:
        return math.nan if x == 0 else math.copysign(math.inf, x)
    return x / t


def model(rows, sao):
    cells = {}
    for r in rows:
        if r["RegionOrigenAWB"] != "Europe" or r["Owner"] is None:
            continue
        country, airport = r["dest"]
        dest = "CHILE" if country == "CHILE" else airport if airport in ("GRU", "VCP", "LIM") else None
        if dest is None or (sao and dest not in ("GRU", "VCP")):
            continue
        label = "EUR - SAO" if sao else f"EUR - {dest}"
        lag = 2 if dest in ("GRU", "VCP") else 0
        offset = ANCHOR - lag - r["Semana"]
        vals = cells.setdefault((label, r["Owner"].strip(" ")), [[] for _ in range(5)])
        for i in range(5):
            vals[i].append(r["Tons"] if offset == i else 0.0)
    groups = {}
    for (label, owner), vals in cells.items():
        groups.setdefault(label, []).append((owner, [sql_sum(v) for v in vals]))
    out = {}
    for label, carriers in groups.items():
        comp = sorted([c for c in carriers if c[0] != "LA"],
                      key=lambda c: (c[1][0] is None, -(c[1][0] or 0), c[0]))
        named, bucket = [], []
        for n, (owner, w) in enumerate(comp, start=1):
            (bucket if n >= 5 or owner == "Otros" else named).append((owner, w))
        rows_out = [(0, "LA", w) for o, w in carriers if o == "LA"]
        rows_out += [(k, o, w) for k, (o, w) in enumerate(named, start=1)]
        if bucket:
            rows_out.append((99, "Otros", [sql_sum([w[i] for _, w in bucket]) for i in range(5)]))
        totals = [sql_sum([w[i] for _, _, w in rows_out]) for i in range(5)]
        for rank, owner, w in rows_out:
            out[f"{rank}{label}"] = (rank, owner, w, [ieee(w[i], totals[i]) for i in range(5)])
    return out


def spark_rows(spark, rows, view, partitions):
    export = export_df(spark, [dict(PaisDestinoAWB=r["dest"][0], PostaDestinoAWB=r["dest"][1],
                                    RegionOrigenAWB=r["RegionOrigenAWB"], Owner=r["Owner"],
                                    Tons=r["Tons"], Semana=r["Semana"]) for r in rows])
    base = prepare_base(export.repartition(partitions), AS_OF)
    return {r.excelKEY: r for r in market_share(base, view, AS_OF, 1).collect()}


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row_st, min_size=1, max_size=40), partitions=st.integers(1, 5),
       sao=st.booleans())
def test_matches_brute_force(spark, rows, partitions, sao):
    got = spark_rows(spark, rows, AWB_SAO if sao else AWB, partitions)
    expected = model(rows, sao)
    assert set(got) == set(expected)
    for key, (rank, owner, w, shares) in expected.items():
        r = got[key]
        assert (r.Rank, r.OwnerGrpd) == (rank, owner)
        assert all(same(a, b) for a, b in zip([r.W, r.Wm1, r.Wm2, r.Wm3, r.Wm4], w)), key
        assert all(same(a, b) for a, b in zip([r.Wr, r.Wm1r, r.Wm2r, r.Wm3r, r.Wm4r], shares)), key
    # Invariants: ranks are {0} + 1..k + {99} with k <= 4; at most one home
    # and one bucket row per group; finite shares sum to 1 per group and week.
    by_group = {}
    for r in got.values():
        by_group.setdefault(r.Grupo, []).append(r)
    for rows_g in by_group.values():
        ranks = sorted(r.Rank for r in rows_g)
        named = [k for k in ranks if 0 < k < 99]
        assert named == list(range(1, len(named) + 1)) and len(named) <= 4
        assert ranks.count(0) <= 1 and ranks.count(99) <= 1
        for i, c in enumerate(["Wr", "Wm1r", "Wm2r", "Wm3r", "Wm4r"]):
            vals = [r[c] for r in rows_g]
            if all(v is not None and math.isfinite(v) for v in vals):
                assert abs(sum(vals) - 1.0) < 1e-9


def test_relabelling_weeks_changes_nothing(spark):
    """Shifting every week and the anchor by the same amount."""
    rows = [dict(RegionOrigenAWB="Europe", dest=("PERU", "LIM"), Owner=o, Tons=t, Semana=s)
            for o, t, s in (("LA ", 5.0, 10), ("A ", 3.0, 9), ("B ", 2.0, 10), ("A ", 1.0, 6))]
    first = spark_rows(spark, rows, AWB, 2)
    export = export_df(spark, [dict(PaisDestinoAWB="PERU", PostaDestinoAWB="LIM", Owner=r["Owner"],
                                    Tons=r["Tons"], Semana=r["Semana"] + 20) for r in rows])
    later = {r.excelKEY: r for r in market_share(prepare_base(export, "2026-07-29"), AWB,
                                                 "2026-07-29", 1).collect()}
    assert set(first) == set(later)
    for k in first:
        assert all(same(a, b) for a, b in zip(first[k], later[k])), k
