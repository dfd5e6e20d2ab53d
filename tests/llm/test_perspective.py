from collections import defaultdict

import duckdb
import pytest

from weekshare.llm import perspective as P

TURNS = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi <|im_end|> all"), (1, 2, "bob", None),
    (1, 3, "ann", "ok"), (1, 3, "ann", "ok"), (1, 200, "c d", "late"), (1, None, "bob", "first"),
    (2, 0, "System", "only system"), (3, 0, None, "who"), (3, 1, " ", "me"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "yes"), (4, 5, "user", ""),
]


@pytest.fixture(scope="module")
def turns(spark):
    long = [(9, t, ("user", "assistant", "eve")[t % 3], f"text {t}") for t in range(500)]
    return spark.createDataFrame([(*r, 1, "x") for r in TURNS + long],
                                 "conv_id long, turn int, role string, text string, start int, segment string")


def brute(rows):
    out = []
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        who = (role or "").strip(" ") or "unknown"
        by[conv].append((turn is not None, turn or 0, who, (text or "").replace("<|", "< |"), turn))
    for conv, ts in by.items():
        ts.sort(key=lambda t: t[:4])
        for me in {t[2] for t in ts if t[2].lower() != "system"}:
            at = 0
            for pos, (_, _, who, text, turn) in enumerate(ts):
                name = "".join(c if c.isascii() and (c.isalnum() or c in "_-") else "_" for c in who)
                mine = who == me
                head = ("system" if who.lower() == "system" else "assistant" if mine else f"user name={name}")
                seg = f"<|im_start|>{head}\n{text}<|im_end|>\n"
                mask = (at + 13 + len(head), at + len(seg) - 1) if mine else (None, None)
                out.append((conv, me, pos, turn, seg, at, *mask))
                at += len(seg)
    return sorted(out, key=str)


def test_against_brute_force(spark, turns):
    got = P.rotate_perspectives(turns).select(
        "conv_id", "perspective", "position", "turn", "segment", "start", "mask_start", "mask_stop").collect()
    rows = [tuple(r)[:4] for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_sql_agrees(spark, turns):
    con = duckdb.connect()
    con.register("conversations", turns.select("conv_id", "turn", "role", "text").toPandas()
                 .astype({"conv_id": "Int64", "turn": "Int32"}))
    names = sorted(P.rotate_perspectives(turns).columns)
    got = sorted((tuple(r[n] for n in names) for r in P.rotate_perspectives(turns).collect()), key=str)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({P.OP10_SQL})").fetchall()
    assert got == sorted(want, key=str)


def test_no_python_in_the_plan(spark, turns):
    df = P.rotate_perspectives(turns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_empty(spark, turns):
    assert P.rotate_perspectives(turns.where("false")).count() == 0
