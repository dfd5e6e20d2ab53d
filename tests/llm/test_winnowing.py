import hashlib
import random
import zlib
from collections import Counter

import pytest

from weekshare.llm import winnowing as W

from .cases import documents, mixed, words


def value(gram):
    numbers = [zlib.crc32(c.encode("utf-32-be")) % W.MASK for c in gram]
    h = 0
    for c in numbers + [0] * (W.GRAM - len(gram)):
        h = (h * W.BASE + c) % W.MASK
    return h


def brute(text):
    """``(hash, position)`` kept, straight from the definition."""
    n = max(1, len(text) - W.GRAM + 1) if text else 0
    h = [value(text[i:i + W.GRAM]) for i in range(n)]
    kept = []
    for i in range(max(1, n - W.WINDOW + 1) if n else 0):
        window = h[i:i + W.WINDOW]
        at = i + max(j for j, x in enumerate(window) if x == min(window))
        if (h[at], at) not in kept[-1:]:
            kept.append((h[at], at))
    return kept


def parsed(s):
    return [tuple(map(int, p.split(":"))) for p in s.split(",")] if s else []


def ordered(texts, ids):
    """Row numbers by descending id; equal ids stay ambiguous."""
    return sorted(range(len(texts)), key=lambda x: (ids[x] is not None, ids[x] or 0), reverse=True)


@pytest.fixture(scope="module")
def result(spark):
    texts = mixed(3, 160)
    # Empty, null and short next texts, and lengths around a window, a stretch and a piece.
    for n in (0, 1, 2, 7, 8, 9, 21, 22, 23, 24, 33, 34, 35, 54, 55, 66, 511, 512, 513, 534, 535, 1046):
        texts += [words(random.Random(n), 400)[:n], [None, "", "z", "äö"][n % 4]]
    ids = [7 * i % 1009 for i in range(len(texts))]
    rows = {r.doc_id: r for r in W.with_edited(documents(spark, texts, ids)).collect()}
    return texts, ids, rows


def test_against_brute_force(spark, result):
    texts, ids, rows = result
    order = ordered(texts, ids)
    edited = {}
    for x, y in zip(order, order[1:] + order[:1]):
        t, nxt = texts[x] or "", texts[y] or ""
        m = len(t) // 3
        edited[x] = t[:len(t) - m] + nxt[:m]
    sets = {}
    for x in order:
        r = rows[ids[x]]
        t = texts[x] or ""
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited[x].encode()).hexdigest()
        for got, source in ((r.fingerprint, t), (r.edited_fingerprint, edited[x])):
            assert sorted(parsed(got), key=lambda p: p[1]) == sorted(set(brute(source)), key=lambda p: p[1])
        sets[x] = ({h for h, _ in parsed(r.fingerprint)}, {h for h, _ in parsed(r.edited_fingerprint)})

    def like(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    for x, y in zip(order, order[1:] + order[:1]):
        assert rows[ids[x]].near_edited == pytest.approx(like(*sets[x]))
        assert rows[ids[x]].near_next == pytest.approx(like(sets[x][0], sets[y][0]))


def test_equal_texts_and_the_plain_operator(spark, result):
    texts, ids, rows = result
    plain = {r.doc_id: r.fingerprint for r in W.fingerprint(documents(spark, texts, ids)).collect()}
    for x, t in enumerate(texts):
        assert set(parsed(plain[ids[x]])) == set(parsed(rows[ids[x]].fingerprint))
    by_text = {}
    for x, t in enumerate(texts):
        by_text.setdefault(t or "", set()).add(rows[ids[x]].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())


def test_ranges_and_repeated_ids(spark, monkeypatch):
    """Many ranges, and one id that holds most rows, give the order's own pairs."""
    rng = random.Random(9)
    texts = [words(rng, rng.randrange(1, 12)) for _ in range(240)]
    ids = [50 if i % 3 else i for i in range(len(texts))]
    ids[:4] = [None] * 4
    docs = documents(spark, texts, ids)
    monkeypatch.setattr(W, "RANGE_BYTES", 100)
    rows = W.with_next(docs).collect()
    sizes = Counter(r.part for r in rows)
    assert max(sizes.values()) < 40                     # 160 rows have the id 50
    ranked = sorted(rows, key=lambda r: (-r.part, r.row))
    assert [r.t for r in ranked[1:]] + [ranked[0].t] == [r.next_t for r in ranked]
    order = [r.doc_id for r in ranked]
    assert order[-4:] == [None] * 4 and order[:-4] == sorted(order[:-4], reverse=True)
    assert len(W.with_edited(docs).collect()) == len(texts)


def test_prefixes_are_the_windows_own(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(23, 90))) for _ in range(30)]
    rows = [(i, t, n) for i, t in enumerate(texts) for n in range(0, len(t) - 21)]
    df = spark.createDataFrame(rows, "doc_id long, t string, windows int").repartition("doc_id", "windows")
    kept = W.kept_of(df, ["doc_id", "windows"], {"kept": ("t", "0")}, ["t"])
    for r in kept.selectExpr("t", "windows", f"{W.rendered(W.prefix('kept', 'windows'))} AS p").collect():
        assert parsed(r.p) == (brute(r.t[:r.windows + 22]) if r.windows else [])


@pytest.mark.parametrize("texts,ids", [([], []), (["only one text here, quite short"], [3]),
                                       ([None, "", "b" * 40, "b" * 40], [None, None, None, 1])])
def test_edges(spark, texts, ids):
    rows = W.with_edited(documents(spark, texts, ids)).collect()
    assert len(rows) == len(texts)
    if len(texts) == 1:
        assert rows[0].near_next == 1.0


def test_no_python_in_the_plan(spark):
    plan = W.with_edited(documents(spark, ["a", "b"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
