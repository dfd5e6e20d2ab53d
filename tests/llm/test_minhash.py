import random
import re
from collections import defaultdict

import numpy as np
import pytest

from weekshare.llm import minhash as M

from .cases import documents, mixed, words


def shingle_set(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(texts, ids, k, percent):
    sets = [shingle_set(t, k) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for x, s in enumerate(sets):
        for g in s:
            holders[g].append(x)
    for x, s in enumerate(sets):
        for y in {y for g in s for y in holders[g] if y < x}:
            if 100 * len(s & sets[y]) >= percent * len(s | sets[y]):
                parent[find(x)] = find(y)
    best = {}
    for x, i in enumerate(ids):
        if i is not None:
            best[find(x)] = min(best.get(find(x), i), i)
    return [(i, len(sets[x]), best.get(find(x))) for x, i in enumerate(ids)]


def near_copies(seed=2):
    rng = random.Random(seed)
    texts = mixed(seed, 25)
    for family in range(12):
        base = words(rng, 60 + 10 * family).split()
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
            texts.append(rng.choice([" ", "\n", "  "]).join(w))
    chain = words(rng, 120, 5000).split()           # neighbours are linked, ends are not
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = chain[2:] + [f"n{rng.randrange(10**6)}" for _ in range(2)]
    return texts


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, k, percent):
    texts = near_copies()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    got = M.near_duplicates(documents(spark, texts, ids), k, percent).select("doc_id", "_n", "_component", "_stays")
    rows = sorted(tuple(r)[:3] for r in got.collect())
    assert rows == sorted(brute(texts, ids, k, percent))
    groups = defaultdict(list)
    for r in got.collect():
        groups[r._component if r._n else ("none", r.doc_id)].append(r._stays)
    assert all(sum(g) == 1 for g in groups.values())


def test_blocks_give_the_same(spark, monkeypatch):
    texts, ids = near_copies(5), None
    ids = list(range(len(texts)))
    for name, value in (("BLOCK", 3), ("BLOCK_SHINGLES", 300), ("STAR", 2), ("SMALL", 2), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(M, name, value)
    got = M.near_duplicates(documents(spark, texts, ids), 3, 85).select("doc_id", "_n", "_component").collect()
    assert sorted(map(tuple, got)) == sorted(brute(texts, ids, 3, 85))


def one_family(n, seed=3):
    """``n`` different near copies of one text, and a few that only come near."""
    rng = random.Random(seed)
    base = words(rng, 150, 5000).split()
    texts = []
    for x in range(n):
        w = list(base)
        for place in rng.sample(range(150), 4 if x % 50 == 7 else 1):
            w[place] = f"n{x}p{place}"
        texts.append(" ".join(w))
    return texts


def test_texts_shipped_grow_with_the_cluster(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 60)
    shipped, write = [], M.staged

    def counted(df, name, *more):
        out = write(df, name, *more)
        if name == "minhash-wanted":
            shipped.append(out.count())
        return out

    monkeypatch.setattr(M, "staged", counted)
    for n in (300, 1200):
        shipped.clear()
        texts = one_family(n)
        got = M.near_duplicates(documents(spark, texts), 5, 80).select("doc_id", "_n", "_component").collect()
        assert sorted(map(tuple, got)) == sorted(brute(texts, list(range(n)), 5, 80))
        assert n <= sum(shipped) < 3.5 * n, shipped


def test_null_and_repeated_ids(spark):
    texts, ids = ["a b c d", "a b c d", "A b  c d", "x y", None, "x y"], [None, 7, 7, None, None, None]
    rows = M.near_duplicates(documents(spark, texts, ids), 3, 85).collect()
    assert sorted((r._component, r._stays) for r in rows if r._n == 2) == [(7, False), (7, False), (7, True)]
    assert sorted(r._stays for r in rows if r._n == 1) == [False, True]
    assert [r._stays for r in rows if not r._n] == [True]


def test_empty(spark):
    assert M.near_duplicates(documents(spark, []), 3, 85).count() == 0


def test_drop_keeps_columns_and_one_of_each(spark):
    texts = near_copies(7)
    docs = documents(spark, texts)
    out = M.drop_near_duplicates(docs, 5, 80)
    assert out.columns == docs.columns
    rows = out.collect()
    assert {r.doc_id for r in rows} == {c for i, n, c in brute(texts, list(range(len(texts))), 5, 80) if n} | \
        {i for i, t in enumerate(texts) if not shingle_set(t, 5)}
    assert all(r.text == texts[r.doc_id] for r in rows)


def test_clashing_columns(spark):
    names = ["digest", "best", "cid", "key", "i", "rid", "_n", "_stays", "_rid", "node", "c0"]
    docs = documents(spark, ["a b c", "a b c", "d e"]).drop("rid")
    for n in names:
        docs = docs.selectExpr("*", f"'{n}' AS `{n}`")
    out = M.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(tuple(r[n] for n in ["doc_id", *names]) for r in out.collect()) == [(0, *names), (2, *names)]


def test_estimate_is_unbiased():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.6, 0.9):
        got = []
        for _ in range(60):
            n = 400
            both = int(round(2 * n * share / (1 + share)))
            h = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.int64).astype(np.uint64) * np.uint64(2)
            a, b = np.sort(h[:n]), np.sort(h[n - both:])
            low = M.minima(np.concatenate([a, b]), np.array([0, n, 2 * n]))
            sig = np.ascontiguousarray(M.signature(low)).view("<u8")
            got.append(M.corrected(M.equal_codes(sig[0], sig[1])))
        assert abs(np.mean(got) - share) < 0.03
    a = rng.integers(0, 256, (50, 64), dtype=np.uint8)
    b = rng.integers(0, 256, (50, 64), dtype=np.uint8)
    direct = ((a & 15) == (b & 15)).sum(1) + ((a >> 4) == (b >> 4)).sum(1)
    assert (M.equal_codes(a.view("<u8"), b.view("<u8")) == direct).all()


def test_shared_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(20)]
    got = M.shared_counts(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))
