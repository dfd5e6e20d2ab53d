import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from weekshare.llm import chunks as C
from weekshare.llm import lm as L

from .cases import documents, mixed


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0D]+", low) + ["</s>"]


def fold(i):
    c = zlib.crc32(str(i).encode() if i is not None else b"")
    return 0 if c % 10 == 0 else 1 if c // 10 % 10 == 0 else 2


def brute(texts, ids):
    """Same model with dictionaries; EM without rounding."""
    rows = [(i, tokens(t), fold(i)) for i, t in zip(ids, texts)]
    uni, bi, uni_r, bi_r = Counter(), Counter(), Counter(), Counter()
    for _, ts, f in rows:
        if f:
            uni.update(ts)
            bi.update(zip(["</s>", *ts], ts))
        if f == 2:
            uni_r.update(ts)
            bi_r.update(zip(["</s>", *ts], ts))
    n, v, n_r, v_r = sum(uni.values()), len(uni), sum(uni_r.values()), len(uni_r)
    held = [(a, b) for _, ts, f in rows if f == 1 for a, b in zip(["</s>", *ts], ts)]

    def em(pairs):
        share = 0.5
        for _ in range(200):
            share = sum(share * x / (share * x + (1 - share) * y) for x, y in pairs) / len(pairs)
            share = min(max(share, 1e-6), 1 - 1e-6)
        return share

    a = em([(uni_r[w] / n_r, 1 / (v_r + 1)) for _, w in held])
    p1 = {w: a * uni_r[w] / n_r + (1 - a) / (v_r + 1) for _, w in held}
    weight, last = {0: 0.0}, 0.0
    for b in range(1, 60):
        mine = [(bi_r[c, w] / uni_r[c], p1[w]) for c, w in held if uni_r[c] and 1 + int(math.log2(uni_r[c])) == b]
        weight[b] = last = em(mine) if mine else last
    out = {}
    for i, ts, f in rows:
        base = sum(math.log10((uni[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        score = 0.0
        for c, w in zip(["</s>", *ts], ts):
            p = a * uni[w] / n + (1 - a) / (v + 1)
            b = 1 + int(math.log2(uni[c])) if uni[c] else 0
            score += math.log10(weight[b] * (bi[c, w] / uni[c] if uni[c] else 0) + (1 - weight[b]) * p)
        out.setdefault(i, []).append((f == 0, len(ts), sum(uni[t] > 0 for t in ts), n, base, score))
    return out


def sample():
    rng = random.Random(4)
    topic = [[f"t{k}w{j}" for j in range(12)] for k in range(9)]
    texts = [" ".join(rng.choice(topic[i % 9]) for _ in range(rng.randrange(5, 60))) for i in range(300)]
    return texts + mixed(n=10)


def test_against_brute_force(spark):
    texts = sample()
    ids = list(range(len(texts) - 2)) + [None, 5]
    want = brute(texts, ids)
    got = L.score_documents(documents(spark, texts, ids)).collect()
    assert len(got) == len(texts)
    for r in got:
        exact = [w for w in want[r.doc_id] if (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
                 and math.isclose(r.base_score, w[4], rel_tol=1e-9)]
        assert exact, (r, want[r.doc_id])
        assert any(math.isclose(r.score, w[5], rel_tol=5e-3) for w in exact), (r, exact)


def test_two_steps_give_the_same(spark, monkeypatch):
    texts = sample()
    ids = list(range(len(texts) - 2)) + [None, 5]
    docs = documents(spark, texts, ids)
    once = sorted(map(str, L.score_documents(docs).select("doc_id", "n_tokens", "n_known", "train_tokens").collect()))
    names, write, chunked, row_counts = [], L.staged, L.write_chunks, {}

    def counted(df, name, *more):
        out = write(df, name, *more)
        names.append(name)
        row_counts[name] = out.count()
        return out

    monkeypatch.setattr(L, "staged", counted)
    monkeypatch.setattr(L, "write_chunks", lambda d, kind, **kw: chunked(d, kind, limit=2000, **kw))
    monkeypatch.setattr(L, "RANGE_BYTES", 500)
    monkeypatch.setattr(C, "FAN", 4)
    got = L.score_documents(docs).collect()
    assert "lm-answers" in names and row_counts["lm-answers"] == row_counts["lm-sent"]
    want = brute(texts, ids)
    assert sorted(map(str, (type(r)(doc_id=r.doc_id, n_tokens=r.n_tokens, n_known=r.n_known,
                                    train_tokens=r.train_tokens) for r in got))) == once
    for r in got:
        exact = [w for w in want[r.doc_id] if (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
                 and math.isclose(r.base_score, w[4], rel_tol=1e-9)]
        assert any(math.isclose(r.score, w[5], rel_tol=5e-3) for w in exact), (r, exact)


def test_range_runs():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 63, 500, dtype=np.int64).astype(np.uint64) * np.uint64(2))
    for ranges in (1, 2, 64, 4096):
        used, cuts = C.range_runs(keys, ranges)
        full = C.range_cuts(keys, ranges)
        assert used.tolist() == np.flatnonzero(np.diff(full)).tolist()
        assert cuts.tolist() == [*full[used].tolist(), len(keys)]
    assert C.range_runs(keys[:0], 8)[0].tolist() == []


def test_held_out_text_is_better_predicted(spark):
    texts = sample()[:300]
    rows = L.score_documents(documents(spark, texts)).where("held_out").collect()
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_probabilities_sum_to_one():
    share, weights, n, v = 0.9, 0.4, 50, 4
    c1, c2 = np.array([20, 15, 10, 5.0]), np.array([3, 0, 1, 0.0])
    p1 = share * c1 / n + (1 - share) / (v + 1)
    unknown = (1 - share) / (v + 1)
    assert math.isclose(p1.sum() + unknown, 1)
    p = weights * c2 / c2.sum() + (1 - weights) * p1
    assert math.isclose(p.sum() + (1 - weights) * unknown, 1)


@pytest.mark.parametrize("texts,ids", [([], []), ([None], [None]), (["a b"], [1]), ([""] * 30, list(range(30)))])
def test_edges(spark, texts, ids):
    rows = L.score_documents(documents(spark, texts, ids)).collect()
    assert len(rows) == len(texts)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
