import math
import random
from collections import defaultdict

import pytest

from weekshare.llm import quality as Q

from .cases import documents, mixed, words

LABELS = "doc_id long, quality int, toxic int, text string, source int"


def corpus(seed=1, n=900):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        kind = rng.choice(["good"] * 6 + ["toxic", "junk"])
        w = words(rng, rng.randrange(20, 90)).split()
        if kind == "toxic":
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(["idiot", "moron", "trash"])
        if kind == "junk":
            w = [x.upper() + "!!$$" for x in w]
        texts.append(" ".join(w))
        labels.append((i, int(kind != "junk"), int(kind == "toxic"), "x", 0))
    return texts, labels


def test_held_out_accuracy(spark):
    texts, labels = corpus()
    seen = spark.createDataFrame(labels[:500], LABELS)
    out = Q.classify(documents(spark, texts), seen).collect()
    assert len(out) == len(texts)
    truth = {i: bool(q and not t) for i, q, t, *_ in labels}
    right = sum(r._kept == truth[r.doc_id] for r in out if r.doc_id >= 500)
    assert right >= 0.97 * (len(texts) - 500)


@pytest.mark.parametrize("limit", [0, Q.BROADCAST_SITES])
def test_cases(spark, limit, monkeypatch):
    monkeypatch.setattr(Q, "BROADCAST_SITES", limit)
    texts, labels = corpus(2, 300)
    texts += mixed()
    ids = list(range(len(texts) - 3)) + [None, None, 5]
    docs = documents(spark, texts, ids)
    labels += [(None, 1, 0, "x", 0), (3, None, 1, "x", 0), (10**9, 0, 1, "x", 0), labels[0]]
    kept = Q.keep_good(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns and kept.count() <= len(texts)
    assert Q.classify(docs.where("false"), spark.createDataFrame(labels, LABELS)).count() == 0
    for few in ([], labels[:1]):
        none = Q.classify(docs, spark.createDataFrame(few, LABELS))
        assert none.where("_kept").count() == len(texts)


def test_clashing_columns(spark):
    texts, labels = corpus(3, 200)
    docs = documents(spark, texts)
    want = {r.doc_id for r in Q.keep_good(docs, spark.createDataFrame(labels, LABELS)).collect()}
    for n in ("_kept", "_toxic", "_p_junk", "s_host", "site_toxic", "__x", "_h", "n"):
        docs = docs.selectExpr("*", f"'{n}' AS `{n}`")
    out = Q.keep_good(docs, spark.createDataFrame(labels, LABELS))
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == want


@pytest.mark.parametrize("host", [1, None])
def test_sparse_sites_shrink(spark, host):
    rows = [(1.0, "a", "a/x")] * 300 + [(-9.0, "b", "b/x")] * 300 + [(9.0, "c", "c/x")] + [(0.0, None, "n")] * 3
    rows += [(1.0, "a", "a/y")]
    scored = spark.createDataFrame([(t, t, h, p) for t, h, p in rows], "_toxic double, _junk double, h string, p string")
    model = {"heads": {"toxic": (None, 0.0, 0.0), "junk": (None, 0.0, 0.0)}}
    got = {(r.s_host, r.s_path): r.site_toxic for r in Q.site_posteriors(scored, model, "h", "p").collect()}
    assert len(got) == 5
    assert got["b", "b/x"] < got["c", "c/x"] < 5 and got["a", "a/x"] > got["b", "b/x"]
    assert abs(got["a", "a/y"] - got["a", "a/x"]) < 0.5      # one document: close to its host


def brute_force(rows, priors):
    """Final probabilities, document by document: ``rows`` of (host, path, evidence per head)."""
    def sigmoid(z):
        return 1 / (1 + math.exp(-z))

    def weight(sites):                     # (n, sum, parent's rate) per site
        sites = [s for s in sites if s[0] > 1]
        spread = sum(n * (s / n - r) ** 2 for n, s, r in sites)
        v, nv = sum(r * (1 - r) for _, _, r in sites), sum(n * r * (1 - r) for n, _, r in sites)
        low, high = Q.PRIOR_RANGE
        rho = (spread - v) / max(nv - v, 1e-12) if sites and nv else 0
        return high if rho <= 1 / (high + 1) else max(low, 1 / rho - 1)

    out = [[] for _ in rows]
    for j, prior in enumerate(priors):
        own = [sigmoid(r[2 + j] + prior) for r in rows]
        hosts, paths = defaultdict(list), defaultdict(list)
        for i, (host, path, *_) in enumerate(rows):
            hosts[host].append(i)
            paths[host, path].append(i)
        mean = min(max(sum(own) / len(own), 1e-6), 1 - 1e-6)
        wh = weight([(len(m), sum(own[i] for i in m), mean) for m in hosts.values()])
        rate = {h: (sum(own[i] for i in m) + wh * mean) / (len(m) + wh) for h, m in hosts.items()}
        wp = weight([(len(m), sum(own[i] for i in m), rate[h]) for (h, _), m in paths.items()])
        for i, (host, path, *evidence) in enumerate(rows):
            others = [own[k] for k in range(len(rows)) if k != i]
            g = sum(others) / len(others) if others else sigmoid(prior)
            g = min(max(g, 1e-6), 1 - 1e-6)
            mine = [own[k] for k in hosts[host] if k != i]
            r = (sum(mine) + wh * g) / (len(mine) + wh)
            mine = [own[k] for k in paths[host, path] if k != i]
            theta = (sum(mine) + wp * r) / (len(mine) + wp)
            out[i].append(sigmoid(evidence[j] + math.log(theta / (1 - theta))))
    return out


@pytest.mark.parametrize("n", [1, 2, 260])
def test_posteriors_and_odds_equal_brute_force(spark, n):
    texts, labels = corpus(5, 260)
    rng = random.Random(6)
    sites = [(rng.choice(["a", "a", "a", "b", "c", None]), rng.choice(["en", "de", None])) for _ in range(n - 1)]
    sites += [("alone", "x")]
    docs = spark.createDataFrame([(i, t, h, p) for i, (t, (h, p)) in enumerate(zip(texts, sites))],
                                 "doc_id long, text string, host string, path string")
    full = documents(spark, texts)
    seen = spark.createDataFrame(labels, LABELS)
    model = Q.train(full, seen)
    assert set(model["heads"]) == set(Q.HEADS)
    rows = sorted(Q.score(docs, model).collect(), key=lambda r: r.doc_id)
    want = brute_force([(r.host, r.path, *(r[f"_{h}"] for h in Q.HEADS)) for r in rows],
                       [model["heads"][h][2] for h in Q.HEADS])
    original = Q.train
    Q.train = lambda *_: model
    try:
        got = sorted(Q.classify(docs, seen, "host", "path").collect(), key=lambda r: r.doc_id)
    finally:
        Q.train = original
    for r, w in zip(got, want, strict=True):
        assert [r[f"_p_{h}"] for h in Q.HEADS] == pytest.approx(w, rel=1e-9, abs=1e-12)


def test_own_evidence_counts_once(spark):
    """In a path of its own, a document's site is what the others of its host say."""
    scored = spark.createDataFrame([(0.0, 0.0, "a", "a/x")] * 50 + [(9.0, 9.0, "a", "a/own")],
                                   "_toxic double, _junk double, h string, p string")
    model = {"heads": {"toxic": (None, 0.0, 0.0), "junk": (None, 0.0, 0.0)}}
    sites = Q.site_posteriors(scored, model, "h", "p").where("s_path = 'a/own'")
    own = Q._probability(model, "toxic", "9D")
    left, whole = sites.selectExpr(Q._posterior(model, "toxic", "", f"({own})", 1), "site_toxic").first()
    assert abs(left) < 1e-6 < whole
