import random

import pytest

from weekshare.llm import decontamination as D

from .cases import documents, mixed, words

BENCH = "item_id long, text string, doc_id string, source int"


def bench(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], BENCH)


def literal_tiling(item, text, least):
    """Greedy string tiling by definition: longest unmarked match first."""
    im, tm, covered = [False] * len(item), [False] * len(text), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while (i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n]
                       and not im[i + n] and not tm[j + n]):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered
        im[i:i + n] = [True] * n
        tm[j:j + n] = [True] * n
        covered += n


@pytest.mark.parametrize("seed", range(8))
def test_tiling_against_definition(seed):
    rng = random.Random(seed)
    for _ in range(20):
        item = [rng.randrange(6) for _ in range(rng.randrange(3, 30))]
        text = [rng.randrange(6) for _ in range(rng.randrange(0, 40))] + item[5:20] + item[:5]
        tiles = D.tile(item, text, 3)
        used_i = [x for i, _, n in tiles for x in range(i, i + n)]
        used_j = [x for _, j, n in tiles for x in range(j, j + n)]
        assert len(set(used_i)) == len(used_i) and len(set(used_j)) == len(used_j)
        assert all(item[i:i + n] == text[j:j + n] and n >= 3 for i, j, n in tiles)
        assert abs(len(used_i) - literal_tiling(item, text, 3)) <= 3    # equal-length ties may differ


def planted(seed=1):
    rng = random.Random(seed)
    items = [(k, words(rng, rng.randrange(20, 60), 9000)) for k in range(12)]
    docs, want = mixed(seed, 20), []
    for k, t in items:
        w = t.split()
        half = len(w) // 2
        forms = {"plain": t, "upper": t.upper(), "punct": ", ".join(w), "reordered": " ".join(w[half:] + w[:half]),
                 "nearly": " ".join(w[:-2] + ["other", "words"]), "half": " ".join(w[:half])}
        for form, body in forms.items():
            docs.append(f"{words(rng, rng.randrange(0, 50))} {body}. {words(rng, rng.randrange(0, 50))}")
            if form != "half":
                want.append((len(docs) - 1, k))
    return docs, items, sorted(want)


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_planted_passages(spark, block, monkeypatch):
    monkeypatch.setattr(D.seed_blocks, "__defaults__", ("item_id", "text", block))
    docs, items, want = planted()
    got = D.leaked_pairs(documents(spark, docs), bench(spark, items)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == want
    assert all(r.coverage >= D.COVERAGE and r.matched_words <= r.item_words for r in got)
    kept = D.drop_leaking(documents(spark, docs), bench(spark, items)).collect()
    assert {r.doc_id for r in kept} == set(range(len(docs))) - {d for d, _ in want}


def test_cases(spark):
    items = [(1, None), (2, ""), (3, "one two three"), (None, "alpha beta gamma delta epsilon zeta"), (5, "...")]
    docs = documents(spark, [None, "", "x One, two three y", "one two", "alpha beta gamma delta epsilon zeta"],
                     [0, 1, 2, 3, None])
    got = sorted(((r.doc_id, r.item_id) for r in D.leaked_pairs(docs, bench(spark, items)).collect()), key=str)
    assert got == [(2, 3), (None, None)]
    assert D.leaked_pairs(docs, bench(spark, [])).count() == 0
    assert D.drop_leaking(docs, bench(spark, [])).count() == 5
    assert D.leaked_pairs(documents(spark, []), bench(spark, items)).count() == 0


def test_equal_items_are_one_entry(spark, monkeypatch):
    rng = random.Random(4)
    hot = words(rng, 30, 9000)
    items = [(k, hot) for k in range(60)] + [(k, words(rng, 30, 9000)) for k in range(60, 100)] + [(7, hot), (None, hot)]
    sizes = [len(t.items) for t in D.seed_blocks(bench(spark, items), D.SEED_WORDS, D.COVERAGE, block_bytes=1000)]
    assert sum(sizes) == 41 and max(sizes) <= 20
    got = D.leaked_pairs(documents(spark, ["a b " + hot, items[60][1], "none"]), bench(spark, items)).collect()
    want = [(0, k) for k in range(60)] + [(0, 7), (0, None), (1, 60)]
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted(want, key=str)
