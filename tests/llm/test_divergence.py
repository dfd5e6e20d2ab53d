import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from weekshare.llm import divergence as D
from weekshare.llm.tokens import split

SCHEMA = "doc_id long, text string, lang string, source string, item string, value double, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, s, "x", 1.0, 3) for i, (t, g, s) in enumerate(rows)], SCHEMA)


def brute(rows, min_docs=D.MIN_DOCS, top=D.TOP):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        here = sorted(s for g, s in groups if g == lang)
        whole = Counter()
        for s in here:
            whole.update(counts[lang, s])

        def p(held):
            size = sum(held[t] for t in kept)
            return {t: 1 + D.UNIT * (held[t] + 5) // (size + 5 * len(kept)) for t in kept}

        of, q = {s: p(counts[lang, s]) for s in here}, p(whole)
        for s in here:
            pairs = [(o, sum(abs(of[s][t] - of[o][t]) for t in kept)) for o in here if o != s]
            terms = [(t, of[s][t] - q[t]) for t in kept if counts[lang, s][t] and of[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda f: (-f[1], f[0].encode()))
                out += [(lang, s, part, item, v, r + 1) for r, (item, v) in enumerate(found[:limit])]
    return sorted(out)


def corpus(seed, n, sources=7, vocabulary=120):
    rng = random.Random(seed)
    words = [f"{rng.choice('abcdeé表')}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(vocabulary)]
    rows = []
    for _ in range(n):
        s = min(rng.randrange(sources), rng.randrange(sources))
        picks = [words[min(rng.randrange(vocabulary), rng.randrange(vocabulary))] for _ in range(rng.randrange(40))]
        text = rng.choice([" ", "-", "1", "\n\x00"]).join(w.upper() if rng.random() < .1 else w for w in picks)
        rows.append((text, rng.choice(["en", "en", "de", None]), f"src{s}" if s else None))
    rows += [(None, "en", "empty"), ("", "fr", "a"), ("only one", "fr", "b"), (None, None, None), ("", "xx", "single"),
             rows[0], rows[0], ("na\x00ïve", "e\x00n", "z\x00"), ("naïve", "e", "n")]
    return rows


def collected(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


@pytest.mark.parametrize("seed,min_docs", [(1, D.MIN_DOCS), (2, 1)])
def test_against_brute_force(spark, seed, min_docs):
    rows = corpus(seed, 400)
    assert collected(D.audit(table(spark, rows), min_docs)) == brute(rows, min_docs)


def test_blocks_runs_tiles_and_shards_do_not_show(spark, monkeypatch):
    rows = corpus(3, 300, sources=11)
    monkeypatch.setattr(D, "BLOCK_BYTES", 400)
    monkeypatch.setattr(D, "RUN_TERMS", 3)
    monkeypatch.setattr(D, "SLICE", 100)
    monkeypatch.setattr(D, "TILE", 4)
    monkeypatch.setattr(D, "PAIR_ENTRIES", 100)
    monkeypatch.setattr(D, "SHARD_BYTES", 100)
    long = [(" ".join(t or "" for t, g, _ in rows if g == "de") * 50, "de", "long")] * 3
    rows = rows + long
    assert collected(D.audit(table(spark, rows).repartition(5), 2)) == brute(rows, 2)


def test_terms_are_never_cut():
    rng = random.Random(4)
    text = ("".join(rng.choice("abé -1Z") for _ in range(5000)) + "x" * 200_000 + " y").encode()
    data = np.frombuffer(text, np.uint8)

    def terms(part):
        start, length, _ = split(part, np.array([0, len(part)]), "letters")
        return [part[a:a + n].tobytes() for a, n in zip(start, length)]

    for limit in (1, 10, 300):
        parts = list(D._text_slices(data, limit))
        assert [t for p in parts for t in terms(p)] == terms(data)


def test_merge_opens_rows_only_when_reached():
    class Part:
        def __init__(self, terms):
            self.terms = terms

    runs = [sorted({bytes([97 + i * k % 26]) for i in range(8)}) for k in (1, 3, 5, 7)]
    opened = []

    def opener(terms):
        def call():
            opened.append(terms[0])
            return Part(terms)
        return terms[0], call

    rows = sorted((run[a:a + 2] for run in runs for a in range(0, len(run), 2)), key=lambda t: t[0])
    got = []
    for term, found in D.merged(map(opener, rows)):
        assert all(first <= term for first in opened)
        assert all(row.terms[at] == term for row, at in found)
        got.append((term, len(found)))
    assert got == sorted(Counter(t for run in runs for t in run).items())


@pytest.mark.parametrize("rows,n", [([], 0), ([(None, None, None)], 0), ([("a", "en", "s"), ("a", "en", "t")], 2)])
def test_edges(spark, rows, n):
    got = collected(D.audit(table(spark, rows)))
    assert len(got) == n and all(r[4] == 0 for r in got) and got == brute(rows)
