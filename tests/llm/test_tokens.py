import random
import re

import numpy as np
import pyarrow as pa

from weekshare.llm import tokens as T


def test_words_and_hashes():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab Z\t\n\x0b\x1fé—1.") for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    texts += [None, "", "x" * 1000, "word " * 50, "y" * 255 + " " + "y" * 257]
    arr = pa.array(texts)
    by_word = {}
    h, of = T.word_hashes(arr)
    k = 0
    for i, t in enumerate(texts):
        low = "".join(c.lower() if c.isascii() else c for c in t or "")
        for w in re.findall("[^\x20\x09-\x0d]+", low):
            assert of[k] == i and by_word.setdefault(w, h[k]) == h[k]
            k += 1
    assert k == len(h) and len(set(map(int, by_word.values()))) == len(by_word)
    part, _ = T.word_hashes(arr.slice(5, 20))
    assert part.tolist() == h[(of >= 5) & (of < 25)].tolist()


def test_kinds():
    data, offsets = T.flat(pa.array(["a1-b é2"]))
    for kind, want in (("space", ["a1-b", "é2"]), ("letters", ["a", "b", "é"]), ("alnum", ["a1", "b", "é2"])):
        start, length, _ = T.split(data, offsets, kind)
        assert [data[a:a + n].tobytes().decode() for a, n in zip(start, length)] == want


def test_shingles():
    h, of = T.word_hashes(pa.array(["a b c d", "a b", None, "b c d", "a", "a b c"]))
    s, t = T.shingles(h, of, 3)
    sets = [set(s[t == i].tolist()) for i in range(6)]
    assert [len(x) for x in sets] == [2, 1, 0, 1, 1, 1]
    assert sets[3] < sets[0] and sets[5] < sets[0] and not sets[1] & sets[0] and not sets[1] & sets[4]
    for k in (2, 3, 5, 9):
        for texts in (["a"], ["a b"], ["a b c", "d"], ["a", None, "b c d e"]):
            s, t = T.shingles(*T.word_hashes(pa.array(texts)), k)
            want = [0 if not x else max(1, len(x.split()) - k + 1) for x in texts]
            assert np.bincount(t, minlength=len(texts)).tolist() == want
    d, cuts = T.distinct_per_text(np.array([3, 1, 3, 2], np.uint64), np.array([0, 0, 0, 2]), 4)
    assert d.tolist() == [1, 3, 2] and cuts.tolist() == [0, 2, 2, 3, 3]
