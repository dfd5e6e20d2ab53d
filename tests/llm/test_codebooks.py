import hashlib
import math
import random

import numpy as np
import pytest

from weekshare.llm import codebooks as C

SCHEMA = "vec_id long, embedding array<double>, label int, v string, error double"


def table(spark, vectors, ids=None, labels=None):
    rows = [(i, v, k, "x", 1.0) for i, v, k in zip(
        ids if ids is not None else range(len(vectors)), vectors, labels or [None] * len(vectors))]
    return spark.createDataFrame(rows, SCHEMA)


def brute(vectors, ids, labels, entries=C.ENTRIES, rounds=C.ROUNDS):
    """Straight from the definition, one part at a time against every entry."""
    kept = [(i, [math.floor(1024 * c) for c in v], k) for i, v, k in zip(ids, vectors, labels)
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = len(kept[0][1]) // 4
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * width:(p + 1) * width] for r in first] for p in range(4)]

    def near(part, p):
        d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for _, v, _k in kept:
                part = v[p * width:(p + 1) * width]
                groups.setdefault(near(part, p)[0], []).append(part)
            for e, members in groups.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, by_label = [], {}
    for i, v, k in kept:
        found = [near(v[p * width:(p + 1) * width], p) for p in range(4)]
        error = sum(d for _, d in found)
        by_label[k] = by_label.get(k, 0) + error
        out.append((i, "".join(f"{e:02x}" for e, _ in found), error, k))
    return sorted(((i, c, e, by_label[k], sha) for i, c, e, k in out), key=str)


def vectors_of(seed, n, dim):
    rng = random.Random(seed)
    out = [[rng.gauss(0, 1) * rng.choice([0.01, 1]) for _ in range(dim)] for _ in range(n)]
    out[5] = list(out[4])                               # repeated rows and many ties
    out[6:9] = [[round(c * 2) / 2 for c in v] for v in out[6:9]]
    return out


@pytest.mark.parametrize("seed,n,dim", [(1, 300, 8), (3, 40, 4)])
def test_against_brute_force(spark, seed, n, dim):
    vectors = vectors_of(seed, n, dim)
    vectors += [None, [None] * dim, [math.nan] + [0.0] * (dim - 1), [0.0] * (dim - 1) + [math.inf], [0.0] * dim]
    ids = [i * 37 % 1009 for i in range(len(vectors))]
    ids[10], ids[11] = ids[12], None
    labels = [None if i % 5 == 0 else i % 3 for i in range(len(vectors))]
    rows = C.compress(table(spark, vectors, ids, labels)).collect()
    got = sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in rows), key=str)
    assert got == brute(vectors, ids, labels)


def test_orchard_finds_the_nearest_with_fewer_distances():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 3000, (16, 6))
    entries = (centres[rng.integers(0, 16, 256)] + rng.normal(0, 60, (256, 6))).astype(np.int64)
    entries[40] = entries[7]                            # equal entries: the lower one wins
    queries = (centres[rng.integers(0, 16, 3000)] + rng.normal(0, 60, (3000, 6))).astype(np.int64)
    queries[:256] = entries
    search = C.Orchard(entries)
    measured = np.zeros(len(queries), np.int64)
    code, error = search.nearest(queries, measured=measured)
    apart = ((queries[:, None] - entries[None]) ** 2).sum(2)
    assert (code == apart.argmin(1)).all() and (error == apart.min(1)).all()
    assert measured.mean() < 100                        # of 256
    for first in (0, 40, 255):                          # the start does not show
        assert (search.nearest(queries, np.full(len(queries), first))[0] == code).all()


def test_batches_and_tasks_do_not_show(spark, monkeypatch):
    df = table(spark, vectors_of(4, 400, 8))
    want = sorted(map(tuple, C.compress(df).collect()))
    monkeypatch.setattr(C, "BLOCK", 7)
    assert sorted(map(tuple, C.compress(df.repartition(7)).collect())) == want


def test_codes_give_the_vectors_back(spark):
    vectors = vectors_of(6, 200, 8)
    kept, books, length = C.fit(table(spark, vectors))
    rows = C.decode(C.encode(kept, books, length), books, length).collect()
    for r in rows:                                      # as many entries as vectors: within the floors
        assert max(abs(a - b) for a, b in zip(r.approx, vectors[r.vec_id])) <= 1 / 1024 + math.sqrt(r.error) / 1024


def test_edges(spark):
    assert C.compress(table(spark, [])).collect() == []
    assert C.compress(table(spark, [None, [math.nan]])).collect() == []
    one = C.compress(table(spark, [[0.5, 1.0, -0.001, 2.0]], [None])).collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in one] == [(None, "00000000", 0, 0)]
    empty = C.compress(table(spark, [[], []])).collect()
    assert [r.code for r in empty] == ["00000000"] * 2
    # Another length than the smallest id's is dropped; six positions are filled up to eight.
    odd = C.compress(table(spark, [[1.0] * 6, [2.0] * 6, [1.0] * 8])).collect()
    assert sorted(r.vec_id for r in odd) == [0, 1] and all(r.error == 0 for r in odd)
    # Components far beyond the clamp do not overflow.
    huge = C.compress(table(spark, [[1e300] * 4, [-1e300] * 4, [0.0] * 4])).collect()
    assert sorted(r.code for r in huge) == ["00000000", "01010101", "02020202"]
