import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weekshare.llm import packing as K

from .cases import documents, mixed


def tokens(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [x.ids + [2] for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check(rows, texts, by_id=True):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= K.CAPACITY
    if by_id:
        pieces = defaultdict(list)
        for r in rows:
            pieces[r.doc_id].append(r)
        for i, ids in enumerate(tokens(texts)):
            got = sorted(pieces[i], key=lambda r: r.piece)
            assert [r.piece for r in got] == list(range(len(got)))
            at = 0
            for r in got:
                assert r.start == at
                part = np.array(ids[at:at + r.length], "<u4").tobytes()
                assert r.ids_crc32 == zlib.crc32(part)
                at += r.length
            assert at == len(ids)
            assert all(r.length == K.CAPACITY for r in got[1:])
    return len(sequences)


def test_pieces_and_places(spark):
    texts = [*mixed(), "<|endoftext|> a", "x <|endoftext|>a  <|endoftext|>", "<|endoftext|>" * 3, "<|endoftext", "  spaces   and\r\n\ttabs ", "a" * 3000]
    rows = K.pack_documents(documents(spark, texts)).collect()
    n = check(rows, texts)
    total = sum(r.length for r in rows)
    assert n <= -(-total // K.CAPACITY) + 1


@pytest.mark.parametrize("texts,ids,n", [([], [], 0), ([None, ""], [None, None], 2), (["a", "a"], [1, 1], 2)])
def test_edges(spark, texts, ids, n):
    rows = K.pack_documents(documents(spark, texts, ids)).collect()
    assert len(rows) == n
    check(rows, texts, by_id=False)


def test_cut():
    assert K.cut(5, 4) == [(0, 1), (1, 4)]
    assert K.cut(8, 4) == [(0, 4), (4, 4)]
    assert K.cut(4, 4) == [(0, 4)] and K.cut(1, 4) == [(0, 1)]


@pytest.mark.parametrize("seed", range(12))
def test_patterns_hold_every_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 100])
    histogram = {n: rng.randrange(1, 60) for n in rng.sample(range(1, capacity + 1), min(capacity, 9))}
    first = K.best_fit(dict(histogram), capacity)
    for bins in (first, K.local_search([[m, f, Counter(c)] for m, f, c in first], capacity)):
        held = Counter()
        for m, free, content in bins:
            assert m > 0 and free == capacity - sum(k * v for k, v in content.items()) >= 0
            for length, v in content.items():
                held[length] += m * v
        assert held == Counter(histogram)
    assert sum(b[0] for b in bins) <= sum(b[0] for b in first)


def test_special_tokens():
    import public_tokenizers as P
    enc = K._encoding(P.path("byte_bpe_50k.tiktoken"))
    assert enc.encode("<|endoftext|> a", allowed_special="all") == [50256, 257]


def optimum(pieces, capacity):
    """Fewest bins, by trying every bin for every piece."""
    best = len(pieces)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(pieces):
            best = len(bins)
            return
        for b in sorted(set(bins)):
            if b + pieces[i] <= capacity:
                rest = list(bins)
                rest.remove(b)
                place(i + 1, [*rest, b + pieces[i]])
        place(i + 1, [*bins, pieces[i]])

    pieces = sorted(pieces, reverse=True)
    place(0, [])
    return best


def test_small_cases_against_the_optimum():
    rng = random.Random(8)
    equal = 0
    for _ in range(150):
        capacity = rng.choice([10, 20, 30])
        pieces = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 10))]
        histogram = Counter(pieces)
        n = sum(b[0] for b in K.local_search(K.best_fit(dict(histogram), capacity), capacity))
        want = optimum(pieces, capacity)
        assert K.fewest(histogram, capacity) <= want <= n <= want + 1
        equal += n == want
    assert equal >= 147


@pytest.mark.parametrize("top", [100_000, 1_000_000])
def test_search_is_bounded_on_the_driver(top):
    rng = random.Random(1)
    histogram = {n: rng.randrange(1, top) for n in rng.sample(range(1, 1025), 725)}
    start = time.process_time()
    done = K.local_search(K.best_fit(dict(histogram), 1024), 1024)
    assert time.process_time() - start < 10
    held = Counter()
    for m, _, content in done:
        for length, v in content.items():
            held[length] += m * v
    assert held == Counter(histogram)


def test_local_search_empties_bins():
    # Best fit leaves 6+3, 5+4, 2 ... ; exchanges reach the bound.
    bins = [[1, 1, Counter({6: 1, 3: 1})], [1, 1, Counter({5: 1, 4: 1})], [1, 8, Counter({1: 2})]]
    done = K.local_search(bins, 10)
    assert sum(b[0] for b in done) == 2


@pytest.mark.parametrize("seed", range(3))
def test_search_ends_only_without_a_gain(seed):
    """Hundreds of emptiest patterns without a partner do not end the search."""
    rng = random.Random(seed)
    # Even lengths fill their bins up to an odd rest of one: nobody can take anything in.
    stuck = [[1, 901, Counter({99: 1})]] + [[1, 1, Counter({n: 1, 999 - n: 1})] for n in range(101, 480)]
    late = [[1, 1, Counter({6: 1, 993: 1})], [1, 1, Counter({5: 1, 994: 1})]]
    bins = [*stuck, *late]
    rng.shuffle(bins)
    done = K.local_search([[m, f, Counter(c)] for m, f, c in bins], 1000)
    held = Counter()
    for m, free, content in done:
        assert m > 0 and free == 1000 - sum(k * v for k, v in content.items()) >= 0
        for length, v in content.items():
            held[length] += m * v
    want = Counter()
    for m, _, content in bins:
        want.update(content)
    assert held == want
    total = sum(k * v for k, v in held.items())
    open_ = [p for p in done if p[1]]
    assert sum(p[0] for p in done) == -(-total // 1000) or not any(
        K._exchange(a, b, 1000) for a in open_ for b in open_
        if b[1] <= a[1] and (b is not a or a[0] > 1))
