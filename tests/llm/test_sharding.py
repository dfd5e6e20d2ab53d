import zlib
from collections import Counter, defaultdict

import pytest

from weekshare.llm import sharding as H

from .cases import documents, mixed


def check(rows, texts, shards=8):
    assert len(rows) == len(texts)
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(shards))
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    return sizes


def cut_edges(rows, text_of):
    groups = defaultdict(Counter)
    for r in rows:
        groups[text_of(r)][r.shard] += 1
    return sum(1 for g in groups.values() if len(g) > 1)


def test_mixed_documents(spark):
    texts = mixed()
    rows = H.shard_documents(documents(spark, texts)).collect()
    check(rows, texts)
    for r in rows:
        body = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(body) + 1, zlib.crc32(body))
        assert r.law == "rows" and r.grown_shard is None
    groups = defaultdict(set)
    for r in rows:
        groups[texts[r.doc_id] or ""].add(r.shard)
    assert all(len(s) == 1 for s in groups.values())


def test_small_groups_stay_whole(spark):
    texts = [f"text {i // 3}" for i in range(240)] + [f"single {i}" for i in range(80)]
    rows = H.shard_documents(documents(spark, texts)).collect()
    check(rows, texts)
    assert cut_edges(rows, lambda r: texts[r.doc_id]) == 0


def test_group_larger_than_a_shard(spark):
    texts = ["copy"] * 300 + [f"pair {i // 2}" for i in range(300)] + [f"single {i}" for i in range(300)]
    rows = H.shard_documents(documents(spark, texts)).collect()
    check(rows, texts)
    hot = Counter(r.shard for r in rows if texts[r.doc_id] == "copy")
    assert len(hot) <= 4                      # 300 of shards of 112 or 113
    assert cut_edges(rows, lambda r: texts[r.doc_id]) <= 9


def test_all_linked_and_full(spark):
    texts = [f"pair {i // 2}" for i in range(160)]
    rows = H.shard_documents(documents(spark, texts)).collect()
    check(rows, texts)
    assert cut_edges(rows, lambda r: texts[r.doc_id]) <= 30


@pytest.mark.parametrize("texts,ids", [([], []), ([None], [None]), (["a", "a", ""], [1, 1, None])])
def test_edges(spark, texts, ids):
    check(H.shard_documents(documents(spark, texts, ids)).collect(), texts)


def test_quotas_keep_sizes():
    room = [0, 0, 5]
    allow = H._quotas({(0, 1): 4, (1, 0): 2, (0, 2): 9}, room)
    assert allow == {(0, 1): 2, (1, 0): 2, (0, 2): 5} and room == [5, 0, 0]
    room = [0, 1]
    assert H._quotas({(0, 1): 3}, room) == {(0, 1): 1} and room == [1, 0]


def test_no_python_in_the_plan(spark):
    df = H.shard_documents(documents(spark, ["a", "a", "b"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
