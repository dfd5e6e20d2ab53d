import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weekshare.llm import tokencount as C

from .cases import documents, mixed


def tokens(texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


AWKWARD = ["<|endoftext|>", "<|endoftext|> a", "x <|endoftext|>a  <|endoftext|>", "<|endoftext|><|endoftext|>",
           "<|endoftext", "it's we'll I'd 'S  'tis", "  two  blanks\n\n\ttabs \r\n end ", "a b　c d",
           "\U0001F600\U0001F600 smile\U0001F600", "क़৴ Ⅷ x² ①", "꟎\U00010940a1",
           "12345 678,9.0 -- !!!", " ", "\n", "\n a", "a \n", "᠎​﻿ x́"]


def test_against_the_library(spark):
    texts = [*mixed(4, 30), *AWKWARD, "ab" * 40_000]
    rows = {r.doc_id: r for r in C.count_tokens(documents(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, n in enumerate(tokens(texts)):
        assert rows[i].n_tokens == n, (i, texts[i])
        assert rows[i].n_bytes == len((texts[i] or "").encode())


def test_chunks_and_slices_do_not_show(spark, monkeypatch):
    texts = mixed(5, 40) + AWKWARD
    whole = {r.doc_id: r.n_tokens for r in C.count_tokens(documents(spark, texts)).collect()}
    monkeypatch.setattr(C, "CHUNK_BYTES", 300)
    monkeypatch.setattr(C, "CHUNK_PIECES", 20)
    monkeypatch.setattr(C, "SHARD_BYTES", 50)
    one = documents(spark, texts).coalesce(1)
    assert {r.doc_id: r.n_tokens for r in C.count_tokens(one).collect()} == whole
    rng = random.Random(7)
    cutter = C._cutter(None)
    for t in [*texts, "".join(rng.choice("ab \n '.") for _ in range(3000))]:
        t = t or ""
        for limit in (1, 3, 50):
            parts = list(C.slices(t, limit))
            assert "".join(parts) == t
            assert [p for s in parts for p in cutter._find(s)] == cutter._find(t)


def test_frequencies_come_back():
    rng = np.random.default_rng(3)
    sizes = np.array([0, 3, 0, 5, 1, 0], np.int64)
    numbers = np.concatenate([rng.permutation(90_000)[:n] for n in sizes]).astype(np.int64)
    counts = rng.integers(1, 70_000, len(numbers))
    got = list(zip(*(x.tolist() for x in C.unpack_freqs(C.pack_freqs(numbers, counts, sizes), sizes))))
    at = 0
    for n in sizes:
        want = sorted(zip(numbers[at:at + n].tolist(), counts[at:at + n].tolist()))
        assert got[at:at + n] == want
        at += n


@pytest.mark.parametrize("texts,ids,want", [
    ([], [], []), ([None, "", None], [None, 1, 1], [0, 0, 0]), (["a b", "a b"], [2, 2], [2, 2])])
def test_edges(spark, texts, ids, want):
    rows = C.count_tokens(documents(spark, texts, ids)).collect()
    assert [r.n_tokens for r in rows] == want
    assert sorted((r.doc_id is None, r.doc_id) for r in rows) == sorted((i is None, i) for i in ids)


def test_each_pre_token_is_counted_once():
    import pyarrow as pa
    asked = [["a", " b", "c"], [" b", "d"], ["c", "a", " b"]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0, 1, 2]), pa.array([5, 5, 5], pa.int32()), pa.array([b"0", b"1", b"2"]),
         pa.array([len(x) for x in asked], pa.int32()),
         pa.array([C.pack_pieces([p.encode() for p in x]) for x in asked])],
        names=["chunk", "shard", "packed", "n", "pieces"])
    counted = []
    cutter = C._cutter(None)
    original = cutter.pieces
    cutter.pieces = lambda new: counted.extend(new) or original(new)
    try:
        (out,) = C._answers(None)([batch])
    finally:
        del cutter.pieces
    assert counted == ["a", " b", "c", "d"]
    assert [C.unpack_numbers(c, n, 1)[0].tolist() for c, n in
            zip(out.column("counts").to_pylist(), out.column("n").to_pylist())] == [[1, 1, 1], [1, 1], [1, 1, 1]]
