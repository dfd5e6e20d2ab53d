"""Corpus-wide facts about numpy keys, two plain shuffles per fact.

Word pairs and passages of a corpus are as many as its words; one Spark row
each would shuffle many times the input. So documents are first written as
chunk rows (some megabytes of compressed text each). A chunk sends its
distinct keys, sorted and packed, as one row per key range; a range sees each
key at most once per chunk, whatever the key's share of all rows, sums up,
and answers each chunk in the order of its keys. A lost executor only repeats
its chunks or ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain_texts, staged, text_batches

CHUNK_BYTES = 4 << 20           # text per chunk; a longer text is its own chunk
FAN = 4096                      # key ranges a chunk may send to in one step
CHUNKS = ("chunk long, kind int, n_bytes long, ids array<long>, sizes array<long>, body binary")


def write_chunks(docs: DataFrame, kind: Callable[[list], np.ndarray] | None = None,
                 limit: int = CHUNK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as chunk rows in the shared folder. ``kind`` maps ids to small
    numbers; documents of different kinds go to different chunks."""
    def run(batches: Iterator[pa.RecordBatch]):
        base = TaskContext.get().partitionId() << 33
        made = 0
        open_: dict[int, list] = {}

        def row(k: int) -> pa.RecordBatch:
            nonlocal made
            ids, texts = open_.pop(k)[1:]
            made += 1
            sizes = [len(t) for t in texts]
            body = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return pa.RecordBatch.from_arrays(
                [pa.array([base + made - 1], pa.int64()), pa.array([k], pa.int32()),
                 pa.array([sum(sizes)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([body], pa.binary())],
                names=["chunk", "kind", "n_bytes", "ids", "sizes", "body"])

        for batch in text_batches(batches, limit=limit):
            ids = batch.column("doc_id").to_pylist()
            kinds = kind(ids).tolist() if kind else [0] * len(ids)
            for i, k, t in zip(ids, kinds, plain_texts(batch.column("text")).to_pylist()):
                t = t.encode()
                held = open_.get(k)
                if held and held[0] + len(t) > limit:
                    yield row(k)
                held = open_.setdefault(k, [0, [], []])
                held[0] += len(t)
                held[1].append(i)
                held[2].append(t)
        for k in list(open_):
            yield row(k)

    rows = docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"`{text_col}` AS text")
    return staged(rows.mapInArrow(run, CHUNKS), "chunks", "uncompressed")


def open_chunk(batch: pa.RecordBatch, i: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Ids, bytes and offsets of the ``i``-th chunk row."""
    ids = batch.column("ids")[i].values
    sizes = batch.column("sizes")[i].values.to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    body = zstandard.ZstdDecompressor().decompress(
        batch.column("body")[i].as_py(), max_output_size=max(1, int(offsets[-1])))
    return ids, np.frombuffer(body, np.uint8), offsets


def ranges_for(chunks: DataFrame, bytes_each: int) -> int:
    """A power of two of key ranges, one for about ``bytes_each`` of text."""
    total = chunks.agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
    return 1 << max(0, (total // bytes_each).bit_length())


def range_cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins in sorted 64-bit keys, and the end."""
    if ranges == 1:
        return np.array([0, len(keys)])
    shift = np.uint64(64 - ranges.bit_length() + 1)
    return np.searchsorted(keys >> shift, np.arange(ranges + 1, dtype=np.uint64))


def first_ranges(ranges: int) -> int:
    """Ranges of the first of two steps: all of them up to ``FAN``; else at
    least ``FAN``, and not fewer than each of them is split into."""
    if ranges <= FAN:
        return ranges
    return max(FAN, 1 << (ranges.bit_length() // 2))


def range_runs(keys: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranges that sorted 64-bit keys fall into, and where each begins, and
    the end. The work follows the keys, not the number of ranges."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    if ranges == 1:
        return np.zeros(1, np.int64), np.array([0, len(keys)])
    of = (keys >> np.uint64(64 - ranges.bit_length() + 1)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    return of[starts], np.append(starts, len(keys))


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane: the planes that
    hold only zeros vanish in the shuffle's compression."""
    if not len(keys):
        return b""
    step = np.diff(keys, prepend=np.uint64(0))
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_keys(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def answers_by_chunk(answers: DataFrame) -> DataFrame:
    """Range answers (chunk, part, ...) as one row per chunk: as large as the
    chunk's own keys."""
    rest = [c for c in answers.columns if c != "chunk"]
    return answers.groupBy("chunk").agg(F.collect_list(F.struct(*rest)).alias("answers"))
