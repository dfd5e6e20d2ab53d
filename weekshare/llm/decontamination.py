"""Benchmark decontamination by greedy string tiling (operator 7).

1. The distinct texts of the benchmark items are read in blocks of about
   ``BLOCK_BYTES`` (a stated query set; one block is what every task holds)
   and turned into a table of seeds: hashes of ``k`` consecutive words. Items
   of one text are one entry; a join by the text's SHA-256 gives their ids.
2. One map over the documents joins each text's seeds with that table. A pair
   of document and item goes on only if its shared seeds could cover the
   threshold: tiles consist of shared seeds, so none is lost here.
3. Greedy string tiling runs on the item and the document's parts that lie in
   shared seeds: running Karp-Rabin hashes of a search length find all common
   runs, the longest are extended and marked first, never overlapping marked
   words; the search length then shrinks down to ``k``. Reordered passages
   are covered by several tiles.
4. An item is leaked by a document when its tiles cover at least ``threshold``
   of the item's words.

Words are runs of letters, digits and multi-byte characters; A-Z count as
lower case. Texts are not shuffled; memory is bounded by a batch and a block.

Defined cases: null and empty texts and items without words match nothing; an
item of fewer than ``k`` words must occur as a whole; null and repeated ids
and repeated rows are judged each; more columns are kept by the filter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, text_batches
from .tokens import mix, word_hashes

SEED_WORDS = 5
COVERAGE = 0.8
BLOCK_BYTES = 8 << 20
_PRIME = (1 << 61) - 1
_BASE = 0x1F2E3D4C5B6A79

MATCHES = ("doc_id long, item_key string, item_words long, matched_words long, coverage double, "
           "tiles long")
PAIRS = ("doc_id long, item_id long, item_words long, matched_words long, coverage double, "
         "tiles long")


def _grams(words: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` words inside one text, and where it starts."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g = words[:n].copy()
    for j in range(1, k):
        g = mix(g + np.uint64(j)) + words[j:j + n]
    at = np.flatnonzero(text[k - 1:] == text[:n])
    return mix(g[at]), at


def _runs(marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    start = None
    for i, m in enumerate([*marked, True]):
        if m:
            if start is not None and i - start >= size:
                yield start, i
            start = None
        elif start is None:
            start = i


def _rolling(words: list[int], a: int, b: int, size: int) -> Iterator[tuple[int, int]]:
    """Karp-Rabin hash of every window of ``size`` words in ``words[a:b]``."""
    top = pow(_BASE, size - 1, _PRIME)
    h = 0
    for i in range(a, b):
        if i >= a + size:
            h = (h - words[i - size] * top) % _PRIME
        h = (h * _BASE + words[i]) % _PRIME
        if i >= a + size - 1:
            yield h, i - size + 1


def tile(item: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(item start, text start, length)`` of the tiles."""
    item_marked, text_marked = [False] * len(item), [False] * len(text)
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), 32))
    while True:
        seen = defaultdict(list)
        for a, b in _runs(text_marked, size):
            for h, i in _rolling(text, a, b, size):
                seen[h].append(i)
        found = []
        for a, b in _runs(item_marked, size):
            for h, i in _rolling(item, a, b, size):
                for j in seen.get(h, ()):
                    if i and j and not item_marked[i - 1] and not text_marked[j - 1] \
                            and item[i - 1] == text[j - 1]:
                        continue                    # not the run's beginning
                    n = 0
                    while (i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n]
                           and not item_marked[i + n] and not text_marked[j + n]):
                        n += 1
                    if n >= size:
                        found.append((n, i, j))
        longest = max(found, default=(0,))[0]
        if longest > 2 * size:                      # search again from the longest
            size = longest
            continue
        found.sort(key=lambda f: (-f[0], f[1], f[2]))
        for n, i, j in found:
            if any(item_marked[i:i + n]) or any(text_marked[j:j + n]):
                continue
            item_marked[i:i + n] = [True] * n
            text_marked[j:j + n] = [True] * n
            tiles.append((i, j, n))
        if size > least:
            size = max(least, size // 2)
        elif not found:
            return tiles


class SeedTable:
    """Seeds of one block of distinct benchmark texts; ``ids`` are their keys."""

    def __init__(self, ids: list, texts: list, k: int, threshold: float):
        words, of = word_hashes(pa.array(texts, pa.string()), "alnum")
        cuts = np.searchsorted(of, np.arange(len(texts) + 1))
        self.ids, self.k, self.threshold = ids, k, threshold
        self.items = [words[a:b] for a, b in zip(cuts, cuts[1:])]
        self.tables = {}
        by_length = defaultdict(list)
        for i, item in enumerate(self.items):
            if len(item):
                by_length[min(k, len(item))].append(i)
        for size, items in by_length.items():
            h, owner, at = [], [], []
            for i in items:
                g, _ = _grams(self.items[i], np.zeros(len(self.items[i]), np.int64), size)
                h.append(g)
                owner.append(np.full(len(g), i))
                at.append(np.arange(len(g)))
            h, owner, at = map(np.concatenate, (h, owner, at))
            order = np.argsort(h, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[(h & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.tables[size] = h[order], owner[order], at[order], seen

    def matches(self, column: pa.Array) -> Iterator[tuple[int, int, int, float, int]]:
        """``(row, item number, matched words, coverage, tiles)`` at or above the threshold."""
        words, text = word_hashes(column, "alnum")
        for size, (h, owner, at, seen) in self.tables.items():
            grams, where = _grams(words, text, size)
            maybe = np.flatnonzero(seen[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
            grams, where = grams[maybe], where[maybe]
            left, right = np.searchsorted(h, grams), np.searchsorted(h, grams, "right")
            hit = np.flatnonzero(right > left)
            left, right, where = left[hit], right[hit], where[hit]
            if not len(hit):
                continue
            many = right - left
            seed = np.repeat(np.arange(len(hit)), many)
            entry = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(left, many)
            row, item = text[where[seed]], owner[entry]
            order = np.lexsort((where[seed], item, row))
            seed, entry, row, item = seed[order], entry[order], row[order], item[order]
            cut = np.flatnonzero((row[1:] != row[:-1]) | (item[1:] != item[:-1])) + 1
            for a, b in zip(np.append(0, cut), np.append(cut, len(row))):
                i = int(item[a])
                total = len(self.items[i])
                need = self.threshold * total
                places = np.unique(at[entry[a:b]])
                if len(places) * size < need:
                    continue
                covered = np.zeros(total, bool)
                for j in range(size):
                    covered[places + j] = True
                if covered.sum() < need - 1e-9:
                    continue
                tiles = tile(self.items[i].tolist(),
                             self._parts(words, np.unique(where[seed[a:b]]), size), size)
                matched = sum(t[2] for t in tiles)
                if matched >= need - 1e-9:
                    yield int(row[a]), i, matched, matched / total, len(tiles)

    @staticmethod
    def _parts(words: np.ndarray, where: np.ndarray, size: int) -> list[int]:
        """The words inside shared seeds; a break between separate parts."""
        out: list[int] = []
        end = None
        for i in where:
            if end is not None and i >= end:
                if i > end:
                    out.append(-len(out) - 1)       # equals no word
                end = i
            start = i if end is None else end
            out += words[start:i + size].tolist()
            end = i + size
        return out


def benchmark_items(bench: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Item ids and texts that are not null, with the text's key."""
    return (bench.selectExpr(f"cast(`{id_col}` AS long) AS item_id", f"`{text_col}` AS t")
            .where("t IS NOT NULL").withColumn("item_key", F.sha2("t", 256)))


def seed_blocks(bench: DataFrame, k: int, threshold: float, id_col: str = "item_id",
                text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[SeedTable]:
    """The benchmark's distinct texts as seed tables of about ``block_bytes`` each."""
    texts = benchmark_items(bench, id_col, text_col).select("item_key", "t").distinct()
    total = texts.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    blocks = -(-total // block_bytes)
    for b in range(blocks):
        part = texts if blocks == 1 else texts.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b)
        rows = part.collect()                       # about block_bytes
        yield SeedTable([r["item_key"] for r in rows], [r["t"] for r in rows], k, threshold)


def leaked_pairs(docs: DataFrame, bench: DataFrame, k: int = SEED_WORDS, threshold: float = COVERAGE,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item it covers."""
    spark = docs.sparkSession
    rows = docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"`{text_col}` AS text")
    out = None
    for table in seed_blocks(bench, k, threshold):
        def run(batches, table=table):
            for batch in text_batches(batches):
                found = list(table.matches(batch.column("text")))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64())),
                    pa.array([table.ids[f[1]] for f in found], pa.string()),
                    pa.array([len(table.items[f[1]]) for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[3] for f in found], pa.float64()),
                    pa.array([f[4] for f in found], pa.int64())],
                    names=["doc_id", "item_key", "item_words", "matched_words", "coverage", "tiles"])

        pairs = rows.mapInArrow(run, MATCHES)
        out = pairs if out is None else out.unionByName(pairs)
    if out is None:
        return spark.createDataFrame([], PAIRS)
    return (out.join(benchmark_items(bench).select("item_key", "item_id"), "item_key")
            .select("doc_id", "item_id", "item_words", "matched_words", "coverage", "tiles"))


def drop_leaking(docs: DataFrame, bench: DataFrame, k: int = SEED_WORDS, threshold: float = COVERAGE,
                 text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that cover a benchmark item."""
    for table in seed_blocks(bench, k, threshold):
        def run(batches, table=table):
            for batch in text_batches(batches, text_col):
                keep = np.ones(batch.num_rows, bool)
                for row, *_ in table.matches(batch.column(batch.schema.get_field_index(text_col))):
                    keep[row] = False
                yield batch if keep.all() else batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op7_greedy_tiling(spark, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item, with the item."""
    return leaked_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
