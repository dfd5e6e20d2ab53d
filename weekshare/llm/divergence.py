"""How far the sources of a language differ in their words (operator 13).

Single-pass in-memory indexing gives the frequencies, and differences between
all pairs of sources come from a baseline with corrections.

1. Index. One map reads every whole text once and adds its terms to block
   postings in memory: occurrences and documents per (term, language, source).
   When the block is full, or the task ends, it leaves as a term-sorted run, cut
   into packed rows by hash shard and by a bound on terms. A task's memory is the
   block's, whatever its input; a document beyond the block is compacted to its
   distinct terms.
2. Merge. A shard's rows are ordered by their first term and merged by a heap: a
   row is opened only when the sweep has reached its first term. A term that every
   row holds is one entry per run. Terms in too few documents end here.
3. Groups. Every (language, source) and every language gets its smoothed,
   rounded probabilities; they are whole numbers, so sums are exact.
4. Terms. The largest excesses over the language are chosen in two levels, by
   buckets of a group and then by group.
5. Pairs. A term that two groups both lack adds ``|z - z'|``, the difference of
   their probabilities for an absent term. So every pair starts with that times
   the number of kept terms, and the frequencies of a shard, streamed in blocks of
   terms, correct it by ``|p - p'| - |z - z'|`` for each term that either holds.
   Shards and tiles of ``TILE`` sources bound the memory; one sum per pair and
   shard is all that is shuffled.

Defined cases: null texts, languages and sources are ''; a group without terms
has rows, too; without kept terms pairs are 0 apart and there are no term rows;
a language with one source has no pairs; ties are ordered by the UTF-8 item;
repeated rows and ids count each; very long texts are read in slices; more
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_of, number_rows, plain_texts, read_table, staged, text_batches
from .tokens import _LETTER, flat, hash_words, lowered, split

MIN_DOCS = 30               # documents of its language that hold a kept term
UNIT = 1_000_000_000        # probabilities are multiples of 1 / UNIT
SMOOTH = 5                  # added to every count
TOP = 50                    # terms listed per group
BLOCK_BYTES = 6 << 20       # text whose postings are held in memory
RUN_TERMS = 4096            # terms in a packed row of a run
SLICE = 4 << 20             # bytes of a long text read at a time
SHARD_BYTES = 64 << 20      # text per hash shard
TILE = 256                  # sources of a tile of pairs
PAIR_ENTRIES = 1 << 18      # frequencies per shard of the pairs' sums

# Per packed row: terms in order (``body`` cut by ``lengths``), the number of
# postings of each, and the postings: which of the row's groups, occurrences
# and documents there.
RUNS = ("shard int, first binary, body binary, lengths array<int>, postings array<int>, langs array<binary>, "
        "sources array<binary>, groups array<int>, n array<int>, docs array<int>")
# ``total`` is the term's count in the language; ``first`` marks one row per term.
FREQUENCIES = "lang string, term string, source string, n long, total long, first boolean"
SUMS = "lang string, a long, b long, apart long"


def _text_slices(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Parts of about ``limit`` bytes of one text; terms are never cut."""
    start = 0
    while len(data) - start > limit:
        ahead = data[start + limit:start + limit + (1 << 16)]
        gap = np.flatnonzero(~_LETTER[ahead])
        end = start + limit + (int(gap[0]) if len(gap) else len(ahead))
        while not len(gap) and end < len(data) and _LETTER[data[end]]:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


class Block:
    """Postings in memory: the terms of whole documents, each with its document
    and a count, until they are put in order as a run."""

    def __init__(self):
        self.docs: list[tuple[bytes, bytes]] = []       # each document's language and source
        self.parts: list[tuple] = []                    # term bytes, lengths, documents, counts
        self.held = 0

    def add(self, langs: list, sources: list, data: np.ndarray, offsets: np.ndarray) -> None:
        """Texts as bytes with offsets."""
        first = len(self.docs)
        self.docs.extend(zip(langs, sources))
        alone = len(langs) == 1
        for part in _text_slices(data, SLICE) if alone else [data]:
            start, length, text = split(part, np.array([0, len(part)]) if alone else offsets, "letters")
            self.parts.append((lowered(part)[_LETTER[part]], length, text + first, np.ones(len(text), np.int64)))
            self.held += len(part)
            if alone and self.held > 2 * BLOCK_BYTES:   # one document beyond the block
                self._compact()

    def _ordered(self):
        """Terms in order, and per distinct (term, document) its term number,
        document and count, in the order of term and group."""
        body = np.concatenate([p[0] for p in self.parts])
        length, doc, n = (np.concatenate([p[k] for p in self.parts]) for k in (1, 2, 3))
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [
            None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
        order = pc.array_sort_indices(words.dictionary)
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        by_group = sorted(range(len(self.docs)), key=self.docs.__getitem__)
        place = np.empty(len(by_group), np.int64)
        place[by_group] = np.arange(len(by_group))
        key = rank[words.indices.to_numpy()] << 32 | place[doc]
        if (n == 1).all():
            key.sort()
        else:
            at = np.argsort(key)
            key, n = key[at], n[at]
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        counts = np.add.reduceat(n, begin) if len(begin) else n
        key = key[begin]
        return words.dictionary.take(order), key >> 32, np.array(by_group, np.int64)[key & 0xFFFFFFFF], counts

    def _compact(self) -> None:
        terms, term, doc, n = self._ordered()
        lengths = pc.binary_length(terms).to_numpy().astype(np.int64)
        words = terms.take(pa.array(term))
        self.parts = [(_bytes_of(words), lengths[term], doc, n)]
        self.held = int(lengths[term].sum())

    def run(self, shards: int, limit: int) -> pa.RecordBatch | None:
        """One term-sorted run, as rows of one hash shard and ``limit`` terms at most."""
        if not self.parts or not sum(len(p[1]) for p in self.parts):
            return None
        terms, term, doc, counts = self._ordered()
        names = sorted(set(self.docs))
        code = {name: i for i, name in enumerate(names)}
        group = np.array([code[d] for d in self.docs], np.int64)[doc]
        begin = np.flatnonzero(np.diff(term << 32 | group, prepend=-1))
        term, group = term[begin], group[begin]
        n = np.add.reduceat(counts, begin)
        docs = np.diff(begin, append=len(counts))
        # Terms by shard, and in order within it; the postings follow them.
        lengths = pc.binary_length(terms).to_numpy().astype(np.int64)
        data = _bytes_of(terms)
        of = (hash_words(data, np.cumsum(lengths) - lengths, lengths) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        each = np.bincount(term, minlength=len(terms))
        first = np.cumsum(each) - each
        each = each[order]
        ends = np.cumsum(each)
        at = np.arange(ends[-1]) + np.repeat(first[order] - (ends - each), each)
        group, n, docs = group[at], n[at], docs[at]
        of = of[order]
        terms, lengths = terms.take(pa.array(order)), lengths[order]
        new = np.flatnonzero(np.diff(of, prepend=-1))
        within = np.arange(len(of)) - np.repeat(new, np.diff(new, append=len(of)))
        rows = np.append(np.flatnonzero(within % limit == 0), len(of))        # first term of each row
        postings = np.concatenate([[0], ends])[rows]
        # Each row names only the groups it holds.
        row = np.repeat(np.arange(len(rows) - 1), np.diff(postings))
        used, local = np.unique(row << 32 | group, return_inverse=True)
        begins = np.searchsorted(used, np.arange(len(rows)) << 32)
        local -= begins[row]
        bodies = np.concatenate([[0], np.cumsum(lengths)])[rows]
        named = [names[i] for i in (used & 0xFFFFFFFF).tolist()]

        def listed(values, offsets, kind):
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))

        body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows) - 1, [
            None, pa.py_buffer(bodies.astype(np.int64)), pa.py_buffer(_bytes_of(terms))])
        return pa.RecordBatch.from_arrays(
            [pa.array(of[rows[:-1]], pa.int32()), terms.take(pa.array(rows[:-1])).cast(pa.binary()),
             body.cast(pa.binary()), listed(lengths, rows, pa.int32()), listed(each, rows, pa.int32()),
             listed([k[0] for k in named], begins, pa.binary()), listed([k[1] for k in named], begins, pa.binary()),
             listed(local, postings, pa.int32()), listed(n, postings, pa.int32()),
             listed(docs, postings, pa.int32())],
            names=["shard", "first", "body", "lengths", "postings", "langs", "sources", "groups", "n", "docs"])


def _bytes_of(words: pa.LargeBinaryArray) -> np.ndarray:
    """The bytes of all words, one after the other."""
    offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    return np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]


def _index(shards: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in text_batches(batches):
            langs, sources = (plain_texts(batch.column(c)).cast(pa.large_binary()).to_pylist()
                              for c in ("lang", "source"))
            block.add(langs, sources, *flat(batch.column("text")))
            if block.held > BLOCK_BYTES:
                yield from filter(None, [block.run(shards, limit)])
                block = Block()
        yield from filter(None, [block.run(shards, limit)])
    return run


class Row:
    """A packed row of a run, read on from term to term."""

    def __init__(self, batch: pa.RecordBatch, i: int, number: dict):
        def column(name):
            return batch.column(name)[i].values

        body = batch.column("body")[i].as_py()
        ends = np.cumsum(column("lengths").to_numpy()).tolist()
        self.terms = [body[a:b] for a, b in zip([0, *ends], ends)]
        codes = np.array([number[k] for k in zip(column("langs").to_pylist(), column("sources").to_pylist())])
        self.groups = codes[column("groups").to_numpy()]
        self.n, self.docs = column("n").to_numpy(), column("docs").to_numpy()
        self.ends = [0, *np.cumsum(column("postings").to_numpy()).tolist()]
        # The documents of each term, in all groups together.
        self.total = np.add.reduceat(self.docs, self.ends[:-1]).tolist()

    def part(self, at: int) -> slice:
        return slice(self.ends[at], self.ends[at + 1])


def merged(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``(term, [(row, place), ...])`` in the order of the terms, from ``(first term,
    opener)`` ordered by their first term. The heap holds the next term of every
    open row; a row is opened when the sweep has reached its first term."""
    heap: list = []
    opened = 0
    coming = next(rows, None)
    while heap or coming:
        while coming and (not heap or coming[0] <= heap[0][0]):
            heapq.heappush(heap, (coming[0], opened, 0, coming[1]()))
            opened += 1
            coming = next(rows, None)
        term, found = heap[0][0], []
        while heap and heap[0][0] == term:
            _, order, at, row = heap[0]
            found.append((row, at))
            if at + 1 < len(row.terms):
                heapq.heapreplace(heap, (row.terms[at + 1], order, at + 1, row))
            else:
                heapq.heappop(heap)
        yield term, found


def _merge(min_docs: int):
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
    names = ["lang", "term", "source", "n", "total", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict = defaultdict(count().__next__)            # of the groups met by this task
        known: list = []
        out: list = []

        def openers():
            for batch in batches:
                for i, (shard, first) in enumerate(zip(batch.column("shard").to_pylist(),
                                                       batch.column("first").to_pylist())):
                    yield shard, (first, lambda batch=batch, i=i: Row(batch, i, number))

        def emit() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * len(kinds)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for _, rows in groupby(openers(), key=itemgetter(0)):
            for term, found in merged(r[1] for r in rows):
                if sum(row.total[at] for row, at in found) < min_docs:
                    continue
                parts = [(row, row.part(at)) for row, at in found]
                group = np.concatenate([row.groups[p] for row, p in parts])
                used, local = np.unique(group, return_inverse=True)
                n, docs = np.zeros(len(used), np.int64), np.zeros(len(used), np.int64)
                np.add.at(n, local, np.concatenate([row.n[p] for row, p in parts]))
                np.add.at(docs, local, np.concatenate([row.docs[p] for row, p in parts]))
                if len(known) < len(number):
                    known = list(number)
                by_lang: dict = defaultdict(list)
                for g, k, d in zip(used.tolist(), n.tolist(), docs.tolist()):
                    by_lang[known[g][0]].append((known[g][1], k, d))
                for lang, held in by_lang.items():
                    if sum(h[2] for h in held) >= min_docs:
                        total = sum(h[1] for h in held)
                        out.extend((lang.decode(), term.decode(), source.decode(), k, total, i == 0)
                                   for i, (source, k, _) in enumerate(held))
                if len(out) > 20_000:
                    yield emit()
        yield emit()
    return run


def term_frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, lang_col: str = "lang",
                     source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``FREQUENCIES`` of the terms in at least ``min_docs`` documents of their language."""
    rows = docs.selectExpr(f"`{lang_col}` AS lang", f"`{source_col}` AS source", f"`{text_col}` AS text")
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(buckets_of(docs.sparkSession), -(-size // SHARD_BYTES))
    return (rows.mapInArrow(_index(shards, RUN_TERMS), RUNS)
            .repartition("shard").sortWithinPartitions("shard", "first")
            .mapInArrow(_merge(min_docs), FREQUENCIES))


def _p(count: str, total: str, terms: str) -> str:
    """SQL: 1 + floor(UNIT * (count + SMOOTH) / (total + SMOOTH * terms)), exact; 0 without terms."""
    return (f"CASE WHEN {terms} = 0 THEN 0L ELSE 1 + cast({UNIT} AS decimal(20,0)) * ({count} + {SMOOTH}) "
            f"div ({total} + {SMOOTH} * {terms}) END")


def group_table(docs: DataFrame, freq: DataFrame, lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """Every occurring group: ``lang, source, gid`` (from 0 in the language), ``size`` (its
    occurrences of kept terms), ``lang_size``, ``terms`` (kept in the language), ``z`` (its
    probability of an absent term) and ``tiles`` of the language."""
    found = docs.selectExpr(f"coalesce(`{lang_col}`, '') AS lang", f"coalesce(`{source_col}`, '') AS source").distinct()
    sizes = freq.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count_if("first").alias("firsts"))
    rows = staged(found.join(sizes, ["lang", "source"], "left").na.fill(0, ["size", "firsts"]), "divergence-groups")
    langs = rows.groupBy("lang").agg(F.sum("size").alias("lang_size"), F.sum("firsts").alias("terms"),
                                     F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"))
    return staged(number_rows(rows, ["lang"], "source", "gid").join(langs, "lang")
                  .withColumn("z", F.expr(_p("0", "size", "terms")))
                  .select("lang", "source", "gid", "size", "lang_size", "terms", "z", "tiles"), "divergence-numbered")


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of absolute differences of every row of ``a`` and every row of ``b``."""
    return np.stack([np.abs(b - x).sum(1) for x in a]) if len(a) else np.zeros((0, len(b)), np.int64)


def _tile_sums(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Corrections of one shard for the pairs of two tiles of groups; shard 0
    adds the baseline. Rows without a term tell each group's ``z`` (as ``p``)."""
    lang, shard, ti, tj = (k.as_py() for k in key)
    table = table.combine_chunks()
    term = table.column("term").combine_chunks()
    gid, p = table.column("gid").to_numpy(), table.column("p").to_numpy()
    is_group = term.is_null().to_numpy(zero_copy_only=False)
    order = np.argsort(gid[is_group])
    groups, z = gid[is_group][order], p[is_group][order]
    place = np.searchsorted(groups, gid[~is_group])
    words = term.filter(pa.array(~is_group)).dictionary_encode()
    code, p = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), p[~is_group]
    order = np.argsort(code, kind="stable")
    code, place, p = code[order], place[order], p[order]
    left, right = np.flatnonzero(groups // TILE == ti), np.flatnonzero(groups // TILE == tj)
    base = np.abs(z[left][:, None] - z[right][None])
    sums = base * int(table.column("terms")[0].as_py()) if shard == 0 else np.zeros_like(base)
    n, width = len(words.dictionary), 512
    for at in range(0, n, width):                       # a block of terms
        a, b = np.searchsorted(code, [at, at + width])
        grid = np.repeat(z[:, None], min(width, n - at), axis=1)
        grid[place[a:b], code[a:b] - at] = p[a:b]
        sums += _apart(grid[left], grid[right]) - base * grid.shape[1]
    i, j = np.nonzero(np.ones_like(sums) if shard == 0 else sums)
    keep = groups[left][i] < groups[right][j]           # a tile with itself: each pair once
    i, j = i[keep], j[keep]
    return pa.table([pa.array([lang] * len(i), pa.string()), pa.array(groups[left][i], pa.int64()),
                     pa.array(groups[right][j], pa.int64()), pa.array(sums[i, j], pa.int64())],
                    names=["lang", "a", "b", "apart"])


def source_pairs(freq: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every ordered pair of a language's sources."""
    shards = max(1, -(-freq.count() // PAIR_ENTRIES))
    tiles = "explode(sequence(0L, tiles - 1)) AS other"
    cells = ["lang", "shard", "least(tile, other) AS ti", "greatest(tile, other) AS tj", "term", "gid", "p", "terms"]
    held = (freq.join(groups, ["lang", "source"])
            .selectExpr("lang", f"cast(pmod(xxhash64(term), {shards}) AS int) AS shard", f"gid div {TILE} AS tile",
                        tiles, "term", "gid", f"{_p('n', 'size', 'terms')} AS p", "terms"))
    absent = (groups.selectExpr("*", f"explode(sequence(0, {shards - 1})) AS shard")
              .selectExpr("lang", "shard", f"gid div {TILE} AS tile", tiles,
                          "cast(NULL AS string) AS term", "gid", "z AS p", "terms"))
    sums = (held.selectExpr(*cells).unionByName(absent.selectExpr(*cells))
            .groupBy("lang", "shard", "ti", "tj").applyInArrow(_tile_sums, SUMS)
            .groupBy("lang", "a", "b").agg(F.sum("apart").alias("value")))
    both = sums.selectExpr("lang", "value", "inline(array(struct(a AS gid, b AS other), struct(b AS gid, a AS other)))")
    names = groups.select("lang", "gid", "source")
    return (both.join(names, ["lang", "gid"])
            .join(names.selectExpr("lang", "gid AS other", "source AS item"), ["lang", "other"])
            .select("lang", "source", "item", "value"))


def marked_terms(freq: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, item, value`` of each group's ``top`` largest excesses over its language."""
    over = (freq.join(groups, ["lang", "source"])
            .selectExpr("lang", "source", "term AS item",
                        f"{_p('n', 'size', 'terms')} - {_p('total', 'lang_size', 'terms')} AS value")
            .where("value > 0").withColumn("bucket", F.expr("pmod(xxhash64(item), 64)")))
    for keys in (["lang", "source", "bucket"], ["lang", "source"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("value"), "item")
        over = over.withColumn("r", F.row_number().over(order)).where(F.col("r") <= top).drop("r")
    return over.select("lang", "source", "item", "value")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: parts ``pair`` and ``term``."""
    freq = staged(term_frequencies(docs, min_docs), "divergence-terms")
    groups = group_table(docs, freq)
    rows = (source_pairs(freq, groups).withColumn("part", F.lit("pair"))
            .unionByName(marked_terms(freq, groups, top).withColumn("part", F.lit("term"))))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", "part", "item", "value", F.row_number().over(order).alias("rank"))


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"))


_SQL_P = f"1 + ({UNIT}::HUGEINT * ({{}} + {SMOOTH})) // ({{}} + {SMOOTH} * v)"
OP13_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source,
  unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs) w GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n) AS total FROM words GROUP BY lang, term HAVING count(*) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(total) AS lang_size FROM kept GROUP BY lang),
counts AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS MATERIALIZED (SELECT d.lang, d.source, coalesce(c.size, 0) AS size FROM (SELECT DISTINCT lang, source FROM docs) d
  LEFT JOIN (SELECT lang, source, sum(n) AS size FROM counts GROUP BY ALL) c USING (lang, source)),
cells AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
  {_SQL_P.format("coalesce(c.n, 0)", "g.size")} AS p, {_SQL_P.format("k.total", "l.lang_size")} AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
    FROM cells x JOIN cells y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) d
    ON d.lang = a.lang AND d.source = a.source AND d.other = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM cells WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part
  ORDER BY value DESC, encode(item)))::INT AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
