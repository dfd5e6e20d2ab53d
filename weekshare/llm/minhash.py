"""b-bit MinHash near-duplicates (operator 3).

1. One map over the scan: each whole text's distinct word shingles, their
   digest, ``PERMS`` minima, one key per band of ``ROWS`` minima, and the low
   ``BITS`` bits of all minima packed into one signature. Texts ride along
   compressed. Equal sets become one class, so groups of copies cost one row.
2. Band keys held by several classes are candidate buckets. Inside a bucket
   signatures are compared by bit counts; the share of equal codes, corrected
   for chance collisions, estimates the similarity. Pairs below a bound six
   standard deviations under the threshold cannot be links (1e-9); of the
   others only a spanning forest leaves the bucket.
3. The forests' components are clusters. Full sets are intersected exactly
   (sparse incidence products) and again only a spanning forest of true links
   leaves the task. A cluster of one block is compared as a whole. In a larger
   one every member first meets its smallest candidate partner, ``STAR`` others
   with it: texts shipped are as many as the members. Those links leave one
   main component and, where some members stayed apart, the rest; only the rest
   is compared with everything.
4. Components of the true links are the result.

A link at the threshold is missed with probability ``(1 - t^ROWS)^BANDS``:
6e-11 at 0.85, 5e-8 at 0.8. Nothing is capped: buckets above ``BLOCK`` members
and the rests of clusters are dealt as pairs of blocks, each pair a task of
bounded memory, so pairs are compared but never emitted.

Defined cases: null and empty texts and texts without words have no shingles
and no links; fewer words than a shingle are one shingle; equal sets are
linked whatever the ids; null ids count as largest and repeated rows are
linked like others (``stays`` is true for exactly one row of a component);
other columns are kept.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, LongType, StructField,
                               StructType)

from .common import read_table, staged, text_batches
from .components import components
from .tokens import distinct_per_text, mix, shingles, word_hashes

PERMS, ROWS, BITS = 128, 4, 4
BANDS = PERMS // ROWS
BLOCK = 1024                # members compared with each other at a time
BLOCK_SHINGLES = 400_000    # and their shingles
STAR = 64                   # members of a large cluster that meet at one candidate partner
SALTS = 16                  # parts of a group that is joined with its facts
SMALL = 32                  # buckets up to this size are compared row by row
BROADCAST_ROWS = 400_000    # cluster members (48 bytes each) that may be broadcast

_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(0, 1 << 32, PERMS, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, PERMS, dtype=np.uint32)


def minima(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``PERMS`` minima per text over its distinct shingle hashes; one
    permutation at a time, so each pass runs along the hashes."""
    out = np.full((PERMS, len(offsets) - 1), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(offsets))
    starts = offsets[some]
    x = (h >> np.uint64(32)).astype(np.uint32)
    y = np.empty_like(x)
    if len(some):
        for j in range(PERMS):
            np.multiply(x, _A[j], out=y)
            np.add(y, _B[j], out=y)
            out[j, some] = np.minimum.reduceat(y, starts)
    return np.ascontiguousarray(out.T)


def band_keys(low: np.ndarray) -> np.ndarray:
    wide = low.astype(np.uint64).reshape(len(low), BANDS, ROWS)
    key = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
    for j in range(ROWS):
        key = mix(key ^ wide[:, :, j])
    return key.astype(np.int64)


def signature(low: np.ndarray) -> np.ndarray:
    """Low four bits of every minimum, two to a byte."""
    code = (low & np.uint32(15)).astype(np.uint8)
    return code[:, 0::2] | (code[:, 1::2] << 4)


def equal_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal codes of packed signatures (as uint64 words)."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    x &= np.uint64(0x1111111111111111)
    return PERMS - np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def corrected(equal: np.ndarray | int) -> np.ndarray | float:
    """Similarity estimated from equal codes: chance collisions taken out."""
    chance = 1 / (1 << BITS)
    return (equal / PERMS - chance) / (1 - chance)


def estimate_bound(threshold: float) -> float:
    """Estimate under which a pair at the threshold falls with chance 1e-9."""
    p = threshold + (1 - threshold) / (1 << BITS)
    return float(corrected(math.floor(PERMS * p - 6 * math.sqrt(PERMS * p * (1 - p)))))


def sketch(docs: DataFrame, k: int, text_col: str) -> DataFrame:
    """``docs`` with the text compressed, and set size, digest, bands, signature."""
    at = docs.columns.index(text_col)
    fields = [StructField(f.name, BinaryType()) if i == at else f for i, f in enumerate(docs.schema.fields)]
    fields += [StructField("_n", LongType()), StructField("_digest", BinaryType()),
               StructField("_bands", ArrayType(LongType())), StructField("_sig", BinaryType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in text_batches(batches, text_col):
            n = batch.num_rows
            column = batch.column(at)
            h, offsets = distinct_per_text(*shingles(*word_hashes(column), k), n)
            low = minima(h, offsets)
            size = np.diff(offsets)
            raw = h.tobytes()
            digests = [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() if b > a else None
                       for a, b in zip(offsets, offsets[1:])]
            keys = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS),
                                            pa.array(band_keys(low).ravel()))
            columns = list(batch.columns)
            columns[at] = pa.array([None if t is None else pack.compress(t.encode())
                                    for t in column.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(size, pa.int64()), pa.array(digests, pa.binary()), keys,
                 pa.array([s.tobytes() for s in signature(low)], pa.binary())], names=names)

    return docs.mapInArrow(run, StructType(fields))


def _whole_groups(batches, key: list[str]) -> Iterator[pa.RecordBatch]:
    """Regroup a stream sorted by ``key`` into batches of whole groups."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        last = batch.num_rows - 1
        same = np.ones(batch.num_rows, bool)
        for name in key:
            column = batch.column(name).to_numpy(zero_copy_only=False)
            same &= column == column[last]
        cut = int(np.argmax(same))                  # sorted: the last group is a suffix
        if cut:
            yield batch.slice(0, cut)
        rest = batch.slice(cut)
    if rest is not None:
        yield rest


def _starts(batch: pa.RecordBatch, key: list[str]) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for name in key:
        column = batch.column(name).to_numpy(zero_copy_only=False)
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _forest(adjacent: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spanning edges (root, node) of a symmetric boolean matrix."""
    n = len(adjacent)
    todo = np.ones(n, bool)
    for root in range(n):
        if not todo[root]:
            continue
        todo[root] = False
        front = np.array([root])
        while len(front):
            found = np.flatnonzero(adjacent[front].any(axis=0) & todo)
            todo[found] = False
            yield from ((root, int(j)) for j in found)
            front = found


class _Union:
    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()),
                                       pa.array([e[1] for e in edges], pa.int64())], names=["a", "b"])


_PAIR = ["key", "i", "j"]


def _compare(bound: float):
    """Bucket members -> spanning edges of pairs whose estimate reaches ``bound``."""
    least = math.ceil(PERMS * (bound * (1 - 1 / (1 << BITS)) + 1 / (1 << BITS)) - 1e-9)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in _whole_groups(batches, _PAIR):
            starts = _starts(batch, _PAIR)
            sizes = np.diff(np.append(starts, batch.num_rows))
            group = np.repeat(np.arange(len(starts)), sizes)
            cid = batch.column("cid").to_numpy(zero_copy_only=False)
            block = batch.column("block").to_numpy(zero_copy_only=False)
            within = (batch.column("i").to_numpy(zero_copy_only=False)
                      == batch.column("j").to_numpy(zero_copy_only=False))
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u8").reshape(-1, PERMS * BITS // 64)
            union, edges = _Union(), []
            small = np.repeat(sizes <= SMALL, sizes)
            for d in range(1, min(SMALL, int(sizes.max()))):
                r = np.flatnonzero((group[d:] == group[:-d]) & small[d:])
                r = r[within[r] | (block[r] != block[r + d])]
                r = r[equal_codes(sig[r], sig[r + d]) >= least]
                for a, b in zip(cid[r].tolist(), cid[r + d].tolist()):
                    if union.join(a, b):
                        edges.append((a, b))
            for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
                x = sig[s:s + n]
                near = np.zeros((n, n), bool)
                for a in range(0, n, 128):
                    near[a:a + 128] = equal_codes(x[a:a + 128, None, :], x[None, :, :]) >= least
                if not within[s]:
                    near &= block[s:s + n, None] != block[None, s:s + n]
                for a, b in _forest(near):
                    a, b = int(cid[s + a]), int(cid[s + b])
                    if union.join(a, b):
                        edges.append((a, b))
            if edges:
                yield _edge_batch(edges)
    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted hash sets."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    h = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    order = np.argsort(h, kind="stable")
    h, owner = h[order], owner[order]
    new = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
    number = np.cumsum(new) - 1
    often = np.bincount(number, minlength=1)[number] > 1 if len(h) else np.zeros(0, bool)
    owner, number = owner[often], number[often]
    if not len(number):
        return np.zeros((m, m), np.int64)
    column = np.cumsum(np.append(True, number[1:] != number[:-1])) - 1
    width = max(1, (4 << 20) // m)
    total = np.zeros((m, m), np.float64)
    for a in range(0, int(column[-1]) + 1, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        x = np.zeros((m, min(width, int(column[-1]) + 1 - a)), np.float32)
        x[owner[lo:hi], column[lo:hi] - a] = 1
        total += x @ x.T
    return np.rint(total).astype(np.int64)


def _confirm(k: int, percent: int):
    """Cluster members -> spanning edges of exact links."""
    def run(batches: Iterator[pa.RecordBatch]):
        unpack = zstandard.ZstdDecompressor()
        for batch in _whole_groups(batches, _PAIR):
            starts = np.append(_starts(batch, _PAIR), batch.num_rows)
            edges = []
            for a, b in zip(starts, starts[1:]):
                part = batch.slice(a, b - a)
                texts = pa.array([unpack.decompress(t).decode() for t in part.column("body").to_pylist()],
                                 pa.large_string())
                h, cuts = distinct_per_text(*shingles(*word_hashes(texts), k), len(texts))
                size = np.diff(cuts)
                both = shared_counts([h[x:y] for x, y in zip(cuts, cuts[1:])])
                linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
                np.fill_diagonal(linked, False)
                if part.column("i")[0].as_py() != part.column("j")[0].as_py():
                    block = part.column("block").to_numpy(zero_copy_only=False)
                    linked &= block[:, None] != block[None, :]
                cid = part.column("cid").to_numpy(zero_copy_only=False)
                edges += [(int(cid[x]), int(cid[y])) for x, y in _forest(linked)]
            if edges:
                yield _edge_batch(edges)
    return run


def _block_pairs(rows: DataFrame, blocks: str) -> DataFrame:
    """Rows of ``key`` dealt to all pairs of its ``blocks`` (SQL) that hold them."""
    return (rows.withColumn("_nb", F.expr(f"cast({blocks} AS int)"))
            .withColumn("block", F.expr("cast(pmod(xxhash64(cid), _nb) AS int)"))
            .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
            .withColumn("i", F.least("block", "_o")).withColumn("j", F.greatest("block", "_o"))
            .drop("_nb", "_o"))


def _by_pair(rows: DataFrame) -> DataFrame:
    # By member too: the smallest of a bucket is the partner of many.
    return rows.repartition(*_PAIR).sortWithinPartitions(*_PAIR, "cid")


def _with_facts(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Rows of (``key``, cid, ...) with the one row of facts of their group;
    a group is joined in ``SALTS`` parts."""
    salted = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("_salt", F.expr(f"cast(pmod(xxhash64(cid), {SALTS}) AS int)"))
            .join(salted, [key, "_salt"]).drop("_salt"))


def _blocks(members: str, shingles: str, each: str = "BLOCK") -> str:
    """SQL for the number of blocks that so many members and shingles need."""
    return (f"cast(greatest(ceil({members} / {globals()[each]}), "
            f"ceil({shingles} / {BLOCK_SHINGLES}), 1) AS int)")


def _stars(large: DataFrame, near: DataFrame) -> DataFrame:
    """Members of large clusters in groups around their smallest candidate
    partner; a partner of many is in every one of its groups."""
    hub = (near.selectExpr("least(a, b) AS key", "greatest(a, b) AS cid")
           .groupBy("cid").agg(F.min("key").alias("key")))
    leaves = large.drop("key").join(hub, "cid")
    facts = (leaves.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
             .selectExpr("key", f"{_blocks('m', 's', 'STAR')} AS nb"))
    around = (_with_facts(leaves, facts, "key")
              .selectExpr("key", "cid", "rid", "cast(pmod(xxhash64(cid), nb) AS int) AS block"))
    centres = (facts.join(large.selectExpr("cid AS key", "cid", "rid"), "key")
               .selectExpr("key", "cid", "rid", "explode(sequence(0, nb - 1)) AS block"))
    return around.unionByName(centres).selectExpr("key", "block AS i", "block AS j", "block", "cid", "rid")


def _rests(large: DataFrame, labels: DataFrame) -> DataFrame:
    """Block pairs of what is left to compare in large clusters: members outside
    the cluster's main component with each other and with the main one."""
    state = (large.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("label", F.coalesce("label", "cid")))
    parts = state.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
    facts = (parts.groupBy("key").agg(F.max(F.struct("m", "s", "label")).alias("main"),
                                      F.sum("m").alias("m"), F.sum("s").alias("s"))
             .where("m > main.m")
             .selectExpr("key", "main.label AS main", f"{_blocks('(m - main.m)', '(s - main.s)')} AS nr",
                         f"{_blocks('main.m', 'main.s')} AS nm"))
    return (_with_facts(state, facts, "key")
            .withColumn("apart", F.expr("label != main"))
            .withColumn("block", F.expr("cast(if(apart, pmod(xxhash64(cid), nr), "
                                        "nr + pmod(xxhash64(cid), nm)) AS int)"))
            .withColumn("_o", F.expr("explode(sequence(0, if(apart, nr + nm, nr) - 1))"))
            .selectExpr("key", "least(block, _o) AS i", "greatest(block, _o) AS j", "block", "cid", "rid"))


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (text compressed in its column) with ``_n`` (set size),
    ``_component`` (smallest id reachable) and ``_stays``.

    Two documents are linked when ``100 * |A and B| >= percent * |A or B|``.
    """
    names = docs.columns
    return _near_duplicates(docs, shingle_words, percent, id_col, text_col).toDF(
        *names, "_n", "_component", "_stays")


def _near_duplicates(docs: DataFrame, shingle_words: int, percent: int, id_col: str,
                     text_col: str) -> DataFrame:
    """The same with the columns of ``docs`` named by place, so none can clash."""
    id_col, text_col = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    docs = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    rows = sketch(docs, shingle_words, text_col).withColumn("_rid", F.monotonically_increasing_id())
    rows = staged(rows, "minhash-rows")
    me = f"struct(`{id_col}` IS NULL AS none, cast(`{id_col}` AS long) AS id, _rid AS rid)"
    classes = (rows.where("_n > 0").groupBy("_digest")
               .agg(F.min(F.expr(me)).alias("least"), F.first(F.struct("_rid", "_n", "_bands", "_sig")).alias("one"))
               .selectExpr("_digest AS digest", "least", "one._rid AS rid", "one._n AS n",
                           "one._bands AS bands", "one._sig AS sig",
                           "monotonically_increasing_id() AS cid"))
    classes = staged(classes, "minhash-classes")

    keys = classes.select("cid", F.explode("bands").alias("key"))
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = keys.join(often, "key").join(classes.select("cid", "sig"), "cid")
    pairs = _block_pairs(members, f"ceil(m / {BLOCK})").select(*_PAIR, "block", "cid", "sig")
    near = _by_pair(pairs).mapInArrow(_compare(estimate_bound(percent / 100)), "a long, b long")
    near = staged(near, "minhash-near")
    clusters = components(near).withColumnRenamed("node", "cid").withColumnRenamed("label", "key")

    sized = staged(clusters.join(classes.select("cid", "rid", "n"), "cid"), "minhash-clusters")
    totals = (sized.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
              .selectExpr("key", f"{_blocks('m', 's')} AS nb"))
    sized = staged(_with_facts(sized, totals, "key"), "minhash-sized")
    large = sized.where("nb > 1").drop("nb")
    body = rows.select(F.col("_rid").alias("rid"), F.col(f"`{text_col}`").alias("body"))

    def confirmed(wanted: DataFrame) -> DataFrame:
        # Members are a small part of all rows: when they are few enough, their
        # texts are picked where they lie instead of shuffling every text.
        wanted = staged(wanted.select(*_PAIR, "block", "cid", "rid"), "minhash-wanted")
        n = wanted.count()
        if not n:
            return None
        texts = body.join(F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted, "rid").drop("rid")
        return staged(_by_pair(texts).mapInArrow(_confirm(shingle_words, percent), "a long, b long"),
                      "minhash-links")

    whole = sized.where("nb = 1").selectExpr("key", "0 AS i", "0 AS j", "0 AS block", "cid", "rid")
    edges = confirmed(whole.unionByName(_stars(large, near)))
    links = components(near.limit(0) if edges is None else edges)
    rest = None if edges is None else confirmed(_rests(large, links))
    if rest is not None:
        links = components(edges.unionByName(rest))

    mine = staged(classes.select("digest", "cid", "least").join(links, F.col("cid") == F.col("node"), "left")
                  .drop("node"), "minhash-mine")
    best = mine.where("label IS NOT NULL").groupBy("label").agg(F.min("least").alias("best"))
    answer = staged(_with_facts(mine.where("label IS NOT NULL"), best, "label").select("digest", "best")
                    .unionByName(mine.where("label IS NULL").selectExpr("digest", "least AS best")),
                    "minhash-answer")
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return (rows.join(answer, rows["_digest"] == answer["digest"], "left")
            .select(*kept, "_n",
                    F.expr(f"CASE WHEN _n > 0 THEN best.id ELSE cast(`{id_col}` AS long) END").alias("_component"),
                    F.expr("_n = 0 OR best.rid = _rid").alias("_stays")))


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80,
                         text_col: str = "text") -> DataFrame:
    """One document of each group, with the columns of ``docs``."""
    stay = _near_duplicates(docs, shingle_words, percent, "doc_id", text_col).where("_stays")
    stay = stay.drop("_n", "_component", "_stays").toDF(*docs.columns)
    at = docs.columns.index(text_col)

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([None if t is None else unpack.decompress(t).decode()
                                    for t in columns[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return stay.mapInArrow(run, docs.schema)


def op3_minhash_near_duplicates(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, shingle_words=3, percent=85).selectExpr(
        "doc_id", "_n AS n_shingles", "_component AS component_id", "doc_id <=> _component AS kept")


# The exact links, by a join on shingles.
OP3_SQL = r"""
WITH RECURSIVE
words AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
      WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN least_of USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
