"""Exact substring dedup by deep-shallow suffix sorting (operator 5).

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier
(smaller id, or earlier in the same document). Whole suffixes of all
documents cannot be sorted within any sensible disk budget, so sorting is
sparse:

1. Anchors. In every string of ``LENGTH`` bytes the smallest (rightmost on
   ties) hash of its ``GRAM``-byte pieces marks one position. Equal strings
   have the same anchor, so only anchors whose piece occurs twice matter;
   chunks learn that from key ranges (``chunks``).
2. Sorting. Strings that share such an anchor meet in one key range: the text
   from the anchor on, and the text before it reversed. Both are sorted
   deep-shallow: multikey quicksort on eight-byte characters to a shallow
   depth, then blind tries order the groups that still agree. Neighbours'
   common prefixes turn the order into classes for every depth; a string is
   the pair of its left and right class, and all but its earliest occurrence
   are marked. No hash decides equality here.
3. Marks return to the chunks, which cover, count and hash the bytes kept.

Within a chunk equal surroundings of an anchor are sent once (its earliest),
so a passage shared by a third of all rows costs a row per chunk, plus one
per distinct neighbourhood at its edges. A piece with over ``HOT`` occurrences
is not gathered in one range: its strings are dealt one by one, each by a
hash of its whole content, so that only equal strings meet.

Defined cases: null text is empty; texts shorter than ``LENGTH`` lose nothing;
null ids come last; repeated ids are documents of their own, ordered by their
place in the table; more columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import (answers_by_chunk, open_chunk, pack_keys, range_cuts,
                     ranges_for, unpack_keys, write_chunks)
from .common import read_table, staged
from .tokens import mix

LENGTH = 100                        # bytes of a string
GRAM = 37                           # bytes of an anchor's piece
WINDOW = LENGTH - GRAM + 1          # 64 pieces per string: one bit each
# A piece is hashed as five overlapping eight-byte words, each times an odd factor.
PLACES = (0, 8, 16, 24, GRAM - 8)
FACTORS = tuple(np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                       0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
STRETCH = 1 << 15                   # positions hashed at a time, to stay in cache
SHALLOW = 5                         # eight-byte characters before the tries
FEW = 12                            # groups up to this size are compared directly
RANGE_BYTES = 4 << 20               # text per key range
HOT = 100_000                       # occurrences from which a piece is dealt by whole strings

KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


# --- anchors -------------------------------------------------------------

def _words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, without copying."""
    return np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))


def gram_hashes(eight: np.ndarray, at) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position in ``at`` (a slice or an
    index array) on."""
    h = None
    for place, factor in zip(PLACES, FACTORS):
        part = eight[at.start + place:at.stop + place] if isinstance(at, slice) else eight[at + place]
        h = part * factor if h is None else h + part * factor
    return mix(h)


def string_hashes(eight: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hash of the ``LENGTH`` bytes from each start."""
    out = mix(gram_hashes(eight, start) ^ np.uint64(LENGTH))
    for at in (GRAM, LENGTH - GRAM):
        out = mix(out ^ gram_hashes(eight, start + at))
    return out


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of every ``w`` consecutive values, by doubling (``w`` = 2 ** i)."""
    step = 1
    while step < w:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return x


def anchors(data: np.ndarray, offsets: np.ndarray):
    """``(anchor, first, last, key)``: the strings starting at ``first..last``
    (all inside one document) have this anchor; ``key`` hashes its piece."""
    none = np.zeros(0, np.int64)
    size = np.diff(offsets)
    long = np.flatnonzero(size >= LENGTH)
    if not len(long):
        return none, none, none, np.zeros(0, np.uint64)
    eight = _words_at(data)
    end = offsets[long + 1] - LENGTH                # last start of each document
    opens = np.zeros(len(data), bool)
    opens[offsets[long]] = True
    firsts, found = [], []
    for a in range(0, len(data) - LENGTH + 1, STRETCH):
        b = min(a + STRETCH, len(data) - LENGTH + 1)
        h = gram_hashes(eight, slice(a, b + WINDOW - 1))
        place = np.uint64(0x7FFFFFFF) - np.arange(a, b + WINDOW - 1, dtype=np.uint64)
        best = sliding_least((h & ~np.uint64(0x7FFFFFFF)) | place, WINDOW)
        at = (np.uint64(0x7FFFFFFF) - (best & np.uint64(0x7FFFFFFF))).astype(np.int64)
        new = opens[a:b].copy()
        new[1:] |= at[1:] != at[:-1]
        new[0] |= not found or at[0] != found[-1][-1]
        new = np.flatnonzero(new)
        if len(new):
            firsts.append(new + a)
            found.append(at[new])
    first, at = np.concatenate(firsts), np.concatenate(found)
    doc = np.searchsorted(offsets[long], first, "right") - 1
    ok = (doc >= 0) & (first <= end[doc])           # not between documents
    last = np.minimum(np.append(first[1:], len(data)) - 1, end[doc])
    first, last, at = first[ok], last[ok], at[ok]
    # Anchors have small hashes; mixed once more, their keys spread evenly.
    return at, first, last, mix(~gram_hashes(eight, at))


# --- deep-shallow sorting ----------------------------------------------------

def _blind_trie(strings: list[bytes], members: list[int]) -> list[int]:
    """Order ``members`` (indices of equally long strings) by their strings.

    A node is ``[depth, {byte: child}]``, a leaf ``[members]``. A string goes
    down by branch bytes alone, is compared once with the leaf it reaches,
    and is hung in where it differs.
    """
    root = [[members[0]]]
    size = len(strings[members[0]])
    for m in members[1:]:
        s = strings[m]
        node = root
        while len(node) == 2:                       # blind: skip what is common
            child = node[1].get(s[node[0]])
            node = child if child is not None else next(iter(node[1].values()))
        other = strings[node[0][0]]
        if s == other:
            node[0].append(m)
            continue
        x = int.from_bytes(s, "big") ^ int.from_bytes(other, "big")
        depth = size - (x.bit_length() + 7) // 8
        above, node = None, root
        while len(node) == 2 and node[0] < depth:
            above, node = node, node[1][s[node[0]]]
        if len(node) == 2 and node[0] == depth:
            node[1][s[depth]] = [[m]]
            continue
        split = [depth, {other[depth]: node, s[depth]: [[m]]}]
        if above is None:
            root = split
        else:
            above[1][s[above[0]]] = split
    out: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if len(node) == 2:
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
        else:
            out += node[0]
    return out


def deep_shallow(matrix: np.ndarray) -> np.ndarray:
    """Order of the rows (equally long byte strings, zero padded to whole
    eight-byte characters)."""
    n, width = matrix.shape
    chars = matrix.view(">u8").astype(np.uint64)
    strings = None
    out = np.empty(n, np.int64)
    stack = [(np.arange(n), 0, 0)]
    while stack:
        rows, depth, at = stack.pop()
        if len(rows) == 1:
            out[at] = rows[0]
        elif depth == chars.shape[1]:
            out[at:at + len(rows)] = rows
        elif depth >= SHALLOW or len(rows) <= FEW:
            if strings is None:
                raw = matrix.tobytes()
                strings = [raw[i:i + width] for i in range(0, n * width, width)]
            members = rows.tolist()
            out[at:at + len(rows)] = (sorted(members, key=strings.__getitem__) if len(rows) <= FEW
                                      else _blind_trie(strings, members))
        else:                                       # three-way split by one character
            c = chars[rows, depth]
            pivot = np.sort(c[[0, len(c) // 2, len(c) - 1]])[1]
            low, high = c < pivot, c > pivot
            a, b, z = rows[low], rows[~(low | high)], rows[high]
            for part, deeper, place in ((a, 0, at), (b, 1, at + len(a)), (z, 0, at + len(a) + len(b))):
                if len(part):
                    stack.append((part, depth + deeper, place))
    return out


def common_prefixes(matrix: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it in ``order`` (0 first)."""
    out = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 1 << 16):
        b = min(len(order), a + (1 << 16))
        differs = matrix[order[a:b]] != matrix[order[a - 1:b - 1]]
        out[a:b] = np.where(differs.any(axis=1), differs.argmax(axis=1), matrix.shape[1])
    return out


def _gather(text: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of up to ``width`` bytes from each start on, in direction ``step``,
    zero padded to whole eight-byte characters."""
    width = -(-width // 8) * 8
    out = np.zeros((len(start), width), np.uint8)
    column = np.arange(width)
    for a in range(0, len(start), 1 << 13):
        part = slice(a, a + (1 << 13))
        use = column[None, :] < size[part, None]
        at = np.where(use, start[part, None] + step * column[None, :], 0)
        out[part] = np.where(use, text[at], 0)
    return out


def mark_repeats(left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Bit masks of the strings that occur earlier.

    Item ``x`` stands for the strings that take ``j`` bytes of row ``x`` of
    ``left`` (reversed text before its anchor) and ``LENGTH - j`` of ``right``,
    for ``j`` in ``low[x]..high[x]``. Items are in order of position; bit ``j``
    of an item's mask says that an earlier item has the same string.
    """
    masks = np.zeros(len(left), np.uint64)
    sides = []
    for matrix in (left, right):
        order = deep_shallow(matrix)
        sides.append((order, common_prefixes(matrix, order)))

    def classes(side: int, depth: int) -> np.ndarray:
        order, common = sides[side]
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(common < depth)
        return out

    for j in range(WINDOW):
        use = np.flatnonzero((low <= j) & (j <= high))
        if len(use) > 1:
            pair = classes(0, j)[use] * (len(left) + 1) + classes(1, LENGTH - j)[use]
            first = np.unique(pair, return_index=True)[1]
            again = np.ones(len(use), bool)
            again[first] = False                    # the earliest of each stays
            masks[use[again]] |= np.uint64(1) << np.uint64(j)
    return masks


# --- passes over the chunks ------------------------------------------------

def _keys(ranges: int):
    """Chunk -> its distinct anchor keys, and how often each occurs here."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                _, data, offsets = open_chunk(batch, i)
                keys, n = np.unique(anchors(data, offsets)[3], return_counts=True)
                cuts = range_cuts(keys, ranges)
                used = [int(b) for b in np.flatnonzero(np.diff(cuts))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(used, pa.int32()),
                    pa.array([batch.column("chunk")[i].as_py()] * len(used), pa.int64()),
                    pa.array([pack_keys(keys[cuts[b]:cuts[b + 1]]) for b in used], pa.binary()),
                    pa.array([n[cuts[b]:cuts[b + 1]].astype("<u4").tobytes() for b in used], pa.binary())],
                    names=["part", "chunk", "keys", "counts"])
    return run


def _repeated(hot: int):
    """Key range -> for each chunk, which of its keys occur more than once,
    and which more than ``hot`` times."""
    def run(table: pa.Table) -> pa.Table:
        keys = [unpack_keys(k) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(c, "<u4") for c in table.column("counts").to_pylist()])
        cuts = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        uniq, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, counts, len(uniq))[at]

        def bits(flags):
            return pa.array([np.packbits(flags[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())

        return pa.table({"chunk": table.column("chunk"), "part": table.column("part"),
                         "often": bits(total > 1), "hot": bits(total > hot)})
    return run


def _instances(batch: pa.RecordBatch, i: int, ranges: int):
    """The chunk's repeated anchors in order of position; those of hot pieces
    once for each of their strings.

    Returns the chunk, the anchors, and for each of them the number of its
    representative (the earliest with the same surroundings).
    """
    ids, data, offsets = open_chunk(batch, i)
    at, first, last, key = anchors(data, offsets)
    keys, place = np.unique(key, return_inverse=True)
    cuts = range_cuts(keys, ranges)
    often, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    for a in batch.column("bits")[i].as_py() or []:
        x, y = cuts[a["part"]], cuts[a["part"] + 1]
        often[x:y] = np.unpackbits(np.frombuffer(a["often"], np.uint8), count=y - x)
        hot[x:y] = np.unpackbits(np.frombuffer(a["hot"], np.uint8), count=y - x)
    if len(place):
        plain, many = np.flatnonzero((often & ~hot)[place]), np.flatnonzero(hot[place])
        width = last[many] - first[many] + 1
        start = np.repeat(first[many] - np.cumsum(width) + width, width) + np.arange(width.sum())
        at = np.concatenate([at[plain], np.repeat(at[many], width)])
        first, last = np.concatenate([first[plain], start]), np.concatenate([last[plain], start])
        key = key[plain]
        if len(start):
            key = np.concatenate([key, string_hashes(_words_at(data), start)])
    doc = np.searchsorted(offsets, first, "right") - 1
    number = np.array([np.iinfo(np.int64).max if x is None else x for x in ids.to_pylist()], np.int64)
    unknown = np.array([x is None for x in ids.to_pylist()], bool)
    use = np.lexsort((first, at, doc, number[doc], unknown[doc]))
    raw, seen, keep = data.tobytes(), {}, np.empty(len(use), np.int64)
    for k, x in enumerate(use.tolist()):
        keep[k] = seen.setdefault((raw[first[x]:last[x] + LENGTH], at[x] - first[x]), k)
    return (ids, data, offsets), (at[use], first[use], last[use], key[use]), keep, doc[use], unknown


def _send_strings(ranges: int):
    """Chunk -> surroundings of its repeated anchors, dealt by key range."""
    shift = np.uint64(64 - ranges.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                (ids, data, offsets), (at, first, last, key), keep, doc, unknown = _instances(batch, i, ranges)
                raw = data.tobytes()
                reps = np.flatnonzero(keep == np.arange(len(keep)))
                part = (key[reps] >> shift).astype(np.int64) if ranges > 1 else np.zeros(len(reps), np.int64)
                out = [[] for _ in range(9)]
                number = ids.to_pylist()
                for b in np.unique(part).tolist():
                    mine = reps[part == b]
                    a, f, z, d = at[mine], first[mine], last[mine], doc[mine]
                    row = (b, batch.column("chunk")[i].as_py(),
                           np.array([number[x] or 0 for x in d], "<i8").tobytes(),
                           np.packbits(unknown[d]).tobytes(), d.astype("<i8").tobytes(), a.astype("<i8").tobytes(),
                           (a - f).astype(np.uint8).tobytes(), (a - z).astype(np.int16).tobytes(),
                           b"".join(raw[x:y + LENGTH] for x, y in zip(f.tolist(), z.tolist())))
                    for column, v in zip(out, row):
                        column.append(v)
                kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=STRINGS)
    return run


STRINGS = ["part", "chunk", "ids", "unknown", "docs", "at", "high", "low", "text"]
STRINGS_SCHEMA = ("part int, chunk long, ids binary, unknown binary, docs binary, at binary, "
                  "high binary, low binary, text binary")


def _mark(table: pa.Table) -> pa.Table:
    """Key range -> masks for each chunk's strings."""
    def joined(name, kind):
        return np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])

    high, low = joined("high", np.uint8).astype(np.int64), joined("low", np.int16).astype(np.int64)
    sizes = [len(x) for x in table.column("high").to_pylist()]
    unknown = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in
                              zip(table.column("unknown").to_pylist(), sizes)])
    chunk = np.repeat(table.column("chunk").to_numpy(), sizes)
    by = np.lexsort((joined("at", "<i8"), joined("docs", "<i8"), chunk, joined("ids", "<i8"), unknown))
    text = joined("text", np.uint8)
    start = np.concatenate([[0], np.cumsum(high - low + LENGTH)])[:-1] + high
    start, high, low = start[by], high[by], low[by]
    left = _gather(text, start - 1, high, WINDOW - 1, -1)
    right = _gather(text, start, LENGTH - low, LENGTH, 1)
    masks = np.empty(len(by), np.uint64)
    masks[by] = mark_repeats(left, right, low, high)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    return pa.table({"chunk": table.column("chunk"), "part": table.column("part"),
                     "masks": pa.array([masks[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})


def _keep(ranges: int):
    """Chunk with its masks -> one row per document."""
    shift = np.uint64(64 - ranges.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                (ids, data, offsets), (at, first, last, key), keep, _, _ = _instances(batch, i, ranges)
                reps = np.flatnonzero(keep == np.arange(len(keep)))
                part = (key[reps] >> shift).astype(np.int64) if ranges > 1 else np.zeros(len(reps), np.int64)
                mask = np.full(len(keep), ~np.uint64(0))        # later equals: all repeat
                for a in batch.column("answers")[i].as_py() or []:
                    mask[reps[part == a["part"]]] = np.frombuffer(a["masks"], "<u8")
                repeats = np.zeros(len(data) + LENGTH, np.int32)      # by start
                for j in range(WINDOW):
                    hit = (mask >> np.uint64(j)) & np.uint64(1) > 0
                    hit &= (at - j >= first) & (at - j <= last)
                    repeats[at[hit] - j + LENGTH] = 1
                total = np.cumsum(repeats, dtype=np.int32)
                gone = total[LENGTH:] > total[:len(data)]   # one of the last LENGTH starts
                edge = gone.copy()
                edge[1:] &= ~gone[:-1]
                begin = offsets[:-1][np.diff(offsets) > 0]
                edge[begin] = gone[begin]
                removed = np.concatenate([[0], np.cumsum(gone)])
                spans = np.concatenate([[0], np.cumsum(edge)])
                shas = [hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest()
                        for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.diff(offsets)), pa.array(np.diff(removed[offsets])),
                    pa.array(np.diff(spans[offsets])), pa.array(shas, pa.string())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: what repeated strings of ``LENGTH`` bytes remove."""
    chunks = write_chunks(docs, id_col=id_col, text_col=text_col)
    ranges = ranges_for(chunks, RANGE_BYTES)
    sent = chunks.mapInArrow(_keys(ranges), "part int, chunk long, keys binary, counts binary")
    bits = staged(sent.groupBy("part").applyInArrow(
        _repeated(HOT), "chunk long, part int, often binary, hot binary"), "suffix-bits")
    known = (chunks.join(answers_by_chunk(bits).withColumnRenamed("answers", "bits"), "chunk", "left"))
    strings = known.mapInArrow(_send_strings(ranges), STRINGS_SCHEMA)
    masks = staged(strings.groupBy("part").applyInArrow(_mark, "chunk long, part int, masks binary"),
                   "suffix-masks")
    return (known.join(answers_by_chunk(masks), "chunk", "left").mapInArrow(_keep(ranges), KEPT))


def op5_deep_shallow_dedup(spark, sf_dir: str) -> DataFrame:
    return drop_repeats(read_table(spark, sf_dir, "documents"))


# Every start of a string, ordered by document and place; strings are told apart by MD5.
OP5_SQL = """
WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents),
stretches AS (SELECT doc_id, body, unnest(range(0, octet_length(body), 500)) AS s FROM docs),
pieces AS (SELECT doc_id, s, array_slice(body, s + 1, s + 599) AS piece FROM stretches),
starts AS (SELECT doc_id, s, piece, unnest(range(1, octet_length(piece) - 98)) AS p FROM pieces),
strings AS (SELECT doc_id, s + p AS p, md5(array_slice(piece, p, p + 99)) AS string FROM starts),
numbered AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY string ORDER BY doc_id, p) AS nth FROM strings),
repeats AS (
  SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS step FROM numbered WHERE nth > 1),
runs AS (
  SELECT doc_id, p, sum(CASE WHEN step <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM repeats),
spans AS (SELECT doc_id, min(p) AS p, max(p) + 99 AS z FROM runs GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY p), 0) + 1 AS p, p - 1 AS z FROM spans
  UNION ALL
  SELECT doc_id, coalesce(max(s.z), 0) + 1, max(octet_length(body))
  FROM docs LEFT JOIN spans s USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(CASE WHEN z >= p THEN hex(array_slice(body, p, z)) ELSE '' END, '' ORDER BY p) AS kept
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(z - p + 1) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, octet_length(body) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM docs JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""
