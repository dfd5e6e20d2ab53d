"""Best-fit packing with swap-based local search (operator 6).

1. One map over the scan tokenises each whole text, cuts it into pieces of at
   most ``capacity`` tokens (the first may be shorter) and keeps only their
   lengths and checksums.
2. Only the histogram of piece lengths (at most ``capacity`` rows) reaches the
   driver. Best-fit decreasing packs it, treating equal bins as one pattern
   with a multiplicity; then local search moves a piece, or exchanges one for
   one or two for one between underfull patterns whenever that increases the
   sum of squared fills, until no pair of patterns has such a change, the lower
   bound is met, or ``SEARCH_PATTERNS`` patterns have been made. The work depends
   on the number of different patterns, not of documents.
3. Pieces are numbered within their length (in parallel, whatever the length's
   share) and look up their sequence and offset in the patterns' slot list,
   which is bounded by lengths, too.

Token ids are those of the byte-level vocabulary file; ``tiktoken`` reads the
same vocabulary as ranks and gives the same ids as ``tokenizers`` at a
fraction of the CPU time (a test compares the two). The literal of the special
token in a text is that token, as the library's default has it.

Defined cases: a null or empty text is one piece holding only the end id;
null and repeated ids and repeated rows are packed each; more columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import number_rows, plain_texts, read_table, staged, text_batches

CAPACITY = 1024
END_ID = 2
SPECIAL = {"<|endoftext|>": 50256}      # fixed value: the vocabulary's special token
SEARCH_PATTERNS = 4096      # patterns that the local search makes at most

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_ENCODINGS: dict = {}


def _encoding(path: str):
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[path] = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN,
                                             mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _ENCODINGS[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens, the short one first."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(a, capacity) for a in range(first, n, capacity)]


def _pieces(path: str | None, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        enc = _encoding(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        for batch in text_batches(batches):
            out = [[] for _ in range(5)]
            for doc, text in zip(batch.column("doc_id").to_pylist(),
                                 plain_texts(batch.column("text")).to_pylist()):
                ids = np.array(enc.encode(text, allowed_special="all") + [end_id], "<u4")
                for k, (at, n) in enumerate(cut(len(ids), capacity)):
                    for column, v in zip(out, (doc, k, at, n, zlib.crc32(ids[at:at + n].tobytes()))):
                        column.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


# A pattern is [number of bins, free space, Counter of lengths in each bin].

def best_fit(histogram: dict[int, int], capacity: int) -> list[list]:
    """Best-fit decreasing over a histogram of lengths."""
    bins: list[list] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for p in sorted((p for p in bins if p[1] >= length), key=lambda p: p[1]):
            if not left:
                break
            fit = p[1] // length                    # the fullest bin stays the best fit
            for each, m in ((fit, min(p[0], left // fit)), (left % fit, 1)):
                m = min(m, p[0], left // each if each else 0)
                if m:
                    p[0] -= m
                    left -= m * each
                    bins.append([m, p[1] - each * length, p[2] + Counter({length: each})])
        fit = capacity // length
        for each, m in ((fit, left // fit), (left % fit, 1)):
            if each and m:
                bins.append([m, capacity - each * length, Counter({length: each})])
        bins = [p for p in bins if p[0]]
    return bins


def _exchange(a: list, b: list, capacity: int):
    """Lengths to give from ``a`` to ``b`` and back that raise the squared fill
    most: a move, one for one or two for one; None if there is none."""
    fill_a, fill_b, room = capacity - a[1], capacity - b[1], b[1]
    give = [(x,) for x in a[2]]
    give += [(x, y) for x in a[2] for y in a[2] if x < y or x == y and a[2][x] > 1]
    best, found = 0, None
    for out in give:
        for back in [()] * (len(out) == 1) + [(y,) for y in b[2] if y not in out]:
            d = sum(out) - sum(back)
            if 0 < d <= room and d * (fill_b - fill_a + d) > best:
                best, found = d * (fill_b - fill_a + d), (out, back)
    return found


class _Open:
    """An underfull pattern, with bit masks that tell at once whether it can
    give to another: bit ``x`` of ``one`` and ``two`` stands for a sum ``x`` of
    one or two of its lengths, bit ``x`` of ``take_one`` and ``take_two`` for a
    sum it can take in, with nothing or one length (one length) given back."""

    def __init__(self, m: int, free: int, content: Counter):
        self.bin = [m, free, content]
        self.born = self.seen = 0
        kinds = list(content)
        self.one = self.two = back = 0
        for x in kinds:
            self.one |= 1 << x
            back |= 1 << x
            for y in kinds:
                if x < y or x == y and content[x] > 1:
                    self.two |= 1 << x + y
        self.take_one, self.take_two = self._spread(back | 1, free), self._spread(back, free)

    @staticmethod
    def _spread(bits: int, room: int) -> int:
        out, done = bits << 1, 1
        while done < room:
            step = min(done, room - done)
            out |= out << step
            done += step
        return out

    def fits(self, other: _Open) -> bool:
        return bool(self.one & other.take_one or self.two & other.take_two)


def fewest(histogram: dict[int, int], capacity: int) -> int:
    """A number of bins that no packing goes below (Martello and Toth's L2).

    Pieces above half a bin each need their own; for a least length ``a``, those
    above ``capacity - a`` share with no piece of ``a`` or more, and the pieces
    from ``a`` up to half a bin must fit the rest of the others or further bins."""
    n = np.zeros(capacity + 1, object)
    for length, count in histogram.items():
        n[length] = count
    upto, space = np.cumsum(n), np.cumsum(n * np.arange(capacity + 1))
    half, most = capacity // 2, 0
    for a in range(half + 1):
        below = max(a - 1, 0)
        own = upto[capacity] - upto[half]
        room = (upto[capacity - a] - upto[half]) * capacity - (space[capacity - a] - space[half])
        most = max(most, own + max(0, -(-(space[half] - space[below] - room) // capacity)))
    return int(most)


def local_search(bins: list[list], capacity: int) -> list[list]:
    """Empty underfull bins by moves and exchanges that raise the squared fill.

    Each giver remembers the newest pattern it was tried with, so a pair
    without a gain is not tried again. Every gain raises the squared fill, so
    the search ends; it also ends after ``SEARCH_PATTERNS`` new patterns, since
    counts in the millions allow more gains than are worth the driver's time.
    """
    held: Counter = Counter()
    for m, _, content in bins:
        for length, each in content.items():
            held[length] += m * each
    bound = fewest(held, capacity)
    count = sum(p[0] for p in bins)
    full = [p for p in bins if p[1] == 0]
    known: dict[frozenset, _Open] = {}
    newest: dict[int, _Open] = {}                   # by birth; a merged pattern is born again
    clock = 0

    def add(m: int, free: int, content: Counter) -> None:
        nonlocal clock
        if not free:
            full.append([m, free, content])
            return
        key = frozenset(content.items())
        p = known.get(key)
        if p is None:
            p = known[key] = _Open(0, free, content)
        elif p.bin[0]:
            del newest[p.born]
        clock += 1
        p.bin[0] += m
        p.born, p.seen = clock, 0
        newest[clock] = p

    for p in bins:
        if p[1]:
            add(*p)

    def gain():
        """The emptiest giver with its fullest taker and their best exchange."""
        for a in sorted(newest.values(), key=lambda p: -p.bin[1]):
            fresh = []
            for b in reversed(newest.values()):
                if b.born <= a.seen:
                    break
                if b.bin[1] <= a.bin[1] and (b is not a or a.bin[0] > 1) and a.fits(b):
                    fresh.append(b)
            for b in sorted(fresh, key=lambda p: p.bin[1]):
                change = _exchange(a.bin, b.bin, capacity)
                if change:
                    return a, b, change
            a.seen = clock
        return None

    last = clock + SEARCH_PATTERNS
    while count > bound and clock < last and (found := gain()):
        a, b, change = found
        out, back = Counter(change[0]), Counter(change[1])
        m = a.bin[0] // 2 if a is b else min(a.bin[0], b.bin[0])
        d = sum(change[0]) - sum(change[1])
        a.bin[0] -= m
        b.bin[0] -= m
        for p in {id(a): a, id(b): b}.values():
            if not p.bin[0]:
                del newest[p.born]
        given, taken = a.bin[2] - out + back, b.bin[2] - back + out
        if given:
            add(m, a.bin[1] + d, given)
        else:
            count -= m
        add(m, b.bin[1] - d, taken)
    return full + [p.bin for p in newest.values()]


def slots_by_length(bins: list[list]) -> list[tuple]:
    """``(length, [first piece number, first sequence, offset] ...)`` per length:
    the k-th piece of a length takes the last slot whose first number is <= k."""
    used: Counter = Counter()
    slots: dict[int, list] = {}
    sequence = 0
    for m, _, content in bins:
        at = 0
        for length in sorted(content, reverse=True):
            for _ in range(content[length]):
                slots.setdefault(length, []).append((used[length], sequence, at))
                used[length] += m
                at += length
        sequence += m
    return sorted(slots.items())


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None,
                   end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and place there.

    ``vocabulary`` is the rank file's path on the executors; by default each
    asks the public tokenizers package for it.
    """
    spark = docs.sparkSession
    pieces = (docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"`{text_col}` AS text")
              .mapInArrow(_pieces(vocabulary, capacity, end_id), PIECES)
              .withColumn("rid", F.monotonically_increasing_id()))
    pieces = staged(pieces, "packing-pieces")
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    bins = local_search(best_fit(histogram, capacity), capacity)
    slots = spark.createDataFrame(
        slots_by_length(bins), "length long, slots array<struct<first: long, seq: long, at: long>>")
    return (number_rows(pieces, ["length"], "rid", "_k")
            .join(F.broadcast(slots), "length")          # at most ``capacity`` rows
            .withColumn("s", F.expr("element_at(slots, size(filter(slots, s -> s.first <= _k)))"))
            .selectExpr("doc_id", "piece", "start", "length", "ids_crc32",
                        "s.seq + _k - s.first AS sequence_id", "s.at AS offset"))


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
