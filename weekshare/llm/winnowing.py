"""Winnowing fingerprints (operator 8), SQL functions only.

Every position's k-gram of code points is hashed; in each window of ``w``
consecutive k-grams the smallest hash is kept, the rightmost one on ties,
with its position. Two texts that share any passage of ``w + k - 1`` code
points therefore share a kept hash, and nothing shorter than ``k`` can match.

Texts are cut, in linear time, into overlapping stretches of ``STEP`` windows, one
row each. A stretch's hashes and minima are plain columns, so they are compiled
code without a loop, a string or an array per position: the rolling hash is a
polynomial modulo ``2^31 - 1`` over a number per code point (its CRC-32), built by
doubling (the hash of two, four and eight code points from those of its halves,
each shared by all grams that need it). Hash and position travel in one long (31 bits of hash above 31 bits of
reversed position), so the smallest value is the smallest hash, rightmost. Rows
of a text come together again in the partition they were made in.

An edited text (the last third replaced by the next document's beginning) shares
the windows of its first part with the text, and those of its second part with
the next document. Both are a prefix of windows, read off the kept entries; only
the seam of ``2 * (w + k - 2)`` code points is hashed anew. The next document is
the one with the next smaller id; rows are dealt to ranges of ids by quantiles
(one range for about ``RANGE_BYTES`` of text; an id of several quantiles is split
by the hash of the text), each range is ordered on its own, and only the first
row of each range is passed to the range above it.

Defined cases: a null text is empty; an empty text has an empty fingerprint
(two empty ones are alike, 1.0; an empty and another one 0.0); a text shorter
than ``k`` is one gram, one shorter than a window one window; null ids come
last in the order; equal and null ids are ordered by a hash of the text (rows
that are equal in id and text share a range); the only document is its own next
one; more columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_of, read_table, staged

GRAM = 8            # code points per k-gram; a power of two
WINDOW = 16         # k-grams per window; a power of four
STEP = 128          # windows per stretch
PIECE = 512         # code points cut off a text at a time; a multiple of STEP
RANGE_BYTES = 1 << 30
MASK = 0x7FFFFFFF   # 2^31 - 1, a prime: also the modulus of the hash
BASE = 1_000_003    # of the polynomial
NONE = "9223372036854775807L"  # no k-gram


def _stretches(text: str, first: str, kind: int, k: int, w: int) -> str:
    """SQL: the stretches of the SQL expression ``text``, whose first code
    point has the number ``first``; none for an empty text.

    A regular expression cuts pieces, so that no cut searches from the start of
    a long text; a piece is followed by the first code points of the next one.
    """
    over = w + k - 2
    pieces = f"regexp_extract_all({text}, '(?s).{{1,{PIECE}}}', 0)"
    # A stretch of at most ``over`` code points holds no window of its own,
    # unless it is the whole text.
    last = f"greatest(length(x) + least(length(tail), {over}) - {over} - 1, IF(i = 0, 0, -1))"
    cut = (f"transform(filter(sequence(0, {PIECE // STEP - 1}), c -> c * {STEP} <= least({last}, length(x) - 1)), c -> "
           f"struct({kind} AS kind, cast({first} + i * {PIECE} + c * {STEP} AS long) AS base, "
           f"substring(body, c * {STEP} + 1, {STEP + over}) AS chunk))")
    with_tail = (f"transform(array(substring(coalesce(get(ps, i + 1), ''), 1, {over})), tail -> "
                 f"transform(array(concat(x, tail)), body -> {cut})[0])[0]")
    return f"flatten(transform(array({pieces}), ps -> flatten(transform(ps, (x, i) -> {with_tail}))))"


def _minima(rows: DataFrame, keys: list[str], k: int, w: int) -> DataFrame:
    """``keys``, ``base`` and ``kept``: the different minima of each stretch's
    windows, from rows with ``base`` and ``chunk``."""
    grams = STEP + w - 1
    # Every code point's number, then hashes of 2, 4, ... k of them. Past the end
    # they are those of nothing. No column is NULL: the compiled code is shorter.
    rows = rows.select(*keys, "base", F.expr("length(chunk)").alias("n"), F.encode("chunk", "UTF-32").alias("b"))
    names = [f"c{j}" for j in range(grams + k - 1)]
    rows = rows.select(*keys, "base", "n", *[
        F.expr(f"coalesce(crc32(substring(b, {4 * j + 1}, 4)), 0L) % {MASK}L").alias(c) for j, c in enumerate(names)])
    size = 1
    while size < k:
        power = pow(BASE, size, MASK)
        pairs = [f"({names[j]} * {power}L + {names[j + size]}) % {MASK}L" for j in range(len(names) - size)]
        size *= 2
        if size == k:
            pairs = [f"IF({j} <= greatest(n - {k}, 0), shiftleft({e}, 32) | ({MASK}L - base - {j}), {NONE})"
                     for j, e in enumerate(pairs)]
        names = [f"h{size}_{j}" for j in range(len(pairs))]
        rows = rows.select(*keys, "base", "n", *[F.expr(e).alias(c) for e, c in zip(pairs, names)])
    size = 1
    while size < w:                                     # minima of 4, then 16, ... values
        ahead = [[names[j + a * size] for a in range(4)] for j in range(len(names) - 3 * size)]
        size *= 4
        names = [f"l{size}_{j}" for j in range(len(ahead))]
        rows = rows.select(*keys, "base", "n", *[F.expr(f"least({', '.join(a)})").alias(c)
                                                 for c, a in zip(names, ahead)])
    new = [names[0]] + [f"IF({c} = {before} OR {i} > n - {w + k - 1}, {NONE}, {c})"
                        for i, (before, c) in enumerate(zip(names, names[1:]), 1)]
    return rows.select(*keys, "base", F.expr(f"array_remove(array({', '.join(new)}), {NONE})").alias("kept"))


def kept_of(rows: DataFrame, keys: list[str], texts: dict[str, tuple[str, str]], carried: list[str],
            k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Kept (hash, position) longs, by position, of several texts per row.

    ``texts`` gives per result column the SQL of a text and of its first
    position; ``keys`` name a row and must lead with the columns that the rows
    are partitioned by, so that nothing is shuffled again. The columns
    ``carried`` travel with a row's first stretch alone.
    """
    lists = [_stretches(text, first, i, k, w) for i, (text, first) in enumerate(texts.values())]
    none = "struct(-1 AS kind, 0L AS base, '' AS chunk)"       # carries the other columns
    rows = rows.select(*keys, *carried, F.expr(f"explode(concat(array({none}), {', '.join(lists)}))").alias("x"))
    held = rows.select(*keys, F.expr(f"CASE WHEN x.kind < 0 THEN struct({', '.join(carried)}) END").alias("held"),
                       "x.kind", "x.base", "x.chunk")
    parts = (_minima(held, [*keys, "held", "kind"], k, w).groupBy(*keys).agg(
        F.first("held", ignorenulls=True).alias("held"),
        *[F.collect_list(F.expr(f"CASE WHEN kind = {i} THEN struct(base, kept) END")).alias(name)
          for i, name in enumerate(texts)]))
    return parts.select(*keys, "held.*", *[
        F.expr(f"array_distinct(flatten(transform(array_sort({name}), p -> p.kept)))").alias(name)
        for name in texts])


def prefix(kept: str, windows: str, w: int = WINDOW) -> str:
    """SQL: the entries kept by the first ``windows`` windows.

    Entry after entry, a smaller one takes over when it enters a window, a larger
    one when the entry before it has left."""
    place = f"({MASK}L - ({{0}} & {MASK}L))"
    begins = (f"CASE WHEN i = 0 THEN 0 WHEN v < get({kept}, i - 1) THEN {place.format('v')} - {w - 1} "
              f"ELSE {place.format(f'get({kept}, i - 1)')} + 1 END")
    return f"filter({kept}, (v, i) -> {begins} < {windows})"


def hashes(kept: str) -> str:
    return f"array_distinct(transform({kept}, v -> cast(shiftright(v, 32) AS int)))"


def rendered(kept: str) -> str:
    """SQL: ``hash:position`` pairs, by position."""
    pairs = (f"transform({kept}, v -> concat(cast(shiftright(v, 32) AS string), ':', "
             f"cast({MASK}L - (v & {MASK}L) AS string)))")
    return f"array_join({pairs}, ',')"


def likeness(a: str, b: str) -> str:
    """SQL: Jaccard likeness of two hash sets; two empty sets are alike."""
    both = f"size(array_intersect({a}, {b}))"
    return (f"CASE WHEN size({a}) + size({b}) = 0 THEN 1.0D ELSE "
            f"cast({both} AS double) / (size({a}) + size({b}) - {both}) END")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """``doc_id, fingerprint``: positions and hashes kept for each whole text."""
    rows = docs.selectExpr(f"`{id_col}` AS doc_id", f"coalesce(`{text_col}`, '') AS t",
                           "monotonically_increasing_id() AS row").repartition("row")
    return (kept_of(rows, ["row"], {"kept": ("t", "0")}, ["doc_id"], k, w)
            .selectExpr("doc_id", f"{rendered('kept')} AS fingerprint"))


def _ranges(rows: DataFrame) -> str:
    """SQL: number of the range that ``doc_id`` and the text hash ``s`` lie in;
    ranges of null ids (by the hash) are below all others.

    The driver reads one quantile of the ids per range. They are searched in
    two levels, so a row compares with about ``2 * sqrt(n)`` of them. An id that
    is several quantiles holds several ranges, by the hash.
    """
    size = rows.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    n = max(buckets_of(rows.sparkSession), -(-size // RANGE_BYTES))
    at = ", ".join(str(i / n) for i in range(1, n))
    found = rows.agg(F.expr(f"percentile_approx(doc_id, array({at}), {max(10_000, 4 * n)})").alias("q")).first()["q"]
    none = "cast(shiftrightunsigned(s, 57) AS int) - 64"
    if not found:
        return f"CASE WHEN doc_id IS NULL THEN {none} ELSE 0 END"
    marks = sorted(set(found))
    width = max(1, round(len(marks) ** 0.5))
    groups = [marks[i:i + width] for i in range(0, len(marks), width)]
    tops = ", ".join(f"{g[0]}L" for g in groups)
    fine = ", ".join("array(" + ", ".join(f"{m}L" for m in g) + ")" for g in groups)
    # The number of different marks up to the id, then that of all of them.
    upto, hot = [0], {}
    for m in marks:
        upto.append(upto[-1] + found.count(m))
        if upto[-1] > upto[-2] + 1:
            hot[m] = upto[-1] - upto[-2]
    place = (f"transform(array(size(filter(array({tops}), m -> m <= doc_id))), g -> CASE WHEN g = 0 THEN 0 "
             f"ELSE (g - 1) * {width} + size(filter(array({fine})[g - 1], m -> m <= doc_id)) END)[0]")
    number = f"array({', '.join(map(str, upto))})[{place}]"
    if hot:
        # Of an id with r ranges: the highest hashes in the highest one.
        many = " ".join(f"WHEN {m}L THEN {r}" for m, r in hot.items())
        number += (f" - transform(array(CASE doc_id {many} ELSE 1 END), r -> r - 1 - "
                   f"cast(shiftright(s, 32) * r div {1 << 31} AS int))[0]")
    return f"CASE WHEN doc_id IS NULL THEN {none} ELSE {number} END"


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``part, row, doc_id, t, next_t, last``: rows numbered in their range, with the
    next text; ``last`` marks the end of a range."""
    rows = (docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"coalesce(`{text_col}`, '') AS t")
            .withColumn("s", F.expr("shiftrightunsigned(xxhash64(t), 1)")))
    rows = rows.withColumn("part", F.expr(_ranges(rows)))
    # The first row of each range, for the last row of the range before it:
    # as many rows as ranges.
    tops = staged(rows.groupBy("part").agg(F.max(F.struct("doc_id", "s")).alias("top")), "winnow-tops")
    tops = F.broadcast(tops.withColumnRenamed("part", "top_part"))
    heads = (rows.join(tops, F.expr("part = top_part AND doc_id <=> top.doc_id AND s = top.s"))
             .groupBy("part").agg(F.max("t").alias("t")))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("part"))
    heads = staged(heads.select(
        F.col("part").alias("head_part"),
        F.coalesce(F.lead("t").over(order), F.first("t").over(order)).alias("head_t")), "winnow-heads")
    inside = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"), F.desc("s"), F.desc("t"))
    rows = (rows.withColumn("next_t", F.lead("t").over(inside)).withColumn("row", F.row_number().over(inside))
            .join(heads, F.col("part") == F.col("head_part"))
            .withColumn("last", F.expr("next_t IS NULL")))
    return rows.selectExpr("part", "row", "doc_id", "t", "coalesce(next_t, head_t) AS next_t", "last")


def with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Each text's and its edited text's fingerprint, and how alike they are."""
    span = w + k - 1
    rows = (with_next(docs, id_col, text_col)
            .withColumn("n", F.expr("length(t)")).withColumn("m", F.expr("cast(floor(n / 3) AS int)"))
            .withColumn("stay", F.expr("substring(t, 1, n - m)"))
            .withColumn("new_end", F.expr("substring(next_t, 1, m)"))
            .withColumn("stays", F.expr("n - m")).withColumn("comes", F.expr("length(new_end)"))
            .withColumn("edited_sha256", F.expr("sha2(concat(stay, new_end), 256)"))
            .withColumn("seam", F.expr(f"concat(right(stay, {span - 1}), left(new_end, {span - 1}))"))
            # A seam shorter than a window is one only if it is the whole edited text.
            .withColumn("seam", F.expr(f"IF(length(seam) < {span} AND length(seam) < stays + comes, '', seam)"))
            .withColumn("next_t", F.expr("IF(last, next_t, '')")))
    carried = ["doc_id", "n", "stays", "comes", "edited_sha256", "last"]
    texts = {"kept": ("t", "0"), "seam": ("seam", f"greatest(stays - {span - 1}, 0)"), "head": ("next_t", "0")}
    rows = kept_of(rows.select("part", "row", *carried, "t", "seam", "next_t"), ["part", "row"], texts, carried, k, w)
    inside = Window.partitionBy("part").orderBy("row")
    edited = (f"concat({prefix('kept', f'stays - {span - 1}', w)}, seam, "
              f"transform({prefix('kept_next', f'comes - {span - 1}', w)}, v -> v - stays))")
    return (rows.withColumn("kept_next", F.lead("kept").over(inside))
            .withColumn("kept_next", F.expr("IF(last, head, kept_next)"))
            .withColumn("kept_edited", F.expr(f"array_distinct({edited})"))
            .select("doc_id", "n", "edited_sha256", F.expr(rendered("kept")).alias("fingerprint"),
                    F.expr(rendered("kept_edited")).alias("edited_fingerprint"),
                    F.expr(hashes("kept")).alias("h"), F.expr(hashes("kept_edited")).alias("he"),
                    F.expr(hashes("kept_next")).alias("hn"))
            .selectExpr("doc_id", "cast(n AS long) AS n_chars", "edited_sha256", "fingerprint",
                        "edited_fingerprint", f"{likeness('h', 'he')} AS near_edited",
                        f"{likeness('h', 'hn')} AS near_next"))


def op8_winnowing(spark, sf_dir: str) -> DataFrame:
    return with_edited(read_table(spark, sf_dir, "documents"))
