"""Language-model scores by deleted interpolation (operator 2).

Model: word pairs mixed with single words mixed with a uniform share,

    p1(w)   = a f(w) + (1 - a) / (V + 1)
    p(w|v)  = l[b] f(w|v) + (1 - l[b]) p1(w),   b = bucket of the count of v

with maximum-likelihood frequencies ``f`` and buckets of the context's count by
powers of two. The weights are learned by expectation-maximisation on held-out
counts: one tenth of the training documents is held out, frequencies come from
the other nine tenths (the counts with the held-out part deleted). The final
model uses the counts of all training documents with those weights.

Counts cover all training documents and every word and pair, with no cut-off:
chunks send their distinct keys with counts to key ranges and get the totals
back (``chunks``). Beyond ``FAN`` ranges this takes two steps: a group of chunks
adds up its counts of a wide range, as one larger chunk would, and asks the
ranges inside for the totals; so rows hold about as many keys at any size
instead of growing with the square of the input. Only bounded tables reach the driver: counts of counts, and
the held-out likelihood ratios by bucket, rounded to a sixteenth of an octave.

Words are those between white space, A-Z as lower case; each document ends
with an end token, which is also the context of its first word. Keys are
64-bit hashes.

Defined cases: null and empty texts have the end token alone; a null id is
taken as empty text for the training split; repeated ids and rows count each;
an empty training set leaves the uniform share; more columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import (answers_by_chunk, first_ranges, open_chunk, pack_keys,
                     range_runs, ranges_for, unpack_keys, write_chunks)
from .common import read_table, staged
from .tokens import hash_words, lowered, mix, split

TEST_FOLDS = 10             # id hash modulo this: 0 is not learned from
HELD_FOLDS = 10             # of the rest, the next digit: 0 is for the weights
RANGE_BYTES = 8 << 20       # text per key range
BUCKETS = 48                # of context counts, by powers of two
STEP = 16                   # ratio bins per octave
EM_ROUNDS = 200
SMOOTHING = 0.1             # of the base score

END = np.uint64(0x9D2C5680CAFEF00D)
TEST, HELD, TRAIN, MIXED = 0, 1, 2, 3      # MIXED: a group's held-out and other counts
SENT = "part int, chunk long, kind int, keys binary, counts binary"
SUMS = "chunk long, part int, total binary, rest binary, stat long, value long"
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def fold(ids: list) -> np.ndarray:
    """TEST, HELD or TRAIN for each id."""
    crc = np.array([zlib.crc32(b"" if i is None else str(i).encode()) for i in ids], np.int64)
    return np.where(crc % TEST_FOLDS == 0, TEST,
                    np.where(crc // TEST_FOLDS % HELD_FOLDS == 0, HELD, TRAIN))


def chunk_tokens(data: np.ndarray, offsets: np.ndarray):
    """Token hashes with end tokens, pair keys, and the document of each."""
    data = lowered(data)
    start, length, text = split(data, offsets)
    n = len(offsets) - 1
    ends = np.cumsum(np.bincount(text, minlength=n)) + np.arange(n)
    tokens = np.empty(len(start) + n, np.uint64)
    tokens[np.arange(len(start)) + text] = hash_words(data, start, length)
    tokens[ends] = END
    before = np.empty_like(tokens)
    before[:1] = END
    before[1:] = tokens[:-1]
    pairs = mix(mix(before) + tokens)
    return tokens, before, pairs, np.searchsorted(ends, np.arange(len(tokens)))


def _send(ranges: int):
    """Chunk -> distinct words (part < ranges) and pairs, with their counts."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                kind = batch.column("kind")[i].as_py()
                _, data, offsets = open_chunk(batch, i)
                tokens, _, pairs, _ = chunk_tokens(data, offsets)
                parts, counts, keys = [], [], []
                for which, all_keys in enumerate((tokens, pairs)):
                    uniq, n = np.unique(all_keys, return_counts=True)
                    used, cuts = range_runs(uniq, ranges)
                    for b, x, y in zip(used.tolist(), cuts, cuts[1:]):
                        parts.append(which * ranges + b)
                        keys.append(pack_keys(uniq[x:y]))
                        counts.append(n[x:y].astype("<u4").tobytes())
                m = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts, pa.int32()), pa.array([batch.column("chunk")[i].as_py()] * m, pa.int64()),
                     pa.array([kind] * m, pa.int32()), pa.array(keys, pa.binary()),
                     pa.array(counts, pa.binary())], names=["part", "chunk", "kind", "keys", "counts"])
    return run


def count_bin(c: np.ndarray) -> np.ndarray:
    """Counts up to 64 as they are, larger ones by a sixteenth of an octave."""
    return np.where(c <= 64, c, np.rint(STEP * np.log2(np.maximum(c, 1))).astype(np.int64))


def bin_count(b: int) -> float:
    return float(b) if b <= 64 else 2.0 ** (b / STEP)


def _added(table: pa.Table):
    """Rows of one key range -> its distinct keys with held-out and other
    counts, the place of every row's keys among them, and where rows begin."""
    keys = [unpack_keys(k) for k in table.column("keys").to_pylist()]
    cuts = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    uniq, at = np.unique(np.concatenate(keys), return_inverse=True)
    held, rest = np.zeros(len(uniq), np.int64), np.zeros(len(uniq), np.int64)
    for x, y, kind, packed in zip(cuts, cuts[1:], table.column("kind").to_pylist(),
                                  table.column("counts").to_pylist()):
        here = at[x:y]                              # a row's keys are distinct
        if kind == MIXED:
            both = np.frombuffer(packed, "<i8").reshape(2, -1)
            held[here] += both[0]
            rest[here] += both[1]
        elif kind != TEST:
            (held if kind == HELD else rest)[here] += np.frombuffer(packed, "<u4")
    return uniq, held, rest, at, cuts


def _asker(groups: int) -> str:
    """SQL for the number of a (wide range, group of chunks)."""
    return f"part * {groups}L + pmod(xxhash64(chunk), {groups}L)"


def _split(wide: int, ranges: int):
    """Rows of a group of chunks for one wide range -> one row per range inside."""
    def run(table: pa.Table) -> pa.Table:
        which = table.column("part")[0].as_py() // wide
        uniq, held, rest, _, _ = _added(table)
        used, cuts = range_runs(uniq, ranges)
        spans = list(zip(cuts, cuts[1:]))
        return pa.table({
            "part": pa.array(which * ranges + used, pa.int32()),
            "chunk": pa.array([table.column("asker")[0].as_py()] * len(used), pa.int64()),
            "kind": pa.array([MIXED] * len(used), pa.int32()),
            "keys": pa.array([pack_keys(uniq[x:y]) for x, y in spans], pa.binary()),
            "counts": pa.array([np.stack([held[x:y], rest[x:y]]).astype("<i8").tobytes() for x, y in spans],
                               pa.binary())})
    return run


def _hand_on(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """A group's rows for one wide range and the answers from inside -> answers
    for its chunks."""
    _, _, _, at, cuts = _added(rows)
    order = np.argsort(answers.column("part").to_numpy())

    def joined(name):
        packed = answers.column(name).to_pylist()
        return np.frombuffer(b"".join(packed[x] for x in order), "<u8")[at]

    total, rest = joined("total"), joined("rest")
    kinds = rows.column("kind").to_pylist()
    return pa.table({
        "chunk": rows.column("chunk"), "part": rows.column("part"),
        "total": pa.array([total[x:y].tobytes() for x, y in zip(cuts, cuts[1:])], pa.binary()),
        "rest": pa.array([rest[x:y].tobytes() if k == HELD else b"" for x, y, k in zip(cuts, cuts[1:], kinds)],
                         pa.binary())})


def _sum(ranges: int):
    """All rows of one key range -> totals for each sender, and for words the
    counts of counts the driver needs."""
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        chunk, kind = table.column("chunk").to_pylist(), table.column("kind").to_pylist()
        _, held, rest, at, cuts = _added(table)
        total, back = (held + rest).astype("<u8")[at], rest.astype("<u8")[at]
        out = {"chunk": chunk, "part": [part] * len(chunk),
               "total": [total[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
               "rest": [back[a:b].tobytes() if k in (HELD, MIXED) else b"" for a, b, k in zip(cuts, cuts[1:], kind)],
               "stat": [None] * len(chunk), "value": [None] * len(chunk)}
        if part < ranges:
            stats = {-1: int((held + rest > 0).sum()), -2: int((held + rest).sum()),
                     -3: int((rest > 0).sum()), -4: int(rest.sum())}
            bins = count_bin(rest)
            sums = np.bincount(bins, held)
            stats |= {int(b): int(sums[b]) for b in np.flatnonzero(sums)}
            for name, fill in (("chunk", None), ("part", part), ("total", None), ("rest", None)):
                out[name] += [fill] * len(stats)
            out["stat"] += list(stats)
            out["value"] += list(stats.values())
        return pa.table({"chunk": pa.array(out["chunk"], pa.int64()), "part": pa.array(out["part"], pa.int32()),
                         "total": pa.array(out["total"], pa.binary()), "rest": pa.array(out["rest"], pa.binary()),
                         "stat": pa.array(out["stat"], pa.int64()), "value": pa.array(out["value"], pa.int64())})
    return run


def mixture_weight(ratios: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> float:
    """EM for the share of a model whose likelihood is ``ratio`` times the other's."""
    total = counts.sum()
    if not total:
        return math.nan
    share = 0.5
    for _ in range(rounds):
        share = float((counts * (share * ratios / (share * ratios + 1 - share))).sum() / total)
        share = min(max(share, 1e-6), 1 - 1e-6)
    return share


def bucket(counts: np.ndarray) -> np.ndarray:
    """Bucket of a context count: 0 for unseen, else one per power of two."""
    return np.where(counts > 0, 1 + np.log2(np.maximum(counts, 1)).astype(np.int64), 0)


def _looked_up(answers, field: str, ranges: int, tokens, pairs, before):
    """Counts of every token, pair and context of a chunk."""
    got = {a["part"]: np.frombuffer(a[field], "<u8") for a in answers}
    word_keys, word_at = np.unique(tokens, return_inverse=True)
    _, pair_at = np.unique(pairs, return_inverse=True)
    none = np.zeros(0, np.uint64)
    words = np.concatenate([got.get(b, none) for b in range(ranges)]).astype(float)
    both = np.concatenate([got.get(ranges + b, none) for b in range(ranges)]).astype(float)
    return words[word_at], both[pair_at], words[np.searchsorted(word_keys, before)]


def _frequency(c2: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.divide(c2, c, out=np.zeros_like(c2), where=c > 0)


def _ratios(ranges: int, vocabulary: int, total: int, share: float):
    """Held-out chunks -> counts by context bucket and likelihood ratio."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                _, data, offsets = open_chunk(batch, i)
                tokens, before, pairs, _ = chunk_tokens(data, offsets)
                c1, c2, c = _looked_up(batch.column("answers")[i].as_py(), "rest", ranges,
                                       tokens, pairs, before)
                p1 = share * c1 / max(total, 1) + (1 - share) / (vocabulary + 1)
                f = _frequency(c2, c)
                key = np.full(len(f), -1000, np.int64)
                some = f > 0
                key[some] = np.rint(STEP * np.log2(f[some] / p1[some])).astype(np.int64)
                found, n = np.unique(np.stack([bucket(c), key]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1]), pa.array(n)],
                                                 names=["bucket", "ratio", "n"])
    return run


def _score(ranges: int, vocabulary: int, total: int, share: float, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, data, offsets = open_chunk(batch, i)
                tokens, before, pairs, doc = chunk_tokens(data, offsets)
                c1, c2, c = _looked_up(batch.column("answers")[i].as_py(), "total", ranges,
                                       tokens, pairs, before)
                n = len(offsets) - 1
                base = np.log10((c1 + SMOOTHING) / (total + SMOOTHING * (vocabulary + 1)))
                p1 = share * c1 / max(total, 1) + (1 - share) / (vocabulary + 1)
                w = weights[bucket(c)]
                p = np.log10(w * _frequency(c2, c) + (1 - w) * p1)
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(fold(ids.to_pylist()) == TEST), pa.array(np.bincount(doc, minlength=n)),
                    pa.array(np.bincount(doc, c1 > 0, n).astype(np.int64)), pa.array(np.full(n, total)),
                    pa.array(np.bincount(doc, base, n)), pa.array(np.bincount(doc, p, n))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                           "base_score", "score"])
    return run


def _totals(chunks: DataFrame, wide: int, ranges: int) -> tuple[DataFrame, DataFrame]:
    """Totals for the chunks' keys by wide range, and the counts of counts."""
    sent = chunks.mapInArrow(_send(wide), SENT)
    if wide == ranges:
        sums = staged(sent.groupBy("part").applyInArrow(_sum(ranges), SUMS), "lm-sums")
        return sums.where("chunk IS NOT NULL").select("chunk", "part", "total", "rest"), sums
    groups = 1 + chunks.count() // wide             # a group's wide range is about a chunk's keys
    sent = staged(sent.withColumn("asker", F.expr(_asker(groups))), "lm-sent")
    inside = sent.groupBy("asker").applyInArrow(_split(wide, ranges), SENT)
    sums = staged(inside.groupBy("part").applyInArrow(_sum(ranges), SUMS), "lm-sums")
    asked = sums.where("chunk IS NOT NULL").select(F.col("chunk").alias("asker"), "part", "total", "rest")
    answers = (sent.groupBy("asker").cogroup(asked.groupBy("asker"))
               .applyInArrow(_hand_on, "chunk long, part int, total binary, rest binary"))
    return staged(answers, "lm-answers"), sums


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, base score and the model's log10 probability."""
    chunks = write_chunks(docs, fold, id_col=id_col, text_col=text_col)
    ranges = ranges_for(chunks, RANGE_BYTES)
    wide = first_ranges(ranges)
    answers, sums = _totals(chunks, wide, ranges)

    stats = {r["stat"]: r["value"] for r in sums.where("stat IS NOT NULL").groupBy("stat")
             .agg(F.sum("value").alias("value")).collect()}           # some hundred rows
    vocabulary, total = stats.get(-1, 0), stats.get(-2, 0)
    vocabulary_rest, total_rest = stats.get(-3, 0), stats.get(-4, 0)
    bins = sorted(b for b in stats if b >= 0)
    share = mixture_weight(np.array([bin_count(b) / max(total_rest, 1) * (vocabulary_rest + 1) for b in bins]),
                           np.array([stats[b] for b in bins], float))
    share = 0.5 if math.isnan(share) else share

    held = (chunks.where(f"kind = {HELD}").join(answers_by_chunk(
        answers.where("length(rest) > 0").select("chunk", "part", "rest")), "chunk"))
    rows = (held.mapInArrow(_ratios(wide, vocabulary_rest, total_rest, share),
                            "bucket long, ratio long, n long")
            .groupBy("bucket", "ratio").agg(F.sum("n").alias("n")).collect())   # buckets x ratio bins
    weights, last = np.zeros(BUCKETS + 17), 0.0
    for b in range(1, len(weights)):
        mine = [r for r in rows if r["bucket"] == b]
        w = mixture_weight(np.array([0.0 if r["ratio"] == -1000 else 2.0 ** (r["ratio"] / STEP) for r in mine]),
                           np.array([r["n"] for r in mine], float))
        weights[b] = last = last if math.isnan(w) else w

    return (chunks.join(answers_by_chunk(answers.select("chunk", "part", "total")), "chunk")
            .mapInArrow(_score(wide, vocabulary, total, share, weights), SCORES))


def op2_deleted_interpolation(spark, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))
