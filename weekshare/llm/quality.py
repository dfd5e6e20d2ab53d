"""Quality classifier by hierarchical empirical Bayes (operator 4).

Document evidence: two additive logistic models (junk, toxic) over hashed
words and binned text measures, fitted on the driver on a bounded sample of
labelled rows (``SAMPLE``; the rows with the smallest hash of their id).
Everything else covers all rows.

Site evidence: every document's probabilities are summed per path (host and
sub-site) in one grouped aggregation. A host's posterior rate shrinks towards
the global rate by a prior weight estimated from the spread between hosts
(moments of the beta-binomial), a path's towards its host's likewise, so a
sparse site follows its parent. A document's final odds are its evidence with
the training prior replaced by its path's posterior, its own share left out of
all three sums: what a document says counts once, and one alone in its path
follows its host. The two prior weights are estimated from all documents.

Two passes over the texts, no shuffle of texts: the first only yields sums per
path, the second scores again and looks its path up. A host with a third of
all rows is one row per task after the partial aggregation.

Defined cases: null or empty text is scored like any other (it has no words);
null host or path is a site of its own; null, repeated ids and repeated rows
are scored each; labels without a text and null labels are ignored, of
repeated labels the worse counts; without labels of both kinds a model gives
no evidence and nothing is rejected by it; all columns of the input stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import read_table, staged, text_batches
from .tokens import flat, hash_words, lowered, split

SAMPLE = 10_000         # labelled rows the models are fitted on, at most
BITS = 18               # hashed words: 2 ** BITS weights per model
BINS = 24               # per measure
ROUNDS = 80             # gradient steps
RIDGE = 2e-4
BROADCAST_SITES = 200_000       # host and path posteriors that may be broadcast
REJECT = 0.5            # probability from which a document is rejected
PRIOR_RANGE = (1.0, 1000.0)     # pseudo-documents a parent may weigh
HEADS = ("toxic", "junk")

# Measures per text, each per byte or per word.
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in ".,'-"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True


def features(column: pa.Array):
    """Distinct hashed words per text ``(feature, text number)``, and measures."""
    data, offsets = flat(column)
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)

    def share(table):
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[offsets[1:]] - total[offsets[:-1]]) / size

    low = lowered(data)
    start, length, text = split(low, offsets, "letters")
    h = hash_words(low, start, length)
    count = np.bincount(text, minlength=n)
    key = (text.astype(np.uint64) << np.uint64(BITS)) | (h & np.uint64((1 << BITS) - 1))
    order = np.sort(key)
    first = np.ones(len(order), bool)
    first[1:] = order[1:] != order[:-1]
    run = np.diff(np.append(np.flatnonzero(first), len(order)))
    uniq = order[first]
    of = (uniq >> np.uint64(BITS)).astype(np.int64)
    feature = (uniq & np.uint64((1 << BITS) - 1)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, of, run)
    words = np.maximum(count, 1)
    kinds = np.bincount(of, minlength=n)
    same = np.zeros(n)
    if len(h) > 1:
        again = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
        same = np.bincount(text[1:][again], minlength=n)
    measures = np.stack([
        share(_PUNCT), share(_UPPER), share(_DIGIT), np.log1p(np.diff(offsets)),
        kinds / words ** 0.8, most / words, same / words,
        np.bincount(text, length, minlength=n) / words], axis=1)
    return feature, of, measures


def _design(feature, of, measures, edges):
    """Word features and one bin per measure as one list of (column, row)."""
    n, m = measures.shape
    bins = np.stack([np.searchsorted(edges[j], measures[:, j], "right") for j in range(m)], 1)
    bins += (1 << BITS) + np.arange(m) * (BINS + 1)
    return np.concatenate([feature, bins.ravel()]), np.concatenate([of, np.repeat(np.arange(n), m)])


def _fit(column, row, n, y):
    """Logistic regression with word features scaled by their class log-ratio."""
    width = (1 << BITS) + 8 * (BINS + 1)
    pos = np.bincount(column, y[row], width)
    df = np.bincount(column, minlength=width)
    n1, n0 = y.sum(), n - y.sum()
    ratio = np.log((pos + 0.5) / (n1 + 1)) - np.log((df - pos + 0.5) / (n0 + 1))
    scale = np.abs(ratio)
    scale[df < 3] = 0                       # a word seen twice proves nothing
    scale[1 << BITS:] = 1
    use = scale[column] > 0.7
    column, row = column[use], row[use]
    x = scale[column]
    w, b = np.zeros(width), float(np.log((n1 + 1) / (n0 + 1)))
    prior, grad2 = b, np.full(width + 1, 1e-8)
    for _ in range(ROUNDS):
        z = np.clip(b + np.bincount(row, w[column] * x, n), -30, 30)
        r = 1 / (1 + np.exp(-z)) - y
        g = np.append(np.bincount(column, r[row] * x, width) / n + RIDGE * w, r.mean())
        grad2 += g * g
        step = 0.5 * g / np.sqrt(grad2)
        w -= step[:-1]
        b -= step[-1]
    return (w * scale).astype(np.float32), float(b), prior


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample: int = SAMPLE) -> dict:
    """Fit both models on at most ``sample`` labelled documents."""
    chosen = (labels.groupBy(F.col(id_col).alias("doc_id"))
              .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
              .where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
            .join(F.broadcast(chosen), "doc_id"))           # ``sample`` rows at most

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in text_batches(batches):
            feature, of, measures = features(batch.column("text"))
            at = np.searchsorted(of, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("quality").cast(pa.int64()), batch.column("toxic").cast(pa.int64()),
                pa.array([feature[a:b].astype("<i4").tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                pa.array([m.astype("<f8").tobytes() for m in measures], pa.binary())],
                names=["quality", "toxic", "words", "measures"])

    got = rows.select("quality", "toxic", "text").mapInArrow(
        run, "quality long, toxic long, words binary, measures binary").collect()
    model: dict = {"edges": None, "heads": {}}
    if not got:
        return model
    lists = [np.frombuffer(r["words"], "<i4") for r in got]
    of = np.repeat(np.arange(len(got)), [len(x) for x in lists])
    measures = np.stack([np.frombuffer(r["measures"], "<f8") for r in got])
    model["edges"] = [np.unique(np.quantile(measures[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))
                      for j in range(measures.shape[1])]
    column, row = _design(np.concatenate(lists).astype(np.int64), of, measures, model["edges"])
    for name, y in (("toxic", [r["toxic"] > 0 for r in got]), ("junk", [r["quality"] < 1 for r in got])):
        y = np.array(y, float)
        if 0 < y.sum() < len(y):
            model["heads"][name] = _fit(column, row, len(got), y)
    return model


def score(docs: DataFrame, model: dict, text_col: str = "text", prefix: str = "_") -> DataFrame:
    """``docs`` with ``_toxic`` and ``_junk``: evidence as log odds at even prior."""
    at = docs.columns.index(text_col)
    names = [*docs.columns, *(f"{prefix}{h}" for h in HEADS)]
    heads, edges = model["heads"], model["edges"]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in text_batches(batches, text_col):
            n = batch.num_rows
            extra = [np.full(n, np.nan) for _ in HEADS]
            if heads:
                column, row = _design(*features(batch.column(at)), edges)
                for i, name in enumerate(HEADS):
                    if name in heads:
                        w, b, prior = heads[name]
                        extra[i] = b - prior + np.bincount(row, w[column], n)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, extra)], names=names)

    return docs.mapInArrow(run, StructType(
        [*docs.schema.fields, *(StructField(f"{prefix}{h}", DoubleType()) for h in HEADS)]))


def _moments(sites: DataFrame, rate: str, parent: str) -> float:
    """Prior weight of a parent from the spread of its sites' rates: the
    beta-binomial moment estimate, within ``PRIOR_RANGE``."""
    r = sites.where("n > 1").agg(
        F.sum(F.expr(f"n * pow({rate} / n - {parent}, 2)")).alias("s"),
        F.sum(F.expr(f"{parent} * (1 - {parent})")).alias("v"), F.sum("n").alias("n"),
        F.sum(F.expr(f"n * {parent} * (1 - {parent})")).alias("nv"),
        F.count(F.lit(1)).alias("k")).first()
    low, high = PRIOR_RANGE
    if not r or not r["k"] or not r["nv"]:
        return high
    # E[s] = sum v (1 + (n - 1) rho), rho the correlation within a site.
    rho = (r["s"] - r["v"]) / max(r["nv"] - r["v"], 1e-12)
    return high if rho <= 1 / (high + 1) else float(max(low, 1 / rho - 1))


def _probability(model: dict, head: str, evidence: str) -> str:
    """What a document adds to its sites' sums: its rate at the training prior."""
    if head not in model["heads"]:
        return "0D"
    return f"1 / (1 + exp(-({evidence} + {model['heads'][head][2]!r}D)))"


def _posterior(model: dict, head: str, prefix: str = "", own: str = "0D", count: int = 0) -> str:
    """Log odds of a path from the sums of ``site_posteriors``, leaving out
    ``count`` documents of rate ``own``: global rate, then host, then path."""
    def left(level):
        return f"greatest({prefix}{level}s_{head} - {own}, 0D)", f"({prefix}{level}n - {count})"

    start = 1 / (1 + np.exp(-model["heads"][head][2])) if head in model["heads"] else 0.0
    s, n = left("g_")
    rate = f"if({n} > 0, {s} / {n}, {float(start)!r}D)"     # no other document: the training prior
    rate = f"least(greatest({rate}, 1e-6D), 1 - 1e-6D)"
    for level in ("h_", ""):
        s, n = left(level)
        weight = f"{prefix}{level}w_{head}"
        rate = f"(({s} + {weight} * {rate}) / ({n} + {weight}))"
    return f"ln({rate} / (1 - {rate}))"


def site_posteriors(scored: DataFrame, model: dict, host: str, path: str) -> DataFrame:
    """One row per host and path: posterior log odds of each head for a document
    not seen yet, and what they come from: sums and prior weights of the path
    (``n s_ w_``), its host (``h_``) and of all (``g_``)."""
    paths = (scored.selectExpr(f"{host} AS _host", f"{path} AS _path",
                               *(f"{_probability(model, h, f'_{h}')} AS p_{h}" for h in HEADS))
             .groupBy("_host", "_path")
             .agg(F.count(F.lit(1)).alias("n"), *(F.sum(f"p_{h}").alias(f"s_{h}") for h in HEADS)))
    paths = staged(paths, "quality-paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), *(F.sum(f"s_{h}").alias(f"s_{h}") for h in HEADS))
    total = hosts.agg(F.sum("n").alias("n"), *(F.sum(f"s_{h}").alias(h) for h in HEADS)).first()
    joined = (paths.join(hosts.selectExpr("_host AS h_host", "n AS h_n", *(f"s_{h} AS h_s_{h}" for h in HEADS)),
                         F.col("_host").eqNullSafe(F.col("h_host")))
              .withColumn("g_n", F.lit(total["n"] or 0)))
    for h in HEADS:
        mean = (total[h] or 0.0) / total["n"] if total["n"] else 0.0
        mean = min(max(mean, 1e-6), 1 - 1e-6)
        weight = _moments(hosts, f"s_{h}", f"{mean!r}D")
        rated = joined.withColumn("r", F.expr(f"(h_s_{h} + {weight!r}D * {mean!r}D) / (h_n + {weight!r}D)"))
        joined = (joined.withColumn(f"g_s_{h}", F.lit(total[h] or 0.0)).withColumn(f"h_w_{h}", F.lit(weight))
                  .withColumn(f"w_{h}", F.lit(_moments(rated, f"s_{h}", "r"))))
    return joined.selectExpr(
        "_host AS s_host", "_path AS s_path", *(f"{_posterior(model, h)} AS site_{h}" for h in HEADS),
        *(f"{level}n" for level in ("", "h_", "g_")), *(f"{level}s_{h}" for level in ("", "h_", "g_") for h in HEADS),
        *(f"{level}w_{h}" for level in ("", "h_") for h in HEADS))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source",
             path: str = "concat_ws('/', source, lang)", id_col: str = "doc_id",
             text_col: str = "text", prefix: str = "_") -> DataFrame:
    """``docs`` with ``_p_toxic``, ``_p_junk`` and ``_kept``.

    ``host`` and ``path`` are SQL expressions over the columns of ``docs``;
    no column of ``docs`` may begin with ``prefix``.
    """
    columns = [f"`{c}`" for c in docs.columns]
    model = train(docs, labels, id_col, text_col)
    needed = docs.selectExpr(f"`{text_col}`", f"{host} AS _h", f"{path} AS _p")
    sites = staged(site_posteriors(score(needed, model, text_col), model, "_h", "_p"), "quality-sites")
    few = sites.count() <= BROADCAST_SITES      # else Spark shuffles, splitting hot sites
    sites = sites.toDF(*(f"{prefix}{c}" for c in sites.columns))
    sites = F.broadcast(sites) if few else sites
    scored = score(docs, model, text_col, prefix).join(
        sites, F.expr(f"({host}) <=> {prefix}s_host AND ({path}) <=> {prefix}s_path"), "left")
    odds = {}
    for h in HEADS:
        site = _posterior(model, h, prefix, f"({_probability(model, h, f'{prefix}{h}')})", 1)
        odds[h] = f"1 / (1 + exp(-({prefix}{h} + {site})))" if h in model["heads"] else "0D"
    kept = " AND ".join(f"{prefix}p_{h} < {REJECT}" for h in HEADS)
    return (scored.selectExpr(*columns, *(f"coalesce({p}, 0D) AS {prefix}p_{h}" for h, p in odds.items()))
            .withColumn(f"{prefix}kept", F.expr(kept)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents the classifier keeps, with the columns of ``docs``."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return (classify(docs, labels, prefix=prefix).where(f"{prefix}kept")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op4_hierarchical_quality(spark, sf_dir: str) -> DataFrame:
    """The documents kept, with their evidence; rejected ones are left out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return (classify(docs, read_table(spark, sf_dir, "labels")).where("_kept")
            .selectExpr("doc_id", "source", "_p_toxic AS p_toxic", "_p_junk AS p_junk", "_kept AS kept"))
