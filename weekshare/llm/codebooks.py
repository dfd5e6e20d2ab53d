"""Vector codes from product codebooks, assigned by Orchard search (operator 12).

Vectors become integers (``floor(scale * x)``), are cut into equal parts, and
every part is replaced by the number of its nearest entry in that part's
codebook. Codebooks start as the parts of the smallest ids and follow some
rounds of assignment and means; all arithmetic is whole, so a result does not
depend on how rows are dealt to tasks.

Nearest entries come from Orchard search. Every entry keeps the list of all
entries sorted by their distance from it. A part starts at some entry and reads
that entry's list in order; an entry that is nearer (or as near, with a lower
number) becomes the current one and its list is read from the start; entries
seen before are marked and not measured again. Once the list is beyond twice
the part's distance from the current entry, no unread entry can be as near: the
triangle inequality ends the search with the exact nearest entry. All parts of a
batch take their steps together, on arrays.

One round is one map over the table: a task sums its rows per entry and sends at
most one number per entry and position, whatever its rows are. The codebooks
(entries x dimensions) are all that the driver holds.

Defined cases: vectors that are null, or hold null or non-finite components, are
dropped; components beyond ``CLAMP`` are taken as ``CLAMP`` (so that sums stay
whole numbers of 64 bits); a length that is no multiple of the parts is filled
with zeros; vectors of another length than the smallest id's are dropped; with
fewer vectors than entries the codebooks are smaller; ties go to the lower
entry, and equal ids start in the order of their vectors; null ids come last;
repeated rows are coded each; more columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, staged

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
CLAMP = 1 << 24             # of a component, after scaling
BLOCK = 4096                # parts that search together
VECTORS = "vec_id long, label string, v array<long>"


@dataclass
class Codebooks:
    """``entries[part, entry, position]``, whole numbers."""

    entries: np.ndarray

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Orchard:
    """Exact nearest entries of one codebook (entries x positions, whole numbers)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        apart = _apart(self.entries, self.entries)
        # Per entry: all entries by distance, the lower number first on ties.
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, 1)
        self._sums = self.entries.sum(1)
        self._by_sum = np.argsort(self._sums, kind="stable")

    def first(self, queries: np.ndarray) -> np.ndarray:
        """An entry to start from: about the one with the nearest component sum."""
        at = np.searchsorted(self._sums[self._by_sum], queries.sum(1))
        return self._by_sum[np.minimum(at, len(self._by_sum) - 1)]

    def nearest(self, queries: np.ndarray, first: np.ndarray | None = None,
                measured: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry and the squared distance, per query.
        ``measured``, if given, receives the number of distances taken."""
        n, m = len(queries), len(self.entries)
        current = (self.first(queries) if first is None else first).copy()
        best = _rows_apart(queries, self.entries[current])
        seen = np.zeros((n, m), bool)                   # the marks
        seen[np.arange(n), current] = True
        place = np.zeros(n, np.int64)
        active = np.arange(n)
        while len(active):
            at, step = current[active], place[active]
            # Beyond twice the current distance (four times its square): done.
            within = self.apart[at, step] <= 4 * best[active]
            active, at, step = active[within], at[within], step[within]
            entry = self.order[at, step]
            place[active] += 1
            new = ~seen[active, entry]
            some, entry = active[new], entry[new]
            seen[some, entry] = True
            d = _rows_apart(queries[some], self.entries[entry])
            nearer = (d < best[some]) | (d == best[some]) & (entry < current[some])
            jump = some[nearer]
            best[jump], current[jump], place[jump] = d[nearer], entry[nearer], 0
            active = active[place[active] < m]
        if measured is not None:
            measured[:] = seen.sum(1)
        return current, best


def _rows_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.stack([_rows_apart(np.broadcast_to(x, b.shape), b) for x in a]) if len(a) else \
        np.zeros((0, len(b)), np.int64)


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  label_col: str | None = "label", scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v``: the rows kept, their components as whole numbers.
    The label is text; null stays null."""
    label = f"cast(`{label_col}` AS string)" if label_col else "cast(NULL AS string)"
    # NaN is above every number in this order, so the test also drops it.
    return (df.selectExpr(f"cast(`{id_col}` AS long) AS vec_id", f"{label} AS label",
                          f"cast(`{vector_col}` AS array<double>) AS x")
            .where("x IS NOT NULL AND forall(x, c -> c IS NOT NULL AND "
                   "abs(c) < cast('Infinity' AS double))")
            .selectExpr("vec_id", "label", f"transform(x, c -> cast(greatest(least(floor(c * {scale}D), "
                        f"{CLAMP}D), -{CLAMP}D) AS long)) AS v"))


def _matrix(batch: pa.RecordBatch, length: int, parts: int) -> np.ndarray:
    """The batch's vectors as rows x parts x positions."""
    column = batch.column("v")
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, length)
    width = -(-length // parts)
    if width * parts != length:
        flat = np.pad(flat, ((0, 0), (0, width * parts - length)))
    return flat.reshape(batch.num_rows, parts, width)


def _assign(searches: list[Orchard], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers and squared distances, rows x parts."""
    codes = np.zeros(x.shape[:2], np.int64)
    errors = np.zeros(x.shape[:2], np.int64)
    for p, search in enumerate(searches):
        for at in range(0, len(x), BLOCK):
            codes[at:at + BLOCK, p], errors[at:at + BLOCK, p] = search.nearest(x[at:at + BLOCK, p])
    return codes, errors


def first_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> tuple[Codebooks, int] | None:
    """The parts of the smallest ids' vectors, and the vectors' length."""
    order = [F.asc_nulls_last("vec_id"), F.asc("v")]
    head = vectors.orderBy(*order).select(F.size("v").alias("n")).first()
    if head is None:
        return None
    rows = vectors.where(F.size("v") == head["n"]).orderBy(*order).select("v").limit(entries).collect()
    width = -(-head["n"] // parts)
    x = np.zeros((len(rows), parts * width), np.int64)
    x[:, :head["n"]] = [r["v"] for r in rows]
    return Codebooks(x.reshape(len(rows), parts, width).transpose(1, 0, 2).copy()), head["n"]


def next_codebooks(vectors: DataFrame, books: Codebooks, length: int) -> Codebooks:
    """One round: entries become the floored means of the parts assigned to them."""
    parts, entries, width = books.entries.shape
    table = books.entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(b) for b in table]
        sums = np.zeros((parts, entries, width + 1), np.int64)      # the last one counts
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, length, parts)
                codes, _ = _assign(searches, x)
                for p in range(parts):
                    order = np.argsort(codes[:, p], kind="stable")
                    used, begin = np.unique(codes[order, p], return_index=True)
                    sums[p, used, :width] += np.add.reduceat(x[order, p], begin, axis=0)
                    sums[p, used, width] += np.bincount(codes[:, p])[used]
        p, e = np.nonzero(sums[:, :, width])
        place = np.tile(np.arange(width + 1, dtype=np.int32), len(p))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(p, width + 1), pa.int32()), pa.array(np.repeat(e, width + 1), pa.int32()),
             pa.array(place, pa.int32()), pa.array(sums[p, e].ravel(), pa.int64())],
            names=["part", "entry", "place", "total"])

    totals = (vectors.mapInArrow(run, "part int, entry int, place int, total long")
              .groupBy("part", "entry", "place").agg(F.sum("total").alias("total")))
    sums = np.zeros((parts, entries, width + 1), np.int64)
    for r in totals.collect():                      # parts x entries x (width + 1) numbers at most
        sums[r["part"], r["entry"], r["place"]] = r["total"]
    counts = sums[:, :, width:]
    return Codebooks(np.where(counts > 0, sums[:, :, :width] // np.maximum(counts, 1), table))


def encode(vectors: DataFrame, books: Codebooks, length: int) -> DataFrame:
    """``vec_id, label, codes, error``: entry numbers in the order of the parts."""
    table = books.entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Orchard(b) for b in table]
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, errors = _assign(searches, _matrix(batch, length, books.parts))
            offsets = np.arange(0, codes.size + 1, books.parts, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel(), pa.int32())),
                 pa.array(errors.sum(1), pa.int64())], names=["vec_id", "label", "codes", "error"])

    return vectors.mapInArrow(run, "vec_id long, label string, codes array<int>, error long")


def decode(coded: DataFrame, books: Codebooks, length: int, scale: int = SCALE) -> DataFrame:
    """Adds ``approx``: the entries' components, back on the vectors' scale."""
    table = books.entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(table))
            near = np.concatenate([table[p, codes[:, p]] for p in range(len(table))], axis=1)[:, :length] / scale
            offsets = np.arange(0, near.size + 1, max(length, 1), dtype=np.int32)[:batch.num_rows + 1]
            if not length:
                offsets = np.zeros(batch.num_rows + 1, np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(near.ravel()))],
                names=[*batch.schema.names, "approx"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)
    return coded.mapInArrow(run, f"{columns}, approx array<double>")


def fit(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
        scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
        label_col: str | None = "label") -> tuple[DataFrame, Codebooks | None, int]:
    """The kept vectors, their codebooks over all rows, and the vectors' length;
    no codebooks for an empty table."""
    vectors = whole_vectors(df, id_col, vector_col, label_col, scale)
    found = first_codebooks(vectors, parts, entries)
    if found is None:
        return vectors, None, 0
    books, length = found
    vectors = vectors.where(F.size("v") == length)
    for _ in range(rounds):
        books = next_codebooks(vectors, books, length)
    return vectors, books, length


def compress(df: DataFrame, **options) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept row."""
    vectors, books, length = fit(df, **options)
    if books is None:
        return (vectors.where("false").selectExpr(
            "vec_id", "'' AS code", "0L AS error", "0L AS label_error", "'' AS codebooks_sha256"))
    coded = staged(encode(vectors, books, length), "codebooks-codes")
    # Small against the rows or not, Spark's size check and skew handling apply:
    # the codes are a file, and the labels' sums are combined before the shuffle.
    sums = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error"))
                  .withColumnRenamed("label", "of"), "codebooks-labels")
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
            .selectExpr("vec_id", "array_join(transform(codes, c -> lower(lpad(hex(c), 2, '0'))), '') AS code",
                        "error", "label_error", f"'{books.sha256()}' AS codebooks_sha256"))


def op12_orchard_codes(spark, sf_dir: str) -> DataFrame:
    return compress(read_table(spark, sf_dir, "embeddings"))


def _op12_sql() -> str:
    """The same in DuckDB: every part against every entry."""
    apart = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(p.x, b.x)])"
    ctes = [f"""vectors AS MATERIALIZED (SELECT vec_id, label, row_number() OVER () AS r,
  [floor(c::DOUBLE * {SCALE})::BIGINT for c in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0)""",
            f"""parts AS MATERIALIZED (SELECT r, vec_id, part,
  v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] AS x
  FROM vectors, range({PARTS}) t(part))""",
            f"""books0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id, x) - 1 AS entry, x
  FROM parts WHERE r IN (SELECT r FROM vectors ORDER BY vec_id, v LIMIT {ENTRIES}))"""]
    for i in range(ROUNDS + 1):
        ctes.append(f"""near{i} AS MATERIALIZED (SELECT r, part, any_value(p.x) AS x, min(({apart}, entry)) AS m
  FROM parts p JOIN books{i} b USING (part) GROUP BY r, part)""")
        if i < ROUNDS:
            ctes.append(f"""books{i + 1} AS MATERIALIZED (
  WITH means AS (SELECT part, entry, list(mean ORDER BY place) AS x FROM (
    SELECT part, m[2] AS entry, place, floor(sum(x[place])::DOUBLE / count(*))::BIGINT AS mean
    FROM near{i}, range(1, 1 + (SELECT max(len(x)) FROM parts)) t(place) GROUP BY ALL) GROUP BY ALL)
  SELECT part, entry, coalesce(n.x, b.x) AS x FROM books{i} b LEFT JOIN means n USING (part, entry))""")
    return "WITH " + ",\n".join(ctes) + f""",
coded AS (SELECT vec_id, label, code, error FROM vectors JOIN (
  SELECT r, string_agg(printf('%02x', m[2]), '' ORDER BY part) AS code, sum(m[1])::BIGINT AS error
  FROM near{ROUNDS} GROUP BY r) USING (r))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM books{ROUNDS}) AS codebooks_sha256
FROM coded"""


OP12_SQL = _op12_sql()
