"""Helpers shared by the operators: staged tables, bounded batches, numbering."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir

# Text bytes a task handles at a time; a longer single text is its own batch.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage in a way that survives lost executors, fixes values such
    as generated ids, and gives the optimizer a file size to plan with.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(batches: Iterable[pa.RecordBatch], text: str = "text",
                 limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``limit`` text bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        yield batch.slice(start)


def plain_texts(column: pa.Array) -> pa.Array:
    """The text column with nulls as empty strings and 64-bit offsets."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def buckets_of(spark: SparkSession) -> int:
    """Sub-groups for numbering; follows the cluster's shuffle setting."""
    return max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def offsets_before(sums: DataFrame, groups: list[str], bucket: str, value: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over smaller buckets of the group.

    ``sums`` has one row per group and bucket, so the window is bounded by
    the number of buckets, never by the data.
    """
    w = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    w = w.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("before", F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long"))


def number_rows(df: DataFrame, groups: list[str], key: str, out: str) -> DataFrame:
    """Gapless numbers from 0 within each group, without one task per group.

    Rows of a group are dealt to buckets by a hash of the unique ``key``;
    each bucket is numbered on its own and starts where the smaller buckets
    end. ``df`` is read twice, so it must be a staged table.
    """
    n = buckets_of(df.sparkSession)
    df = df.withColumn("_b", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
    sums = offsets_before(df.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_n")),
                          groups, "_b", "_n").drop("_n")
    # By bucket too: else the join would deal the rows by group alone.
    sums = sums.repartition(*groups, "_b")
    w = Window.partitionBy(*groups, "_b").orderBy(key)
    return (df.withColumn("_i", F.row_number().over(w) - 1)
            .join(sums, [*groups, "_b"])
            .withColumn(out, F.col("before") + F.col("_i"))
            .drop("_b", "_i", "before"))
