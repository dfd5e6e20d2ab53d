"""Builders for small hand-written inputs."""

from __future__ import annotations

import math

from weekshare.sources.schema import BASE_COLUMNS, EXPORT_SCHEMA

DEFAULTS = dict(Year=2026, Semana=10, RegionOrigenAWB="Europe", RegionOrigenSegmento="Europe",
                ZonaOrigenAWB="EU_DE", PaisOrigenAWB="ALEMANIA", PaisOrigenSegmento="ALEMANIA",
                PaisDestinoAWB="PERU", PostaDestinoAWB="LIM", TipoVuelo="PAX", Owner="LA ",
                Tons=1.0)


def export_df(spark, rows):
    """Export rows from dicts overriding ``DEFAULTS``."""
    data = []
    for r in rows:
        d = dict(DEFAULTS, **r)
        data.append(tuple(d[c] for c in BASE_COLUMNS[:-1]))
    return spark.createDataFrame(data, EXPORT_SCHEMA)


def rows_by(df, *keys):
    """Rows as dicts keyed by one column (scalar key) or several (tuple)."""
    if len(keys) == 1:
        return {r[keys[0]]: r.asDict() for r in df.collect()}
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def same(a, b, tol=1e-12):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) and isinstance(b, float):
        if math.isnan(a) or math.isnan(b):
            return math.isnan(a) and math.isnan(b)
        if math.isinf(a) or math.isinf(b):
            return a == b
        return abs(a - b) <= tol * max(1.0, abs(a), abs(b))
    return a == b


def three_branch(bucketed, part, weeks=5):
    """The report's three branches as a literal append (U1), to check the
    single-pass form: named competitors, the bucket and the home carrier."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from weekshare.operators.topn import BUCKET, HOME, NAMED
    from weekshare.sources.schema import week_columns
    sums = [F.sum(c).alias(c) for c in week_columns(weeks)]
    keys = [*part, "OwnerGrpd"]

    def branch(cls):
        return bucketed.where(F.col("cls") == cls).groupBy(*keys).agg(*sums)

    order = Window.partitionBy(*part).orderBy(F.col("W").desc_nulls_last(), F.col("OwnerGrpd").asc())
    named = branch(NAMED).withColumn("Rank", F.row_number().over(order).cast("long"))
    bucket = branch(BUCKET).withColumn("Rank", F.lit(BUCKET).cast("long"))
    home = branch(HOME).withColumn("Rank", F.lit(HOME).cast("long"))
    return named.unionByName(bucket).unionByName(home)
