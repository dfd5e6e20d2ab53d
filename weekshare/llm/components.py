"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

ROWS_PER_TASK = 500_000     # of an edge table when it is written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> ``(node, label)``: one label per component.

    Each round maps every node to the smallest node within two steps along
    smallest neighbours, renames the edges by that map and drops the loops, so
    chains shrink geometrically and stars vanish at once. Rounds are written to
    the shared folder, by as many tasks as the edges left need. The map is a
    partial aggregate, so a node with very many edges is one row per task; the
    renaming joins are left to Spark's skew handling.
    """
    edges = staged(edges.where("a != b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b")
                   .distinct(), "cc-edges")
    left = edges.count()
    width = tasks = 1 + left // ROWS_PER_TASK
    labels = (edges.selectExpr("inline(array(struct(a AS node), struct(b AS node)))")
              .distinct().withColumn("label", F.col("node")))
    labels = staged(labels.coalesce(width), "cc-labels")
    while left:
        both = edges.selectExpr("inline(array(struct(a AS u, b AS v), struct(b AS u, a AS v)))")
        step = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        lower = (step.join(step.selectExpr("u AS m", "m AS mm"), "m").selectExpr("u", "mm AS m"))
        lower = staged(lower.coalesce(tasks), "cc-map")
        edges = (edges.join(lower.selectExpr("u AS a", "m AS x"), "a")
                 .join(lower.selectExpr("u AS b", "m AS y"), "b").where("x != y")
                 .selectExpr("least(x, y) AS a", "greatest(x, y) AS b").distinct())
        edges = staged(edges.coalesce(tasks), "cc-edges")
        labels = staged(labels.join(lower.selectExpr("u AS label", "m"), "label", "left")
                        .selectExpr("node", "coalesce(m, label) AS label").coalesce(width), "cc-labels")
        left = edges.count()
        tasks = 1 + left // ROWS_PER_TASK
    return labels
