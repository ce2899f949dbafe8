"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagwright.session import write_shared


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (a, b): ``label`` is the smallest
    node reachable from it.

    Each round sends a node to its smallest neighbour, jumps one pointer further,
    and contracts the edges onto the nodes reached; edges inside a node fall away.
    Smallest neighbours combine on the map side, and a hub's edges meet unique
    rows in joins that can be split. Rounds are as the logarithm of the longest
    path; each is written to the shared folder, so nothing is recomputed when an
    executor is lost. The driver sees only whether edges are left. Edges with a
    null end are left out.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = write_shared(
        edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(larger.alias("a"), smaller.alias("b"))
        .distinct()
    )
    both_ends = edges.select(F.col("a").alias("node")).union(edges.select("b"))
    labels = both_ends.distinct().withColumn("label", F.col("node"))
    while not edges.isEmpty():
        ends = edges.union(edges.select("b", "a"))
        parent = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        parent = parent.select("node", F.least("node", "least").alias("up"))
        further = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        parent = write_shared(parent.join(further, "up").select("node", "top"))
        top_of = {
            end: parent.select(F.col("node").alias(end), F.col("top").alias(f"top_{end}")) for end in ("a", "b", "label")
        }
        labels = write_shared(
            labels.join(top_of["label"], "label", "left").select(
                "node", F.coalesce("top_label", "label").alias("label")
            )
        )
        edges = write_shared(
            edges.join(top_of["a"], "a")
            .join(top_of["b"], "b")
            .filter(F.col("top_a") != F.col("top_b"))
            .select(F.greatest("top_a", "top_b").alias("a"), F.least("top_a", "top_b").alias("b"))
            .distinct()
        )
    return labels
