"""Connected components of a graph of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse.session import scratch_dir


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every node in ``a``, ``b``.

    Each round every node points to the least of itself and its neighbours, the graph
    is contracted along these pointers, and the roots found so far follow them. Node
    names are hashes, so a round keeps about half of the nodes of a chain, and a star
    is done in three. Rounds cut their lineage by tables in the shared folder; the
    driver sees only whether links are left.
    """
    folder = scratch_dir(links.sparkSession)
    edges = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    edges = _stored(edges.toDF("a", "b"), f"{folder}/edges0")
    roots = None
    turn = 0
    while not edges.isEmpty():
        turn += 1
        parents = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("parent"))
        parents = _stored(parents, f"{folder}/parents{turn}")
        if roots is None:
            roots = parents.select(F.col("a").alias("node"), F.col("parent").alias("root"))
        else:
            roots = roots.join(parents, roots["root"] == parents["a"], "left").select(
                "node", F.coalesce("parent", "root").alias("root")
            )
        roots = _stored(roots, f"{folder}/roots{turn}")
        left = edges.join(parents, "a").select(F.col("parent").alias("_a"), "b")
        ends = parents.select(F.col("a").alias("b"), F.col("parent").alias("_b"))
        contracted = left.join(ends, "b").where("_a <> _b").select("_a", "_b").distinct()
        edges = _stored(contracted.toDF("a", "b"), f"{folder}/edges{turn}")
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return roots
