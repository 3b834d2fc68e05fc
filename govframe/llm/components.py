"""Connected components of a link table, as repeated joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.llm.common import compact, cut_lineage

#: Label tables up to this number of rows (two numbers each) are broadcast; larger ones meet the links in shuffled joins.
BROADCAST_ROWS = 100_000


def components(spark: SparkSession, links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, comp): the smallest node that each node of ``links`` (a, b) reaches.

    Each round lowers a node's label, and its label's label, to the smallest label among its
    neighbours, then lets labels jump to their own labels; the number of rounds is about the
    logarithm of a component's width.  With ``rounds`` it stops early: nodes with equal labels are
    connected then, but connected nodes may have different ones.  Minima are pre-aggregated before
    each shuffle, so a node with very many links costs a row per task.
    """
    links = compact(cut_lineage(spark, links.select("a", "b")))
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    label = cut_lineage(spark, edges.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("comp")))
    last, nodes = _total(label)
    done = 0
    while nodes and done != rounds:
        label = cut_lineage(spark, _lowered(spark, edges, compact(label), nodes <= BROADCAST_ROWS))
        now, _ = _total(label)  # labels only fall
        if now == last:
            break
        last, done = now, done + 1
    return label


def _total(label: DataFrame) -> tuple:
    return tuple(label.agg(F.sum(F.col("comp").cast("decimal(38,0)")), F.count("*")).first())


def _lowered(spark: SparkSession, edges: DataFrame, label: DataFrame, small: bool) -> DataFrame:
    side = F.broadcast if small else lambda df: df
    of = lambda n, c: side(label.select(F.col("node").alias(n), F.col("comp").alias(c)))
    near = edges.join(of("v", "cv"), "v").join(of("u", "cu"), "u")
    lower = near.select(F.col("u").alias("node"), F.col("cv").alias("comp")).union(near.select("cu", "cv")).union(label).groupBy("node").agg(F.min("comp").alias("comp"))
    if not small:  # written first: beside its aggregate in one stage, Spark could not split a component with a third of the nodes
        lower = cut_lineage(spark, lower)
    up = lower.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
    return lower.join(side(up), "comp").select("node", F.col("top").alias("comp"))
