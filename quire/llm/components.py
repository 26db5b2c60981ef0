"""Connected components of a link table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import staged


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): every linked node with the smallest node of its component.

    Each round links every node's neighbours to its smallest neighbour, first for larger neighbours, then
    for smaller ones (alternating large and small stars); the number of links never grows and the rounds
    are logarithmic in practice. Every round is a written table, so a lost executor repeats one round only. A hub with very many
    neighbours costs a partial minimum and a join that adaptive execution splits, never one task."""
    edges = staged(links.where("a != b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
                   .distinct(), "links")
    for _ in range(max_rounds):
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("m").alias("u"), F.col("y").alias("v"))
        large = large.where("u != v").distinct()
        # after the large star every link (u, v) has u < v; the small star joins v's smaller neighbours
        floor = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(floor, "v").select(F.col("m").alias("p"), F.col("u").alias("q")) \
            .union(floor.select("m", "v")).where("p != q")
        after = staged(small.distinct().select(F.col("p").alias("u"), F.col("q").alias("v")), "links")
        # done when every node has one link, to a node that is itself nobody's larger end
        done = after.groupBy("v").count().where("count > 1").isEmpty() and \
            after.join(after.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()
        edges = after
        if done:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root")) \
                .union(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
