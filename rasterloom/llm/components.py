"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rasterloom.llm.tables import shuffled, spread_join, stored


def components(edges):
    """(node, component) of each node with an edge; a component's name is its least node.

    ``edges`` has long columns a and b. Rounds of large-star and small-star steps: each node's larger
    neighbours, then its smaller ones, are hung on its least neighbour until nothing moves. The least
    neighbour is a minimum combined before the shuffle and joined back, so no node's neighbours are
    ever gathered in one place. Each round is stored, which also cuts the lineage.
    """
    e = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    while True:
        # Done when the edges are stars: each node hangs on one other, and none that others hang on hangs itself.
        n = e.agg(F.count(F.lit(1)), F.count_distinct("hi")).first()
        if n[0] == n[1] and e.join(shuffled(e.select(F.col("lo").alias("hi"))), "hi", "left_semi").isEmpty():
            break
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("lo"), F.least("u", "m").alias("m"))
        large = spread_join(e, shuffled(least), ["lo"]).select("hi", F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = spread_join(large, shuffled(least), ["hi"]).select(F.explode(F.array(
            F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("x"))
        e = stored(small.select("x.*").filter("hi <> lo").distinct(), "edges")
    root = e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(root)
