"""Connected components of a graph given by its edges."""

from pyspark.sql import DataFrame, functions as F

from pageflow.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node it is connected with.

    Each round ties all neighbours of a node to the smallest of them, larger ones first and then smaller ones. Rounds
    grow with the logarithm of the longest path, and no round holds more edges than the last. Minima are combined
    before their shuffle; no node's neighbours are gathered.
    """
    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    while True:
        found = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("all")).first()
        if found == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = found
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        now = saved(tied.union(own).where("a <> b").distinct(), "edges")
