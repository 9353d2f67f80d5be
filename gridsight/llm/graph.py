"""Connected components of a table of links."""

from pyspark.sql import DataFrame, functions as F

from .shared import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node it reaches) for every linked node.

    Alternating star contraction: every node hands its neighbours to the smallest of them until
    all nodes hang on their component's smallest.  The rounds grow with the logarithm of the
    longest path; every round is written, so a lost executor repeats one round at most.
    """
    one, two = F.col(a), F.col(b)
    edges = stored(links.select(F.greatest(one, two).alias("a"), F.least(one, two).alias("b")).where("a <> b").distinct(), "links")
    before = _state(edges)
    while True:
        # large star: the bigger neighbours of u go to the smallest of u and its neighbours
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        small = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = large.join(small, F.col("a") == F.col("u")).select(F.explode(F.array(
            F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y"))
        )).alias("e")).select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a <> b").distinct()
        edges = stored(moved, "links")
        after = _state(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = after
