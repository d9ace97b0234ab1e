"""Connected components of an edge list by alternating stars."""

from pyspark.sql import DataFrame, functions as F

from caseflow.llm.common import hot_keys, spread_join, store


def _least(edges):
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))


def _with_least(edges):
    least = store(_least(edges))
    return spread_join(edges, least.select("u", "m"), "u", hot_keys(least, "u", "n")), least


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of its component, for every node with an edge; ``edges`` has u and v.

    Every step hangs neighbours on the least of them (larger ones, then smaller ones) until nothing changes; paths
    halve at each step, a node with many edges is spread over tasks, and all steps are stored.
    """
    edges = store(edges.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u"))
                  .filter("u <> v").distinct())
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or state["n"] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined, _ = _with_least(both)
        # Larger neighbours hang on the least neighbour, or on the node itself if that is less.
        large = store(joined.withColumn("m", F.least("u", "m")).filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        joined, least = _with_least(large)
        edges = store(
            joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
