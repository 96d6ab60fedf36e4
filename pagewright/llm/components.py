"""Connected components of an edge table by alternating large-star and small-star rounds, all as joins of written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import store


#: Edges to a file of the tables between rounds, if that makes more files than twice the cluster's cores.
FILE_EDGES = 250_000


def _large_star(edges: DataFrame, files: int) -> DataFrame:
    both = store(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "star_both", files=files)
    least = store(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star_least", files=files)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, files: int) -> DataFrame:
    least = store(edges.groupBy("u").agg(F.min("v").alias("m")), "star_least", files=files)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(edges: DataFrame, left: str = "a", right: str = "b", most_rounds: int = 60) -> DataFrame:
    """node, root for every node of an edge: root is the component's smallest node. Loops and repeated edges do no harm.

    Rounds are logarithmic in a component's size. Nodes are longs; rows with a null node are no edges.
    """
    edges = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where(f"{left} is not null and {right} is not null and u <> v").distinct()
    edges = store(edges, "star_edges")
    print_of = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen = print_of(edges)
    # No round makes more edges than there are, so their number fixes that of the files.
    files = max(2 * edges.sparkSession.sparkContext.defaultParallelism, -(-seen[0] // FILE_EDGES))
    for _ in range(most_rounds):
        edges = store(_small_star(store(_large_star(edges, files), "star_large", files=files), files), "star_small", files=files)
        now = print_of(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
