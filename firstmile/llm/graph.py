"""Connected components of an undirected graph given as edges, as a series of shuffles.

Large-star and small-star steps in turn: every node is linked to the smallest
node it knows, until nothing changes. Each round's edges are a written table, so
neither the driver nor one task ever holds links or components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firstmile.llm import store


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v) to (u, v, least of u and its v's).

    Minima are combined before their shuffle and written, so that the join has
    plain shuffles below it and adaptive execution can split a hot u.
    """
    least = store.land(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")
    return pairs.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    known = _least(down)
    joined = known.select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
    return joined.union(known.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for each node that has an edge and is not itself its component's smallest.

    `edges` has columns u and v of an orderable type. Loops and repeated edges are
    allowed, NULL ends are not. An empty table gives an empty table.
    """
    now = store.land(edges.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "edges")
    before = _state(now)
    for _ in range(rounds if before[0] else 0):
        large = store.land(_large_star(now).distinct(), "edges")
        after = store.land(_small_star(large).distinct(), "edges")
        state = _state(after)
        store.drop(now)
        store.drop(large)
        now = after
        if state == before:
            break
        before = state
    else:
        if before[0]:
            raise RuntimeError(f"components still change after {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]
