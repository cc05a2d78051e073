"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.tables import written


def components(edges: DataFrame, label: str = "graph") -> DataFrame:
    """(v, root) of every vertex in ``edges`` (a, b); the root is one vertex of its component.

    Each round every vertex moves to its smallest neighbour if that is smaller, and the edges
    are rewritten. With vertices that are hashes the graph shrinks by a constant factor a
    round. Rounds are written, and their moves are put together backwards at the end. Hot
    vertices cost nothing special: the minimum combines in the map tasks and the joins are
    inner equi-joins that adaptive execution can split. No edges give no rows; loops count as
    vertices of their own.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    current = written(both.distinct(), f"{label}-edges")
    moves: list[DataFrame] = []
    while True:
        nearest = current.groupBy("a").agg(F.min("b").alias("m"))
        move = nearest.select(F.col("a").alias("v"), F.least("a", "m").alias("root"))
        moves.append(written(move, f"{label}-moves"))
        left = moves[-1].select(F.col("v").alias("a"), F.col("root").alias("ra"))
        right = moves[-1].select(F.col("v").alias("b"), F.col("root").alias("rb"))
        joined = current.filter("a <> b").join(left, "a").join(right, "b")
        nxt = joined.select(F.col("ra").alias("a"), F.col("rb").alias("b")).filter("a <> b")
        current = written(nxt.distinct(), f"{label}-edges")
        if current.isEmpty():
            break
    result = moves.pop()
    for move in reversed(moves):
        later = result.select(F.col("v").alias("root"), F.col("root").alias("end"))
        result = move.join(later, "root", "left").select("v", F.coalesce("end", "root").alias("root"))
    return result
