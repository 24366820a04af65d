"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is two grouped minima and one join; the edges of a round are a table in the shared folder, so a
round can be redone from the one before it. The number of rounds grows with the logarithm of a component's
size. A node with very many edges is split by AQE (``spread_join``), and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pistespark.shared import dropped, spread_join, written


def _canonical(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    low = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("low"))
    return _canonical(spread_join(both, low, ["x"]).filter("y > x"), "y", "low")


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    far = spread_join(edges, low, ["u"]).select(F.col("v").alias("a"), "low")
    return _canonical(far.unionByName(low.select(F.col("u").alias("a"), "low")), "a", "low")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge to another; root is the least node of its component."""
    now = written(_canonical(edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()), a, b), "edges")
    state = _state(now)
    while state[0]:
        after = written(_small_star(_large_star(now)), "edges")
        new = _state(after)
        dropped(now)
        now, same, state = after, new == state, new
        if same:
            break
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
