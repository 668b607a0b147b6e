"""Connected components over edge lists (U12, U13, U14) without collecting the graph.

Every round each node moves to the neighbour, or itself, whose hashed name is least; edges follow their ends and
are made distinct. Hashed order contracts long chains as fast as stars, so that rounds grow with the logarithm of
the size. The moves of all rounds, joined one after another, lead each node to its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.storage import discard, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an edge; component is the least node of its component.

    Loops give a node alone; repeated and reversed edges count once; null ends are ignored; without edges the
    result is empty.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    now = materialize(both.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "graph-edges")
    moves: list[DataFrame] = []
    while True:
        ends = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ends.groupBy("u").agg(F.min(F.struct(F.xxhash64("v").alias("h"), F.col("v").alias("node"))).alias("best"))
        own = F.struct(F.xxhash64("u").alias("h"), F.col("u").alias("node"))
        move = materialize(least.select("u", F.least(own, F.col("best"))["node"].alias("to")), "graph-moves")
        moves.append(move)
        left = move.select(F.col("u"), F.col("to").alias("p"))
        right = move.select(F.col("u").alias("v"), F.col("to").alias("q"))
        after = now.join(left, "u").join(right, "v").where("p <> q").select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v")).distinct()
        after = materialize(after, "graph-edges")
        discard(now)
        now = after
        if now.isEmpty():
            break
    out = moves[0].select(F.col("u").alias("node"), F.col("to").alias("root"))
    for move in moves[1:]:
        step = move.select(F.col("u").alias("root"), "to")
        out = out.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    names = out.groupBy("root").agg(F.min("node").alias("component"))
    return out.join(names, "root").select("node", "component")
