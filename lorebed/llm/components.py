"""Connected components of links, by contracting each node to a neighbour until no link is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .job import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (columns a and b); nodes of one component share a root, which is one of them.

    In each round every node moves to the one of itself and its neighbours that comes first in an order of the round's own, so that
    the number of nodes shrinks by a share whatever the shape; the rounds' moves are then followed from the first on. Each round is a few joins
    of nodes that still have links, and is written to the shared folder.
    """
    moves: list[DataFrame] = []
    edges = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(moves))).alias("h"), F.col(c).alias("v"))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("other"))
        move = stored(best.select(F.col("a").alias("node"), F.least(rank("a"), F.col("other"))["v"].alias("to")))
        moves.append(move)
        left = edges.join(move.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        left = left.join(move.select(F.col("node").alias("b"), F.col("to").alias("y")), "b").where("x <> y")
        contracted = stored(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        discard(edges)
        edges = contracted
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = moves[0].select("node", F.col("to").alias("root"))
    for move in moves[1:]:
        out = out.join(move.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    out = stored(out)
    discard(edges, *moves)
    return out
