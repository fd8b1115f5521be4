"""Components of a table of links, and clusters that keep what conflicts apart."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard, stored


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b): the root is the component's smallest node.

    Each round joins every node to the first of itself and its neighbours, in an order by hash that is new in each round, and keeps the links between
    what is left; so the number of nodes shrinks by a share whatever the shape, a long chain too. The moves are then followed round by round.
    """
    edges = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    place = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    number = 0
    while not edges.isEmpty():
        ranked = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(number)).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        ends = edges.select(ranked("a").alias("x"), ranked("b").alias("y"))
        moves = ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y"))).groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("to"))
        moves = stored(moves.select(F.col("x.v").alias("from"), F.col("to.v").alias("to")))
        moved = stored(place.join(moves, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root")))
        left = edges
        for side in ("a", "b"):
            left = left.join(moves, F.col(side) == F.col("from")).drop(side, "from").withColumnRenamed("to", side)
        left = stored(left.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        discard(edges, moves, place)
        edges, place = left, moved
        number += 1
    least = place.groupBy("root").agg(F.min("node").alias("least"))
    return place.join(least, "root").select("node", F.col("least").alias("root"))


#: A component of so many links is clustered in one task; a larger one in rounds of joins.
MOST_LINKS = 20_000


def agglomerated(links: DataFrame, marks: DataFrame, most_links: int = MOST_LINKS) -> DataFrame:
    """(node, root) of every node in links (a, b, score) when links are taken one by one, the best score first, and unite two clusters unless these have marks that differ.

    ``marks`` (node, mark) has the mark of each node at most once; a cluster's mark is that of any of its nodes, as all that have one agree. Of links with equal
    scores the one with the smaller md5 of both names, with the character 1 between, comes first. The root is the cluster's smallest node.

    What doesn't conflict anywhere is a component like any other. A component that does is one task's work if it has ``most_links`` or fewer; larger ones
    go through rounds, each of which takes every link that is the best for both of its clusters: neither of them would find a better one before, so
    the result is that of taking them one by one. A link between clusters that conflict is dropped for good. A round costs two aggregates and joins of the links left.
    """
    found = connected(links.select("a", "b"))
    sizes = links.where("a <> b").join(found, F.col("a") == F.col("node")).groupBy("root").agg(F.count("*").alias("links"))
    marked = found.join(marks.where("mark IS NOT NULL"), "node", "left").groupBy("root").agg((F.min("mark") < F.max("mark")).alias("torn"))
    of = marked.join(sizes, "root").select("root", F.when(~F.coalesce("torn", F.lit(False)), "whole").when(F.col("links") <= most_links, "task").otherwise("rounds").alias("way"))
    found = stored(found.join(of, "root"))
    out = found.where("way = 'whole'").select("node", "root")
    order = F.struct((-F.col("score")).alias("s"), F.md5(F.concat("a", F.lit("\x01"), "b")).alias("h"), F.col("a").alias("m"), F.col("b").alias("n"))
    # Both ends are in one component, so one of them tells.
    torn = links.where("a <> b").withColumn("order", order).join(found.where("way <> 'whole'").withColumnRenamed("node", "a"), "a")
    in_task = torn.where("way = 'task'")
    for side in ("a", "b"):
        in_task = in_task.join(marks.select(F.col("node").alias(side), F.col("mark").alias(f"mark_{side}")), side, "left")
    kind = links.schema["a"].dataType.simpleString()
    grouped = in_task.select("root", "a", "b", "mark_a", "mark_b", "order.s", "order.h").groupBy("root").applyInPandas(_one_by_one, f"node {kind}, root {kind}")
    out = out.unionByName(grouped)
    if found.where("way = 'rounds'").isEmpty():
        return out
    place = found.where("way = 'rounds'").select("node").join(marks, "node", "left").select("node", F.col("node").alias("root"), "mark")
    return out.unionByName(_in_rounds(torn.where("way = 'rounds'").select(F.col("a").alias("x"), F.col("b").alias("y"), "order"), stored(place)))


def _one_by_one(links: pd.DataFrame) -> pd.DataFrame:
    """One component, link by link."""
    root: dict = {}
    mark: dict = {}
    for side in ("a", "b"):
        for node, own in zip(links[side], links[f"mark_{side}"]):
            root[node], mark[node] = node, own if isinstance(own, str) else None

    def top(node):
        while root[node] != node:
            root[node] = node = root[root[node]]
        return node

    for a, b in links.sort_values(["s", "h", "a", "b"])[["a", "b"]].itertuples(index=False):
        x, y = sorted((top(a), top(b)))
        if x != y and (mark[x] is None or mark[y] is None or mark[x] == mark[y]):
            root[y], mark[x] = x, mark[x] if mark[x] is not None else mark[y]
    return pd.DataFrame({"node": list(root), "root": [top(n) for n in root]})


def _in_rounds(edges: DataFrame, place: DataFrame) -> DataFrame:
    """(node, root) of the nodes of ``place`` (node, root, mark; every node its own root at first) by their links (x, y, order)."""
    edges = _admissible(edges, place)
    while not edges.isEmpty():
        ends = edges.select(F.explode(F.array("x", "y")).alias("x"), "order").groupBy("x").agg(F.min("order").alias("order"))
        chosen = ends.groupBy("order").agg(F.count("*").alias("ends"), F.min("x").alias("to"), F.max("x").alias("from")).where("ends = 2")
        chosen = stored(chosen.select("from", "to"))
        united = place.join(chosen, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root"), "mark")
        united = stored(united.drop("mark").join(united.groupBy("root").agg(F.max("mark").alias("mark")), "root"))
        left = edges
        for side in ("x", "y"):
            left = left.join(chosen, F.col(side) == F.col("from"), "left").withColumn(side, F.coalesce("to", side)).drop("from", "to")
        left = _admissible(left, united)
        discard(edges, place, chosen)
        edges, place = left, united
    heads = place.groupBy("root").agg(F.min("node").alias("least"))
    return place.join(heads, "root").select("node", F.col("least").alias("root"))


def _admissible(edges: DataFrame, place: DataFrame) -> DataFrame:
    """The best link (x, y, order) of every two different clusters whose marks don't differ, stored."""
    clusters = place.groupBy("root").agg(F.max("mark").alias("mark"))
    for side in ("x", "y"):
        edges = edges.join(clusters.select(F.col("root").alias(side), F.col("mark").alias(f"mark_{side}")), side)
    fine = (F.col("x") != F.col("y")) & ~F.coalesce(F.col("mark_x") != F.col("mark_y"), F.lit(False))
    ends = edges.where(fine).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "order")
    return stored(ends.groupBy("x", "y").agg(F.min("order").alias("order")))
