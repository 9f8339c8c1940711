"""Labels from neighbours and ancestors, heights, bounded growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators import graph as G
from strandloom.runtime import Scratch


def neighbour_vote(near: DataFrame, labels: DataFrame, floor: float = 0.6, neighbours: int = 10, least: int = 3, keep: int = 3) -> DataFrame:
    """``id, label, weight, rank``: labels that the nearest neighbours of a row agree on.

    ``near``: ``id, other, cosine``; ``labels``: ``other, label``. The first
    ``neighbours`` at or above ``floor`` vote with their cosine; a row with
    fewer than ``least`` of them gets none. A label needs a weight of ``least``
    times the floor; the ``keep`` heaviest stay. Labels are those before the
    vote, so the result does not depend on an order of rows.
    """
    order = Window.partitionBy("id").orderBy(F.desc("cosine"), "other")
    top = near.where(F.col("cosine") >= floor).withColumn("k", F.row_number().over(order)).where(F.col("k") <= neighbours)
    enough = top.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("id")
    votes = top.join(enough, "id", "left_semi").join(labels.where("label is not null").distinct(), "other").groupBy("id", "label").agg(F.sum("cosine").alias("weight")).where(F.col("weight") >= least * floor)
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("weight"), "label"))
    return votes.withColumn("rank", rank).where(F.col("rank") <= keep)


def ancestor_labels(edges: DataFrame, depth: int, cap: int = 6) -> DataFrame:
    """``id, labels``: the first ``cap`` ancestors within ``depth`` steps, nearest first, then by name."""
    near = G.bounded_ancestors(edges, depth).where("dep <> anc")
    first = F.row_number().over(Window.partitionBy("dep").orderBy("depth", "anc"))
    some = near.withColumn("k", first).where(F.col("k") <= cap)
    return some.groupBy(F.col("dep").alias("id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "anc"))), lambda x: x["anc"]).alias("labels"))


def added_topics(skills: DataFrame, ancestors: DataFrame, most: int = 3, total: int = 5) -> DataFrame:
    """``id, topics``: topics of a skill with up to ``most`` of its ancestors' that share a word with it, ``total`` in all.

    ``skills``: ``id, topics`` (array); ``ancestors``: ``id, labels`` of ids and
    of topics. Candidates come from the id first, then from the topics in order.
    """
    words = lambda c: F.filter(F.split(c, "-"), lambda w: F.length(w) >= 3)
    sources = skills.select("id", "topics", F.posexplode(F.concat(F.array("id"), "topics")).alias("p", "from"))
    cand = sources.join(ancestors.select(F.col("id").alias("from"), "labels"), "from").select("id", "p", F.posexplode("labels").alias("q", "label"))
    own = skills.select("id", "topics", F.flatten(F.transform(F.concat(F.array("id"), "topics"), words)).alias("own"))
    new = cand.join(own, "id").where(~F.array_contains("topics", F.col("label")) & F.arrays_overlap("own", words(F.col("label"))))
    best = new.groupBy("id", "label").agg(F.min(F.struct("p", "q")).alias("at")).withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy("at", "label"))).where(F.col("k") <= most)
    extra = best.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "label"))), lambda x: x["label"]).alias("extra"))
    return skills.join(extra, "id", "left").select("id", F.slice(F.concat("topics", F.coalesce("extra", F.array().cast("array<string>"))), 1, total).alias("topics"))


def heights(edges: DataFrame) -> DataFrame:
    """``id, longest, shortest``: steps from a node down to nodes without prerequisites, along the longest and the shortest way."""
    scratch = Scratch(edges.sparkSession, "heights")
    e = scratch.save(G.clean_edges(edges), "edges")
    longest = G.topo_levels(e, scratch=scratch).withColumnRenamed("level", "longest")
    frontier = scratch.save(e.select(F.col("pre").alias("id")).distinct().join(e.select(F.col("dep").alias("id")), "id", "left_anti").withColumn("shortest", F.lit(0)), "ground")
    seen = frontier
    while True:
        step = e.join(frontier.select(F.col("id").alias("pre"), "shortest"), "pre").groupBy(F.col("dep").alias("id")).agg((F.min("shortest") + 1).cast("int").alias("shortest"))
        fresh = scratch.save(step.join(seen, "id", "left_anti"), "frontier")
        if fresh.isEmpty():
            break
        seen = scratch.save(seen.union(fresh), "seen")
        frontier = fresh
    return longest.join(seen, "id")


def grow(roots: DataFrame, offers: DataFrame, depth: int = 30, most: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """A tree grown downwards: ``id, parent, depth`` and the rejected offers ``id, parent, reason``.

    ``roots``: ``id``; ``offers``: ``id, parent``. Level by level a node takes
    the smallest parent that offers it; an offer of a node that is there already
    is ``known``, of itself ``self``. Growth stops at ``depth`` or before more
    than ``most`` nodes; what is left over is ``limit``.
    """
    scratch = Scratch(roots.sparkSession, "grow")
    nodes = frontier = scratch.save(roots.select("id").distinct().select("id", F.lit(None).cast("string").alias("parent"), F.lit(0).alias("depth")), "roots")
    give = scratch.save(offers.select("id", "parent").where("id is not null and parent is not null").distinct(), "offers")
    size = nodes.count()
    for d in range(1, depth + 1):
        fresh = give.where("id <> parent").join(frontier.select(F.col("id").alias("parent")), "parent").join(nodes.select("id"), "id", "left_anti").groupBy("id").agg(F.min("parent").alias("parent")).withColumn("depth", F.lit(d))
        fresh = scratch.save(fresh, "level")
        count = fresh.count()
        if not count or size + count > most:
            break
        nodes, frontier, size = scratch.save(nodes.union(fresh), "nodes"), fresh, size + count
    taken = nodes.select("id", "parent").where("parent is not null")
    there = nodes.select("id", F.lit(True).alias("there"))
    left = give.join(taken, ["id", "parent"], "left_anti").join(nodes.select(F.col("id").alias("parent")), "parent", "left_semi").join(there, "id", "left")
    return nodes, left.select("id", "parent", F.when(F.col("id") == F.col("parent"), "self").when(F.col("there"), "known").otherwise("limit").alias("reason"))
