"""Pairwise matches to groups (problem 5).

1. Ends are numbered in the order of their text, so the smallest number of a
   group is its smallest id.
2. From the vertex of highest degree, frontier joins find its component, as a
   rule the giant one, and an anti-join takes it away.
3. What remains, many small components, is labelled by minimum propagation:
   every vertex takes the smallest label next to it, labels jump until they
   stand, and the links are rewritten to labels. Two such rounds at least halve
   the labels, and a sorted chain of any length takes one.

Frontiers advance one step a join, so a component of great diameter would take
as many joins. After ``FRONTIERS`` of them, what was reached is merged into one
vertex and goes on with the rest, in step 3; nothing is lost. Links between
equal labels vanish and parallel ones are merged before they are shuffled on,
so a vertex that holds a third of all links does no harm.

Defined results: null or blank ends and pairs of an id with itself link
nothing; order and repeats do not matter; no links give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators.graph import min_labels
from strandloom.runtime import Scratch

FRONTIERS = 24


def _numbered(scratch: Scratch, ids: DataFrame) -> DataFrame:
    """``id, n``: numbers in the order of code points, by range partitions."""
    spark = ids.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return scratch.save(ids.distinct().repartitionByRange(parts, "id").sortWithinPartitions("id").withColumn("n", F.monotonically_increasing_id()), "vertices")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _peel(scratch: Scratch, edges: DataFrame) -> tuple[DataFrame, DataFrame, int, bool]:
    """The component of the vertex of highest degree, by frontiers: reached vertices, the other links, the root, and whether it is whole."""
    top = _both_ways(edges).groupBy("u").agg(F.count("*").alias("d")).orderBy(F.desc("d"), "u").first()
    root, spark = top.u, edges.sparkSession
    reached = frontier = scratch.save(spark.createDataFrame([(root,)], "v long"), "frontier")
    left = edges
    whole = False
    for _ in range(FRONTIERS):
        f = frontier
        out = left.join(f.select(F.col("v").alias("u")), "u").select("v").union(left.join(f, "v").select(F.col("u").alias("v")))
        fresh, seen = scratch.counted(out.distinct().join(reached, "v", "left_anti"), "frontier")
        if not seen["rows"]:
            whole = True
            break
        reached, frontier = reached.union(fresh), fresh
    if whole:
        rest = left.join(reached.select(F.col("v").alias("u")), "u", "left_anti")
    else:
        mark = reached.select(F.col("v").alias("x"))
        rest = left.join(mark.withColumnRenamed("x", "u").withColumn("ru", F.lit(root)), "u", "left").join(mark.withColumnRenamed("x", "v").withColumn("rv", F.lit(root)), "v", "left").select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v")).where("u <> v").distinct()
    return reached, scratch.save(rest, "rest"), root, whole


def groups(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, group_id``: every linked id with the smallest id of its group."""
    spark = pairs.sparkSession
    scratch = Scratch(spark, "groups")
    links = pairs.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).where("a <> b and trim(a) <> '' and trim(b) <> ''").distinct()
    links, seen = scratch.counted(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    names = _numbered(scratch, links.select(F.col("a").alias("id")).union(links.select(F.col("b").alias("id"))))
    if not seen["rows"]:
        return spark.createDataFrame([], "id string, group_id string")
    edges = links.join(names.select(F.col("id").alias("a"), F.col("n").alias("u")), "a").join(names.select(F.col("id").alias("b"), F.col("n").alias("v")), "b").select("u", "v")
    edges = scratch.save(edges, "links")
    reached, rest, root, whole = _peel(scratch, edges)
    small, _ = min_labels(rest, scratch)
    if whole:
        least = reached.agg(F.min("v")).first()[0]
        label = small.union(reached.select("v", F.lit(least).alias("label")))
    else:
        # the merged vertex has a label of its own; what was reached may hold a smaller vertex still
        joined = small.where(F.col("v") == root).select("label").first()
        at = joined.label if joined else root
        least = min(at, reached.agg(F.min("v")).first()[0])
        mine = small.join(reached, "v", "left_anti").select("v", F.when(F.col("label") == at, F.lit(least)).otherwise(F.col("label")).alias("label"))
        label = mine.union(reached.select("v", F.lit(least).alias("label")))
    label = scratch.save(label, "labels")
    own = names.select(F.col("n").alias("v"), "id")
    head = names.select(F.col("n").alias("label"), F.col("id").alias("group_id"))
    return label.join(own, "v").join(head, "label").select("id", "group_id")
