"""Parent-child links to full hierarchies (problem 1).

1. Ids are numbered in their own order, by range partitions.
2. Peeling: nodes without a child and nodes whose parent is gone are taken
   away, a few rounds from both ends. What is left are loops and long chains;
   there, parent pointers are doubled. The nodes that still are images when
   the set of images no longer shrinks lie on loops. This takes a number of
   rounds that grows as the logarithm of the longest way, not as its length.
3. Loops are cut at all their nodes, so each becomes a root of its own.
4. Euler tour: every inner node is entered and left, a leaf is one element.
   Children of one parent are linked in salted parts of at most ``PART`` each,
   and the parts in order, so a parent of a third of all nodes is no one
   task's work.
5. List ranking: every element's pointer triples its reach per round and adds
   up the distance to the end of its tour and the balance of entries and
   exits. Each element is pointed at once, so no join is skewed.

From the distances come ``entry`` and ``exit``: node *b* lies under *a* exactly
if both have one root and ``a.entry < b.entry and b.exit <= a.exit``; half the
distance between the two is the number of descendants, and the balance is the
depth.

Defined results: null ids are no nodes; a null, blank or unknown parent makes
a root; of several parents the smallest counts; repeated rows count once; a
node that is its own parent is a loop; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.runtime import BROADCAST_ROWS, Scratch

PEELS = 4
PART = 20_000
CHUNK = 50_000


class Hierarchy:
    """``nodes``: ``id, parent, root, depth, in_loop, to_loop, loop, entry, exit, descendants``.

    ``root`` is the id at the top of the way up; where the way ends in a loop
    (``to_loop``) it is the loop's node at which it arrives, ``depth`` counts
    the steps to it, and ``loop`` is the smallest id of that loop.
    """

    def __init__(self, links: DataFrame, id: str = "id", parent: str = "parent"):
        self.spark = links.sparkSession
        self.scratch = Scratch(self.spark, "hierarchy")
        rows = links.select(F.col(id).cast("string").alias("id"), F.col(parent).cast("string").alias("parent")).where("id is not null")
        rows = rows.groupBy("id").agg(F.min(F.when(F.trim("parent") != "", F.col("parent"))).alias("parent"))
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.names = self.scratch.save(rows.repartitionByRange(parts, "id").sortWithinPartitions("id").withColumn("n", F.monotonically_increasing_id()), "names")
        above = self.names.select(F.col("id").alias("parent"), F.col("n").alias("p"))
        tree, seen = self.scratch.counted(self.names.where("parent is not null").join(above, "parent").select("n", "p"), "links")
        loops = self._loops(tree, seen["rows"])
        self.loops = self.scratch.save(self._least(tree.join(loops, "n")), "loops")
        cut = tree.join(loops, "n", "left_anti")
        self.ranked = self.scratch.save(self._rank(cut), "ranked")
        self.nodes = self._named(tree)

    # --- loops -----------------------------------------------------------------------------------

    def _loops(self, tree: DataFrame, size: int) -> DataFrame:
        """``n`` of every node on a loop."""
        core = tree
        for _ in range(PEELS):
            with_child = core.select(F.col("p").alias("n")).distinct()
            kept = core.join(with_child, "n", "left_semi")
            kept = kept.join(core.select(F.col("n").alias("p")), "p", "left_semi").select("n", "p")
            kept, seen = self.scratch.counted(kept, "core")
            if core is not tree:
                self.scratch.drop(core)
            core, before, size = kept, size, seen["rows"]
            if size in (0, before):
                return core.select("n")
        # ways are doubled twice a table; the images stop dwindling when only loops are left of them
        jump, images = core, -1
        while True:
            found, seen = self.scratch.counted(jump.select(F.col("p").alias("n")).distinct(), "images")
            if seen["rows"] in (0, images):
                return found
            images = seen["rows"]
            self.scratch.drop(found)
            step = jump.select(F.col("n").alias("p"), F.col("p").alias("q"))
            twice = jump.join(step, "p").select("n", F.col("q").alias("p"))
            again = self.scratch.save(twice.join(step, "p").select("n", F.col("q").alias("p")), "jump")
            if jump is not core:
                self.scratch.drop(jump)
            jump = again

    def _least(self, loop: DataFrame) -> DataFrame:
        """``n, loop``: the smallest node of the loop, by doubling along the loop."""
        reach, seen = self.scratch.counted(loop.select("n", "p", F.least("n", "p").alias("loop"), F.lit(True).alias("new")), "loop", new=F.count_if("new"))
        while seen["new"]:
            ahead = reach.select(F.col("n").alias("p"), F.col("p").alias("q"), F.col("loop").alias("far"))
            grown, seen = self.scratch.counted(reach.drop("new").join(ahead, "p").select("n", F.col("q").alias("p"), F.least("loop", "far").alias("loop"), (F.col("far") < F.col("loop")).alias("new")), "loop", new=F.count_if("new"))
            self.scratch.drop(reach)
            reach = grown
        return reach.select("n", "loop")

    # --- Euler tours -----------------------------------------------------------------------------

    def _tour(self, tree: DataFrame) -> DataFrame:
        """``e, nxt, dist, bal``: entering node n is 2n, leaving it 2n + 1; a leaf is 2n alone."""
        hot = tree.groupBy("p").agg(F.count("*").alias("c")).where(F.col("c") > PART).select("p", F.ceil(F.col("c") / PART).alias("parts"))
        hot = self.scratch.save(hot, "hot")
        child = tree.join(hot, "p", "left").select("n", "p", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("n"), F.col("parts"))).cast("int").alias("s"))
        child = child.withColumn("sibling", F.lead("n").over(Window.partitionBy("p", "s").orderBy("n")))
        child = self.scratch.save(child, "children")
        part = child.groupBy("p", "s").agg(F.min("n").alias("first"))
        part = self.scratch.save(part.withColumn("after", F.lead("first").over(Window.partitionBy("p").orderBy("s"))).withColumn("head", F.row_number().over(Window.partitionBy("p").orderBy("s")) == 1), "parts")
        # inner nodes are entered towards their first child
        enter = part.where("head").select((F.col("p") * 2).alias("e"), (F.col("first") * 2).alias("nxt"), F.lit(1).cast("long").alias("dist"), F.lit(1).cast("long").alias("bal"))
        inner = part.where("head").select(F.col("p").alias("n"), F.lit(True).alias("inner"))
        # every node is left towards its sibling, the next part, or its parent
        step = child.join(part.where("after is not null").select("p", "s", "after"), ["p", "s"], "left").select("n", F.coalesce(F.col("sibling") * 2, F.col("after") * 2, F.col("p") * 2 + 1).alias("nxt"))
        out = self.names.select("n").join(step, "n", "left").join(inner, "n", "left")
        leave = out.select((F.col("n") * 2 + F.coalesce(F.col("inner").cast("int"), F.lit(0))).alias("e"), "nxt", F.when(F.col("inner"), 1).otherwise(2).cast("long").alias("dist"), F.when(F.col("inner"), -1).otherwise(0).cast("long").alias("bal"))
        return enter.union(leave)

    def _rank(self, tree: DataFrame) -> DataFrame:
        """``n, root, depth, entry, exit`` by list ranking."""
        going = F.count("nxt")
        tour, seen = self.scratch.counted(self._tour(tree).withColumn("tail", F.col("e")), "tour", going=going)
        while seen["going"]:
            step = tour.select(F.col("e").alias("nxt"), F.col("nxt").alias("n2"), F.col("dist").alias("d2"), F.col("bal").alias("b2"), F.col("tail").alias("t2"))
            # an element that has reached the end of its tour waits; only the others are joined
            hop = tour.where("nxt is not null")
            for _ in range(2):
                hop = hop.join(step, "nxt", "left")
                hop = hop.select("e", F.col("n2").alias("nxt"), (F.col("dist") + F.coalesce("d2", F.lit(0))).alias("dist"), (F.col("bal") + F.coalesce("b2", F.lit(0))).alias("bal"), F.coalesce("t2", "tail").alias("tail"))
            longer, seen = self.scratch.counted(hop.union(tour.where("nxt is null").select("e", "nxt", "dist", "bal", "tail")), "tour", going=going)
            self.scratch.drop(tour)
            tour = longer
        half = F.shiftright("e", 1)
        both = tour.groupBy(half.alias("n")).agg(F.max("dist").alias("far"), F.min("dist").alias("near"), F.max("bal").alias("bal"), F.min("tail").alias("tail"))
        leave = F.when(F.col("far") == F.col("near"), F.col("far") - 1).otherwise(F.col("near"))
        return both.select("n", F.shiftright("tail", 1).alias("root"), (-F.col("bal")).cast("int").alias("depth"), (-F.col("far")).alias("entry"), (-leave).alias("exit"))

    def _named(self, tree: DataFrame) -> DataFrame:
        plain = self.names.select("n", "id")
        roots = self.ranked.where("depth = 0").select("n").join(plain, "n").join(self.loops, "n", "left").join(plain.select(F.col("n").alias("loop"), F.col("id").alias("loop_id")), "loop", "left")
        roots, seen = self.scratch.counted(roots.select(F.col("n").alias("root"), F.col("id").alias("root_id"), "loop_id"), "roots")
        few = F.broadcast(roots) if seen["rows"] <= BROADCAST_ROWS else roots
        known = tree.select("n", F.lit(True).alias("has_parent"))
        out = self.ranked.join(self.names, "n").join(known, "n", "left").join(few, "root")
        return out.select(
            "n", "id", F.when(F.col("has_parent"), F.col("parent")).alias("parent"), F.col("root_id").alias("root"), "depth",
            (F.col("loop_id").isNotNull() & (F.col("depth") == 0)).alias("in_loop"), F.col("loop_id").isNotNull().alias("to_loop"), F.col("loop_id").alias("loop"),
            F.col("root").alias("root_n"), "entry", "exit", F.floor((F.col("exit") - F.col("entry") - 1) / 2).cast("long").alias("descendants"),
        )

    # --- paths and pairs -------------------------------------------------------------------------

    def under(self, ids: DataFrame) -> DataFrame:
        """``id, descendant`` for the given ids (a column ``id``): all their descendants, by intervals.

        An interval is cut at the chunks of the tour, and meets the nodes of
        each chunk by an equal join, so a root with a third of all nodes is
        spread over all its chunks.
        """
        chunk = lambda c: F.floor(F.col(c) / CHUNK)
        top = self.nodes.join(ids.select("id").distinct(), "id").where("descendants > 0").select(F.col("id").alias("top"), "root_n", F.col("entry").alias("lo"), F.col("exit").alias("hi"))
        top = top.withColumn("chunk", F.explode(F.sequence(chunk("lo"), chunk("hi"))))
        found = self.nodes.select("id", "root_n", "entry", "exit", chunk("entry").alias("chunk")).join(top, ["root_n", "chunk"])
        return found.where("entry > lo and exit <= hi").select(F.col("top").alias("id"), F.col("id").alias("descendant"))

    def descendants(self) -> DataFrame:
        """``id, descendant, steps`` of every node and all that lies under it: as many rows as the depths add up to."""
        way = self.paths().select(F.col("id").alias("descendant"), F.size("path").alias("n"), F.posexplode(F.expr("slice(path, 1, size(path) - 1)")).alias("at", "id"))
        return way.select("id", "descendant", (F.col("n") - 1 - F.col("at")).alias("steps"))

    def paths(self) -> DataFrame:
        """``id, path``: the ids from the root down to each node, as an array.

        Nodes in tour order are cut into chunks of ``CHUNK`` positions. A chunk
        starts with the last node of every depth before it, which are the
        ancestors of its first node; these boundary states come from one row
        per chunk and depth.
        """
        rows = self.scratch.save(self.nodes.select("id", "root_n", "depth", "entry", F.floor(F.col("entry") / CHUNK).alias("chunk")), "preorder")
        ends = rows.groupBy("root_n", "chunk", "depth").agg(F.max(F.struct("entry", "id")).alias("last"))
        starts = rows.groupBy("root_n", "chunk").agg(F.min(F.struct("entry", "depth")).alias("first")).where("first.depth > 0")
        ask = starts.select("root_n", "chunk", F.explode(F.sequence(F.lit(0), F.col("first.depth") - 1)).alias("depth"))
        both = ends.select("root_n", "chunk", "depth", F.col("last.id").alias("id"), F.lit(1).alias("kind")).union(ask.select("root_n", "chunk", "depth", F.lit(None).cast("string").alias("id"), F.lit(0).alias("kind")))
        before = F.last("id", True).over(Window.partitionBy("root_n", "depth").orderBy("chunk", "kind").rowsBetween(Window.unboundedPreceding, -1))
        states = both.withColumn("above", before).where("kind = 0").select("root_n", "chunk", "depth", F.lit(-1).cast("long").alias("rank"), F.col("above").alias("id"))
        shift = F.col("entry") - F.col("chunk") * CHUNK
        todo = states.union(rows.select("root_n", "chunk", "depth", shift.alias("rank"), "id"))
        todo = todo.repartition("root_n", "chunk").sortWithinPartitions("root_n", "chunk", "rank", "depth").select("depth", "rank", "id")
        return todo.mapInArrow(_walk, "id string, path array<string>")


#: Path entries that one output batch is meant to hold.
ENTRIES = 1 << 20


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of rows in preorder: the ancestor at depth k is the last row of depth k that came before."""
    stack = pa.array([], pa.string())
    for batch in batches:
        depth = batch.column(0).to_numpy().astype(np.int64)
        shown = batch.column(1).to_numpy() >= 0
        start = 0
        while start < depth.size:
            # a slice of about ENTRIES path entries; entries count for rows that are shown
            size = np.cumsum(np.where(shown[start:], depth[start:] + 1, 1))
            stop = start + max(1, int(np.searchsorted(size, ENTRIES, "right")))
            d, here = depth[start:stop], shown[start:stop]
            # the stack before the slice, then the slice's own ids
            ids = pa.concat_arrays([stack, batch.column(2).slice(start, stop - start).cast(pa.string())])
            old = len(stack)
            low = int(d.min())
            rows = np.flatnonzero(here)
            offsets = np.zeros(rows.size + 1, np.int64)
            np.cumsum(d[rows] + 1, out=offsets[1:])
            flat = np.empty(int(offsets[-1]), np.int64)
            if low and rows.size:
                flat[(offsets[:-1, None] + np.arange(low)).ravel()] = np.tile(np.arange(low), rows.size)
            last = np.arange(old)[: max(int(d.max()) + 1, old)]
            top = np.full(max(int(d.max()) + 1, old), -1, np.int64)
            top[:old] = last
            for k in range(low, int(d.max()) + 1):
                at = np.flatnonzero(d == k)
                deep = np.flatnonzero(d[rows] >= k)
                place = np.searchsorted(at, rows[deep], "right") - 1
                if not at.size:
                    flat[offsets[deep] + k] = top[k]
                    continue
                flat[offsets[deep] + k] = np.where(place >= 0, at[np.maximum(place, 0)] + old, top[k])
                top[k] = at[-1] + old
            stack = ids.take(pa.array(top[: int(d[-1]) + 1]))
            if rows.size:
                path = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), ids.take(pa.array(flat)))
                yield pa.RecordBatch.from_arrays([ids.slice(old).take(pa.array(rows)), path], ["id", "path"])
            start = stop
