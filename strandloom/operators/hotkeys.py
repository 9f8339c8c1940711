"""Per-key results where a few keys hold most rows (problem 2): exact offset chunking.

1. Rows are put in order by range partitions of the order column, which do not
   depend on the key, and written; every written block holds a like number of rows.
   Inside a block they are sorted by key and order.
2. Keys are counted per block, by partial aggregation.
3. Prefix sums over the blocks give the offset of each key's rows in each block.
4. A row's number within its key is the offset of its block plus its place in
   the key's run there; the number divided by ``chunk_rows`` is its chunk. All
   chunks of a key but the last hold exactly ``chunk_rows`` rows.
5. Chunks are processed by themselves, each giving a state, and the few states
   of a key are merged in order, across their boundaries.

Every key goes this way, rare ones with one chunk. A chunk is meant to be a
small part of one task's share: ``chunk_rows`` is all rows divided by
``CHUNKS_A_TASK`` times the number of shuffle partitions, unless it is given.

Defined results: null keys are left out; ties in the order are broken by the
position in the written block; an empty table gives no keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.runtime import Scratch

#: Chunks that the rows of one shuffle partition would make if all belonged to one key.
CHUNKS_A_TASK = 4
#: Bits that ``monotonically_increasing_id`` keeps for the place in a partition.
PLACE_BITS = 33


class KeyChunks:
    """``rows``: ``key columns, order, _place, chunk``; ``chunk_rows``: rows of a full chunk."""

    def __init__(self, df: DataFrame, keys: list[str], order: str, chunk_rows: int | None = None):
        spark = df.sparkSession
        self.keys, self.order = keys, order
        scratch = Scratch(spark, "hotkeys")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        keyed = df.select(*keys, order).where(" and ".join(f"`{k}` is not null" for k in keys))
        placed = keyed.repartitionByRange(parts, order).sortWithinPartitions(*keys, order).withColumn("_place", F.monotonically_increasing_id())
        placed, seen = scratch.counted(placed, "placed")
        self.chunk_rows = chunk_rows or max(1, -(-seen["rows"] // (CHUNKS_A_TASK * parts)))
        block = F.shiftright("_place", PLACE_BITS)
        # a key's rows in a block are one run, which starts at its least place
        runs = placed.groupBy(*keys, block.alias("_block")).agg(F.count("*").alias("_n"), F.min("_place").alias("_start"))
        before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = runs.select(*keys, "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start")).alias("_shift"))
        offsets = scratch.save(offsets, "offsets")
        number = F.col("_place") + F.col("_shift")
        self.rows = placed.withColumn("_block", block).join(offsets, [*keys, "_block"]).select(*keys, order, "_place", F.floor(number / self.chunk_rows).alias("chunk"))

    def merge_counts(self) -> DataFrame:
        """``keys, n_rows``: chunks are counted by themselves and added up."""
        states = self.rows.groupBy(*self.keys, "chunk").agg(F.count("*").alias("n"))
        return states.groupBy(*self.keys).agg(F.sum("n").alias("n_rows"))

    def runs(self) -> DataFrame:
        """``keys, n_rows, first, last, longest_gap``: the widest step between neighbours in order, across chunk boundaries."""
        by = Window.partitionBy(*self.keys, "chunk").orderBy("_place")
        gap: Column = F.col(self.order) - F.lag(self.order).over(by)
        states = self.rows.withColumn("_gap", gap).groupBy(*self.keys, "chunk").agg(F.count("*").alias("n"), F.min(self.order).alias("lo"), F.max(self.order).alias("hi"), F.max("_gap").alias("gap"))
        # one state per chunk: a key of r rows has r / chunk_rows of them
        ahead = Window.partitionBy(*self.keys).orderBy("chunk")
        states = states.withColumn("edge", F.col("lo") - F.lag("hi").over(ahead))
        return states.groupBy(*self.keys).agg(F.sum("n").alias("n_rows"), F.min("lo").alias("first"), F.max("hi").alias("last"), F.coalesce(F.greatest(F.max("gap"), F.max("edge")), F.lit(0)).alias("longest_gap"))


def list_items(column: str) -> Column:
    """Distinct non-empty items of a comma-joined list, trimmed and in lower case."""
    items = F.transform(F.split(F.col(column), ","), lambda x: F.lower(F.regexp_replace(x, r"^[\s\x{a0}]+|[\s\x{a0}]+$", "")))
    return F.array_distinct(F.filter(items, lambda x: x != ""))
