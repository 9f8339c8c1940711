"""Mixing sources to target weights (problem 9): capped water-filling and seeded repetitions.

Sizes are tokens of a public tokenizer, counted over every whole text. Target
shares are turned into amounts; a source whose amount exceeds its tokens times
its allowed repeats is clamped there and the excess goes to the others in
proportion to their targets, until nothing exceeds. The number of epochs of a
source is its amount divided by its tokens: every record is taken the whole
number of times, and the remaining fraction is filled by records in a seeded
order until their tokens reach it.

The seeded order is a hash of the record's id, so it does not depend on
partitions. The cut is found without sorting a source: two histograms of 4096
slots of the hash per source find the slot in which the amount is reached, and
only that slot, 1/16777216 of a source, is ordered.

Defined results: null sources, and sources without a target, are left out;
null texts have no tokens and are left out, empty texts have 0 tokens and ride
along; a source without records gets share 0 and its weight goes to the
others; no records at all give no rows and shares of 0.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm import textform
from strandloom.runtime import Scratch, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the splitting pattern that byte-level vocabularies of this family use.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SLOTS = 4096


@functools.lru_cache(maxsize=4)
def _encoding(name: str):
    """The tokenizer of a vocabulary file that was sent to the executors."""
    import tiktoken

    with open(SparkFiles.get(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _count(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(name).encode_ordinary_batch
        for batch in (b.slice(lo, hi - lo) for b in batches for lo, hi in textform.slices(b.column(b.num_columns - 1))):
            n = [len(tokens) for tokens in encode(batch.column(batch.num_columns - 1).to_pylist(), num_threads=1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], [*batch.schema.names[:-1], "tokens"])

    return run


def source_key(column: Column | str) -> Column:
    """Sources are the same whatever their case, outer blanks, ``-`` or ``_``."""
    column = F.col(column) if isinstance(column, str) else column
    key = F.translate(F.lower(F.regexp_replace(column, r"^[\s\x{a0}]+|[\s\x{a0}]+$", "")), "-", "_")
    return F.when(key != "", key)


def water_fill(targets: dict[str, tuple[float, int]], sizes: dict[str, int], total: float | None = None) -> dict[str, float]:
    """Amount of each source: ``targets`` has share and allowed repeats, ``sizes`` the tokens; ``total`` is all tokens at first."""
    total = float(sum(sizes.get(s, 0) for s in targets)) if total is None else float(total)
    cap = {s: float(sizes.get(s, 0)) * max(r, 0) for s, (_, r) in targets.items()}
    total = min(total, sum(c for s, c in cap.items() if targets[s][0] > 0))
    amount: dict[str, float] = {s: 0.0 for s in targets}
    free = {s for s in targets if targets[s][0] > 0 and cap[s] > 0}
    while free:
        left = total - sum(amount[s] for s in targets if s not in free)
        weight = sum(targets[s][0] for s in free)
        for s in free:
            amount[s] = left * targets[s][0] / weight
        over = {s for s in free if amount[s] > cap[s] * (1 + 1e-12)}
        if not over:
            break
        for s in over:
            amount[s] = cap[s]
        free -= over
    return amount


class Mixture:
    """``chosen``: ``doc_id, source, tokens, repeats``. ``shares``: one row per target source, with what was reached."""

    def __init__(self, documents: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 11, total: float | None = None, tokenizer: str = TOKENIZER):
        spark = documents.sparkSession
        scratch = Scratch(spark, "mixture")
        # a row per target source, by contract a short table
        rows = targets.select(source_key("source").alias("source"), "target_share", "max_repeats").where("source is not null").groupBy("source").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("repeats")).collect()
        goal = {r.source: (float(r.share or 0), int(r.repeats or 0)) for r in rows}
        key = source_key(source)
        docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), key.alias("source"), F.col(text).alias("text")).where(F.col("text").isNotNull() & F.col("source").isin(list(goal)))
        # the vocabulary is read on the driver and sent along; executors need no copy of their own
        spark.sparkContext.addFile(tokenizer)
        sized = spread(docs).mapInArrow(_count(os.path.basename(tokenizer)), "doc_id long, source string, tokens long")
        order = F.xxhash64(F.lit(seed), "doc_id", "tokens")
        slot = F.shiftrightunsigned(order, 52).cast("int")
        fine = F.shiftrightunsigned(order, 40).bitwiseAND(F.lit(SLOTS - 1)).cast("int")
        sized = scratch.save(sized.select("*", order.alias("order"), slot.alias("slot"), fine.alias("fine")), "sized")
        sizes = {r.source: int(r.n or 0) for r in sized.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
        amount = water_fill(goal, sizes, total)
        plan = []
        for s, (share, repeats) in sorted(goal.items()):
            epochs = amount[s] / sizes[s] if sizes.get(s) else 0.0
            whole = min(int(epochs + 1e-9), repeats)
            part = max(0.0, amount[s] - whole * sizes.get(s, 0)) if whole < repeats else 0.0
            plan.append((s, share, repeats, sizes.get(s, 0), whole, part))
        plan = spark.createDataFrame(plan, "source string, share double, repeats int, available long, whole int, part double")
        todo = F.broadcast(plan.where("part >= 1").select("source", "part"))  # a row per target source
        cuts = self._cut(sized, todo, [], "slot")
        cuts = self._cut(sized, cuts, ["slot"], "fine")
        # inside the last slot the records themselves are in order
        inside = sized.join(F.broadcast(cuts), "source").where("slot = cut_slot and fine = cut_fine")
        run = Window.partitionBy("source").orderBy("order", "doc_id")
        inside = inside.withColumn("before", F.coalesce(F.sum("tokens").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).groupBy("source", "order", "doc_id").agg(F.min("before").alias("before"))
        last = scratch.save(inside, "last")
        edge = F.broadcast(cuts)
        joined = sized.join(F.broadcast(plan.select("source", "whole")), "source").join(edge, "source", "left").join(last, ["source", "order", "doc_id"], "left")
        below = (F.col("slot") < F.col("cut_slot")) | ((F.col("slot") == F.col("cut_slot")) & (F.col("fine") < F.col("cut_fine")))
        # the record that crosses the amount is taken if more than half of it fits
        fits = F.col("before").isNotNull() & (F.col("before") + F.col("tokens") / 2 <= F.col("part"))
        extra = F.when(F.coalesce(below, F.lit(False)) | F.coalesce(fits, F.lit(False)), 1).otherwise(0)
        chosen = joined.select("doc_id", "source", "tokens", (F.col("whole") + extra).alias("repeats")).where("repeats > 0")
        self.chosen = scratch.save(chosen, "chosen")
        taken = self.chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("taken"), F.count("*").alias("records"), F.max("repeats").alias("most"))
        all_taken = F.sum("taken_tokens").over(Window.partitionBy())  # over a row per target source
        self.shares = (
            plan.join(taken, "source", "left")
            .select("source", F.col("share").alias("target_share"), F.col("repeats").alias("max_repeats"), F.col("available").alias("available_tokens"), F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("most", F.lit(0)).alias("most_repeats"), F.coalesce("taken", F.lit(0)).alias("taken_tokens"))
            .withColumn("actual_share", F.coalesce(F.try_divide(F.col("taken_tokens").cast("double"), all_taken), F.lit(0.0)))
        )

    @staticmethod
    def _cut(sized: DataFrame, todo: DataFrame, fixed: list[str], slot: str) -> DataFrame:
        """The slot of each source in which the amount is reached, and what is left of the amount there."""
        df = sized.join(F.broadcast(todo), "source")
        for f in fixed:
            df = df.where(F.col(f) == F.col(f"cut_{f}"))
        keep = ["source", "part", *(f"cut_{f}" for f in fixed)]
        hist = df.groupBy(*keep, slot).agg(F.sum("tokens").alias("n"))  # at most SLOTS rows a source
        run = Window.partitionBy("source").orderBy(slot)
        hist = hist.withColumn("upto", F.sum("n").over(run)).where(F.col("upto") >= F.col("part"))
        best = hist.groupBy(*keep).agg(F.min(F.struct(slot, "upto", "n")).alias("c"))
        return best.select("source", (F.col("part") - (F.col("c.upto") - F.col("c.n"))).alias("part"), *keep[2:], F.col(f"c.{slot}").alias(f"cut_{slot}"))
