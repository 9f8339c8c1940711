"""Incremental ingestion of append-only answers: what a resumable batch run needs.

``targets`` finds the prompts that have no answer yet; ``ingest`` takes new
answer files once each, by a checkpointed stream that ends when it has caught
up, and keeps the first answer of a key in the order in which they were written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.hashing import content_key


def targets(items: DataFrame, cache: DataFrame, key: str, prompt: str) -> DataFrame:
    """``key, prompt_id, prompt`` of items without an answer; equal prompts are asked once, for their smallest key."""
    open_ = items.select(F.col(key).alias("key"), F.col(prompt).alias("prompt")).where("key is not null and prompt is not null").join(cache.select("key"), "key", "left_anti")
    asked = open_.withColumn("prompt_id", F.substring(content_key("prompt"), 1, 32))
    return asked.groupBy("prompt_id").agg(F.min("key").alias("key"), F.min("prompt").alias("prompt")).select("key", "prompt_id", "prompt")


def targets_in_flight(asked: DataFrame, pending: DataFrame) -> DataFrame:
    """``targets`` without those that a batch under way (``prompt_id``) already asks."""
    return asked.join(pending.select("prompt_id").distinct(), "prompt_id", "left_anti").select("key", "prompt_id", "prompt")


def assert_answers(answers: DataFrame, rejected: str, least: int = 200, most: float = 0.5) -> None:
    """An error if, of at least ``least`` answers, more than the share ``most`` is ``rejected`` (a condition)."""
    seen = answers.agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.expr(rejected), F.lit(False))).alias("bad")).first()
    if seen.n >= least and seen.bad > most * seen.n:
        raise ValueError(f"expected at most {most:.0%} of the answers to be rejected, received {seen.bad} of {seen.n}")


def prune(cache: DataFrame, keep: DataFrame) -> DataFrame:
    """Answers whose key is still asked for."""
    return cache.join(keep.select("key").distinct(), "key", "left_semi")


def ingest(spark: SparkSession, folder: str, store: str, checkpoint: str) -> None:
    """Take all new files of ``folder`` (lines of key, tab, value) into the Parquet ``store``; returns when caught up."""
    lines = spark.readStream.text(folder).select("value", "_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start")
    cells = F.split("value", "\t", 2)
    rows = lines.where("value <> ''").select(cells[0].alias("key"), cells[1].alias("value"), F.struct("file_modification_time", "file_path", "file_block_start").alias("at")).where("value is not null")

    def add(batch: DataFrame, number: int) -> None:
        # first is first written: by the file's time and name, then by the place in it
        placed = batch.withColumn("ord", F.struct("at", F.monotonically_increasing_id().alias("place")))
        first = placed.groupBy("key").agg(F.min(F.struct("ord", "value")).getField("value").alias("value"))
        try:
            known = spark.read.parquet(store)
            # a batch that is run again after a failure replaces its own part
            first = first.join(known.where(F.col("batch") != number).select("key"), "key", "left_anti")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER" not in str(error):
                raise
        first.write.mode("overwrite").parquet(f"{store}/batch={number}")

    rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
