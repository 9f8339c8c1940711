"""An inverted-file index over vectors: approximate top-k under a condition on the candidates.

Centroids come from spherical k-means on a bounded sample: about the square
root of the number of rows, at most ``MOST_LISTS``, so that they can be sent to
every task whatever the size of the table. Every row is assigned to its nearest
centroid. A query visits its ``probe`` nearest lists, and further ones, twice as
many a round, until ``k`` candidates pass the condition or no list is left, so
a condition that few rows meet costs work and never candidates. Lists are
compared with the queries that visit them in blocks, under the condition; the
rounds behind the first are made at once, each with its own best.

Vectors that are null, of another length, not finite or all zero take no part;
ties in cosine go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.blocks import NOWHERE, Guard, search, units
from strandloom.operators.similarity import usable
from strandloom.runtime import Scratch

#: Lists at most: 4,096 centroids of 768 numbers are 12 MB.
MOST_LISTS = 4_096
#: Sample vectors a list that the centroids are fitted on, and rounds of fitting.
SAMPLE_A_LIST, ROUNDS = 50, 8


class ListIndex:
    """``rows``: ``list, id, vec`` and the columns ``keep`` (new name to old); ``centroids``: one row a list."""

    def __init__(self, vectors: DataFrame, id: str, vector: str, dim: int, keep: dict[str, str] | None = None):
        spark = vectors.sparkSession
        self.scratch, self.dim, self.spark = Scratch(spark, "lists"), dim, spark
        rows = vectors.where(usable(vector, dim)).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vec"), *(F.col(old).alias(new) for new, old in (keep or {}).items()))
        rows, seen = self.scratch.counted(rows, "vectors")
        self.size = seen["rows"]
        lists = max(1, min(MOST_LISTS, round(self.size**0.5)))
        # a sample of fixed size by hash, whatever the order of the rows
        some = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_A_LIST * lists).select("vec").toArrow()
        x = np.concatenate([units(c, dim) for c in some["vec"].chunks if len(c)]) if some.num_rows else np.zeros((0, dim))
        self.centroids = self._fit(x, lists)
        held = spark.sparkContext.broadcast(self.centroids)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    near = np.argmax(units(batch.column("vec"), dim) @ held.value.T, axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), *batch.columns], ["list", *batch.schema.names])

        kind = ", ".join(["list int", *(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)])
        self.rows = self.scratch.save(rows.mapInArrow(assign, kind).repartition("list").sortWithinPartitions("list"), "lists")
        self.scratch.drop(rows)

    @staticmethod
    def _fit(x: np.ndarray, lists: int) -> np.ndarray:
        if not len(x):
            return np.zeros((1, x.shape[1]))
        centre = x[np.linspace(0, len(x) - 1, min(lists, len(x))).astype(int)].copy()
        for _ in range(ROUNDS):
            near = np.concatenate([np.argmax(part @ centre.T, axis=1) for part in np.array_split(x, max(1, len(x) // 8192))])
            total = np.zeros_like(centre)
            np.add.at(total, near, x)
            norm = np.sqrt((total * total).sum(axis=1))
            full = norm > 0  # an empty list keeps its centroid
            centre[full] = total[full] / norm[full, None]
        return centre

    def described(self, attributes: DataFrame) -> DataFrame:
        """The rows with ``attributes`` (by ``id``), for searches under a condition on these; other rows are left out."""
        return self.scratch.save(self.rows.join(attributes, "id").repartition("list").sortWithinPartitions("list"), "described")

    def _visits(self, upto: list[int], start: int):
        """The bucket of each list for unit vectors: the first of ``upto`` that its place in order of nearness is below, from place ``start`` on."""
        lists = len(self.centroids)
        place = np.searchsorted(np.array(upto), np.arange(lists), "right")
        bucket = np.where((np.arange(lists) < start) | (place >= len(upto)), NOWHERE, place).astype(np.uint8)

        def visits(q: np.ndarray) -> np.ndarray:
            out = np.empty((len(q), lists), np.uint8)
            for lo in range(0, len(q), 1024):
                order = np.argsort(-(q[lo : lo + 1024] @ self.centroids.T), axis=1, kind="stable")
                np.put_along_axis(out[lo : lo + 1024], order, np.broadcast_to(bucket, order.shape), axis=1)
            return out

        return visits

    def top(self, queries: DataFrame, k: int, id: str, vector: str, probe: int = 24, guard: Guard | None = None, rows: DataFrame | None = None) -> DataFrame:
        """``id, other, cosine, rank``: the best ``k`` others of each query under the condition ``guard``.

        It reads columns of ``queries`` and of ``rows``, which are those of the
        index or ``described`` ones.
        """
        rows, dim, lists, guard = self.rows if rows is None else rows, self.dim, len(self.centroids), guard or Guard()
        asked = queries.where(usable(vector, dim)).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vec"), *guard.asks)
        asked, seen = self.scratch.counted(asked, "asked")
        best = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "other"))
        ranked = lambda df: df.withColumn("rank", best).where(F.col("rank") <= k)
        near = search(rows, asked, seen["rows"], k, dim, guard, visits=None if probe >= lists else self._visits([probe], 0))
        found = self.scratch.save(ranked(near).select("id", "other", "cosine"), "found")
        if probe >= lists:
            return found.withColumn("rank", best)
        full = found.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") >= k).select("id")
        left, seen = self.scratch.counted(asked.join(full, "id", "left_anti"), "open")
        if not seen["rows"]:
            return found.withColumn("rank", best)
        upto = [2 * probe]
        while upto[-1] < lists:
            upto.append(2 * upto[-1])
        more = search(rows, left, seen["rows"], k, dim, guard, visits=self._visits(upto, probe), buckets=len(upto))
        more = found.withColumn("bucket", F.lit(-1)).union(more)
        # a round counts if all before it found fewer than k
        before = F.count("*").over(Window.partitionBy("id").orderBy("bucket").rangeBetween(Window.unboundedPreceding, -1))
        return self.scratch.save(ranked(more.withColumn("before", before).where(F.col("before") < k)).select("id", "other", "cosine", "rank"), "found")
