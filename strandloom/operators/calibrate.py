"""Difficulty: anchors, topic smoothing, isotonic calibration, bands, audits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.runtime import Scratch


def band(value: Column | str) -> Column:
    """A difficulty on the scale of bands, 1 to 20: rounded half up, plus one."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v.isNotNull(), F.least(F.lit(20), F.greatest(F.lit(1), F.floor(v + 0.5) + 1))).cast("int")


def anchors(grades: Column, span: int = 12) -> Column:
    """The lowest of a row's grades; null without grades and where they span all of school."""
    low, high = F.array_min(grades), F.array_max(grades)
    return F.when((high - low) < span, low)


def smooth_by_topic(rows: DataFrame, id: str, value: str, topic: str, weight: float = 0.3, least: int = 3) -> DataFrame:
    """``id, smoothed``: 70 % of the value, 30 % of the mean over its topics of the others' mean.

    ``rows`` has one row per id and topic. Topics of fewer than ``least`` rows
    don't count. Sums per topic are joined back, so a hot topic is one partial
    aggregate and not a window.
    """
    sums = rows.where(F.col(topic).isNotNull()).groupBy(topic).agg(F.sum(value).alias("_sum"), F.count("*").alias("_n"))
    each = rows.join(sums, topic, "left")
    other = F.when(F.col("_n") >= least, (F.col("_sum") - F.col(value)) / (F.col("_n") - 1))
    mean = each.groupBy(id).agg(F.max(value).alias("_v"), F.avg(other).alias("_mean"))
    return mean.select(id, F.when(F.col("_mean").isNull(), F.col("_v")).otherwise((1 - weight) * F.col("_v") + weight * F.col("_mean")).alias("smoothed"))


def pool(points: Iterator[tuple[float, float, float]]) -> list[list[float]]:
    """Pool adjacent violators: blocks ``x`` (left edge), mean ``y``, weight."""
    blocks: list[list[float]] = []
    for x, y, w in points:
        now = [x, y, w]
        while blocks and blocks[-1][1] > now[1]:
            px, py, pw = blocks.pop()
            now = [px, (py * pw + now[1] * now[2]) / (pw + now[2]), pw + now[2]]
        blocks.append(now)
    return blocks


class Isotonic:
    """A rising line through blocks' left edges; flat below, the slope of the last tenth above."""

    def __init__(self, points: DataFrame, x: str, y: str):
        """Blocks are pooled in every range of x, then once more over all ranges in order.

        Pooling a sequence and pooling its pooled parts give the same blocks,
        so only blocks leave the tasks, and they are as few as steps of y.
        """
        parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        p = points.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where("x is not null and y is not null")

        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = ((a, b, 1.0) for batch in batches for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            blocks = pool(rows)
            if blocks:
                yield pa.RecordBatch.from_arrays([pa.array([b[k] for b in blocks]) for k in range(3)], ["x", "y", "w"])

        found = p.repartitionByRange(parts, "x", "y").sortWithinPartitions("x", "y").mapInArrow(local, "x double, y double, w double").orderBy("x", "y").collect()
        blocks = pool((r.x, r.y, r.w) for r in found)
        self.x, self.y = np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])
        n = self.x.size
        start = max(0, n - max(2, n // 10))
        run = self.x[-1] - self.x[start] if n else 0.0
        self.slope = float((self.y[-1] - self.y[start]) / run) if run > 0 else 0.5

    def predict(self, value: np.ndarray) -> np.ndarray:
        if not self.x.size:
            return value
        out = np.interp(value, self.x, self.y)
        above = value >= self.x[-1]
        return np.where(above, self.y[-1] + self.slope * (value - self.x[-1]), out)

    def column(self, value: Column | str) -> Column:
        model = self

        def run(v: pa.Array) -> pa.Array:
            known = v.is_valid().to_numpy(zero_copy_only=False)
            got = model.predict(v.fill_null(0.0).to_numpy(zero_copy_only=False).astype(float))
            return pa.array(got, mask=~known)

        from pyspark.sql import types as T

        return F.arrow_udf(run, T.DoubleType())((F.col(value) if isinstance(value, str) else value).cast("double"))


def kendall_tau(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``n, concordant, discordant, tau`` over all pairs of rows; pairs with a tie in either count as neither.

    Both values are scales of few steps (bands, grades), so the rows are counted
    in a table of their combinations, and pairs of combinations stand for pairs
    of rows. Rows that lack a value are left out; fewer than two have no tau.
    """
    cells = pairs.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).where("a is not null and b is not null").groupBy("a", "b").agg(F.count("*").alias("c"))
    cells = Scratch(pairs.sparkSession, "tau").save(cells, "cells")
    p, q = cells.alias("p"), cells.alias("q")
    # every pair of different combinations once, by the first value
    both = p.join(q, F.col("p.a") < F.col("q.a")).select((F.col("p.c") * F.col("q.c")).alias("n"), F.signum(F.col("q.b") - F.col("p.b")).alias("way"))
    out = both.agg(F.coalesce(F.sum(F.when(F.col("way") > 0, F.col("n"))), F.lit(0)).alias("concordant"), F.coalesce(F.sum(F.when(F.col("way") < 0, F.col("n"))), F.lit(0)).alias("discordant"))
    total = cells.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"))
    return total.crossJoin(out).withColumn("tau", F.try_divide((F.col("concordant") - F.col("discordant")).cast("double"), F.col("n") * (F.col("n") - 1) / 2))


def scaled_anchors(rows: DataFrame, grades: str, position: str, span: int = 12, top: float = 12.0) -> DataFrame:
    """``rows`` with ``anchor``: the lowest of its grades; else the place of ``position`` between its least and greatest, on a scale of ``top``."""
    ends = rows.agg(F.min(position).alias("_lo"), F.max(position).alias("_hi"))  # one row
    place = F.try_divide((F.col(position) - F.col("_lo")).cast("double"), F.col("_hi") - F.col("_lo")) * top
    return rows.crossJoin(F.broadcast(ends)).withColumn("anchor", F.coalesce(anchors(F.col(grades), span).cast("double"), place)).drop("_lo", "_hi")


def inversions(rows: DataFrame, most: float = 5, samples: int = 10) -> tuple[DataFrame, DataFrame]:
    """``n, inverted, widest, share`` of rows whose estimated and anchored bands are further apart than ``most``, and the widest of them.

    ``rows``: ``id, estimate, anchor`` in bands; rows without an anchor are left out.
    """
    known = rows.where("anchor is not null and estimate is not null").withColumn("gap", F.abs(F.col("estimate") - F.col("anchor")))
    worst = known.where(F.col("gap") > most).orderBy(F.desc("gap"), "id").limit(samples).select("id", "estimate", "anchor", "gap")
    return known.agg(F.count("*").alias("n"), F.count_if(F.col("gap") > most).alias("inverted"), F.max("gap").alias("widest"), F.avg((F.col("gap") > most).cast("double")).alias("share")), worst


def grade_score(value: Column, good: float, bad: float) -> Column:
    """1 at the passing threshold, 0 at failure or below; values beyond the threshold score above 1."""
    return F.greatest(F.lit(0.0), (value - F.lit(bad)) / F.lit(float(good) - float(bad)))


def percentile_rank(values: Column, share: float) -> Column:
    """The element at ``floor(share * n)`` of a sorted array: the nearest rank from below."""
    ordered = F.array_sort(values)
    return F.try_element_at(ordered, F.least(F.size(ordered), F.floor(F.size(ordered) * F.lit(share)).cast("int") + 1))
