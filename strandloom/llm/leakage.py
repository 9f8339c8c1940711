"""Held-out items that leak into a corpus (problem 8): size-partitioned MinHash containment search with exact verification.

A leak is a run of at least ``run`` consecutive words of an item, in order and
without gap; an item of fewer words, down to ``least``, leaks as a whole.
Against a long document such a run is a tiny share of the shingles, so a
sketch of the whole document would miss it. The search is partitioned by size
instead:

1. Items are partitioned by the length of run that counts as a leak: ``run``
   words, or all words of a shorter item, so there are at most ``run``
   partitions. A run of r words has r - s + 1 shingles of s words, with s the
   smaller of ``shingle`` and r.
2. Every run of that length, in items and in documents, is a set of shingles
   that is sketched by its MinHash. A document holds a run of an item exactly
   if a run of its own contains all the shingles in their places, and then
   both have one MinHash, so no leak is missed. Runs that overlap share most
   of their minima, so a text gives far fewer sketches than it has words.
3. A bit set of the items' sketches is broadcast, at most ``BITS`` bits
   whatever the number of items. A document's sketches are looked up where the
   document is read; only those that meet the bit set are sent on.
4. These meet the items' sketches in a join, and are verified by the words
   around the shingle, as strings: a leak holds ``run`` equal words in a row.

Defined results: null or empty texts, and items of fewer than ``least`` words,
take no part; a document that repeats a run, or a row given twice, counts
once; whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textform
from strandloom.runtime import BROADCAST_ROWS, Scratch, spread

STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bits of the largest bit set (16 MB), and bits for each sketch below that.
BITS, BITS_A_SKETCH = 1 << 27, 64


def _shingles(hashes: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every shingle of ``size`` words, and whether it lies within one text."""
    n = max(hashes.size - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * STEP + hashes[j : j + n]
    return textform.mix(out ^ np.uint64(size)), row[:n] == row[size - 1 : size - 1 + n]


def _minima(hashes: np.ndarray, row: np.ndarray, run: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a shingle is the first minimum of some run of ``run`` words, and its hash mixed with the run's length."""
    size = min(shingle, run)
    window = run - size + 1
    value, _ = _shingles(hashes, row, size)
    n = hashes.size - run + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = value[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, window):
        less = value[j : j + n] < best
        best[less], at[less] = value[j : j + n][less], j
    inside = row[:n] == row[run - 1 :]
    place = np.unique((np.arange(n) + at)[inside])
    return place, textform.mix(value[place] + np.uint64(run))


def _context(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, place: np.ndarray, run: int, shingle: int) -> pa.Array:
    """The words around each shingle that a run with it can reach, in lower case; empty beyond the text."""
    size = min(shingle, run)
    reach = run - size
    width = size + 2 * reach
    at = place[:, None] + np.arange(-reach, size + reach)
    held = np.clip(at, 0, max(row.size - 1, 0))
    inside = (at == held) & (row[held] == row[place][:, None])
    length = np.where(inside, (ends - starts)[held], 0).ravel()
    offsets = np.zeros(length.size + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    letters = np.repeat(starts[held].ravel() - offsets[:-1], length) + np.arange(int(offsets[-1]))
    words = textform.to_arrow(textform.tables().lower[cps[letters]], offsets)
    return pa.ListArray.from_arrays(pa.array((np.arange(place.size + 1) * width).astype(np.int32)), words)


SKETCH = "id long, run int, sketch long, words array<string>"


def _sketches(runs: list[int], run: int, shingle: int, bits=None, of_items: bool = False):
    """Sketches of a table ``id, text``, of the given lengths of run; with a bit set, only those that meet it."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bits.value if bits is not None else None
        for batch in (b.slice(lo, hi - lo) for b in batches for lo, hi in textform.slices(b.column(1))):
            cps, ends_ = textform.canonical(batch.column(1))
            hashes, starts, ends, offsets = textform.words(cps, ends_)
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            count = np.diff(offsets)
            for r in runs:
                place, sketch = _minima(hashes, row, r, shingle)
                if of_items:  # a run shorter than ``run`` belongs to items of just that length
                    ok = (count[row[place]] == r) | (r == run)
                    place, sketch = place[ok], sketch[ok]
                if held is not None:
                    slot = sketch & np.uint64(held.size * 64 - 1)
                    met = (held[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
                    place, sketch = place[met], sketch[met]
                # a text that repeats itself sends each context once
                around = np.zeros(place.size, np.uint64)
                for j in range(-(r - min(shingle, r)), r):
                    at = np.clip(place + j, 0, max(row.size - 1, 0))
                    around = around * STEP + np.where(row[at] == row[place], hashes[at], 0).astype(np.uint64)
                _, first = np.unique(np.stack((row[place].astype(np.uint64), sketch, around)), axis=1, return_index=True)
                for lo in range(0, first.size, 20_000):
                    some = first[lo : lo + 20_000]
                    words = _context(cps, starts, ends, row, place[some], r, shingle)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[place[some]])), pa.array(np.full(some.size, r, np.int32)), pa.array(sketch[some].view(np.int64)), words], ["id", "run", "sketch", "words"])

    return go


def _bit_set(sketches: DataFrame, rows: int) -> np.ndarray:
    """A bit for every sketch, as machine words; their number is a power of two, at most ``BITS`` bits."""
    bits = 1 << 16
    while bits < BITS and bits < BITS_A_SKETCH * rows:
        bits *= 2
    slot = F.col("sketch").bitwiseAND(F.lit(bits - 1))
    words = sketches.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((sketch & {bits - 1}) & 63 as int))")).alias("mask")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy()] = words["mask"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def _texts(df: DataFrame, id: str, text: str) -> DataFrame:
    return df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", run: int = 10, shingle: int = 5, least: int | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, item_id``: documents that hold at least ``run`` consecutive words of an item, or all of a shorter one."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "leaks")
    runs = list(range(least or run, run + 1))
    held = _texts(items, item_id, item_text).mapInArrow(_sketches(runs, run, shingle, None, True), SKETCH)
    index, seen = scratch.counted(held.distinct(), "items")
    here = [r.run for r in index.select("run").distinct().collect()]  # at most ``run`` lengths
    bits = spark.sparkContext.broadcast(_bit_set(index, seen["rows"]))
    docs = spread(_texts(documents, doc_id, text)).mapInArrow(_sketches(sorted(here), run, shingle, bits), SKETCH)
    index = index.select(F.col("id").alias("item_id"), "run", "sketch", F.col("words").alias("item_words"))
    both = docs.withColumnRenamed("id", "doc_id").join(F.broadcast(index) if seen["rows"] <= broadcast_rows else index, ["run", "sketch"])
    # of the runs around the shingle, one has equal words throughout; empty places are equal to nothing
    same = F.zip_with("words", "item_words", lambda a, b: ((a == b) & (a != "")).cast("int"))
    reach = F.col("run") - F.least(F.lit(shingle), F.col("run"))
    whole = F.exists(F.sequence(F.lit(1), reach + 1), lambda k: ~F.array_contains(F.slice(F.col("same"), k, F.col("run")), 0))
    return both.withColumn("same", same).where(whole).select("doc_id", "item_id").distinct()


def _all_shingles(size: int, bits=None):
    """Two hashes of every distinct shingle of a table ``id, text``; texts of fewer words are one shingle."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bits.value if bits is not None else None
        for batch in (b.slice(lo, hi - lo) for b in batches for lo, hi in textform.slices(b.column(1))):
            hashes, _, _, offsets = textform.words(*textform.canonical(batch.column(1)))
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            value, inside = _shingles(hashes, row, size)
            second, _ = _shingles(textform.mix(hashes + np.uint64(3)), row, size)
            at = np.flatnonzero(inside)
            if held is not None:
                slot = value[at] & np.uint64(held.size * 64 - 1)
                at = at[(held[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0]
            table = np.unique(np.stack((row[at].astype(np.uint64), value[at], second[at])), axis=1)
            if table.shape[1]:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(table[0].astype(np.int64))), pa.array(table[1].view(np.int64)), pa.array(table[2].view(np.int64))], ["id", "sketch", "second"])

    return go


def containment(documents: DataFrame, items: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", shingle: int = 5) -> DataFrame:
    """``doc_id, item_id, shingles, held``: of the pairs ``found``, how many of the item's distinct shingles the document holds."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "containment")
    found = scratch.save(found.select("doc_id", "item_id").distinct(), "found")
    kind = "id long, sketch long, second long"
    own, seen = scratch.counted(_texts(items, item_id, item_text).mapInArrow(_all_shingles(shingle), kind).distinct(), "items")
    bits = spark.sparkContext.broadcast(_bit_set(own, seen["rows"]))
    leaked = found.select(F.col("doc_id").alias("id")).distinct()
    docs = spread(_texts(documents, doc_id, text).join(leaked, "id", "left_semi")).mapInArrow(_all_shingles(shingle, bits), kind).distinct()
    size = own.groupBy(F.col("id").alias("item_id")).agg(F.count("*").alias("shingles"))
    asked = found.join(own.withColumnRenamed("id", "item_id"), "item_id")
    met = asked.join(docs.withColumnRenamed("id", "doc_id"), ["doc_id", "sketch", "second"]).groupBy("doc_id", "item_id").agg(F.count("*").alias("held"))
    return found.join(size, "item_id").join(met, ["doc_id", "item_id"]).select("doc_id", "item_id", "shingles", "held")


def report(documents: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``item_id, documents``: how many documents each leaked item is in."""
    return leaks(documents, items, **options).groupBy("item_id").agg(F.count("*").alias("documents"))
