"""Exact vector operators: blocked top-k, weighted neighbours, duplicate vectors; pairs of near word sets.

Vectors that are null, of another length, not finite or all zero take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.hashing import vector_signature
from strandloom.operators.blocks import Shares, search
from strandloom.runtime import Scratch

#: Rows of a block of queries that is compared with a block of vectors at once.
QUERY_BLOCK = 1024
#: Rows of a part whose words are counted against each other at once, and cells of one table of counts.
PART_ROWS, PART_CELLS = 4096, 1 << 22
#: Rows that meet on one word, beyond which they meet on more words; rows of one chunk of a key.
HOT_ROWS, KEY_ROWS = 100, 2000


def usable(vector: str, dim: int) -> Column:
    """Whether a column is a vector of ``dim`` finite numbers that has a direction."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) == dim) & ~bad & F.exists(v, lambda x: x != 0)


def unit(vector: str) -> Column:
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(v, lambda x: x / norm)


def dot(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def _block_top(k: int, dim: int):
    """Top k of each query over the vectors of one block, without itself; rows come sorted by block, queries last."""

    def merge(x: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(ids, kind="stable")
        x, ids = x[order], ids[order]
        for lo in range(0, len(qids), QUERY_BLOCK):
            s = q[lo : lo + QUERY_BLOCK] @ x.T
            top = min(k + 1, len(ids))
            best = np.argsort(-s, axis=1, kind="stable")[:, :top]
            row, col = np.repeat(np.arange(s.shape[0]), top), best.ravel()
            other = ids[col] != qids[lo + row]
            row, col = row[other], col[other]
            yield pa.RecordBatch.from_arrays([pa.array(qids[lo + row]), pa.array(ids[col]), pa.array(s[row, col])], ["id", "other", "cosine"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        at = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held.get("x") and held.get("q"):
                yield from merge(*(np.concatenate(held[key]) for key in ("x", "i", "q", "j")))

        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column(0).to_numpy()
            asks = batch.column(1).to_numpy(zero_copy_only=False)
            ids = batch.column(2).to_numpy()
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), block.size]
            for a, b in zip(cuts, cuts[1:]):
                if at is not None and block[a] != at:
                    yield from flush()
                    held = {}
                at = block[a]
                for key, what, mask in (("x", x, ~asks), ("i", ids, ~asks), ("q", x, asks), ("j", ids, asks)):
                    held.setdefault(key, []).append(what[a:b][mask[a:b]])
        yield from flush()

    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, id: str, vector: str, dim: int, blocks: int | None = None) -> DataFrame:
    """``id, other, cosine, rank``: for every query its ``k`` nearest vectors, exactly; ties to the smaller id.

    A stated set of queries meets all vectors in blocks: each block of vectors
    gets all queries and answers with the best of its own; these are merged.
    """
    rows = vectors.where(usable(vector, dim)).select(F.col(id).cast("long").alias("id"), unit(vector).alias("v"))
    asks = queries.where(usable(vector, dim)).select(F.col(id).cast("long").alias("id"), unit(vector).alias("v"))
    many = blocks or vectors.sparkSession.sparkContext.defaultParallelism
    data = rows.select(F.pmod(F.xxhash64("id"), F.lit(many)).cast("long").alias("block"), F.lit(False).alias("asks"), "id", "v")
    ask = asks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))).alias("block"), F.lit(True).alias("asks"), "id", "v")
    both = data.union(ask).repartition(many, "block").sortWithinPartitions("block", "asks")
    near = both.mapInArrow(_block_top(k, dim), "id long, other long, cosine double")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "other"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k)


def neighbour_regression(near: DataFrame, values: DataFrame, power: int = 8, default: float = 10.0, own: DataFrame | None = None) -> DataFrame:
    """``id, estimate``: mean of the neighbours' values, weighted by the power of their cosine; without weight its own value, or else the default.

    ``near`` has ``id, other, cosine``, ``values`` has ``other, value``; ``own`` has
    ``id, value``. A row with a value may be its own neighbour.
    """
    w = F.pow(F.greatest(F.lit(0.0), F.col("cosine")), F.lit(power))
    sums = near.join(values, "other").groupBy("id").agg(F.sum(w).alias("w"), F.sum(w * F.col("value")).alias("wy"))
    out = near.select("id").distinct().join(sums, "id", "left")
    out = out.withColumn("value", F.lit(None).cast("double")) if own is None else out.join(own.select("id", F.col("value").cast("double").alias("value")), "id", "left")
    return out.select("id", F.when(F.col("w") > 0, F.col("wy") / F.col("w")).otherwise(F.coalesce("value", F.lit(default))).alias("estimate"))


def pooled_top_k(anchors: DataFrame, queries: DataFrame, k: int, dim: int) -> DataFrame:
    """``id, other, cosine, rank``: the nearest anchors of each query among those that share a topic with it, or among all if none does.

    ``anchors``: ``id, vec, topics``; ``queries``: ``id, vec, topics``; vectors are
    of ``dim`` numbers. A query that is an anchor itself is not left out. A pool
    of any size is met whole, by the exact search in blocks; no pair is joined.
    """
    scratch = Scratch(anchors.sparkSession, "pooled")
    topics = F.coalesce("topics", F.array().cast("array<string>")).alias("topics")
    a = scratch.save(anchors.where(usable("vec", dim)).select(F.lit(0).alias("list"), "id", "vec", topics), "anchors")
    q = queries.where(usable("vec", dim)).select("id", "vec", topics)
    known = a.select(F.explode("topics").alias("topic")).distinct()
    pooled = q.select("id", F.explode("topics").alias("topic")).join(known, "topic", "left_semi").select("id", F.lit(False).alias("alone")).distinct()
    q, seen = scratch.counted(q.join(pooled, "id", "left").withColumn("alone", F.coalesce("alone", F.lit(True))), "queries")
    near = search(a, q, seen["rows"], k, dim, Shares("topics", "alone"), itself=True)
    best = Window.partitionBy("id").orderBy(F.desc("cosine"), "other")
    return scratch.save(near.drop("bucket").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "near")


def duplicate_vectors(vectors: DataFrame, vector: str, id: str, least: int) -> DataFrame:
    """``signature, n, first_id``: vectors that more than ``least`` rows share to three decimals of their first 16 numbers."""
    return vectors.where(F.col(vector).isNotNull()).groupBy(vector_signature(vector).alias("signature")).agg(F.count("*").alias("n"), F.min(id).alias("first_id")).where(F.col("n") > least)


def _ordered(scratch: Scratch, base: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """The keys with ``ws``, the numbers of their words from the rarest to the commonest."""
    flat = base.select(*keys, F.explode(F.array_distinct(words)).alias("w"))
    df = scratch.save(flat.groupBy("w").agg(F.count("*").alias("df")).orderBy("df", "w").withColumn("no", F.monotonically_increasing_id()), "words")
    return flat.join(df, "w").groupBy(*keys).agg(F.sort_array(F.collect_list("no")).alias("ws"))


def _meeting(scratch: Scratch, each: DataFrame, keys: list[str], jaccard: float, firsts: int | None = None) -> DataFrame:
    """``keys, a, b``: pairs of ids that have the wanted Jaccard, none of which is lost; ``each`` has ``keys, id, ws``.

    A row of n words shares at least t = ceil(n * jaccard) words with a partner, so
    the first common word is among its first n - t + 1, the second among its first
    n - t + 2, and so on. Rows meet on the first common word; where more than
    ``HOT_ROWS`` do, on the first two, then on the first three. Rows that may share
    fewer words than that meet on these alone. ``firsts`` limits the place of the
    first common word. Rows bring their words along, so only true pairs leave the join.
    """
    from strandloom.functions import text as X

    n, t = F.size("ws"), F.ceil(F.size("ws") * F.lit(jaccard) - 1e-9).cast("int")
    here = [*keys, "key"]
    each = each.select(*keys, "id", "ws", n.alias("n"), t.alias("t"))
    most = F.col("n") - F.col("t") + 1
    first = F.slice("ws", F.lit(1), most if firsts is None else F.least(F.lit(firsts), most))
    keyed = scratch.save(each.select("*", F.posexplode(first).alias("at", "w")).withColumn("key", F.array("w")).drop("w"), "keyed")
    done, used = None, []
    for depth in (2, 3):
        hot = scratch.save(keyed.groupBy(*here).agg(F.count("*").alias("rows")).where(F.col("rows") > HOT_ROWS).drop("rows"), "hot")
        held = keyed.join(hot, here, "left_semi")
        stay = keyed.join(hot, here, "left_anti").union(held.where(F.col("t") < depth).withColumn("key", F.array_append("key", F.lit(-1).cast("long"))))
        stay = stay.select(*here, "id", "ws")
        done = stay if done is None else done.union(stay)
        left = F.col("n") - F.greatest("t", F.lit(depth)) + depth - F.col("at") - 1
        later = F.slice("ws", F.col("at") + 2, F.greatest(F.lit(0), left))
        used += [keyed, hot]
        held = held.select(*keys, "id", "ws", "n", "t", F.col("key").alias("k"), F.col("at").alias("from"), F.posexplode(later).alias("on", "w"))
        keyed = scratch.save(held.select(*keys, "id", "ws", "n", "t", (F.col("from") + F.col("on") + 1).alias("at"), F.array_append("k", F.col("w")).alias("key")), "keyed")
    done = scratch.save(done.union(keyed.select(*here, "id", "ws")), "done")
    scratch.drop(*used, keyed)
    # a key of many rows is cut into chunks, each of which meets all its rows
    chunks = done.groupBy(*here).agg(F.ceil(F.count("*") / KEY_ROWS).cast("int").alias("chunks"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    met = scratch.save(done.join(chunks, here), "met")
    scratch.drop(done)
    a = met.select(*here, F.col("id").alias("a"), F.col("ws").alias("wa"), F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"))
    b = met.select(*here, F.col("id").alias("b"), F.col("ws").alias("wb"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    na, nb = F.size("wa"), F.size("wb")
    near = (F.col("a") < F.col("b")) & (F.least(na, nb) >= F.greatest(na, nb) * F.lit(jaccard) - 1e-9) & (X.jaccard("wa", "wb") >= jaccard)
    return a.join(b, [*here, "chunk"]).where(near).select(*keys, "a", "b").distinct()


def bucket_pairs(rows: DataFrame, bucket: str, id: str, title: str, words: str, signature: str, jaccard: float = 0.7, biggest: int | None = None) -> DataFrame:
    """Pairs of rows of one bucket whose titles are near: Jaccard, a length ratio of at most 3, and an overlap of at least 0.4.

    Buckets of any size are searched, unless ``biggest`` limits them. A pair of the
    wanted Jaccard shares one of the rarest words of its smaller set, so pairs
    are found through a prefix of each row's words in order of frequency, not by
    crossing the bucket with itself; hot words are split by the words that follow.
    """
    from strandloom.functions import text as X

    scratch = Scratch(rows.sparkSession, "buckets")
    base = rows.select(F.col(bucket).alias("bucket"), F.col(id).alias("id"), F.col(title).alias("title"), F.col(words).alias("words"), F.col(signature).alias("sig")).where("bucket is not null and size(words) > 0")
    if biggest is not None:
        size = base.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") <= biggest).select("bucket")
        base = base.join(size, "bucket", "left_semi")
    base = scratch.save(base, "rows")
    pairs = _meeting(scratch, _ordered(scratch, base, ["bucket", "id"]), ["bucket"], jaccard)
    side = lambda s: base.select("bucket", F.col("id").alias(s), F.col("title").alias(f"t{s}"), F.col("words").alias(f"w{s}"), F.col("sig").alias(f"s{s}"))
    both = pairs.join(side("a"), ["bucket", "a"]).join(side("b"), ["bucket", "b"]).withColumn("jaccard", X.jaccard("wa", "wb"))
    la, lb = F.length("ta"), F.length("tb")
    ok = (F.col("jaccard") >= jaccard) & (F.greatest(la, lb) / F.greatest(F.lit(1), F.least(la, lb)) <= 3) & (F.coalesce(X.overlap("sa", "sb"), F.lit(1.0)) >= 0.4)
    return both.where(ok).select("a", "b", "jaccard").distinct()


def rare_word_pairs(rows: DataFrame, id: str, words: str, jaccard: float = 0.5, biggest: int | None = None) -> DataFrame:
    """``a, b, jaccard``: pairs that share one of their two rarest words and have the wanted Jaccard.

    Words that are the rarest of any number of rows count, unless ``biggest``
    limits them. The rarest common word of such a pair is among the two rarest of
    both, so rows meet on it, and where many do, together with the next common
    words; blocks are never crossed with themselves.
    """
    from strandloom.functions import text as X

    scratch = Scratch(rows.sparkSession, "rare")
    base = rows.select(F.col(id).alias("id"), F.col(words).alias("words"))
    each = scratch.save(_ordered(scratch, base, ["id"]).withColumn("top", F.slice("ws", 1, 2)), "ordered")
    pairs = _meeting(scratch, each, [], jaccard, 2)
    if biggest is not None:
        two = each.select("id", F.explode("top").alias("w"))
        block = two.groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") <= biggest).select("w")
        held = two.join(block, "w", "left_semi").groupBy("id").agg(F.collect_set("w").alias("top"))
        each = scratch.save(each.drop("top").join(held, "id"), "held")
    side = lambda s: each.select(F.col("id").alias(s), F.col("ws").alias(f"w{s}"), F.col("top").alias(f"t{s}"))
    full = pairs.join(side("a"), "a").join(side("b"), "b").where(F.arrays_overlap("ta", "tb"))
    return full.withColumn("jaccard", X.jaccard("wa", "wb")).select("a", "b", "jaccard")


def _common_words(gap: int, least: int, below: float, k: int):
    """Top k pairs of each pair of levels among the rows of one block, or between its two chunks; counts come from postings."""

    def pick(block: pa.Table) -> pa.Table:
        block = block.take(pa.compute.sort_indices(block, [("level", "ascending"), ("id", "ascending")])).combine_chunks()
        level, ids, chunk = (block[c].to_numpy() for c in ("level", "id", "chunk"))
        apart = block["c1"][0].as_py() != block["c2"][0].as_py()
        lists = block["words"].combine_chunks()
        size = np.asarray(pa.compute.list_value_length(lists))
        word = np.asarray(lists.flatten().dictionary_encode().indices).astype(np.int64)
        row = np.repeat(np.arange(len(ids)), size)
        by_word = np.argsort(word, kind="stable")
        posted, starts = row[by_word], np.searchsorted(word[by_word], np.arange(word.max() + 2))
        first = np.concatenate([[0], np.cumsum(size)])
        out = []
        step = max(1, PART_CELLS // len(ids))
        for lo in range(0, len(ids), step):
            hi = min(len(ids), lo + step)
            w, a = word[first[lo] : first[hi]], row[first[lo] : first[hi]] - lo
            n = starts[w + 1] - starts[w]
            ends, counts = np.cumsum(n), np.zeros((hi - lo) * len(ids), np.int32)
            at = 0
            while at < len(w):  # words in slices, so that the postings read at once are bounded
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART_CELLS, "right")))
                m = n[at:to]
                place = np.arange(m.sum()) + np.repeat(starts[w[at:to]] - (np.cumsum(m) - m), m)
                counts += np.bincount(np.repeat(a[at:to], m) * len(ids) + posted[place], minlength=len(counts)).astype(np.int32)
                at = to
            found = np.flatnonzero(counts >= least)
            src, dst, shared = found // len(ids) + lo, found % len(ids), counts[found]
            up = level[dst] - level[src]
            ok = (up >= 1) & (up <= gap) & (shared / (size[src] + size[dst] - shared) < below)
            if apart:
                ok &= chunk[src] != chunk[dst]
            out.append((src[ok], dst[ok], shared[ok]))
            if len(out) > 1 or hi == len(ids):  # a running top k
                src, dst, shared = (np.concatenate(x) for x in zip(*out))
                order = np.lexsort((ids[dst], ids[src], -shared, level[dst], level[src]))
                src, dst, shared = src[order], dst[order], shared[order]
                new = np.ones(len(src), bool)
                new[1:] = (level[src][1:] != level[src][:-1]) | (level[dst][1:] != level[dst][:-1])
                begin = np.maximum.accumulate(np.where(new, np.arange(len(src)), 0))
                top = np.arange(len(src)) - begin < k
                out = [(src[top], dst[top], shared[top])]
        src, dst, shared = out[0]
        part = pa.array([block["part"][0].as_py()] * len(src), pa.string())
        return pa.table({"part": part, "la": level[src], "lb": level[dst], "src": ids[src], "dst": ids[dst], "shared": shared.astype(np.int32)})

    return pick


def common_word_pairs(rows: DataFrame, part: str, level: str, id: str, words: str, gap: int, least: int, below: float, k: int) -> DataFrame:
    """``part, la, lb, src, dst, shared, rank``: of each part and two levels up to ``gap`` apart, the ``k`` pairs that share most words.

    A pair shares at least ``least`` words and has a Jaccard under ``below``.
    Every pair counts, whatever its words: the longest rows of a part are
    compared in full, and as no pair shares more words than its shorter row has,
    a row with fewer words than the k-th pair found shares can't be in a
    better one. What is left of a big part is cut into chunks, and each two
    chunks make a block.
    """
    scratch = Scratch(rows.sparkSession, "common")
    kind = "part string, la int, lb int, src long, dst long, shared int"
    pick = _common_words(gap, least, below, k)
    top = lambda df: df.groupBy("part", "c1", "c2").applyInArrow(pick, kind)
    base = rows.select(F.col(part).cast("string").alias("part"), F.col(level).cast("int").alias("level"), F.col(id).cast("long").alias("id"), F.array_distinct(words).alias("words"))
    base = scratch.save(base.where("part is not null and level is not null").withColumn("n", F.size("words")).where(F.col("n") >= least), "rows")
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("n"), "id"))
    zero = F.lit(0)
    longest = base.withColumn("place", place).where(F.col("place") <= PART_ROWS).select("part", "level", "id", "words", zero.alias("chunk"), zero.alias("c1"), zero.alias("c2"))
    one = scratch.save(top(longest), "longest")
    big = scratch.save(base.groupBy("part").agg(F.count("*").alias("rows")).where(F.col("rows") > PART_ROWS).select("part"), "big")
    held = base.join(big, "part", "left_semi")
    bound = one.groupBy("part", "la", "lb").agg(F.min("shared").alias("bound"), F.count("*").alias("found")).where(F.col("found") >= k).drop("found")
    levels = held.select("part", "level").distinct()
    both = levels.select("part", F.col("level").alias("la")).join(levels.select("part", F.col("level").alias("lb")), "part").where((F.col("lb") > F.col("la")) & (F.col("lb") <= F.col("la") + gap)).join(bound, ["part", "la", "lb"], "left")
    need = both.select("part", F.explode(F.array("la", "lb")).alias("level"), F.coalesce("bound", F.lit(least)).alias("need")).groupBy("part", "level").agg(F.min("need").alias("need"))
    held = scratch.save(held.join(need, ["part", "level"]).where("n >= need").drop("n", "need"), "held")
    chunks = held.groupBy("part").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("chunks"))
    cut = held.join(chunks, "part").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")).withColumn("x", F.explode(F.sequence(zero, F.col("chunks") - 1)))
    cut = cut.select("part", "level", "id", "words", "chunk", F.least("chunk", "x").alias("c1"), F.greatest("chunk", "x").alias("c2"))
    # a number given keeps blocks of few bytes but much work from being put into one task
    rest = top(cut.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part", "c1", "c2"))
    rank = F.row_number().over(Window.partitionBy("part", "la", "lb").orderBy(F.desc("shared"), "src", "dst"))
    return one.join(big, "part", "left_anti").union(rest).withColumn("rank", rank).where(F.col("rank") <= k)


def best_match(vectors: DataFrame, queries: DataFrame, floor: float, id: str, vector: str, dim: int) -> DataFrame:
    """``id, other, cosine``: the nearest vector of each query, if its cosine exceeds ``floor``."""
    return exact_top_k(vectors, queries, 1, id, vector, dim).where(F.col("cosine") > floor).drop("rank")


