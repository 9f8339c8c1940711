"""Most similar vectors (problem 3): a forest of random-projection trees, one shared queue, exact reranking.

* Vectors of one direction (to six decimals) form a class; one stands for it,
  and its copies are expanded at the end, so copies neither crowd a leaf nor
  multiply work.
* Trees are fitted on a bounded sample of ``FIT_ROWS`` directions: a node
  splits by the plane between two centres of its sample points. Where a node
  has fewer than ``FIT_LEAF`` points and still too many rows of the table, it is
  split on by random planes through its middle, one for each further depth of a
  tree. They take no room, so leaves grow in number with the table and hold
  ``leaf_rows`` vectors on average, while the forest that is broadcast is
  bounded by the sample. Every row is indexed.
* A query descends all trees with one queue of at most ``probes`` nodes: the
  priority of a node is the least of its margins against the query on its way.
  The near child keeps its parent's priority, so the nodes that a best-first
  search over all trees would pop are always among the ``probes`` first of a
  depth, and the queue can be cut there without loss.
* Ids go to the leaves with vectors of one byte a number and the length of the
  rounding error, which bounds every cosine from both sides. What can't be
  among the ``k`` best by these bounds is dropped in the leaf and once more per
  query; the few that are left are reranked by their exact cosine. A leaf that
  holds too many vectors is split into blocks, and its queries visit them all.

Defined results: vectors that are null, of another length than ``dim``, hold
nulls, NaN or infinities, or are all zero take no part; ties in cosine go to
the smaller id; an id given twice counts once (its smallest vector).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm import textform
from strandloom.runtime import BROADCAST_ROWS, Scratch, spread

#: Directions that the trees are fitted on at most; those of smallest hash.
FIT_ROWS = 20_000
#: Sample points of a node below which its planes are no longer fitted; nodes of a tree are at most FIT_ROWS / FIT_LEAF.
FIT_LEAF = 16
BLOCK_ROWS = 8_192
#: Trees, vectors of a leaf on average, and leaves that a query searches for each depth of a tree.
TREES, LEAF_ROWS, PROBES_A_DEPTH = 8, 256, 5


def _flat(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are vectors of ``dim`` numbers, and the vectors."""
    n = len(column)
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(size == dim)
    values = column.take(pa.array(rows)).flatten().cast(pa.float64())
    null = values.is_null().to_numpy(zero_copy_only=False) if values.null_count else None
    x = values.fill_null(np.nan).to_numpy(zero_copy_only=False) if null is not None else values.to_numpy(zero_copy_only=False)
    x = x.reshape(-1, dim)
    norm = np.sqrt((x * x).sum(axis=1))
    ok = np.isfinite(norm) & (norm > 0)
    return rows[ok], x[ok] / norm[ok, None]


def _units(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, x = _flat(batch.column(1), dim)
            if not rows.size:
                continue
            grid = np.rint(x * 1e6).astype(np.int64).astype(np.uint64)
            a = np.zeros(rows.size, np.uint64)
            b = np.full(rows.size, 7, np.uint64)
            for j in range(dim):
                a = textform.mix(a * textform.BASE + grid[:, j])
                b = textform.mix(b + grid[:, j] * textform.BASE_INVERSE + np.uint64(j))
            blob = np.ascontiguousarray(x.astype("<f4")).view(np.uint8).reshape(-1)
            vec = pa.Array.from_buffers(pa.binary(), rows.size, [None, pa.py_buffer((np.arange(rows.size + 1) * 4 * dim).astype(np.int32)), pa.py_buffer(blob)])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), vec], ["id", "da", "db", "vec"])

    return run


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of one width, [row, byte]."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, width)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return _bytes(column, 4 * dim).view("<f4")


def coded(x: np.ndarray) -> np.ndarray:
    """Unit vectors in one byte a number: scale, length of the rounding error, codes."""
    scale = np.abs(x).max(axis=1) / 127
    code = np.rint(x / scale[:, None])
    error = np.sqrt(((x - code * scale[:, None]) ** 2).sum(axis=1)) + 1e-6
    out = np.zeros((x.shape[0], 8 + x.shape[1]), np.uint8)
    out[:, :4] = scale.astype("<f4")[:, None].view(np.uint8)
    out[:, 4:8] = error.astype("<f4")[:, None].view(np.uint8)
    out[:, 8:] = code.astype(np.int8).view(np.uint8)
    return out


def decoded(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rounded vectors and the lengths of their errors."""
    head = np.ascontiguousarray(data[:, :8]).view("<f4")
    return data[:, 8:].view(np.int8).astype(np.float32) * head[:, :1], head[:, 1]


class Forest:
    """Planes and children of all trees; a child below 0 is the fitted leaf ``-1 - child``, which ``extra`` random planes split on."""

    def __init__(self, sample: np.ndarray, rows: int, trees: int, leaf_rows: int, seed: int):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        planes, offsets, kids, centres, tree_of = [], [], [], [], []
        self.roots: list[int] = []
        want = max(1, -(-rows // leaf_rows))

        def plane_of(points: np.ndarray) -> tuple[np.ndarray, float] | None:
            for _ in range(3):
                # two centres, moved a few times to the middle of their halves
                i, j = rng.choice(len(points), 2, replace=False)
                p, q = points[i], points[j]
                for _ in range(3):
                    near = points @ (p - q) > ((p * p).sum() - (q * q).sum()) / 2
                    if near.all() or not near.any():
                        break
                    p, q = points[near].mean(axis=0), points[~near].mean(axis=0)
                size = np.sqrt(((p - q) ** 2).sum())
                if size < 1e-6:
                    continue
                normal = (p - q) / size
                side = points @ normal
                cut = float(np.median(side))
                if (side > cut).any() and (side <= cut).any():
                    return normal, cut
            return None

        def grow(points: np.ndarray, share: float) -> int:
            found = plane_of(points) if share * want > 1.0 and len(points) >= max(2, FIT_LEAF) else None
            if found is None:
                centres.append(points.mean(axis=0) if len(points) else np.zeros(self.dim))
                tree_of.append(len(self.roots))
                return -len(centres)
            me = len(planes)
            planes.append(found[0].astype(np.float32))
            offsets.append(found[1])
            kids.append([0, 0])
            side = points @ found[0] > found[1]
            kids[me][0] = grow(points[~side], share / 2)
            kids[me][1] = grow(points[side], share / 2)
            return me

        for _ in range(trees):
            self.roots.append(grow(sample, 1.0))
        self.planes = np.array(planes, np.float32).reshape(-1, self.dim)
        self.offsets = np.array(offsets, np.float32)
        self.kids = np.array(kids, np.int64).reshape(-1, 2)
        self.tree = np.array(tree_of, np.int64)
        # further depths: as many as the fullest trees need
        fitted = np.bincount(self.tree, minlength=trees).min() if trees else 1
        self.extra = max(0, int(np.ceil(np.log2(want / max(1, fitted)) - 1e-9)))
        more = rng.standard_normal((trees, self.extra, self.dim))
        self.more = (more / np.sqrt((more * more).sum(axis=2, keepdims=True))).astype(np.float32)
        middle = np.array(centres, np.float32).reshape(-1, self.dim)
        self.cuts = np.einsum("ld,led->le", middle, self.more[self.tree]).astype(np.float32)
        self.leaves = len(centres) << self.extra

    def seek(self, x: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """The leaves of the ``probes`` highest priorities over all trees, [query, probe], -1 where there are fewer; and the nodes looked at."""
        n = x.shape[0]
        node = np.tile(np.array(self.roots, np.int64), (n, 1))
        rank = np.zeros(node.shape, np.float32)
        looked = np.zeros(n, np.int64)
        row = np.arange(n)[:, None]

        def cut(node: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if node.shape[1] <= probes:
                return node, rank
            best = np.argpartition(-rank, probes - 1, axis=1)[:, :probes]
            return node[row, best], rank[row, best]

        node, rank = cut(node, rank)
        while ((node >= 0) & (rank > -np.inf)).any():
            inner = (node >= 0) & (rank > -np.inf)
            q, at = np.nonzero(inner)
            looked += inner.sum(axis=1)
            which = node[q, at]
            side = np.einsum("ij,ij->i", x[q], self.planes[which]) - self.offsets[which]
            right = (side > 0).astype(np.int64)
            far_node, far_rank = np.full(node.shape, -1), np.full(node.shape, -np.inf, np.float32)
            far_node[q, at] = self.kids[which, 1 - right]
            far_rank[q, at] = np.minimum(rank[q, at], -np.abs(side))
            node[q, at] = self.kids[which, right]
            node, rank = cut(np.concatenate((node, far_node), axis=1), np.concatenate((rank, far_rank), axis=1))
        leaf = np.where(rank > -np.inf, -1 - node, 0)
        for depth in range(self.extra):
            top = leaf >> depth
            side = np.einsum("qd,qpd->qp", x, self.more[self.tree[top], depth]) - self.cuts[top, depth]
            looked += (rank > -np.inf).sum(axis=1)
            near = (leaf << 1) | (side > 0)
            leaf, rank = cut(np.concatenate((near, near ^ 1), axis=1), np.concatenate((rank, np.where(rank > -np.inf, np.minimum(rank, -np.abs(side)), -np.inf)), axis=1))
        return np.where(rank > -np.inf, leaf, -1), looked

    def home(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree, [vector, tree]."""
        out = np.empty((x.shape[0], len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            node = np.full(x.shape[0], root)
            while (inner := np.flatnonzero(node >= 0)).size:
                n = node[inner]
                side = np.einsum("ij,ij->i", x[inner], self.planes[n]) > self.offsets[n]
                node[inner] = self.kids[n, side.astype(np.int64)]
            leaf = top = -1 - node
            for depth in range(self.extra):
                leaf = (leaf << 1) | (x @ self.more[t, depth] > self.cuts[top, depth])
            out[:, t] = leaf
        return out


#: Queries that descend at once.
STEP = 2_048


def _visits(held, dim: int, probes: int, blocks):
    """A row per leaf that a vector lives in (role bit 1) or searches (role bit 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, many = held.value, blocks.value
        for whole in batches:
            for batch in (whole.slice(at, STEP) for at in range(0, whole.num_rows, STEP)):
                x, asks = _matrix(batch.column(2), dim), batch.column(1).to_numpy(zero_copy_only=False)
                ids = batch.column(0).to_numpy()
                home = forest.home(x)
                who = np.flatnonzero(asks)
                best = forest.seek(x[who], probes)[0] if who.size else np.zeros((0, 1), np.int64)
                rows = np.concatenate((np.repeat(np.arange(x.shape[0]), home.shape[1]), np.repeat(who, best.shape[1])))
                leaf = np.concatenate((home.ravel(), best.ravel()))
                role = np.repeat([1, 2], [home.size, best.size])
                rows, leaf, role = rows[leaf >= 0], leaf[leaf >= 0], role[leaf >= 0]
                # a split leaf: a vector lives in one block, a query visits all
                split = many["leaf"]
                count = np.ones(leaf.size, np.int64)
                if split.size:
                    at = np.minimum(np.searchsorted(split, leaf), split.size - 1)
                    count = np.where(split[at] == leaf, many["blocks"][at], 1)
                times = np.where(role == 1, 1, count)
                own = (textform.mix(ids[rows].astype(np.uint64)) % count.astype(np.uint64)).astype(np.int64)
                again = np.repeat(np.arange(rows.size), times)
                block = np.where(role[again] == 1, own[again], np.arange(again.size) - np.repeat(np.cumsum(times) - times, times))
                leaf, rows, role = leaf[again], rows[again], role[again]
                order = np.lexsort((rows, block, leaf))
                leaf, block, rows, role = leaf[order], block[order], rows[order], role[order]
                new = np.flatnonzero(np.concatenate(([True], (leaf[1:] != leaf[:-1]) | (block[1:] != block[:-1]) | (rows[1:] != rows[:-1]))))
                role = np.bitwise_or.reduceat(role, new)
                leaf, block, rows = leaf[new], block[new], rows[new]
                codes = coded(x.astype(np.float64))
                for c in range(0, rows.size, 50_000):
                    some = rows[c : c + 50_000]
                    data = np.ascontiguousarray(codes[some]).reshape(-1)
                    packed = pa.Array.from_buffers(pa.binary(), some.size, [None, pa.py_buffer((np.arange(some.size + 1) * (8 + dim)).astype(np.int32)), pa.py_buffer(data)])
                    yield pa.RecordBatch.from_arrays([pa.array(leaf[c : c + 50_000]), pa.array(block[c : c + 50_000].astype(np.int32)), pa.array(role[c : c + 50_000].astype(np.int8)), batch.column(0).take(pa.array(some)), packed], ["leaf", "block", "role", "id", "code"])

    return run


def _leaf_sizes(held, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf, n = np.unique(held.value.home(_matrix(batch.column(0), dim)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(n)], ["leaf", "n"])

    return run


def _shortlist(dim: int, k: int, floor: float):
    """Of each query in each leaf, those that can be among the best k; rows are sorted by leaf and block."""

    def best(ids: np.ndarray, role: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        data, asks = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
        if not data.size or not asks.size:
            return
        x, error = decoded(codes)
        y, ey = x[data], error[data]
        for lo in range(0, asks.size, 1024):
            q = asks[lo : lo + 1024]
            s = x[q] @ y.T
            # both rounded vectors are off by no more than their errors
            slack = error[q][:, None] * (1 + ey)[None, :] + ey[None, :]
            low, high = s - slack, s + slack
            self_ = ids[q][:, None] == ids[data][None, :]
            low[self_], high[self_] = -3, -3
            if data.size > k:
                kth = -np.partition(-low, k - 1, axis=1)[:, k - 1]
                row, col = np.nonzero((high >= kth[:, None]) & (high >= floor) & ~self_)
            else:
                row, col = np.nonzero((high >= floor) & ~self_)
            if row.size:
                yield pa.RecordBatch.from_arrays([pa.array(ids[q[row]]), pa.array(ids[data[col]]), pa.array(low[row, col]), pa.array(high[row, col])], ["id", "other", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((leaf[1:] != leaf[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), leaf.size]
            parts = (batch.column(3).to_numpy(), batch.column(2).to_numpy(), _bytes(batch.column(4), 8 + dim))
            for a, b in zip(cuts, cuts[1:]):
                if held and at != (leaf[a], block[a]):
                    yield from best(*(np.concatenate(p) for p in zip(*held)))
                    held = []
                at = (leaf[a], block[a])
                held.append(tuple(p[a:b] for p in parts))
        if held:
            yield from best(*(np.concatenate(p) for p in zip(*held)))

    return run


def _exact(dim: int):
    """The exact cosine of pairs of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _matrix(batch.column(2), dim).astype(np.float64), _matrix(batch.column(3), dim).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.einsum("ij,ij->i", x, y))], ["id", "other", "cosine"])

    return run


def nearest(vectors: DataFrame, k: int = 10, id: str = "vec_id", vector: str = "embedding", queries: str = "true", floor: float = -1.0, dim: int = 64, trees: int = TREES, leaf_rows: int = LEAF_ROWS, probes: int | None = None, seed: int = 5) -> DataFrame:
    """``id, other, cosine``: the ``k`` others of highest cosine for every vector that satisfies the condition ``queries`` on ``id``.

    With ``floor``, of these only the ones whose cosine reaches it; candidates
    below it are then dropped in the leaf. Without ``probes``, their number
    grows with the depth of the trees, as ``PROBES_A_DEPTH``.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    context = spark.sparkContext
    rows = spread(vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null"))
    units, seen = scratch.counted(rows.mapInArrow(_units(dim), "id long, da long, db long, vec binary"), "units")
    all_units = seen["rows"]
    asked = units.select("id", "da", "db").groupBy("id").agg(F.min(F.struct("da", "db")).alias("d")).select("id", "d.da", "d.db")
    asked, seen = scratch.counted(asked.withColumn("asks", F.expr(queries.replace(id, "id"))), "ids")
    repeated = all_units > seen["rows"]
    direction = ["da", "db"]
    classes = asked.groupBy(direction).agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.max(F.col("asks").cast("int")).alias("asks"))
    classes, seen = scratch.counted(classes, "classes", asking=F.count_if(F.col("asks") == 1))
    size, asking = seen["rows"], seen["asking"]
    if not size:
        return spark.createDataFrame([], "id long, other long, cosine double")
    # one row per class: the others are few and sent along, or, if they are many, joined
    spare, seen = scratch.counted(asked.join(classes.where("copies > 1"), direction).where("id <> rep").select("id"), "spare")
    n_spare = seen["rows"]
    reps = units
    if repeated:  # of an id given twice, the smallest vector
        reps = units.join(asked.select("id", "da", "db"), ["id", "da", "db"], "left_semi").dropDuplicates(["id"])
    if n_spare:
        reps = reps.join(F.broadcast(spare) if n_spare <= BROADCAST_ROWS else spare, "id", "left_anti")
    reps = reps.select("id", "vec")
    # a class asks if any of its members does
    if asking == size:
        sent = reps.select("id", F.lit(True).alias("asks"), "vec")
    else:
        askers = classes.where("asks = 1").select(F.col("rep").alias("id"), F.lit(True).alias("asks"))
        sent = reps.join(F.broadcast(askers) if asking <= BROADCAST_ROWS else askers, "id", "left").select("id", F.coalesce("asks", F.lit(False)).alias("asks"), "vec")
    sample = units.select("vec", F.xxhash64("da", "db").alias("h")).orderBy("h").limit(FIT_ROWS).select("vec").toArrow()
    sample = np.unique(np.concatenate([_matrix(chunk, dim) for chunk in sample["vec"].chunks if len(chunk)]), axis=0)
    forest = Forest(sample.astype(np.float64), size, trees, leaf_rows, seed)
    probes = probes or PROBES_A_DEPTH * max(1, int(np.ceil(np.log2(forest.leaves / trees))))
    held = context.broadcast(forest)
    # leaves that hold more than a block: at most rows / BLOCK_ROWS of each tree
    big = reps.select("vec").mapInArrow(_leaf_sizes(held, dim), "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).where(F.col("n") > BLOCK_ROWS).orderBy("leaf").toArrow()
    blocks = context.broadcast({"leaf": big["leaf"].to_numpy(), "blocks": -(-big["n"].to_numpy() // BLOCK_ROWS)})
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), context.defaultParallelism)
    visits = sent.mapInArrow(_visits(held, dim, probes, blocks), "leaf long, block int, role byte, id long, code binary")
    short = visits.repartition(tasks, "leaf", "block").sortWithinPartitions("leaf", "block").mapInArrow(_shortlist(dim, k, floor), "id long, other long, low float, high float")
    short = short.groupBy("id", "other").agg(F.max("low").alias("low"), F.min("high").alias("high"))
    # a pair that k others surely surpass is out
    by_low = Window.partitionBy("id").orderBy(F.desc("low"), "other")
    short = short.withColumn("r", F.row_number().over(by_low)).withColumn("kth", F.max(F.when(F.col("r") == k, F.col("low"))).over(Window.partitionBy("id")))
    short = scratch.save(short.where("kth is null or high >= kth").select("id", "other"), "short")
    ends = short.join(reps, "id").select("id", "other", F.col("vec").alias("x")).join(reps.select(F.col("id").alias("other"), F.col("vec").alias("y")), "other").select("id", "other", "x", "y")
    top = lambda by: Window.partitionBy(by).orderBy(F.desc("cosine"), "other")
    close = ends.mapInArrow(_exact(dim), "id long, other long, cosine double").where(F.col("cosine") >= floor)
    close = close.withColumn("r", F.row_number().over(top("id"))).where(F.col("r") <= k).drop("r")
    if not n_spare:
        return close
    close = scratch.save(close, "close")
    # copies: a class is as near as its representative, its members to one another at cosine 1
    several = classes.where("copies > 1").select(*direction, "rep")
    member = asked.join(several, direction).select("rep", "id", F.col("asks"), F.row_number().over(Window.partitionBy(*direction).orderBy("id")).alias("m"))
    member = scratch.save(member, "members")
    few = member.where(F.col("m") <= k + 1).select("rep", F.col("id").alias("member"))
    own = member.where("m = 1").select("rep", F.col("rep").alias("other"), F.lit(1.0).alias("cosine"))
    lists = close.withColumnRenamed("id", "rep").unionByName(own)
    wide = lists.join(few.withColumnRenamed("rep", "other"), "other", "left").select("rep", F.coalesce("member", "other").alias("other"), "cosine")
    wide = wide.withColumn("r", F.row_number().over(top("rep"))).where(F.col("r") <= k + 1).drop("r")
    wide = scratch.save(wide, "wide")
    out = wide.join(member.select("rep", "id", "asks"), "rep", "left").where("asks is null or asks").select(F.coalesce("id", "rep").alias("id"), "other", "cosine").where("id <> other")
    return out.withColumn("r", F.row_number().over(top("id"))).where(F.col("r") <= k).drop("r")


def close_pairs(vectors: DataFrame, k: int = 10, floor: float = 0.9, **options) -> DataFrame:
    """``vec_a`` < ``vec_b``: one is among the ``k`` nearest of the other, and their cosine is at least ``floor``."""
    near = nearest(vectors, k=k, floor=floor, **options)
    return near.select(F.least("id", "other").alias("vec_a"), F.greatest("id", "other").alias("vec_b")).distinct()
