"""Searches in blocks against brute force, and the guard of slots against its conditions on columns."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandloom.operators import blocks as B
from strandloom.operators import candidates as K
from strandloom.operators import similarity as S
from strandloom.operators.lists_index import ListIndex
from strandloom.runtime import Scratch


def table(ids, x, **more):
    return pa.table({"list": pa.array(np.zeros(len(ids), np.int32)), "id": pa.array(ids, pa.int64()), "vec": pa.array([[float(y) for y in v] for v in x], pa.list_(pa.float32())), **more})


def unit(x):
    x = x.astype(np.float32).astype(float)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def test_blocks_of_any_size_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.integers(-2, 3, (200, 6)) + 0.5  # with equal vectors
    words = [[], ["a"], ["b", "b"], ["a", "c"], ["d", None], None]
    topics = [words[rng.integers(6)] for _ in range(200)]
    free = [bool(k % 7 == 0) for k in range(200)]
    rows = table(range(200), x, topics=pa.array(topics, pa.list_(pa.string())))
    asked = table(range(0, 200, 3), x[::3], topics=pa.array(topics[::3], pa.list_(pa.string())), free=pa.array(free[::3]))
    u = unit(x)
    want = {}
    for q in range(0, 200, 3):
        mine = {t for t in topics[q] or [] if t}
        pool = [j for j in range(200) if free[q] or mine & {t for t in topics[j] or [] if t}]
        want[q] = sorted(pool, key=lambda j: (-(u[q] * u[j]).sum(), j))[:4]
    for sizes in ({}, {"BLOCK": 5, "SLICE": 7, "PAIRS": 11, "CELLS": 64}):
        for name, value in sizes.items():
            monkeypatch.setattr(B, name, value)
        search = B._Search(asked, 4, 6, B.Shares("topics", "free"), True, None, 1)
        got = {}
        for batch in search.run(iter(rows.to_batches(max_chunksize=90))):
            for r in batch.to_pylist():
                got.setdefault(r["id"], []).append((-r["cosine"], r["other"]))
        assert {q: [o for _, o in sorted(v)] for q, v in got.items()} == {q: v for q, v in want.items() if v}


def test_rounds_of_lists(spark, monkeypatch):
    monkeypatch.setattr(B, "HELD", 9)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 8))
    names = [f"n{k % 4}" if k % 11 else None for k in range(300)]
    v = spark.createDataFrame([(k, names[k], [float(y) for y in x[k]]) for k in range(300)], "id long, name string, vec array<float>")
    index = ListIndex(v, "id", "vec", 8, {"other": "name"})
    lists = dict(index.rows.select("id", "list").collect())
    u = unit(x)
    for k, probe in ((3, 2), (25, 1), (3, 10**6)):
        got = {}
        for r in index.top(v.where("id % 10 = 0").withColumn("own", F.col("name")), k, "id", "vec", probe, B.Differs("own", "other")).collect():
            got.setdefault(r.id, []).append((r["rank"], r.other))
        for q in range(0, 300, 10):
            near = np.argsort(-(u[q] @ index.centroids.T), kind="stable").tolist()
            upto = probe
            while True:
                pool = [j for j in range(300) if j != q and names[j] != names[q] and lists[j] in near[:upto]]
                if len(pool) >= k or upto >= len(near):
                    break
                upto *= 2
            assert [o for _, o in sorted(got[q])] == sorted(pool, key=lambda j: (-(u[q] * u[j]).sum(), j))[:k]


def test_guard_of_slots_equals_columns(spark):
    rng = random.Random(6)
    some = lambda *xs: [x for x in xs if rng.random() < 0.4]
    kind = "id string, raw double, band int, topics array<string>, start int, end int, occupations array<string>, sources array<string>, tags string, pathological boolean"
    topics = ["geometry-circles", "algebra-numbers", "circles-numbers-plane", "sced-standards", "x-framework", "tiny"]
    data = [
        (rng.choice(["time-management-", "python-", "geometry-", "numbers-", "s-"]) + str(k), float(rng.randrange(8)), rng.randrange(4), some(*topics) or rng.choice([None, ["sced-standards"]]), rng.choice([None, 3, 8]), rng.choice([None, 2, 9]), some("clerk", "cook") or None,
         some("a", "b", "esco"), rng.choice([None, "skillsengland:level:2", "skillsengland:level:6", "sced:catalog"]), rng.random() < 0.1)
        for k in range(70)
    ]
    language = lambda c: F.when(c.startswith("python"), "python").when(c.startswith("numbers"), "r")
    p = K.profiles(spark.createDataFrame(data, kind), language, ["geometry-2", "numbers-3", data[5][0]]).withColumn("key", F.regexp_extract("id", r"(\d+)$", 1).cast("long")).cache()
    x = np.random.default_rng(6).standard_normal((70, 8))
    v = spark.createDataFrame([(k, [float(y) for y in x[k]]) for k in range(70)], "key long, vector array<double>")
    taken = F.array(F.lit(data[9][0]), F.lit(data[20][0]), F.lit("unknown"))
    fields = [c for c in p.columns if c != "key"]
    both = p.select("key", F.struct(*fields).alias("d")).crossJoin(p.select(F.col("key").alias("other"), F.struct(*fields).alias("c")))
    linked = F.exists("d.topic_tokens", lambda t: F.exists("c.topic_tokens", lambda s: F.arrays_overlap(t, s)))
    pools = {"inside": F.arrays_overlap("d.topics", "c.topics") & K.akin("d", "c"), "wide": F.lit(True), "far": linked & K.across("d", "c")}
    index = ListIndex(v, "key", "vector", 8)
    described = index.described(K.SlotGuard.columns(p).select(F.col("key").alias("id"), *K.SlotGuard.has))
    asked = K.SlotGuard.columns(p).join(v, "key").withColumn("taken", taken)
    for pool, condition in pools.items():
        want = {tuple(r) for r in both.where(K.admissible("d", "c") & condition & ~F.array_contains(taken, F.col("c.id"))).select("key", "other").collect()}
        got = index.top(asked, 70, "key", "vector", 100, K.SlotGuard(pool, True), described).select("id", "other").collect()
        assert len(want) > 20 and len(got) == len(want) and {tuple(r) for r in got} == want


@pytest.mark.parametrize("which", ["index", "pooled"])
def test_pairs_are_never_joined(spark, monkeypatch, which):
    """Every query met every vector in a join, with both vectors in each row."""
    plans, save = [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, label="t": plans.append(df._jdf.queryExecution().analyzed().toString()) or save(self, df, label))
    x = np.random.default_rng(1).standard_normal((50, 8))
    df = spark.createDataFrame([(k, [float(y) for y in x[k]], ["t"]) for k in range(50)], "id long, vec array<float>, topics array<string>")
    if which == "index":
        got = ListIndex(df, "id", "vec", 8).top(df.where("id < 5"), 3, "id", "vec", 10**6)
    else:
        got = S.pooled_top_k(df, df.where("id < 5"), 3, 8)
    assert got.count() == 15
    near = [p for p in plans if "cosine" in p]
    assert near and not any("Join" in p for p in near)
