import random

from pyspark.sql import functions as F

from strandloom.operators.hotkeys import KeyChunks, list_items


def test_runs_equal_brute_force_and_chunks_are_equal(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}", rng.randrange(10**6)) for _ in range(3000)] + [(None, 5), ("one", 7)]
    df = spark.createDataFrame(rows, "key string, at long").withColumn("chunk", F.lit("clash"))
    chunks = KeyChunks(df, ["key"], "at", chunk_rows=100)
    got = {r.key: (r.n_rows, r.first, r.last, r.longest_gap) for r in chunks.runs().collect()}
    want = {}
    for key in {k for k, _ in rows if k}:
        at = sorted(v for k, v in rows if k == key)
        want[key] = (len(at), at[0], at[-1], max((b - a for a, b in zip(at, at[1:])), default=0))
    assert got == want
    assert {r.key: r.n_rows for r in chunks.merge_counts().collect()} == {k: v[0] for k, v in want.items()}
    sizes = [r["count"] for r in chunks.rows.where("key = 'hot'").groupBy("chunk").count().orderBy("chunk").collect()]
    assert set(sizes[:-1]) == {100} and 0 < sizes[-1] <= 100
    # the chunk size that follows from the rows cuts the hot key as well
    own = KeyChunks(df, ["key"], "at")
    assert own.rows.where("key = 'hot'").select("chunk").distinct().count() >= 7
    assert {r.key: (r.n_rows, r.first, r.last, r.longest_gap) for r in own.runs().collect()} == want


def test_empty_and_lists(spark):
    assert KeyChunks(spark.createDataFrame([], "key string, at long"), ["key"], "at").runs().count() == 0
    df = spark.createDataFrame([(" A,b, a ,,",), (None,), ("",)], "x string")
    assert [r.x for r in df.select(list_items("x").alias("x")).collect()] == [["a", "b"], None, []]
