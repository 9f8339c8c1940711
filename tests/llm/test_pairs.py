import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.llm import groups, neardup, neighbours, visual


def pairs(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


# --- problem 6 ---


def test_alike_pairs(spark):
    rows = [(1, "talk"), (2, "ｔａｌｋ"), (3, "talk"), (4, "Talk"), (5, None), (6, ""), (7, "​"), (2, "ｔａｌｋ"), (None, "talk")]
    df = spark.createDataFrame(rows, "key int, text string").withColumn("form", F.lit("clash"))
    assert pairs(visual.alike_pairs(df, "key", "text"), "key_a", "key_b") == {(1, 2), (2, 3), (6, 7)}
    assert visual.alike_pairs(df.where("false"), "key", "text").count() == 0


def test_alike_hot_group_keeps_every_link(spark, monkeypatch):
    monkeypatch.setattr(visual, "COPIES", 3)
    monkeypatch.setattr(visual, "CHUNK", 10)
    rows = [(i, "talk") for i in range(50)] + [(50 + i, "t" + "\u200b" * (i + 1) + "alk") for i in range(45)]
    df = spark.createDataFrame(rows, "key int, text string")
    got = pairs(visual.alike_pairs(df, "key", "text"), "key_a", "key_b")
    text = dict(rows)
    assert all(text[a] != text[b] for a, b in got)
    assert {x for p in got for x in p} == set(text)
    # all different strings are paired, copies beyond the limit are linked once
    assert {frozenset((text[a], text[b])) for a, b in got} == {frozenset((x, y)) for x in text.values() for y in text.values() if x != y}
    assert len(got) == 45 * 44 // 2 + 3 * 45 + 47
    classes = {r.key: (r.class_id, r.string_id, r.strings) for r in visual.alike_classes(df, "key", "text").collect()}
    assert classes == {k: (0, 0 if t == "talk" else k, 46) for k, t in rows}


# --- problem 7 ---


def jaccard_pairs(rows, least, share):
    sets = {}
    for tab, key, text in rows:
        if text is not None and key is not None:
            words = frozenset(re.findall(r"[^\W_]+", text.lower()))
            if len(words) >= least:
                sets[tab, key] = words
    items = sorted(sets.items())
    out = set()
    for i, ((ta, a), x) in enumerate(items):
        for (tb, b), y in items[i + 1 :]:
            if ta == tb and len(x & y) >= share * len(x | y):
                out.add((ta, a, b))
    return out


def texts(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(150)]
    rows = []
    for k in range(n):
        if rows and rng.random() < 0.5:
            words = rows[rng.randrange(len(rows))][2].split()
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[: rng.randrange(10, len(words) + 1)] + rng.sample(vocabulary, 3)
            rng.shuffle(words)
        else:
            words = rng.sample(vocabulary[:60], rng.randrange(12, 30))
        rows.append((k % 2, k, " ".join(words)))
    return rows


@pytest.mark.parametrize(("least", "share", "whole", "part"), [(14, Fraction(7, 10), 64, 20000), (5, Fraction(8, 10), 3, 20), (3, Fraction(1, 2), 3, 20)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, least, share, whole, part):
    monkeypatch.setattr(neardup, "WHOLE", whole)
    monkeypatch.setattr(neardup, "PART_ROWS", part)
    rows = texts(700, 5) + [(0, 9001, None), (0, 9002, ""), (1, None, "x y z")]
    df = spark.createDataFrame(rows, "tab int, key long, text string").withColumn("words", F.lit(1))
    found = neardup.NearDuplicates(df, least, share)
    want = jaccard_pairs(rows, least, share)
    assert pairs(found.pairs(), "tab", "key_a", "key_b") == want
    members = found.members().collect()
    assert len({(r.tab, r.key) for r in members}) == len(members)


def test_near_duplicates_tiny_and_large_sets(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(0, k, " ".join(rng.sample("abcdefg", rng.randrange(1, 4)))) for k in range(60)]
    df = spark.createDataFrame(rows, "tab int, key long, text string")
    for share in (Fraction(1, 2), Fraction(1, 3), Fraction(9, 10)):
        assert pairs(neardup.NearDuplicates(df, 1, share).pairs(), "tab", "key_a", "key_b") == jaccard_pairs(rows, 1, share)
    monkeypatch.setattr(neardup, "LARGE", 20)
    rows = texts(400, 6)
    df = spark.createDataFrame(rows, "tab int, key long, text string")
    assert pairs(neardup.NearDuplicates(df, 5, Fraction(7, 10)).pairs(), "tab", "key_a", "key_b") == jaccard_pairs(rows, 5, Fraction(7, 10))


def test_near_duplicates_very_long_text(spark):
    words = [f"w{i}" for i in range(30_000)]
    rows = [(0, 1, " ".join(words)), (0, 2, " ".join(words[:25_000])), (0, 3, " ".join(words[20_000:]))]
    assert pairs(neardup.NearDuplicates(spark.createDataFrame(rows, "tab int, key long, text string")).pairs(), "key_a", "key_b") == {(1, 2)}


def test_near_duplicates_copies_stay_linear(spark, monkeypatch):
    monkeypatch.setattr(neardup, "COPIES", 4)
    monkeypatch.setattr(neardup, "CHUNK", 10)
    base = " ".join(f"w{i}" for i in range(20))
    rows = [(0, k, base) for k in range(300)] + [(0, 300, base + " extra"), (0, 301, base + " extra")]
    # the same words in other strings are no copies: all of them are paired
    rows += [(0, 400 + k, base + "!" * (k + 1)) for k in range(40)]
    got = pairs(neardup.NearDuplicates(spark.createDataFrame(rows, "tab int, key long, text string")).pairs(), "key_a", "key_b")
    assert {x for p in got for x in p} == {r[1] for r in rows}
    text = {k: t for _, k, t in rows}
    assert {frozenset((text[a], text[b])) for a, b in got if text[a] != text[b]} == {frozenset((x, y)) for x in text.values() for y in text.values() if x != y}
    assert (0, 300) in got and (0, 299) in got and len(got) < 2000


def test_near_duplicates_long_texts(spark, monkeypatch):
    rng = random.Random(21)
    shared = [f"s{i}" for i in range(750)]
    rows = []
    for k in range(2000):
        own = [f"v{rng.randrange(40_000)}" for _ in range(750)]
        if k % 100 == 1:  # a near copy of the record before
            own = rows[-1][2].split()[750:]
            for _ in range(100):
                own[rng.randrange(750)] = f"v{rng.randrange(40_000)}"
        rows.append((0, k, " ".join(shared + own)))
    got = pairs(neardup.NearDuplicates(spark.createDataFrame(rows, "tab int, key long, text string").repartition(8)).pairs(), "key_a", "key_b")
    sets = [frozenset(t.split()) for _, _, t in rows]
    want = {(k, k + 1) for k in range(0, 2000, 100) if len(sets[k] & sets[k + 1]) >= 0.7 * len(sets[k] | sets[k + 1])}
    assert len(want) == 20 and got == want


def test_near_duplicates_across_bands_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BANDS", [(0, 128), (18, 256), (24, 512)])
    monkeypatch.setattr(neardup, "LARGE", 22)
    monkeypatch.setattr(neardup, "PART_ROWS", 15)
    rows = texts(500, 11)
    df = spark.createDataFrame(rows, "tab int, key long, text string")
    assert pairs(neardup.NearDuplicates(df, 5, Fraction(7, 10)).pairs(), "tab", "key_a", "key_b") == jaccard_pairs(rows, 5, Fraction(7, 10))


def test_table_of_words_shows_words_of_one_hash(monkeypatch):
    whole = neardup.textform.words

    def words(cps, offsets, seed=0):
        hashes, *rest = whole(cps, offsets, seed)
        return (hashes & np.uint64(31) if seed == 0 else hashes), *rest

    batch = neardup.pa.RecordBatch.from_arrays([neardup.pa.array([0], "int32"), neardup.pa.array([1]), neardup.pa.array([1]), neardup.pa.array([" ".join(f"w{i}" for i in range(50))])], ["tab", "key", "string", "text"])
    monkeypatch.setattr(neardup.textform, "words", words)
    for seed, same in ((0, True), (1, False)):
        table = next(iter(neardup._word_sets(1, seed)(iter([batch]))))
        assert table.column(0).null_count == table.num_rows
        assert (table.num_rows < 50) == same


def test_near_duplicates_empty(spark):
    empty = spark.createDataFrame([], "tab int, key long, text string")
    assert neardup.NearDuplicates(empty).pairs().count() == 0


def test_bit_sliced_counters():
    rng = np.random.default_rng(3)
    sig = rng.integers(0, 256, (200, 16)).astype(np.uint8)
    sig[50:60] = sig[0] ^ np.uint8(7)
    planes = neardup._planes(sig)
    bits = np.unpackbits(sig, axis=1, bitorder="little")
    query = np.repeat(np.arange(200), 4)
    word = np.tile(np.arange(4), 200)
    for radius in (0, 6, 60, 127):
        masks = np.where(bits.T > 0, ~np.uint64(0), np.uint64(0))
        alive, lanes = neardup.within_radius(planes, masks, word, query, np.full(query.size, radius))
        k, lane = np.nonzero(np.unpackbits(np.ascontiguousarray(lanes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        got = {(q, j) for q, j in zip(query[alive[k]].tolist(), (word[alive[k]] * 64 + lane).tolist()) if j < 200}
        dist = np.bitwise_count(sig[:, None] ^ sig[None]).sum(axis=2, dtype=int)
        assert got == {(a, b) for a, b in zip(*np.nonzero(dist <= radius))}


# --- problem 5 ---


def components(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a and b and a.strip() and b.strip() and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {(x, find(x)) for x in list(root)}


@pytest.mark.parametrize("frontiers", [24, 2])
def test_groups(spark, monkeypatch, frontiers):
    monkeypatch.setattr(groups, "FRONTIERS", frontiers)
    rng = random.Random(4)
    links = [(f"n{i:03}", f"n{i + 1:03}") for i in range(100)] + [("hub", f"s{i}") for i in range(40)] + [("hub", "n100")]
    links += [(f"r{rng.randrange(60)}", f"r{rng.randrange(60)}") for _ in range(50)] + [("b", "a"), ("a", "b"), ("q", "q"), (None, "z"), ("z", " ")]
    df = spark.createDataFrame(links, "a string, b string").withColumn("label", F.lit(0))
    assert pairs(groups.groups(df), "id", "group_id") == components(links)


def test_groups_empty(spark):
    assert groups.groups(spark.createDataFrame([], "a string, b string")).count() == 0
    assert groups.groups(spark.createDataFrame([("x", "x")], "a string, b string")).count() == 0


# --- problem 3 ---


def test_nearest(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 16))
    x = centres[rng.integers(0, 40, 800)] + 0.25 * rng.standard_normal((800, 16))
    x[700:] = x[0]  # a hot direction
    x[750:] *= 3
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0]), (904, [None] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash"))
    got = neighbours.nearest(df, k=5, dim=16, trees=6, leaf_rows=50, probes=24).toPandas()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    s = unit @ unit.T
    np.fill_diagonal(s, -2)
    kth = np.sort(s, axis=1)[:, -5]
    hits = sum(s[a, b] >= kth[a] - 1e-6 for a, b in zip(got.id, got.other))
    assert got.groupby("id").size().eq(5).all() and set(got.id) == set(range(800))
    assert hits / 4000 >= 0.9
    close = pairs(neighbours.close_pairs(df, k=5, floor=0.9, dim=16, trees=6, leaf_rows=50, probes=24), "vec_a", "vec_b")
    assert all(a < b and s[a, b] >= 0.9 - 1e-5 for a, b in close)
    asked = neighbours.nearest(df, k=5, dim=16, queries="vec_id % 50 = 0")
    assert {r.id for r in asked.select("id").distinct().collect()} == set(range(0, 800, 50))
    assert neighbours.nearest(df.where("vec_id >= 900"), dim=16).count() == 0


def test_queue_finds_the_leaves_of_a_full_search():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 8)).astype(np.float32)
    # fitted nodes end early here, so that random planes split on
    forest = neighbours.Forest(x[:200].astype(np.float64), 5000, 3, 40, 1)
    assert forest.extra > 0
    got, looked = forest.seek(x, 9)
    assert (got >= 0).all() and looked.max() < forest.leaves / 2

    def every(q):
        out, todo = {}, [(root, 0.0) for root in forest.roots]
        while todo:
            node, p = todo.pop()
            if node >= 0:
                side = q @ forest.planes[node] - forest.offsets[node]
                for kid in (0, 1):
                    todo.append((forest.kids[node][kid], p if kid == (side > 0) else min(p, -abs(side))))
                continue
            ends = [(-1 - node, p)]
            for d in range(forest.extra):
                top = -1 - node
                side = q @ forest.more[forest.tree[top], d] - forest.cuts[top, d]
                ends = [((leaf << 1) | bit, p if bit == (side > 0) else min(p, -abs(side))) for leaf, p in ends for bit in (0, 1)]
            out.update(ends)
        return out

    home = forest.home(x)
    for k in range(40):
        all_ = every(x[k])
        assert len(all_) == forest.leaves
        want = sorted(all_.values(), reverse=True)[:9]
        np.testing.assert_allclose(sorted((all_[leaf] for leaf in got[k]), reverse=True), want, atol=1e-5)
        assert {leaf for leaf, p in all_.items() if p == 0} == set(home[k])


def test_codes_bound_the_cosine():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((200, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y, error = neighbours.decoded(neighbours.coded(x))
    slack = error[:, None] * (1 + error)[None] + error[None]
    assert (np.abs(y @ y.T - x @ x.T) <= slack + 1e-6).all() and slack.max() < 0.05


def test_split_leaf_gives_the_same(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.standard_normal((300, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = neighbours.nearest(df, k=3, dim=8, trees=1, leaf_rows=1000, probes=1)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 32)
    two = neighbours.nearest(df, k=3, dim=8, trees=1, leaf_rows=1000, probes=1)
    assert pairs(one, "id", "other") == pairs(two, "id", "other")
