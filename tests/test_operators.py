import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.operators import calibrate as C
from strandloom.operators import graph as G
from strandloom.operators import relational as R
from strandloom.operators import similarity as S


def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs) or [], "dep string, pre string")


def rows(df):
    return {tuple(r) for r in df.collect()}


def random_dag(n, m, seed):
    rng = random.Random(seed)
    out = set()
    while len(out) < m:
        a, b = sorted(rng.sample(range(n), 2))
        out.add((f"n{b:03}", f"n{a:03}"))
    return sorted(out)


def brute_closure(pairs):
    up = {}
    for d, p in pairs:
        up.setdefault(d, set()).add(p)
    out = set()
    for d in up:
        todo, seen = list(up[d]), set()
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += up.get(x, ())
        out |= {(d, a) for a in seen}
    return out


def test_closure_levels_reduction(spark):
    pairs = random_dag(40, 90, 1)
    e = edges(spark, *pairs, (None, "x"), ("y", "y"), pairs[0])
    known = G.closure(e)
    assert rows(known) == brute_closure(pairs)
    level = {r.id: r.level for r in G.topo_levels(e).collect()}
    assert all(level[d] > level[p] for d, p in pairs)
    assert all(level[d] == 0 or max(level[p] for x, p in pairs if x == d) == level[d] - 1 for d in level)
    reduced = rows(G.transitive_reduction(e))
    assert brute_closure(reduced) == brute_closure(pairs)
    assert all(brute_closure(reduced - {x}) != brute_closure(pairs) for x in reduced)
    assert rows(G.bounded_ancestors(e, 1).select("dep", "anc")) == set(pairs)


def test_cycles(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("c", "e"), ("x", "y"), ("y", "x"), ("a", "x"), ("s", "s")]
    assert rows(G.components(edges(spark, *pairs))) == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}
    assert ("a", "a") in rows(G.closure(edges(spark, *pairs)))
    assert {r.id for r in G.topo_levels(edges(spark, *pairs)).collect()} == {"e"}
    rank = spark.createDataFrame([(x, float(k)) for k, x in enumerate("edabcxy")], "id string, raw double")
    left = G.break_cycles(edges(spark, *pairs), rank, edges(spark, ("c", "a"), ("b", "c")))
    assert G.components(left).count() == 0 and ("c", "a") in rows(left)
    marked = edges(spark, *pairs).withColumn("source", F.when(F.col("dep") == "c", "courses").otherwise("expert"))
    assert rows(G.drop_inside_components(marked, "source = 'courses'").select("dep", "pre")) == {*pairs} - {("c", "a")}
    assert G.components(edges(spark)).count() == 0
    assert G.closure(edges(spark)).count() == 0 and G.topo_levels(edges(spark)).count() == 0


def test_components_random(spark):
    rng = random.Random(5)
    pairs = [(f"v{rng.randrange(40)}", f"v{rng.randrange(40)}") for _ in range(60)]
    up = brute_closure([p for p in pairs if p[0] != p[1]])
    want = {}
    for a, b in up:
        if a != b and (b, a) in up:
            want.setdefault(a, {a}).add(b)
    assert rows(G.components(edges(spark, *pairs))) == {(a, min(s)) for a, s in want.items()}


def test_aliases_and_inheritance(spark):
    chain = spark.createDataFrame([(f"a{i:02}", f"a{i + 1:02}") for i in range(30)] + [(None, "x")], "dropped_id string, canonical_id string")
    assert {r.canonical_id for r in G.collapse_aliases(chain).collect()} == {"a30"}
    with pytest.raises(ValueError, match="cycle"):
        G.collapse_aliases(spark.createDataFrame([("a", "b"), ("b", "a")], chain.schema))
    links = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("p", "q"), ("q", "p"), ("z", "gone")], "id string, parent string")
    known = spark.createDataFrame([("a", "1"), ("c", "2")], "id string, value string")
    assert {r.id: r.value for r in G.inherited(links, known).collect()} == {"a": "1", "b": "1", "c": "2", "d": "2", "p": None, "q": None, "z": None}
    e = R.remap(edges(spark, ("x", "plus"), ("x", "add"), ("add", "plus")), spark.createDataFrame([("plus", "add")], "dropped_id string, canonical_id string"), ["dep", "pre"])
    assert rows(e) == {("x", "add")}


def test_expert_scores(spark):
    e = edges(spark, ("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"))
    pairs = [("a", "b", True), ("a", "c", True), ("b", "a", True), ("c", "d", False), ("c", "d", True), ("d", "e", False), ("a", "a", True)]
    got = G.expert_scores(e, spark.createDataFrame(pairs, "pre string, dep string, positive boolean")).first()
    assert (got.positives, got.predicted, got.hits, got.recovered) == (4, 3, 2, 3)


@pytest.mark.parametrize(
    ("bands", "anchored", "seed", "want", "kept"),
    [((5, 5, 5), (), False, (5, 6, 7), 2), ((5, 5, 6), (2,), False, (5, 5, 6), 2), ((10, 5, 5), (), False, (10, 5, 6), 1), ((10, 5, 5), (), True, (10, 9, 9), 2)],
)
def test_chain_lift(spark, bands, anchored, seed, want, kept):
    nodes = spark.createDataFrame([(x, bands[k], k in anchored) for k, x in enumerate("abc")], "id string, band int, anchored boolean")
    e = edges(spark, ("b", "a"), ("c", "b"))
    lifted, left = G.chain_lift(nodes, e, e.where("dep = 'b'") if seed else e.where("false"))
    assert tuple(r.band for r in lifted.orderBy("id").collect()) == want
    assert left.count() == kept


def test_merge_votes_collisions(spark):
    df = spark.createDataFrame([("k", 2, "b", "y,z", "long text", "B"), ("k", 1, "a", "x,y", "short", "A"), ("k", 3, "a", "w", None, "C"), (None, 4, "a", "", "t", "D"), ("", 5, "a", "", "t", "E")], "key string, ord int, source string, tags string, description string, title string")
    got = R.merge_by_key(df, "key", "ord", {"source": None, "tags": 3}, ["description"], ["title"]).collect()
    assert [(r.key, r.n_rows, r.source, r.tags, r.description, r.title) for r in got] == [("k", 3, "a,b", "x,y,z", "long text", "A")]
    votes = spark.createDataFrame([("a", "b", "i1"), ("a", "b", "i2"), ("b", "a", "i3"), ("c", "d", "i1"), ("d", "c", "i2"), ("e", "f", "i1"), ("g", "g", "i1")], "x string, y string, inst string")
    assert rows(R.majority_votes(votes, "x", "y", "inst").select("a", "b", "verdict")) == {("a", "b", "kept"), ("b", "a", "minority"), ("c", "d", "tie"), ("d", "c", "tie"), ("e", "f", "kept")}
    assert rows(R.contested(votes, "x", "y", "inst")) == set()
    slugs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b" * 80), (4, "b" * 80)], "ord int, slug string")
    assert [r.slug for r in R.suffix_collisions(slugs, "slug", "ord").orderBy("ord").collect()] == ["a", "a-2", "b" * 80, "b" * 78 + "-2"]
    with pytest.raises(ValueError, match="for example"):
        R.assert_none(slugs, "rows")


def test_resolver(spark):
    skills = spark.createDataFrame([("hidden-markov-model", "Hidden Markov Model", 1), ("order-fractions", "Order fractions", 2), ("maps", "Map", 3), ("maps-2", "Maps", 4)], "id string, title string, ord int")
    labels = spark.createDataFrame([("Hidden Markov Models",), ("ordering fractions",), ("mapping",), ("nothing",), ("Order_fractions (easy)",), ("maps 2",), (None,)], "label string")
    got = {r.label: r.id for r in R.resolve_concepts(labels, skills).collect()}
    assert got == {"Hidden Markov Models": "hidden-markov-model", "ordering fractions": "order-fractions", "mapping": None, "nothing": None, "Order_fractions (easy)": "order-fractions", "maps 2": "maps-2"}


def test_exact_top_k_and_regression(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((60, 8))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(99, None), (98, [0.0] * 8)], "vec_id long, embedding array<double>")
    got = rows(S.exact_top_k(df, df.where("vec_id < 10"), 3, "vec_id", "embedding", 8, blocks=5).select("id", "other", "rank"))
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T
    np.fill_diagonal(s, -2)
    assert got == {(i, int(j), k + 1) for i in range(10) for k, j in enumerate(np.argsort(-s[i])[:3])}
    near = spark.createDataFrame([(1, 2, 1.0), (1, 3, 0.5), (4, 2, -0.5)], "id long, other long, cosine double")
    est = {r.id: r.estimate for r in S.neighbour_regression(near, spark.createDataFrame([(2, 4.0), (3, 8.0)], "other long, value double")).collect()}
    assert abs(est[1] - (4 + 8 * 0.5**8) / (1 + 0.5**8)) < 1e-12 and est[4] == 10


def test_isotonic(spark):
    model = C.Isotonic(spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 2.0), (4.0, 5.0), (None, 1.0)], "x double, y double"), "x", "y")
    assert model.x.tolist() == [1, 2, 4] and model.y.tolist() == [1, 2.5, 5]
    assert model.predict(np.array([0.0, 3.5, 6.0])).tolist() == [1, 4.375, 7.5]
    rng = random.Random(1)
    points = [(rng.random(), rng.random() * 3) for _ in range(500)]
    whole = C.pool((x, y, 1.0) for x, y in sorted(points))
    model = C.Isotonic(spark.createDataFrame(points, "x double, y double"), "x", "y")
    assert np.allclose(model.y, [b[1] for b in whole]) and np.allclose(model.x, [b[0] for b in whole])
    empty = C.Isotonic(spark.createDataFrame([], "x double, y double"), "x", "y")
    assert empty.predict(np.array([2.0])).tolist() == [2.0]


def test_scales(spark):
    df = spark.createDataFrame([(-0.5,), (0.5,), (30.0,), (None,), (1.5,)], "v double")
    assert [r.b for r in df.select(C.band("v").alias("b")).collect()] == [1, 2, 20, None, 3]
    g = spark.createDataFrame([([3, 5],), ([0, 12],), ([],), (None,)], "g array<int>")
    assert [r.a for r in g.select(C.anchors(F.col("g")).alias("a")).collect()] == [3, None, None, None]
    topics = spark.createDataFrame([(1, 1.0, "t"), (2, 4.0, "t"), (3, 7.0, "t"), (4, 9.0, "u"), (5, 2.0, None)], "id int, v double, t string")
    got = {r.id: r.smoothed for r in C.smooth_by_topic(topics, "id", "v", "t").collect()}
    assert got == {1: 0.7 * 1 + 0.3 * 5.5, 2: 0.7 * 4 + 0.3 * 4, 3: 0.7 * 7 + 0.3 * 2.5, 4: 9, 5: 2}
    tau = C.kendall_tau(spark.createDataFrame([(1, 1, 1), (2, 2, 3), (3, 3, 2), (4, None, 2)], "ord int, a int, b int"), "a", "b").first()
    assert (tau.n, tau.concordant, tau.discordant) == (3, 2, 1) and abs(tau.tau - 1 / 3) < 1e-12


def test_rare_and_bucket_pairs_equal_brute_force(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(12)]
    sets = {f"r{i:03}": sorted(rng.sample(words, rng.randrange(1, 6))) for i in range(90)}
    df = spark.createDataFrame([(k, v, " ".join(v), "t" if i % 3 else "u") for i, (k, v) in enumerate(sets.items())], "id string, w array<string>, title string, topic string")
    count = {w: sum(w in s for s in sets.values()) for w in words}
    top = {k: set(sorted(s, key=lambda w: (count[w], w))[:2]) for k, s in sets.items()}
    size = {w: sum(w in t for t in top.values()) for w in words}
    j = lambda a, b: len({*sets[a]} & {*sets[b]}) / len({*sets[a]} | {*sets[b]})
    for biggest in (2000, 12):
        ok = {w for w in words if 2 <= size[w] <= biggest}
        want = {(a, b) for a in sets for b in sets if a < b and top[a] & top[b] & ok and j(a, b) >= 0.5}
        assert rows(S.rare_word_pairs(df, "id", "w", biggest=biggest).select("a", "b")) == want
    topic = {r.id: r.topic for r in df.collect()}
    want = {(a, b) for a in sets for b in sets if a < b and topic[a] == topic[b] and j(a, b) >= 0.7 and max(len(" ".join(sets[x])) for x in (a, b)) <= 3 * min(len(" ".join(sets[x])) for x in (a, b))}
    assert rows(S.bucket_pairs(df, "topic", "id", "title", "w", "w").select("a", "b")) == want


def test_big_buckets_and_hot_words_equal_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(9)]
    sets = {f"r{i:03}": frozenset(rng.sample(words, rng.randrange(1, 8))) for i in range(160)}
    df = spark.createDataFrame([(k, sorted(v), "same title", "t") for k, v in sets.items()], "id string, w array<string>, title string, topic string")
    for jaccard in (0.7, 0.5):
        want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= jaccard}
        for hot, key in ((100, 2000), (3, 2000), (3, 5)):
            monkeypatch.setattr(S, "HOT_ROWS", hot)
            monkeypatch.setattr(S, "KEY_ROWS", key)
            assert rows(S.bucket_pairs(df, "topic", "id", "title", "w", "w", jaccard).select("a", "b")) == {(a, b) for a, b in want if 5 * len(sets[a] & sets[b]) >= 2 * min(len(sets[a]), len(sets[b]))}


def test_bucket_of_many_rows_is_searched(spark):
    df = spark.range(1600).selectExpr("concat('r', lpad(id, 4, '0')) as id", "array(concat('a', id div 2), concat('b', id div 2)) as w", "'title' as title", "'t' as topic")
    assert S.bucket_pairs(df, "topic", "id", "title", "w", "w").count() == 800


def test_rare_words_of_many_rows_are_searched(spark):
    # both words of a row are among the two rarest of more than 2000 rows
    df = spark.range(2001).selectExpr("concat('r', lpad(id, 4, '0')) as id", "case when id = 0 then array('x', 'y') when id = 1 then array('y', 'x') else array('x', 'y', concat('a', id), concat('b', id), concat('c', id)) end as w")
    df = df.union(spark.range(2001).selectExpr("concat('s', lpad(id, 4, '0'))", "array('x', concat('d', id))"))
    df = df.union(spark.range(2001).selectExpr("concat('t', lpad(id, 4, '0'))", "array('y', concat('e', id))"))
    assert rows(S.rare_word_pairs(df, "id", "w").select("a", "b")) == {("r0000", "r0001")}


def test_common_word_pairs_equal_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(14)]  # every word is common
    data = [(f"p{0 if i < 250 else i % 3}", rng.randrange(1, 8), i, sorted(rng.sample(words, rng.randrange(2, 9)))) for i in range(330)]
    df = spark.createDataFrame(data, "p string, g int, i long, w array<string>")
    want = {}
    for p, g, i, w in data:
        for q, h, j, v in data:
            n = len({*w} & {*v})
            if p == q and g < h <= g + 3 and n >= 3 and n / len({*w} | {*v}) < 0.8:
                want.setdefault((p, g, h), []).append((-n, i, j))
    want = {(*key, i, j, -n, r) for key, found in want.items() for r, (n, i, j) in enumerate(sorted(found)[:5], 1)}
    for most in (4096, 50):  # one block a part; the longest rows first, then blocks of two chunks
        monkeypatch.setattr(S, "PART_ROWS", most)
        got = S.common_word_pairs(df, "p", "g", "i", "w", gap=3, least=3, below=0.8, k=5)
        assert rows(got.select("part", "la", "lb", "src", "dst", "shared", "rank")) == want


def test_grade_pairs_of_common_words(spark, tmp_path):
    from strandloom.plans.measures import q_grade_pairs

    text = "measure length using {} rulers carefully {}"
    data = [(i, "d", text.format(f"alpha{i}", f"beta{i}"), ["01" if i < 20 else "02"]) for i in range(40)]
    spark.createDataFrame(data, "item_no long, docidentifier string, fullstatement string, educationlevel array<string>").write.parquet(f"{tmp_path}/cf_items.parquet")
    assert rows(q_grade_pairs(spark, str(tmp_path)).select("src", "dst", "rank")) == {(0, 20 + i, i + 1) for i in range(5)}


def test_tool_rule(spark):
    from strandloom.operators.candidates import tool_rule

    df = spark.createDataFrame([(True, False, True, 0.0, False), (False, True, True, 2.0, False), (False, True, True, 1.0, True), (False, False, True, 9.0, True), (False, False, True, 9.0, False), (False, False, False, 0.0, False)], "s boolean, d boolean, p boolean, g double, t boolean")
    assert [r.x for r in df.select(tool_rule(*map(F.col, "sdpgt")).alias("x")).collect()] == [True, True, False, True, False, True]
