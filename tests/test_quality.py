"""The edge chain against one pass in Python, cycle breaking by seeds, and every quality condition."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from strandloom.operators import edges as L
from strandloom.operators import graph as G
from strandloom.operators import quality as Q


def rows(df):
    return {tuple(r) for r in df.collect()}


SKILL = "id string, raw double, band int, anchored boolean, tags string, topics array<string>, ord int"


def test_rules_in_order(spark):
    skills = [
        ("algebra", 8.0, 8, True, None, ["maths", "tool-x"], 1), ("linear-algebra-one", 10.0, 10, False, None, ["maths"], 2), ("spanish-verbs", 3.0, 3, False, None, [], 3), ("french-verbs", 2.0, 2, False, None, [], 4),
        ("retell-stories-related-to-new-year-day", 1.0, 1, False, None, [], 5), ("low", 9.0, 9, False, "skillsengland:level:2", [], 6), ("high", 1.0, 1, False, "x,skillsengland:level:6", [], 7), ("tool-x", 1.0, 1, False, "onet:tech", [], 8),
        ("tool-y", 5.0, 5, False, "onet:tech", [], 9), ("partial-fraction-decomposition-steps", 1.0, 1, False, None, [], 10), ("same-band", 8.0, 8, False, None, [], 11), ("fraction-steps", 1.0, 1, False, None, [], 12), ("partial-fraction-steps-more", 9.0, 9, False, None, [], 13),
    ]
    cases = [
        ("algebra", "retell-stories-related-to-new-year-day", False, "leaf"), ("spanish-verbs", "french-verbs", False, "language"), ("low", "high", False, "level"), ("algebra", "linear-algebra-one", True, "band"), ("spanish-verbs", "linear-algebra-one", False, "band"),
        ("spanish-verbs", "algebra", True, None), ("algebra", "same-band", False, "raw"), ("low", "partial-fraction-decomposition-steps", False, "specific"), ("partial-fraction-steps-more", "fraction-steps", False, "hypernym"), ("algebra", "tool-x", False, None), ("algebra", "tool-y", False, "tool"),
        ("tool-y", "tool-x", False, None), ("low", "tool-x", False, "tool"), ("algebra", "high", False, None),
    ]
    s = spark.createDataFrame(skills, SKILL)
    e = spark.createDataFrame([(d, p, n, False) for d, p, n, _ in cases] + [("algebra", "gone", False, False)], "dep string, pre string, named boolean, seed boolean")
    got = {(r.dep, r.pre): r.reason for r in L.reasons(L.with_ends(e, s)).collect()}
    assert got == {(d, p): why for d, p, _, why in cases}
    assert {r.reason for r in L.reasons(L.with_ends(e.withColumn("seed", F.lit(True)), s)).collect()} == {None}


def test_united(spark):
    picks = spark.createDataFrame([("a", "b"), ("a", "a"), ("x", "b")], "dep string, pre string")
    names = spark.createDataFrame([("a", "Linear Algebra"), ("b", "Nothing")], "dep string, name string")
    snap = spark.createDataFrame([("linear-algebra", "la"), ("nothing", None)], "name string, match string")
    alias = spark.createDataFrame([("x", "y")], "dropped_id string, canonical_id string")
    assert rows(L.united(picks, names, snap, alias)) == {("a", "b", False), ("y", "b", False), ("a", "la", True)}
    with pytest.raises(ValueError, match="95%"):
        L.united(picks, names, snap.where("match is not null"), alias)


def test_trim_and_seeds_and_areas(spark):
    s = spark.createDataFrame([("maps-one", 1.0, 1, True, None, ["a", "b"], 1), ("tables-two", 1.0, 1, True, None, ["c", "d"], 2), ("tables-three", 1.0, 9, True, None, ["e", "f"], 3), ("reading", 1.0, 1, True, None, ["g", "h"], 4), ("maps-four", 1.0, 1, True, None, ["c", "i"], 5)], SKILL)
    e = spark.createDataFrame([("maps-one", "tables-two", False, 0), ("maps-one", "tables-three", False, 0), ("maps-one", "reading", False, 0), ("maps-one", "maps-four", False, 1), ("tables-two", "maps-one", False, 0)], "dep string, pre string, seed boolean, ord int")
    assert rows(L.trimmed(e, s)) == {("maps-one", "reading"), ("maps-one", "maps-four"), ("tables-two", "maps-one")}
    seeds = spark.createDataFrame([("tables-two", "tables-three", "courses"), ("reading", "tables-three", "courses"), ("reading", "tables-three", "khan"), ("reading", "gone", "khan"), ("reading", "maps-one", "courses")], "dep string, pre string, source string")
    assert rows(L.with_seeds(e.where("false"), seeds, s)) == {("reading", "tables-three"), ("reading", "maps-one")}
    t = spark.createDataFrame([(f"k{i}", 1.0, 1, True, None, ["maps"], i) for i in range(3)], SKILL)
    assert rows(L.subject_areas(spark.createDataFrame([("k0", "maps"), ("z", "maps")], "dep string, pre string"), t, 3)) == {("k0", "maps")}


def broken(edges, raw, seeds):
    """Rounds of ranking every component by its seeds, as one would by hand."""
    edges = {e for e in edges if e[0] != e[1]}
    while True:
        nodes = {x for e in edges for x in e}
        reach = {n: {n} for n in nodes}
        for _ in nodes:
            for d, p in edges:
                reach[d] |= reach[p]
        same = {(a, b) for a in nodes for b in reach[a] if a in reach[b]}
        inside = {e for e in edges if e in same}
        if not inside:
            return edges
        drop = set()
        for head in {min(b for b in nodes if (a, b) in same) for a in {x for e in inside for x in e}}:
            scc = {n for n in nodes if (n, head) in same}
            own = [e for e in inside if e[0] in scc]
            wait = dict.fromkeys(scc, 0)
            for d, p in own:
                wait[d] += (d, p) in seeds
            heap = [(raw[n], n) for n in scc if not wait[n]]
            heapq.heapify(heap)
            place = {}
            while heap:
                _, n = heapq.heappop(heap)
                place[n] = len(place)
                for d, p in own:
                    if p == n and (d, p) in seeds:
                        wait[d] -= 1
                        if not wait[d]:
                            heapq.heappush(heap, (raw[d], d))
            for n in sorted((n for n in scc if n not in place), key=lambda n: (raw[n], n)):
                place[n] = len(place)
            drop |= {(d, p) for d, p in own if place[p] >= place[d]}
        edges -= drop


def test_cycles_break_by_seeds(spark):
    rng = random.Random(17)
    names = [f"n{i:02}" for i in range(30)]
    raw = {n: float(rng.randrange(5)) for n in names}
    pairs = {tuple(rng.sample(names, 2)) for _ in range(75)}
    seeds = set(rng.sample(sorted(pairs), 18))
    e = spark.createDataFrame(sorted(pairs), "dep string, pre string")
    s = spark.createDataFrame(sorted(seeds), "dep string, pre string")
    r = spark.createDataFrame(list(raw.items()), "id string, raw double")
    got = rows(G.break_cycles(e, r, s).select("dep", "pre"))
    assert got == broken(pairs, raw, seeds)
    assert len(got) < len(pairs)


def test_whole_chain(spark):
    rng = random.Random(3)
    s = spark.createDataFrame([(f"word{i:02}-maps", float(i), max(1, i // 2), i % 3 == 0, None, ["t"], i) for i in range(40)] + [("orbit-maps", 30.0, 15, False, None, [], 90), ("orbit", 1.0, 1, False, None, [], 91)], SKILL)
    e = spark.createDataFrame([(f"word{a:02}-maps", f"word{b:02}-maps", False) for a, b in (rng.sample(range(40), 2) for _ in range(120))], "dep string, pre string, named boolean")
    seeds = spark.createDataFrame([("word01-maps", "word30-maps", "khan"), ("word30-maps", "word01-maps", "khan"), ("word02-maps", "word35-maps", "courses")], "dep string, pre string, source string")
    chain = L.EdgeChain(e, s, seeds)
    final = chain.final
    assert G.components(final).count() == 0 and ("orbit-maps", "orbit") in rows(final)
    assert ("word02-maps", "word35-maps") not in rows(final)
    steps = {r.name: r.n_edges for r in chain.steps.collect()}
    assert steps["judged"] >= steps["kept"] >= 1 and steps["reduced"] == final.count() and steps["orphans"] == 1


def test_graph_helpers(spark):
    e = spark.createDataFrame([("c", "b"), ("b", "a"), ("d", "a"), ("c", "a")], "dep string, pre string")
    assert rows(G.longest_chain(e)) == {(0, "a"), (1, "b"), (2, "c")}
    assert rows(G.reaches(e, spark.createDataFrame([("a", "c"), ("d", "b"), ("x", "x")], "dep string, pre string"))) == {("a", "c"), ("x", "x")}
    G.assert_acyclic(e)
    with pytest.raises(ValueError, match="cycle"):
        G.assert_acyclic(e.union(spark.createDataFrame([("a", "c")], "dep string, pre string")))
    n = spark.createDataFrame([("a", 5, 1, 20, True), ("b", 2, 1, 6, False), ("c", 3, 1, 6, False), ("d", 1, 1, 4, False)], "id string, band int, low int, high int, anchored boolean")
    assert rows(G.forward_bands(e, n)) == {("a", 5), ("b", 6), ("c", 6), ("d", 4)}
    links = spark.createDataFrame([("x", "y", 2), ("x", "z", 1), ("z", "w", 1), ("w", "x", 1)], "id string, parent string, ord int")
    ladder = {(r.id, r.step): r.parents for r in G.first_parents(links, 5).collect()}
    assert ladder["x", 1] == ["z", "y"] and ladder["x", 2] == ["w"] and ladder["x", 3] == ["x"] and ("x", 4) not in ladder
    b = spark.createDataFrame([("a", 9), ("b", 2), ("c", 3), ("d", 9), ("lone", 1)], "id string, band int")
    assert rows(G.inverted_above(e, b)) == {("a", 9, None), ("b", 2, 9), ("c", 3, 9), ("d", 9, 9), ("lone", 1, None)}


def rows_of(df):
    return {tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.collect()}


def score(df):
    (r,) = df.collect()
    return round(r.score, 6)


def test_conditions(spark):
    make = spark.createDataFrame
    skills = make([("a", 1, [], []), ("b", 2, ["clerk"], ["t"]), ("c", 3, [], []), ("lone", 1, [], [])], "id string, band int, occupations array<string>, topics array<string>")
    e = make([("b", "a"), ("c", "b")], "dep string, pre string")
    assert score(Q.acyclic(skills, e)) == 1
    assert score(Q.acyclic(skills, e.union(make([("a", "c"), ("lone", "gone")], e.schema)))) == 0
    v = make([([1.0, 2.0, 3.0, 9.0],)] * 6 + [([2.0, 2.0, 3.0, 9.0],)], "v array<double>")
    assert score(Q.shared_vectors(v, "v")) == round((6 - 7) / (5 - 7), 6)
    d = make([("a", 1.0, 1), ("b", 2.0, 2), ("c", 2.0, 2)], "id string, raw double, band int")
    picks = make([("b", ["a"]), ("c", ["b"]), ("gone", []), ("a", [])], "skill string, picks array<string>")
    assert score(Q.current_picks(picks, d)) == 0.5
    assert score(Q.lost_in_lift(e, e.where("dep = 'b'"))) == round((0.5 - 1) / (0.1 - 1), 6)
    assert score(Q.inverted_seeds(make([("a", "c"), ("c", "a")], e.schema), skills)) == round((0.5 - 1) / (0.1 - 1), 6)
    known = G.closure(e)
    assert score(Q.surviving_seeds(make([("c", "a"), ("a", "c")], e.schema), known, skills)) == round(0.5 / 0.8, 6)
    assert score(Q.ordered_bands(e, skills)) == round(1 / 0.95, 6)
    assert score(Q.isolated(skills, e)) == round((0.25 - 1) / (0.2 - 1), 6)
    assert score(Q.roots(skills, e)) == round((0.25 - 1) / (0.2 - 1), 6)
    assert score(Q.tau(make([(0.25,)], "tau double"))) == 0.5
    assert score(Q.far_from_anchor(make([(0.05,)], "share double"))) == 1
    assert score(Q.conflicting_seeds(make([(True, False), (False, True), (False, False), (True, False)], "kept boolean, tie boolean"))) == round((0.25 - 1) / (0.01 - 1), 6)
    each = make([("d", "p", "khan", False, False, 5, 3, True, False), ("e", "p", "khan", False, False, 5, 4, True, True), ("f", "p", "khan", True, False, 1, 4, True, True), ("g", "p", "lc", False, True, 5, 5, True, True)], "dep string, pre string, source string, kept boolean, tie boolean, bp int, bd int, ap boolean, ad boolean")
    assert rows_of(Q.conflict_samples(each, 1)) == {("khan", 2, ("p(5) > d(~3)",))}
    assert score(Q.circular_seeds(make([("a", "b"), ("b", "a"), ("c", "a"), ("c", "b")], e.schema))) == round((0.5 - 1) / (0.01 - 1), 6)
    assert score(Q.empty_titles(make([("x",), ("!",)], "t string"), F.regexp_replace("t", "!", ""), F.col("t"))) == 0
    tags = make([("opensalt", "grade:1"), ("opensalt,esco", ""), ("opensalt", "opensalt:ungraded-framework"), ("esco", "")], "sources string, tags string")
    assert score(Q.graded_rows(tags)) == round(0.5 / 0.95, 6)
    assert score(Q.anomalous_hubs(skills, make([("a", "sced-x")], e.schema))) == round((1 - 201) / (200 - 201), 6)
    assert score(Q.crossed_languages(make([("spanish-a", "french-b"), ("x", "y")], e.schema))) == 0.5
    assert score(Q.junk(make([("x" * 70 + "-abc123", [], []), ("b", ["o-abc123"], []), ("c", [], ["junk"]), ("d", [], [])], "id string, occupations array<string>, topics array<string>"), lambda t: t == "junk")) == 0.25
    sane = make([("a", "K", "1"), ("b", "5", "6")], "id string, grade_from string, grade_to string")
    assert score(Q.sane(sane, make([("a", 2), ("b", 3)], "id string, band int"))) == round(0.5 / 0.8, 6)
    with pytest.raises(ValueError, match="no skill"):
        Q.sane(sane, skills.where("id = 'a'"))
    assert score(Q.areas_inside(skills, make([("b", "t")], e.schema), 1)) == 0.75
    assert score(Q.implied(known, "c", "a")) == 1 and score(Q.implied(known)) == 0
    spots = make([("javascript", 5, ["software-developer-x"], []), ("biology", 5, [], ["marine-biology"]), ("addition", 1, [], []), ("calculus", 9, [], [])], "id string, band int, occupations array<string>, topics array<string>")
    assert score(Q.spot_checks(Q.known_spots(spots, e))) == 1
    assert score(Q.spot_checks(Q.known_spots(skills, make([("distinguish-lumber-categories", "pack-fragile-items-for-transportation")], e.schema)))) == round(2 / 6, 6)
    assert score(Q.clean_list(make([(1, 1)], "prefix int, emphasis int"), skills)) == 0.5
    ex = {r.condition: round(r.score, 6) for r in Q.expert("expert", make([(6, 4, 1, 3)], "positives int, predicted int, hits int, recovered int")).collect()}
    assert list(ex.values()) == [2, 1, 10]
    assert Q.in_time(spark, __import__("time").time()).first().score > 1
    assert Q.missing(spark, "x").first().score == 0
    with pytest.raises(Exception, match="finite measurement"):
        Q.isolated(skills.where("false"), e).collect()
