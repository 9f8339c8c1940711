import pytest
from pyspark.sql import functions as F

from strandloom.functions import answers as A
from strandloom.functions import text as X
from strandloom.operators import merging as M
from strandloom.operators import relational as R
from strandloom.sources import standards as D


def rows(df):
    return {tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.collect()}


def test_rules_and_gates(spark, monkeypatch):
    monkeypatch.setattr(M, "CHUNK", 1)
    make = spark.createDataFrame
    s = make([("l1", ["csp"], ["code:1.1", "x"]), ("l2", ["learningcommons"], ["code:1.1"]), ("o1", ["opensalt"], ["code:1.1"]), ("o2", ["opensalt", "csp"], ["code:1.1"]), ("n", ["esco"], ["code:1.1"])], "id string, sources array<string>, tags array<string>")
    codes = M.code_rule(s)
    assert {frozenset((r.a, r.b)) for r in codes.collect()} == {frozenset(p) for p in (("l1", "o1"), ("l1", "o2"), ("l2", "o1"), ("l2", "o2"), ("o2", "o1"))}
    rare = M.rare_rule(make([("l1", "n", 0.6), ("o1", "n", 0.6)], "a string, b string, jaccard double"), s)
    assert rows(rare) == {("l1", "n", 0.95)}
    edges = make([("hasStandardAlignment", "x", "y"), ("other", "x", "y")], "rel string, src string, dst string")
    aligned = M.alignment_rule(edges, make([("x", "o1"), ("y", "l1")], "node string, id string"))
    all_ = M.lowest(codes, rare, aligned, M.topic_rule(make([("l1", "l2", 0.8)], "a string, b string, jaccard double")))
    assert {(r.a, r.b): r.least for r in all_.collect()}["l1", "o1"] == 0.90
    v = make([("l1", [1.0, 0.0]), ("o1", [0.92, 0.3919]), ("o2", [0.0, 1.0]), ("n", [0.94, 0.3411]), ("l2", [1.0, 0.0])], "id string, vec array<double>")
    assert {(r.a, r.b) for r in M.gated(all_, v).collect()} == {("l1", "o1"), ("l2", "o1"), ("l1", "l2")}
    assert M.gated(all_, v.where("id <> 'o1'")).where("b = 'o1'").count() == 0


def test_group_attributes_and_tree_topics(spark):
    r = spark.createDataFrame([("a", 3, ["x"], ["t1"]), ("b", 1, ["y", "x"], ["t2"]), ("c", 2, ["z", "w"], ["t1", "t3"]), ("d", 4, [], [])], "id string, ord int, topics array<string>, tags array<string>")
    alias = spark.createDataFrame([("b", "a"), ("c", "a")], "dropped_id string, canonical_id string")
    assert rows(M.group_attributes(r, alias, ["topics"], ["tags"])) == {("a", ("x", "y", "z"), ("t1", "t2", "t3")), ("d", (), ())}
    one = spark.createDataFrame([("d", ["junk", "maths", "science"])], "slug string, ancestors array<string>")
    two = spark.createDataFrame([("d", ["other"]), ("e", ["p"])], "slug string, ancestors array<string>")
    s = spark.createDataFrame([("d", []), ("e", []), ("f", ["own"]), ("g", [])], "id string, topics array<string>")
    assert rows(M.tree_topics(s, one, two, lambda t: t == "junk")) == {("d", ("maths", "science")), ("e", ("p",)), ("f", ("own",)), ("g", ())}


def test_tags(spark):
    s = spark.createDataFrame([("khan-add", "Add", [], ["khan"]), ("weld", "Weld pipes at sea", [], ["esco"]), ("count", "Count", [3], ["csp"]), ("maths", "Maths games", [12], ["csp"])], "id string, title string, grades array<int>, sources array<string>")
    m = spark.createDataFrame([("khan-add", "clerk", 0.9), ("weld", "welder", 0.7), ("weld", "welder", 0.8), ("weld", "ship-manager", 0.9), ("weld", "dock-director-a", 0.96), ("weld", "thing-abc123", 0.9), ("count", "clerk", 0.9), ("maths", "", 0.9)], "id string, slug string, score double")
    assert rows(M.picked_tags(m, s, "occupation", 2)) == {("weld", "dock-director-a", 0.96, 1), ("weld", "welder", 0.8, 2)}
    t = spark.createDataFrame([("maths", "maths-basics", 0.7), ("maths", "sport", 0.9), ("weld", "sport", 0.9)], "id string, slug string, score double")
    assert rows(M.picked_tags(t, s, "topic", 3)) == {("maths", "maths-basics", 0.7, 1), ("weld", "sport", 0.9, 1)}
    items = spark.createDataFrame([("i", ["rare", "big", "old"]), ("j", ["big"])], "item string, words array<string>")
    refs = spark.createDataFrame([("r", ["rare"]), ("s", ["big", "old"]), ("t", ["big"]), ("u", ["old", "big"])], "ref string, words array<string>")
    met = R.rare_token_matches(items, refs, F.col("df") > 1)
    assert rows(met) == {("i", "r", 1), ("i", "s", 2), ("i", "u", 2)}
    x = spark.createDataFrame([("i", [1.0, 0.0])], "item string, vec array<double>")
    y = spark.createDataFrame([("r", [0.8, 0.6]), ("s", [0.0, 1.0])], "ref string, vec array<double>")
    assert rows(M.scored_matches(met, x, y, 0.6, 1)) == {("i", "r", 0.8, 1)}


def test_contents_and_vectors(spark):
    df = spark.createDataFrame([("Add", None, "grade:1,x"), ("Add", "", ""), ("Add", "d" * 60, "t")], "title string, description string, tags string")
    got = [r.c for r in df.select(M.content(F.col("title"), F.col("description"), F.col("tags")).alias("c")).collect()]
    assert got == ["Add. grade:1 x", "Add. Skill: Add. Add.", "Add\n" + "d" * 60]
    assert df.select(M.retry_content(F.col("title"), F.col("description"), F.col("tags")).alias("c")).first().c == "Skill: Add. Context: grade:1 x. Topic: Add."
    sig = spark.createDataFrame([(k, "s" if k < 6 else "t") for k in range(9)], "id int, signature string")
    assert {r.id for r in M.collapsed(sig).collect()} == set(range(6))
    M.assert_finite(spark.createDataFrame([([1.0],)], "v array<double>"), "v")
    for bad in ([0.0], [float("nan")], None):
        with pytest.raises(ValueError, match="finite"):
            M.assert_finite(spark.createDataFrame([([1.0],), (bad,)], "v array<double>"), "v")


def test_answers(spark):
    cases = {
        '{"prereqs": ["Linear algebra", "sets; logic", "Sets", "none"]}': ("Linear algebra", "sets", "logic", "Sets"), '{"prereqs": []}': (), '{"prereqs": ["none"]}': (), "prose": None, '{"prereqs": [1]}': None, '{"prereqs": "x"}': None,
        '{"prereqs": ["one two three four five six seven eight nine"]}': None, '{"prereqs": ["!!"]}': None, '{"other": []}': None,
        '{"prereqs": ["a1","a2","a3","a4","a5","a6","a7","a8","a9"]}': tuple(f"a{k}" for k in range(1, 9)),
    }
    df = spark.createDataFrame([(k,) for k in cases], "a string")
    got = {r.a: r.n if r.n is None else tuple(r.n) for r in df.select("a", A.named_prerequisites(F.col("a")).alias("n")).collect()}
    assert got == cases
    snaps = {'{"match": "2"}': "y", '{"match": "none"}': "none", '{"match": "3"}': None, '{"match": 2}': None, "y": None, '{"match": "0"}': None}
    df = spark.createDataFrame([(k, ["x", "y"]) for k in snaps], "a string, c array<string>")
    assert {r.a: r.m for r in df.select("a", A.snapped(F.col("a"), F.col("c")).alias("m")).collect()} == snaps


def test_annotated_sets(spark, tmp_path):
    (tmp_path / "c.csv").write_text("1,Graphs, trees,NULL\n2,Sets,https://x.y/z\n")
    (tmp_path / "t.tsv").write_text("1\tCells\n2\tGenes\n")
    (tmp_path / "a.csv").write_text("1,2,1\n1,9,0\n")
    (tmp_path / "b.csv").write_text("2,1,0\n")
    pairs, lost = D.read_annotated(spark, [(str(tmp_path / "c.csv"), "comma", str(tmp_path / "a.csv")), (str(tmp_path / "t.tsv"), "tab", str(tmp_path / "b.csv"))])
    assert rows(pairs) == {("Graphs, trees", "Sets", True), ("Genes", "Cells", False)} and lost == 1
    assert X.slugify("x") is not None
