"""Readers of skill lists and seeds, on small files."""

import gzip
import json

import pytest

from strandloom.sources import files, lists, seeds


def rows(df):
    return {tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.collect()}


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_concepts_and_occupations(spark, tmp_path):
    esco = put(tmp_path / "s.csv", 'preferredLabel,description,definition,skillType\nplan work,,"To plan, well",skill/competence\n,x,y,z\nWeld,Says,,\n')
    assert rows(lists.esco_skills(spark, esco)) == {("Plan work", "To plan, well", "esco", "esco:skill/competence"), ("Weld", "Says", "esco", "esco")}
    a = put(tmp_path / "o.csv", "preferredLabel,description\nBaker,Bakes\n,none\n")
    b = put(tmp_path / "o.txt", "O*NET-SOC Code\tTitle\tDescription\n1\tbaker\tOther\n2\tClerk\tFiles\n")
    assert rows(lists.occupation_names(spark, a, b)) == {("Baker", "Bakes"), ("Clerk", "Files")}
    need = put(tmp_path / "r.csv", "occupationLabel,skillLabel,relationType\nclerk,Plan work,essential\nbaker,plan work,essential\nclerk,plan work,essential\nbaker,weld,optional\n")
    assert rows(lists.essential_occupations(spark, need)) == {("plan-work", ("clerk", "baker"))}


def test_content_model(spark, tmp_path):
    model = put(tmp_path / "m.txt", "Element ID\tElement Name\tDescription\n1.A\tReading\tTo read\n1.B\tWriting\t\n")
    used = put(tmp_path / "Skills.txt", "O*NET-SOC Code\tElement ID\tScale ID\tData Value\n11\t1.A\tIM\t3.5\n11\t1.A\tLV\t9\n12\t1.A\tIM\t4.5\n11\t1.B\tIM\tn/a\n")
    assert rows(lists.onet_elements(spark, model, {used: "onet:skill"})) == {("Reading", "To read", "onet", "onet:skill"), ("Writing", "", "onet", "onet:skill")}
    titles = put(tmp_path / "t.txt", "O*NET-SOC Code\tTitle\n11\tClerk\n12\tBaker\n")
    assert rows(lists.rated_occupations(spark, model, titles, [used])) == {("reading", "Baker", 4.5, 1), ("reading", "Clerk", 3.5, 2)}
    bad = put(tmp_path / "bad.txt", "O*NET-SOC Code\tElement ID\tScale ID\tData Value\n11\t9.Z\tIM\t3.5\n")
    with pytest.raises(ValueError, match="not in the content model"):
        lists.onet_elements(spark, model, {bad: "onet:skill"})


def test_tasks_activities_technologies(spark, tmp_path):
    tasks = put(tmp_path / "t.txt", "Task\tTask Type\nFile forms\tCore\nfile FORMS\tSupplemental\nSort\t\n")
    assert rows(lists.onet_tasks(spark, tasks)) == {("File forms", "", "onet", "onet:task,onet:core")}
    dwas = put(tmp_path / "d.txt", "DWA Title\nSort mail\nSORT mail\n")
    assert rows(lists.onet_activities(spark, dwas)) == {("Sort mail", "", "onet", "onet:dwa")}
    tech = put(tmp_path / "x.txt", "Example\tCommodity Title\tHot Technology\npython\tLanguages\tN\nPython\tTools of code\tY\nPYTHON\tOther\tY\nAcme Inc\tTools\tY\nOld thing\tTools\tN\nGit\t\tY\n")
    assert rows(lists.onet_technologies(spark, tech)) == {("Python", "Python — Tools of code", "onet", "onet:tech,onet:tech:tools-of-code"), ("Git", "", "onet", "onet:tech")}


def test_lightcast_foundations_targets(spark, tmp_path):
    doc = {"data": [{"name": "Go", "type": {"name": "Tool"}, "category": {"name": "Code"}}, {"name": "CPA", "type": {"name": "Certification"}}, {"name": "Rust", "type": {"name": "Tool"}, "subcategory": {"name": "Systems"}}, {"name": "Zig"}]}
    path = put(tmp_path / "l.json", json.dumps(doc))
    infill = spark.createDataFrame([("go", "A language."), ("rust", "SKIP")], "key string, value string")
    assert rows(lists.lightcast_skills(spark, path, infill)) == {("Go", "A language.", "lightcast", "lightcast:Tool"), ("Rust", "Rust — Systems", "lightcast", "lightcast:Tool,desc:placeholder"), ("Zig", "", "lightcast", "lightcast,desc:placeholder")}
    f = spark.createDataFrame([("number-sense", "Number sense", "d", 0, 2), ("play", "Play", "e", -1, -1)], "id string, title string, description string, grade_start int, grade_end int")
    assert {r.tags for r in lists.foundation_skills(f).collect()} == {"foundation,foundation:number-sense,grade:K,grade:2", "foundation,foundation:play,grade:PK"}
    some = [("a", "x" * 130, "", "onet", ""), ("go", "go", "", "lightcast", ""), ("ab", "ab", "", "lightcast", ""), ("c", "Long enough", "", "opensalt", ""), ("d", "Said thing", "yes", "lightcast", "desc:placeholder")]
    t = lists.enrichment_targets(spark.createDataFrame(some, "id string, title string, description string, sources string, tags string"))
    assert {(r.id, r.task) for r in t.collect()} == {("a", "summary"), ("go", "infill"), ("c", "opensalt"), ("d", "infill")}


def test_framework_skills(spark, tmp_path):
    item = lambda i, s, **k: {"identifier": i, "fullStatement": s, **k}
    one = {
        "CFDocument": {"identifier": "d1", "title": "State Maths"},
        "CFItems": [
            item("a", "Add whole numbers within twenty", CFItemType="Standard", educationLevel=["01"], humanCodingScheme="1.OA.6", conceptKeywords=["Number Sense", "!"]),
            item("b", "add whole numbers within twenty", CFItemType="Standard"), item("c", "Numbers", CFItemType="Strand"), item("e", "Subtract whole numbers within ten", CFItemType="Standard", notes="see khanacademy.org/e/subtract_10 now"),
        ],
        "CFAssociations": [{"associationType": "isChildOf", "originNodeURI": {"identifier": "e"}, "destinationNodeURI": {"identifier": "a"}}],
    }
    two = {"CFDocument": {"identifier": "d2", "title": "SCED codes"}, "CFItems": [item("x", "Compare the parts of simple machines")], "CFAssociations": []}
    three = {"CFDocument": {"identifier": "d3", "title": "Skip me"}, "CFItems": [item("y", "Explain how machines work")], "CFAssociations": []}
    for k, d in enumerate((one, two, three)):
        put(tmp_path / f"{k}.json", json.dumps(d))
    found, lost = lists.framework_skills(spark, str(tmp_path), ["Strand"], ["skip-me"])
    by = {r.title: r.tags for r in found.collect()}
    assert len(by) == 3 and all("opensalt" in t for t in by.values())
    tags = sorted(t for t in by.values())
    assert any(t.startswith("opensalt,grade:01,topic:number-sense,code:") and t.endswith("opensalt:standard") for t in tags)
    assert any(t == "opensalt,grade:01,opensalt:standard,khan:subtract_10" for t in tags)
    assert "opensalt,sced:catalog,opensalt:ungraded-framework" in tags
    assert rows(lost) == {("d1", "b", "title"), ("d1", "c", "scaffolding"), ("d3", "y", "framework")}


def test_graph_standards(spark, tmp_path):
    nodes = [
        {"k": "component", "id": "c1", "text": "share a feeling", "grades": ["K"]}, {"k": "item", "id": "i1", "text": "Add whole numbers fluently", "type": "Standard", "grades": ["1"], "code": "1.OA.6"},
        {"k": "item", "id": "i2", "text": "Add whole numbers fluently", "type": "Standard", "grades": ["2"]}, {"k": "item", "id": "i3", "text": "(Begins in grade 3.)"}, {"k": "item", "id": "i4", "text": "Numbers", "type": "Strand"},
        {"k": "edge", "rel": "buildsTowards", "from": "i1", "to": "c1"}, {"k": "edge", "rel": "buildsTowards", "from": "i1", "to": "i2"},
    ]
    path = put(tmp_path / "g.jsonl", "\n".join(map(json.dumps, nodes)))
    found, keys, lost = lists.graph_standards(spark, path, ["Strand"])
    by = {r.key: r for r in found.collect()}
    assert set(by) == {"c1", "i1"} and by["c1"].title == "Share a feeling" and by["c1"].tags == "learningcommons:component,grade:K"
    assert by["i1"].tags.startswith("learningcommons:standard,learningcommons:coherence,grade:1") and "grade:2" in by["i1"].tags
    assert rows(keys) == {("c1", "c1"), ("i1", "i1"), ("i2", "i1")}
    assert rows(lost) == {("i3", "note"), ("i4", "scaffolding")}
    _, edges = files.read_property_graph(spark, path)
    skill_of = spark.createDataFrame([("c1", "share"), ("i1", "add"), ("i2", "add-2")], "node string, id string")
    alias = spark.createDataFrame([("add-2", "add")], "dropped_id string, canonical_id string")
    good, bad = seeds.node_pairs(edges, skill_of, alias)
    assert rows(good) == {("add", "share", "i1->c1")} and rows(bad) == {("i1", "i2", "i1->i2", "self-loop")}
    assert rows(seeds.node_pairs(edges, skill_of.where("node <> 'c1'"), alias)[1]) == {("i1", "i2", "i1->i2", "self-loop"), ("i1", "c1", "i1->c1", "no-skill")}


def test_exams_and_objectives(spark, tmp_path):
    exam = [{"id": "e", "name": "Exam", "body": "Board", "domains": [{"name": "D", "objectives": [{"title": "Sort things", "sub": ["a", "b"]}, {"title": "概要", "sub": []}]}, {"name": "E", "objectives": []}]}]
    path = tmp_path / "e.json.gz"
    path.write_bytes(gzip.compress(json.dumps(exam).encode()))
    assert rows(lists.exam_objectives(spark, str(path))) == {("Sort things", "Exam (Board), D. a; b", "certatlas", "")}
    live = {"status": "vigente"}
    docs = [
        {"objetivos": [{"codigo": "EI02CG01", "texto": "Correr", "grupo_etario": "ei-grupo-02", "vigencia": live}]},
        {"habilidades": [{"codigo": "EF67LP08", "texto": "Ler", "anos": [6, 7], "vigencia": live}, {"codigo": "EF03MA01", "texto": "Somar", "anos": [3], "vigencia": live}, {"codigo": "EM13LP01", "texto": "Escrever", "vigencia": live}]},
    ]
    paths = [put(tmp_path / f"b{k}.json", json.dumps(d)) for k, d in enumerate(docs)]
    got = lists.objectives(spark, paths)
    assert {(r.code, tuple(r.grades), r.subject) for r in got.collect()} == {("EI02CG01", ("PK",), "Body, gestures, and movement"), ("EF67LP08", ("6", "7"), "Portuguese language"), ("EF03MA01", ("3",), "Mathematics"), ("EM13LP01", ("10", "11", "12"), "Portuguese language")}
    english = spark.createDataFrame([("EI02CG01", "Run"), ("EF67LP08", "Read"), ("EF03MA01", "Add"), ("EM13LP01", "Write")], "key string, value string")
    titled = {r.title: r.tags for r in lists.objective_skills(got, english).collect()}
    assert titled["Read"] == "bncc:objective,bncc:subject:portuguese-language,grade:6,grade:7,code:EF67LP08"
    with pytest.raises(ValueError, match="English translation"):
        lists.objective_skills(got, english.where("key <> 'EM13LP01'"))
    wrong = put(tmp_path / "w.json", json.dumps({"habilidades": [{"codigo": "EF67LP08", "texto": "Ler", "anos": [6], "vigencia": live}]}))
    with pytest.raises(ValueError, match="contradicts"):
        lists.objectives(spark, [wrong])


def test_units_and_tracks(spark, tmp_path):
    unit = lambda s, y: {"unitSlug": s, "unitTitle": s.title(), "description": " d ", "year": y, "priorKnowledgeRequirements": ["count"] if s == "u1" else []}
    (tmp_path / "units").mkdir()
    for s, y in (("u1", 1), ("u2", 7), ("u3", 8), ("u4", 8), ("u5", 8)):
        (tmp_path / "units" / f"{s}.json.gz").write_bytes(gzip.compress(json.dumps(unit(s, y)).encode()))
    u = lists.units(spark, str(tmp_path / "units"))
    assert {r.tags for r in lists.unit_skills(u).collect()} == {"oak:u1,grade:K", "oak:u2,grade:6", "oak:u3,grade:7", "oak:u4,grade:7", "oak:u5,grade:7"}
    at = lambda s, n, **k: {"unitTitle": s, "unitOrder": n, "unitSlug": s, "threads": [{"threadSlug": "t"}], **k}
    primary = put(tmp_path / "p.json", json.dumps([{"year": "1", "units": [at("u1", 1)]}]))
    options = {"unitTitle": "o", "unitOrder": 1, "unitOptions": [{"unitSlug": "u3"}, {"unitSlug": "u4"}], "threads": [{"threadSlug": "t"}]}
    second = put(tmp_path / "s.json", json.dumps([{"year": "7", "units": [at("u2", 2)]}, {"year": "8", "tiers": [{"tierSlug": "core", "units": [options]}, {"tierSlug": "high", "units": [at("u5", 1)]}]}]))
    seq = spark.createDataFrame([("maths", "maths-primary", primary), ("maths", "maths-secondary", second)], "subject string, sequence string, path string")
    got = {}
    for r in lists.tracks(spark, seq, u).orderBy("track", "pos").collect():
        got.setdefault(r.track, []).append(tuple(r.slugs))
    assert got == {"maths-secondary/core": [("u1",), ("u2",), ("u3", "u4")], "maths-secondary/high": [("u1",), ("u2",), ("u5",)]}
    tagged = spark.createDataFrame([("counting", 1, "oak:u1,x"), ("other", 2, "oak:u1")], "id string, ord int, tags string")
    by_tag = lists.tag_values(tagged, "oak:")
    assert rows(by_tag) == {("u1", "counting")}
    assert rows(seeds.prior_names(u, by_tag)) == {("counting", "count")}


def test_list_guards(spark):
    df = spark.createDataFrame([(["a", "b"], ["x"]), (["a"], [])], "sources array<string>, tags array<string>")
    assert rows(lists.list_guards(df, ["a", "b"], 2)) == {("a", 2), ("b", 1)}
    with pytest.raises(ValueError, match="no rows"):
        lists.list_guards(df, ["c"], 1)
    with pytest.raises(ValueError, match="at least 3"):
        lists.list_guards(df, ["a"], 3)


def test_seed_pairs(spark, tmp_path):
    khan = put(tmp_path / "k.tsv", "Data Name\tPrereq(s)\tCode\tDisplay Name\nadd\troot\tc1\tAddition\nmul\tc1; count\tc2\tTimes\ncount\t\t\tCounting\n")
    tagged = spark.createDataFrame([("mul", "multiplication")], "value string, id string")
    pairs = seeds.exercise_pairs(spark, khan, tagged)
    assert rows(pairs) == {("Addition", "multiplication", "khan", "add->mul"), ("Counting", "multiplication", "khan", "count->mul")}
    cpl = put(tmp_path / "a.preqs", "Angle,Line\n\nArea,Angle\n")
    assert rows(seeds.concept_pairs(spark, {cpl: "alcpl_geometry"})) == {("Line", "Angle", "alcpl_geometry", "Angle,Line"), ("Angle", "Area", "alcpl_geometry", "Area,Angle")}
    with pytest.raises(ValueError, match="Dependent,Prereq"):
        seeds.concept_pairs(spark, {put(tmp_path / "b.preqs", "a,b,c\n"): "x"})
    meta = put(tmp_path / "m.csv", "a,b,c,d\nSets,1,2,Groups\n,1,2,x\n")
    assert rows(seeds.positional_pairs(spark, meta)) == {("Sets", "Groups", "metacademy", "Sets->Groups")}
    exact = spark.createDataFrame([("Addition", "addition"), ("multiplication", "multiplication"), ("Lost", None)], "label string, id string")
    fallback = spark.createDataFrame([("Counting", "counting", None), ("Lost", None, "below-gate")], "label string, id string, reason string")
    more = pairs.union(spark.createDataFrame([("Lost", "Addition", "khan", "x"), ("Addition", "Addition", "khan", "y"), ("Nowhere", "Addition", "other", "z")], pairs.schema))
    edges, lost = seeds.resolve_pairs(more, exact, fallback)
    assert {(r.src, r.dst, r.confidence, r.fallback) for r in edges.collect()} == {("addition", "multiplication", 1.0, False), ("counting", "multiplication", 0.85, True)}
    assert {(r.raw, r.src_reason, r.dst_reason) for r in lost.collect()} == {("x", "below-gate", "ok"), ("y", "ok", "ok (self-loop)"), ("z", "no-match", "ok")}
    short = {r.source: r.short for r in seeds.source_shares(edges, lost).collect()}
    assert short == {"khan": True, "other": True}
    with pytest.raises(ValueError, match="too few"):
        seeds.assert_floors(edges, lost)
    seeds.assert_floors(edges, lost, {"khan": 0.5, "other": 0.0})
    alias = spark.createDataFrame([("counting", "addition")], "dropped_id string, canonical_id string")
    kept = edges.withColumn("holdout", edges.src == "none")
    assert rows(seeds.kept_seeds(kept, alias)) == {("addition", "multiplication", "khan")}


def test_labels_and_order(spark, tmp_path):
    labels = spark.createDataFrame([("a", "Physics"), ("b", "List of birds"), ("c", "One two three four five"), ("d", "x"), ("e", "Law (UK)"), ("f", "Maths--History")], "node string, label string")
    assert rows(files.subject_labels(labels).select("node")) == {("a",), ("f",)}
    assert rows(files.tree_labels(labels).select("node")) == {("a",), ("b",), ("c",), ("e",)}
    broader = spark.createDataFrame([("x", "a"), ("y", "a"), ("z", "b"), ("w", "q")], "node string, broader string")
    assert rows(files.broadest(labels, broader, 2, 1)) == {("a", "Physics", 2)}
    folder = tmp_path / "cache"
    folder.mkdir()
    import os

    # the later file is smaller and sorts first by name, and the later answer is the smaller text
    (folder / "z.txt").write_text("k\tzebra\nq\tone\n" + "".join(f"x{i}\ty\n" for i in range(500)))
    (folder / "a.txt").write_text("k\tapple\nq\tant\n")
    os.utime(folder / "z.txt", (1_000_000, 1_000_000))
    os.utime(folder / "a.txt", (2_000_000, 2_000_000))
    got = {r.key: r.value for r in files.read_cache(spark, str(folder)).where("key in ('k', 'q')").collect()}
    assert got == {"k": "zebra", "q": "one"}
