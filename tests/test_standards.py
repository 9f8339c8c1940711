import gzip
import json

import pytest

from strandloom.sources import standards as D


def rows(df):
    return {tuple(r) for r in df.collect()}


def dump(path, *docs):
    text = "\n".join(json.dumps(d) for d in docs)
    if path.suffix == ".gz":
        with gzip.open(path, "wt") as out:
            out.write(text)
    else:
        path.write_text(text)
    return str(path)


def test_case_levels_are_inherited(spark, tmp_path):
    link = lambda a, b: {"associationType": "isChildOf", "originNodeURI": {"identifier": a}, "destinationNodeURI": {"identifier": b}}
    doc = {"CFDocument": {"identifier": "doc", "title": "T"}, "CFItems": [{"identifier": "a", "educationLevel": ["03", "04"]}, {"identifier": "b", "fullStatement": "S"}, {"identifier": "c", "educationLevel": []}, {"identifier": "d"}], "CFAssociations": [link("b", "a"), link("c", "b"), link("a", "doc"), link("d", "gone")]}
    items, links = D.read_case(spark, dump(tmp_path / "p.json", doc))
    assert {r.identifier: r.levels for r in items.collect()} == {"a": ["03", "04"], "b": ["03", "04"], "c": ["03", "04"], "d": None}
    assert rows(links) == {("doc", "b", "a"), ("doc", "c", "b")}
    doc["CFItems"].append({"identifier": "e", "educationLevel": ["09"]})
    doc["CFAssociations"].append(link("b", "e"))
    with pytest.raises(ValueError, match="different levels"):
        D.read_case(spark, dump(tmp_path / "q.json", doc))


def test_standard_sets(spark, tmp_path):
    s = lambda id, text, parent=None, label=None, code=None: {"id": id, "description": text, "parentId": parent, "statementLabel": label, "statementNotation": code}
    doc = {"educationLevels": ["KG", "01"], "standards": {"1": s("1", "Numbers and operations"), "2": s("2", "Compare two rÃ©sumÃ©s by length", "1", "Standard", "K.MD.2"), "3": s("3", "Strand text of words", None, "Strand")}}
    got = {r.id: r for r in D.read_standard_sets(spark, dump(tmp_path / "s.json.gz", doc), ["Strand"]).collect()}
    assert got["1"].reason == "heading" and got["3"].reason == "scaffolding" and got["2"].reason is None
    assert got["2"].title == "Compare two résumés by length" and got["2"].tags == "csp,grade:K,grade:01,code:K.MD.2"
    gone = D.read_standard_sets(spark, dump(tmp_path / "t.json", doc | {"document": {"publicationStatus": "Deprecated"}}), [])
    assert {r.reason for r in gone.collect()} == {"deprecated"}


def test_outcomes_and_levels(spark, tmp_path):
    graph = [{"@id": "A", "@type": "CompetenceArea", "name": "Safe use"}, {"@id": "C", "@type": "Competence", "name": "Privacy care"}, {"@id": "L", "@type": "ProficiencyLevel", "four_levels_name": "Basic"}]
    out = {"@id": "O", "@type": "LearningOutcome", "description": "Lock a screen", "competence_area_id": "A", "competence_id": "C", "four_levels_proficiency_name": "ProficiencyLevel/Basic"}
    assert rows(D.read_outcomes(spark, dump(tmp_path / "g.jsonld", {"@graph": [*graph, out]}))) == {("Lock a screen", "digcomp:outcome,digcomp:area:safe-use,digcomp:competence:privacy-care,digcomp:level:basic")}
    with pytest.raises(ValueError, match="known area"):
        D.read_outcomes(spark, dump(tmp_path / "h.jsonld", {"@graph": [*graph, out | {"competence_id": "X"}]}))
    tag = lambda c, *levels: ",".join([f"digcomp:competence:{c}", *(f"digcomp:level:{x}" for x in levels)])
    tagged = [("a1", tag("a", "basic")), ("a2", tag("a", "basic", "advanced")), ("b1", tag("a", "intermediate")), ("x1", tag("x", "intermediate")), ("x2", tag("x", "advanced")), ("x3", tag("x", "intermediate")), ("plain", "other")]
    assert rows(D.level_pairs(spark.createDataFrame(tagged, "id string, tags string"))) == {("a1", "b1"), ("a2", "b1"), ("x1", "x2"), ("x3", "x2")}
    with pytest.raises(ValueError, match="known levels"):
        D.level_pairs(spark.createDataFrame([("a", tag("a", "odd"))], "id string, tags string"))


def test_threads(spark):
    tracks = [(1, 0, ["a"], ["t", "u"]), (1, 1, ["b", "c"], ["t"]), (1, 2, ["d"], ["t", "u"]), (2, 0, ["a"], ["t"]), (2, 1, ["a"], ["t"])]
    got = D.thread_pairs(spark.createDataFrame(tracks, "track int, pos int, slugs array<string>, threads array<string>"))
    assert rows(got) == {("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("a", "d")}


def test_occupations(spark, tmp_path):
    docs = [{"name": "Baker", "level": 2, "knowledges": [{"detail": "Core - know the manufacturer™s rules"}], "skills": [{"detail": "Option 2: bake"}], "behaviours": [{"detail": "be kind"}]}, {"name": "None", "level": 3}]
    for k, d in enumerate(docs):
        dump(tmp_path / f"{k}.json", d)
    items, empty = D.read_occupations(spark, str(tmp_path / "*.json"))
    assert rows(items) == {("Baker", 2, "know the manufacturer's rules"), ("Baker", 2, "bake")} and rows(empty) == {("None",)}
    dump(tmp_path / "9.json", {"name": "High", "level": 9})
    with pytest.raises(ValueError, match="level of 2 to 7"):
        D.read_occupations(spark, str(tmp_path / "*.json"))


def test_annotated_and_crowd(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("1|Search\n2|Graph theory\n")
    (tmp_path / "a.csv").write_text("1,2,1\n2,1,0\n1,9,1\n")
    pairs, lost = D.read_annotated(spark, [(str(tmp_path / "t.tsv"), "bar", str(tmp_path / "a.csv"))])
    assert rows(pairs) == {("Search", "Graph theory", True), ("Graph theory", "Search", False)} and lost == 1
    (tmp_path / "c.csv").write_text("Exercise_A,Exercise_B,Prerequisite_avg\nadding_2_0.5,counting_1,5.1\na_b,c,5\n")
    assert rows(D.read_crowd(spark, str(tmp_path / "c.csv"))) == {("counting", "adding 2", True), ("c", "a b", False)}
    (tmp_path / "d.csv").write_text("Exercise_A,Exercise_B,Prerequisite_avg\na,b,12\n")
    with pytest.raises(ValueError, match="mean from 1 to 9"):
        D.read_crowd(spark, str(tmp_path / "d.csv"))


def test_courses(spark):
    courses = [("d", "1", "Introduction to Topology"), ("d", "2", "Calculus II"), ("d", "3", "CEN 271"), ("d", "4", "Practicum II"), ("d", "5", None), ("d", "6", "A topic"), ("d", "6", "Other topic"), ("d", "7", "Calculus I"), ("e", "1", "Algebra"), ("e", "2", "Topology"), ("e", "3", "Calculus")]
    edge = lambda ds, inst, s, t, timing="before": (ds, inst, s, t, 0, timing)
    edges = [edge("d", "i1", "2", "1"), edge("d", "i1", "3", "1"), edge("d", "i1", "4", "1"), edge("d", "i1", "5", "1"), edge("d", "i1", "6", "1"), edge("d", "i1", "8", "1"), edge("d", "i1", "7", "2"), edge("e", "i2", "3", "2"), edge("e", "i3", "2", "3"), edge("e", "i2", "1", "2", "concurrent"), edge("e", "i4", "1", "3"), edge("e", "i5", "3", "1")]
    pairs, lost = D.course_pairs(spark.createDataFrame(courses, "dataset string, code string, title string"), spark.createDataFrame(edges, "dataset string, institution string, source_prereq string, target_course string, is_alternative int, timing string"))
    assert rows(pairs) == {("Calculus", "Topology")}
    assert sorted(r.reason for r in lost.collect()) == ["ambiguous-code", "code-title", "contested-order", "contested-order", "minority-order", "no-course", "no-title", "no-topic", "same-topic"]


def test_foundations(spark):
    ids = spark.createDataFrame([("algebra-one",), ("music",)], "id string")
    rules = spark.createDataFrame([("counting", "music", None), ("counting", None, "^algebra")], "prereq string, dependent string, pattern string")
    assert rows(D.wire_foundations(rules, ids)) == {("counting", "music"), ("counting", "algebra-one")}
    with pytest.raises(ValueError, match="matches no id"):
        D.wire_foundations(spark.createDataFrame([("counting", None, "zzz")], rules.schema), ids)
