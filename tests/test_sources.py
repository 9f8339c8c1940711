import gzip
import json

import numpy as np
import pytest

from strandloom.sources import files, sinks
from strandloom.streaming import answers


def write(path, text):
    path.write_text(text, newline="")
    return str(path)


def test_tsv_and_csv(spark, tmp_path):
    df = files.read_tsv(spark, write(tmp_path / "a.tsv", 'x\ty\r\n1\t"q\r\n\n2\t\r\n'))
    assert [tuple(r) for r in df.collect()] == [("1", '"q'), ("2", "")]
    with pytest.raises(Exception, match="expected 2 cells"):
        files.read_tsv(spark, write(tmp_path / "b.tsv", "x\ty\n1\n")).collect()
    with pytest.raises(ValueError, match="empty file"):
        files.read_tsv(spark, write(tmp_path / "c.tsv", ""))
    df = files.read_csv(spark, write(tmp_path / "a.csv", 'x,y\n"a\nb","say ""hi"""\n'))
    assert [tuple(r) for r in df.collect()] == [("a\nb", 'say "hi"')]
    with pytest.raises(ValueError, match="expected a column 'z'"):
        files.column(df, "z", "a.csv")


def test_typed(spark):
    good = spark.createDataFrame([("a-b", "5", "1.5", "1"), ("c", "20", "-2", "0")], "id string, difficulty string, difficulty_raw string, anchored string")
    rows = [tuple(r) for r in files.typed(good, files.DIFFICULTY).orderBy("id").collect()]
    assert rows == [("a-b", 5, 1.5, True), ("c", 20, -2.0, False)]
    for row, what in ((("A", "5", "1", "1"), "id"), (("a", "21", "1", "1"), "difficulty"), (("a", "5", "1e3", "1"), "difficulty_raw"), (("a", "5", " 7", "1"), "difficulty_raw"), (("a", "5", "1", "yes"), "anchored"), ((None, "5", "1", "1"), "id")):
        with pytest.raises(ValueError, match=f"column {what} expected"):
            files.typed(spark.createDataFrame([row], good.schema), files.DIFFICULTY)
    with pytest.raises(ValueError, match="expected once"):
        files.typed(good.union(good), files.DIFFICULTY)
    with pytest.raises(ValueError, match="received none"):
        files.typed(good.where("false"), files.DIFFICULTY)
    assert files.typed(spark.createDataFrame([], "skill_id string, prereq_id string"), files.EDGES).count() == 0
    picks = spark.createDataFrame([("a", "none"), ("b", "x,y-z")], "skill string, picks string")
    assert [r.picks for r in files.typed(picks, files.PICKS).orderBy("skill").collect()] == [[], ["x", "y-z"]]


def test_json_graph_skos_cache_vectors(spark, tmp_path):
    lines = [{"k": "item", "id": "a", "text": "A"}, {"k": "component", "id": "b", "grades": ["1"]}, {"k": "edge", "rel": "buildsTowards", "from": "a", "to": "b"}]
    with gzip.open(tmp_path / "g.json.gz", "wt") as out:
        out.write("\n".join(map(json.dumps, lines)))
    nodes, edges = files.read_property_graph(spark, str(tmp_path / "g.json.gz"))
    assert nodes.count() == 2 and tuple(edges.first()) == ("buildsTowards", "a", "b")
    write(tmp_path / "bad.json", json.dumps(lines[0]) + "\n" + json.dumps(lines[2]))
    with pytest.raises(ValueError, match="ends at no node"):
        files.read_property_graph(spark, str(tmp_path / "bad.json"))
    nt = '<x/1> <http://w3.org/skos/core#prefLabel> "A \\"b\\""@en .\n<x/1> <http://w3.org/skos/core#broader> <x/2> .\nother\n'
    labels, broader = files.read_skos(spark, write(tmp_path / "t.nt", nt))
    assert [tuple(r) for r in labels.collect()] == [("x/1", 'A "b"')] and [tuple(r) for r in broader.collect()] == [("x/1", "x/2")]
    cache = files.read_cache(spark, write(tmp_path / "c.tsv", "k\tone\nk\ttwo\nj\tx\n"))
    assert {tuple(r) for r in cache.collect()} == {("k", "one"), ("j", "x")}
    with pytest.raises(Exception, match="expected key and value"):
        files.read_cache(spark, write(tmp_path / "d.tsv", "k\tone\ntorn")).collect()
    tree = files.read_tree(spark, write(tmp_path / "tree.tsv", "slug\tancestors\na\tb,c\nd\t\n"))
    assert {r.slug: r.ancestors for r in tree.collect()} == {"a": ["b", "c"], "d": []}
    x = np.arange(6, dtype="<f4").reshape(2, 3)
    (tmp_path / "v.bin").write_bytes(b"".join(b"kk" + row.tobytes() for row in x))
    got = files.read_vectors(spark, str(tmp_path / "v.bin"), 3, 2).collect()
    assert [(bytes(r.key), r.vec) for r in got] == [(b"kk", [0, 1, 2]), (b"kk", [3, 4, 5])]
    (tmp_path / "w.bin").write_bytes(b"123")
    with pytest.raises(ValueError, match="expected records of 12 bytes"):
        files.read_vectors(spark, str(tmp_path / "w.bin"), 3)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "A", "A", "", 3, ["b"], [], ["t"], None, 2)], "id string, title string, display_title string, description string, difficulty int, prereqs array<string>, occupations array<string>, topics array<string>, grade_start int, grade_end int")
    sinks.write_tables([(df, files.FINAL, str(tmp_path / "final"))], "gzip")
    back = files.typed(files.read_tsv(spark, str(tmp_path / "final")), files.FINAL)
    assert [tuple(r) for r in back.collect()] == [("a", "A", "A", "", 3, ["b"], [], ["t"], None, 2)]
    with pytest.raises(ValueError, match="column difficulty"):
        sinks.write_tables([(df.selectExpr("id", "title", "display_title", "description", "99 difficulty", "prereqs", "occupations", "topics", "grade_start", "grade_end"), files.FINAL, str(tmp_path / "final"))])
    assert (tmp_path / "final").exists()
    sinks.write_statistics(spark, {"rows": 1}, str(tmp_path / "s.json"))
    assert json.loads((tmp_path / "s.json").read_text()) == {"rows": 1}
    text, ok = sinks.scorecard_json(spark.createDataFrame([("x", 1.0), ("y", 0.5)], "condition string, score double"))
    assert json.loads(text)["y"] == {"0": 0.5} and not ok


def test_answers(spark, tmp_path):
    inbox, store, mark = tmp_path / "inbox", str(tmp_path / "store"), str(tmp_path / "mark")
    inbox.mkdir()
    write(inbox / "1.txt", "a\tone\nb\ttwo\n")
    answers.ingest(spark, str(inbox), store, mark)
    write(inbox / "2.txt", "a\tlater\nc\tthree\n")
    answers.ingest(spark, str(inbox), store, mark)
    answers.ingest(spark, str(inbox), store, mark)
    cache = spark.read.parquet(store)
    assert {(r.key, r.value) for r in cache.collect()} == {("a", "one"), ("b", "two"), ("c", "three")}
    items = spark.createDataFrame([("a", "p"), ("d", "q"), ("e", "q"), (None, "r")], "name string, prompt string")
    assert [(r.key, r.prompt) for r in answers.targets(items, cache, "name", "prompt").collect()] == [("d", "q")]
    assert answers.prune(cache, spark.createDataFrame([("c",)], "key string")).count() == 1
    sinks.append_answers(spark.createDataFrame([("z", "x\ty")], "key string, value string"), str(inbox))
    answers.ingest(spark, str(inbox), store, mark)
    assert spark.read.parquet(store).where("key = 'z'").first().value == "x y"
