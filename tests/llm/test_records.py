import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from strandloom.llm import language, leakage, mixture, survivor

SKILL = "rec_id long, id string, title string, description string, grade_start int, source string, updated_at timestamp_ntz"
TRUST = [("board", 1), ("desk", 2), ("crawl", 3)]


def day(n):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)


# --- problem 4 ---


def test_survivors_ranked(spark):
    rows = [
        (1, "a", "TBD", "Ends well.", 99, "board", day(9)), (2, "a", "Good", "Broken off", 3, "desk", day(1)), (3, "a", "Late", "Two stops..", 4, "desk", day(2)),
        (4, "a", "Other", None, None, None, day(30)), (5, "b", "Ｎ/Ａ", " ", -5, "board", day(1)), (6, "b", "Same time", "Fine text.", None, "nobody", day(1)), (7, "b", "Same time", "Fine text.", None, None, day(1)),
        (8, "c", "Single", None, None, "board", None), (9, None, "No id", None, 1, "board", day(1)), (2, "a", "Good", "Broken off", 3, "desk", day(1)), (10, "d", None, None, None, "board", None), (11, "d", "?", None, None, "desk", None),
    ]
    df = spark.createDataFrame(rows, SKILL).withColumn("rank", F.lit("clash"))
    got = survivor.Survivors(df, spark.createDataFrame(TRUST, "source string, trust_rank int"), "ranked", 2)
    assert {(r.id, r.field, r.rec_id) for r in got.winners.collect()} == {("a", "title", 3), ("a", "description", 1), ("a", "grade_start", 3), ("b", "title", 6), ("b", "description", 6)}


def test_survivors_detect_copies(spark):
    rng = random.Random(1)
    rows, key = [], 0
    names = ["good1", "good2", "good3", "good4", "bad", "copy1", "copy2"]
    for i in range(300):
        truth = f"true {i}"
        wrong = f"false {i} {rng.randrange(50)}"
        bad = truth if rng.random() < 0.4 else wrong
        for s in names:
            value = bad if s in ("bad", "copy1", "copy2") else truth if rng.random() < 0.9 else f"false {i} {rng.randrange(1000)}"
            key += 1
            rows.append((key, f"i{i}", value, None, None, s, day(0)))
    trust = spark.createDataFrame([(s, k) for k, s in enumerate(names)], "source string, trust_rank int")
    got = survivor.Survivors(spark.createDataFrame(rows, SKILL), trust, "estimated")
    title = {r[0]: r[2] for r in rows}
    right = sum(title[r.rec_id].startswith("true") for r in got.winners.where("field = 'title'").collect())
    assert right >= 290
    dep = {frozenset((r.source_a, r.source_b)): r.probability for r in got.dependence.collect()}
    assert dep[frozenset(("copy1", "bad"))] > 0.9 and dep[frozenset(("copy2", "copy1"))] > 0.9
    assert dep[frozenset(("good2", "good1"))] < 0.1 and dep[frozenset(("copy1", "good1"))] < 0.1
    accuracy = {r.source: r.accuracy for r in got.accuracy.collect()}
    assert accuracy["good1"] > accuracy["bad"]
    # one rank for all, and no list at all: estimates and copying decide in the same way
    one = spark.createDataFrame([(s, 1) for s in names], "source string, trust_rank int")
    for trust in (one, one.where("false")):
        got = survivor.Survivors(spark.createDataFrame(rows, SKILL), trust, "trusted", 2)
        assert sum(title[r.rec_id].startswith("true") for r in got.winners.where("field = 'title'").collect()) >= 290
    # a step in trust outweighs every vote, however few the better sources and however bad
    two = spark.createDataFrame([(s, 1 if s == "bad" else 2) for s in names], "source string, trust_rank int")
    got = survivor.Survivors(spark.createDataFrame(rows, SKILL), two, "trusted", 2)
    assert {r.source for r in got.winners.where("field = 'title'").collect()} == {"bad"}


def test_survivors_many_unlisted_sources(spark, monkeypatch):
    monkeypatch.setattr(survivor, "MOST_SOURCES", 2)
    rows = [(k, "a", f"Value {k % 3}", None, None, f"s{k % 7}", day(k)) for k in range(40)]
    got = survivor.Survivors(spark.createDataFrame(rows, SKILL), spark.createDataFrame(TRUST, "source string, trust_rank int"), "ranked", 2)
    assert [r.rec_id for r in got.winners.collect()] == [39]
    assert got.accuracy.count() == len(TRUST) + 3


def test_survivors_empty(spark):
    got = survivor.Survivors(spark.createDataFrame([], SKILL), spark.createDataFrame(TRUST, "source string, trust_rank int"))
    assert got.winners.count() == 0
    with pytest.raises(ValueError, match="prior"):
        survivor.Survivors(spark.createDataFrame([], SKILL), spark.createDataFrame(TRUST, "source string, trust_rank int"), "other")


# --- problem 8 ---


def test_leaks(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = [
        (1, f"x {item} y"), (2, "Before ONE, two three\nfour five six seven eight nine ｔｅn after"), (3, "one two three four five six seven eight nine gap ten eleven"), (4, None), (5, ""),
        (6, "two three four five six seven eight nine ten eleven"), (7, "word " * 30_000 + item), (1, f"x {item} y"),
    ]
    items = [(10, item), (11, "too short an item"), (12, None), (13, item.replace("one", "uno"))]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("sketch", F.lit(1))
    e = spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 10), (2, 10), (6, 10), (7, 10), (1, 13), (6, 13), (7, 13)}
    for rows in (10**6, 0):
        assert {tuple(r) for r in leakage.leaks(d, e, broadcast_rows=rows).collect()} == want
    short = {(d, 11) for d, t in [(20, "It is too short: an item!"), (21, "too short an item of its own"), (22, "too short, item")] if "an item" in t.lower() and "short an" in t.replace(":", "")}
    more = d.unionByName(spark.createDataFrame([(20, "It is too short: an item!", 1), (21, "so, TOO short an item of its own", 1), (22, "too short, item", 1)], d.schema))
    assert {tuple(r) for r in leakage.leaks(more, e, least=2).collect()} == want | short
    held = {(r.doc_id, r.item_id): (r.shingles, r.held) for r in leakage.containment(d, e, leakage.leaks(d, e)).collect()}
    assert held[1, 10] == (8, 8) and held[2, 10] == (8, 6) and held[1, 13] == (8, 7)
    assert leakage.leaks(d.where("false"), e).count() == leakage.leaks(d, e.where("false")).count() == 0


def test_leaks_of_many_items_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(leakage, "BITS", 1 << 16)
    rng = random.Random(12)
    words = [f"w{i}" for i in range(12)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(4, 40)))) for k in range(300)]
    docs = []
    for k in range(300):
        parts = [rng.choice(words) for _ in range(rng.randrange(3, 60))]
        for _ in range(rng.randrange(3)):
            w = rng.choice(items)[1].split()
            at = rng.randrange(len(w))
            parts[rng.randrange(len(parts)) :] = w[at : at + rng.randrange(5, 25)]
        docs.append((k, " ".join(parts)))
    runs = lambda text, n: {" ".join(text.split()[i : i + n]) for i in range(len(text.split()) - n + 1)}
    want = {(d, i) for d, t in docs for i, u in items if runs(t, 7) & runs(u, 7)}
    d, e = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for rows in (10**6, 0):
        assert {tuple(r) for r in leakage.leaks(d, e, run=7, shingle=3, broadcast_rows=rows).collect()} == want


# --- problem 9 ---


def test_water_fill():
    got = mixture.water_fill({"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 1)}, {"a": 100, "b": 100, "c": 1000})
    assert got["a"] == 100 and got["b"] == 200 and got["c"] == 900
    got = mixture.water_fill({"a": (0.5, 1), "b": (0.5, 4)}, {"a": 1000, "b": 100}, 200)
    assert got == {"a": 100, "b": 100}
    assert mixture.water_fill({"a": (1.0, 3)}, {}) == {"a": 0}
    assert mixture.water_fill({}, {"a": 3}) == {}


@pytest.mark.skipif(not os.path.exists(mixture.TOKENIZER), reason="no vocabulary here")
def test_mixture(spark):
    docs = [(i, "some words of text " * (1 + i % 5), ["Big_One", " big-one", "BIG_ONE "][i % 3]) for i in range(900)] + [(1000 + i, "small text of words", "small") for i in range(30)] + [(2000, None, "small"), (2001, "", "small"), (2002, "other", "unknown"), (2003, "null", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("slot", F.lit("clash"))
    t = spark.createDataFrame([("big_one", 0.8, 1), ("SMALL", 0.15, 3), ("absent", 0.05, 2)], "source string, target_share double, max_repeats int")
    mix = mixture.Mixture(d, t, total=6000)
    shares = {r.source: r for r in mix.shares.collect()}
    assert shares["absent"].actual_share == 0 and shares["small"].most_repeats == 3
    small = shares["small"].available_tokens * 3
    assert shares["small"].taken_tokens == small
    assert abs(shares["big_one"].taken_tokens - (6000 - small)) <= 20
    assert abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9
    chosen = mix.chosen.collect()
    assert len({r.doc_id for r in chosen}) == len(chosen) and not {2000, 2002, 2003} & {r.doc_id for r in chosen}
    again = mixture.Mixture(d.repartition(7), t, total=6000).chosen
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in chosen}
    assert mixture.Mixture(d.where("false"), t).chosen.count() == 0


TABLES = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(mixture.TOKENIZER) or not os.path.isdir(TABLES), reason="no vocabulary or tables here")
def test_mixture_of_the_tables(spark):
    """Every figure again by other means: tokens one text at a time, amounts by bisection, the chosen ones from the order."""
    import base64

    import tiktoken

    documents, targets = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "mix_targets"))
    with open(mixture.TOKENIZER, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("test", pat_str=mixture.PATTERN, mergeable_ranks=ranks, special_tokens={})
    goal = {r.source: (r.target_share, r.max_repeats) for r in targets.collect()}
    size = {}
    for r in documents.select("doc_id", "source", "text").collect():
        source = (r.source or "").strip().lower().replace("-", "_")
        if r.text is not None and source in goal:
            size[r.doc_id] = (source, len(encoding.encode_ordinary(r.text)))
    have = {s: sum(n for t, n in size.values() if t == s) for s in goal}
    # the amount of a source is its cap, or its share times one factor for all
    total = sum(have.values())
    low, high = 0.0, 1e12
    for _ in range(200):
        factor = (low + high) / 2
        low, high = (factor, high) if sum(min(have[s] * m, share * factor) for s, (share, m) in goal.items()) < total else (low, factor)
    amount = {s: min(have[s] * m, share * low) for s, (share, m) in goal.items()}
    mix = mixture.Mixture(documents, targets)
    order = {r.doc_id: r.o for r in documents.select("doc_id").join(spark.createDataFrame([(d, n) for d, (_, n) in size.items()], "doc_id long, tokens long"), "doc_id").select("doc_id", F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id", "tokens"), 1).alias("o")).collect()}
    chosen = {r.doc_id: (r.source, r.tokens, r.repeats) for r in mix.chosen.collect()}
    assert all(chosen[d][:2] == size[d] for d in chosen)
    for s, (_, most) in goal.items():
        mine = {d: chosen.get(d, (s, n, 0))[2] for d, (t, n) in size.items() if t == s}
        taken = sum(k * size[d][1] for d, k in mine.items())
        longest = max((size[d][1] for d in mine), default=0)
        assert abs(taken - amount[s]) <= longest and all(k <= most for k in mine.values())
        assert len(set(mine.values())) <= 2
        if len(set(mine.values())) == 2:
            more, less = (k(mine.values()) for k in (max, min))
            assert max(order[d] for d, k in mine.items() if k == more) < min(order[d] for d, k in mine.items() if k == less)
    shares = {r.source: r for r in mix.shares.collect()}
    reached = sum(amount.values())
    assert all(abs(shares[s].actual_share - amount[s] / reached) < 0.01 for s in goal)


# --- problem 10 ---


def test_named_language(spark):
    labels = {"en": "en", "EN": "en", "en-GB": "en", "pt_BR": "pt", " Portuguese ": "pt", "deu": "de", "ger": "de", "xx": None, "und": None, "unknown": None, "": None, None: None, "zh-Hans-CN": "zh", "e n": None}
    df = spark.createDataFrame([(k,) for k in labels], "label string")
    assert {r.label: r.code for r in df.withColumn("code", language.named_language("label")).collect()} == labels


SENTENCES = {
    "en": ["the teacher explains the plan to the whole class", "every pair writes a short report about the garden", "they read the answer before the lesson ends"],
    "es": ["la maestra explica el plan a toda la clase", "cada pareja escribe un informe breve sobre el jardín", "leen la respuesta antes de que termine la lección"],
    "de": ["die lehrerin erklärt den plan vor der ganzen klasse", "jedes paar schreibt einen kurzen bericht über den garten", "sie lesen die antwort bevor die stunde endet"],
}


def test_languages(spark):
    rng = random.Random(3)
    say = lambda code: ". ".join(rng.sample(SENTENCES[code], 2)).capitalize() + "."
    rows = []
    for i in range(240):
        code = list(SENTENCES)[i % 3]
        label = code if rng.random() < 0.85 else rng.choice(["en", "es", "de"])
        rows.append((i, say(code), label))
    cases = [
        (1000, say("es") + "\n\n" + say("de") + "\n\n123 456", "es-MX"), (1001, say("en").upper(), "und"), (1002, 'La maestra explica "every pair writes a short report about the garden" a la clase.', "Spanish"),
        (1003, "", "en"), (1004, None, "en"), (1005, "LECCION respuesta\nclase jardin", "es"),
    ]
    df = spark.createDataFrame(rows + cases, "doc_id long, text string, lang string").withColumn("para_no", F.lit("clash"))
    out = {(r.doc_id, r.para_no): r for r in language.paragraphs(df).where("doc_id >= 1000").collect()}
    assert {k: r.lang for k, r in out.items()} == {(1000, 0): "es", (1000, 1): "de", (1000, 2): None, (1001, 0): "en", (1002, 0): "es", (1003, 0): None, (1005, 0): "es"}
    assert all(0 <= r.confidence <= 1 and (r.lang is None) == (r.confidence == 0) for r in out.values())
    wrong = {tuple(r) for r in language.mislabelled(df).where("doc_id >= 1000").collect()}
    assert wrong == {(1000, 1, "de"), (1001, 0, "en")}
    held_out = language.paragraphs(df).where("doc_id < 240").collect()
    assert sum(r.lang == list(SENTENCES)[r.doc_id % 3] for r in held_out) >= 238
    assert language.paragraphs(df.where("false")).count() == 0
