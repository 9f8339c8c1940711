import pytest
from pyspark.sql import functions as F

from strandloom.functions import hashing as H
from strandloom.functions import text as X


def apply(spark, function, *values):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, x string")
    return [r.y for r in df.select("k", function(F.col("x")).alias("y")).orderBy("k").collect()]


def test_slugs(spark):
    assert apply(spark, X.slugify, "Straße & Søren", "Łódź", "Iğdır ılık", "R&amp;D  Basics", "日本語", "", None, "--a -- b-") == ["strasse-soren", "lodz", "igdir-ilik", "r-d-basics", "", "", None, "a-b"]
    long = " ".join(f"word{i}" for i in range(30))
    (slug,) = apply(spark, X.slugify, long)
    assert len(slug) <= 80 and slug.startswith("word0-word1-") and slug.rsplit("-", 1)[1].isalnum()
    (single,) = apply(spark, X.slugify, "x" * 90)
    assert len(single) == 80


def test_hashes(spark):
    assert apply(spark, H.h32, "learningcommons|a->b", "", None) == [2801957023, 2166136261, None]
    assert apply(spark, H.string_hash, "hello", "Aa", "") == [99162322, 2112, 0]
    assert all(-0.0005 <= x < 0.0005 for x in apply(spark, H.jitter, "a", "zz", "long id"))


def test_keys(spark):
    assert apply(spark, X.fold_key, "Hidden Markov Models", "ordering fractions", "Order fractions", "glass", "Studies used") == ["hidden markov model", "order fraction", "order fraction", "glass", "study used"]
    assert apply(spark, X.fuzzy_key, "Café (basic) -- Skills", "日本") == ["cafe skills", ""]
    assert apply(spark, X.token_signature, "The art of 3D and go", "Go art 3d") == ["3d art", "3d art"]
    assert apply(spark, X.tag_words, "These maps class skills") == [["maps", "class", "skills", "skill"]]


def test_cleaning(spark):
    assert apply(spark, X.normalize_text, "“A” – **bold**  x\u00a0") == ['"A" - bold x']
    assert apply(spark, X.denoise_title, "1. Perform the audit (e.g. x) and", "Plan trips, such as a b.", "Sums (A)") == ["Perform the audit", "Plan trips", "Sums"]
    assert apply(spark, X.strip_student_lead, "Students will be able to add", "SWBAT: read", "students can ", "plain") == ["Add", "Read", "students can ", "Plain"]
    assert apply(spark, X.strip_question, "What is rain?", "Can ?", "plain") == ["Rain", None, "Plain"]
    assert apply(spark, X.unmark, "*With modeling, prompting, and support* ask questions", "With modeling and support break words", "Encode _or_ after _w_", "* recognize own name") == ["ask questions", "break words", "Encode or after w", "recognize own name"]
    assert apply(spark, X.repair_encoding, "rÃ©sumÃ©", "café", "â€™s", None) == ["résumé", "café", "’s", None]
    assert apply(spark, X.html_text, "<p>variable.</p><p>Use</p>", "a &lt; b", "plain", None) == [" variable. Use", "a < b", "plain", None]
    assert apply(spark, lambda c: X.truncate_title(c, 20), "One two three. Four five six", "abcdefghijklmnopqrstuvwxyz", "short") == ["One two three.", "abcdefghijklmnopqrst…", "short"]
    assert apply(spark, X.clean_definition, ' "A thing." ', "I cannot say", "SKIP", "") == ["A thing.", "", "", ""]


def test_answers_and_descriptions(spark):
    assert apply(spark, X.is_summary, "Solve linear equations", "word " * 16) == [True, False]
    assert apply(spark, X.is_translation, "Read maps", "Ler uma carta", "two\nlines", " ", None) == [True, False, False, False, False]
    assert apply(spark, X.clean_description, "Note: add two", "3.", "Big Idea: x", "plain", None) == ["add two", "", "", "plain", None]


def test_html_rejects_scripts(spark):
    with pytest.raises(Exception, match="script"):
        apply(spark, X.html_text, "<script>x</script>")


def test_grades_and_courses(spark):
    assert apply(spark, X.tag_grades, "grade:09.10,topic:x,grade:K", "grade:CTE", "none", "grade:13") == [[10, 11, 1], [14], [], []]
    assert apply(spark, X.course_topic, "Introduction to Topology", "Calculus III for Engineers", "Microprocessors Lab", "Ethics in Islam", "Analytics for Accounting", "Advanced Topics in X Lab II", "Soil Mechanics and Laboratory") == [
        "Topology", "Calculus", "Microprocessors", "Ethics in Islam", "Analytics for Accounting", "X", "Soil Mechanics and Laboratory",
    ]
    assert apply(spark, X.code_tag, "Khan K.CC.1", "a", "abcd") == ["code:K.CC.1", None, None]
    assert apply(spark, X.plain_label, "hidden_markov (hmm)  models") == ["hidden markov models"]


def test_statements(spark):
    def status(c):
        return X.clean_statement(c, F.lit(""), F.lit(""), F.lit(False))

    got = apply(spark, status, "I can I can examine maps and charts", "MA.1.2", "", "Grade 3 overview", "Understand the parts of speech", "WCAG", "Students will solve two-step problems")
    assert [(r.status, r.title) for r in got][0] == ("row", "Examine maps and charts")
    assert [r.status for r in got] == ["row", "scaffold", "scaffold", "scaffold", "verb", "scaffold", "row"]
