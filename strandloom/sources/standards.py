"""Readers of curriculum data: frameworks, standard sets, outcomes, occupations, annotated pairs, courses, tracks.

Every reader declares the shape that it needs and turns nested documents into
rows; what does not resolve comes out with a reason instead of vanishing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions import text as X
from strandloom.operators import graph as G
from strandloom.operators.relational import assert_none, majority_votes
from strandloom.sources.files import read_csv, read_json

CASE = """CFDocument struct<identifier:string,title:string>, CFItems array<struct<identifier:string,fullStatement:string,abbreviatedStatement:string,notes:string,CFItemType:string,humanCodingScheme:string,educationLevel:array<string>,conceptKeywords:array<string>>>,
 CFAssociations array<struct<associationType:string,originNodeURI:struct<identifier:string>,destinationNodeURI:struct<identifier:string>>>"""


def read_case(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Items ``document, identifier, statement, abbreviation, notes, type, code, framework, pos, keywords, levels`` of CASE packages, and child links ``document, id, parent``.

    ``framework`` is the package's title, ``pos`` the item's place in it.

    An item without levels takes those of the nearest parent that has some;
    parents that give different levels are an error.
    """
    packages = read_json(spark, path, CASE).withColumn("document", F.col("CFDocument.identifier"))
    items = packages.select("document", F.col("CFDocument.title").alias("framework"), F.posexplode("CFItems").alias("pos", "i")).select(
        "document", "i.identifier", F.col("i.fullStatement").alias("statement"), F.col("i.abbreviatedStatement").alias("abbreviation"), "i.notes", F.col("i.CFItemType").alias("type"), F.col("i.humanCodingScheme").alias("code"), "framework", "pos", F.col("i.conceptKeywords").alias("keywords"), F.col("i.educationLevel").alias("levels"),
    )
    links = packages.select("document", F.explode("CFAssociations").alias("a")).where("a.associationType = 'isChildOf'").select("document", F.col("a.originNodeURI.identifier").alias("id"), F.col("a.destinationNodeURI.identifier").alias("parent")).where("parent <> document")
    links = links.join(items.select("document", F.col("identifier").alias("parent")), ["document", "parent"], "left_semi").select("document", "id", "parent")
    own = items.where(F.size("levels") > 0).select("document", F.col("identifier").alias("id"), F.array_join("levels", ",").alias("value"))
    two = links.join(own.select("document", F.col("id").alias("parent"), "value"), ["document", "parent"]).join(own.select("document", "id"), ["document", "id"], "left_anti").groupBy("document", "id").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).where("lo <> hi")
    assert_none(two, "parents give different levels")
    key = lambda c: F.concat_ws("\x1f", "document", c)
    found = G.inherited(items.select("document", F.col("identifier").alias("id")).join(links, ["document", "id"], "left").select(key("id").alias("id"), F.when(F.col("parent").isNotNull(), key("parent")).alias("parent")), own.select(key("id").alias("id"), "value"))
    full = items.withColumn("_key", key("identifier")).join(found.withColumnRenamed("id", "_key"), "_key", "left")
    return full.withColumn("levels", F.split(F.col("value"), ",")).drop("_key", "value"), links


SETS = "document struct<publicationStatus:string>, educationLevels array<string>, standards map<string, struct<id:string,parentId:string,description:string,statementLabel:string,statementNotation:string>>"


def read_standard_sets(spark: SparkSession, path: str, types: list[str]) -> DataFrame:
    """``title, description, tags, reason`` of the leaves of standard sets; headings, deprecated sets and scaffolding have a reason."""
    sets = read_json(spark, path, SETS).withColumn("file", F.input_file_name())
    rows = sets.select("file", F.col("document.publicationStatus").alias("status"), F.coalesce("educationLevels", F.array().cast("array<string>")).alias("levels"), F.explode(F.map_values("standards")).alias("s")).select("file", "status", "levels", "s.*")
    heading = rows.where("parentId is not null").select("file", F.col("parentId").alias("id"), F.lit(True).alias("heading")).distinct()
    clean = X.clean_statement(X.collapse(X.repair_encoding(F.coalesce("description", F.lit("")))), F.lit(""), F.lit(""), F.col("statementLabel").isNotNull())
    grades = F.filter(F.transform("levels", X.normal_grade), lambda g: g != "")
    note = F.trim(F.coalesce("statementNotation", F.lit("")))
    tags = F.concat(F.array(F.lit("csp")), F.when(F.size("levels") <= 4, F.transform(grades, lambda g: F.concat(F.lit("grade:"), g))).otherwise(F.array().cast("array<string>")), F.filter(F.array(F.when(~note.rlike(r"[\s,()]"), X.code_tag(note))), lambda t: t.isNotNull()))
    full = rows.join(heading, ["file", "id"], "left").withColumn("c", clean)
    reason = F.when(F.col("status") == "Deprecated", "deprecated").when(F.col("heading"), "heading").when(F.col("statementLabel").isin(types) | (F.col("c.status") != "row"), "scaffolding")
    return full.select("file", "id", "c.title", F.col("c.description").alias("description"), F.array_join(tags, ",").alias("tags"), reason.alias("reason"))


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """``title, tags`` of the learning outcomes of a JSON-LD graph; an unknown area, competence or level is an error."""
    node = "`@id` string, `@type` string, name string, description string, four_levels_name string, competence_area_id string, competence_id string, four_levels_proficiency_name string"
    inner = ",".join(part.strip().replace(" string", ":string") for part in node.split(","))
    nodes = read_json(spark, path, f"`@graph` array<struct<{inner}>>").select(F.explode("@graph").alias("n")).select("n.*")
    named = lambda kind, id, new: nodes.where(F.col("@type") == kind).select(F.col("@id").alias(id), F.col("name").alias(new))
    levels = nodes.where("`@type` = 'ProficiencyLevel'").select(F.col("four_levels_name").alias("level"), F.lit(True).alias("known")).distinct()
    rows = nodes.where("`@type` = 'LearningOutcome'").withColumn("level", F.regexp_replace("four_levels_proficiency_name", "^ProficiencyLevel/", ""))
    full = rows.drop("name").join(named("CompetenceArea", "competence_area_id", "area"), "competence_area_id", "left").join(named("Competence", "competence_id", "competence"), "competence_id", "left").join(levels, "level", "left")
    assert_none(full.where("area is null or competence is null or known is null").select("@id", "competence_area_id", "competence_id", "level"), "expected a known area, competence and level")
    tags = F.concat_ws(",", F.lit("digcomp:outcome"), *(F.concat(F.lit(f"digcomp:{k}:"), X.slugify(k)) for k in ("area", "competence", "level")))
    return full.select(F.col("description").alias("title"), tags.alias("tags"))


# Levels of outcomes, lowest first.
OUTCOME_LEVELS = ["basic", "intermediate", "advanced", "highly-advanced"]


def level_pairs(rows: DataFrame) -> DataFrame:
    """``src, dst``: within a competence, each outcome of a level before each of the next. ``rows``: ``id, tags``."""
    found = lambda name: F.regexp_extract_all("tags", F.lit(f"(?:^|,)digcomp:{name}:([^,]+)"), 1)
    rank = F.create_map(*(F.lit(x) for k, name in enumerate(OUTCOME_LEVELS) for x in (name, k)))
    s = rows.select("id", F.array_distinct(found("competence")).alias("comp"), F.transform(found("level"), lambda x: F.try_element_at(rank, x)).alias("ks")).where("size(comp) > 0 or size(ks) > 0")
    assert_none(s.where("size(comp) <> 1 or size(ks) = 0 or exists(ks, k -> k is null)"), "expected one competence and known levels")
    s = s.select("id", F.col("comp")[0].alias("comp"), F.array_min("ks").alias("k"))
    nxt = s.select(F.col("id").alias("dst"), "comp", (F.col("k") - 1).alias("k"))
    return s.join(nxt, ["comp", "k"]).where("id <> dst").select(F.col("id").alias("src"), "dst")


def thread_pairs(tracks: DataFrame) -> DataFrame:
    """``src, dst``: a unit before the next one of its track that shares a thread, every option with every option.

    ``tracks``: ``track, pos, slugs`` (array of options), ``threads`` (array).
    """
    flat = tracks.select("track", "pos", "slugs", F.explode(F.array_distinct("threads")).alias("thread"))
    before = F.lag("slugs").over(Window.partitionBy("track", "thread").orderBy("pos"))
    pairs = flat.withColumn("before", before).where("before is not null").select(F.explode("before").alias("src"), "slugs").select("src", F.explode("slugs").alias("dst"))
    return pairs.where("src <> dst").distinct()


OCCUPATIONS = "name string, level int, knowledges array<struct<detail:string>>, skills array<struct<detail:string>>, behaviours array<struct<detail:string>>"


def read_occupations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Statements ``occupation, level, text`` (knowledge and skills, no behaviours), and the occupations without any list."""
    rows = read_json(spark, path, OCCUPATIONS)
    assert_none(rows.where("level is null or level not between 2 and 7").select("name", "level"), "expected a level of 2 to 7")
    both = F.concat(F.coalesce("knowledges", F.array().cast("array<struct<detail:string>>")), F.coalesce("skills", F.array().cast("array<struct<detail:string>>")))
    text = F.regexp_replace(F.regexp_replace("x.detail", r"^(Core|Option \d+)\s*[-–:]\s*", ""), "™s\\b", "'s")
    items = rows.select(F.col("name").alias("occupation"), "level", F.explode(both).alias("x")).select("occupation", "level", text.alias("text"))
    assert_none(items.where("text is null or trim(text) = ''"), "expected a text after its label")
    return items, rows.where("knowledges is null and skills is null and behaviours is null").select("name")


# The lines of numbered topics in the files of annotated pairs, by their separator.
TOPIC_LINES = {
    "comma": r"^(\d+),(.+?)(?:,(?:NULL|https?://[^,]*))+\z",
    "bar": r"^(\d+)\|(.+)\z",
    "tab": r"^(\d+)\t(.+)\z",
}


def read_annotated(spark: SparkSession, sets: list[tuple[str, str, str]]) -> tuple[DataFrame, int]:
    """``pre, dep, positive`` of ``a,b,0|1`` lines over numbered topics, and how many lines name no topic.

    ``sets``: topic file, the kind of its lines (a key of ``TOPIC_LINES``, or a
    pattern with a group for number and name), annotation file. Numbers mean a
    topic only inside their set.
    """
    known_pairs, lost = None, 0
    for topics, kind, annotations in sets:
        pattern = TOPIC_LINES.get(kind, kind)
        line = spark.read.text(topics).select(F.regexp_replace("value", "\r$", "").alias("l")).where("l <> ''")
        assert_none(line.where(~F.col("l").rlike(pattern)), f"{topics}: expected a topic line")
        names = line.select(F.regexp_extract("l", pattern, 1).alias("n"), F.trim(F.regexp_extract("l", pattern, 2)).alias("name"))
        assert_none(names.groupBy("n").count().where("count > 1"), f"{topics}: expected a new number")
        rows = spark.read.text(annotations).select(F.regexp_replace("value", "\r$", "").alias("l")).where("l <> ''")
        assert_none(rows.where(~F.col("l").rlike(r"^\d+,\d+,[01]$")), f'{annotations}: expected "topic,topic,0|1"')
        cells = F.split("l", ",")
        full = rows.select(cells[0].alias("a"), cells[1].alias("b"), (cells[2] == "1").alias("positive")).join(names.select(F.col("n").alias("a"), F.col("name").alias("pre")), "a", "left").join(names.select(F.col("n").alias("b"), F.col("name").alias("dep")), "b", "left")
        known = F.col("pre").isNotNull() & F.col("dep").isNotNull()
        some = full.where(known).select("pre", "dep", "positive")
        known_pairs = some if known_pairs is None else known_pairs.union(some)
        lost += full.where(~known).count()
    return known_pairs, lost


def read_crowd(spark: SparkSession, path: str) -> DataFrame:
    """``pre, dep, positive`` of exercise pairs with a mean score of 1 to 9: positive above 5; the second is the prerequisite."""
    rows = read_csv(spark, path)
    score = F.col("Prerequisite_avg").try_cast("double")
    assert_none(rows.where("Exercise_A is null or Exercise_B is null or Exercise_A = '' or Exercise_B = ''").union(rows.where(score.isNull() | ~score.between(1, 9))), f"{path}: expected two names and a mean from 1 to 9")
    name = lambda c: F.translate(F.regexp_replace(c, r"_\d+(\.\d+)?$", ""), "_", " ")
    return rows.select(name("Exercise_B").alias("pre"), name("Exercise_A").alias("dep"), (score > 5).alias("positive"))


# A title that is only a code, and topics that are only a format.
CODE_TITLE = r"^[A-Z]{2,5}\s?\d{3,4}[A-Z]?\z"
FORMAT_ONLY = r"(?i)^(?:lab(?:oratory)?|practicum|workshop|seminar|studio|tutorial|clinical|lecture|capstone|honou?rs|internship|project|thesis|research|elective|introduction|special topics)\z"
TIMINGS = ["before", "concurrent", "before_or_concurrent"]


def course_pairs(courses: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prerequisites between course topics: ``src, dst`` that a majority of institutions orders this way, and ``source_prereq, target_course, reason`` of all others.

    ``courses``: ``dataset, code, title``; ``edges``: ``dataset, institution,
    source_prereq, target_course, is_alternative, timing``. A code means a
    course only inside its dataset; only ``before`` is a prerequisite.
    """
    assert_none(edges.where(~F.col("timing").isin(TIMINGS) | ~F.col("is_alternative").cast("string").isin("0", "1")), "expected a known timing and is_alternative as 0 or 1")
    title = X.collapse(F.coalesce("title", F.lit("")))
    named = courses.select("dataset", "code", F.nullif(title, F.lit("")).alias("t")).groupBy("dataset", "code").agg(F.min("t").alias("t"), F.countDistinct("t").alias("n"))
    topic = X.course_topic("t")
    reason = F.when(F.col("n") > 1, "ambiguous-code").when(F.col("n") == 0, "no-title").when(F.col("t").rlike(CODE_TITLE), "code-title").when(topic.rlike(FORMAT_ONLY), "no-topic")
    named = named.select("dataset", "code", topic.alias("topic"), reason.alias("why"))
    side = lambda code, p: named.select("dataset", F.col("code").alias(code), F.col("topic").alias(f"t{p}"), F.col("why").alias(f"w{p}"), F.lit(True).alias(f"k{p}"))
    e = edges.where("timing = 'before'").join(side("source_prereq", "s"), ["dataset", "source_prereq"], "left").join(side("target_course", "d"), ["dataset", "target_course"], "left")
    missing = lambda p: F.when(F.col(f"k{p}").isNull(), "no-course").otherwise(F.col(f"w{p}"))
    e = e.withColumn("reason", F.coalesce(missing("s"), missing("d"), F.when(F.lower("ts") == F.lower("td"), "same-topic")))
    good = e.where("reason is null").withColumn("a", F.lower("ts")).withColumn("b", F.lower("td"))
    votes = majority_votes(good, "a", "b", "institution").select("a", "b", "verdict")
    judged = good.join(votes, ["a", "b"])
    lost = judged.where("verdict <> 'kept'").select("source_prereq", "target_course", F.when(F.col("verdict") == "tie", "contested-order").otherwise("minority-order").alias("reason"))
    kept = judged.where("verdict = 'kept'").groupBy("a", "b").agg(F.min(F.struct("ts", "td")).alias("p")).select(F.col("p.ts").alias("src"), F.col("p.td").alias("dst"))
    return kept, e.where("reason is not null").select("source_prereq", "target_course", "reason").union(lost)


def wire_foundations(rules: DataFrame, ids: DataFrame) -> DataFrame:
    """``src, dst`` of rules that name a dependent or a pattern of ids; a pattern that matches nothing is an error."""
    assert_none(rules.where("(dependent is null) = (pattern is null)"), "expected either a dependent or a pattern")
    plain = rules.where("dependent is not null").select(F.col("prereq").alias("src"), F.col("dependent").alias("dst"))
    matched = ids.join(F.broadcast(rules.where("pattern is not null")), F.regexp_like("id", F.col("pattern"))).select("pattern", F.col("prereq").alias("src"), F.col("id").alias("dst"))
    assert_none(rules.where("pattern is not null").join(matched.select("pattern").distinct(), "pattern", "left_anti"), "a pattern matches no id")
    return plain.union(matched.select("src", "dst")).where("src <> dst").distinct()
