"""Readers of skill lists: each turns one source's files into rows ``title, description, sources, tags``.

``tags`` is a comma-joined list. Rows that a source rules out come back in a
second frame with their reason where the reader says so; a broken file is an
error that names the value. Where the first of several rows counts, it is the
first in the file, by ``files.in_order``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions import text as X
from strandloom.operators.relational import assert_none, first_per_key
from strandloom.sources.files import column, in_order, read_csv, read_json, read_property_graph, read_tsv
from strandloom.sources.standards import read_case, read_occupations


def _rows(df: DataFrame, source: str, title: Column, description: Column, tags: Column) -> DataFrame:
    return df.select(title.alias("title"), F.coalesce(description, F.lit("")).alias("description"), F.lit(source).alias("sources"), tags.alias("tags"))


def _filled(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.trim(c), F.lit(""))


# --- concepts and occupations --------------------------------------------------------------------


def esco_skills(spark: SparkSession, path: str) -> DataFrame:
    """Concepts with a label; the description, or else the definition; tagged by their type."""
    df = read_csv(spark, path)
    label, kind = (column(df, c, path) for c in ("preferredLabel", "skillType"))
    said = F.coalesce(F.nullif(column(df, "description", path), F.lit("")), column(df, "definition", path))
    tag = F.when(F.coalesce(kind, F.lit("")) != "", F.concat(F.lit("esco:"), kind)).otherwise("esco")
    return _rows(df.where(F.coalesce(label, F.lit("")) != ""), "esco", X.upper_first(F.trim(label)), F.trim(said), tag)


def occupation_names(spark: SparkSession, esco: str, onet: str) -> DataFrame:
    """``label, description`` of all occupations, each label once whatever its case; the first list wins, then the first row."""
    a, b = in_order(read_csv(spark, esco)), in_order(read_tsv(spark, onet))
    one = a.select(F.lit(0).alias("src"), "ord", _filled(column(a, "preferredLabel", esco)).alias("label"), column(a, "description", esco).alias("d"))
    two = b.select(F.lit(1).alias("src"), "ord", _filled(column(b, "Title", onet)).alias("label"), column(b, "Description", onet).alias("d"))
    both = one.union(two).where("label is not null").withColumn("key", F.lower("label"))
    return first_per_key(both, ["key"], ["src", "ord"]).select("label", F.trim(F.coalesce("d", F.lit(""))).alias("description"))


def essential_occupations(spark: SparkSession, path: str) -> DataFrame:
    """``skill, occupations``: the occupations that need a skill, by the skill's slug, in the order of the file."""
    df = in_order(read_csv(spark, path))
    rows = df.where(column(df, "relationType", path) == "essential").select(X.slugify(F.coalesce(column(df, "skillLabel", path), F.lit(""))).alias("skill"), column(df, "occupationLabel", path).alias("occupation"), "ord").where("skill <> '' and occupation <> ''")
    one = rows.groupBy("skill", "occupation").agg(F.min("ord").alias("ord"))
    return one.groupBy("skill").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "occupation"))), lambda x: x["occupation"]).alias("occupations"))


def element_names(spark: SparkSession, path: str) -> DataFrame:
    """``element, name, description`` of the content model."""
    df = read_tsv(spark, path)
    return df.select(column(df, "Element ID", path).alias("element"), column(df, "Element Name", path).alias("name"), column(df, "Description", path).alias("description")).dropDuplicates(["element"])


def rated_occupations(spark: SparkSession, model: str, titles: str, ratings: list[str], most: int = 5) -> DataFrame:
    """``skill, occupation, rating, rank``: the occupations that rate a skill as most important."""
    names = element_names(spark, model).select("element", X.slugify("name").alias("skill"))
    t = read_tsv(spark, titles)
    occupations = t.select(column(t, "O*NET-SOC Code", titles).alias("code"), column(t, "Title", titles).alias("occupation")).where("code <> '' and occupation <> ''").dropDuplicates(["code"])
    each = None
    for path in ratings:
        df = read_tsv(spark, path)
        some = df.where(column(df, "Scale ID", path) == "IM").select(column(df, "O*NET-SOC Code", path).alias("code"), column(df, "Element ID", path).alias("element"), column(df, "Data Value", path).try_cast("double").alias("rating"))
        each = some if each is None else each.union(some)
    best = each.where("rating is not null").join(names, "element").join(occupations, "code").groupBy("skill", "occupation").agg(F.max("rating").alias("rating"))
    rank = F.row_number().over(Window.partitionBy("skill").orderBy(F.desc("rating"), "occupation"))
    return best.withColumn("rank", rank).where(F.col("rank") <= most)


def onet_elements(spark: SparkSession, model: str, files: dict[str, str]) -> DataFrame:
    """Each element that a file of ratings names, once a file; ``files`` maps a path to its tag. An unknown element is an error."""
    names = element_names(spark, model)
    out = None
    for path, tag in files.items():
        df = read_tsv(spark, path)
        used = df.select(column(df, "Element ID", path).alias("element")).where("element <> ''").distinct()
        assert_none(used.join(names, "element", "left_anti"), f"{path}: an element is not in the content model")
        rows = _rows(used.join(names, "element"), "onet", F.trim("name"), F.trim("description"), F.lit(tag))
        out = rows if out is None else out.union(rows)
    return out


def onet_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Tasks that have a type, each once whatever its case; the first row's type counts."""
    df = in_order(read_tsv(spark, path))
    rows = df.select("ord", _filled(column(df, "Task", path)).alias("task"), _filled(column(df, "Task Type", path)).alias("kind")).where("task is not null and kind is not null").withColumn("key", F.lower("task"))
    return _rows(first_per_key(rows, ["key"], ["ord"]), "onet", F.col("task"), F.lit(""), F.concat(F.lit("onet:task,onet:"), F.lower("kind")))


def onet_activities(spark: SparkSession, path: str) -> DataFrame:
    """Work activities, each title once whatever its case."""
    df = in_order(read_tsv(spark, path))
    rows = df.select("ord", _filled(column(df, "DWA Title", path)).alias("title")).where("title is not null").withColumn("key", F.lower("title"))
    return _rows(first_per_key(rows, ["key"], ["ord"]), "onet", F.col("title"), F.lit(""), F.lit("onet:dwa"))


# Fixed value: names of products that carry a company or a version.
BRAND = r"^[!\d]|\b(Inc|LLC|Corp|Corporation|Ltd|GmbH|Co\.)\b|\bSoftware\s+\d"


def onet_technologies(spark: SparkSession, path: str) -> DataFrame:
    """Hot technologies: of the rows of one name the first hot one counts, or else the first; brands are left out."""
    df = in_order(read_tsv(spark, path))
    hot = (F.coalesce(column(df, "Hot Technology", path), F.lit("")) == "Y").alias("hot")
    rows = df.select("ord", _filled(column(df, "Example", path)).alias("name"), F.trim(F.coalesce(column(df, "Commodity Title", path), F.lit(""))).alias("kind"), hot).where("name is not null")
    best = first_per_key(rows.withColumn("key", F.lower("name")).withColumn("cold", ~F.col("hot")), ["key"], ["cold", "ord"])
    best = best.where(F.col("hot") & ~F.col("name").rlike(BRAND))
    named = F.col("kind") != ""
    return _rows(best, "onet", F.col("name"), F.when(named, F.concat_ws(" — ", "name", "kind")), F.concat(F.lit("onet:tech"), F.when(named, F.concat(F.lit(",onet:tech:"), X.slugify("kind"))).otherwise("")))


LIGHTCAST = "data array<struct<name:string,type:struct<name:string>,category:struct<name:string>,subcategory:struct<name:string>>>"


def lightcast_skills(spark: SparkSession, path: str, infill: DataFrame, skip: str = "SKIP") -> DataFrame:
    """Skills but certifications; ``infill`` (``key, value`` by slug) describes them, else their category stands in and a tag says so."""
    rows = read_json(spark, path, LIGHTCAST).select(F.explode("data").alias("s")).select(_filled("s.name").alias("title"), F.coalesce("s.type.name", F.lit("")).alias("kind"), F.coalesce("s.category.name", "s.subcategory.name", F.lit("")).alias("category"))
    assert_none(rows.where("title is null"), f"{path}: a skill has no name")
    known = infill.select(F.col("key").alias("slug"), F.when(F.col("value") != skip, F.col("value")).alias("said"))
    full = rows.where("kind <> 'Certification'").withColumn("slug", X.slugify("title")).join(known, "slug", "left")
    good = (F.coalesce("said", F.lit("")) != "") & (F.trim("said") != F.col("kind"))
    stand_in = F.when(F.col("category") != "", F.concat_ws(" — ", "title", "category"))
    tag = F.concat(F.lit("lightcast"), F.when(F.col("kind") != "", F.concat(F.lit(":"), F.col("kind"))).otherwise(""), F.when(F.coalesce(good, F.lit(False)), "").otherwise(",desc:placeholder"))
    return _rows(full, "lightcast", F.col("title"), F.when(good, F.col("said")).otherwise(stand_in), tag)


def foundation_skills(foundations: DataFrame) -> DataFrame:
    """Curated hubs ``id, title, description, grade_start, grade_end`` as rows with grade tags; an id must be its title's slug."""
    assert_none(foundations.where(F.col("id") != X.slugify("title")).select("id", "title"), "a foundation's id is not the slug of its title")
    grade = lambda c: F.when(F.col(c) == 0, "K").when(F.col(c) == -1, "PK").otherwise(F.col(c).cast("string"))
    grades = F.array_distinct(F.filter(F.array(grade("grade_start"), grade("grade_end")), lambda g: g.isNotNull()))
    tags = F.array_join(F.concat(F.array(F.lit("foundation"), F.concat(F.lit("foundation:"), F.col("id"))), F.transform(grades, lambda g: F.concat(F.lit("grade:"), g))), ",")
    return _rows(foundations, "foundation", F.col("title"), F.col("description"), tags)


# --- frameworks ----------------------------------------------------------------------------------

# Frameworks that are tests, templates or copies of others, by the slug of their title.
SKIPPED_FRAMEWORKS = [
    "pcg-georgia-s-k-12-mathematics-standards-implementation-sy2023-2024-2", "florida-math-scope-and-sequence", "florida-science-scope-and-sequence-grade-3", "florida-social-studies-scope-and-sequence", "al-ela-alabama-ela-test", "al-mth-alabama-math-test",
    "al-sc-alabama-science-test", "al-ss-alabama-social-studies-test", "normalized-data-schema", "scope-and-sequence-framework-template", "norm-webb-s-depth-of-knowledge-dok-levels-of-cognitive-difficulty", "florida-ela-standards-best-3rd-grade",
    "florida-ela-standards-lafs-3rd-grade", "florida-science-standards-grade-3", "florida-social-studies-standards-grade-3", "gcps-aks-language-arts-2021-2022", "gcps-aks-mathematics-2022-2023", "indiana-academic-standards-for-mathematics-2020", "mathematics-b-e-s-t",
]


def framework_skills(spark: SparkSession, path: str, scaffolding: list[str], skipped: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of CASE packages, and the items left out, ``document, identifier, reason``.

    Of the items of one framework with one title, whatever its case, the first
    counts. Grades are an item's own or its nearest ancestors'; a framework
    without any is tagged as ungraded.
    """
    items, _ = read_case(spark, path)
    ungraded = items.groupBy("document").agg((F.max(F.coalesce(F.size("levels"), F.lit(0))) <= 0).alias("ungraded"))
    said = lambda c: F.trim(X.html_text(F.coalesce(F.col(c), F.lit(""))))
    full = items.join(ungraded, "document").withColumn("slug", X.slugify(F.coalesce("framework", F.lit("opensalt")))).withColumn("c", X.clean_statement(said("statement"), said("abbreviation"), said("notes"), F.col("type").isNotNull()))
    why = F.when(F.col("slug").isin(SKIPPED_FRAMEWORKS if skipped is None else skipped), "framework").when(F.coalesce(F.col("type").isin(scaffolding), F.lit(False)), "scaffolding").when(F.col("c.status") != "row", F.col("c.status"))
    full = full.withColumn("reason", why)
    good = full.where("reason is null").withColumn("key", F.lower("c.title")).withColumn("k", F.row_number().over(Window.partitionBy("document", "key").orderBy("pos")))
    none = F.array().cast("array<string>")
    grades = F.transform(F.filter(F.transform(F.coalesce("levels", none), X.normal_grade), lambda g: g != ""), lambda g: F.concat(F.lit("grade:"), g))
    exercise = F.nullif(F.regexp_extract(F.coalesce("notes", F.lit("")), r"khanacademy\.org/e/([\w.-]+)", 1), F.lit(""))
    tags = F.concat(
        F.array(F.lit("opensalt"), F.when(F.col("slug").startswith("sced-"), "sced:catalog"), F.when(F.col("ungraded"), "opensalt:ungraded-framework")), grades,
        F.filter(F.transform(F.coalesce("keywords", none), lambda w: F.concat(F.lit("topic:"), F.regexp_replace(F.regexp_replace(F.lower(w), "[^a-z0-9]+", "-"), "^-|-$", ""))), lambda t: t != "topic:"),
        F.array(F.when(F.coalesce("code", F.lit("")) != "", X.code_tag("code")), F.when(F.coalesce("type", F.lit("")) != "", F.concat(F.lit("opensalt:"), X.slugify("type"))), F.concat(F.lit("khan:"), exercise)),
    )
    rows = _rows(good.where("k = 1"), "opensalt", F.col("c.title"), F.col("c.description"), F.array_join(F.filter(tags, lambda t: t.isNotNull()), ","))
    return rows, full.where("reason is not null").select("document", "identifier", "reason").union(good.where("k > 1").select("document", "identifier", F.lit("title")))


# --- a property graph of standards ---------------------------------------------------------------


def graph_standards(spark: SparkSession, path: str, scaffolding: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Components and standards as rows with a ``key``, the ``key`` of every node, and the nodes left out with their reason.

    One row holds every standard of one title: the first gives its words, and
    tags are united in order. A node that a learning path names is tagged as
    such; more than four grades give no grade tag.
    """
    nodes, edges = read_property_graph(spark, path)
    # nodes are in the order of their ids, which are unique
    grades = F.when(F.size("grades") <= 4, F.transform("grades", lambda g: F.concat(F.lit("grade:"), X.normal_grade(g)))).otherwise(F.array().cast("array<string>"))
    path_ends = edges.where("rel = 'buildsTowards'").select(F.explode(F.array("src", "dst")).alias("id")).distinct().withColumn("on_path", F.lit(True))
    plain = nodes.withColumn("said", F.trim(X.html_text("text")))
    parts = plain.where("k = 'component'").select("id", X.upper_first(X.unmark("said")).alias("title"), F.lit("").alias("description"), F.concat(F.array(F.lit("learningcommons:component")), F.coalesce(grades, F.array().cast("array<string>"))).alias("tags"), F.col("id").alias("key"))
    items = plain.where("k = 'item'").join(path_ends, "id", "left").withColumn("c", X.clean_statement(F.col("said"), F.lit(""), F.lit(""), F.col("type").isNotNull()))
    note = F.col("said").rlike(r"^\*?\([^)]*\)\*?\z")
    reason = F.when(F.coalesce(F.col("type").isin(scaffolding), F.lit(False)), "scaffolding").when(note, "note").when(F.col("c.status") != "row", F.col("c.status"))
    judged = items.withColumn("reason", reason)
    code = X.code_tag(F.coalesce("code", F.lit("")))
    tags = F.filter(F.concat(F.array(F.lit("learningcommons:standard"), F.when(F.col("on_path"), "learningcommons:coherence")), F.coalesce(grades, F.array().cast("array<string>")), F.array(code)), lambda t: t.isNotNull())
    good = judged.where("reason is null").select("id", F.col("c.title").alias("title"), F.col("c.description").alias("description"), tags.alias("tags"))
    head = good.groupBy("title").agg(F.min("id").alias("key"), F.min(F.struct("id", "description")).getField("description").alias("description"))
    # tags of a statement that many states repeat are united tag by tag
    tag = good.select("title", "id", F.posexplode("tags").alias("p", "t")).groupBy("title", "t").agg(F.min(F.struct("id", "p")).alias("at"))
    united = tag.groupBy("title").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "t"))), lambda x: x["t"]).alias("tags"))
    standards = head.join(united, "title").select("key", "title", "description", F.array_join("tags", ",").alias("tags"))
    rows = parts.select("key", "title", "description", F.array_join("tags", ",").alias("tags")).unionByName(standards).withColumn("sources", F.lit("learningcommons"))
    keys = good.join(head.select("title", "key"), "title").select(F.col("id").alias("node"), "key").union(parts.select(F.col("id").alias("node"), "key"))
    return rows, keys, judged.where("reason is not null").select("id", "reason")


# --- exams, objectives, units, apprenticeships ---------------------------------------------------


EXAMS = "id string, name string, body string, domains array<struct<name:string,objectives:array<struct<title:string,sub:array<string>>>>>"


def exam_objectives(spark: SparkSession, path: str) -> DataFrame:
    """A row per objective of an exam's domain, described by exam, body, domain and sub-objectives; titles without a Latin letter are left out."""
    exams = read_json(spark, path, EXAMS)
    assert_none(exams.where("coalesce(id, '') = '' or coalesce(name, '') = '' or coalesce(body, '') = '' or domains is null").select("id", "name"), f"{path}: an exam lacks a field")
    rows = exams.select("name", "body", F.explode("domains").alias("d")).select("name", "body", F.col("d.name").alias("domain"), F.explode("d.objectives").alias("o")).select("name", "body", "domain", F.col("o.title").alias("title"), F.coalesce("o.sub", F.array().cast("array<string>")).alias("sub"))
    assert_none(rows.where("coalesce(domain, '') = '' or coalesce(title, '') = '' or exists(sub, s -> coalesce(s, '') = '')").select("name", "domain", "title"), f"{path}: an objective lacks a text")
    rows = rows.where(F.col("title").rlike("(?i)[a-z]"))
    more = F.when(F.size("sub") > 0, F.concat(F.lit(" "), F.array_join("sub", "; "))).otherwise("")
    return _rows(rows, "certatlas", X.strip_question("title"), F.concat(F.col("name"), F.lit(" ("), F.col("body"), F.lit("), "), F.col("domain"), F.lit("."), more), F.lit(""))


# Subjects and fields of experience by their letters in a code.
SUBJECTS = {
    "AR": "Art", "CI": "Science", "EF": "Physical education", "ER": "Religious education", "GE": "Geography", "HI": "History", "LI": "English language", "LP": "Portuguese language", "MA": "Mathematics",
    "LGG": "Languages", "MAT": "Mathematics", "CNT": "Natural sciences", "CHS": "Human and social sciences",
}
FIELDS = {
    "CG": "Body, gestures, and movement", "EO": "The self, the other, and us", "TS": "Traces, sounds, colors, and shapes", "EF": "Listening, speaking, thinking, and imagination", "ET": "Spaces, times, quantities, relations, and transformations",
}
# The forms of a code, for early, basic and upper-secondary schooling.
EARLY = r"^EI0([1-3])(CG|EO|TS|EF|ET)\d{2}\z"
BASIC = r"^EF(\d)(\d)(AR|CI|EF|ER|GE|HI|LI|LP|MA)\d{2}\z"
UPPER = r"^EM13(?:(LGG|MAT|CNT|CHS)\d{3}|(LP)\d{2})\z"
PORTUGUESE = r"(?i)\b(?:não|para|uma|pelos?|pelas?|dos|das)\b|ções\b"
OBJECTIVE = "array<struct<codigo:string,texto:string,grupo_etario:string,anos:array<int>,vigencia:struct<status:string>>>"


def objectives(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``code, text, grades, subject`` of national objectives in force; the code must agree with the group or the years, and be unique."""
    rows = None
    for path in paths:
        doc = read_json(spark, path, f"objetivos {OBJECTIVE}, habilidades {OBJECTIVE}")
        some = doc.select(F.explode(F.coalesce("objetivos", "habilidades")).alias("r")).select("r.*")
        rows = some if rows is None else rows.union(some)
    code = lambda p, k: F.nullif(F.regexp_extract("codigo", p, k), F.lit(""))
    named = lambda names, c: F.try_element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), c)
    low = F.when(code(BASIC, 1) == "0", code(BASIC, 2)).otherwise(code(BASIC, 1)).cast("int")
    years = F.when(low <= code(BASIC, 2).cast("int"), F.sequence(low, code(BASIC, 2).cast("int")))
    early = code(EARLY, 1).isNotNull() & (F.col("grupo_etario") == F.concat(F.lit("ei-grupo-0"), code(EARLY, 1)))
    basic = code(BASIC, 3).isNotNull() & (years == F.col("anos"))
    upper = F.col("codigo").rlike(UPPER)
    grades = F.when(early, F.array(F.lit("PK"))).when(basic, F.transform(years, lambda y: y.cast("string"))).when(upper, F.array(*map(F.lit, ("10", "11", "12"))))
    subject = F.when(early, named(FIELDS, code(EARLY, 2))).when(basic, named(SUBJECTS, code(BASIC, 3))).when(upper, named(SUBJECTS, F.coalesce(code(UPPER, 1), code(UPPER, 2))))
    assert_none(rows.where("coalesce(trim(texto), '') = '' or coalesce(vigencia.status, '') <> 'vigente'").select("codigo", "texto"), "expected a text in force")
    out = rows.select(F.col("codigo").alias("code"), F.trim("texto").alias("text"), grades.alias("grades"), subject.alias("subject"))
    assert_none(out.where("grades is null or subject is null").select("code"), "a code contradicts its group or years, or has another form")
    assert_none(out.groupBy("code").count().where("count > 1"), "a code is used twice")
    return out


def objective_skills(rows: DataFrame, english: DataFrame) -> DataFrame:
    """Objectives titled by their translation, ``key, value`` by code; a missing or half-translated one is an error."""
    full = rows.join(english.select(F.col("key").alias("code"), F.col("value").alias("title")), "code", "left")
    assert_none(full.where(F.col("title").isNull() | (F.trim("title") == "") | F.col("title").rlike(PORTUGUESE) | F.col("title").rlike(r"[\t\r\n]")).select("code", "title"), "expected an English translation")
    tags = F.concat(F.lit("bncc:objective,bncc:subject:"), X.slugify("subject"), F.lit(","), F.array_join(F.transform("grades", lambda g: F.concat(F.lit("grade:"), g)), ","), F.lit(",code:"), F.col("code"))
    return _rows(full, "bncc", F.col("title"), F.lit(""), tags)


UNIT = "unitSlug string, unitTitle string, description string, year int, priorKnowledgeRequirements array<string>"
PLACE = "struct<unitTitle:string,unitOrder:int,unitSlug:string,unitOptions:array<struct<unitSlug:string>>,threads:array<struct<threadSlug:string>>>"
TIER = f"struct<tierSlug:string,units:array<{PLACE}>>"
YEAR = f"year string, title string, units array<{PLACE}>, tiers array<{TIER}>, examSubjects array<struct<examSubjectSlug:string,units:array<{PLACE}>,tiers:array<{TIER}>>>"


def units(spark: SparkSession, path: str) -> DataFrame:
    """``slug, title, description, year, prior`` of teaching units of the years 1 to 11."""
    rows = read_json(spark, path, UNIT)
    assert_none(rows.where("unitSlug is null or unitTitle is null or description is null or year is null or year not between 1 and 11").select("unitSlug", "year"), f"{path}: expected a unit of the years 1 to 11")
    assert_none(rows.groupBy("unitSlug").count().where("count > 1"), f"{path}: a unit is given twice")
    return rows.select(F.col("unitSlug").alias("slug"), F.col("unitTitle").alias("title"), F.trim("description").alias("description"), "year", F.coalesce("priorKnowledgeRequirements", F.array().cast("array<string>")).alias("prior"))


def tracks(spark: SparkSession, sequences: DataFrame, known: DataFrame) -> DataFrame:
    """``track, pos, slugs, threads``: the ways through a subject. ``sequences``: ``subject, sequence, path``; ``known``: ``slug`` of units.

    A year of a sequence holds units, tiers of units, or exam subjects that hold
    either; each tier and exam subject is a variant. A track is the subject's
    primary sequence followed by one variant of a secondary one; years without
    variants belong to all variants of their sequence.
    """
    flat = None
    for r in sequences.select("subject", "sequence", "path").collect():  # a row per sequence of an index
        years = read_json(spark, r.path, YEAR).withColumn("y", F.monotonically_increasing_id())
        kinds = sum(F.col(c).isNotNull().cast("int") for c in ("units", "tiers", "examSubjects"))
        assert_none(years.where(kinds != 1).select("year"), f"{r.path}: expected one of units, tiers or exam subjects")
        subject = years.select("y", F.explode("examSubjects").alias("e"))
        place = lambda df, variant, c: df.select("y", variant.alias("variant"), F.explode(c).alias("u"))
        tier = years.select("y", F.explode("tiers").alias("t"))
        inner = subject.select("y", "e.examSubjectSlug", F.explode("e.tiers").alias("t"))
        some = (
            place(years.where("units is not null"), F.lit(None).cast("string"), F.col("units"))
            .union(place(tier, F.col("t.tierSlug"), F.col("t.units")))
            .union(place(subject.where("e.units is not null"), F.col("e.examSubjectSlug"), F.col("e.units")))
            .union(place(inner, F.concat_ws(" ", "examSubjectSlug", "t.tierSlug"), F.col("t.units")))
        )
        some = some.select(F.lit(r.subject).alias("subject"), F.lit(r.sequence).alias("sequence"), "*")
        flat = some if flat is None else flat.union(some)
    assert_none(flat.where("(u.unitSlug is null) = (u.unitOptions is null) or u.unitOrder is null").select("sequence"), "expected a unit or its options, with an order")
    slugs = F.coalesce(F.transform("u.unitOptions", lambda o: o["unitSlug"]), F.array("u.unitSlug"))
    flat = flat.select("subject", "sequence", "variant", "y", F.col("u.unitOrder").alias("n"), slugs.alias("slugs"), F.coalesce(F.transform("u.threads", lambda t: t["threadSlug"]), F.array().cast("array<string>")).alias("threads"))
    assert_none(flat.select(F.explode("slugs").alias("slug")).join(known.select("slug"), "slug", "left_anti"), "a track names an unknown unit")
    # the variants of a sequence, or one without a name
    variants = flat.select("subject", "sequence", "variant").distinct().groupBy("subject", "sequence").agg(F.collect_set("variant").alias("v")).select("subject", "sequence", F.explode(F.when(F.size("v") > 0, F.col("v")).otherwise(F.array(F.lit("")))).alias("way"))
    years_ = flat.where("variant is not null").select("sequence", "y").distinct().join(variants.select("sequence", "way"), "sequence")
    assert_none(years_.join(flat.select("sequence", "y", F.col("variant").alias("way")), ["sequence", "y", "way"], "left_anti"), "a year lacks a variant of its sequence")
    whole = flat.join(variants, ["subject", "sequence"]).where(F.col("variant").isNull() | (F.col("variant") == F.col("way"))).drop("variant")
    primary = F.col("sequence").endswith("-primary")
    assert_none(variants.where(primary).groupBy("subject").count().where("count > 1"), "a subject has several primary tracks")
    second = variants.where(~primary).select("subject", F.concat_ws("/", "sequence", "way").alias("track"))
    ways = variants.select("subject").distinct().join(second, "subject", "left").select("subject", F.coalesce("track", "subject").alias("track"))
    lead = whole.where(primary).join(ways, "subject").select("track", F.lit(0).alias("part"), "y", "n", "slugs", "threads")
    rest = whole.where(~primary).select(F.concat_ws("/", "sequence", "way").alias("track"), F.lit(1).alias("part"), "y", "n", "slugs", "threads")
    pos = F.row_number().over(Window.partitionBy("track").orderBy("part", "y", "n"))
    return lead.union(rest).select("track", pos.alias("pos"), "slugs", "threads")


def unit_skills(rows: DataFrame) -> DataFrame:
    """Units as rows; the first year is the kindergarten of the grade tags."""
    grade = F.when(F.col("year") == 1, "K").otherwise((F.col("year") - 1).cast("string"))
    return _rows(rows, "oak", X.strip_question("title"), F.col("description"), F.concat(F.lit("oak:"), F.col("slug"), F.lit(",grade:"), grade))


def apprenticeship_skills(spark: SparkSession, path: str) -> DataFrame:
    """Knowledge and skill statements of apprenticeship standards, tagged by occupation and level."""
    items, _ = read_occupations(spark, path)
    return _rows(items, "skillsengland", X.strip_question("text"), F.lit(""), F.concat(F.lit("occupation:"), X.slugify("occupation"), F.lit(",skillsengland:level:"), F.col("level").cast("string")))


# --- the list as a whole -------------------------------------------------------------------------


def list_guards(rows: DataFrame, sources: list[str], least: int) -> DataFrame:
    """``source, n_rows`` of a finished list; an empty source, too few rows, or a tag with a comma inside is an error.

    ``rows``: ``sources, tags`` as arrays.
    """
    assert_none(rows.where(F.exists("tags", lambda t: t.contains(","))).select("sources", "tags"), "expected tags without a comma")
    counts = rows.select(F.explode(F.array_distinct("sources")).alias("source")).groupBy("source").agg(F.count("*").alias("n_rows"))
    wanted = rows.sparkSession.createDataFrame([(s,) for s in sources], "source string")
    assert_none(wanted.join(counts, "source", "left_anti"), "a source gives no rows")
    n = rows.count()
    if n < least:
        raise ValueError(f"expected at least {least} rows, received {n}")
    return counts


def tag_values(rows: DataFrame, prefix: str) -> DataFrame:
    """``value, id``: what follows the prefix in a row's tags; of several ids with one value the first by ``ord`` counts. ``rows``: ``id, ord, tags``."""
    found = F.filter(F.split("tags", ","), lambda t: t.startswith(prefix))
    each = rows.select("id", "ord", F.explode(found).alias("t")).select(F.substring("t", len(prefix) + 1, 1_000_000).alias("value"), "ord", "id")
    return each.groupBy("value").agg(F.min(F.struct("ord", "id")).getField("id").alias("id"))


# Names of technologies that are known although they have three characters at most.
SHORT_NAMES = ["r", "go", "c#", "c++", "ada", "apl", "awk", "css", "db2", "git", "ios", "jet", "lua", "mdx", "mmx", "php", "qml", "sql", "tcl", "xml", "yml", "vim", "tex", "rsa"]


def enrichment_targets(rows: DataFrame, longest: int = 120) -> DataFrame:
    """``id, title, task``: what a row lacks: a shorter title (``summary``), or a description (``infill``, ``onet``, ``opensalt``).

    ``rows``: ``id, title, description, sources, tags`` as text. A row may lack
    several; a short name that is not known is too opaque to describe.
    """
    said = F.coalesce("description", F.lit("")) != ""
    n = F.length("title")
    opaque = (n <= 3) & ~F.lower("title").isin(SHORT_NAMES)
    tasks = [
        ("summary", (n > longest) | (F.length(X.slug_base("title")) > 80)),
        ("infill", F.col("sources").contains("lightcast") & (~said | F.coalesce(F.col("tags").contains("desc:placeholder"), F.lit(False))) & ~opaque),
        ("onet", (F.col("sources") == "onet") & ~said & (n < 120)),
        ("opensalt", (F.col("sources") == "opensalt") & ~said & n.between(8, 120)),
    ]
    wanted = F.filter(F.array(*(F.when(c, F.lit(name)) for name, c in tasks)), lambda t: t.isNotNull())
    return rows.select("id", "title", F.explode(wanted).alias("task"))
