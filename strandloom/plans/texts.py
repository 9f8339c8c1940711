"""Queries over titles, statements, lists and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import hashing as H
from strandloom.functions import text as X
from strandloom.operators import relational as R
from strandloom.plans.tables import table

# Topics that name a framework, a wiki category or a year.
FRAMEWORK = r"-standards|-20\d\d|^sced-|^content-khan|^ccss$|^ngss$|next-generation-science|k-5-mathematics|adult-basic-education|cte-standards|curriculum|course-codes|^skills$|^content$|^learning-stage-|\d{4}-\d{4}|\d{2}-\d{2}-updates|scope-and-sequence|-sy\d{4}|-effective-starting|early-childhood-standards"
WIKI = r"-officials-and-employees$|-by-country$|-by-region$|-by-type$|-by-year$|-by-nationality$|-introduced-in-|-established-in-|-disestablished-in-|-founded-in-|-born-in-|-died-in-|-set-in-|^people-in-|-people$|-in-history$|^wikiproject-|-templates$|^years-in-|^decades-in-|^centuries-in-|-matches$|-aircraft$|-records$|-(judges|officials|employees|members|persons)$"
YEAR = r"(^|-)(19|20)\d\d(-|$)|^\d+$"
PLACE_OR_TIME = r"(?i)(\b(in|of|from|by|for)\b\s+(Europe|Asia|Africa|America|Oceania|Antarctica|England|France|Germany|China|Japan|India|Russia|USSR|USA|Britain|Scotland|Ireland|Italy|Spain|Canada|Australia|Mexico|Brazil|Argentina|Iran|Iraq|Egypt|Turkey|Greece))|(\bcentury|centuries|\bdecade|\b\d{4}s\b|\b\d{3,4}\s*(BC|AD|BCE|CE)\b)|(\bpeople\b|\bbiography|\bbiographies|\bdeaths\b|\bbirths\b|\bmarriage|\bfamily\b)|(\bdisasters|\bincidents|\baccidents|\bwars\b|\bbattles|\belections)|^(19|20)\d{2}s?\b|^\d{1,2}(st|nd|rd|th)\s*(century|millennium)"
SCAFFOLDING_TYPES = [
    "Grade Level", "Domain", "Strand", "Course", "Topic", "Cluster", "Component", "Section", "Module", "Chapter", "Unit", "Sub-Domain", "Category", "Connection", "Grade", "Grade Band", "Quarter", "Section Heading", "Pathway", "Subject", "Dimension",
    "Cognitive Complexity", "Performance Level", "Assignment", "Lesson", "Job Role", "Employee", "Team Leader", "People Leader", "Senior Leader", "Concepts and Practices",
]
# Defects of a finished list.
DEFECT_PREFIX = r"^((Unit|Lesson|Chapter|Benchmark|Standard)\s+[\d.]+|[A-Z][A-Za-z0-9]*(\.[A-Za-z0-9]+)+:\s|(I can,?|[Cc]an|[Cc]ould|[Ss]hould|[Hh]ow to|[Ww]hat is|[Ww]hy does)\s|[*_]*[Ww]ith\s+(modeling|prompting|guidance|support)|[*_])"
DEFECT_EMPHASIS = r"(^|\s)[*_]+[^*_\s][^*_]*[*_]+(\s|[,.]|$)"
DEFECT_ENCODING = r"[ÂÃâ][\x{80}-\x{bf}ŒœŠšŸŽžƒˆ˜–-›€™]|Â(\s|$)"


def q_slugify(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "skills").select("rec_id", X.slugify("title").alias("slug"))


def q_fold_key(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "skills").select("rec_id", X.fold_key("title").alias("fold"))


def q_token_signature(spark: SparkSession, folder: str) -> DataFrame:
    skills = table(spark, folder, "skills")
    return skills.select("id", X.token_signature("title").alias("signature")).where("signature <> ''").groupBy("signature").agg(F.countDistinct("id").alias("ids"), F.count("*").alias("n_rows"), F.min("id").alias("first_id"))


def q_word_sets(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "cf_items").select("item_no", F.array_join(F.array_sort(X.word_set("fullstatement")), " ").alias("words"), F.array_join(F.array_sort(X.tag_words("fullstatement")), " ").alias("tag_words"))


def q_clean_title(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "cf_items").select("item_no", X.denoise_title(X.normalize_text("fullstatement")).alias("title"))


def q_clean_statement(spark: SparkSession, folder: str) -> DataFrame:
    """No SQL: look-aheads. Status and title of every statement."""
    items = table(spark, folder, "cf_items")
    clean = X.clean_statement(X.html_text(X.normalize_text("fullstatement")), F.lit(""), F.lit(""), F.col("cfitemtype").isNotNull())
    return items.select("item_no", clean.alias("c")).select("item_no", "c.status", "c.title", "c.truncated")


def q_statement_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of statements by what drops them: scaffolding types, deprecation, length, slug overflow."""
    items = table(spark, folder, "cf_items").where("fullstatement is not null")
    words = F.size(F.filter(F.split("fullstatement", r"\s+"), lambda w: w != ""))
    why = (
        F.when(F.col("cfitemtype").isin(SCAFFOLDING_TYPES), "scaffolding").when(F.col("fullstatement").rlike(r"(?i)^DEPRECATED\b"), "deprecated")
        .when((words > 12) | (F.length("fullstatement") > 100), "long").when(F.length(X.slug_base("fullstatement")) > 80, "overflow").otherwise("kept")
    )
    return items.groupBy(why.alias("reason")).agg(F.count("*").alias("n_rows"))


def q_display_title(spark: SparkSession, folder: str) -> DataFrame:
    tag = F.coalesce(F.concat(F.lit("code:"), F.col("humancodingscheme")), F.lit(""))
    return table(spark, folder, "cf_items").select("item_no", X.display_title("fullstatement", tag).alias("display"))


def list_defects(rows: DataFrame) -> DataFrame:
    """One row: titles with a leftover prefix or emphasis, codes of fewer than four characters, and texts decoded twice. ``rows``: ``title, description, tags`` as text."""
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    short = F.size(F.filter(F.split(F.coalesce("tags", F.lit("")), ","), lambda t: t.startswith("code:") & (F.length(t) < len("code:") + 4)))
    return rows.agg(
        count(F.col("title").rlike(DEFECT_PREFIX)).alias("prefix"), count(F.col("title").rlike(DEFECT_EMPHASIS)).alias("emphasis"), F.sum(short).alias("short_codes"),
        count(F.coalesce(F.col("title").rlike(DEFECT_ENCODING), F.lit(False)) | F.coalesce(F.col("description").rlike(DEFECT_ENCODING), F.lit(False))).alias("encoding"),
    )


def defect_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Skills without tags, and statements with their code as one."""
    skills = table(spark, folder, "skills").select("title", "description", F.lit("").alias("tags"))
    return skills.union(table(spark, folder, "cf_items").select("fullstatement", "notes", F.coalesce(F.concat(F.lit("code:"), F.lower(F.regexp_replace("humancodingscheme", r"[\s,]", ""))), F.lit(""))))


def q_list_defects(spark: SparkSession, folder: str) -> DataFrame:
    return list_defects(defect_rows(spark, folder))


def q_fuzzy_merge(spark: SparkSession, folder: str) -> DataFrame:
    skills = table(spark, folder, "skills").withColumn("key", X.fuzzy_key("title"))
    out = R.merge_by_key(skills, "key", "rec_id", {"source": None, "topics": 20}, ["description"], ["title", "id"])
    return out.select("key", F.col("rec_id").alias("first_rec"), "n_rows", "title", "id", "description", F.col("source").alias("sources"), "topics")


def q_slug_collision(spark: SparkSession, folder: str) -> DataFrame:
    skills = table(spark, folder, "skills")
    merged = R.first_per_key(skills.withColumn("key", X.fuzzy_key("title")).where("key <> ''"), ["key"], ["rec_id"])
    slugs = merged.select("rec_id", X.slugify("title").alias("slug")).where("slug <> ''")
    return R.suffix_collisions(slugs, "slug", "rec_id")


def q_first_per_key(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "cf_items").select("identifier", "item_no", "fullstatement", "docidentifier").where("identifier is not null")
    return R.first_per_key(items, ["identifier"], ["item_no"])


def q_tag_grades(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "cf_items")
    tags = F.array_join(F.transform("educationlevel", lambda g: F.concat(F.lit("grade:"), X.normal_grade(g))), ",")
    found = X.tag_grades(tags)
    return items.select("item_no", F.array_min(found).alias("lowest"), F.array_max(found).alias("highest"))


def q_holdout(spark: SparkSession, folder: str) -> DataFrame:
    pairs = table(spark, folder, "skill_matches").where("id_a is not null and id_b is not null and method is not null")
    raw = F.concat("id_a", F.lit("->"), "id_b")
    return pairs.select("match_id", H.h32(F.concat("method", F.lit("|"), raw)).alias("h"), H.holdout("method", raw).alias("held_out"))


def q_junk_topics(spark: SparkSession, folder: str) -> DataFrame:
    topics = table(spark, folder, "skills").select(F.explode(F.split("topics", ",")).alias("t")).select(F.lower(F.trim("t")).alias("topic")).where("topic <> ''")
    return topics.groupBy("topic").agg(F.count("*").alias("n_rows")).withColumn("junk", F.col("topic").rlike(FRAMEWORK) | F.col("topic").rlike(WIKI) | F.col("topic").rlike(YEAR)).withColumn("place_or_time", F.regexp_replace("topic", "-", " ").rlike(PLACE_OR_TIME))


def q_clean_description(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "skills").select("rec_id", X.clean_description(X.normalize_text("description")).alias("description"), X.clean_definition("description").alias("definition"))


def q_resolve_concepts(spark: SparkSession, folder: str) -> DataFrame:
    """Prerequisites and concept labels as names, resolved to skills."""
    skills = table(spark, folder, "skills").select("id", "title", F.col("rec_id").alias("ord")).where("id is not null")
    names = table(spark, folder, "skills").select(F.explode(F.split("prereqs", ",")).alias("label")).union(table(spark, folder, "researchskillscollection_en").select("preferredlabel")).union(skills.select(F.regexp_replace("title", " ", "_"))).where("trim(label) <> ''")
    return R.resolve_concepts(names, skills)


def q_token_match(spark: SparkSession, folder: str) -> DataFrame:
    """Concepts and topics that share a rare word or two words; up to five topics a concept."""
    concepts = table(spark, folder, "researchskillscollection_en").select(F.lower("preferredlabel").alias("item")).where("item is not null").distinct()
    topics = table(spark, folder, "skills").select(F.explode(F.split("topics", ",")).alias("t")).select(F.lower(F.trim("t")).alias("ref")).where("ref <> ''").groupBy("ref").agg(F.count("*").alias("n")).where("n >= 2").select("ref")
    pairs = R.rare_token_matches(concepts.withColumn("words", X.tag_words("item")), topics.withColumn("words", X.tag_words("ref")), F.col("df") > 12)
    return R.top_per_key(pairs, ["item"], [F.desc("shared"), "ref"], 5).select("item", "ref", "shared", "rank")


def q_document_frequency(spark: SparkSession, folder: str) -> DataFrame:
    words = table(spark, folder, "skills").select(F.explode(X.word_set("title")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("df"))


def q_idf_prune(spark: SparkSession, folder: str) -> DataFrame:
    """Topics that at most 1.5 % of the rows have."""
    skills = table(spark, folder, "skills")
    topics = skills.select("rec_id", F.explode(F.split("topics", ",")).alias("t")).select("rec_id", F.lower(F.trim("t")).alias("topic")).where("topic <> ''").distinct()
    return topics.groupBy("topic").agg(F.count("*").alias("n")).where(F.col("n") <= 0.015 * skills.count())


def q_votes(spark: SparkSession, folder: str) -> DataFrame:
    votes = table(spark, folder, "skill_matches").where("lower(trim(verdict)) = 'same' and id_a is not null and id_b is not null").select(F.lower(F.trim("id_a")).alias("x"), F.lower(F.trim("id_b")).alias("y"), "method")
    return R.majority_votes(votes, "x", "y", "method")


def q_contested_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = table(spark, folder, "skill_matches").select(F.lower(F.trim("id_a")).alias("x"), F.lower(F.trim("id_b")).alias("y"), "method").where("method is not null")
    return R.contested(pairs, "x", "y", "method")


def q_frequency_cap(spark: SparkSession, folder: str) -> DataFrame:
    """At most 500 skills per occupation, the easiest."""
    rows = table(spark, folder, "skills").select("rec_id", "difficulty", F.explode(F.split("occupations", ",")).alias("o")).select("rec_id", "difficulty", F.lower(F.trim("o")).alias("occupation")).where("occupation <> ''").distinct()
    return R.cap_by_frequency(rows, "occupation", [F.asc_nulls_last("difficulty"), "rec_id"], 500)


def q_direct_first(spark: SparkSession, folder: str) -> DataFrame:
    """Three labels a row: its occupations first, then topics, none twice."""
    part = lambda c: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    return table(spark, folder, "skills").select("rec_id", F.array_join(F.slice(F.array_distinct(F.concat(part("occupations"), part("topics"))), 1, 3), ",").alias("labels"))


def q_top_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """The five nations of highest supplier balance for each part brand (rating join and top five)."""
    line, part, supplier, nation = (table(spark, folder, t) for t in ("lineitem", "part", "supplier", "nation"))
    best = line.select("l_partkey", "l_suppkey").distinct().join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("p_brand", "s_nationkey").agg(F.max("s_acctbal").alias("rating"))
    named = best.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("p_brand", "n_name", "rating")
    return R.top_per_key(named, ["p_brand"], [F.desc("rating"), "n_name"], 5)


def q_thread_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Consecutive event types of a user, each ordered pair once, with its count."""
    from pyspark.sql import Window

    events = table(spark, folder, "events")
    before = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return events.withColumn("src", before).where("src is not null and src <> event_type").groupBy("src", F.col("event_type").alias("dst")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


def q_pick_parser(spark: SparkSession, folder: str) -> DataFrame:
    """Answers of the form "none" or "2,5,9" to numbers from 1 to 20, at most 8, each once; anything else is null."""
    raw = table(spark, folder, "skills").select("rec_id", F.regexp_replace(F.coalesce("topics", F.lit("none")), "[^0-9,]+", "").alias("digits"), "difficulty", "grade_start")
    answer = F.when(F.col("difficulty") % 5 == 0, "None.").when(F.col("difficulty") % 5 == 1, F.concat(F.col("difficulty").cast("string"), F.lit(", "), F.coalesce(F.col("grade_start"), F.lit(3)).cast("string"))).otherwise(F.concat_ws(",", F.col("difficulty").cast("string"), F.lit("2"), F.col("difficulty").cast("string")))
    return raw.select("rec_id", parse_picks(answer, F.lit(20)).alias("picks"))


def parse_picks(answer, limit):
    """Comma-joined numbers of an answer; empty for "none"; null for prose or a number out of range."""
    t = F.regexp_replace(F.lower(X.trim(answer)), r"\.\z", "")
    numbers = F.array_distinct(F.transform(F.split(t, r"\s*,\s*"), lambda x: x.try_cast("int")))
    good = t.rlike(r"^\d+(\s*,\s*\d+)*\z") & F.forall(numbers, lambda k: k.between(1, limit))
    return F.when(t.isin("none", "n/a"), "").when(good, F.array_join(F.slice(numbers, 1, 8), ","))


QUERIES = {
    f.__name__: f
    for f in (
        q_slugify, q_fold_key, q_token_signature, q_word_sets, q_clean_title, q_clean_statement, q_statement_filters, q_display_title, q_list_defects, q_fuzzy_merge, q_slug_collision, q_first_per_key, q_tag_grades, q_holdout, q_junk_topics, q_clean_description,
        q_resolve_concepts, q_token_match, q_document_frequency, q_idf_prune, q_votes, q_contested_pairs, q_frequency_cap, q_direct_first, q_top_ratings, q_thread_pairs, q_pick_parser,
    )
}


# --- the same in SQL -----------------------------------------------------------------------------


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(words: list[str]) -> str:
    return "(" + ", ".join(map(quoted, words)) + ")"


def _nfkd(c: str) -> str:
    wide, plain = "".join(map(chr, range(0xFF01, 0xFF5F))), "".join(map(chr, range(0x21, 0x7F)))
    out = f"translate({c}, {quoted(wide)}, {quoted(plain)})"
    for a, b in (("ﬁ", "fi"), ("ﬂ", "fl"), ("…", "...")):
        out = f"replace({out}, '{a}', '{b}')"
    return f"regexp_replace(strip_accents({out}), '[\\x{{300}}-\\x{{36f}}]', '', 'g')"


def _slug_base(c: str) -> str:
    out = f"lower({_nfkd(c)})"
    for a, b in X.ASCII_LETTERS.items():
        out = f"replace({out}, '{a}', '{b}')"
    return f"regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace({out}, '[^a-z0-9-]', ' ', 'g')), ' +', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g')"


def _h32(c: str) -> str:
    """For ASCII texts."""
    return f"CASE WHEN {c} = '' THEN 2166136261 ELSE list_reduce(list_prepend(CAST(2166136261 AS HUGEINT), list_transform(string_split({c}, ''), lambda x: CAST(ascii(x) AS HUGEINT))), lambda h, x: (xor(h, x) * 16777619) % 4294967296) END"


def _slug(c: str) -> str:
    """Long slugs: words up to 73 characters with their hyphens, then the hash."""
    words = f"string_split({c}, '-')"
    kept = f"list_filter(list_transform(range(1, len({words}) + 1), lambda k: array_to_string({words}[1:k], '-')), lambda p: length(p) <= 72 + CASE WHEN contains(p, '-') THEN 1 ELSE 0 END)"
    return f"CASE WHEN length({c}) <= 80 THEN {c} ELSE coalesce({kept}[-1], substr({c}, 1, 73)) || '-' || substr(lpad(lower(to_hex(CAST({_h32(c)} AS BIGINT))), 8, '0'), 1, 6) END"


def _fuzzy(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({_nfkd(c)}), '\\([^)]*\\)', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


def _split(c: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda w: w <> '')"


_FOLD_WORD = """CASE WHEN length(w) > 4 AND w LIKE '%ies' THEN w[:-4] || 'y' WHEN length(w) > 5 AND w LIKE '%ing' THEN w[:-4] WHEN length(w) > 4 AND w LIKE '%ed' THEN w[:-3]
 WHEN length(w) > 3 AND w LIKE '%s' AND w NOT LIKE '%ss' THEN w[:-2] ELSE w END"""


def _fold(c: str) -> str:
    return f"array_to_string(list_transform({_split(c)}, lambda w: {_FOLD_WORD}), ' ')"


def _tag_words(c: str) -> str:
    kept = f"list_filter({_split(c)}, lambda w: length(w) >= 4 AND w NOT IN {listed(X.TAG_STOP)})"
    return f"list_distinct(list_concat({kept}, list_transform(list_filter({kept}, lambda w: length(w) >= 5 AND w LIKE '%s' AND w NOT LIKE '%ss'), lambda w: w[:-2])))"


def _word_set(c: str) -> str:
    return f"list_distinct(list_filter({_split(c)}, lambda w: length(w) >= 2 AND w NOT IN {listed(X.WORD_STOP)}))"


def _exploded(column: str, name: str, source: str = "skills", keep: str = "rec_id") -> str:
    return f"SELECT * FROM (SELECT {keep}, lower(trim(unnest(string_split({column}, ',')))) AS {name} FROM {source}) WHERE {name} <> ''"


_SIGNATURE = f"array_to_string(list_sort(list_filter({_split('title')}, lambda w: length(w) >= 2 AND w NOT IN {listed(X.SIGNATURE_STOP)} AND (length(w) >= 3 OR regexp_matches(w, '[0-9]')))), ' ')"


def _denoise(c: str) -> str:
    out = c
    for pattern, by in X.NOISE:
        once = pattern.lstrip("(?i)").startswith("^") or pattern.endswith("\\z")
        out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(by.replace('$1', chr(92) + '1'))}, 'g')" if not once else f"regexp_replace({out}, {quoted(pattern)}, {quoted(by.replace('$1', chr(92) + '1'))})"
    return f"trim(regexp_replace({out}, '[\\s\\x{{a0}}\\x{{feff}}\\pZ]+', ' ', 'g'))"


def _normal(c: str) -> str:
    out = f"translate({c}, '‘’‚‛“”„‟‐‑‒–—', {quoted(chr(39) * 4 + chr(34) * 4 + '-----')})"
    return f"trim(regexp_replace(regexp_replace({out}, '\\*\\*([^*]+)\\*\\*', '\\1', 'g'), '[\\s\\x{{a0}}\\x{{feff}}\\pZ]+', ' ', 'g'))"


_LAST = "CASE WHEN contains({t}, {m}) THEN length({t}) - position({r} IN reverse({t})) - {k} ELSE -1 END"


def _last(t: str, mark: str) -> str:
    return f"(CASE WHEN contains({t}, {quoted(mark)}) THEN length({t}) - position({quoted(mark[::-1])} IN reverse({t})) - {len(mark) - 1} ELSE -1 END)"


_STOP80 = f"greatest({_last('substr(t, 1, 80)', '. ')}, {_last('substr(t, 1, 80)', '? ')}, {_last('substr(t, 1, 80)', '! ')})"
_BLANK79 = _last("substr(t, 1, 79)", " ")
_GRADE = "CASE WHEN g IN ('KG', 'TK', 'K') THEN 1 WHEN g IN ('PR', 'PK', 'PRE-K', 'EC', 'PRE-KINDERGARTEN') THEN 0 WHEN regexp_matches(g, '^0?[0-9]{1,2}$') AND CAST(g AS INTEGER) BETWEEN 1 AND 12 THEN CAST(g AS INTEGER) + 1 WHEN g IN ('IT', 'CTE') THEN 14 WHEN regexp_matches(g, 'AP|COLLEGE|UG|UNDERGRAD') THEN 15 END"

ORACLE = {
    "q_slugify": f"SELECT rec_id, {_slug('b')} AS slug FROM (SELECT rec_id, {_slug_base('title')} AS b FROM skills)",
    "q_fold_key": f"SELECT rec_id, {_fold('title')} AS fold FROM skills",
    "q_token_signature": f"SELECT signature, count(DISTINCT id) AS ids, count(*) AS n_rows, min(id) AS first_id FROM (SELECT id, {_SIGNATURE} AS signature FROM skills) WHERE signature <> '' GROUP BY signature",
    "q_word_sets": f"SELECT item_no, array_to_string(list_sort({_word_set('fullstatement')}), ' ') AS words, array_to_string(list_sort({_tag_words('fullstatement')}), ' ') AS tag_words FROM cf_items",
    "q_clean_title": f"SELECT item_no, {_denoise(_normal('fullstatement'))} AS title FROM cf_items",
    "q_statement_filters": f"""
SELECT CASE WHEN cfitemtype IN {listed(SCAFFOLDING_TYPES)} THEN 'scaffolding' WHEN regexp_matches(fullstatement, '(?i)^DEPRECATED\\b') THEN 'deprecated'
  WHEN len(list_filter(regexp_split_to_array(fullstatement, '\\s+'), lambda w: w <> '')) > 12 OR length(fullstatement) > 100 THEN 'long' WHEN length({_slug_base('fullstatement')}) > 80 THEN 'overflow' ELSE 'kept' END AS reason, count(*) AS n_rows
FROM cf_items WHERE fullstatement IS NOT NULL GROUP BY 1""",
    "q_display_title": f"""
SELECT item_no, CASE WHEN length(t) <= 80 THEN t WHEN trim(coalesce(code, '')) <> '' AND length(code) <= 80 THEN code WHEN {_STOP80} > 30 THEN trim(substr(t, 1, {_STOP80} + 1))
  ELSE trim(CASE WHEN {_BLANK79} > 30 THEN substr(t, 1, {_BLANK79}) ELSE substr(t, 1, 79) END) || '…' END AS display
FROM (SELECT item_no, fullstatement AS t, trim(humancodingscheme) AS code FROM cf_items)""",
    "q_list_defects": f"""
WITH r AS (SELECT title, description, '' AS tags FROM skills UNION ALL SELECT fullstatement, notes, coalesce('code:' || lower(regexp_replace(humancodingscheme, '[\\s,]', '', 'g')), '') FROM cf_items)
SELECT count(*) FILTER (WHERE regexp_matches(title, {quoted(DEFECT_PREFIX)})) AS prefix, count(*) FILTER (WHERE regexp_matches(title, {quoted(DEFECT_EMPHASIS)})) AS emphasis,
  count(*) FILTER (WHERE tags LIKE 'code:%' AND length(tags) < 9) AS short_codes, count(*) FILTER (WHERE coalesce(regexp_matches(title, {quoted(DEFECT_ENCODING)}), false) OR coalesce(regexp_matches(description, {quoted(DEFECT_ENCODING)}), false)) AS encoding FROM r""",
    "q_fuzzy_merge": f"""
WITH k AS (SELECT *, {_fuzzy('title')} AS key FROM skills),
kept AS (SELECT * FROM k WHERE key <> ''),
one AS (SELECT key, min(rec_id) AS first_rec, count(*) AS n_rows, arg_min(struct_pack(t := title, i := id), rec_id) AS head,
  (list(description ORDER BY length(coalesce(description, '')) DESC, rec_id))[1] AS description FROM kept GROUP BY key),
src AS (SELECT key, string_agg(source, ',' ORDER BY place) AS sources FROM (SELECT key, source, min(rec_id) AS place FROM kept WHERE source <> '' GROUP BY 1, 2) GROUP BY key),
items AS (SELECT key, rec_id, unnest(string_split(topics, ',')) AS item, unnest(range(len(string_split(topics, ',')))) AS pos FROM kept),
seen AS (SELECT key, item, min(rec_id * 1000 + pos) AS place FROM items WHERE item <> '' GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY place) AS r, min(place // 1000) OVER (PARTITION BY key) AS head FROM seen),
top AS (SELECT key, string_agg(item, ',' ORDER BY place) AS topics FROM ranked WHERE r <= 20 OR place // 1000 = head GROUP BY key)
SELECT key, first_rec, n_rows, head.t AS title, head.i AS id, description, coalesce(sources, '') AS sources, coalesce(topics, '') AS topics FROM one LEFT JOIN src USING (key) LEFT JOIN top USING (key)""",
    "q_slug_collision": f"""
WITH m AS (SELECT rec_id, {_slug_base('title')} AS b FROM skills WHERE {_fuzzy('title')} <> '' QUALIFY row_number() OVER (PARTITION BY {_fuzzy('title')} ORDER BY rec_id) = 1),
s AS (SELECT rec_id, {_slug('b')} AS slug FROM m),
n AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY rec_id) AS k FROM s WHERE slug <> '')
SELECT rec_id, CASE WHEN k > 1 THEN regexp_replace(substr(slug, 1, 80 - length('-' || k)), '-$', '') || '-' || k ELSE slug END AS slug FROM n""",
    "q_first_per_key": "SELECT identifier, item_no, fullstatement, docidentifier FROM cf_items WHERE identifier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY item_no) = 1",
    "q_tag_grades": f"""
WITH g AS (SELECT item_no, upper(trim(unnest(educationlevel))) AS g FROM cf_items), d AS (SELECT item_no, {_GRADE} AS d FROM g)
SELECT c.item_no, CAST(min(d) AS INTEGER) AS lowest, CAST(max(d) AS INTEGER) AS highest FROM cf_items c LEFT JOIN d ON d.item_no = c.item_no GROUP BY c.item_no""",
    "q_holdout": f"SELECT match_id, CAST(h AS BIGINT) AS h, h % 5 = 0 AS held_out FROM (SELECT match_id, {_h32('s')} AS h FROM (SELECT match_id, method || '|' || id_a || '->' || id_b AS s FROM skill_matches WHERE id_a IS NOT NULL AND id_b IS NOT NULL AND method IS NOT NULL))",
    "q_junk_topics": f"SELECT topic, count(*) AS n_rows, regexp_matches(topic, {quoted(FRAMEWORK)}) OR regexp_matches(topic, {quoted(WIKI)}) OR regexp_matches(topic, {quoted(YEAR)}) AS junk, regexp_matches(replace(topic, '-', ' '), {quoted(PLACE_OR_TIME)}) AS place_or_time FROM ({_exploded('topics', 'topic')}) GROUP BY topic",
    "q_clean_description": f"""
SELECT rec_id, CASE WHEN d IS NULL THEN NULL WHEN {' OR '.join(f'regexp_matches(d, {quoted(p)})' for p in X.BOILERPLATE)} THEN '' ELSE regexp_replace(d, {quoted(X.DESCRIPTION_LABEL)}, '') END AS description,
  CASE WHEN r IS NULL THEN NULL WHEN regexp_matches(r, {quoted(X.REFUSAL)}) OR lower(r) = 'skip' THEN '' WHEN length(r) <= 400 THEN r ELSE substr(r, 1, 400) || '…' END AS definition
FROM (SELECT rec_id, {_normal('description')} AS d, regexp_replace(regexp_replace(regexp_replace(description, '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g'), '^[\\s"''*_-]+|[\\s"''*_-]+$', '', 'g'), '[\\s\\x{{a0}}\\x{{feff}}\\pZ]+', ' ', 'g') AS r FROM skills)""",
    "q_resolve_concepts": f"""
WITH s AS (SELECT id, title, rec_id, {_slug_base('title')} AS b, {_fold('title')} AS f FROM skills WHERE id IS NOT NULL),
t1 AS (SELECT lower(trim(title)) AS k, arg_min(id, rec_id) AS v FROM s WHERE trim(title) <> '' GROUP BY 1),
t2 AS (SELECT DISTINCT id AS k FROM s),
t3 AS (SELECT k, arg_min(id, rec_id) AS v FROM (SELECT {_slug('b')} AS k, id, rec_id FROM s) WHERE k <> '' GROUP BY 1),
t6 AS (SELECT f AS k, min(id) AS v FROM s WHERE f <> '' GROUP BY 1 HAVING min(id) = max(id)),
n AS (SELECT unnest(string_split(prereqs, ',')) AS label FROM skills UNION SELECT preferredlabel FROM researchskillscollection_en UNION SELECT replace(title, ' ', '_') FROM skills WHERE id IS NOT NULL),
c AS (SELECT DISTINCT label, trim(regexp_replace(regexp_replace(replace(label, '_', ' '), '\\([^)]*\\)', ' ', 'g'), '[\\s\\x{{a0}}\\x{{feff}}\\pZ]+', ' ', 'g')) AS clean FROM n WHERE trim(label) <> ''),
d AS (SELECT label, clean, {_slug_base('clean')} AS b, {_slug_base("replace(label, '_', ' ')")} AS rb, {_fold('clean')} AS f FROM c),
e AS (SELECT label, clean, f, {_slug('b')} AS slug, {_slug('rb')} AS raw FROM d)
SELECT e.label, CASE WHEN clean <> '' THEN coalesce(t1.v, a.k, t3.v, b.k, u.v, t6.v) END AS id,
  CASE WHEN clean <> '' THEN CASE WHEN t1.v IS NOT NULL THEN 'title' WHEN a.k IS NOT NULL THEN 'id' WHEN t3.v IS NOT NULL THEN 'slug' WHEN b.k IS NOT NULL THEN 'raw id' WHEN u.v IS NOT NULL THEN 'raw slug' WHEN t6.v IS NOT NULL THEN 'fold' END END AS rule
FROM e LEFT JOIN t1 ON t1.k = lower(clean) LEFT JOIN t2 a ON a.k = slug LEFT JOIN t3 ON t3.k = slug LEFT JOIN t2 b ON b.k = raw LEFT JOIN t3 u ON u.k = raw LEFT JOIN t6 ON t6.k = f""",
    "q_token_match": f"""
WITH c AS (SELECT DISTINCT lower(preferredlabel) AS item FROM researchskillscollection_en WHERE preferredlabel IS NOT NULL),
t AS (SELECT topic AS ref FROM ({_exploded('topics', 'topic')}) GROUP BY 1 HAVING count(*) >= 2),
cw AS (SELECT item, unnest({_tag_words('item')}) AS w FROM c), tw AS (SELECT ref, unnest({_tag_words('ref')}) AS w FROM t),
df AS (SELECT w, count(*) AS n FROM tw GROUP BY w),
p AS (SELECT item, ref, count(*) AS shared, max(CASE WHEN n > 12 THEN 0 ELSE 1 END) AS rare FROM cw JOIN tw USING (w) JOIN df USING (w) GROUP BY 1, 2)
SELECT item, ref, shared, CAST(row_number() OVER (PARTITION BY item ORDER BY shared DESC, ref) AS INTEGER) AS rank FROM p WHERE rare = 1 OR shared >= 2 QUALIFY rank <= 5""",
    "q_document_frequency": f"SELECT word, count(*) AS df FROM (SELECT unnest({_word_set('title')}) AS word FROM skills) GROUP BY word",
    "q_idf_prune": f"SELECT topic, count(DISTINCT rec_id) AS n FROM ({_exploded('topics', 'topic')}) GROUP BY topic HAVING count(DISTINCT rec_id) <= 0.015 * (SELECT count(*) FROM skills)",
    "q_votes": """
WITH v AS (SELECT lower(trim(id_a)) AS a, lower(trim(id_b)) AS b, count(DISTINCT method) AS votes FROM skill_matches WHERE lower(trim(verdict)) = 'same' AND lower(trim(id_a)) <> lower(trim(id_b)) GROUP BY 1, 2)
SELECT v.a, v.b, v.votes, coalesce(r.votes, 0) AS against, CASE WHEN v.votes > coalesce(r.votes, 0) THEN 'kept' WHEN v.votes = r.votes THEN 'tie' ELSE 'minority' END AS verdict FROM v LEFT JOIN v r ON r.a = v.b AND r.b = v.a""",
    "q_contested_pairs": """
WITH p AS (SELECT DISTINCT lower(trim(id_a)) AS a, lower(trim(id_b)) AS b, method AS source FROM skill_matches WHERE method IS NOT NULL)
SELECT p.a, p.b, p.source FROM p JOIN p q ON q.a = p.b AND q.b = p.a AND q.source = p.source WHERE p.a < p.b""",
    "q_frequency_cap": f"SELECT rec_id, difficulty, occupation FROM (SELECT DISTINCT rec_id, difficulty, occupation FROM ({_exploded('occupations', 'occupation', keep='rec_id, difficulty')})) QUALIFY row_number() OVER (PARTITION BY occupation ORDER BY difficulty NULLS LAST, rec_id) <= 500",
    "q_direct_first": """
WITH l AS (SELECT rec_id, list_filter(list_transform(list_concat(string_split(coalesce(occupations, ''), ','), string_split(coalesce(topics, ''), ',')), lambda x: lower(trim(x))), lambda x: x <> '') AS w FROM skills)
SELECT rec_id, array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i)[1:3], ',') AS labels FROM l""",
    "q_top_ratings": """
WITH b AS (SELECT p_brand, n_name, max(s_acctbal) AS rating FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
SELECT p_brand, n_name, rating, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY rating DESC, n_name) AS INTEGER) AS rank FROM b QUALIFY rank <= 5""",
    "q_thread_pairs": """
WITH e AS (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS src FROM events)
SELECT src, event_type AS dst, count(*) AS n, count(DISTINCT user_id) AS users FROM e WHERE src IS NOT NULL AND src <> event_type GROUP BY 1, 2""",
    "q_pick_parser": """
WITH a AS (SELECT rec_id, difficulty AS d, coalesce(grade_start, 3) AS g FROM skills),
n AS (SELECT rec_id, d, CASE WHEN d % 5 = 1 THEN CASE WHEN d = g THEN [d] ELSE [d, g] END ELSE CASE WHEN d = 2 THEN [2] ELSE [d, 2] END END AS l, d % 5 = 1 AND g < 0 AS minus FROM a)
SELECT rec_id, CASE WHEN d % 5 = 0 THEN '' WHEN d IS NULL THEN '2' WHEN minus OR list_min(l) < 1 OR list_max(l) > 20 THEN NULL ELSE array_to_string(l, ',') END AS picks FROM n""",
}
