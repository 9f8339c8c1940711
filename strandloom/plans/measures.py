"""Queries over vectors, difficulty, duplicates and quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import text as X
from strandloom.functions.hashing import jitter
from strandloom.operators import calibrate as C
from strandloom.operators import relational as R
from strandloom.operators import similarity as S
from strandloom.plans import graphs
from strandloom.plans.tables import table
from strandloom.plans.texts import _exploded, _word_set, listed, _split

DIM = 64


def _vectors(spark, folder):
    v = table(spark, folder, "skill_vectors").select("vec_id", "id", "embedding")
    return v, v.where("vec_id % 50 = 0")


def _difficulty(spark, folder):
    return table(spark, folder, "skills").where("id is not null and difficulty is not null").groupBy("id").agg(F.min("difficulty").alias("difficulty"))


def q_cosine_top(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50, against all, exactly."""
    v, q = _vectors(spark, folder)
    return S.exact_top_k(v, q, 5, "vec_id", "embedding", DIM).select("id", "other", F.round("cosine", 5).alias("cosine"), "rank")


def q_semantic_match(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest vector above 0.9 of each query; kept if the two ids share a word, else with the reason."""
    v, q = _vectors(spark, folder)
    best = S.best_match(v, q, 0.9, "vec_id", "embedding", DIM)
    a, b = v.select(F.col("vec_id").alias("id"), F.col("id").alias("ia")), v.select(F.col("vec_id").alias("other"), F.col("id").alias("ib"))
    both = best.join(a, "id").join(b, "other")
    shared = F.size(F.array_intersect(F.split("ia", "-"), F.split("ib", "-")))
    return both.select("id", "other", F.when(shared > 0, "kept").otherwise("no-token-overlap").alias("verdict"))


def q_duplicate_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return S.duplicate_vectors(table(spark, folder, "skill_vectors"), "embedding", "vec_id", 1).select("n", "first_id")


def q_neighbour_regression(spark: SparkSession, folder: str) -> DataFrame:
    """Difficulty of every query vector from its 15 nearest anchors that share a topic with it, or else of all; an anchor counts for itself."""
    v, q = _vectors(spark, folder)
    rows = table(spark, folder, "skills").where("id is not null")
    topics = rows.select("id", F.explode(F.split("topics", ",")).alias("t")).select("id", F.lower(F.trim("t")).alias("t")).where("t <> ''").groupBy("id").agg(F.collect_set("t").alias("topics"))
    full = lambda df: df.join(topics, "id", "left").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "topics", *(["difficulty"] if "difficulty" in df.columns else []))
    anchored = full(v.join(_difficulty(spark, folder), "id"))
    near = S.pooled_top_k(anchored, full(q), 15, DIM)
    values = anchored.select(F.col("id").alias("other"), F.col("difficulty").alias("value"))
    return S.neighbour_regression(near, values, own=values.withColumnRenamed("other", "id")).select("id", F.round("estimate", 4).alias("estimate"))


def _topic_rows(spark, folder):
    rows = table(spark, folder, "skills").where("difficulty is not null")
    topics = F.array_distinct(F.filter(F.transform(F.split(F.coalesce("topics", F.lit("")), ","), lambda t: F.lower(F.trim(t))), lambda t: t != ""))
    return rows.select("rec_id", F.col("difficulty").cast("double").alias("v"), F.explode_outer(topics).alias("topic"))


def q_topic_smoothing(spark: SparkSession, folder: str) -> DataFrame:
    return C.smooth_by_topic(_topic_rows(spark, folder), "rec_id", "v", "topic").select("rec_id", F.round(F.col("smoothed") + 1e-9, 5).alias("smoothed"))


def q_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Histogram of bands from smoothed difficulties."""
    smooth = C.smooth_by_topic(_topic_rows(spark, folder), "rec_id", "v", "topic")
    return smooth.select(C.band(F.round("smoothed", 6)).alias("band")).groupBy("band").agg(F.count("*").alias("n_rows"))


def q_anchors(spark: SparkSession, folder: str) -> DataFrame:
    """Anchor of each id: its lowest grade, unless its grades span all of school."""
    rows = table(spark, folder, "skills").where("id is not null").groupBy("id").agg(F.collect_set(F.when(F.col("grade_start").between(-1, 12), F.col("grade_start"))).alias("g"))
    return rows.select("id", C.anchors(F.col("g"), 12).alias("anchor"))


def q_isotonic(spark: SparkSession, folder: str) -> DataFrame:
    """No SQL: pooling. Difficulties calibrated by grades, and their bands."""
    rows = table(spark, folder, "skills").where("difficulty is not null and id is not null").select("rec_id", (F.col("difficulty") + jitter("id")).alias("x"), F.when(F.col("grade_start").between(-1, 12), F.col("grade_start").cast("double")).alias("y"))
    model = C.Isotonic(rows, "x", "y")
    return rows.select("rec_id", F.round(model.column("x"), 5).alias("calibrated")).withColumn("band", C.band("calibrated"))


def q_kendall_tau(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "skills").where("grade_start between -1 and 12").select("difficulty", "grade_start")
    return C.kendall_tau(rows, "difficulty", "grade_start").select("n", "concordant", "discordant", F.round("tau", 6).alias("tau"))


def q_inversion_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose difficulty is more than 5 bands from their grade: number, share and the widest gap."""
    rows = table(spark, folder, "skills").where("grade_start between -1 and 12 and difficulty is not null").select(F.abs(F.col("difficulty") - F.col("grade_start") - 2).alias("gap"))
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col("gap") > 5).alias("inverted"), F.max("gap").alias("widest"), F.round(F.avg((F.col("gap") > 5).cast("double")), 6).alias("share"))


def _first_rows(spark, folder):
    return R.first_per_key(table(spark, folder, "skills").where("id is not null and title is not null").select("id", "title", "topics", "rec_id", "source"), ["id"], ["rec_id"])


def q_bucket_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Near titles among the rows of one first topic."""
    rows = _first_rows(spark, folder).withColumn("topic", F.nullif(F.lower(F.trim(F.substring_index("topics", ",", 1))), F.lit(""))).withColumn("w", X.word_set("title")).withColumn("s", X.signature_words("title"))
    return S.bucket_pairs(rows, "topic", "id", "title", "w", "s").select("a", "b", F.round("jaccard", 6).alias("jaccard"))


def q_rare_word_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Near titles among rows that share one of their two rarest words."""
    rows = _first_rows(spark, folder).withColumn("w", X.signature_words("title"))
    return S.rare_word_pairs(rows, "id", "w").select("a", "b", F.round("jaccard", 6).alias("jaccard"))


# Words of one group exclude each other.
ANTONYMS = [
    ["theoretical", "practical", "applied"],
    ["commercial", "industrial", "residential", "military", "civil", "consumer"],
    ["1d", "2d", "3d", "4d"],
    ["first", "second", "third", "fourth", "fifth"],
    ["introductory", "advanced", "intermediate", "beginner", "basic"],
    ["micro", "macro", "nano", "mini", "mega"],
    ["pre", "post", "anti", "pro", "non", "sub", "super"],
    ["internal", "external"],
    ["public", "private"],
    ["input", "output"],
    ["front", "back", "side", "top", "bottom"],
    ["positive", "negative", "neutral"],
    ["online", "offline"],
    ["qualitative", "quantitative"],
    ["domestic", "international", "foreign"],
    ["static", "dynamic"],
    ["manual", "automatic", "automated"],
    ["wired", "wireless"],
    ["analog", "digital"],
    ["primary", "secondary", "tertiary"],
    ["open", "closed"],
    ["augmented", "mixed", "virtual"],
    ["ac", "dc"],
    ["z", "c", "bash", "fish", "ksh", "zsh"],
]


def antonyms(a, b):
    """Whether two word arrays hold different words of one group and none in common."""
    clash = F.lit(False)
    for group in ANTONYMS:
        words = F.array(*map(F.lit, group))
        x, y = F.array_intersect(a, words), F.array_intersect(b, words)
        clash = clash | ((F.size(x) > 0) & (F.size(y) > 0) & ~F.arrays_overlap(x, y))
    return clash


def q_antonym_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Near titles with the guard's verdict."""
    pairs = q_bucket_pairs(spark, folder)
    rows = _first_rows(spark, folder).select("id", X.plain_words("title").alias("w"))
    both = pairs.join(rows.select(F.col("id").alias("a"), F.col("w").alias("wa")), "a").join(rows.select(F.col("id").alias("b"), F.col("w").alias("wb")), "b")
    return both.select("a", "b", antonyms(F.col("wa"), F.col("wb")).alias("clash"))


def q_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of one title signature: each to the canonical one, of most sources, then the shortest title, then the first."""
    rows = table(spark, folder, "skills").where("id is not null and title is not null").groupBy("id").agg(F.countDistinct("source").alias("sources"), F.min(F.struct("rec_id", "title")).getField("title").alias("title"))
    rows = rows.withColumn("signature", X.token_signature("title")).where("signature <> ''")
    best = rows.groupBy("signature").agg(F.min(F.struct(-F.col("sources"), F.length("title"), "id")).getField("id").alias("canonical_id"))
    return rows.join(best, "signature").where("id <> canonical_id").select(F.col("id").alias("dropped_id"), "canonical_id")


# Topics that stay however common they are, and topics that never stay.
COMMON_TOPICS = [
    "mathematics", "science", "biology", "chemistry", "physics", "engineering", "technology", "economics", "history", "literature", "philosophy", "medicine", "law", "education", "problem-solving", "critical-thinking", "communication", "management", "leadership",
    "computer-science", "software-engineering", "data-analysis", "statistics", "research", "information-skills", "management-skills", "nondestructive-testing", "mathematical-optimization", "handling-and-moving", "personnel-management", "working-with-machinery-and-specialised-equipment",
]
BLOCKED_TOPICS = [
    "photomechanical-processes", "flying-machines", "rome-officials-and-employees", "traffic-regulations", "units-of-measurement", "professional-employees", "employees", "persons", "specialists", "scientists", "workers", "people", "occupations", "officials", "personnel", "staff", "professionals",
    "practitioners", "technicians", "operators", "judaism-customs-and-practices", "descriptive-cataloging", "ibm-computers", "wikiproject-countries-projects", "wikiproject-africa-projects", "computer-input-output-equipment", "history-of-technology", "personality-tests",
    "diagnostic-equipment-industry", "industrial-equipment-industry", "portable-computers", "telecommunication-equipment-industry", "law-interpretation-and-construction",
]


def topic_policy(counts: DataFrame, rows: int, common: list[str], blocked: list[str], least: int = 4, most: int = 1200, share: float = 0.013) -> DataFrame:
    """The topics of ``counts`` (``topic, n``) that stay: held by ``least`` rows, by no more than ``most`` or the share of all rows unless ``common``, and not ``blocked``."""
    cap = max(most, int(rows * share))
    return counts.where((F.col("n") >= least) & ((F.col("n") <= cap) | F.col("topic").isin(common)) & ~F.col("topic").isin(blocked))


def q_topic_policy(spark: SparkSession, folder: str) -> DataFrame:
    """Topics that stay; here three topics of these tables are common ones and one is blocked, too."""
    skills = table(spark, folder, "skills")
    topics = skills.select("rec_id", F.explode(F.split("topics", ",")).alias("t")).select("rec_id", F.lower(F.trim("t")).alias("topic")).where("topic <> ''").distinct().groupBy("topic").agg(F.count("*").alias("n"))
    return topic_policy(topics, skills.count(), [*COMMON_TOPICS, "computing-basics", "living-things", "number-sense"], [*BLOCKED_TOPICS, "verbal-narratives"])


# Fixed value: ids that say nothing.
CRUFT_IDS = "^review-records|^prepare-inserts|^seal-containers"


def q_cruft(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that nothing points to or from and that say too little; rows that stand for aliases stay."""
    e = graphs.edges(spark, folder)
    used = e.select(F.col("dep").alias("id")).union(e.select(F.col("pre").alias("id"))).distinct()
    rows = table(spark, folder, "skills").where("id is not null").join(used, "id", "left_anti")
    said = F.trim(F.coalesce("description", F.lit("")))
    topics = F.size(F.filter(F.split(F.coalesce("topics", F.lit("")), ","), lambda t: t != ""))
    cruft = ((said == "") & (topics < 2)) | ((F.size(F.split("id", "-")) >= 5) & (F.length(said) < 60)) | F.col("id").rlike(CRUFT_IDS)
    canonical = q_aliases(spark, folder).select(F.col("canonical_id").alias("id")).distinct()
    return rows.where(cruft).join(canonical, "id", "left_anti").select("rec_id", "id")


def q_grade_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Seed pairs inside a framework: grades 1 to 3 apart, three shared words, Jaccard below 0.8, at most 5 per pair of grades."""
    words = X.signature_words("fullstatement")
    grade = F.array_min(F.filter(F.transform("educationlevel", X.grade_difficulty), lambda g: g.isNotNull()))
    rows = table(spark, folder, "cf_items").where("docidentifier is not null and fullstatement is not null").select("docidentifier", "item_no", grade.alias("g"), words.alias("w")).where("g is not null and size(w) >= 3")
    rows = R.first_per_key(rows.withColumn("key", F.array_join(F.array_sort("w"), " ")), ["docidentifier", "g", "key"], ["item_no"]).drop("key")
    pairs = S.common_word_pairs(rows, "docidentifier", "g", "item_no", "w", gap=3, least=3, below=0.8, k=5)
    return pairs.select(F.col("part").alias("docidentifier"), "src", "dst", "shared", "rank")


def q_regex_wiring(spark: SparkSession, folder: str) -> DataFrame:
    """Foundations to every id that matches their pattern (their words, as whole words)."""
    hubs = table(spark, folder, "foundations").select(F.col("id").alias("pre"), F.concat(F.lit("(^|-)("), F.regexp_replace("id", "-", "|"), F.lit(")(-|$)")).alias("pattern"))
    ids = table(spark, folder, "skills").select(F.col("id").alias("dep")).where("dep is not null").distinct()
    return ids.join(F.broadcast(hubs), F.regexp_like("dep", F.col("pattern")) & (F.col("dep") != F.col("pre"))).select("dep", "pre")


QUERIES = {
    f.__name__: f
    for f in (
        q_cosine_top, q_semantic_match, q_duplicate_vectors, q_neighbour_regression, q_topic_smoothing, q_bands, q_anchors, q_isotonic, q_kendall_tau, q_inversion_audit, q_bucket_pairs, q_rare_word_pairs, q_antonym_guard, q_aliases, q_topic_policy, q_cruft, q_grade_pairs, q_regex_wiring,
    )
}

_V = """u AS (SELECT vec_id, id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM skill_vectors
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"""
_COS = "list_cosine_similarity(a.e, b.e)"
_TR = """t AS (SELECT DISTINCT rec_id, v, topic FROM (SELECT rec_id, CAST(difficulty AS DOUBLE) AS v, lower(trim(unnest(string_split(topics, ',')))) AS topic FROM skills WHERE difficulty IS NOT NULL) WHERE topic <> ''),
s AS (SELECT topic, sum(v) AS sm, count(*) AS n FROM t GROUP BY topic),
m AS (SELECT rec_id, avg(CASE WHEN n >= 3 THEN (sm - v) / (n - 1) END) AS mean FROM t JOIN s USING (topic) GROUP BY rec_id),
z AS (SELECT k.rec_id, CASE WHEN mean IS NULL THEN difficulty ELSE 0.7 * difficulty + 0.3 * mean END AS smoothed FROM skills k LEFT JOIN m ON m.rec_id = k.rec_id WHERE difficulty IS NOT NULL)"""
_FIRST = "f AS (SELECT id, title, topics, rec_id FROM skills WHERE id IS NOT NULL AND title IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY rec_id) = 1)"
_SIGW = f"list_distinct(list_filter({_split('title')}, lambda w: length(w) >= 3 AND w NOT IN {listed(X.SIGNATURE_STOP)}))"
_JAC = "CAST(len(list_intersect({0}, {1})) AS DOUBLE) / (len({0}) + len({1}) - len(list_intersect({0}, {1})))"
_BUCKET = f"""{_FIRST}, r AS (SELECT id, title, nullif(lower(trim(string_split(topics, ',')[1])), '') AS topic, {_word_set('title')} AS w, {_SIGW} AS s FROM f),
bp AS (SELECT DISTINCT a.id AS a, b.id AS b, {_JAC.format('a.w', 'b.w')} AS jaccard FROM r a JOIN r b ON a.topic = b.topic AND a.id < b.id
  WHERE len(a.w) > 0 AND len(b.w) > 0 AND {_JAC.format('a.w', 'b.w')} >= 0.7 AND greatest(length(a.title), length(b.title)) <= 3.0 * greatest(1, least(length(a.title), length(b.title)))
  AND (len(a.s) = 0 OR len(b.s) = 0 OR len(list_intersect(a.s, b.s)) >= 0.4 * least(len(a.s), len(b.s))))"""
_CLASH = " OR ".join(
    f"(len(list_intersect({{0}}, [{', '.join(repr(w) for w in g)}])) > 0 AND len(list_intersect({{1}}, [{', '.join(repr(w) for w in g)}])) > 0 AND len(list_intersect(list_intersect({{0}}, {{1}}), [{', '.join(repr(w) for w in g)}])) = 0)" for g in ANTONYMS
)
_G = "CASE WHEN g IN ('KG', 'K') THEN 1 WHEN regexp_matches(g, '^0?[0-9]{1,2}$') AND CAST(g AS INTEGER) BETWEEN 1 AND 12 THEN CAST(g AS INTEGER) + 1 END"

_ALIASES = f"""
WITH g AS (SELECT id, count(DISTINCT source) AS sources, arg_min(title, rec_id) AS title FROM skills WHERE id IS NOT NULL AND title IS NOT NULL GROUP BY id),
s AS (SELECT *, array_to_string(list_sort(list_filter({_split('title')}, lambda w: length(w) >= 2 AND w NOT IN {listed(X.SIGNATURE_STOP)} AND (length(w) >= 3 OR regexp_matches(w, '[0-9]')))), ' ') AS k FROM g),
c AS (SELECT *, first_value(id) OVER (PARTITION BY k ORDER BY sources DESC, length(title), id) AS canonical_id FROM s WHERE k <> '')
SELECT id AS dropped_id, canonical_id FROM c WHERE id <> canonical_id"""
_TAU = """cell AS (SELECT difficulty AS a, grade_start AS b, count(*) AS c FROM skills WHERE grade_start BETWEEN -1 AND 12 AND difficulty IS NOT NULL GROUP BY 1, 2),
way AS (SELECT coalesce(sum(CASE WHEN q.b > p.b THEN p.c * q.c END), 0) AS con, coalesce(sum(CASE WHEN q.b < p.b THEN p.c * q.c END), 0) AS dis FROM cell p JOIN cell q ON p.a < q.a), whole AS (SELECT sum(c) AS n FROM cell),
tau AS (SELECT CAST(n AS BIGINT) AS n, CAST(con AS BIGINT) AS concordant, CAST(dis AS BIGINT) AS discordant, round(CAST(con - dis AS DOUBLE) / (n * (n - 1) / 2.0), 6) AS tau FROM way, whole)"""

ORACLE = {
    "q_cosine_top": f"WITH {_V} SELECT a.vec_id AS id, b.vec_id AS other, round({_COS}, 5) AS cosine, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY {_COS} DESC, b.vec_id) AS INTEGER) AS rank FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 QUALIFY rank <= 5",
    "q_semantic_match": f"""
WITH {_V}, n AS (SELECT a.vec_id AS id, b.vec_id AS other, {_COS} AS c, a.id AS ia, b.id AS ib FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY {_COS} DESC, b.vec_id) = 1)
SELECT id, other, CASE WHEN len(list_intersect(string_split(ia, '-'), string_split(ib, '-'))) > 0 THEN 'kept' ELSE 'no-token-overlap' END AS verdict FROM n WHERE c > 0.9""",
    "q_duplicate_vectors": "SELECT count(*) AS n, min(vec_id) AS first_id FROM (SELECT vec_id, list_transform(embedding[1:16], lambda x: CASE WHEN isnan(x) THEN 'nan' ELSE CAST(round(CAST(x AS DOUBLE), 3) + 0.0 AS VARCHAR) END) AS s FROM skill_vectors WHERE embedding IS NOT NULL) GROUP BY s HAVING count(*) > 1",
    "q_neighbour_regression": f"""
WITH {_V}, d AS (SELECT id, min(difficulty) AS d FROM skills WHERE difficulty IS NOT NULL AND id IS NOT NULL GROUP BY id),
t AS (SELECT id, list(DISTINCT t) AS t FROM (SELECT id, lower(trim(unnest(string_split(topics, ',')))) AS t FROM skills WHERE id IS NOT NULL) WHERE t <> '' GROUP BY id),
z AS (SELECT u.vec_id, u.e, coalesce(t.t, []) AS t, d.d FROM u JOIN d ON d.id = u.id LEFT JOIN t ON t.id = u.id), a AS (SELECT u.vec_id, u.e, coalesce(t.t, []) AS t FROM u LEFT JOIN t ON t.id = u.id WHERE u.vec_id % 50 = 0),
p AS (SELECT a.vec_id AS id, b.vec_id AS other, list_has_any(a.t, b.t) AS near, {_COS} AS c, b.d FROM a JOIN z b ON true), h AS (SELECT id, max(near) AS any_near FROM p GROUP BY id),
n AS (SELECT p.id, greatest(0, c) AS c, d FROM p JOIN h USING (id) WHERE near OR NOT any_near QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY p.c DESC, other) <= 15)
SELECT n.id, round(CASE WHEN sum(c ** 8) > 0 THEN sum(c ** 8 * d) / sum(c ** 8) ELSE coalesce(max(z.zd), 10) END, 4) AS estimate FROM n LEFT JOIN (SELECT vec_id, d AS zd FROM z) z ON z.vec_id = n.id GROUP BY n.id""",
    "q_topic_smoothing": f"WITH {_TR} SELECT rec_id, round(smoothed + 1e-9, 5) AS smoothed FROM z",
    "q_bands": f"WITH {_TR} SELECT CAST(least(20, greatest(1, floor(round(smoothed, 6) + 0.5) + 1)) AS INTEGER) AS band, count(*) AS n_rows FROM z GROUP BY 1",
    "q_anchors": "SELECT id, CASE WHEN max(g) - min(g) < 12 THEN min(g) END AS anchor FROM (SELECT id, CASE WHEN grade_start BETWEEN -1 AND 12 THEN grade_start END AS g FROM skills WHERE id IS NOT NULL) GROUP BY id",
    "q_kendall_tau": f"WITH {_TAU} SELECT * FROM tau",
    "q_inversion_audit": "SELECT count(*) AS n_rows, count(*) FILTER (WHERE gap > 5) AS inverted, max(gap) AS widest, round(avg(CASE WHEN gap > 5 THEN 1.0 ELSE 0.0 END), 6) AS share FROM (SELECT abs(difficulty - grade_start - 2) AS gap FROM skills WHERE grade_start BETWEEN -1 AND 12 AND difficulty IS NOT NULL)",
    "q_bucket_pairs": f"WITH {_BUCKET} SELECT a, b, round(jaccard, 6) AS jaccard FROM bp",
    "q_rare_word_pairs": f"""
WITH {_FIRST}, r AS (SELECT id, {_SIGW} AS w FROM f), x AS (SELECT id, unnest(w) AS t FROM r), df AS (SELECT t, count(*) AS n FROM x GROUP BY t),
two AS (SELECT id, t FROM x JOIN df USING (t) QUALIFY row_number() OVER (PARTITION BY id ORDER BY n, t) <= 2),
p AS (SELECT DISTINCT a.id AS a, b.id AS b FROM two a JOIN two b ON a.t = b.t AND a.id < b.id)
SELECT a, b, round({_JAC.format('x.w', 'y.w')}, 6) AS jaccard FROM p JOIN r x ON x.id = a JOIN r y ON y.id = b WHERE {_JAC.format('x.w', 'y.w')} >= 0.5""",
    "q_antonym_guard": f"WITH {_BUCKET}, pw AS (SELECT id, {_split('title')} AS w FROM f) SELECT a, b, {_CLASH.format('x.w', 'y.w')} AS clash FROM bp JOIN pw x ON x.id = a JOIN pw y ON y.id = b",
    "q_aliases": _ALIASES,
    "q_topic_policy": f"SELECT topic, count(DISTINCT rec_id) AS n FROM ({_exploded('topics', 'topic')}) GROUP BY topic HAVING count(DISTINCT rec_id) >= 4 AND (count(DISTINCT rec_id) <= greatest(1200, floor((SELECT count(*) FROM skills) * 0.013)) OR topic IN {listed([*COMMON_TOPICS, 'computing-basics', 'living-things', 'number-sense'])}) AND topic NOT IN {listed([*BLOCKED_TOPICS, 'verbal-narratives'])}",
    "q_cruft": f"""
WITH {graphs._RAW}, used AS (SELECT dep AS id FROM e UNION SELECT pre FROM e), al AS ({_ALIASES})
SELECT rec_id, id FROM (SELECT *, trim(coalesce(description, '')) AS said, len(list_filter(string_split(coalesce(topics, ''), ','), lambda t: t <> '')) AS n FROM skills WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM used))
WHERE ((said = '' AND n < 2) OR (len(string_split(id, '-')) >= 5 AND length(said) < 60) OR regexp_matches(id, '{CRUFT_IDS}')) AND id NOT IN (SELECT canonical_id FROM al)""",
    "q_grade_pairs": f"""
WITH g AS (SELECT item_no, min({_G}) AS g FROM (SELECT item_no, upper(trim(unnest(educationlevel))) AS g FROM cf_items) GROUP BY item_no),
r0 AS (SELECT docidentifier, item_no, g, {_SIGW.replace("lower(title)", "lower(fullstatement)")} AS w FROM cf_items JOIN g USING (item_no) WHERE docidentifier IS NOT NULL AND fullstatement IS NOT NULL AND g IS NOT NULL),
r AS (SELECT * FROM r0 WHERE len(w) >= 3 QUALIFY row_number() OVER (PARTITION BY docidentifier, g, array_to_string(list_sort(w), ' ') ORDER BY item_no) = 1),
x AS (SELECT docidentifier, item_no, g, unnest(w) AS t FROM r),
p AS (SELECT a.docidentifier, a.item_no AS src, b.item_no AS dst FROM x a JOIN x b ON a.docidentifier = b.docidentifier AND a.t = b.t AND b.g > a.g AND b.g <= a.g + 3 GROUP BY 1, 2, 3 HAVING count(*) >= 3),
q AS (SELECT p.docidentifier, src, dst, a.g AS ga, b.g AS gb, len(list_intersect(a.w, b.w)) AS shared, {_JAC.format('a.w', 'b.w')} AS j FROM p JOIN r a ON a.item_no = src JOIN r b ON b.item_no = dst)
SELECT docidentifier, src, dst, CAST(shared AS INTEGER) AS shared, CAST(row_number() OVER (PARTITION BY docidentifier, ga, gb ORDER BY shared DESC, src, dst) AS INTEGER) AS rank FROM q WHERE shared >= 3 AND j < 0.8 QUALIFY rank <= 5""",
    "q_regex_wiring": "SELECT dep, pre FROM (SELECT DISTINCT id AS dep FROM skills WHERE id IS NOT NULL) JOIN (SELECT id AS pre, '(^|-)(' || replace(id, '-', '|') || ')(-|$)' AS pattern FROM foundations) ON regexp_matches(dep, pattern) AND dep <> pre",
}
