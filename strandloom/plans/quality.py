"""The quality report over the tables of skills, their prerequisites, vectors and statements."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import text as X
from strandloom.operators import calibrate as C
from strandloom.operators import folds as O
from strandloom.operators import graph as G
from strandloom.operators import quality as Q
from strandloom.operators import similarity as S
from strandloom.plans import graphs, measures, texts
from strandloom.plans.tables import table
from strandloom.runtime import Scratch


def _final(spark: SparkSession, folder: str) -> DataFrame:
    """``id, band, topics, occupations`` of skills and foundations."""
    part = lambda c: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    first = table(spark, folder, "skills").where("id is not null").groupBy("id").agg(F.min(F.struct("rec_id", part("topics").alias("t"), part("occupations").alias("o"))).alias("f"))
    none = F.array().cast("array<string>")
    return graphs.bands(spark, folder).join(first, "id", "left").select("id", "band", F.coalesce("f.t", none).alias("topics"), F.coalesce("f.o", none).alias("occupations"))


def _seeds(spark: SparkSession, folder: str, e: DataFrame) -> DataFrame:
    return e.join(F.broadcast(table(spark, folder, "foundations").select(F.col("id").alias("pre"))), "pre", "left_semi").select("dep", "pre")


def q_scorecard(spark: SparkSession, folder: str) -> DataFrame:
    """The conditions that SQL can express, with their scores; 1 and more passes."""
    scratch = Scratch(spark, "scorecard")
    skills, e = scratch.save(_final(spark, folder), "skills"), scratch.save(graphs.edges(spark, folder), "edges")
    known, seeds = G.closure(e, scratch), scratch.save(_seeds(spark, folder, e), "seeds")
    rows, items = table(spark, folder, "skills"), table(spark, folder, "cf_items")
    lists = rows.where("id is not null").groupBy(F.col("id").alias("skill")).agg(F.array_distinct(F.flatten(F.collect_list(F.filter(F.transform(F.split(F.coalesce("prereqs", F.lit("")), ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")))).alias("picks"))
    difficulty = skills.select("id", F.col("band").alias("raw"), "band")
    audit = rows.where("difficulty is not null").select(F.col("rec_id").alias("id"), F.col("difficulty").alias("estimate"), F.when(F.col("grade_start").between(-1, 12), F.col("grade_start") + 2).alias("anchor"))
    framework = items.groupBy("docidentifier").agg(F.max(F.coalesce(F.size("educationlevel") > 0, F.lit(False))).alias("graded"))
    tagged = items.join(framework, "docidentifier", "left")
    tags = F.concat_ws(",", F.when(F.coalesce(F.size("educationlevel") > 0, F.lit(False)), F.concat(F.lit("grade:"), F.element_at("educationlevel", 1))), F.when(~F.coalesce("graded", F.lit(False)), "opensalt:ungraded-framework"))
    expected = table(spark, folder, "foundations").select("id", F.when(F.col("grade_start") == 0, "K").otherwise(F.col("grade_start").cast("string")).alias("grade_from"), F.when(F.col("grade_end") == 0, "K").otherwise(F.col("grade_end").cast("string")).alias("grade_to"))
    junk = lambda t: t.rlike(texts.FRAMEWORK) | t.rlike(texts.WIKI) | t.rlike(texts.YEAR)
    conditions = [
        Q.acyclic(skills, e, known),
        Q.shared_vectors(table(spark, folder, "skill_vectors").where(S.usable("embedding", measures.DIM)), "embedding"),
        Q.current_picks(lists, difficulty),
        Q.inverted_seeds(seeds, skills),
        Q.surviving_seeds(seeds, known, skills),
        Q.ordered_bands(e, skills, known),
        Q.isolated(skills, e),
        Q.roots(skills, e),
        Q.tau(C.kendall_tau(rows.where("grade_start between -1 and 12"), "difficulty", "grade_start")),
        Q.far_from_anchor(C.inversions(audit)[0]),
        Q.circular_seeds(seeds),
        Q.empty_titles(rows.where("title is not null"), X.fuzzy_key("title"), X.slugify("title")),
        Q.graded_rows(tagged.select(F.lit("opensalt").alias("sources"), tags.alias("tags"))),
        Q.anomalous_hubs(skills, e),
        Q.crossed_languages(e),
        Q.junk(skills, junk),
        Q.sane(expected, skills),
        Q.areas_inside(skills, e),
        Q.implied(known),
        Q.spot_checks(Q.known_spots(skills, e)),
        Q.clean_list(texts.list_defects(texts.defect_rows(spark, folder)), texts.defect_rows(spark, folder)),
        Q.expert("expert", scratch.save(G.expert_scores(e, graphs.expert_pairs(spark, folder), known), "expert")),
    ]
    out = conditions[0]
    for c in conditions[1:]:
        out = out.union(c)
    return out.select("condition", F.round("score", 5).alias("score"))


def q_scorecard_folds(spark: SparkSession, folder: str) -> DataFrame:
    """No SQL: the conditions that rest on greedy folds, on two expert sources, or on the clock."""
    began = time.time()
    e, bands = graphs.edges(spark, folder), graphs.bands(spark, folder)
    seeds = _seeds(spark, folder, e)
    _, kept = G.chain_lift(bands, e, seeds)
    judged = O.feasible_seeds(bands, seeds.withColumn("late", F.lit(0)).withColumn("ord", F.xxhash64("dep", "pre")))
    side = lambda end, p: bands.select(F.col("id").alias(end), F.col("band").alias(f"b{p}"), F.col("anchored").alias(f"a{p}"))
    judged = judged.join(side("dep", "d"), "dep").join(side("pre", "p"), "pre").select("kept", (~F.col("kept") & F.col("ad") & F.col("ap") & (F.col("bd") == F.col("bp"))).alias("tie"))
    crowd = table(spark, folder, "skill_matches").where("score is not null and id_a is not null and id_b is not null").select(F.lower(F.trim("id_b")).alias("pre"), F.lower(F.trim("id_a")).alias("dep"), (F.col("score") > 0.75).alias("positive"))
    listed = graphs.raw_edges(spark, folder).select("pre", "dep", F.lit(True).alias("positive"))
    out = Q.lost_in_lift(e, kept).union(Q.conflicting_seeds(judged)).union(Q.expert("crowd", G.expert_scores(e, crowd.union(listed))))
    return out.union(Q.in_time(spark, began)).select("condition", F.round("score", 5).alias("score"))


QUERIES = {f.__name__: f for f in (q_scorecard, q_scorecard_folds)}


def _rule(name: str, value: str, good: float, bad: float | str) -> str:
    return f"SELECT '{name}' AS condition, round(greatest(0, (CAST(({value}) AS DOUBLE) - {bad}) / ({good} - {bad})), 5) AS score"


def _share(condition: str, rows: str) -> str:
    return f"SELECT avg(CASE WHEN {condition} THEN 1.0 ELSE 0 END) FROM {rows}"


_N = "(SELECT count(*) FROM fin)"
_JUNK = " OR ".join(f"regexp_matches(t, {texts.quoted(p)})" for p in (texts.FRAMEWORK, texts.WIKI, texts.YEAR))
_PART = "list_filter(list_transform(string_split(coalesce({0}, ''), ','), lambda x: lower(trim(x))), lambda x: x <> '')"
_GRADE = "CASE WHEN {0} = 0 THEN 2 ELSE {0} + 2 END"
_RULES = [
    ("prerequisites form no cycle and name other skills", _share("EXISTS (SELECT 1 FROM up WHERE up.dep = e.dep AND up.anc = e.dep)", "e"), 0, 1),
    ("at most 5 skills share a vector", "SELECT max(n) FROM (SELECT count(*) AS n FROM u GROUP BY list_transform(e[1:3], lambda x: round(x, 4)))", 5, "greatest(6, (SELECT count(*) FROM u))"),
    ("picks are current and easier", "SELECT avg(CASE WHEN bad THEN 1.0 ELSE 0 END) FROM (SELECT k.id, bool_or(coalesce(p.pre IS NOT NULL AND NOT coalesce(y.band < x.band, false), false)) AS bad FROM (SELECT DISTINCT id FROM skills WHERE id IS NOT NULL) k JOIN b x ON x.id = k.id LEFT JOIN (SELECT DISTINCT id AS dep, pre FROM (SELECT id, lower(trim(unnest(string_split(prereqs, ',')))) AS pre FROM skills) WHERE pre <> '') p ON p.dep = k.id LEFT JOIN b y ON y.id = p.pre GROUP BY k.id)", 0, 1),
    ("under 10% of seeds put the prerequisite higher", "SELECT avg(CASE WHEN y.band > x.band THEN 1.0 ELSE 0 END) FROM se JOIN b x ON x.id = dep JOIN b y ON y.id = pre", 0.1, 1),
    ("at least 80% of seeds survive", "SELECT avg(CASE WHEN EXISTS (SELECT 1 FROM up WHERE up.dep = q.dep AND up.anc = q.pre) THEN 1.0 ELSE 0 END) FROM (SELECT * FROM se WHERE NOT EXISTS (SELECT 1 FROM area WHERE area.dep = se.dep AND area.pre = se.pre)) q", 0.8, 0),
    ("at least 95% of skills are at or above all their prerequisites", "SELECT avg(CASE WHEN highest <= band THEN 1.0 ELSE 0 END) FROM (SELECT dep, max(b.band) AS highest FROM up JOIN b ON b.id = anc GROUP BY dep) h JOIN b ON b.id = dep", 0.95, 0),
    ("under 20% of skills are isolated", _share("id NOT IN (SELECT dep FROM e) AND id NOT IN (SELECT pre FROM e)", "fin"), 0.2, 1),
    ("under 20% of skills are roots", _share("id NOT IN (SELECT dep FROM e) AND id IN (SELECT pre FROM e)", "fin"), 0.2, 1),
    ("difficulty agrees with grades", "SELECT CAST(con - dis AS DOUBLE) / (n * (n - 1) / 2.0) FROM way, whole", 0.5, 0),
    ("under 5% of anchored skills miss their band by more than 5", "SELECT avg(CASE WHEN abs(difficulty - grade_start - 2) > 5 THEN 1.0 ELSE 0 END) FROM skills WHERE grade_start BETWEEN -1 AND 12 AND difficulty IS NOT NULL", 0.05, 1),
    ("under 1% of seeds are in a cycle", _share("EXISTS (SELECT 1 FROM up WHERE up.dep = se.pre AND up.anc = se.dep)", "se"), 0.01, 1),
    ("under 0.1% of titles drop for an empty key or slug", "SELECT avg(CASE WHEN " + texts._fuzzy("title") + " = '' OR " + texts._slug_base("title") + " = '' THEN 1.0 ELSE 0 END) FROM skills WHERE title IS NOT NULL", 0.001, 0.01),
    ("at least 95% of framework skills carry a grade", "SELECT avg(CASE WHEN coalesce(len(educationlevel) > 0, false) THEN 1.0 ELSE 0 END) FROM cf_items WHERE docidentifier IN (SELECT docidentifier FROM cf_items WHERE len(educationlevel) > 0) OR len(educationlevel) > 0", 0.95, 0),
    ("no anomalous hub has over 200 dependents", f"SELECT coalesce(max(n), 0) FROM (SELECT count(*) AS n FROM e WHERE regexp_matches(pre, {texts.quoted(Q.ANOMALOUS)}) GROUP BY pre)", 200, f"greatest(201, {_N})"),
    ("no language needs another", _share(f"{graphs._LANG.format('dep')} <> {graphs._LANG.format('pre')}", "e"), 0, 1),
    ("no hashed id, junk topic or hashed occupation", _share(f"(length(id) >= 70 AND regexp_matches(id, '-[a-f0-9]{{6}}$')) OR len(list_filter(topics, lambda t: {_JUNK})) > 0 OR len(list_filter(occupations, lambda o: regexp_matches(o, '-[a-f0-9]{{6}}$'))) > 0", "fin"), 0, 1),
    ("at least 80% of the sanity skills are in their band", f"SELECT avg(CASE WHEN b.band BETWEEN {_GRADE.format('grade_start')} AND {_GRADE.format('grade_end')} THEN 1.0 ELSE 0 END) FROM foundations f JOIN b ON b.id = f.id", 0.8, 0),
    ("no subject area is inside itself", f"SELECT count(DISTINCT area.dep) / CAST({_N} AS DOUBLE) FROM area JOIN e ON e.dep = area.dep AND e.pre = area.pre", 0, 1),
    ("addition comes before multiplication", "SELECT least(1, count(*)) FROM up WHERE dep = 'multiplication' AND anc = 'addition'", 1, 0),
    (
        "spot checks pass",
        "SELECT (CASE WHEN EXISTS (SELECT 1 FROM fin WHERE id = 'javascript' AND (len(list_filter(occupations, lambda o: contains(o, 'software-developer'))) > 0 OR len(list_filter(topics, lambda o: contains(o, 'programming'))) > 0)) THEN 0 ELSE 1 END"
        " + CASE WHEN EXISTS (SELECT 1 FROM fin WHERE id = 'biology' AND (len(list_filter(occupations, lambda o: contains(o, 'biologist'))) > 0 OR len(list_filter(topics, lambda o: contains(o, 'biology'))) > 0)) THEN 0 ELSE 1 END"
        " + CASE WHEN EXISTS (SELECT 1 FROM b x, b y WHERE x.id = 'addition' AND y.id = 'calculus' AND x.band <= y.band) THEN 0 ELSE 1 END"
        " + (SELECT count(*) FROM e WHERE (dep, pre) IN (('describe-consequences-of-following-rules', 'antisocial-personality-disorder'), ('distinguish-lumber-categories', 'pack-fragile-items-for-transportation'), ('weigh-products-or-estimate-weight', 'use-measures-of-dispersion')))) / 6.0",
        0,
        1,
    ),
    ("no list title has a defect", f"SELECT (prefix + emphasis + short_codes + encoding) / CAST((SELECT count(*) FROM skills) + (SELECT count(*) FROM cf_items) AS DOUBLE) FROM ({texts.ORACLE['q_list_defects']})", 0, 1),
    ("enough expert pairs resolve", "SELECT positives FROM ex", 3, 0),
    ("expert edges are precise", "SELECT hits / CAST(predicted AS DOUBLE) FROM ex", 0.25, 0),
    ("expert pairs are recovered", "SELECT recovered / CAST(positives AS DOUBLE) FROM ex", 0.05, 0),
]

ORACLE = {
    "q_scorecard": f"""
WITH RECURSIVE {graphs._RAW}, {graphs._UP}, {graphs._BANDS}, {measures._V}, {measures._TAU},
fin AS (SELECT b.id, band, coalesce(t, []) AS topics, coalesce(o, []) AS occupations FROM b LEFT JOIN (SELECT id, arg_min({_PART.format('topics')}, rec_id) AS t, arg_min({_PART.format('occupations')}, rec_id) AS o FROM skills WHERE id IS NOT NULL GROUP BY id) s ON s.id = b.id),
se AS (SELECT dep, pre FROM e WHERE pre IN (SELECT id FROM foundations)),
tt AS (SELECT DISTINCT id AS dep, unnest(topics) AS pre FROM fin), area AS (SELECT * FROM tt WHERE pre IN (SELECT pre FROM tt GROUP BY 1 HAVING count(*) >= 50)),
ex AS ({graphs.ORACLE['q_expert_scores']})
"""
    + " UNION ALL ".join(_rule(*r) for r in _RULES),
}
