"""Queries over the prerequisite graph of skills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators import edges as E
from strandloom.operators import graph as G
from strandloom.operators import relational as R
from strandloom.plans.tables import table
from strandloom.plans.training import uri


def known_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "skills").select("id").union(table(spark, folder, "foundations").select("id")).where("id is not null").distinct()


def raw_edges(spark: SparkSession, folder: str) -> DataFrame:
    lists = table(spark, folder, "skills").select(F.col("id").alias("dep"), F.explode(F.split("prereqs", ",")).alias("p"))
    return G.clean_edges(lists.select("dep", F.lower(F.trim("p")).alias("pre")).where("pre <> ''"))


def edges(spark: SparkSession, folder: str) -> DataFrame:
    """Prerequisites that exist, each edge once."""
    return raw_edges(spark, folder).join(known_ids(spark, folder).withColumnRenamed("id", "pre"), "pre", "left_semi").select("dep", "pre")


def bands(spark: SparkSession, folder: str) -> DataFrame:
    """``id, band, anchored``: the lowest difficulty of each id; anchored by a grade."""
    skills = table(spark, folder, "skills").where("id is not null").groupBy("id").agg(F.least(F.lit(20), F.greatest(F.lit(1), F.min("difficulty"))).alias("band"), F.max(F.coalesce(F.col("grade_start").between(-1, 12), F.lit(False))).alias("anchored"))
    hubs = table(spark, folder, "foundations").select("id", F.lit(1).alias("band"), F.lit(True).alias("anchored"))
    return skills.union(hubs.join(skills, "id", "left_anti")).withColumn("band", F.coalesce("band", F.lit(1)))


def q_unresolved(spark: SparkSession, folder: str) -> DataFrame:
    """Quarantine: prerequisites that are no known id, with the number of rows that name them."""
    lost = raw_edges(spark, folder).join(known_ids(spark, folder).withColumnRenamed("id", "pre"), "pre", "left_anti")
    return lost.groupBy("pre").agg(F.count("*").alias("n_edges"), F.lit("unknown").alias("reason"))


def q_closure(spark: SparkSession, folder: str) -> DataFrame:
    return G.closure(edges(spark, folder))


def q_topo_levels(spark: SparkSession, folder: str) -> DataFrame:
    return G.topo_levels(edges(spark, folder))


def q_transitive_reduction(spark: SparkSession, folder: str) -> DataFrame:
    return G.transitive_reduction(edges(spark, folder))


def q_components(spark: SparkSession, folder: str) -> DataFrame:
    """Strongly connected components of matches, read from the first to the second end."""
    pairs = table(spark, folder, "skill_matches").where("lower(trim(verdict)) = 'same'").select(F.lower(F.trim("id_a")).alias("dep"), F.lower(F.trim("id_b")).alias("pre"))
    return G.components(pairs)


def q_alias_collapse(spark: SparkSession, folder: str) -> DataFrame:
    """Concepts to the top of their chain; links inside a loop are cut, so a way into a loop ends where it meets it."""
    rows = table(spark, folder, "researchskillscollection_en").select(uri("concepturi").alias("dep"), uri("broaderconcepturi").alias("pre")).where("dep is not null and pre is not null").groupBy("dep").agg(F.min("pre").alias("pre"))
    open_ = G.drop_inside_components(rows.where("dep <> pre"), "true")
    return G.collapse_aliases(open_.select(F.col("dep").alias("dropped_id"), F.col("pre").alias("canonical_id")), 1_000_000)


def q_bounded_ancestors(spark: SparkSession, folder: str) -> DataFrame:
    return G.bounded_ancestors(edges(spark, folder), 3)


def q_inherit_attribute(spark: SparkSession, folder: str) -> DataFrame:
    """A concept's reuse level, or the nearest one above it; loops and ways without one give none."""
    rows = table(spark, folder, "researchskillscollection_en").select(uri("concepturi").alias("id"), uri("broaderconcepturi").alias("parent"), "reuselevel", "status")
    known = rows.where("reuselevel is not null and lower(status) <> 'released'").select("id", F.col("reuselevel").alias("value"))
    return G.inherited(rows.select("id", "parent"), known)


def expert_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Annotations: matches, positive if the verdict is "same", and every listed prerequisite, positive if one of the two most trusted sources lists it."""
    pairs = table(spark, folder, "skill_matches").select(F.lower(F.trim("id_a")).alias("pre"), F.lower(F.trim("id_b")).alias("dep"), (F.lower(F.trim("verdict")) == "same").alias("positive")).where("pre is not null and dep is not null and positive is not null")
    trusted = table(spark, folder, "skill_sources").where("trust_rank <= 2").select("source", F.lit(True).alias("good"))
    lists = table(spark, folder, "skills").join(F.broadcast(trusted), "source", "left").select(F.col("id").alias("dep"), F.explode(F.split("prereqs", ",")).alias("p"), F.coalesce("good", F.lit(False)).alias("positive")).select(F.lower(F.trim("p")).alias("pre"), "dep", "positive").where("pre <> '' and dep is not null")
    return pairs.unionByName(lists)


def q_expert_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Edges scored against the annotations."""
    return G.expert_scores(edges(spark, folder), expert_pairs(spark, folder))


def q_hub_cap(spark: SparkSession, folder: str) -> DataFrame:
    """At most 150 dependents of a prerequisite, those nearest in band."""
    b = bands(spark, folder).select("id", "band")
    e = edges(spark, folder).join(b.select(F.col("id").alias("dep"), F.col("band").alias("bd")), "dep").join(b.select(F.col("id").alias("pre"), F.col("band").alias("bp")), "pre")
    return R.top_per_key(e.withColumn("gap", F.abs(F.col("bd") - F.col("bp"))), ["pre"], ["gap", "dep"], 150).select("dep", "pre", "gap", "rank")


def q_trim_edges(spark: SparkSession, folder: str) -> DataFrame:
    """A skill keeps its foundations last: of n edges, at most n - 1 droppable ones go, from the back."""
    from pyspark.sql import Window

    hubs = table(spark, folder, "foundations").select(F.col("id").alias("pre"), F.lit(True).alias("droppable"))
    e = edges(spark, folder).join(F.broadcast(hubs), "pre", "left").withColumn("droppable", F.coalesce("droppable", F.lit(False)))
    n = F.count("*").over(Window.partitionBy("dep"))
    rank = F.sum(F.col("droppable").cast("int")).over(Window.partitionBy("dep").orderBy(F.desc("pre")))
    return e.withColumn("n", n).withColumn("r", rank).where("not droppable or r > n - 1").select("dep", "pre")


def chain_skills(spark: SparkSession, folder: str) -> DataFrame:
    """What the edge rules need: ``id, raw, band, anchored, tags, topics, ord`` of skills and foundations.

    A skill that names occupations counts as taught at a level of 2 to 7, by its
    difficulty; one whose first topic is about technical systems counts as a tool.
    """
    part = lambda c: F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    rows = table(spark, folder, "skills").where("id is not null").groupBy("id").agg(F.min("difficulty").alias("d"), F.min(F.struct("rec_id", part("topics").alias("t"), part("occupations").alias("o"))).alias("first"), F.min("rec_id").alias("ord"))
    level = F.when(F.size("first.o") > 0, F.concat(F.lit("skillsengland:level:"), F.least(F.lit(7), 2 + F.floor(F.col("d") / 4)).cast("string")))
    tool = F.when(F.get(F.col("first.t"), F.lit(0)) == "technical-systems", "onet:tech")
    one = bands(spark, folder).join(rows, "id", "left")
    return one.select("id", F.col("band").cast("double").alias("raw"), "band", "anchored", F.concat_ws(",", level, tool).alias("tags"), F.coalesce("first.t", F.array().cast("array<string>")).alias("topics"), F.coalesce("ord", F.lit(0)).alias("ord"))


def chain_input(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges with ``named`` (volunteers list the prerequisite), skills, and the edges of foundations as seeds."""
    named = table(spark, folder, "skills").where("source = 'volunteers'").select(F.col("id").alias("dep"), F.explode(F.split("prereqs", ",")).alias("p")).select("dep", F.lower(F.trim("p")).alias("pre"), F.lit(True).alias("named")).distinct()
    e = edges(spark, folder).join(named, ["dep", "pre"], "left").withColumn("named", F.coalesce("named", F.lit(False)))
    seeds = edges(spark, folder).join(F.broadcast(table(spark, folder, "foundations").select(F.col("id").alias("pre"))), "pre", "left_semi").select("dep", "pre", F.lit("foundation").alias("source"))
    return e, chain_skills(spark, folder), seeds


def q_edge_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Every edge with the rule that drops it; edges to foundations are seeds and stay."""
    e, skills, seeds = chain_input(spark, folder)
    marked = e.join(seeds.select("dep", "pre", F.lit(True).alias("seed")), ["dep", "pre"], "left").withColumn("seed", F.coalesce("seed", F.lit(False)))
    return E.reasons(E.with_ends(marked, skills)).select("dep", "pre", "named", "reason")


def q_edge_steps(spark: SparkSession, folder: str) -> DataFrame:
    """No SQL: stateful. Edges that are left after each step of the whole chain."""
    e, skills, seeds = chain_input(spark, folder)
    return E.EdgeChain(e, skills, seeds).steps


def q_subject_areas(spark: SparkSession, folder: str) -> DataFrame:
    """Prerequisites that are the topic of 5 or more skills and a topic of their dependent; here a skill's topics count as its prerequisites too."""
    topics = table(spark, folder, "skills").select("id", F.explode(F.split("topics", ",")).alias("t")).select("id", F.lower(F.trim("t")).alias("topic")).where("id is not null and topic <> ''").distinct()
    skills = topics.groupBy("id").agg(F.collect_set("topic").alias("topics"))
    both = raw_edges(spark, folder).union(topics.select(F.col("id").alias("dep"), F.col("topic").alias("pre")))
    return E.subject_areas(both.distinct(), skills, 5)


def q_chain_lift(spark: SparkSession, folder: str) -> DataFrame:
    """No SQL: two passes with a cap. The band of every skill after the lift."""
    seeds = edges(spark, folder).join(F.broadcast(table(spark, folder, "foundations").select(F.col("id").alias("pre"))), "pre", "left_semi")
    lifted, _ = G.chain_lift(bands(spark, folder), edges(spark, folder), seeds)
    return lifted


def q_break_cycles(spark: SparkSession, folder: str) -> DataFrame:
    """No SQL: greedy. Matches read as edges, without cycles; those found by code are seeds, and the ids' bands break ties."""
    pairs = table(spark, folder, "skill_matches").where("lower(trim(verdict)) = 'same'").select(F.lower(F.trim("id_a")).alias("dep"), F.lower(F.trim("id_b")).alias("pre"), F.lower(F.trim("method")).alias("method"))
    seeds = pairs.where("method = 'code'").select("dep", "pre")
    return G.break_cycles(pairs.select("dep", "pre"), bands(spark, folder).select("id", F.col("band").cast("double").alias("raw")), seeds)


def q_band_inversions(spark: SparkSession, folder: str) -> DataFrame:
    """Share of skills whose band is below that of a direct or indirect prerequisite."""
    above = G.inverted_above(edges(spark, folder), bands(spark, folder).select("id", "band")).where("highest is not null")
    return above.agg(F.count("*").alias("skills"), F.count_if(F.col("highest") > F.col("band")).alias("inverted"))


def q_roots(spark: SparkSession, folder: str) -> DataFrame:
    """Skills without prerequisites, and those without any edge."""
    e = edges(spark, folder)
    ids = known_ids(spark, folder)
    marked = ids.join(e.select(F.col("dep").alias("id"), F.lit(1).alias("d")).distinct(), "id", "left").join(e.select(F.col("pre").alias("id"), F.lit(1).alias("p")).distinct(), "id", "left")
    return marked.agg(F.count("*").alias("nodes"), F.count_if(F.col("d").isNull()).alias("roots"), F.count_if(F.col("d").isNull() & F.col("p").isNull()).alias("isolated"))


QUERIES = {
    f.__name__: f
    for f in (
        q_unresolved, q_closure, q_topo_levels, q_transitive_reduction, q_components, q_alias_collapse, q_bounded_ancestors, q_inherit_attribute, q_expert_scores, q_hub_cap, q_trim_edges, q_edge_chain, q_edge_steps, q_subject_areas, q_chain_lift, q_break_cycles, q_band_inversions, q_roots,
    )
}

_RAW = """raw AS (SELECT DISTINCT id AS dep, pre FROM (SELECT id, lower(trim(unnest(string_split(prereqs, ',')))) AS pre FROM skills) WHERE pre <> '' AND id <> pre),
known AS (SELECT id FROM skills WHERE id IS NOT NULL UNION SELECT id FROM foundations WHERE id IS NOT NULL),
e AS (SELECT dep, pre FROM raw WHERE pre IN (SELECT id FROM known))"""
_UP = "up AS (SELECT dep, pre AS anc FROM e UNION SELECT u.dep, e.pre FROM up u JOIN e ON e.dep = u.anc)"
_BANDS = """sb AS (SELECT id, least(20, greatest(1, coalesce(min(difficulty), 1))) AS band, bool_or(coalesce(grade_start BETWEEN -1 AND 12, false)) AS anchored FROM skills WHERE id IS NOT NULL GROUP BY id),
b AS (SELECT * FROM sb UNION ALL SELECT id, 1, true FROM foundations WHERE id NOT IN (SELECT id FROM sb))"""
_URI = "nullif(regexp_replace(regexp_replace(regexp_replace(lower({0}), '^\\s+|\\s+$', '', 'g'), '^https://', 'http://'), '/+$', ''), '')"
_LANG = "coalesce(" + ", ".join(f"CASE WHEN list_contains(string_split({{0}}, '-'), '{t}') THEN '{t}' END" for t in E.LANGUAGE_TOKENS) + ")"


def _sig(c: str) -> str:
    from strandloom.functions.text import SIGNATURE_STOP

    words = ", ".join(f"'{w}'" for w in SIGNATURE_STOP)
    return f"list_distinct(list_filter(string_split({c}, '-'), lambda w: length(w) >= 3 AND w NOT IN ({words})))"


_COUNT = "len(list_filter(string_split({0}, '-'), lambda w: length(w) >= 2))"

ORACLE = {
    "q_unresolved": f"WITH {_RAW} SELECT pre, count(*) AS n_edges, 'unknown' AS reason FROM raw WHERE pre NOT IN (SELECT id FROM known) GROUP BY pre",
    "q_closure": f"WITH RECURSIVE {_RAW}, {_UP} SELECT dep, anc FROM up",
    "q_topo_levels": f"WITH RECURSIVE {_RAW}, l AS (SELECT dep AS id, 0 AS level FROM e UNION SELECT pre, 0 FROM e UNION SELECT e.dep, l.level + 1 FROM l JOIN e ON e.pre = l.id) SELECT id, CAST(max(level) AS INTEGER) AS level FROM l GROUP BY id",
    "q_transitive_reduction": f"WITH RECURSIVE {_RAW}, {_UP} SELECT dep, pre FROM e WHERE NOT EXISTS (SELECT 1 FROM e f JOIN up ON up.dep = f.pre WHERE f.dep = e.dep AND up.anc = e.pre)",
    "q_components": """
WITH RECURSIVE m AS (SELECT DISTINCT lower(trim(id_a)) AS dep, lower(trim(id_b)) AS pre FROM skill_matches WHERE lower(trim(verdict)) = 'same'),
e AS (SELECT dep, pre FROM m WHERE dep <> pre), up AS (SELECT dep, pre AS anc FROM e UNION SELECT u.dep, e.pre FROM up u JOIN e ON e.dep = u.anc)
SELECT a.dep AS id, least(a.dep, min(a.anc)) AS component FROM up a JOIN up b ON b.dep = a.anc AND b.anc = a.dep WHERE a.dep <> a.anc GROUP BY a.dep""",
    "q_alias_collapse": f"""
WITH RECURSIVE n AS (SELECT {_URI.format('concepturi')} AS d, {_URI.format('broaderconcepturi')} AS c FROM researchskillscollection_en),
a AS (SELECT d, min(c) AS c FROM n WHERE d IS NOT NULL AND c IS NOT NULL GROUP BY d), r AS (SELECT d, c AS cur, [d] AS way FROM a UNION ALL SELECT r.d, a.c, list_append(way, r.cur) FROM r JOIN a ON a.d = r.cur WHERE NOT list_contains(way, r.cur)),
l AS (SELECT DISTINCT d FROM r WHERE cur = d), o AS (SELECT * FROM a WHERE d NOT IN (SELECT d FROM l)), w AS (SELECT d, c, 1 AS k FROM o UNION ALL SELECT w.d, o.c, k + 1 FROM w JOIN o ON o.d = w.c)
SELECT d AS dropped_id, arg_max(c, k) AS canonical_id FROM w GROUP BY d""",
    "q_bounded_ancestors": f"WITH RECURSIVE {_RAW}, w AS (SELECT dep, pre AS anc, 1 AS depth FROM e UNION SELECT w.dep, e.pre, depth + 1 FROM w JOIN e ON e.dep = w.anc WHERE depth < 3) SELECT dep, anc, CAST(min(depth) AS INTEGER) AS depth FROM w GROUP BY 1, 2",
    "q_inherit_attribute": f"""
WITH RECURSIVE n AS (SELECT {_URI.format('concepturi')} AS id, {_URI.format('broaderconcepturi')} AS parent, reuselevel, status FROM researchskillscollection_en),
t AS (SELECT id, min(parent) AS parent FROM n WHERE id IS NOT NULL GROUP BY id), k AS (SELECT id, min(reuselevel) AS value FROM n WHERE reuselevel IS NOT NULL AND lower(status) <> 'released' GROUP BY id),
w AS (SELECT id, id AS cur, [id] AS way FROM t UNION ALL SELECT w.id, t.parent, list_append(way, t.parent) FROM w JOIN t ON t.id = w.cur LEFT JOIN k ON k.id = w.cur WHERE k.id IS NULL AND t.parent IS NOT NULL AND NOT list_contains(way, t.parent))
SELECT w.id, max(k.value) AS value FROM w LEFT JOIN k ON k.id = w.cur GROUP BY w.id""",
    "q_expert_scores": f"""
WITH RECURSIVE {_RAW}, {_UP},
p AS (SELECT lower(trim(id_a)) AS pre, lower(trim(id_b)) AS dep, lower(trim(verdict)) = 'same' AS positive FROM skill_matches WHERE id_a IS NOT NULL AND id_b IS NOT NULL AND verdict IS NOT NULL
  UNION ALL SELECT pre, id, coalesce(source IN (SELECT source FROM skill_sources WHERE trust_rank <= 2), false) FROM (SELECT id, source, lower(trim(unnest(string_split(prereqs, ',')))) AS pre FROM skills WHERE id IS NOT NULL) WHERE pre <> ''),
m AS (SELECT pre, dep, bool_or(positive) AS positive FROM p WHERE pre <> dep GROUP BY 1, 2)
SELECT (SELECT count(*) FROM m WHERE positive) AS positives, (SELECT count(*) FROM e JOIN m USING (dep, pre)) AS predicted, (SELECT count(*) FROM e JOIN m USING (dep, pre) WHERE positive) AS hits,
  (SELECT count(*) FROM m WHERE positive AND EXISTS (SELECT 1 FROM up WHERE up.dep = m.dep AND up.anc = m.pre)) AS recovered""",
    "q_hub_cap": f"WITH {_RAW}, {_BANDS} SELECT dep, pre, abs(x.band - y.band) AS gap, CAST(row_number() OVER (PARTITION BY pre ORDER BY abs(x.band - y.band), dep) AS INTEGER) AS rank FROM e JOIN b x ON x.id = dep JOIN b y ON y.id = pre QUALIFY rank <= 150",
    "q_trim_edges": f"""
WITH {_RAW}, d AS (SELECT dep, pre, pre IN (SELECT id FROM foundations) AS droppable FROM e),
r AS (SELECT *, count(*) OVER (PARTITION BY dep) AS n, sum(CASE WHEN droppable THEN 1 ELSE 0 END) OVER (PARTITION BY dep ORDER BY pre DESC) AS r FROM d)
SELECT dep, pre FROM r WHERE NOT droppable OR r > n - 1""",
    "q_edge_chain": f"""
WITH {_RAW}, {_BANDS},
f AS (SELECT id, min(difficulty) AS d, list_filter(list_transform(string_split(coalesce(arg_min(coalesce(topics, ''), rec_id), ''), ','), lambda t: lower(trim(t))), lambda t: t <> '') AS t, list_filter(list_transform(string_split(coalesce(arg_min(coalesce(occupations, ''), rec_id), ''), ','), lambda t: lower(trim(t))), lambda t: t <> '') AS o FROM skills WHERE id IS NOT NULL GROUP BY id),
k AS (SELECT b.id, band, anchored, CASE WHEN len(o) > 0 THEN least(7, 2 + floor(d / 4)) END AS level, coalesce(t[1] = 'technical-systems', false) AS tool, coalesce(t, []) AS topics FROM b LEFT JOIN f ON f.id = b.id),
v AS (SELECT DISTINCT id AS dep, lower(trim(unnest(string_split(prereqs, ',')))) AS pre FROM skills WHERE source = 'volunteers'),
q AS (SELECT e.dep, e.pre, v.dep IS NOT NULL AS named FROM e LEFT JOIN v ON v.dep = e.dep AND v.pre = e.pre)
SELECT q.dep, q.pre, named, CASE WHEN q.pre IN (SELECT id FROM foundations) THEN NULL WHEN regexp_matches(q.pre, '{E.LEAVES}') THEN 'leaf' WHEN {_LANG.format('q.dep')} <> {_LANG.format('q.pre')} THEN 'language'
  WHEN y.level > x.level THEN 'level' WHEN y.band > x.band AND NOT (named AND NOT x.anchored) THEN 'band' WHEN y.band > x.band - 0.05 AND y.band >= x.band AND NOT (named AND NOT x.anchored) THEN 'raw'
  WHEN {_COUNT.format('q.dep')} <= 2 AND {_COUNT.format('q.pre')} > {_COUNT.format('q.dep')} + 1 THEN 'specific'
  WHEN len({_sig('q.pre')}) >= 2 AND len({_sig('q.dep')}) > len({_sig('q.pre')}) AND list_has_all({_sig('q.dep')}, {_sig('q.pre')}) THEN 'hypernym'
  WHEN y.tool AND NOT (CASE WHEN x.tool THEN x.band - y.band >= 2 ELSE list_contains(x.topics, q.pre) END) THEN 'tool' END AS reason
FROM q JOIN k x ON x.id = q.dep JOIN k y ON y.id = q.pre""",
    "q_subject_areas": f"""
WITH {_RAW}, t AS (SELECT DISTINCT id, topic FROM (SELECT id, lower(trim(unnest(string_split(topics, ',')))) AS topic FROM skills) WHERE topic <> '' AND id IS NOT NULL),
a AS (SELECT dep, pre FROM raw WHERE dep IS NOT NULL UNION SELECT id, topic FROM t)
SELECT dep, pre FROM a SEMI JOIN t ON t.id = dep AND t.topic = pre WHERE pre IN (SELECT topic FROM t GROUP BY 1 HAVING count(*) >= 5)""",
    "q_band_inversions": f"WITH RECURSIVE {_RAW}, {_UP}, {_BANDS}, h AS (SELECT dep, max(b.band) AS highest FROM up JOIN b ON b.id = anc GROUP BY dep) SELECT count(*) AS skills, count(*) FILTER (WHERE highest > band) AS inverted FROM h JOIN b ON b.id = dep",
    "q_roots": f"WITH {_RAW} SELECT count(*) AS nodes, count(*) FILTER (WHERE id NOT IN (SELECT dep FROM e)) AS roots, count(*) FILTER (WHERE id NOT IN (SELECT dep FROM e) AND id NOT IN (SELECT pre FROM e)) AS isolated FROM known",
}
