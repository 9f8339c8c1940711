"""Queries of candidates, guarded merges, seeds and caps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import hashing as H
from strandloom.functions import text as X
from strandloom.operators import candidates as K
from strandloom.operators import edges as L
from strandloom.operators import enrich as E
from strandloom.operators import folds as O
from strandloom.operators import graph as G
from strandloom.operators import similarity as S
from strandloom.operators.blocks import Differs
from strandloom.operators.lists_index import ListIndex
from strandloom.plans import graphs, measures
from strandloom.plans.tables import table
from strandloom.runtime import Scratch


def _skills(spark: SparkSession, folder: str) -> DataFrame:
    """One row per id: ``id, raw, band, topics, start, end, title, sources, ord``."""
    rows = table(spark, folder, "skills").where("id is not null")
    grade = lambda c: F.when(F.col(c).between(-1, 12), F.col(c))
    topics = F.filter(F.transform(F.split(F.coalesce("topics", F.lit("")), ","), lambda t: F.lower(F.trim(t))), lambda t: t != "")
    one = rows.groupBy("id").agg(
        F.coalesce(F.min("difficulty"), F.lit(10)).alias("raw"), F.min(grade("grade_start")).alias("start"), F.max(grade("grade_end")).alias("end"), F.min(F.struct("rec_id", topics.alias("t"))).getField("t").alias("topics"),
        F.min(F.when(F.col("title").isNotNull(), F.struct("rec_id", "title"))).getField("title").alias("title"), F.countDistinct("source").alias("sources"), F.min("rec_id").alias("ord"),
    )
    return one.withColumn("band", F.least(F.lit(20), F.greatest(F.lit(1), F.col("raw"))))


def _profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Profiles of all skills; vectors that more than five rows share make a skill pathological."""
    part = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    rows = table(spark, folder, "skills").where("id is not null")
    more = rows.groupBy("id").agg(F.min(F.struct("rec_id", part(F.col("occupations")).alias("o"))).getField("o").alias("occupations"), F.array_sort(F.collect_set("source")).alias("sources"))
    v = table(spark, folder, "skill_vectors").where("id is not null and embedding is not null").withColumn("signature", H.vector_signature("embedding"))
    many = v.groupBy("signature").agg(F.count("*").alias("n")).where("n > 5").select("signature")
    bad = v.join(many, "signature", "left_semi").select("id", F.lit(True).alias("pathological")).distinct()
    full = _skills(spark, folder).drop("sources", "title").join(more, "id").join(bad, "id", "left")
    level = F.when(F.size("occupations") > 0, F.concat(F.lit("skillsengland:level:"), F.least(F.lit(7), 2 + F.floor(F.col("raw") / 4)).cast("string")))
    hubs = [r.id for r in table(spark, folder, "foundations").select("id").collect()]  # a short list by contract
    return K.profiles(full.withColumn("tags", F.coalesce(level, F.lit(""))), L.language_token, hubs)


def q_topic_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """The first five prerequisites of every skill among its topics, from the easiest on; the hardest fifth takes nearer ones."""
    p = Scratch(spark, "profiles").save(_profiles(spark, folder), "profiles")
    return K.topic_candidates(p, relaxed=F.col("raw") >= K.upper_fifth(p))


def q_candidate_slots(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates in all slots, for the skills of the vectors whose id is divisible by 50."""
    return _slots(spark, folder, 24)


def _slots(spark: SparkSession, folder: str, probe: int) -> DataFrame:
    v = table(spark, folder, "skill_vectors").where("id is not null").where(S.usable("embedding", measures.DIM))
    one = v.groupBy("id").agg(F.min(F.struct("vec_id", "embedding")).alias("v")).select("id", F.col("v.vec_id").alias("key"), F.col("v.embedding").alias("vector"))
    p = Scratch(spark, "profiles").save(_profiles(spark, folder).join(one.select("id", "key"), "id"), "profiles")
    asked = one.where("key % 50 = 0").select("key", "vector")
    ancestors = K.topic_candidates(p.drop("key"), relaxed=F.col("raw") >= K.upper_fifth(p)).join(p.join(asked, "key", "left_semi").select("id"), "id", "left_semi")
    return K.slots(p, ListIndex(one, "key", "vector", measures.DIM), ancestors, asked, measures.DIM, probe=probe)


def q_index_top(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50 that belong to another id, through the index with all lists."""
    v = table(spark, folder, "skill_vectors")
    index = ListIndex(v, "vec_id", "embedding", measures.DIM, {"other_id": "id"})
    near = index.top(v.where("vec_id % 50 = 0").withColumn("own", F.col("id")), 5, "vec_id", "embedding", probe=1_000_000, guard=Differs("own", "other_id"))
    return near.select("id", "other", F.round("cosine", 5).alias("cosine"), "rank")


def q_guarded_aliases(spark: SparkSession, folder: str) -> DataFrame:
    """No SQL: greedy. Near titles merged under the guards of antonyms and lowest grades."""
    pairs = measures.q_bucket_pairs(spark, folder).select("a", "b", F.lit(1).alias("ord"))
    rows = _skills(spark, folder).where("title is not null").select("id", "title", "sources", F.col("start").alias("lowest"))
    signature = rows.select("id", X.token_signature("title").alias("s")).where("s <> ''")
    first = signature.groupBy("s").agg(F.min("id").alias("a"))
    star = signature.join(first, "s").where("id <> a").select("a", F.col("id").alias("b"), F.lit(0).alias("ord"))
    return O.guarded_merge(rows, star.union(pairs), measures.ANTONYMS)


def q_feasible_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """No SQL: greedy. Prerequisites as seeds, those of foundations first."""
    hubs = table(spark, folder, "foundations").select(F.col("id").alias("pre"), F.lit(0).alias("late"))
    seeds = graphs.edges(spark, folder).join(F.broadcast(hubs), "pre", "left").select("dep", "pre", F.coalesce("late", F.lit(1)).alias("late"), F.xxhash64("dep", "pre").alias("ord"))
    return O.feasible_seeds(graphs.bands(spark, folder), seeds)


def q_hub_caps(spark: SparkSession, folder: str) -> DataFrame:
    """No SQL: stateful caps. Edges that stay under 30 a topic, 150 in all and 15 of a tool."""
    b = graphs.bands(spark, folder).select("id", "band")
    topics = _skills(spark, folder).select(F.col("id").alias("dep"), "topics")
    e = graphs.edges(spark, folder).join(b.select(F.col("id").alias("dep"), F.col("band").alias("bd")), "dep").join(b.select(F.col("id").alias("pre"), F.col("band").alias("bp")), "pre").join(topics, "dep", "left")
    e = e.select("dep", "pre", F.abs(F.col("bd") - F.col("bp")).alias("gap"), F.lit(False).alias("seed"), "topics")
    tools = graphs.chain_skills(spark, folder).select(F.col("id").alias("pre"), F.coalesce(F.col("tags").contains(L.TOOL), F.lit(False)).alias("tech"))
    return O.hub_caps(e.join(tools, "pre"))


def q_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """No SQL: greedy. Skills without prerequisites and the words of their ids that are words of a topic, as hard as its easiest skill."""
    s = _skills(spark, folder)
    lonely = s.join(graphs.edges(spark, folder).select(F.col("dep").alias("id")).distinct(), "id", "left_anti").select("id", F.col("raw").cast("double").alias("raw"), "ord")
    single = s.select("raw", F.explode("topics").alias("t")).select("raw", F.explode(F.split("t", "-")).alias("id")).where("length(id) >= 5").groupBy("id").agg(F.min("raw").cast("double").alias("raw")).select("id", "raw", F.lit(False).alias("tech"))
    return O.orphan_prerequisites(lonely, single)


def q_weak_components(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of skills that prerequisites join, foundations aside."""
    e = graphs.edges(spark, folder).join(F.broadcast(table(spark, folder, "foundations").select(F.col("id").alias("pre"))), "pre", "left_anti")
    return G.weak_components(e)


def q_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """Topics that the nearest vectors of every query vector agree on."""
    v, q = measures._vectors(spark, folder)
    near = S.exact_top_k(v, q, 10, "vec_id", "embedding", measures.DIM)
    topics = table(spark, folder, "skills").where("id is not null").select("id", F.explode(F.split("topics", ",")).alias("t")).select("id", F.lower(F.trim("t")).alias("label")).where("label <> ''").distinct()
    labels = v.where("id is not null").join(topics, "id").select(F.col("vec_id").alias("other"), "label")
    return E.neighbour_vote(near, labels, 0.4, 10, 3, 3).select("id", "label", F.round("weight", 4).alias("weight"), "rank")


def q_ancestor_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The first six prerequisites within three steps of every skill."""
    return E.ancestor_labels(graphs.edges(spark, folder), 3).select("id", F.array_join("labels", ",").alias("labels"))


def q_heights(spark: SparkSession, folder: str) -> DataFrame:
    return E.heights(graphs.edges(spark, folder))


def q_grow(spark: SparkSession, folder: str) -> DataFrame:
    """The tree that prerequisites make below the skills that nothing depends on, at most 8 deep."""
    e = graphs.edges(spark, folder)
    tops = e.select(F.col("dep").alias("id")).distinct().join(e.select(F.col("pre").alias("id")), "id", "left_anti")
    nodes, _ = E.grow(tops, e.select(F.col("pre").alias("id"), F.col("dep").alias("parent")), 8, 10**12)
    return nodes


QUERIES = {f.__name__: f for f in (q_backfill, q_ancestor_labels, q_heights, q_grow, q_topic_candidates, q_candidate_slots, q_index_top, q_guarded_aliases, q_feasible_seeds, q_hub_caps, q_orphans, q_weak_components)}

_STUDY = K.STUDY.replace("(?i)", "")
_SK = f"""s AS (SELECT id, coalesce(min(difficulty), 10) AS raw, min(CASE WHEN grade_start BETWEEN -1 AND 12 THEN grade_start END) AS gs, max(CASE WHEN grade_end BETWEEN -1 AND 12 THEN grade_end END) AS ge,
  arg_min(coalesce(topics, ''), rec_id) AS topics, arg_min(coalesce(occupations, ''), rec_id) AS occ FROM skills WHERE id IS NOT NULL GROUP BY id),
g AS (SELECT id, list_transform(embedding[1:16], lambda x: CASE WHEN isnan(x) THEN 'nan' ELSE CAST(round(CAST(x AS DOUBLE), 3) + 0.0 AS VARCHAR) END) AS sg FROM skill_vectors WHERE id IS NOT NULL AND embedding IS NOT NULL),
worse AS (SELECT DISTINCT id FROM g WHERE sg IN (SELECT sg FROM g GROUP BY 1 HAVING count(*) > 5)),
z AS (SELECT s.*, least(20, greatest(1, raw)) AS band, CASE WHEN len(list_filter(string_split(occ, ','), lambda o: trim(o) <> '')) > 0 THEN least(7, 2 + floor(raw / 4)) END AS level, {graphs._LANG.format('s.id')} AS lang,
  regexp_matches(s.id, '{_STUDY}', 'i') AS study, w.id IS NOT NULL AS bad FROM s LEFT JOIN worse w ON w.id = s.id),
f AS (SELECT * FROM (SELECT id, raw, band, gs, ge, level, lang, study, bad, lower(trim(unnest(string_split(topics, ',')))) AS topic, unnest(range(1, len(string_split(topics, ',')) + 1)) AS n FROM z) WHERE topic <> '')"""

ORACLE = {
    "q_topic_candidates": f"""
WITH {_SK}, m AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n) - 1 AS pos FROM (SELECT id, raw, band, gs, ge, level, lang, study, bad, topic, min(n) AS n FROM f GROUP BY ALL)),
lim AS (SELECT raw AS top FROM (SELECT raw, row_number() OVER (ORDER BY raw) - 1 AS k, count(*) OVER () AS c FROM z) WHERE k = floor(c * 0.8)),
p AS (SELECT d.id, c.id AS candidate, min(d.pos) AS pos, c.raw AS rc FROM m d JOIN m c ON c.topic = d.topic CROSS JOIN lim
  WHERE d.id <> c.id AND c.raw <= d.raw - CASE WHEN d.raw >= top THEN 0.1 ELSE 2 END AND NOT c.bad AND NOT (c.study AND NOT d.study) AND (d.lang IS NULL OR c.lang IS NULL OR d.lang = c.lang)
  AND NOT coalesce(d.gs >= 7 AND c.ge <= 3, false) AND NOT coalesce(c.level > d.level, false) AND (c.raw < d.raw OR c.band < d.band) GROUP BY 1, 2, 4)
SELECT id, candidate, CAST(row_number() OVER (PARTITION BY id ORDER BY pos, rc, candidate) AS INTEGER) AS rank FROM p QUALIFY rank <= 5""",
    "q_index_top": f"""
WITH {measures._V} SELECT a.vec_id AS id, b.vec_id AS other, round({measures._COS}, 5) AS cosine, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY {measures._COS} DESC, b.vec_id) AS INTEGER) AS rank
FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 AND a.id IS DISTINCT FROM b.id QUALIFY rank <= 5""",
    "q_weak_components": f"""
WITH RECURSIVE {graphs._RAW}, l AS (SELECT dep AS a, pre AS b FROM e WHERE pre NOT IN (SELECT id FROM foundations)), b AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS id, a AS o FROM b UNION SELECT r.id, b.b FROM r JOIN b ON b.a = r.o) SELECT id, min(o) AS component FROM r GROUP BY id""",
    "q_backfill": f"""
WITH {measures._V}, n AS (SELECT a.vec_id AS id, b.id AS sid, {measures._COS} AS c FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY {measures._COS} DESC, b.vec_id) <= 10),
m AS (SELECT * FROM n WHERE c >= 0.4), ok AS (SELECT id FROM m GROUP BY id HAVING count(*) >= 3),
t AS (SELECT DISTINCT id AS sid, label FROM (SELECT id, lower(trim(unnest(string_split(topics, ',')))) AS label FROM skills WHERE id IS NOT NULL) WHERE label <> ''),
w AS (SELECT m.id, label, sum(c) AS weight FROM m SEMI JOIN ok ON ok.id = m.id JOIN t USING (sid) GROUP BY 1, 2 HAVING sum(c) >= 3 * 0.4)
SELECT id, label, round(weight, 4) AS weight, CAST(row_number() OVER (PARTITION BY id ORDER BY weight DESC, label) AS INTEGER) AS rank FROM w QUALIFY rank <= 3""",
    "q_ancestor_labels": f"""
WITH RECURSIVE {graphs._RAW}, w AS (SELECT dep, pre AS anc, 1 AS depth FROM e UNION SELECT w.dep, e.pre, depth + 1 FROM w JOIN e ON e.dep = w.anc WHERE depth < 3),
m AS (SELECT dep, anc, min(depth) AS depth FROM w WHERE dep <> anc GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY dep ORDER BY min(depth), anc) <= 6)
SELECT dep AS id, string_agg(anc, ',' ORDER BY depth, anc) AS labels FROM m GROUP BY dep""",
    "q_heights": f"""
WITH RECURSIVE {graphs._RAW}, l AS (SELECT pre AS id, 0 AS k FROM e WHERE pre NOT IN (SELECT dep FROM e) UNION SELECT e.dep, l.k + 1 FROM l JOIN e ON e.pre = l.id)
SELECT id, CAST(max(k) AS INTEGER) AS longest, CAST(min(k) AS INTEGER) AS shortest FROM l GROUP BY id""",
    "q_grow": f"""
WITH RECURSIVE {graphs._RAW}, l AS (SELECT dep AS id, 0 AS depth FROM e WHERE dep NOT IN (SELECT pre FROM e) UNION SELECT e.pre, l.depth + 1 FROM l JOIN e ON e.dep = l.id WHERE l.depth < 8),
m AS (SELECT id, min(depth) AS depth FROM l GROUP BY id)
SELECT m.id, CASE WHEN m.depth > 0 THEN (SELECT min(e.dep) FROM e JOIN m p ON p.id = e.dep WHERE e.pre = m.id AND p.depth = m.depth - 1) END AS parent, CAST(m.depth AS INTEGER) AS depth FROM m""",
}
