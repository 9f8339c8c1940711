"""Queries of the problems 3 to 10, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import groups, language, leakage, mixture, neardup, neighbours, survivor, textform, visual


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.close_pairs(_table(spark, folder, "skill_vectors"), k=10, floor=0.9, probes=16)


def p3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest of every vector whose id is divisible by 50, against all."""
    near = neighbours.nearest(_table(spark, folder, "skill_vectors"), k=10, queries="vec_id % 50 = 0")
    return near.select(F.col("id").alias("vec_id"), F.col("other").alias("neighbour"), F.round("cosine", 6).alias("cosine"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    first = survivor.first_claims(_table(spark, folder, "skills"), _table(spark, folder, "skill_sources"), 2)
    return first.select("id", F.col("field").alias("fieldname"), "rec_id")


def p4_records(spark: SparkSession, folder: str) -> DataFrame:
    """One record per id, with the values of maximum posterior."""
    won = survivor.Survivors(_table(spark, folder, "skills"), _table(spark, folder, "skill_sources"), "estimated", 1).winners
    rows = _table(spark, folder, "skills").select("rec_id", "title", "description", "grade_start")
    value = F.when(F.col("field") == "title", F.col("title")).when(F.col("field") == "description", F.col("description")).otherwise(F.col("grade_start").cast("string"))
    wide = won.join(rows, "rec_id").select("id", "field", value.alias("value"))
    pick = lambda f: F.max(F.when(F.col("field") == f, F.col("value"))).alias(f)
    return wide.groupBy("id").agg(pick("title"), pick("description"), pick("grade_start").cast("int").alias("grade_start"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    ids = _table(spark, folder, "skills").select("id").where("id is not null").distinct()
    bare = lambda c: F.lower(F.regexp_replace(c, r"^[\s\x{a0}]+|[\s\x{a0}]+$", ""))
    pairs = _table(spark, folder, "skill_matches").where(bare("verdict") == "same").select(bare("id_a").alias("a"), bare("id_b").alias("b")).where("a <> b").distinct()
    pairs = pairs.join(ids.withColumnRenamed("id", "a"), "a", "left_semi").join(ids.withColumnRenamed("id", "b"), "b", "left_semi")
    return groups.groups(pairs)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    skills = visual.alike_pairs(_table(spark, folder, "skills"), "rec_id", "title").withColumn("tab", F.lit("skills"))
    items = visual.alike_pairs(_table(spark, folder, "cf_items"), "item_no", "fullstatement").withColumn("tab", F.lit("cf_items"))
    return skills.union(items).select("tab", "key_a", "key_b")


def p6_forms(spark: SparkSession, folder: str) -> DataFrame:
    skills = _table(spark, folder, "skills").select(F.lit("skills").alias("tab"), F.col("rec_id").alias("key"), visual.form("title").alias("form"))
    items = _table(spark, folder, "cf_items").select(F.lit("cf_items"), "item_no", visual.form("fullstatement"))
    return skills.union(items)


def p6_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose text looks like another string of their table: their class, their string, and the strings of the class."""
    skills = visual.alike_classes(_table(spark, folder, "skills"), "rec_id", "title").withColumn("tab", F.lit("skills"))
    items = visual.alike_classes(_table(spark, folder, "cf_items"), "item_no", "fullstatement").withColumn("tab", F.lit("cf_items"))
    return skills.unionByName(items)


TABS = ["skills", "cf_items"]


def _near(spark: SparkSession, folder: str) -> neardup.NearDuplicates:
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("description", F.lit("")))
    skills = _table(spark, folder, "skills").select(F.lit(0).alias("tab"), F.col("rec_id").alias("key"), text.alias("text"))
    items = _table(spark, folder, "cf_items").select(F.lit(1), "item_no", "fullstatement")
    return neardup.NearDuplicates(skills.union(items))


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("tab", F.element_at(F.array(*map(F.lit, TABS)), F.col("tab") + 1))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return _named(_near(spark, folder).pairs())


def p7_classes(spark: SparkSession, folder: str) -> DataFrame:
    return _named(_near(spark, folder).members())


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaks(_table(spark, folder, "documents"), _table(spark, folder, "eval_items"))


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.report(_table(spark, folder, "documents"), _table(spark, folder, "eval_items"))


def p8_containment(spark: SparkSession, folder: str) -> DataFrame:
    """How much of each leaked item every document holds, in shingles of five words."""
    documents, items = _table(spark, folder, "documents"), _table(spark, folder, "eval_items")
    return leakage.containment(documents, items, leakage.leaks(documents, items))


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.Mixture(_table(spark, folder, "documents"), _table(spark, folder, "mix_targets")).chosen


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.Mixture(_table(spark, folder, "documents"), _table(spark, folder, "mix_targets")).shares


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return language.mislabelled(_table(spark, folder, "documents"))


def p10_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    """Language and confidence of every paragraph and of its document."""
    return language.paragraphs(_table(spark, folder, "documents")).select("doc_id", "para_no", "lang", F.round("confidence", 4).alias("confidence"), "doc_lang", F.round("doc_confidence", 4).alias("doc_confidence"))


QUERIES = {
    "p3_found": p3_found, "p3_neighbours": p3_neighbours, "p4_found": p4_found, "p4_records": p4_records, "p5_found": p5_found, "p6_found": p6_found, "p6_forms": p6_forms, "p6_classes": p6_classes,
    "p7_found": p7_found, "p7_classes": p7_classes, "p8_found": p8_found, "p8_report": p8_report, "p8_containment": p8_containment, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_paragraphs": p10_paragraphs,
}


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _form(column: str) -> str:
    """SQL for the form of problem 6, for the characters of these tables."""
    wide = "".join(map(chr, range(0xFF01, 0xFF5F)))
    plain = "".join(map(chr, range(0x21, 0x7F)))
    alike, latin = "".join(textform.LOOKALIKES), "".join(textform.LOOKALIKES.values())
    out = f"translate(translate({column}, {_quote(wide)}, {_quote(plain)}), {_quote(alike)}, {_quote(latin)})"
    for a, b in (("ﬁ", "fi"), ("ﬂ", "fl"), ("…", "...")):
        out = f"replace({out}, '{a}', '{b}')"
    out = f"regexp_replace({out}, '[\\x{{200b}}-\\x{{200f}}\\x{{2060}}\\x{{feff}}\\x{{ad}}]', '', 'g')"
    out = f"regexp_replace({out}, '[\\s\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g')"
    return f"nfc_normalize(trim({out}))"


def _words(column: str) -> str:
    return f"regexp_extract_all(lower({_form(column)}), '[\\pL\\pN]+')"


def _usable() -> str:
    listed = ", ".join(map(_quote, survivor.STAND_INS))
    bare = lambda c: f"regexp_replace(lower({_form(c)}), '[.\\s]+$', '')"
    return f"""
WITH base AS (
  SELECT s.id, s.rec_id, s.updated_at, s.grade_start, coalesce(r.trust_rank, 1000000) AS rank,
    {bare('s.title')} AS t, {bare('s.description')} AS d, {_form('s.description')} AS form
  FROM skills s LEFT JOIN skill_sources r ON r.source = s.source WHERE s.id IS NOT NULL),
several AS (SELECT id FROM base GROUP BY id HAVING count(DISTINCT rec_id) >= 2),
claims AS (
  SELECT id, 'title' AS fieldname, rec_id, rank, updated_at FROM base WHERE t <> '' AND t NOT IN ({listed})
  UNION ALL SELECT id, 'description', rec_id, rank, updated_at FROM base WHERE d <> '' AND d NOT IN ({listed}) AND form LIKE '%.' AND form NOT LIKE '%..'
  UNION ALL SELECT id, 'grade_start', rec_id, rank, updated_at FROM base WHERE grade_start BETWEEN -1 AND 12)"""


def _alike(tab: str, key: str, text: str) -> str:
    return f"""SELECT '{tab}' AS tab, least(a.k, b.k) AS key_a, greatest(a.k, b.k) AS key_b
FROM (SELECT {key} AS k, {text} AS x, {_form(text)} AS f FROM {tab}) a JOIN (SELECT {key} AS k, {text} AS x, {_form(text)} AS f FROM {tab}) b ON a.f = b.f AND a.k < b.k AND a.x <> b.x"""


_NEAR = f"""
WITH sets AS (
  SELECT tab, k, list_sort(list_distinct(w)) AS s FROM (
    SELECT 'skills' AS tab, rec_id AS k, {_words("coalesce(title, '') || ' ' || coalesce(description, '')")} AS w FROM skills
    UNION ALL SELECT 'cf_items', item_no, {_words('fullstatement')} FROM cf_items WHERE fullstatement IS NOT NULL) WHERE len(list_distinct(w)) >= 14),
flat AS (SELECT tab, k, unnest(s) AS w FROM sets),
common AS (SELECT x.tab, x.k AS a, y.k AS b, count(*) AS c FROM flat x JOIN flat y ON x.tab = y.tab AND x.w = y.w AND x.k < y.k GROUP BY 1, 2, 3),
near AS (SELECT c.tab, a, b FROM common c JOIN sets p ON p.tab = c.tab AND p.k = a JOIN sets q ON q.tab = c.tab AND q.k = b WHERE 10 * c >= 7 * (len(p.s) + len(q.s) - c)),
both_ways AS (SELECT tab, a, b FROM near UNION ALL SELECT tab, b, a FROM near)
"""

ORACLE = {
    "p3_found": """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM skill_vectors
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.e, b.e) AS c FROM usable a JOIN usable b ON a.vec_id <> b.vec_id),
top AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY a ORDER BY c DESC, b) <= 10)
SELECT DISTINCT least(a, b) AS vec_a, greatest(a, b) AS vec_b FROM top WHERE c >= 0.9""",
    "p4_found": _usable() + " SELECT id, fieldname, rec_id FROM claims SEMI JOIN several USING (id) QUALIFY row_number() OVER (PARTITION BY id, fieldname ORDER BY rank, updated_at DESC NULLS LAST, rec_id) = 1",
    "p5_found": """
WITH RECURSIVE pairs AS (
  SELECT DISTINCT lower(trim(id_a)) AS a, lower(trim(id_b)) AS b FROM skill_matches WHERE lower(trim(verdict)) = 'same'),
kept AS (SELECT a, b FROM pairs WHERE a <> b AND a IN (SELECT id FROM skills) AND b IN (SELECT id FROM skills)),
links AS (SELECT a, b FROM kept UNION SELECT b, a FROM kept),
reach AS (SELECT a AS id, a AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT id, min(other) AS group_id FROM reach GROUP BY id""",
    "p6_found": _alike("skills", "rec_id", "title") + " UNION ALL " + _alike("cf_items", "item_no", "fullstatement"),
    "p6_forms": f"SELECT 'skills' AS tab, rec_id AS key, {_form('title')} AS form FROM skills UNION ALL SELECT 'cf_items', item_no, {_form('fullstatement')} FROM cf_items",
    "p7_found": _NEAR + "SELECT tab, a AS key_a, b AS key_b FROM near",
    "p7_classes": _NEAR
    + """, c AS (SELECT tab, k, min(k) OVER (PARTITION BY tab, s) AS class_id, count(*) OVER (PARTITION BY tab, s) AS copies FROM sets),
l AS (SELECT a.tab, a.class_id, count(DISTINCT b.class_id) AS links FROM both_ways n JOIN c a ON a.tab = n.tab AND a.k = n.a JOIN c b ON b.tab = n.tab AND b.k = n.b WHERE a.class_id <> b.class_id GROUP BY 1, 2)
SELECT c.tab, k AS key, class_id, copies, coalesce(links, 0) AS links FROM c LEFT JOIN l USING (tab, class_id)""",
    "p8_found": f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents), e AS (SELECT item_id, {_words('text')} AS w FROM eval_items),
dw AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 9], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 8)) AS i FROM d)),
ew AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS run FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS i FROM e))
SELECT DISTINCT doc_id, item_id FROM dw JOIN ew USING (run)""",
}
_CLASSES = """SELECT '{0}' AS tab, k AS key, min(k) OVER (PARTITION BY f) AS class_id, min(k) OVER (PARTITION BY x) AS string_id, n AS strings
FROM (SELECT {1} AS k, {2} AS x, {3} AS f FROM {0} WHERE {2} IS NOT NULL) JOIN (SELECT {3} AS f, count(DISTINCT {2}) AS n FROM {0} WHERE {2} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {2}) > 1) USING (f)"""
ORACLE["p6_classes"] = _CLASSES.format("skills", "rec_id", "title", _form("title")) + " UNION ALL " + _CLASSES.format("cf_items", "item_no", "fullstatement", _form("fullstatement"))
ORACLE["p8_containment"] = f"""
WITH leaks AS ({ORACLE['p8_found']}), d AS (SELECT doc_id, {_words('text')} AS w FROM documents SEMI JOIN leaks USING (doc_id)), e AS (SELECT item_id, {_words('text')} AS w FROM eval_items),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
es AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM e))
SELECT doc_id, item_id, n AS shingles, count(*) AS held FROM leaks JOIN es USING (item_id) JOIN ds USING (doc_id, s) JOIN (SELECT item_id, count(*) AS n FROM es GROUP BY 1) USING (item_id) GROUP BY 1, 2, 3"""
ORACLE["p8_report"] = f"SELECT item_id, count(*) AS documents FROM ({ORACLE['p8_found']}) GROUP BY item_id"
