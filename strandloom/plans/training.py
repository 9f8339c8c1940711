"""Queries of the general problems 1 and 2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators.hierarchy import Hierarchy
from strandloom.operators.hotkeys import KeyChunks, list_items
from strandloom.plans.tables import table


def uri(column: str) -> Column:
    """A URI with http, in lower case, without outer blanks and closing slash; null if blank."""
    bare = F.regexp_replace(F.lower(F.col(column)), r"^[\s\x{a0}]+|[\s\x{a0}]+$", "")
    out = F.regexp_replace(F.regexp_replace(bare, r"^https://", "http://"), r"/+$", "")
    return F.when(out != "", out)


def concept_hierarchy(spark: SparkSession, folder: str) -> Hierarchy:
    rows = table(spark, folder, "researchskillscollection_en")
    return Hierarchy(rows.select(uri("concepturi").alias("id"), uri("broaderconcepturi").alias("parent")))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    nodes = concept_hierarchy(spark, folder).nodes
    top = F.when(F.col("to_loop"), F.col("loop")).otherwise(F.col("root"))
    return nodes.where("to_loop or depth >= 8").select(F.col("id").alias("concepturi"), top.alias("topuri"), "depth")


def p1_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    nodes = concept_hierarchy(spark, folder).nodes
    return nodes.select(F.col("id").alias("concepturi"), "parent", "root", "depth", "in_loop", "descendants")


def p1_paths(spark: SparkSession, folder: str) -> DataFrame:
    return concept_hierarchy(spark, folder).paths().select(F.col("id").alias("concepturi"), F.array_join("path", " > ").alias("path"))


def p1_descendants(spark: SparkSession, folder: str) -> DataFrame:
    """Every concept with each concept below it and the steps down to it."""
    return concept_hierarchy(spark, folder).descendants().select(F.col("id").alias("concepturi"), F.col("descendant").alias("descendanturi"), "steps")


def slugs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Skills, and ``fieldname, keyname, rec_id`` of every slug that a row holds, once a row."""
    skills = table(spark, folder, "skills")
    fields = F.array(*(F.struct(F.lit(f).alias("fieldname"), list_items(f).alias("items")) for f in ("prereqs", "topics")))
    lists = skills.select("rec_id", F.explode(fields).alias("x")).select("rec_id", "x.fieldname", F.explode("x.items").alias("keyname"))
    return skills, lists


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    skills, lists = slugs(spark, folder)
    counts = KeyChunks(lists, ["fieldname", "keyname"], "rec_id").merge_counts()
    return counts.where(F.col("n_rows") >= 0.02 * skills.count()).select("fieldname", "keyname")


def p2_runs(spark: SparkSession, folder: str) -> DataFrame:
    _, lists = slugs(spark, folder)
    return KeyChunks(lists, ["fieldname", "keyname"], "rec_id").runs()


QUERIES = {"p1_found": p1_found, "p1_hierarchy": p1_hierarchy, "p1_paths": p1_paths, "p1_descendants": p1_descendants, "p2_found": p2_found, "p2_runs": p2_runs}

_URI = "nullif(regexp_replace(regexp_replace(regexp_replace(lower({0}), '^\\s+|\\s+$', '', 'g'), '^https://', 'http://'), '/+$', ''), '')"
_TREE = f"""
WITH RECURSIVE named AS (
  SELECT {_URI.format('concepturi')} AS id, {_URI.format('broaderconcepturi')} AS parent FROM researchskillscollection_en),
one AS (SELECT id, min(parent) AS parent FROM named WHERE id IS NOT NULL GROUP BY id),
tree AS (SELECT a.id, b.id AS parent FROM one a LEFT JOIN one b ON b.id = a.parent),
up AS (
  SELECT id, id AS cur, 0 AS steps, [id] AS way FROM tree
  UNION ALL
  SELECT u.id, t.parent, u.steps + 1, list_append(u.way, t.parent)
  FROM up u JOIN tree t ON t.id = u.cur WHERE t.parent IS NOT NULL AND NOT list_contains(u.way, t.parent)),
ends AS (SELECT u.*, t.parent AS back FROM (SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY id ORDER BY steps DESC) = 1) u JOIN tree t ON t.id = u.cur),
tops AS (
  SELECT id, way, back IS NOT NULL AS to_loop,
    CASE WHEN back IS NULL THEN steps ELSE list_position(way, back) - 1 END AS depth,
    CASE WHEN back IS NULL THEN cur ELSE back END AS root,
    CASE WHEN back IS NOT NULL THEN list_min(way[list_position(way, back):]) END AS loop FROM ends)"""

ORACLE = {
    "p1_found": _TREE + " SELECT id AS concepturi, CASE WHEN to_loop THEN loop ELSE root END AS topuri, CAST(depth AS INTEGER) AS depth FROM tops WHERE to_loop OR depth >= 8",
    "p1_hierarchy": _TREE
    + """,
over_ AS (SELECT a.anc, count(*) AS n FROM (SELECT id, unnest(way[2:depth + 1]) AS anc FROM tops) a GROUP BY a.anc)
SELECT t.id AS concepturi, tree.parent, t.root, CAST(t.depth AS INTEGER) AS depth, t.to_loop AND t.depth = 0 AS in_loop, CAST(coalesce(o.n, 0) AS BIGINT) AS descendants
FROM tops t JOIN tree ON tree.id = t.id LEFT JOIN over_ o ON o.anc = t.id""",
    "p1_paths": _TREE + " SELECT id AS concepturi, array_to_string(list_reverse(way[:depth + 1]), ' > ') AS path FROM tops",
    "p1_descendants": _TREE
    + """
SELECT way[k + 1] AS concepturi, id AS descendanturi, CAST(k AS INTEGER) AS steps FROM (SELECT id, way, unnest(range(1, depth + 1)) AS k FROM tops)""",
    "p2_found": """
WITH items AS (
  SELECT rec_id, 'prereqs' AS fieldname, lower(trim(unnest(string_split(prereqs, ',')))) AS keyname FROM skills
  UNION ALL SELECT rec_id, 'topics', lower(trim(unnest(string_split(topics, ',')))) FROM skills)
SELECT fieldname, keyname FROM items WHERE keyname <> '' GROUP BY 1, 2 HAVING count(DISTINCT rec_id) >= 0.02 * (SELECT count(*) FROM skills)""",
    "p2_runs": """
WITH items AS (
  SELECT DISTINCT rec_id, fieldname, keyname FROM (
    SELECT rec_id, 'prereqs' AS fieldname, lower(trim(unnest(string_split(prereqs, ',')))) AS keyname FROM skills
    UNION ALL SELECT rec_id, 'topics', lower(trim(unnest(string_split(topics, ',')))) FROM skills) WHERE keyname <> ''),
steps AS (SELECT *, rec_id - lag(rec_id) OVER (PARTITION BY fieldname, keyname ORDER BY rec_id) AS gap FROM items)
SELECT fieldname, keyname, count(*) AS n_rows, min(rec_id) AS first, max(rec_id) AS last, CAST(coalesce(max(gap), 0) AS BIGINT) AS longest_gap FROM steps GROUP BY 1, 2""",
}
