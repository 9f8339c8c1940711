"""Seed pairs: prerequisites that a source names, resolved to ids or quarantined with a reason.

Readers give labels ``pre, dep, source, raw``; ``resolve_pairs`` turns them into
edges. Nothing vanishes: every pair comes out as an edge or with the reasons of
both its ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.hashing import holdout
from strandloom.operators.relational import assert_none
from strandloom.sources.files import column, read_csv, read_tsv


def exercise_pairs(spark: SparkSession, path: str, tagged: DataFrame) -> DataFrame:
    """Exercises with ``;``-joined prerequisites, which are codes or names; ``root`` is none.

    ``tagged``: ``value, id`` of exercise names (see ``lists.tag_values``). An end
    is its tagged id, or its display name, or its name.
    """
    df = read_tsv(spark, path)
    cell = lambda c: F.trim(F.coalesce(column(df, c, path), F.lit("")))
    rows = df.select(cell("Data Name").alias("name"), cell("Prereq(s)").alias("list"), cell("Code").alias("code"), cell("Display Name").alias("shown"))
    codes = rows.where("code <> '' and name <> ''").groupBy("code").agg(F.max("name").alias("by_code"))
    shown = rows.where("shown <> '' and name <> ''").groupBy("name").agg(F.max("shown").alias("shown"))
    each = rows.where("name <> '' and list not in ('', 'root')").select("name", F.explode(F.split("list", ";")).alias("p")).select("name", F.trim("p").alias("p")).where("p <> ''")
    each = each.join(codes.withColumnRenamed("code", "p"), "p", "left").select(F.coalesce("by_code", "p").alias("from"), "name")

    def label(df: DataFrame, end: str, out: str) -> DataFrame:
        with_id = df.join(tagged.select(F.col("value").alias(end), F.col("id").alias("_id")), end, "left")
        return with_id.join(shown.select(F.col("name").alias(end), F.col("shown").alias("_shown")), end, "left").withColumn(out, F.coalesce("_id", "_shown", end)).drop("_id", "_shown")

    each = label(label(each, "from", "pre"), "name", "dep")
    return each.select("pre", "dep", F.lit("khan").alias("source"), F.concat("from", F.lit("->"), "name").alias("raw"))


def concept_pairs(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Lines ``dependent,prerequisite`` without a header; ``files`` maps a path to its source's name."""
    out = None
    for path, source in files.items():
        line = spark.read.text(path).select(F.trim("value").alias("raw")).where("raw <> ''")
        cells = F.split("raw", ",", -1)
        assert_none(line.where((F.size(cells) != 2) | (F.trim(cells[0]) == "") | (F.trim(cells[1]) == "")), f'{path}: expected "Dependent,Prereq"')
        some = line.select(cells[1].alias("pre"), cells[0].alias("dep"), F.lit(source).alias("source"), "raw")
        out = some if out is None else out.union(some)
    return out


def positional_pairs(spark: SparkSession, path: str, pre: int = 0, dep: int = 3, source: str = "metacademy") -> DataFrame:
    """Two columns of a headed file by their place."""
    df = read_csv(spark, path)
    a, b = (F.col(f"`{df.columns[k]}`") for k in (pre, dep))
    return df.where((F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")).select(a.alias("pre"), b.alias("dep"), F.lit(source).alias("source"), F.concat(a, F.lit("->"), b).alias("raw"))


def resolve_pairs(pairs: DataFrame, exact: DataFrame, fallback: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges ``src, dst, source, confidence, holdout, fallback``, and all other pairs with ``src_reason, dst_reason``.

    ``pairs``: ``pre, dep, source, raw``. ``exact`` (``label, id``) resolves
    first; ``fallback`` (``label, id, reason``) resolves the rest, or says why
    not. A pair whose ends are one id is a self-loop.
    """
    first = exact.where("id is not null").select("label", F.col("id").alias("e"))
    second = fallback.select("label", F.col("id").alias("f"), "reason")
    out = pairs
    for end, new in (("pre", "src"), ("dep", "dst")):
        out = out.join(first.select(F.col("label").alias(end), F.col("e").alias(f"e_{new}")), end, "left").join(second.select(F.col("label").alias(end), F.col("f").alias(f"f_{new}"), F.col("reason").alias(f"r_{new}")), end, "left")
        out = out.withColumn(new, F.coalesce(f"e_{new}", f"f_{new}"))
    loop = F.coalesce(F.col("src") == F.col("dst"), F.lit(False))
    whole = F.col("src").isNotNull() & F.col("dst").isNotNull() & ~loop
    weak = F.col("e_src").isNull() | F.col("e_dst").isNull()
    edges = out.where(whole).select("src", "dst", "source", F.when(weak, 0.85).otherwise(1.0).alias("confidence"), holdout("source", "raw").alias("holdout"), weak.alias("fallback"))
    why = lambda end: F.when(F.col(end).isNotNull(), "ok").otherwise(F.coalesce(f"r_{end}", F.lit("no-match")))
    lost = out.where(~whole).select("pre", "dep", "source", "raw", why("src").alias("src_reason"), F.concat(why("dst"), F.when(loop, " (self-loop)").otherwise("")).alias("dst_reason"))
    return edges, lost


def node_pairs(edges: DataFrame, skill_of: DataFrame, alias: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Learning paths between nodes as pairs of ids: ``src, dst, raw``, and those without, ``src, dst, raw, reason``.

    ``edges``: ``rel, src, dst`` of nodes; ``skill_of``: ``node, id``; ``alias``:
    ``dropped_id, canonical_id``.
    """
    e = edges.where("rel = 'buildsTowards'").select(F.col("src").alias("a"), F.col("dst").alias("b"), F.concat("src", F.lit("->"), "dst").alias("raw"))
    for end in ("a", "b"):
        e = e.join(skill_of.select(F.col("node").alias(end), F.col("id").alias(f"id_{end}")), end, "left")
        e = e.join(alias.select(F.col("dropped_id").alias(f"id_{end}"), F.col("canonical_id").alias(f"to_{end}")), f"id_{end}", "left").withColumn(f"id_{end}", F.coalesce(f"to_{end}", f"id_{end}")).drop(f"to_{end}")
    reason = F.when(F.col("id_a").isNull() | F.col("id_b").isNull(), "no-skill").when(F.col("id_a") == F.col("id_b"), "self-loop")
    e = e.withColumn("reason", reason)
    return e.where("reason is null").select(F.col("id_a").alias("src"), F.col("id_b").alias("dst"), "raw"), e.where("reason is not null").select(F.col("a").alias("src"), F.col("b").alias("dst"), "raw", "reason")


def prior_names(units: DataFrame, tagged: DataFrame) -> DataFrame:
    """``dep, name``: what a unit asks for beforehand, for the skill that carries the unit's tag. ``tagged``: ``value, id``."""
    return units.select("slug", F.explode("prior").alias("name")).join(tagged.select(F.col("value").alias("slug"), F.col("id").alias("dep")), "slug").select("dep", "name")


def kept_seeds(edges: DataFrame, alias: DataFrame) -> DataFrame:
    """``pre, dep, source`` of the seeds that are not held out, through aliases; pairs whose ends fall together are left out."""
    out = edges.where(~F.col("holdout")).select(F.col("src").alias("pre"), F.col("dst").alias("dep"), "source")
    for end in ("pre", "dep"):
        out = out.join(alias.select(F.col("dropped_id").alias(end), F.col("canonical_id").alias("_to")), end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
    return out.where("pre <> dep").select("pre", "dep", "source").distinct()


# The share of its pairs that each source must resolve.
FLOORS = {
    "khan": 0.675, "alcpl_data_mining": 0.172, "alcpl_geometry": 0.029, "alcpl_physics": 0.044, "alcpl_precalculus": 0.072, "metacademy": 0.04, "courses": 0.065, "opensalt_grade": 0.201, "foundation": 0.9, "learningcommons": 0.71, "digcomp": 0.9, "oak_thread": 0.9,
}


def source_shares(edges: DataFrame, lost: DataFrame, floors: dict[str, float] | None = None) -> DataFrame:
    """``source, total, resolved, floor, short``: whether a source resolves less than its floor, or has none."""
    floors = FLOORS if floors is None else floors
    both = edges.select("source", F.lit(1).alias("ok")).union(lost.select("source", F.lit(0).alias("ok")))
    counts = both.groupBy("source").agg(F.count("*").alias("total"), F.sum("ok").alias("resolved"))
    floor = F.try_element_at(F.create_map(*(F.lit(x) for pair in floors.items() for x in pair)), F.col("source"))
    return counts.withColumn("floor", floor).withColumn("short", F.col("floor").isNull() | (F.col("resolved") < F.col("floor") * F.col("total")))


def assert_floors(edges: DataFrame, lost: DataFrame, floors: dict[str, float] | None = None) -> None:
    assert_none(source_shares(edges, lost, floors).where("short"), "a source resolves too few of its pairs")
