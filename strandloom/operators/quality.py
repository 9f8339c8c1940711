"""Quality conditions of a finished build, each graded from a measured value.

A condition is a frame of one row with a ``value``, and the values at which it
passes (score 1) and fails (score 0); scores are linear between, above 1 beyond
the pass, and never below 0. A value that can't be measured (a count that is
divided by is 0) is an error that names the condition. A condition whose input
is missing scores 0.

Frames: ``skills``: ``id, title, band, occupations, topics`` (arrays); ``edges``
and ``seeds``: ``dep, pre``; ``known``: all ancestors ``dep, anc``.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators import graph as G
from strandloom.operators.edges import language_token, subject_areas

# Hubs that are anomalies; a hash that ends an overlong id.
ANOMALOUS = r"retell-stories-related-to.*-day|^sced-|language-immersion-prior|understand-object-naming-and-naming-conventions|^(leadership|assisted-reading|corrective-reading|study-hall)\z"
HASHED = r"-[a-f0-9]{6}\z"


def share(condition: Column) -> Column:
    """The share of rows that meet a condition; null counts as not met."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def graded(name: str, value: DataFrame, good: float, bad: float) -> DataFrame:
    """``condition, score`` of a frame of one ``value``."""
    if good == bad:
        raise ValueError(f"{name}: expected distinct bounds")
    v = F.col("value").cast("double")
    sound = F.when(v.isNull() | F.isnan(v), F.raise_error(F.lit(f"{name}: expected a finite measurement"))).otherwise(v)
    return value.select(F.lit(name).alias("condition"), F.greatest(F.lit(0.0), (sound - F.lit(float(bad))) / F.lit(float(good - bad))).alias("score"))


def missing(spark, name: str) -> DataFrame:
    return spark.createDataFrame([(name, 0.0)], "condition string, score double")


def _ratio(part: DataFrame, whole: DataFrame) -> DataFrame:
    """Rows of ``part`` for each row of ``whole``."""
    return part.agg(F.count("*").alias("p")).crossJoin(whole.agg(F.count("*").alias("w"))).select(F.try_divide(F.col("p").cast("double"), F.col("w")).alias("value"))  # one row each


def acyclic(skills: DataFrame, edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Share of edges that are self-edges, end at no skill, or belong to a skill on or above a cycle.

    ``known``, all ancestors, saves going through the levels if it is there.
    """
    if known is None:
        ordered = G.topo_levels(edges, skills.select("id"))
    else:
        loop = known.where("dep = anc").select("anc")
        ordered = skills.select("id").join(known.join(loop, "anc", "left_semi").select(F.col("dep").alias("id")), "id", "left_anti")
    ordered = ordered.select(F.col("id").alias("dep"), F.lit(True).alias("ordered"))
    marked = edges.join(ordered, "dep", "left").join(skills.select(F.col("id").alias("pre"), F.lit(True).alias("there")), "pre", "left")
    return graded("prerequisites form no cycle and name other skills", marked.agg(share((F.col("dep") == F.col("pre")) | F.col("there").isNull() | F.col("ordered").isNull()).alias("value")), 0, 1)


def shared_vectors(vectors: DataFrame, vector: str) -> DataFrame:
    """The most vectors that share their first three numbers to four decimals."""
    first = F.transform(F.slice(vector, 1, 3), lambda x: F.round(x.cast("double"), 4) + F.lit(0.0))
    n = vectors.agg(F.count("*")).first()[0]
    return graded("at most 5 skills share a vector", vectors.groupBy(first.alias("s")).agg(F.count("*").alias("n")).agg(F.max("n").alias("value")), 5, max(n, 6))


def current_picks(picks: DataFrame, difficulty: DataFrame) -> DataFrame:
    """Share of picked rows that name a gone skill or a pick that is not easier. ``picks``: ``skill, picks`` (array); ``difficulty``: ``id, raw, band``."""
    d = difficulty.select(F.col("id").alias("skill"), F.col("raw").alias("rs"), F.col("band").alias("bs"))
    c = difficulty.select(F.col("id").alias("pick"), F.col("raw").alias("rp"), F.col("band").alias("bp"))
    each = picks.join(d, "skill", "left").select("skill", "rs", "bs", F.explode_outer("picks").alias("pick")).join(c, "pick", "left")
    stale = F.col("rs").isNull() | (F.col("pick").isNotNull() & ~F.coalesce((F.col("rp") < F.col("rs")) | (F.col("bp") < F.col("bs")), F.lit(False)))
    return graded("picks are current and easier", each.groupBy("skill").agg(F.max(stale).alias("stale")).agg(share(F.col("stale")).alias("value")), 0, 1)


def lost_in_lift(edges: DataFrame, kept: DataFrame) -> DataFrame:
    return graded("under 10% of edges drop in the lift", _ratio(edges.select("dep", "pre").join(kept, ["dep", "pre"], "left_anti"), edges), 0.10, 1)


def inverted_seeds(seeds: DataFrame, bands: DataFrame) -> DataFrame:
    both = seeds.join(bands.select(F.col("id").alias("dep"), F.col("band").alias("bd")), "dep").join(bands.select(F.col("id").alias("pre"), F.col("band").alias("bp")), "pre")
    return graded("under 10% of seeds put the prerequisite higher", both.agg(share(F.col("bp") > F.col("bd")).alias("value")), 0.10, 1)


def surviving_seeds(seeds: DataFrame, known: DataFrame, skills: DataFrame) -> DataFrame:
    """Share of the seeds, subject areas aside, that the graph implies."""
    all_ = seeds.select("dep", "pre").join(subject_areas(seeds.select("dep", "pre"), skills), ["dep", "pre"], "left_anti")
    kept = all_.join(known.select("dep", F.col("anc").alias("pre")), ["dep", "pre"], "left_semi")
    return graded("at least 80% of seeds survive", _ratio(kept, all_), 0.8, 0)


def ordered_bands(edges: DataFrame, bands: DataFrame, known: DataFrame | None = None) -> DataFrame:
    if known is None:
        above = G.inverted_above(edges, bands)
    else:
        highest = known.join(bands.select(F.col("id").alias("anc"), F.col("band").alias("ba")), "anc").groupBy(F.col("dep").alias("id")).agg(F.max("ba").alias("highest"))
        above = bands.select("id", "band").join(highest, "id")
    above = above.join(edges.select(F.col("dep").alias("id")).distinct(), "id", "left_semi")
    return graded("at least 95% of skills are at or above all their prerequisites", above.agg(share(F.coalesce(F.col("highest") <= F.col("band"), F.lit(True))).alias("value")), 0.95, 0)


def isolated(skills: DataFrame, edges: DataFrame) -> DataFrame:
    used = edges.select(F.explode(F.array("dep", "pre")).alias("id")).distinct()
    return graded("under 20% of skills are isolated", _ratio(skills.select("id").join(used, "id", "left_anti"), skills), 0.2, 1)


def roots(skills: DataFrame, edges: DataFrame) -> DataFrame:
    """Skills that others need and that need none."""
    found = skills.select("id").join(edges.select(F.col("pre").alias("id")), "id", "left_semi").join(edges.select(F.col("dep").alias("id")), "id", "left_anti")
    return graded("under 20% of skills are roots", _ratio(found, skills), 0.2, 1)


def tau(measured: DataFrame) -> DataFrame:
    return graded("difficulty agrees with grades", measured.select(F.col("tau").alias("value")), 0.5, 0)


def far_from_anchor(measured: DataFrame) -> DataFrame:
    return graded("under 5% of anchored skills miss their band by more than 5", measured.select(F.col("share").alias("value")), 0.05, 1)


def conflicting_seeds(judged: DataFrame) -> DataFrame:
    """Share of seed pairs that do not fit the bands, ties of two anchors aside. ``judged``: ``kept, tie`` of each pair."""
    return graded("under 1% of seeds conflict with anchors", judged.agg(share(~F.col("kept") & ~F.col("tie")).alias("value")), 0.01, 1)


def conflict_samples(judged: DataFrame, most: int = 5) -> DataFrame:
    """``source, conflicts, samples``: the conflicts of each source and up to ``most`` of them, as ``pre(band) > dep(band)``.

    ``judged``: ``dep, pre, source, kept, tie, bp, bd, ap, ad``; a band without an
    anchor is marked by ``~``.
    """
    end = lambda c, p: F.concat(c, F.lit("("), F.when(F.col(f"a{p}"), "").otherwise("~"), F.col(f"b{p}").cast("string"), F.lit(")"))
    bad = judged.where("not kept and not tie").select("source", F.concat(end("pre", "p"), F.lit(" > "), end("dep", "d")).alias("s"))
    some = bad.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy("s"))).where(F.col("k") <= most).groupBy("source").agg(F.array_sort(F.collect_list("s")).alias("samples"))
    return bad.groupBy("source").agg(F.count("*").alias("conflicts")).join(some, "source")


def circular_seeds(seeds: DataFrame) -> DataFrame:
    scc = G.components(seeds)
    inside = seeds.select("dep", "pre").join(scc.select(F.col("id").alias("dep"), F.col("component").alias("c")), "dep").join(scc.select(F.col("id").alias("pre"), F.col("component").alias("c")), ["pre", "c"])
    return graded("under 1% of seeds are in a cycle", _ratio(inside, seeds), 0.01, 1)


def empty_titles(rows: DataFrame, key: Column, slug: Column) -> DataFrame:
    """Share of source titles without a key or, among the others, without a slug."""
    return graded("under 0.1% of titles drop for an empty key or slug", rows.agg(share((F.coalesce(key, F.lit("")) == "") | (F.coalesce(slug, F.lit("")) == "")).alias("value")), 0.001, 0.01)


def graded_rows(rows: DataFrame, source: str = "opensalt") -> DataFrame:
    """Share of a source's rows, of frameworks that grade any, that carry a grade. ``rows``: ``sources, tags`` as text."""
    grade = F.col("tags").rlike(r"(^|,)grade:")
    mine = rows.where(F.array_contains(F.split("sources", ","), source)).where(grade | ~F.col("tags").rlike(r"(^|,)opensalt:ungraded-framework(,|\z)"))
    return graded("at least 95% of framework skills carry a grade", mine.agg(share(grade).alias("value")), 0.95, 0)


def anomalous_hubs(skills: DataFrame, edges: DataFrame) -> DataFrame:
    n = skills.agg(F.count("*")).first()[0]
    worst = edges.where(F.col("pre").rlike(ANOMALOUS)).groupBy("pre").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("value"))
    return graded("no anomalous hub has over 200 dependents", worst, 200, max(n, 201))


def crossed_languages(edges: DataFrame) -> DataFrame:
    ld, lp = language_token(F.col("dep")), language_token(F.col("pre"))
    return graded("no language needs another", edges.agg(share(ld != lp).alias("value")), 0, 1)


def junk(skills: DataFrame, junk_topic) -> DataFrame:
    """Share of skills with a hashed id, a junk topic (``junk_topic`` judges one) or a hashed occupation."""
    bad = ((F.length("id") >= 70) & F.col("id").rlike(HASHED)) | F.exists("topics", junk_topic) | F.exists("occupations", lambda o: o.rlike(HASHED))
    return graded("no hashed id, junk topic or hashed occupation", skills.agg(share(bad).alias("value")), 0, 1)


def sane(expected: DataFrame, bands: DataFrame) -> DataFrame:
    """Share of the ``expected`` skills (``id, grade_from, grade_to``, kindergarten as K) whose band fits; an unknown id is an error."""
    from strandloom.operators.relational import assert_none

    assert_none(expected.join(bands, "id", "left_anti"), "an expected skill is no skill")
    band = lambda c: F.when(F.col(c) == "K", 0).otherwise(F.col(c).cast("int")) + 2
    return graded("at least 80% of the sanity skills are in their band", expected.join(bands.select("id", "band"), "id").agg(share(F.col("band").between(band("grade_from"), band("grade_to"))).alias("value")), 0.8, 0)


def areas_inside(skills: DataFrame, edges: DataFrame, least: int = 50) -> DataFrame:
    bad = subject_areas(edges.select("dep", "pre"), skills, least).select("dep").distinct()
    return graded("no subject area is inside itself", _ratio(bad, skills), 0, 1)


def implied(known: DataFrame, dep: str = "multiplication", pre: str = "addition") -> DataFrame:
    found = known.where((F.col("dep") == dep) & (F.col("anc") == pre))
    return graded(f"{pre} comes before {dep}", found.agg(F.least(F.count("*"), F.lit(1)).alias("value")), 1, 0)


def spot_checks(checks: DataFrame) -> DataFrame:
    """``checks``: a boolean ``ok`` for each."""
    return graded("spot checks pass", checks.agg(share(~F.coalesce("ok", F.lit(False))).alias("value")), 0, 1)


def known_spots(skills: DataFrame, edges: DataFrame) -> DataFrame:
    """The spot checks: tags that must be there, a pair of bands in order, and prerequisites that must not be."""
    # What is looked at.
    absent = [("describe-consequences-of-following-rules", "antisocial-personality-disorder"), ("distinguish-lumber-categories", "pack-fragile-items-for-transportation"), ("weigh-products-or-estimate-weight", "use-measures-of-dispersion")]
    has = lambda c, word: F.exists(c, lambda x: x.contains(word))
    tagged = [("javascript", has("occupations", "software-developer") | has("topics", "programming")), ("biology", has("occupations", "biologist") | has("topics", "biology"))]
    out = None
    for id, condition in tagged:
        row = skills.agg(F.coalesce(F.max((F.col("id") == id) & condition), F.lit(False)).alias("ok"))
        out = row if out is None else out.union(row)
    band = lambda id: F.min(F.when(F.col("id") == id, F.col("band")))
    out = out.union(skills.agg(F.coalesce(band("addition") <= band("calculus"), F.lit(False)).alias("ok")))
    for dep, pre in absent:
        out = out.union(edges.agg(~F.coalesce(F.max((F.col("dep") == dep) & (F.col("pre") == pre)), F.lit(False)).alias("ok")))
    return out


def clean_list(defects: DataFrame, rows: DataFrame) -> DataFrame:
    """``defects``: one row with a count of each kind."""
    total = sum((F.col(c) for c in defects.columns), F.lit(0))
    return graded("no list title has a defect", defects.select(total.alias("d")).crossJoin(rows.agg(F.count("*").alias("w"))).select(F.try_divide(F.col("d").cast("double"), F.col("w")).alias("value")), 0, 1)


def expert(who: str, scores: DataFrame) -> DataFrame:
    """Three conditions of ``graph.expert_scores``: enough positive pairs, precision and recall above their floors."""
    pos = graded(f"enough {who} pairs resolve", scores.select(F.col("positives").alias("value")), 3, 0)
    precision = graded(f"{who} edges are precise", scores.select(F.try_divide(F.col("hits").cast("double"), F.col("predicted")).alias("value")), 0.25, 0)
    recall = graded(f"{who} pairs are recovered", scores.select(F.try_divide(F.col("recovered").cast("double"), F.col("positives")).alias("value")), 0.05, 0)
    return pos.union(precision).union(recall)


def in_time(spark, began: float) -> DataFrame:
    """Seconds since ``began``: passes at 30, fails at 100."""
    return graded("the report ends in 30 seconds", spark.createDataFrame([(time.time() - began,)], "value double"), 30, 100)
