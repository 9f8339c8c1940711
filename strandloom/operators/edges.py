"""The edge chain: from picked and named prerequisites to a reduced graph without cycles.

Row-local rules are one projection, each edge with the first rule that drops
it; seeds are exempt. What follows looks at more than one edge: caps of hubs,
edges for orphans, trimming across domains, seeds, subject areas, cycles,
reduction, in this order.

``skills``: ``id, raw, band, anchored, tags`` (text), ``topics`` (array), ``ord``.
Edges are ``dep, pre``. Null ends and self-edges are left out, repeats count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions import text as X
from strandloom.operators import folds as O
from strandloom.operators import graph as G
from strandloom.operators import relational as R
from strandloom.operators.candidates import level_inverted, tool_rule
from strandloom.runtime import Scratch

# Leaves that name a holiday or a trait, tokens that name a language, prerequisites of every domain.
LEAVES = r"retell-stories-related-to-.*-day|customs-around-.*-day|-national-independence-day|classify-character-traits-and-their-influence|understand-object-naming-and-naming-conventions"
LANGUAGE_TOKENS = ["spanish", "french", "german", "italian", "portuguese", "chinese", "japanese", "greek", "latin", "arabic", "korean", "russian", "hebrew", "swazi", "kanuri", "pulaar"]
EVERY_DOMAIN = [
    "mathematics", "math", "arithmetic", "reading", "writing", "reading-comprehension", "written-expression", "active-listening", "speaking", "problem-solving", "critical-thinking", "complex-problem-solving",
    "deductive-reasoning", "inductive-reasoning", "active-learning", "learning-strategies",
]
#: How much easier in raw value a prerequisite of the same band must be.
EPSILON = 0.05
TOOL = "onet:tech"


def language_token(id: Column) -> Column:
    """The first of the language tokens, in their order, that is a whole word of an id."""
    words = F.split(id, "-")
    return F.coalesce(*(F.when(F.array_contains(words, t), F.lit(t)) for t in LANGUAGE_TOKENS))


def significant(id: Column) -> Column:
    return F.array_distinct(F.filter(F.split(id, "-"), lambda w: (F.length(w) >= 3) & ~w.isin(X.SIGNATURE_STOP)))


def _pairs(df: DataFrame) -> DataFrame:
    return df.select("dep", "pre").where("dep is not null and pre is not null and dep <> pre").distinct()


def united(picks: DataFrame, names: DataFrame, snap: DataFrame, alias: DataFrame, lost: float = 0.05) -> DataFrame:
    """``dep, pre, named``: picked edges and those that a name stands for.

    ``picks``: ``dep, pre``; ``names``: ``dep, name``; ``snap``: ``name`` (slug),
    ``match`` (id, or null for none). A name that has no answer at all is lost;
    more than the share ``lost`` of them is an error.
    """
    asked = names.where("dep is not null and name is not null").select("dep", X.slugify("name").alias("name")).join(snap.select("name", "match", F.lit(True).alias("known")).dropDuplicates(["name"]), "name", "left")
    asked = Scratch(picks.sparkSession, "named").save(asked, "named")
    seen = asked.agg(F.count("*").alias("n"), F.count_if(F.col("known").isNull()).alias("lost")).first()
    if seen.lost > lost * seen.n:
        raise ValueError(f"expected an answer for {1 - lost:.0%} of {seen.n} names, received none for {seen.lost}")
    ends = lambda df: R.remap(df, alias, ["dep", "pre"])
    named = _pairs(ends(asked.where("match is not null").select("dep", F.col("match").alias("pre"))))
    return _pairs(ends(picks)).union(named).distinct().join(named.withColumn("named", F.lit(True)), ["dep", "pre"], "left").withColumn("named", F.coalesce("named", F.lit(False)))


def with_ends(edges: DataFrame, skills: DataFrame) -> DataFrame:
    """Edges with what the rules need of both ends; an end that is no skill leaves the edge out."""
    fields = ["raw", "band", "anchored", "tags", "topics"]
    side = lambda end, p: skills.select(F.col("id").alias(end), *(F.col(f).alias(f"{p}_{f}") for f in fields))
    return edges.join(side("dep", "d"), "dep").join(side("pre", "p"), "pre")


def reasons(full: DataFrame) -> DataFrame:
    """``full`` (see ``with_ends``, with ``seed, named``) with ``reason``: the first rule that drops an edge, or null.

    A named prerequisite of a dependent without an anchor may be harder.
    """
    words = lambda c: F.size(F.filter(F.split(c, "-"), lambda w: F.length(w) >= 2))
    ld, lp = language_token(F.col("dep")), language_token(F.col("pre"))
    wd, wp = significant(F.col("dep")), significant(F.col("pre"))
    liftable = F.col("named") & ~F.col("d_anchored")
    empty = F.array().cast("array<string>")
    tool = lambda p: F.coalesce(F.col(f"{p}_tags").contains(TOOL), F.lit(False))
    tags = lambda p: F.coalesce(F.col(f"{p}_tags"), F.lit(""))
    rules = [
        (F.col("pre").rlike(LEAVES), "leaf"),
        (ld.isNotNull() & lp.isNotNull() & (ld != lp), "language"),
        (level_inverted(tags("d"), tags("p")), "level"),
        ((F.col("p_band") > F.col("d_band")) & ~liftable, "band"),
        ((F.col("p_raw") > F.col("d_raw") - EPSILON) & (F.col("p_band") >= F.col("d_band")) & ~liftable, "raw"),
        ((words(F.col("dep")) <= 2) & (words(F.col("pre")) > words(F.col("dep")) + 1), "specific"),
        ((F.size(wp) >= 2) & (F.size(wd) > F.size(wp)) & (F.size(F.array_except(wp, wd)) == 0), "hypernym"),
        (~tool_rule(F.lit(False), tool("d"), tool("p"), F.col("d_raw") - F.col("p_raw"), F.array_contains(F.coalesce("d_topics", empty), F.col("pre"))), "tool"),
    ]
    why = F.coalesce(*(F.when(c, F.lit(name)) for c, name in rules))
    return full.withColumn("reason", F.when(~F.col("seed"), why))


def trimmed(edges: DataFrame, skills: DataFrame, common: int = 300) -> DataFrame:
    """``dep, pre`` without those across domains: neither a topic nor a word in common, both ends with two topics or more.

    ``edges``: ``dep, pre, seed, ord``. Seeds and prerequisites of every domain
    stay. Edges go from the last in order on, and a dependent keeps its last one.
    """
    empty = F.array().cast("array<string>")
    topics = skills.select("id", F.coalesce("topics", empty).alias("topics"))
    tokens = skills.select("id", F.explode(F.array_distinct(F.split("id", "-"))).alias("w"))
    often = tokens.where("length(w) >= 5").groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") > common).select("w")
    own = tokens.where("length(w) >= 4").join(often, "w", "left_anti").groupBy("id").agg(F.collect_set("w").alias("words"))
    facts = topics.join(own, "id", "left").select("id", "topics", F.coalesce("words", empty).alias("words"))
    full = edges.join(facts.select(F.col("id").alias("dep"), F.col("topics").alias("td"), F.col("words").alias("wd")), "dep").join(facts.select(F.col("id").alias("pre"), F.col("topics").alias("tp"), F.col("words").alias("wp")), "pre")
    apart = (F.size("td") >= 2) & (F.size("tp") >= 2) & ~F.arrays_overlap("td", "tp") & ~F.arrays_overlap("wd", "wp")
    full = full.withColumn("out", apart & ~F.col("seed") & ~F.col("pre").isin(EVERY_DOMAIN))
    n = F.count("*").over(Window.partitionBy("dep"))
    rank = F.sum(F.col("out").cast("int")).over(Window.partitionBy("dep").orderBy(F.desc("ord"), F.desc("pre")))
    return full.withColumn("n", n).withColumn("r", rank).where("not out or r > n - 1").select("dep", "pre")


def with_seeds(edges: DataFrame, seeds: DataFrame, skills: DataFrame, courses: str = "courses") -> DataFrame:
    """Edges and all seeds between skills; a course's seed whose prerequisite is in a higher band is left out, unless another source has it."""
    known = skills.select("id", "band")
    s = seeds.select("dep", "pre", "source").where("dep <> pre").join(known.select(F.col("id").alias("dep"), F.col("band").alias("bd")), "dep").join(known.select(F.col("id").alias("pre"), F.col("band").alias("bp")), "pre")
    s = s.groupBy("dep", "pre").agg(F.max(F.col("source") != courses).alias("expert"), F.first("bd").alias("bd"), F.first("bp").alias("bp"))
    return _pairs(edges.select("dep", "pre").union(s.where("expert or bp <= bd").select("dep", "pre")))


def subject_areas(edges: DataFrame, skills: DataFrame, least: int = 50) -> DataFrame:
    """Edges whose prerequisite is a topic of its dependent and of ``least`` skills or more."""
    topics = skills.select("id", F.explode(F.array_distinct("topics")).alias("topic")).where("topic <> ''").distinct()
    areas = topics.groupBy("topic").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("topic")
    inside = topics.join(areas, "topic", "left_semi").select(F.col("id").alias("dep"), F.col("topic").alias("pre"))
    return edges.join(inside, ["dep", "pre"], "left_semi")


class EdgeChain:
    """``judged``: every edge with its ``reason``; ``final``: ``dep, pre`` of the finished graph; ``steps``: edges after each step."""

    def __init__(self, edges: DataFrame, skills: DataFrame, seeds: DataFrame, per_topic: int = 30, overall: int = 150, technical: int = 15, uses: int = 15, gap: float = 4.0, area: int = 50):
        """``edges``: ``dep, pre, named``; ``seeds``: ``dep, pre, source``."""
        scratch = Scratch(edges.sparkSession, "chain")
        skills = scratch.save(skills.select("id", F.col("raw").cast("double").alias("raw"), "band", F.coalesce("anchored", F.lit(False)).alias("anchored"), "tags", F.coalesce("topics", F.array().cast("array<string>")).alias("topics"), "ord"), "skills")
        keys = scratch.save(seeds.select("dep", "pre").distinct().withColumn("seed", F.lit(True)), "seeds")
        marked = edges.where("dep is not null and pre is not null and dep <> pre").groupBy("dep", "pre").agg(F.max("named").alias("named")).join(keys, ["dep", "pre"], "left").withColumn("seed", F.coalesce("seed", F.lit(False)))
        full = scratch.save(reasons(with_ends(marked, skills)), "judged")
        self.judged = full.select("dep", "pre", "seed", "named", "reason")
        kept = full.where("reason is null")
        tool = F.coalesce(F.col("p_tags").contains(TOOL), F.lit(False))
        capped = O.hub_caps(kept.select("dep", "pre", F.abs(F.col("d_raw") - F.col("p_raw")).alias("gap"), "seed", tool.alias("tech"), F.col("d_topics").alias("topics")), per_topic, overall, technical)
        capped = scratch.save(capped, "capped")
        lonely = skills.join(capped.select(F.col("dep").alias("id")).distinct(), "id", "left_anti").select("id", "raw", "ord")
        orphans = O.orphan_prerequisites(lonely, skills.select("id", "raw", F.coalesce(F.col("tags").contains(TOOL), F.lit(False)).alias("tech")), gap, uses)
        orphans = scratch.save(orphans, "orphans")
        both = capped.withColumn("ord", F.lit(0)).union(orphans.withColumn("ord", F.lit(1))).join(keys, ["dep", "pre"], "left").withColumn("seed", F.coalesce("seed", F.lit(False)))
        cut = scratch.save(trimmed(both, skills), "trimmed")
        seeded = scratch.save(with_seeds(cut, seeds, skills), "seeded")
        plain = scratch.save(seeded.join(subject_areas(seeded, skills, area), ["dep", "pre"], "left_anti"), "plain")
        ordered = scratch.save(G.break_cycles(plain, skills.select("id", "raw"), keys), "acyclic")
        self.final = scratch.save(G.transitive_reduction(ordered), "final")
        named = [("judged", self.judged), ("kept", kept), ("capped", capped), ("orphans", orphans), ("trimmed", cut), ("seeded", seeded), ("subject areas", plain), ("acyclic", ordered), ("reduced", self.final)]
        self.steps = None
        for k, (name, df) in enumerate(named):
            row = df.agg(F.count("*").alias("n_edges")).select(F.lit(k).alias("step"), F.lit(name).alias("name"), "n_edges")
            self.steps = row if self.steps is None else self.steps.union(row)
