"""Entity resolution: candidate pairs by titles, rare words, codes and alignments, gated by cosine; and what a group inherits.

Candidates are ``a, b`` with the cosine that they must reach (``least``); a pair
that several rules find keeps the lowest. Vectors are ``id, vec`` of unit length
(see ``similarity.unit``); a pair whose end has no vector is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.similarity import dot

#: Cosines that pairs of one topic, of a rare word, of a code and of an alignment must reach.
TOPIC, RARE, CODE, ALIGNED = 0.96, 0.95, 0.90, 0.96
#: Rows of one code that one task pairs at once.
CHUNK = 2_000


def lowest(*rules: DataFrame) -> DataFrame:
    """``a, b, least`` of all rules, each unordered pair once."""
    out = None
    for r in rules:
        some = r.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "least")
        out = some if out is None else out.union(some)
    return out.groupBy("a", "b").agg(F.min("least").alias("least"))


def gated(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``a, b, cosine`` of the candidates that reach their cosine."""
    side = lambda s: vectors.select(F.col("id").alias(s), F.col("vec").alias(f"v{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "least", dot("va", "vb").alias("cosine"))
    return both.where("cosine >= least").select("a", "b", "cosine")


def topic_rule(pairs: DataFrame) -> DataFrame:
    """``similarity.bucket_pairs`` with their gate."""
    return pairs.select("a", "b", F.lit(TOPIC).alias("least"))


def rare_rule(pairs: DataFrame, sources: DataFrame, source: str = "csp") -> DataFrame:
    """``similarity.rare_word_pairs`` of which one end at least comes from the source, with their gate. ``sources``: ``id, sources`` (array)."""
    mine = sources.where(F.array_contains("sources", source)).select("id", F.lit(True).alias("mine"))
    both = pairs.join(mine.select(F.col("id").alias("a"), F.col("mine").alias("ma")), "a", "left").join(mine.select(F.col("id").alias("b"), F.col("mine").alias("mb")), "b", "left")
    return both.where("ma or mb").select("a", "b", F.lit(RARE).alias("least"))


def code_rule(rows: DataFrame, left: list[str] = ("learningcommons", "csp"), right: str = "opensalt") -> DataFrame:
    """Pairs that share a ``code:`` tag, one end from the sources ``left``, the other from ``right``. ``rows``: ``id, sources, tags`` (arrays).

    A code that very many rows carry is cut into chunks, each of which meets all
    rows of the other side.
    """
    each = rows.select("id", "sources", F.explode(F.array_distinct(F.filter("tags", lambda t: t.startswith("code:")))).alias("code"))
    a = each.where(F.arrays_overlap("sources", F.array(*map(F.lit, left)))).select("code", F.col("id").alias("a"))
    b = each.where(F.array_contains("sources", right)).select("code", F.col("id").alias("b"))
    chunks = a.groupBy("code").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    cut = a.join(chunks, "code").withColumn("chunk", F.pmod(F.xxhash64("a"), F.col("chunks")).cast("int")).drop("chunks")
    spread = b.join(chunks, "code").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    return cut.join(spread, ["code", "chunk"]).where("a <> b").select("a", "b", F.lit(CODE).alias("least")).distinct()


def alignment_rule(edges: DataFrame, skill_of: DataFrame) -> DataFrame:
    """Pairs of nodes that a graph aligns, as ids. ``edges``: ``rel, src, dst``; ``skill_of``: ``node, id``."""
    e = edges.where("rel = 'hasStandardAlignment'").join(skill_of.select(F.col("node").alias("src"), F.col("id").alias("a")), "src").join(skill_of.select(F.col("node").alias("dst"), F.col("id").alias("b")), "dst")
    return e.where("a <> b").select("a", "b", F.lit(ALIGNED).alias("least")).distinct()


def group_attributes(rows: DataFrame, alias: DataFrame, capped: list[str], whole: list[str], most: int = 3) -> DataFrame:
    """One row a group: ``id`` of the canonical row and the united lists of its members.

    ``rows``: ``id, ord`` and the list columns; ``alias``: ``dropped_id,
    canonical_id``. The canonical row's items come first, then the others' by
    ``ord``. Of the ``capped`` lists the first ``most`` stay; the ``whole`` ones are
    kept. Items are reduced before a group is put together.
    """
    to = alias.select(F.col("dropped_id").alias("id"), "canonical_id")
    base = rows.join(to, "id", "left").withColumn("head", F.coalesce("canonical_id", "id")).withColumn("late", (F.col("head") != F.col("id")).cast("int"))
    out = base.select(F.col("head").alias("id")).distinct()
    for c in [*capped, *whole]:
        items = base.select(F.col("head").alias("id"), "late", "ord", F.posexplode(c).alias("p", "item"))
        first = items.groupBy("id", "item").agg(F.min(F.struct("late", "ord", "p")).alias("at"))
        if c in capped:
            first = first.withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy("at", "item"))).where(F.col("k") <= most)
        lists = first.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]).alias(c))
        out = out.join(lists, "id", "left").withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    return out


def tree_topics(rows: DataFrame, first: DataFrame, second: DataFrame, junk, most: int = 3) -> DataFrame:
    """``id, topics`` for rows without a topic: the first ``most`` ancestors that are no junk, from the tree ``first``, or else ``second``.

    ``rows``: ``id, topics``; trees: ``slug, ancestors``, nearest first; ``junk``
    judges a label.
    """
    side = lambda t, n: t.select(F.col("slug").alias("id"), F.col("ancestors").alias(n))
    full = rows.join(side(first, "one"), "id", "left").join(side(second, "two"), "id", "left")
    found = F.slice(F.filter(F.coalesce("one", "two"), lambda t: ~junk(t)), 1, most)
    return full.select("id", F.when(F.size("topics") > 0, F.col("topics")).otherwise(F.coalesce(found, F.array().cast("array<string>"))).alias("topics"))


# --- tags ----------------------------------------------------------------------------------------

# Occupations that manage, a hash that ends an overlong slug.
MANAGES = r"-manager\z|-manager-|-director\z|-director-|-supervisor\z|-supervisor-"
HASHED = r"-[a-f0-9]{6}\z"


def scored_matches(pairs: DataFrame, items: DataFrame, refs: DataFrame, floor: float, k: int, times: int = 5) -> DataFrame:
    """``item, ref, score, rank``: of the pairs of ``relational.rare_token_matches`` those whose cosine reaches ``floor``, ``k * times`` an item.

    ``items``: ``item, vec``; ``refs``: ``ref, vec``, of unit length.
    """
    scored = pairs.join(items.select("item", F.col("vec").alias("x")), "item").join(refs.select("ref", F.col("vec").alias("y")), "ref").select("item", "ref", dot("x", "y").alias("score")).where(F.col("score") >= floor)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "ref"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k * times)


def without_occupations(id: Column, title: Column, grades: Column, sources: Column) -> Column:
    """Skills that get no occupation: school exercises, and those taught up to grade 8 only that no list of occupations has.

    ``grades``: difficulties of the grade tags (array).
    """
    exercise = id.rlike(r"^khan-|-khan-|-khan\z") | F.lower(title).startswith("khan")
    top = F.array_max(grades)
    return exercise | F.coalesce((top <= 9) & ~F.arrays_overlap(sources, F.array(F.lit("onet"), F.lit("esco"))), F.lit(False))


def picked_tags(matches: DataFrame, skills: DataFrame, kind: str, most: int) -> DataFrame:
    """``id, slug, score, rank``: the tags of a skill by the rules of their kind, ``occupation`` or ``topic``.

    ``matches``: ``id, slug, score``; ``skills``: ``id, title, grades, sources``. Of
    several matches of one slug the best counts. Occupations: none for skills
    that get none, no hashed slug, managers from a score of 0.95 on. Topics: a
    title of one or two words shares a word of four letters with its topic.
    """
    full = matches.where("slug <> ''").join(skills, "id")
    if kind == "occupation":
        full = full.where(~without_occupations(F.col("id"), F.col("title"), F.col("grades"), F.col("sources")) & ~F.col("slug").rlike(HASHED) & (~F.col("slug").rlike(MANAGES) | (F.col("score") >= 0.95)))
    else:
        from strandloom.functions.text import slugify

        words = F.size(F.filter(F.split("title", r"\s+"), lambda w: F.length(w) > 1))
        long = lambda c: F.filter(F.split(c, "-"), lambda w: F.length(w) >= 4)
        full = full.where((words > 2) | F.arrays_overlap(long(slugify("title")), long(F.col("slug"))))
    best = full.groupBy("id", "slug").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "slug"))
    return best.withColumn("rank", rank).where(F.col("rank") <= most)


# --- vectors of texts ----------------------------------------------------------------------------


def content(title: Column, description: Column, tags: Column, least: int = 40) -> Column:
    """The text that a vector is made of: title and description; one of fewer than ``least`` characters is padded with its tags, or with its title again."""
    said = F.coalesce(description, F.lit(""))
    base = F.when(said != "", F.concat(title, F.lit("\n"), said)).otherwise(title)
    hint = F.substring(F.regexp_replace(F.coalesce(tags, F.lit("")), ",", " "), 1, 300)
    return F.when(F.length(base) >= least, base).when(hint != "", F.concat(base, F.lit(". "), hint)).otherwise(F.concat(base, F.lit(". Skill: "), title, F.lit(". "), title, F.lit(".")))


def retry_content(title: Column, description: Column, tags: Column) -> Column:
    """A longer text for rows whose vectors fell together."""
    hint = F.substring(F.regexp_replace(F.coalesce(tags, F.lit("")), ",", " "), 1, 400)
    said = F.coalesce(description, F.lit(""))
    return F.concat(F.lit("Skill: "), title, F.lit("."), F.when(said != "", F.concat(F.lit(" "), said)).otherwise(""), F.lit(" Context: "), F.when(hint != "", hint).otherwise(title), F.lit(". Topic: "), title, F.lit("."))


def collapsed(vectors: DataFrame, least: int = 5) -> DataFrame:
    """``id`` of rows whose signature more than ``least`` rows share: to be retried, or, after that, pathological. ``vectors``: ``id, signature``."""
    many = vectors.groupBy("signature").agg(F.count("*").alias("n")).where(F.col("n") > least).select("signature")
    return vectors.join(many, "signature", "left_semi").select("id")


def assert_finite(vectors: DataFrame, vector: str) -> None:
    """An error if a vector has a number that is null or not finite, or no direction."""
    from strandloom.operators.relational import assert_none

    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(v, lambda x: x != 0)
    assert_none(vectors.where(v.isNull() | F.coalesce(bad, F.lit(True))), "expected finite vectors with a direction")
