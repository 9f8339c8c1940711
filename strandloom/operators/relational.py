"""Merging, ranking, resolving and voting: the relational operators.

Rows that are "first" are first by an explicit order column, never by their
place in a partition. Nulls in a key group together unless stated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions import text as X
from strandloom.runtime import Scratch


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. A rank limit runs before the shuffle, so hot keys send one row per task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows of each key, with their ``rank``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def merge_by_key(df: DataFrame, key: str, order: str, lists: dict[str, int | None], longest: list[str], firsts: list[str]) -> DataFrame:
    """One row per key: unions of list columns in order, the longest text, the values of the first row.

    ``lists`` maps a column of comma-joined items to its cap, or None. The first
    row keeps all its items; a cap only stops items of later rows. A key of
    very many rows is reduced item by item first, so no list of rows is built.
    Rows with a null or empty key are left out.
    """
    rows = df.where(F.col(key).isNotNull() & (F.col(key) != ""))
    # the longest text of a key, the earliest of equals
    best = [F.max(F.struct(F.length(F.coalesce(F.col(c), F.lit(""))).alias("n"), (-F.col(order)).alias("o"), F.col(c).alias("v"))).alias(f"_{c}") for c in longest]
    head = [F.min(F.struct(order, c)).getField(c).alias(c) for c in firsts]
    out = rows.groupBy(key).agg(F.min(order).alias(order), F.count("*").alias("n_rows"), *head, *best)
    for c in longest:
        out = out.withColumn(c, F.col(f"_{c}.v")).drop(f"_{c}")
    for c, cap in lists.items():
        items = rows.select(key, order, F.posexplode(F.split(F.coalesce(F.col(c), F.lit("")), ",")).alias("_pos", "_item")).where("_item <> ''")
        seen = items.groupBy(key, "_item").agg(F.min(F.struct(order, "_pos")).alias("_at"))
        place = Window.partitionBy(key).orderBy("_at")
        seen = seen.withColumn("_rank", F.row_number().over(place))
        if cap is not None:
            seen = seen.withColumn("_head", F.min(F.col(f"_at.{order}")).over(Window.partitionBy(key)))
            seen = seen.where((F.col("_rank") <= cap) | (F.col(f"_at.{order}") == F.col("_head")))
        joined = seen.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_rank", "_item"))), lambda x: x["_item"]), ",").alias(c))
        out = out.join(joined, key, "left").withColumn(c, F.coalesce(F.col(c), F.lit("")))
    return out


def suffix_collisions(df: DataFrame, slug: str, order: str) -> DataFrame:
    """Slugs made unique: the second row of a slug gets ``-2`` and so on, within 80 characters."""
    k = F.row_number().over(Window.partitionBy(slug).orderBy(order))
    end = F.concat(F.lit("-"), F.col("_k").cast("string"))
    short = F.regexp_replace(F.substring(F.col(slug), F.lit(1), F.lit(X.SLUG_LENGTH) - F.length(end)), "-$", "")
    return df.withColumn("_k", k).withColumn(slug, F.when(F.col("_k") > 1, F.concat(short, end)).otherwise(F.col(slug))).drop("_k")


def resolve_concepts(labels: DataFrame, skills: DataFrame) -> DataFrame:
    """``label, id, rule``: each label's skill, by the first rule that finds one; null if none does.

    Rules in order: equal title, slug equal to an id, slug of a title, the same
    two with the label's asides kept, folded title if no two skills share it.
    ``skills`` has ``id, title, ord``; the first by ``ord`` wins.
    """
    base = skills.select("id", "title", "ord")
    title = F.lower(X.trim("title"))
    by_title = base.select(title.alias("k"), "ord", "id").where("k <> ''").groupBy("k").agg(F.min(F.struct("ord", "id")).getField("id").alias("by_title"))
    by_id = base.select(F.col("id").alias("k")).where("id is not null").distinct().withColumn("by_id", F.col("k"))
    by_slug = base.select(X.slugify("title").alias("k"), "ord", "id").where("k <> ''").groupBy("k").agg(F.min(F.struct("ord", "id")).getField("id").alias("by_slug"))
    by_fold = base.select(X.fold_key("title").alias("k"), "id").where("k <> ''").groupBy("k").agg(F.min("id").alias("by_fold"), F.max("id").alias("hi")).where("by_fold = hi").drop("hi")
    out = labels.select("label").distinct().where("label is not null")
    out = out.withColumn("clean", X.plain_label("label")).withColumn("low", F.lower("clean")).withColumn("slug", X.slugify("clean")).withColumn("raw", X.slugify(F.translate("label", "_", " "))).withColumn("fold", X.fold_key("clean"))
    look = lambda df, at, name, new: df.join(name.withColumnsRenamed({"k": at, name.columns[1]: new}), at, "left")
    out = look(out, "low", by_title, "r1")
    out = look(look(out, "slug", by_id, "r2"), "slug", by_slug, "r3")
    out = look(look(out, "raw", by_id, "r4"), "raw", by_slug, "r5")
    out = look(out, "fold", by_fold, "r6")
    rules = [("r1", "title"), ("r2", "id"), ("r3", "slug"), ("r4", "raw id"), ("r5", "raw slug"), ("r6", "fold")]
    hit = F.col("clean") != ""
    rule = F.coalesce(*(F.when(F.col(c).isNotNull(), F.lit(name)) for c, name in rules))
    return out.select("label", F.when(hit, F.coalesce(*(F.col(c) for c, _ in rules))).alias("id"), F.when(hit, rule).alias("rule"))


def majority_votes(votes: DataFrame, a: str, b: str, voter: str) -> DataFrame:
    """``a, b, votes, against, verdict``: each ordered pair by its number of voters against the reverse pair's.

    ``verdict`` is ``kept`` for a majority, ``minority`` for the fewer, and
    ``tie`` for both of an even pair. Pairs of one end are left out.
    """
    n = votes.where(F.col(a) != F.col(b)).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.countDistinct(voter).alias("votes"))
    back = n.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("votes").alias("against"))
    both = n.join(back, ["a", "b"], "left").withColumn("against", F.coalesce("against", F.lit(0)))
    verdict = F.when(F.col("votes") > F.col("against"), "kept").when(F.col("votes") == F.col("against"), "tie").otherwise("minority")
    return both.withColumn("verdict", verdict)


def contested(pairs: DataFrame, a: str, b: str, source: str) -> DataFrame:
    """Pairs that one source claims both ways, smaller end first."""
    p = pairs.select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(source).alias("source")).distinct().where("a is not null and b is not null and a <> b")
    one = p.where("a < b")
    other = p.where("a > b").select(F.col("b").alias("a"), F.col("a").alias("b"), "source")
    return one.intersect(other)


def remap(edges: DataFrame, alias: DataFrame, ends: list[str], strict: bool = False) -> DataFrame:
    """Both ends of edges through ``dropped_id, canonical_id``; edges whose ends fall together vanish, or are an error if ``strict``."""
    out = edges
    for end in ends:
        out = out.join(alias.select(F.col("dropped_id").alias(end), F.col("canonical_id").alias("_to")), end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
    if strict:
        assert_none(out.where(F.col(ends[0]) == F.col(ends[1])), "expected two ends, received an edge that aliases to one")
    return out.select(edges.columns).where(F.col(ends[0]) != F.col(ends[1])).dropDuplicates(ends)


def assert_none(df: DataFrame, what: str) -> None:
    """Raise with an example if the frame of violations has a row."""
    bad = df.limit(1).collect()
    if bad:
        raise ValueError(f"{what}, for example {bad[0].asDict()}")


def cap_by_frequency(df: DataFrame, key: str, order: list[Column | str], cap: int) -> DataFrame:
    """At most ``cap`` rows of each key, by rank."""
    return top_per_key(df, [key], order, cap).drop("rank")


def rare_token_matches(items: DataFrame, refs: DataFrame, common: Column) -> DataFrame:
    """``item, ref, shared``: pairs that share a rare word, or two words.

    ``items`` has ``item, words``, ``refs`` has ``ref, words``. ``common`` is a
    condition on ``df``, the number of references that have a word. Pairs meet on
    a rare word, or on two common words at once; no common word is ever joined
    by itself.
    """
    scratch = Scratch(items.sparkSession, "tokens")
    df = refs.select("ref", F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    words = scratch.save(df.select("w", common.alias("common")), "words")

    def sides(rows: DataFrame, id: str) -> DataFrame:
        each = rows.select(id, F.explode(F.array_distinct("words")).alias("w")).distinct().join(words, "w")
        return scratch.save(each.groupBy(id).agg(F.array_sort(F.collect_list("w")).alias("all"), F.collect_list(F.when(~F.col("common"), F.col("w"))).alias("rare"), F.array_sort(F.collect_list(F.when(F.col("common"), F.col("w")))).alias("often")), id)

    a, b = sides(items, "item"), sides(refs, "ref")
    # every two words of a sorted list, as keys
    two = F.flatten(F.transform("often", lambda x, i: F.transform(F.slice("often", i + 2, F.size("often")), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    by_rare = a.select("item", F.explode("rare").alias("k")).join(b.select("ref", F.explode("rare").alias("k")), "k").select("item", "ref")
    by_two = a.select("item", F.explode(two).alias("k")).join(b.select("ref", F.explode(two).alias("k")), "k").select("item", "ref")
    met = by_rare.union(by_two).distinct()
    both = met.join(a.select("item", F.col("all").alias("wa")), "item").join(b.select("ref", F.col("all").alias("wb")), "ref")
    return both.select("item", "ref", F.size(F.array_intersect("wa", "wb")).cast("long").alias("shared"))
