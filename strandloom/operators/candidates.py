"""Candidate prerequisites of a skill: guards, pools, slots."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.blocks import Guard, Names, Words, count_overlaps, flags, numbers
from strandloom.operators.lists_index import ListIndex
from strandloom.runtime import BROADCAST_ROWS, Scratch


def easier(pre_raw: Column, pre_band: Column, raw: Column, band: Column) -> Column:
    """A prerequisite is easier if its raw value or its band is lower."""
    return (pre_raw < raw) | (pre_band < band)


def levels(tags: Column) -> Column:
    """Apprenticeship levels that a comma-joined tag list names."""
    return F.transform(F.regexp_extract_all(tags, F.lit(r"(?:^|,)skillsengland:level:(\d)"), 1), lambda x: x.cast("int"))


def level_inverted(dep_tags: Column, pre_tags: Column) -> Column:
    """The lowest level of a prerequisite is above the highest of its dependent, both known."""
    d, p = levels(dep_tags), levels(pre_tags)
    return (F.size(d) > 0) & (F.size(p) > 0) & (F.array_min(p) > F.array_max(d))


def grade_gap(dep_start: Column, pre_end: Column) -> Column:
    """A skill of grade 7 or later with a candidate that ends at grade 3 or before."""
    return F.coalesce((dep_start >= 7) & (pre_end <= 3), F.lit(False))


def tool_rule(seed: Column, dep_tool: Column, pre_tool: Column, gap: Column, is_topic: Column) -> Column:
    """Whether an edge to a tool stays: a seed, between tools a raw gap of 2 or more, else only a topic of its dependent."""
    return seed | ~pre_tool | F.when(dep_tool, gap >= 2.0).otherwise(is_topic)


# Skills about studying itself; topics that name a framework; tokens of fewer letters link unrelated ids.
STUDY = r"(?i)^(take[- ]notes?|mental[- ]concentration|find[- ]a[- ]dedicated|test[- ]anxiety|time[- ]management|study[- ]space|ask[- ]for[- ]help)"
FRAME = r"-standards|^sced-|-\d{4}|framework|curriculum|scope-and-sequence"
TOKEN = 7


def _long_tokens(c: Column) -> Column:
    return F.filter(F.split(c, "-"), lambda t: F.length(t) >= TOKEN)


def profiles(skills: DataFrame, language, foundations: list[str] = ()) -> DataFrame:
    """What the guards need of a skill.

    ``skills``: ``id, raw, band, start, end, topics, occupations, sources``
    (arrays), ``tags`` (text), ``pathological`` (boolean). ``language`` gives the
    language that an id names.
    """
    none = F.array().cast("array<string>")
    topics = F.coalesce("topics", none)
    tokens = F.transform(topics, lambda t: F.filter(F.split(t, "-"), lambda w: F.length(w) >= TOKEN))
    return skills.select(
        "id", "raw", "band", "start", "end", topics.alias("topics"), F.coalesce("occupations", none).alias("occupations"), F.coalesce("sources", none).alias("sources"), F.coalesce("tags", F.lit("")).alias("tags"),
        F.coalesce("pathological", F.lit(False)).alias("pathological"), language(F.col("id")).alias("language"), F.col("id").rlike(STUDY).alias("study"), F.col("id").isin(list(foundations)).alias("foundation"),
        (F.coalesce("tags", F.lit("")).contains("sced:catalog") & ~F.arrays_overlap(F.coalesce("sources", none), F.array(*map(F.lit, ("esco", "onet", "lightcast"))))).alias("catalogue"),
        F.array_min(levels(F.coalesce("tags", F.lit("")))).alias("lowest_level"), F.array_max(levels(F.coalesce("tags", F.lit("")))).alias("highest_level"), _long_tokens(F.col("id")).alias("id_tokens"), tokens.alias("topic_tokens"), F.forall(topics, lambda t: t.rlike(FRAME)).alias("framework_only"),
    )


def admissible(d: str, c: str) -> Column:
    """Whether the profile ``c`` may be a prerequisite of the profile ``d`` (struct columns): the guard of every pool."""
    at = lambda s, name: F.col(f"{s}.{name}")
    same_language = F.coalesce(at(c, "language") == at(d, "language"), F.lit(True))
    fine = ~at(c, "pathological") & ~at(c, "catalogue") & (~at(c, "study") | at(d, "study")) & same_language
    return (at(c, "id") != at(d, "id")) & fine & ~grade_gap(at(d, "start"), at(c, "end")) & ~F.coalesce(at(c, "lowest_level") > at(d, "highest_level"), F.lit(False)) & easier(at(c, "raw"), at(c, "band"), at(d, "raw"), at(d, "band"))


def akin(d: str, c: str) -> Column:
    """Inside a topic: a foundation, a shared occupation, or a long token of a topic of ``d`` in the id or a topic of ``c``."""
    own = F.flatten(F.col(f"{d}.topic_tokens"))
    return F.col(f"{c}.foundation") | F.arrays_overlap(f"{c}.occupations", f"{d}.occupations") | F.arrays_overlap(own, F.concat(F.col(f"{c}.id_tokens"), F.flatten(F.col(f"{c}.topic_tokens"))))


def across(d: str, c: str) -> Column:
    """Between topics: not only frameworks for topics, and a shared occupation or two topics that hold a long token of ``d``'s."""
    own = F.flatten(F.col(f"{d}.topic_tokens"))
    sharing = F.size(F.filter(F.col(f"{c}.topic_tokens"), lambda t: F.arrays_overlap(t, own)))
    return ~F.col(f"{c}.framework_only") & (F.arrays_overlap(f"{c}.occupations", f"{d}.occupations") | (sharing >= 2))


class SlotGuard(Guard):
    """``admissible`` and the condition of a pool over blocks of profiles; with ``free``, candidates in ``taken`` are left out.

    Pools are ``inside`` (a topic in common, and ``akin``), ``wide`` (no more than
    ``admissible``) and ``far`` (a long token of topics in common, and ``across``).
    """

    asks = ["name", "raw", "band", "start", "study", "language", "highest_level", "topics", "occupations", "own_tokens", "taken"]
    has = ["name", "raw", "band", "end", "barred", "study", "language", "lowest_level", "foundation", "framework_only", "topics", "occupations", "id_tokens", "topic_tokens"]

    def __init__(self, pool: str, free: bool):
        self.pool, self.free = pool, free

    @classmethod
    def columns(cls, profiled: DataFrame) -> DataFrame:
        """``key`` and what is read here of a skill that asks and of a candidate. A pathological candidate or a mere catalogue entry is barred."""
        barred = F.coalesce(F.col("pathological") | F.col("catalogue"), F.lit(True))
        df = profiled.withColumnRenamed("id", "name").withColumns({"barred": barred, "own_tokens": F.flatten("topic_tokens")})
        return df.select("key", *dict.fromkeys([*cls.asks[:-1], *cls.has]))

    def hold(self, queries):
        at = lambda c: queries[c].combine_chunks()
        self.names, self.languages, self.study = Names(at("name")), Names(at("language")), flags(at("study"))
        self.raw, self.band, self.start, self.highest = (numbers(at(c)) for c in ("raw", "band", "start", "highest_level"))
        self.topics, self.occupations, self.tokens, self.taken = (Words(at(c)) for c in ("topics", "occupations", "own_tokens", "taken"))

    def see(self, rows):
        return _Candidates(self, rows)

    def plain(self, seen, q, x):
        language, own = seen.language[x], self.languages.codes[q]
        ok = ~seen.barred[x] & (seen.name[x] != self.names.codes[q]) & (~seen.study[x] | self.study[q]) & ((language == -1) | (own == -1) | (language == own))
        ok &= ~((self.start[q] >= 7) & (seen.end[x] <= 3)) & ~(seen.lowest[x] > self.highest[q])
        return ok & easier(seen.raw[x], seen.band[x], self.raw[q], self.band[q])

    def sets(self, seen, block):
        return seen.judge(block)


class _Candidates:
    """A slice of candidates, as a guard sees them."""

    def __init__(self, guard: SlotGuard, rows):
        self.guard, at = guard, rows.column
        self.name, self.language, self.study, self.barred = guard.names.of(at("name")), guard.languages.of(at("language")), flags(at("study")), flags(at("barred"))
        self.raw, self.band, self.end, self.lowest = (numbers(at(c)) for c in ("raw", "band", "end", "lowest_level"))
        self.foundation, self.bare = flags(at("foundation")), flags(at("framework_only").fill_null(True))
        self.taken = guard.taken.one(at("name"))
        self.topics, self.occupations = guard.topics.of(at("topics")), guard.occupations.of(at("occupations"))
        self.tokens, self.ends = guard.tokens.each(at("topic_tokens"))
        self.id_tokens = guard.tokens.of(at("id_tokens"))

    def judge(self, block: np.ndarray):
        """The condition on sets, for pairs of a query of the block and a candidate."""
        guard, parts = self.guard, (self.taken, self.topics, self.occupations, self.tokens, self.id_tokens)
        for part in parts:
            part.asked_by(block)

        def inside(i, j):
            out = self.topics.overlap(i, j)
            i, j = i[out], j[out]
            out[out] = self.foundation[j] | self.occupations.overlap(i, j) | self.id_tokens.overlap(i, j) | (count_overlaps(self.tokens, self.ends, i, j) > 0)
            return out

        def far(i, j):
            sharing = count_overlaps(self.tokens, self.ends, i, j)
            return ~self.bare[j] & ((sharing >= 2) | (sharing == 1) & self.occupations.overlap(i, j))

        def ok(i, j):
            out = {"inside": inside, "far": far}[guard.pool](i, j) if guard.pool != "wide" else np.ones(len(i), bool)
            return out & ~self.taken.overlap(i, j) if guard.free else out

        return ok


def upper_fifth(skills: DataFrame) -> float:
    """The raw value that a fifth of all rows reach: the element at place ``floor(0.8 n)`` in order, exactly.

    Two estimates bracket it; only the values between them are put in order.
    """
    rows = skills.select(F.col("raw").cast("double").alias("raw")).where("raw is not null")
    n = rows.count()
    if not n:
        return float("inf")
    low, high = rows.approxQuantile("raw", [0.79, 0.81], 0.005)
    below = rows.where(F.col("raw") < low).count()
    values = rows.where(F.col("raw").between(low, high)).groupBy("raw").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.orderBy("raw"))
    return values.withColumn("upto", upto + below).where(F.col("upto") > int(n * 0.8)).agg(F.min("raw")).first()[0]


#: What ``admissible`` looks at.
GUARDED = ["id", "raw", "band", "start", "end", "pathological", "catalogue", "study", "language", "lowest_level", "highest_level"]


def topic_candidates(profiled: DataFrame, per_skill: int = 5, least_gap: float = 2.0, relaxed_gap: float = 0.1, relaxed: Column | None = None, window: int = 32) -> DataFrame:
    """``id, candidate, rank``: the first ``per_skill`` members of a skill's topics that pass the guards.

    Topics are visited in their order, members of a topic from the easiest on,
    those of one raw value by id; a candidate counts at its first topic. A
    candidate is easier by ``least_gap``, or by ``relaxed_gap`` for skills that
    satisfy ``relaxed``. A topic never meets itself: members are ranked once and
    met in windows, the first of ``window``, each further one four times as
    long, only by skills whose slots the topic can still fill. The search of a
    skill ends with its slots full or its topics at their end, so none is cut.
    """
    spark = profiled.sparkSession
    scratch = Scratch(spark, "topics")
    base = profiled.withColumn("gap", F.when(relaxed if relaxed is not None else F.lit(False), F.lit(relaxed_gap)).otherwise(F.lit(least_gap)))
    base = scratch.save(base.select(*GUARDED, "gap", "topics"), "profiles")
    flat = base.select("id", "raw", "gap", F.posexplode(F.array_distinct("topics")).alias("pos", "topic"))
    place = F.row_number().over(Window.partitionBy("topic").orderBy("raw", "id"))
    members = scratch.save(flat.select("topic", "id", "raw").withColumn("k", place).select("topic", F.col("id").alias("candidate"), F.col("raw").alias("rc"), "k"), "members")
    sizes = members.groupBy("topic").agg(F.max("k").alias("size"))
    # what of a topic can be a candidate: the members up to the skill's raw value less the gap
    d = base.select("id", F.struct(*GUARDED).alias("d"))
    open_ = scratch.save(flat.join(sizes, "topic").join(d, "id").select("id", "topic", "pos", (F.col("raw") - F.col("gap")).alias("most"), "size", "d"), "open")
    c = base.select(F.col("id").alias("candidate"), F.struct(*GUARDED).alias("c"))
    found, start, length = None, 0, window
    while True:
        pool, seen = scratch.counted(members.where((F.col("k") > start) & (F.col("k") <= start + length)).join(c, "candidate"), "pool")
        if not seen["rows"]:
            break
        few = F.broadcast(pool) if seen["rows"] <= BROADCAST_ROWS // 10 else pool  # rows with their profiles
        pairs = open_.join(few, "topic").where(F.col("rc") <= F.col("most")).where(admissible("d", "c"))
        new = pairs.select("id", "topic", "pos", "candidate", "rc")
        rank = F.row_number().over(Window.partitionBy("id", "topic").orderBy("rc", "candidate"))
        new = new if found is None else found.union(new)
        found = scratch.save(new.withColumn("r", rank).where(F.col("r") <= per_skill).drop("r"), "found")
        # a topic stays open while it has members left that are easy enough, and fewer passed than there are slots
        full = found.groupBy("id", "topic").agg(F.count("*").alias("n")).where(F.col("n") >= per_skill).select("id", "topic")
        last = pool.groupBy("topic").agg(F.max("rc").alias("reached"))
        left = open_.join(full, ["id", "topic"], "left_anti").where(F.col("size") > start + length).join(last, "topic").where("reached <= most").drop("reached")
        open_, seen = scratch.counted(left, "open")
        start, length = start + length, length * 4
        if not seen["rows"]:
            break
    if found is None:
        return spark.createDataFrame([], "id string, candidate string, rank int")
    once = found.groupBy("id", "candidate").agg(F.min(F.struct("pos", "rc")).alias("at"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("at.pos", "at.rc", "candidate"))
    return once.withColumn("rank", rank).where(F.col("rank") <= per_skill).select("id", "candidate", "rank")


def slots(profiled: DataFrame, index: ListIndex, ancestors: DataFrame, vectors: DataFrame, dim: int, most: int = 15, far: int = 5, probe: int = 24) -> DataFrame:
    """``id, candidate, kind, score``: the candidates of each skill in its slots, ancestors first, then its topics', then others'.

    ``profiled``: profiles with a numeric ``key``; ``index`` over vectors by that
    key; ``ancestors``: ``id, candidate, rank``; ``vectors``: ``key, vector`` of the
    skills that ask. The pool inside the topics counts if it has ``most`` members;
    a smaller one gives way to all skills, unless the skill has several sources
    and the pool fewer than three. ``far`` slots are for other topics.
    """
    scratch = Scratch(profiled.sparkSession, "slots")
    taken = ancestors.groupBy("id").agg(F.collect_set("candidate").alias("taken"))
    d = profiled.join(vectors, "key").join(taken, "id", "left").withColumn("taken", F.coalesce("taken", F.array().cast("array<string>")))
    asked = scratch.save(SlotGuard.columns(d).join(d.select("key", "vector", "sources", "taken"), "key"), "asked")
    rows = index.described(SlotGuard.columns(profiled).select(F.col("key").alias("id"), *SlotGuard.has))
    named = profiled.select(F.col("key").alias("other"), F.col("id").alias("candidate"))

    def search(who: DataFrame, k: int, pool: str, free: bool = True) -> DataFrame:
        return index.top(who, k, "key", "vector", probe, SlotGuard(pool, free), rows).withColumnRenamed("id", "key")

    pool = search(asked, most, "inside", False)
    size = asked.select("key", F.size("sources").alias("sources"), F.size("taken").alias("n_taken")).join(pool.groupBy("key").agg(F.count("*").alias("n")), "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    wide = scratch.save(size.where((F.col("n") < most) & ~((F.col("sources") >= 2) & (F.col("n") < 3))).select("key"), "wide")
    near = search(asked.join(wide, "key", "left_anti"), most, "inside").union(search(asked.join(wide, "key", "left_semi"), most, "wide"))
    slot = F.greatest(F.lit(1), F.lit(most - far) - F.col("n_taken"))
    top = scratch.save(near.join(size, "key").where(F.col("rank") <= slot).join(named, "other").select("key", "candidate", F.lit("topic").alias("kind"), F.col("cosine").alias("score"), "rank"), "top")
    used = top.groupBy("key").agg(F.collect_set("candidate").alias("used"))
    second = asked.join(used, "key", "left").withColumn("taken", F.array_union("taken", F.coalesce("used", F.array().cast("array<string>")))).drop("used")
    others = search(second.where(F.size("own_tokens") > 0), far, "far")
    others = others.join(named, "other").select("key", "candidate", F.lit("far").alias("kind"), F.col("cosine").alias("score"), "rank")
    ids = profiled.select("key", "id")
    first = ancestors.join(ids, "id").join(asked.select("key"), "key", "left_semi").select("key", "candidate", F.lit("ancestor").alias("kind"), F.lit(0.0).alias("score"), "rank")
    return first.unionByName(top).unionByName(others).join(ids, "key").select("id", "candidate", "kind", "score", "rank")


def neighbour_candidates(near: DataFrame, skills: DataFrame, slots: int) -> DataFrame:
    """``id, candidate, cosine, rank``: the nearest easier skills of each skill.

    ``near``: ``id, other, cosine`` of skills, as many as the guards may need.
    """
    a = skills.select("id", F.col("raw").alias("ra"), F.col("band").alias("ba"), F.col("start").alias("sa"))
    b = skills.select(F.col("id").alias("other"), F.col("raw").alias("rb"), F.col("band").alias("bb"), F.col("end").alias("eb"))
    ok = near.join(a, "id").join(b, "other").where(easier(F.col("rb"), F.col("bb"), F.col("ra"), F.col("ba")) & ~grade_gap(F.col("sa"), F.col("eb")))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "other"))
    return ok.withColumn("rank", rank).where(F.col("rank") <= slots).select("id", F.col("other").alias("candidate"), "cosine", "rank")


def without_twins(picks: DataFrame, vectors: DataFrame, slots: int = 15, limit: float = 0.97) -> DataFrame:
    """``id, candidate``: picks of a skill in rank order without one that is nearly the same as a better one.

    ``picks``: ``id, candidate, rank, score``, at most a few dozen a skill;
    ``vectors``: ``id, vec`` of unit length.
    """
    import numpy as np
    import pandas as pd

    full = picks.join(vectors.select(F.col("id").alias("candidate"), "vec"), "candidate")

    def fold(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("rank", kind="stable").reset_index(drop=True)
        x = np.stack(df["vec"].to_list())
        near = x @ x.T >= limit
        score, gone = df["score"].to_numpy(), np.zeros(len(df), bool)
        for a in range(len(df)):
            if gone[a]:
                continue
            for b in range(a + 1, len(df)):
                if not gone[b] and near[a, b]:
                    if score[a] >= score[b]:
                        gone[b] = True
                    else:
                        gone[a] = True
                        break
        return df.loc[~gone, ["id", "candidate"]].head(slots)

    return full.groupBy("id").applyInPandas(fold, "id string, candidate string")
