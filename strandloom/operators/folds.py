"""Ordered folds: greedy steps that look at the state so far.

Such a step can only change the state of rows that are joined to it through
candidate pairs. Components of the candidate pairs therefore share no state,
and the exact sequential fold runs in each of them by itself, in the order of
explicit columns.

A component may be a giant one, so no fold takes it whole: rows are numbered in
order within their component, by exact offsets, and cut into windows of
``WINDOW`` rows. The windows of one number are folded together, one task a
component; what they change goes to a table of states, from which the next
windows take what concerns their rows. Components of up to ``WINDOW`` rows, as a
rule all, take one round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions import text as X
from strandloom.operators import graph as G
from strandloom.operators.hotkeys import KeyChunks
from strandloom.runtime import Scratch

WINDOW = 100_000


def ordered_fold(df: DataFrame, component: str, order: list[str], step: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``step`` over the rows of each component, sorted by ``order``."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return step(rows.sort_values(order, kind="stable").reset_index(drop=True))

    return df.groupBy(component).applyInPandas(run, schema)


def windows(df: DataFrame, component: str, order: list[str], scratch: Scratch) -> Iterator[DataFrame]:
    """The rows of each component in order, ``WINDOW`` at a time; ``order`` must tell the rows of a component apart."""
    base = scratch.save(df, "ordered")
    big, seen = scratch.counted(base.groupBy(component).agg(F.count("*").alias("n")).where(F.col("n") > WINDOW).select(component), "big")
    if not seen["rows"]:
        yield base
        return
    at = F.struct(*order)
    held = KeyChunks(base.join(big, component, "left_semi").select(component, at.alias("at")), [component], "at", WINDOW)
    placed = scratch.save(base.withColumn("at", at).join(held.rows.select(component, "at", "chunk"), [component, "at"], "left").withColumn("chunk", F.coalesce("chunk", F.lit(0))).drop("at"), "placed")
    last = placed.agg(F.max("chunk")).first()[0]
    for k in range(last + 1):
        yield placed.where(F.col("chunk") == k).drop("chunk")


# --- guarded merging -----------------------------------------------------------------------------


def guarded_merge(rows: DataFrame, pairs: DataFrame, antonyms: list[str]) -> DataFrame:
    """``dropped_id, canonical_id``: candidate pairs merged one by one, under guards that look at the groups so far.

    ``rows``: ``id, title, sources`` (a number), ``lowest`` (grade or null).
    ``pairs``: ``a, b, ord``. Two groups do not merge if their canonical titles
    hold different words of one antonym group, or if both have a lowest grade
    and these differ. The canonical row is that of more sources, then the one
    whose words are a superset, then the one of the shorter title, then the
    first end of the pair.
    """
    scratch = Scratch(rows.sparkSession, "merge")
    spark = rows.sparkSession
    p = scratch.save(pairs.select("a", "b", "ord").where("a is not null and b is not null and a <> b").distinct(), "pairs")
    where = G.weak_components(p.select(F.col("a").alias("dep"), F.col("b").alias("pre")))
    named = p.join(where.withColumnRenamed("id", "a"), "a")
    groups = {w: k for k, g in enumerate(antonyms) for w in (g if isinstance(g, list) else g.split())}
    facts = scratch.save(rows.select("id", "title", X.plain_words("title").alias("words"), X.signature_words("title").alias("sig"), "sources", F.col("lowest").cast("double").alias("lowest")), "facts")

    def fold(df: pd.DataFrame) -> pd.DataFrame:
        info: dict[str, tuple] = {}
        for s in "ab":
            for r in df[[s, f"title_{s}", f"words_{s}", f"sig_{s}", f"sources_{s}"]].itertuples(index=False):
                info[r[0]] = (r[1], set(r[2]), set(r[3]), r[4])
        low = {x: v for s in "ab" for x, v in zip(df[s], df[f"lowest_{s}"]) if v == v and v is not None}
        root = {x: x for x in info}

        def find(x: str) -> str:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def clash(x: set, y: set) -> bool:
            held: dict[int, tuple[set, set]] = {}
            for w in x | y:
                if w in groups:
                    pair = held.setdefault(groups[w], (set(), set()))
                    if w in x:
                        pair[0].add(w)
                    if w in y:
                        pair[1].add(w)
            return any(m and n and not m & n for m, n in held.values())

        for a, b in zip(df["a"], df["b"]):
            x, y = find(a), find(b)
            if x == y or clash(info[x][1], info[y][1]) or (x in low and y in low and low[x] != low[y]):
                continue
            (tx, _, sx, nx), (ty, _, sy, ny) = info[x], info[y]
            if nx != ny:
                keep = x if nx > ny else y
            elif sx and sx < sy:
                keep = y
            elif sy and sy < sx:
                keep = x
            else:
                keep = x if len(tx) <= len(ty) else y
            gone = y if keep == x else x
            root[gone] = keep
            if x in low or y in low:
                low[keep] = min(low.get(x, float("inf")), low.get(y, float("inf")))
        out = [(x, find(x), low.get(find(x))) for x in root]
        return pd.DataFrame(out, columns=["id", "root", "low"])

    roots = low = None
    for part in windows(named, "component", ["ord", "a", "b"], scratch):
        # ends stand for the groups that they have come to, groups have the lowest grade of their members
        for s in "ab":
            if roots is not None:
                part = part.join(roots.select(F.col("id").alias(s), "root"), s, "left").withColumn(s, F.coalesce("root", s)).drop("root")
            part = part.join(facts.select(F.col("id").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("title", "words", "sig", "sources", "lowest"))), s)
            if low is not None:
                part = part.join(low.select(F.col("root").alias(s), F.col("low").alias("_low")), s, "left").withColumn(f"lowest_{s}", F.coalesce("_low", f"lowest_{s}")).drop("_low")
        now = scratch.save(ordered_fold(part, "component", ["ord", "a", "b"], fold, "id string, root string, low double"), "merged")
        moved = now.where("id <> root").select("id", "root")
        fresh = now.where("low is not null").select("root", "low").distinct()
        if roots is None:
            roots, low = moved, fresh
            continue
        onward = roots.join(moved.select(F.col("id").alias("root"), F.col("root").alias("next")), "root", "left").select("id", F.coalesce("next", "root").alias("root"))
        roots = scratch.save(onward.union(moved), "roots")
        low = scratch.save(fresh.union(low.join(fresh.select("root"), "root", "left_anti")), "low")
    if roots is None:
        return spark.createDataFrame([], "dropped_id string, canonical_id string")
    return roots.select(F.col("id").alias("dropped_id"), F.col("root").alias("canonical_id"))


# --- feasible seeds ------------------------------------------------------------------------------


def feasible_seeds(nodes: DataFrame, seeds: DataFrame) -> DataFrame:
    """``dep, pre, kept``: seed pairs taken one by one, each kept iff all bands can still be ordered.

    ``nodes``: ``id, band, anchored``; ``seeds``: ``dep, pre, late, ord``. Every
    node's band lies in an interval, 1 to 20, or its own band if it is anchored.
    A kept pair puts its dependent at least one band above its prerequisite;
    that moves intervals along all kept pairs, and a pair that would empty one
    is undone. Pairs that are not ``late`` come first. Intervals of anchored
    nodes never move, so components are cut there.
    """
    scratch = Scratch(nodes.sparkSession, "seeds")
    info = nodes.select("id", "band", "anchored")
    s = seeds.where("dep is not null and pre is not null and dep <> pre").groupBy("dep", "pre").agg(F.min("late").alias("late"), F.min("ord").alias("ord"))
    s = s.join(info.select(F.col("id").alias("dep"), F.col("band").alias("bd"), F.col("anchored").alias("ad")), "dep").join(info.select(F.col("id").alias("pre"), F.col("band").alias("bp"), F.col("anchored").alias("ap")), "pre")
    s = scratch.save(s, "seeds")
    free = s.where("not ad and not ap").select("dep", "pre")
    where = G.weak_components(free)
    alone = lambda c: where.select(F.col("id").alias(c), F.col("component").alias(f"c_{c}"))
    placed = s.join(alone("dep"), "dep", "left").join(alone("pre"), "pre", "left")
    # a pair belongs to the component of its free end; two anchored ends decide by themselves
    own = F.when(~F.col("ad"), F.coalesce("c_dep", "dep")).when(~F.col("ap"), F.coalesce("c_pre", "pre"))
    both = placed.where("ad and ap").select("dep", "pre", (F.col("bp") < F.col("bd")).alias("kept"))
    rest = placed.where("not (ad and ap)").withColumn("component", own)

    size = rest.groupBy("component").agg(F.count("*").alias("n"))
    big, seen = scratch.counted(size.where(F.col("n") > WINDOW).select("component"), "big")
    few = rest.join(big, "component", "left_anti") if seen["rows"] else rest
    out = both.union(ordered_fold(few, "component", ["late", "ord", "dep", "pre"], _seed_fold, "dep string, pre string, kept boolean"))
    return out.union(_feasible_by_halves(info, rest.join(big, "component", "left_semi"), scratch)) if seen["rows"] else out


def _seed_fold(df: pd.DataFrame) -> pd.DataFrame:
    low: dict[str, int] = {}
    high: dict[str, int] = {}
    for n, b, a in [*zip(df["dep"], df["bd"], df["ad"]), *zip(df["pre"], df["bp"], df["ap"])]:
        low[n], high[n] = (int(b), int(b)) if a else (1, 20)
    up: dict[str, list[str]] = {}
    down: dict[str, list[str]] = {}
    kept = []
    for dep, pre in zip(df["dep"], df["pre"]):
        undo: list[tuple[dict, str, int]] = []
        up.setdefault(pre, []).append(dep)
        down.setdefault(dep, []).append(pre)
        todo = [(True, dep, low[pre] + 1), (False, pre, high[dep] - 1)]
        ok = True
        while todo and ok:
            rising, n, v = todo.pop()
            if rising and v > low[n]:
                if v > high[n]:
                    ok = False
                    break
                undo.append((low, n, low[n]))
                low[n] = v
                todo += [(True, d, v + 1) for d in up.get(n, ())]
            elif not rising and v < high[n]:
                if v < low[n]:
                    ok = False
                    break
                undo.append((high, n, high[n]))
                high[n] = v
                todo += [(False, p, v - 1) for p in down.get(n, ())]
        if not ok:
            for bound, n, v in reversed(undo):
                bound[n] = v
            up[pre].pop()
            down[dep].pop()
        kept.append(ok)
    return pd.DataFrame({"dep": df["dep"], "pre": df["pre"], "kept": kept})


def _bounds(info: DataFrame, pairs: DataFrame, scratch: Scratch) -> tuple[DataFrame, bool]:
    """``id, low, high`` that the pairs leave each node, and whether all can be met. A way is at most 19 pairs long, or none can."""
    ends = pairs.select(F.explode(F.array("dep", "pre")).alias("id")).distinct()
    at = scratch.save(info.join(ends, "id").select("id", F.when(F.col("anchored"), F.col("band")).otherwise(1).alias("low"), F.when(F.col("anchored"), F.col("band")).otherwise(20).alias("high")), "bounds")
    for _ in range(21):
        p = at.select(F.col("id").alias("pre"), F.col("low").alias("lp"), F.col("high").alias("hp"))
        d = at.select(F.col("id").alias("dep"), F.col("low").alias("ld"), F.col("high").alias("hd"))
        met = pairs.join(p, "pre").join(d, "dep")
        push = met.select(F.col("dep").alias("id"), (F.col("lp") + 1).alias("l"), F.lit(20).alias("h")).union(met.select(F.col("pre").alias("id"), F.lit(1), F.col("hd") - 1)).groupBy("id").agg(F.max("l").alias("l"), F.min("h").alias("h"))
        moved = at.join(push, "id", "left").select("id", F.greatest("low", F.coalesce("l", "low")).alias("low"), F.least("high", F.coalesce("h", "high")).alias("high"), ((F.col("l") > F.col("low")) | (F.col("h") < F.col("high"))).alias("moved"))
        grown, seen = scratch.counted(moved, "bounds", moved=F.count_if("moved"), bad=F.count_if(F.col("low") > F.col("high")))
        scratch.drop(at)
        at = grown.select("id", "low", "high")
        at._scratch_path = grown._scratch_path  # type: ignore[attr-defined]
        if seen["bad"]:
            return at, False
        if not seen["moved"]:
            return at, True
    return at, False


def _feasible_by_halves(info: DataFrame, rest: DataFrame, scratch: Scratch) -> DataFrame:
    """The same fold for components of any size: a run of pairs that can all be met at once is kept whole, any other is halved.

    If a set of pairs can be met, so can every part of it; pairs that the bounds
    of those kept so far rule out are dropped together before a run is tried.
    """
    at = F.struct("late", "ord", "dep", "pre")
    chunks = KeyChunks(rest.select(F.lit(0).alias("one"), at.alias("at")), ["one"], "at", 1)
    todo = scratch.save(rest.withColumn("at", at).join(chunks.rows.select("at", F.col("chunk").alias("k")), "at").select("dep", "pre", "k"), "pairs")
    last = todo.agg(F.max("k")).first()[0]
    kept = scratch.save(todo.where("false"), "kept")
    runs = [(0, last + 1)]
    while runs:
        lo, hi = runs.pop()
        bounds, _ = _bounds(info, kept, scratch)
        here = todo.where((F.col("k") >= lo) & (F.col("k") < hi))
        open_ = info.select("id", F.when(F.col("anchored"), F.col("band")).otherwise(1).alias("l0"), F.when(F.col("anchored"), F.col("band")).otherwise(20).alias("h0")).join(bounds, "id", "left").select("id", F.coalesce("low", "l0").alias("low"), F.coalesce("high", "h0").alias("high"))
        here = here.join(open_.select(F.col("id").alias("pre"), F.col("low").alias("lp")), "pre").join(open_.select(F.col("id").alias("dep"), F.col("high").alias("hd")), "dep").where("lp + 1 <= hd").select("dep", "pre", "k")
        here, seen = scratch.counted(here, "run")
        if not seen["rows"]:
            continue
        both = scratch.save(kept.union(here), "kept")
        if _bounds(info, both, scratch)[1]:
            scratch.drop(kept)
            kept = both
        elif seen["rows"] > 1:
            middle = here.agg(F.min("k"), F.max("k")).first()
            cut = (middle[0] + middle[1]) // 2 + 1
            runs += [(cut, hi), (lo, cut)]
    return rest.select("dep", "pre").join(kept.select("dep", "pre", F.lit(True).alias("kept")), ["dep", "pre"], "left").select("dep", "pre", F.coalesce("kept", F.lit(False)).alias("kept"))


# --- caps with state -----------------------------------------------------------------------------


def hub_caps(edges: DataFrame, per_topic: int = 30, overall: int = 150, technical: int = 15) -> DataFrame:
    """``dep, pre``: edges that stay under the caps of their prerequisite, nearest dependents first.

    ``edges``: ``dep, pre, gap, seed, tech, topics`` (of the dependent). Seeds
    stay and count. A technical prerequisite keeps its first ``technical``
    edges. Others keep an edge while one of its topics has fewer than
    ``per_topic`` and the prerequisite fewer than ``overall`` edges. Edges past
    the place at which nothing but seeds can be kept are decided without the
    fold, so a hub of any size is never one task's list: the fold sees at most
    the first rows of a prerequisite that can still matter.
    """
    scratch = Scratch(edges.sparkSession, "caps")
    base = edges.where("dep is not null and pre is not null").dropDuplicates(["dep", "pre"])
    by = Window.partitionBy("pre").orderBy("gap", "dep")
    tech = base.where("tech").withColumn("i", F.row_number().over(by)).where(F.col("seed") | (F.col("i") <= technical)).select("dep", "pre")
    seeds = base.where("not tech and seed").select("dep", "pre")
    # of one topic list, only the first ``overall`` edges can ever be kept
    sets = base.where("not tech").withColumn("topics", F.array_sort(F.coalesce("topics", F.array().cast("array<string>"))))
    rank = F.row_number().over(Window.partitionBy("pre", "topics", "seed").orderBy("gap", "dep"))
    some = sets.withColumn("k", rank).where(F.col("k") <= overall).drop("k", "tech")

    def fold(df: pd.DataFrame) -> pd.DataFrame:
        topics: dict[str, int] = dict(df["held"].iloc[0] or {}) if df["held"].iloc[0] is not None else {}
        count, kept = int(df["count"].iloc[0]), []
        for r in df.itertuples(index=False):
            if r.seed:
                count += 1
                continue
            own = list(r.topics) or ["_notopic"]
            free = [t for t in own if topics.get(t, 0) < per_topic]
            if free and count < overall:
                kept.append((r.dep, r.pre, None, None))
                count += 1
                for t in free:
                    topics[t] = topics.get(t, 0) + 1
        # at most ``overall`` edges are kept, so the state is no larger
        kept.append((None, df["pre"].iloc[0], count, topics))
        return pd.DataFrame(kept, columns=["dep", "pre", "count", "held"])

    state = kept = None
    for part in windows(some, "pre", ["gap", "dep"], scratch):
        part = part.withColumn("count", F.lit(0)).withColumn("held", F.lit(None).cast("map<string,int>")) if state is None else part.join(state, "pre")
        now = scratch.save(ordered_fold(part, "pre", ["gap", "dep"], fold, "dep string, pre string, count int, held map<string,int>"), "folded")
        state = now.where("dep is null").select("pre", "count", "held")
        new = now.where("dep is not null").select("dep", "pre")
        kept = new if kept is None else kept.union(new)
    return tech.union(seeds).union(kept)


def orphan_prerequisites(orphans: DataFrame, words: DataFrame, gap: float = 4.0, uses: int = 15, common: int = 300) -> DataFrame:
    """``dep, pre``: skills without a prerequisite get the least used skill whose whole id is one of their words.

    ``orphans``: ``id, raw, ord``; ``words``: ``id, raw, tech``. A word has five
    letters or more and is in at most ``common`` ids; the prerequisite is easier
    by ``gap`` and used at most ``uses`` times, least used first, then easiest.
    """
    token = lambda df: df.select("id", F.explode(F.array_distinct(F.split("id", "-"))).alias("w")).where("length(w) >= 5")
    rare = token(words).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") <= common).select("w")
    cand = token(orphans).join(rare, "w", "left_semi").join(words.where("not tech").select(F.col("id").alias("w"), F.col("raw").alias("rp")), "w").join(orphans.select("id", "raw", "ord"), "id")
    scratch = Scratch(orphans.sparkSession, "orphans")
    cand = scratch.save(cand.where((F.col("w") != F.col("id")) & (F.col("raw") - F.col("rp") >= gap)).select(F.col("id").alias("dep"), F.col("w").alias("pre"), "rp", "ord"), "candidates")
    where = G.weak_components(cand.select("dep", "pre"))
    full = cand.join(where.withColumnRenamed("id", "dep"), "dep")

    def fold(df: pd.DataFrame) -> pd.DataFrame:
        used = {p: int(n) for p, n in zip(df["pre"], df["n"])}
        out = []
        for _, rows in df.groupby("ord", sort=True):
            ranked = sorted((used[p], r, p) for p, r in zip(rows["pre"], rows["rp"]))
            n, _, p = ranked[0]
            if n < uses:
                used[p] = n + 1
                out.append((rows["dep"].iloc[0], p))
        return pd.DataFrame(out, columns=["dep", "pre"])

    # a window ends with a whole dependent: all its candidates carry its first place
    taken = None
    heads = full.groupBy("component", "ord", "dep").agg(F.min("pre").alias("_first"))
    for part in windows(heads, "component", ["ord", "dep"], scratch):
        rows = part.drop("_first").join(full, ["component", "ord", "dep"])
        rows = rows.withColumn("n", F.lit(0)) if taken is None else rows.join(taken.groupBy("pre").agg(F.count("*").alias("n")), "pre", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        now = scratch.save(ordered_fold(rows, "component", ["ord", "pre"], fold, "dep string, pre string"), "taken")
        taken = now if taken is None else taken.union(now)
    return taken
