"""Graph operators on edges ``dep, pre`` (dependent, prerequisite).

Each round of a fixpoint is written to scratch, so lineage stays short and a
lost executor costs one round. Edges with a null end and edges of a node to
itself are ignored; repeated edges count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.runtime import Scratch


def clean_edges(edges: DataFrame) -> DataFrame:
    return edges.select("dep", "pre").where("dep is not null and pre is not null and dep <> pre").distinct()


def closure(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``dep, anc``: every direct or indirect prerequisite; a node on a cycle is its own ancestor.

    Paths double in length each round, so the rounds grow as the logarithm of
    the longest path.
    """
    scratch = scratch or Scratch(edges.sparkSession, "closure")
    known, seen = scratch.counted(clean_edges(edges).select("dep", F.col("pre").alias("anc")), "closure")
    while True:
        size = seen["rows"]
        up = known.select(F.col("dep").alias("anc"), F.col("anc").alias("far"))
        longer, seen = scratch.counted(known.union(known.join(up, "anc").select("dep", F.col("far").alias("anc"))).distinct(), "closure")
        scratch.drop(known)
        known = longer
        if seen["rows"] == size:
            return known


def topo_levels(edges: DataFrame, nodes: DataFrame | None = None, scratch: Scratch | None = None) -> DataFrame:
    """``id, level``: 0 without prerequisites, else one more than the highest prerequisite's; members of cycles, and what depends on them, are left out."""
    scratch = scratch or Scratch(edges.sparkSession, "levels")
    left = scratch.save(clean_edges(edges), "edges")
    all_nodes = left.select(F.col("dep").alias("id")).union(left.select(F.col("pre").alias("id")))
    if nodes is not None:
        all_nodes = all_nodes.union(nodes.select("id"))
    rest = scratch.save(all_nodes.where("id is not null").distinct(), "nodes")
    done: DataFrame | None = None
    level = 0
    while True:
        # nodes that wait for nobody any more
        free, seen = scratch.counted(rest.join(left.select(F.col("dep").alias("id")).distinct(), "id", "left_anti").withColumn("level", F.lit(level)), "level")
        if not seen["rows"]:
            break
        done = free if done is None else done.union(free)
        fewer = scratch.save(left.join(free.select(F.col("id").alias("pre")), "pre", "left_anti").select("dep", "pre"), "edges")
        others = scratch.save(rest.join(free, "id", "left_anti"), "nodes")
        scratch.drop(left, rest)
        left, rest, level = fewer, others, level + 1
    return done if done is not None else rest.withColumn("level", F.lit(0)).where("false")


def trim(edges: DataFrame, scratch: Scratch, rounds: int = 1_000_000) -> DataFrame:
    """Edges between nodes that have both a prerequisite and a dependent, again and again: all cycles are left."""
    core = edges
    size = core.count()
    for _ in range(rounds):
        kept = core.join(core.select(F.col("dep").alias("pre")).distinct(), "pre", "left_semi").join(core.select(F.col("pre").alias("dep")).distinct(), "dep", "left_semi").select("dep", "pre")
        kept, seen = scratch.counted(kept, "core")
        if seen["rows"] == size:
            return kept
        core, size = kept, seen["rows"]
        if not size:
            return core
    return core


def components(edges: DataFrame) -> DataFrame:
    """``id, component``: strongly connected components of two or more nodes, named by their smallest id.

    Peeling leaves cycles and what lies between them. There, colours spread:
    every node takes the smallest id that reaches it; the nodes of a colour that
    reach its first node back form a component and are taken away.
    """
    scratch = Scratch(edges.sparkSession, "components")
    core = trim(scratch.save(clean_edges(edges), "edges"), scratch)
    found: DataFrame | None = None
    while not core.isEmpty():
        colour = scratch.save(core.select(F.explode(F.array("dep", "pre")).alias("id")).distinct().withColumn("colour", F.col("id")), "colour")
        while True:
            # a prerequisite's colour flows to its dependents
            flow = core.join(colour.withColumnRenamed("id", "pre"), "pre").groupBy(F.col("dep").alias("id")).agg(F.min("colour").alias("new"))
            moved, seen = scratch.counted(colour.join(flow, "id", "left").select("id", F.least("colour", F.coalesce("new", "colour")).alias("colour"), (F.col("new") < F.col("colour")).alias("changed")), "colour", changed=F.count_if("changed"))
            scratch.drop(colour)
            colour = moved
            if not seen["changed"]:
                break
        colour = colour.select("id", "colour")
        same = core.join(colour.select(F.col("id").alias("dep"), F.col("colour").alias("cd")), "dep").join(colour.select(F.col("id").alias("pre"), F.col("colour").alias("cp")), "pre").where("cd = cp").select("dep", "pre", F.col("cd").alias("colour"))
        same = scratch.save(same, "inside")
        reached = frontier = scratch.save(colour.where("id = colour").select("id", "colour"), "reached")
        while True:
            # backwards: from a node to its prerequisites inside the colour
            step = frontier.select(F.col("id").alias("dep")).join(same, "dep").select(F.col("pre").alias("id"), "colour").distinct()
            fresh, seen = scratch.counted(step.join(reached, ["id", "colour"], "left_anti"), "frontier")
            if not seen["rows"]:
                break
            reached = scratch.save(reached.union(fresh), "reached")
            frontier = fresh
        big = reached.groupBy("colour").agg(F.count("*").alias("n")).where("n > 1").select("colour")
        part = scratch.save(reached.join(big, "colour").select("id", F.col("colour").alias("component")), "component")
        found = part if found is None else found.union(part)
        gone = reached.select("id")
        rest = core.join(gone.withColumnRenamed("id", "dep"), "dep", "left_anti").join(gone.withColumnRenamed("id", "pre"), "pre", "left_anti").select("dep", "pre")
        core = trim(scratch.save(rest, "edges"), scratch)
    return found if found is not None else core.select(F.col("dep").alias("id"), F.col("pre").alias("component"))


def min_labels(links: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """``v, label``, the smallest vertex of each component of the links ``u, v``, and the number of rounds.

    A round hooks every vertex to the smallest one next to it and then
    shortcuts the hooks until each leads to its end, tripling their reach with
    every table, so a sorted chain of any length is one hook. Links are then
    rewritten to ends. In two such rounds every end that is left has taken in
    all that lay next to it, so the ends at least halve.
    """
    pairs = links.select("u", "v").where("u is not null and v is not null and u <> v").distinct()
    left, seen = scratch.counted(pairs, "links")
    labels: DataFrame | None = None
    rounds = 0
    while seen["rows"]:
        both = left.select("u", "v").union(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.save(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p")), "low")
        moved = 1
        while moved:
            rounds += 1
            up, far = (low.select(F.col("u").alias(a), F.col("p").alias(b)) for a, b in (("p", "q"), ("q", "r")))
            hop = low.join(up, "p").join(far, "q").select("u", F.col("r").alias("p"), (F.col("r") != F.col("p")).alias("moved"))
            jumped, figures = scratch.counted(hop, "low", moved=F.count_if("moved"))
            scratch.drop(low)
            low, moved = jumped, figures["moved"]
        if labels is None:
            labels = low.select(F.col("u").alias("v"), F.col("p").alias("label"))
            kept: tuple[DataFrame, ...] = ()
        else:
            ends = low.select(F.col("u").alias("label"), F.col("p").alias("next"))
            moved_on = scratch.save(labels.join(ends, "label", "left").select("v", F.coalesce("next", "label").alias("label")), "labels")
            scratch.drop(*kept)
            labels, kept = moved_on, (moved_on,)
        a = low.select("u", F.col("p").alias("pu"))
        b = low.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        fewer, seen = scratch.counted(left.join(a, "u").join(b, "v").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).where("u <> v").distinct(), "links")
        scratch.drop(left)
        left = fewer
    return (labels if labels is not None else left.select("v", F.col("u").alias("label"))), rounds


def weak_components(edges: DataFrame) -> DataFrame:
    """``id, component``: nodes joined by edges in either direction, named by their smallest id."""
    labels, _ = min_labels(edges.select(F.col("dep").alias("u"), F.col("pre").alias("v")), Scratch(edges.sparkSession, "weak"))
    return labels.select(F.col("v").alias("id"), F.col("label").alias("component"))


def transitive_reduction(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Edges of a DAG without those that another way implies."""
    e = clean_edges(edges)
    up = known if known is not None else closure(e)
    implied = e.select("dep", F.col("pre").alias("mid")).join(up.select(F.col("dep").alias("mid"), F.col("anc").alias("pre")), "mid").select("dep", "pre").distinct()
    return e.join(implied, ["dep", "pre"], "left_anti")


def collapse_aliases(aliases: DataFrame, hops: int = 64) -> DataFrame:
    """``dropped_id, canonical_id`` with every chain followed to its end by pointer jumping; a cycle is an error."""
    scratch = Scratch(aliases.sparkSession, "aliases")
    to = scratch.save(aliases.select("dropped_id", "canonical_id").where("dropped_id is not null and canonical_id is not null").groupBy("dropped_id").agg(F.min("canonical_id").alias("canonical_id")), "aliases")
    reach = 1
    while True:
        nxt = to.select(F.col("dropped_id").alias("canonical_id"), F.col("canonical_id").alias("far"))
        moved = scratch.save(to.join(nxt, "canonical_id", "left").select("dropped_id", F.coalesce("far", "canonical_id").alias("canonical_id"), F.col("far").isNotNull().alias("moved")), "aliases")
        scratch.drop(to)
        if moved.where("moved").isEmpty():
            return moved.select("dropped_id", "canonical_id")
        reach *= 2
        if reach > 2 * hops:
            raise ValueError(f"an alias chain of more than {hops} hops, or a cycle")
        to = scratch.save(moved.select("dropped_id", "canonical_id"), "aliases")
        scratch.drop(moved)


def bounded_ancestors(edges: DataFrame, depth: int) -> DataFrame:
    """``dep, anc, depth``: ancestors within ``depth`` steps, each at its least depth."""
    e = clean_edges(edges)
    out = frontier = e.select("dep", F.col("pre").alias("anc"), F.lit(1).alias("depth"))
    for d in range(2, depth + 1):
        frontier = frontier.join(e.select(F.col("dep").alias("anc"), F.col("pre").alias("far")), "anc").select("dep", F.col("far").alias("anc"), F.lit(d).alias("depth")).distinct()
        out = out.union(frontier)
    return out.groupBy("dep", "anc").agg(F.min("depth").alias("depth"))


def inherited(links: DataFrame, known: DataFrame) -> DataFrame:
    """``id, value``: each node's value, else that of the nearest node above that has one.

    ``links`` has ``id, parent``, ``known`` has ``id, value``. Pointers jump over
    nodes without a value, so the rounds grow as the logarithm of the longest
    way. A way that ends, or turns in a circle, has no value.
    """
    scratch = Scratch(links.sparkSession, "inherited")
    up = scratch.save(links.where("id is not null").groupBy("id").agg(F.min("parent").alias("parent")), "links")
    value = scratch.save(known.where("id is not null and value is not null").groupBy("id").agg(F.min("value").alias("value")), "known")
    at = scratch.save(up.join(value, "id", "left").select("id", F.when(F.col("value").isNull(), F.col("parent")).alias("at"), "value"), "at")
    rounds, most = 0, up.count().bit_length() + 1
    while rounds < most and not at.where("at is not null").isEmpty():
        ahead = at.select(F.col("id").alias("at"), F.col("at").alias("far"), F.col("value").alias("found"))
        moved = scratch.save(at.join(ahead, "at", "left").select("id", F.col("far").alias("at"), F.coalesce("value", "found").alias("value")), "at")
        scratch.drop(at)
        at, rounds = moved, rounds + 1
    return at.select("id", "value")


def expert_scores(edges: DataFrame, pairs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``positives, predicted, hits, recovered``: edges against annotated pairs ``pre, dep, positive``.

    A pair is positive if any annotation says so. Only annotated edges count as
    predicted; a positive pair is recovered if its prerequisite is an ancestor.
    """
    marked = pairs.where("pre <> dep").groupBy("pre", "dep").agg(F.max("positive").alias("positive"))
    direct = clean_edges(edges).join(marked, ["dep", "pre"]).agg(F.count("*").alias("predicted"), F.count_if("positive").alias("hits"))
    up = (known if known is not None else closure(edges)).select("dep", F.col("anc").alias("pre"))
    good = marked.where("positive")
    return good.agg(F.count("*").alias("positives")).crossJoin(direct).crossJoin(good.join(up, ["dep", "pre"], "left_semi").agg(F.count("*").alias("recovered")))


def chain_lift(nodes: DataFrame, edges: DataFrame, seeds: DataFrame, cap: int = 4) -> tuple[DataFrame, DataFrame]:
    """``id, band`` after the lift, and the edges that it can order.

    ``nodes`` has ``id, band, anchored``. A ceiling comes down from anchored
    dependents, one band a step; then, prerequisites first, a node rises above
    its prerequisites up to its ceiling and at most ``cap`` bands. An edge whose
    prerequisite ends above that limit is dropped unless it is a seed. Both
    passes go level by level, each over the edges of its level only.
    """
    scratch = Scratch(nodes.sparkSession, "lift")
    e = scratch.save(clean_edges(edges), "edges")
    levels = scratch.save(topo_levels(e, nodes, scratch), "levels")
    deepest = levels.agg(F.max("level")).first()[0] or 0
    base = scratch.save(nodes.join(levels, "id").select("id", "band", "anchored", "level"), "nodes")
    placed = scratch.save(e.join(levels.select(F.col("id").alias("pre"), F.col("level").alias("lp")), "pre").join(levels.select(F.col("id").alias("dep"), F.col("level").alias("ld")), "dep"), "placed")
    own = F.when(F.col("anchored"), F.col("band"))
    ceiling: DataFrame | None = None
    for k in range(deepest, -1, -1):
        here = base.where(F.col("level") == k)
        if ceiling is None:
            now = here.select("id", F.greatest("band", F.coalesce(own, F.lit(20))).alias("ceiling"))
        else:
            low = placed.where(F.col("lp") == k).join(ceiling.withColumnRenamed("id", "dep"), "dep").groupBy(F.col("pre").alias("id")).agg(F.min(F.col("ceiling") - 1).alias("low"))
            now = here.join(low, "id", "left").select("id", F.greatest("band", F.coalesce(own, F.least(F.lit(20), F.coalesce("low", F.lit(20))))).alias("ceiling"))
        now = scratch.save(now, "ceiling")
        ceiling = now if ceiling is None else ceiling.union(now)
    limits = scratch.save(base.join(ceiling, "id").select("id", "band", "level", F.coalesce(own, F.least("ceiling", F.col("band") + cap)).alias("top")), "limits")
    seed = seeds.select("dep", "pre").distinct().withColumn("seed", F.lit(True))
    placed = scratch.save(placed.join(seed, ["dep", "pre"], "left").join(limits.select(F.col("id").alias("dep"), "top"), "dep"), "placed")
    lifted: DataFrame | None = None
    kept: DataFrame | None = None
    for k in range(deepest + 1):
        here = limits.where(F.col("level") == k)
        if lifted is None:
            now = here.select("id", F.least("band", "top").alias("lifted"))
        else:
            good = placed.where(F.col("ld") == k).join(lifted.select(F.col("id").alias("pre"), F.col("lifted").alias("lp_band")), "pre").where("lp_band <= top or seed")
            good = scratch.save(good.select("dep", "pre", "lp_band"), "kept")
            high = good.groupBy(F.col("dep").alias("id")).agg(F.max(F.col("lp_band") + 1).alias("high"))
            now = here.join(high, "id", "left").select("id", F.least(F.greatest("band", F.coalesce("high", "band")), "top").alias("lifted"))
            kept = good.select("dep", "pre") if kept is None else kept.union(good.select("dep", "pre"))
        now = scratch.save(now, "lifted")
        lifted = now if lifted is None else lifted.union(now)
    return lifted.select("id", F.col("lifted").alias("band")), kept if kept is not None else e


def drop_inside_components(edges: DataFrame, droppable: str) -> DataFrame:
    """Edges without those that are ``droppable`` (a condition) and lie inside a strongly connected component."""
    scc = Scratch(edges.sparkSession, "inside").save(components(edges), "components")
    inside = edges.join(scc.select(F.col("id").alias("dep"), F.col("component").alias("_cd")), "dep", "left").join(scc.select(F.col("id").alias("pre"), F.col("component").alias("_cp")), "pre", "left")
    return inside.where(~(F.expr(droppable) & F.coalesce(F.col("_cd") == F.col("_cp"), F.lit(False)))).select(edges.columns)


def _seed_order(scc: DataFrame, seeds: DataFrame) -> DataFrame:
    """``id, phase, place``: the order in which a component's nodes are ready, by their seed prerequisites and then by ``raw, id``.

    ``scc``: ``id, component, raw``; ``seeds``: ``dep, pre, component``, those
    inside. Always the ready node of least ``(raw, id)`` comes next; nodes that
    wait for each other come last, by ``(raw, id)``. A node without seeds comes
    when the ready ones before it are used up, so only nodes with seeds are gone
    through one by one; ``phase`` is the greatest ``(raw, id)`` up to a node's turn
    and orders it among all others.
    """
    import heapq

    import pandas as pd

    held = seeds.select("component", F.explode(F.array("dep", "pre")).alias("id")).distinct()
    nodes = scc.join(held, ["component", "id"])
    rows = nodes.select("component", "id", "raw", F.lit(None).cast("string").alias("pre")).union(seeds.join(nodes.select("component", F.col("id").alias("dep"), "raw"), ["component", "dep"]).select("component", F.col("dep").alias("id"), "raw", "pre"))

    def ready(df: pd.DataFrame) -> pd.DataFrame:
        raw = dict(zip(df["id"], df["raw"]))
        after: dict[str, list[str]] = {}
        wait = dict.fromkeys(raw, 0)
        for dep, pre in zip(df["id"], df["pre"]):
            if pre is not None:
                after.setdefault(pre, []).append(dep)
                wait[dep] += 1
        heap = [(raw[n], n) for n, k in wait.items() if not k]
        heapq.heapify(heap)
        out, phase = [], None
        while heap:
            at = heapq.heappop(heap)
            phase = at if phase is None or at > phase else phase
            out.append((at[1], False, *phase, len(out)))
            for dep in after.get(at[1], ()):
                wait[dep] -= 1
                if not wait[dep]:
                    heapq.heappush(heap, (raw[dep], dep))
        rest = sorted((raw[n], n) for n, k in wait.items() if k)
        out += [(n, True, r, n, len(out)) for r, n in rest]
        return pd.DataFrame(out, columns=["id", "last", "phase_raw", "phase_id", "place"])

    turn = rows.groupBy("component").applyInPandas(ready, "id string, last boolean, phase_raw double, phase_id string, place long")
    full = scc.select("id", "component", "raw").join(turn, "id", "left")
    return full.select("id", "component", F.struct(F.coalesce("last", F.lit(False)).alias("last"), F.coalesce("phase_raw", "raw").alias("raw"), F.coalesce("phase_id", "id").alias("id"), F.coalesce("place", F.lit(-1).cast("long")).alias("place")).alias("at"))


def break_cycles(edges: DataFrame, rank: DataFrame, seeds: DataFrame, rounds: int = 100) -> DataFrame:
    """Edges without cycles, by rounds over the strongly connected components that are left.

    A component's nodes are ranked by its seed edges (see ``_seed_order``), with
    ``raw`` of ``rank`` (``id, raw``) and the id as tie-breaks; a missing ``raw``
    comes last. Every edge, seed or not, whose prerequisite does not rank before
    its dependent goes. Such a rank orders all seeds unless they form a cycle
    themselves, so only then does a seed go.
    """
    scratch = Scratch(edges.sparkSession, "break")
    left = scratch.save(clean_edges(edges), "edges")
    seed = scratch.save(seeds.select("dep", "pre").distinct(), "seeds")
    raw = scratch.save(rank.groupBy("id").agg(F.min(F.col("raw").cast("double")).alias("raw")), "raw")
    for _ in range(rounds):
        scc = scratch.save(components(left), "components")
        if scc.isEmpty():
            return left
        nodes = scratch.save(scc.join(raw, "id", "left").select("id", "component", F.coalesce("raw", F.lit(float("inf"))).alias("raw")), "nodes")
        inside = left.join(scc.select(F.col("id").alias("dep"), "component"), "dep").join(scc.select(F.col("id").alias("pre"), F.col("component").alias("cp")), "pre").where("component = cp").select("dep", "pre", "component")
        inside = scratch.save(inside, "inside")
        order = scratch.save(_seed_order(nodes, inside.join(seed, ["dep", "pre"], "left_semi")), "order")
        placed = inside.join(order.select(F.col("id").alias("dep"), F.col("at").alias("ad")), "dep").join(order.select(F.col("id").alias("pre"), F.col("at").alias("ap")), "pre")
        left = scratch.save(left.join(placed.where("ap >= ad").select("dep", "pre"), ["dep", "pre"], "left_anti"), "edges")
    raise ValueError(f"cycles are left after {rounds} rounds")


def longest_chain(edges: DataFrame) -> DataFrame:
    """``step, id``: one of the longest ways of a DAG, from a node without prerequisites up; of equal ones the smallest ids."""
    scratch = Scratch(edges.sparkSession, "chain")
    e = scratch.save(clean_edges(edges), "edges")
    levels = scratch.save(topo_levels(e, scratch=scratch), "levels")
    # a way of the greatest length steps down one level at a time
    below = e.join(levels.select(F.col("id").alias("dep"), F.col("level").alias("ld")), "dep").join(levels.select(F.col("id").alias("pre"), F.col("level").alias("lp")), "pre").where("lp = ld - 1").groupBy("dep").agg(F.min("pre").alias("pre"))
    top = levels.orderBy(F.desc("level"), "id").first()
    if top is None:
        return edges.sparkSession.createDataFrame([], "step int, id string")
    below = scratch.save(below, "below")
    way, at = [(top.level, top.id)], top.id
    for step in range(top.level - 1, -1, -1):  # as many rows as the way is long
        at = below.where(F.col("dep") == at).first().pre
        way.append((step, at))
    return edges.sparkSession.createDataFrame(way, "step int, id string")


def reaches(edges: DataFrame, new: DataFrame) -> DataFrame:
    """The edges ``dep, pre`` of ``new`` that would close a cycle with ``edges``: their prerequisite already leads to their dependent."""
    up = closure(edges)
    back = new.join(up.select(F.col("dep").alias("pre"), F.col("anc").alias("dep")), ["dep", "pre"], "left_semi")
    return new.where("dep = pre").union(back).select("dep", "pre").distinct()


def assert_acyclic(edges: DataFrame) -> None:
    """An error that names a node on a cycle, or a self-edge."""
    from strandloom.operators.relational import assert_none

    assert_none(edges.where("dep = pre"), "expected two ends, received a self-edge")
    assert_none(components(edges), "expected no cycle")


def forward_bands(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``id, band``: prerequisites first, a band rises above those of its prerequisites, kept between ``low`` and ``high``.

    ``nodes``: ``id, band, low, high, anchored``; anchored bands stand.
    """
    scratch = Scratch(nodes.sparkSession, "forward")
    e = scratch.save(clean_edges(edges), "edges")
    levels = scratch.save(topo_levels(e, nodes, scratch), "levels")
    deepest = levels.agg(F.max("level")).first()[0] or 0
    base = scratch.save(nodes.join(levels, "id"), "nodes")
    done: DataFrame | None = None
    for k in range(deepest + 1):
        here = base.where(F.col("level") == k)
        above = F.lit(None).cast("int")
        if done is not None:
            high = e.join(done.withColumnRenamed("id", "pre"), "pre").groupBy(F.col("dep").alias("id")).agg(F.max("band").alias("above"))
            here = here.join(high, "id", "left")
            above = F.col("above") + 1
        fit = F.greatest("low", F.least("high", F.greatest(F.col("band"), F.coalesce(above, F.col("band")))))
        now = scratch.save(here.select("id", F.when(F.col("anchored"), F.col("band")).otherwise(fit).alias("band")), "bands")
        done = now if done is None else done.union(now)
    return done if done is not None else nodes.select("id", "band")


def first_parents(links: DataFrame, most: int) -> DataFrame:
    """``id, step, parents``: all parents of a node, then all of its first parent's, and so on up, ``most`` steps at most.

    ``links``: ``id, parent, ord``; the first parent by ``ord`` leads on. A way
    that comes back to a node that it has led through ends.
    """
    scratch = Scratch(links.sparkSession, "ladder")
    each = links.where("id is not null and parent is not null").groupBy("id", "parent").agg(F.min("ord").alias("ord"))
    lists = scratch.save(each.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("ord", "parent"))).alias("l")).select("id", F.transform("l", lambda x: x["parent"]).alias("parents")), "parents")
    at = lists.select("id", F.col("id").alias("cursor"), F.array("id").alias("way"))
    out: DataFrame | None = None
    for step in range(1, most + 1):
        here = at.join(lists.select(F.col("id").alias("cursor"), "parents"), "cursor").select("id", F.lit(step).alias("step"), "parents", F.col("parents")[0].alias("next"), "way")
        here, seen = scratch.counted(here, "step")
        if not seen["rows"]:
            break
        out = here.select("id", "step", "parents") if out is None else out.union(here.select("id", "step", "parents"))
        at = here.where(~F.array_contains("way", F.col("next"))).select("id", F.col("next").alias("cursor"), F.array_append("way", F.col("next")).alias("way"))
    return out if out is not None else lists.select("id", F.lit(0).alias("step"), "parents").where("false")


def inverted_above(edges: DataFrame, bands: DataFrame) -> DataFrame:
    """``id, band, highest``: the highest band of all direct and indirect prerequisites, by a running maximum up the levels.

    Nodes without prerequisites have a null ``highest``. Only direct edges are
    read, each once. ``edges`` is a DAG.
    """
    scratch = Scratch(edges.sparkSession, "above")
    e = scratch.save(clean_edges(edges).join(bands.select(F.col("id").alias("pre"), F.col("band").alias("bp")), "pre", "left"), "edges")
    levels = scratch.save(topo_levels(e.select("dep", "pre"), scratch=scratch), "levels")
    placed = scratch.save(e.join(levels.select(F.col("id").alias("dep"), F.col("level").alias("ld")), "dep"), "placed")
    deepest = levels.agg(F.max("level")).first()[0] or 0
    known: DataFrame | None = None
    for k in range(1, deepest + 1):
        step = placed.where(F.col("ld") == k)
        up = F.col("bp")
        if known is not None:
            step = step.join(known.select(F.col("id").alias("pre"), F.col("highest").alias("hp")), "pre", "left")
            up = F.greatest("bp", "hp")
        now = scratch.save(step.groupBy(F.col("dep").alias("id")).agg(F.max(up).alias("highest")), "highest")
        known = now if known is None else known.union(now)
    if known is None:
        return bands.select("id", "band", F.lit(None).cast("int").alias("highest"))
    return bands.select("id", "band").join(known, "id", "left")
