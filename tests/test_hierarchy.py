import random

from strandloom.operators import hierarchy
from strandloom.operators.hierarchy import Hierarchy


def brute(links):
    parent = {}
    for child, up in sorted(links, key=str):
        if child is None:
            continue
        parent.setdefault(child, None)
        if up is not None and up.strip() and (parent[child] is None or up < parent[child]):
            parent[child] = up
    parent = {c: p if p in parent else None for c, p in parent.items()}
    out = {}
    for node in parent:
        way, at = [], node
        while parent[at] is not None and at not in way:
            way.append(at)
            at = parent[at]
        if parent[at] is None:
            out[node] = (at, len(way), None)
        else:
            loop = way[way.index(at) :]
            out[node] = (at, way.index(at), min(loop))
    return parent, out


def check(spark, links):
    h = Hierarchy(spark.createDataFrame(links, "child string, up string"), "child", "up")
    parent, want = brute(links)
    rows = {r.id: r for r in h.nodes.collect()}
    assert {k: (r.root, r.depth, r.loop) for k, r in rows.items()} == want
    assert {k: r.parent for k, r in rows.items()} == parent
    assert all(r.in_loop == (r.loop is not None and r.depth == 0) for r in rows.values())
    below = dict.fromkeys(parent, 0)
    for node in parent:
        at = node
        while not rows[at].in_loop and parent[at] is not None:
            at = parent[at]
            below[at] += 1
    assert {k: r.descendants for k, r in rows.items()} == below
    paths = {r.id: r.path for r in h.paths().collect()}
    assert set(paths) == set(parent)
    for node, path in paths.items():
        assert path[0] == rows[node].root and path[-1] == node and len(path) == rows[node].depth + 1
        assert all(parent[b] == a for a, b in zip(path, path[1:]))
    pairs = {(r.id, r.descendant): r.steps for r in h.descendants().collect()}
    assert pairs == {(up, node): len(path) - 1 - k for node, path in paths.items() for k, up in enumerate(path[:-1])}
    some = [n for n in paths if rows[n].descendants][:40]
    under = h.under(spark.createDataFrame([(n,) for n in some], "id string"))
    assert {tuple(r) for r in under.collect()} == {p for p in pairs if p[0] in some}
    return h


def test_trees_loops_and_dirt(spark):
    links = [("a", None), ("b", "a"), ("c", "b"), ("c", "b"), ("d", "zz"), ("e", " "), ("x", "y"), ("y", "x"), ("z", "y"), ("s", "s"), ("t", "s"), (None, "a"), ("m", "c"), ("m", "b")]
    h = check(spark, links)
    under = h.under(spark.createDataFrame([("a",), ("y",)], "id string"))
    assert {tuple(r) for r in under.collect()} == {("a", "b"), ("a", "c"), ("a", "m"), ("y", "z")}


def test_long_chain_hot_parent_and_random(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "PART", 7)
    monkeypatch.setattr(hierarchy, "CHUNK", 16)
    monkeypatch.setattr(hierarchy, "ENTRIES", 50)
    rng = random.Random(1)
    links = [(f"c{i:03}", f"c{i - 1:03}" if i else None) for i in range(130)]
    links += [(f"h{i:03}", "c007") for i in range(90)]
    links += [(f"r{i:03}", f"r{rng.randrange(120):03}") for i in range(120)]
    check(spark, links)


def test_empty(spark):
    h = Hierarchy(spark.createDataFrame([], "child string, up string"), "child", "up")
    assert h.nodes.count() == 0
    assert h.paths().count() == 0
    assert h.descendants().count() == 0
