from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pagemill.operators import hierarchy
from pagemill.operators.hierarchy import build_forest

SCHEMA = "chunk_id string, parent_header_id string, page int, nid string, root string, state int"


def brute(links):
    """node -> (path, depth, root, n_descendants, state) by following the links."""
    nodes = {}
    for node, parent in links:
        if node is not None:
            parent = None if parent in (None, "", "nan") else parent
            old = nodes.get(node, "none yet")
            nodes[node] = parent if old in ("none yet", None) else min(x for x in (old, parent) if x is not None)
    cyc = set()
    for start in nodes:
        seen, at = [], start
        while at in nodes and at not in seen:
            seen.append(at)
            at = nodes[at]
        if at in seen:
            cyc.update(seen[seen.index(at):])
    out, below = {}, Counter()
    for node in nodes:
        path = [node]
        while path[0] not in cyc and nodes[path[0]] in nodes:
            path.insert(0, nodes[path[0]])
        below.update(path[:-1])
        state = "on_cycle" if node in cyc else "below_cycle" if path[0] in cyc else "lost_parent" if nodes[node] is not None and nodes[node] not in nodes else None
        out[node] = (path, state)
    return {n: (p, len(p) - 1, p[0], below[n], s) for n, (p, s) in out.items()}


def run(spark, links):
    rows = [(a, b, i % 3, "x", "y", 1) for i, (a, b) in enumerate(links)]
    forest = build_forest(spark.createDataFrame(rows, SCHEMA), "chunk_id", "parent_header_id", "page")
    table = forest.table().collect()
    assert len({(r.root, r.entry) for r in table}) == len(table)
    return {r.node: (list(r.path), r.depth, r.root, r.n_descendants, r.state) for r in table}


CASES = {
    "empty": [],
    "one": [("a", None)],
    "self": [("a", "a"), ("b", "a")],
    "cycle with tree below": [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "d"), ("f", "e")],
    "lost": [("a", "zz"), ("b", "a")],
    "none marks": [("a", ""), ("b", "nan"), ("c", None), ("d", "a")],
    "repeated rows and null id": [("a", None), ("b", "a"), ("b", "a"), (None, "a"), (None, None)],
    "two parents": [("a", None), ("b", None), ("c", "b"), ("c", "a")],
    "deep": [("n0", None)] + [(f"n{i}", f"n{i - 1}") for i in range(1, 120)],
    "wide": [("r", None)] + [(f"c{i}", "r") for i in range(30)] + [(f"d{i}", "c3") for i in range(9)] + [("e", "d4")],
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    assert run(spark, CASES[name]) == brute(CASES[name])


def test_many_children_go_under_helpers(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "BLOCK", 4)
    assert run(spark, CASES["wide"]) == brute(CASES["wide"])


@pytest.mark.parametrize("block", [4, 100_000])
def test_siblings_stand_in_their_order(spark, monkeypatch, block):
    """Preorder by (page, node), nulls first, also where the children are spread over helpers."""
    monkeypatch.setattr(hierarchy, "BLOCK", block)
    page = {"r": 1, **{f"c{i:02d}": (None, 3, 2, 2)[i % 4] for i in range(25)}, **{f"d{i}": 5 for i in range(7)}}
    links = [("r", None)] + [(f"c{i:02d}", "r") for i in range(25)] + [(f"d{i}", "c03") for i in range(7)]
    rows = spark.createDataFrame([(n, p, page[n]) for n, p in links], "node string, parent string, page int")
    got = [r.node for r in sorted(build_forest(rows, "node", "parent", "page").table().collect(), key=lambda r: r.entry)]
    want = ["r"]
    for c in sorted((f"c{i:02d}" for i in range(25)), key=lambda c: (page[c] is not None, page[c] or 0, c)):
        want += [c] + ([f"d{i}" for i in range(7)] if c == "c03" else [])
    assert got == want


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcdefghij"), st.one_of(st.none(), st.sampled_from("abcdefghijk"))), max_size=25))
def test_random(spark, links):
    assert run(spark, links) == brute(links)


@pytest.mark.parametrize("top", [1, 14])
def test_pairs_are_all_descendants(spark, monkeypatch, top):
    monkeypatch.setattr(hierarchy, "TOP", top)
    links = CASES["wide"] + CASES["cycle with tree below"][3:]
    rows = spark.createDataFrame([(a, b) for a, b in links], "id string, up string")
    forest = build_forest(rows, "id", "up")
    name = {r.nid: r.node for r in forest.names.collect()}
    got = sorted((name[r.ancestor], name[r.nid]) for r in forest.ancestor_pairs().collect())
    assert got == sorted((a, n) for n, (path, *_) in brute(links).items() for a in path[:-1])
