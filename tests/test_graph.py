import random
from itertools import combinations

import pytest

from docloom.operators.graph import Level, both_ways, communities, connected, modularity, sizes, supply_links

TRIANGLES = [(1, 2, 1.0), (2, 3, 1.0), (1, 3, 1.0), (11, 12, 1.0), (12, 13, 1.0), (11, 13, 1.0)]


def frame(spark, edges):
    return spark.createDataFrame(edges, "a long, b long, w double")


def plain_modularity(edges, c, resolution=1.0):
    """By the definition: over all ordered pairs of vertices."""
    k, m2 = {}, 2 * sum(w for *_, w in edges)
    for a, b, w in edges:
        k[a], k[b] = k.get(a, 0) + w, k.get(b, 0) + w
    inner = sum(2 * w for a, b, w in edges if c[a] == c[b])
    return inner / m2 - resolution * sum(k[a] * k[b] for a in k for b in k if c[a] == c[b]) / m2**2


def plain_louvain(edges):
    """Sequential local moves and contraction, for comparison."""
    names = {v: v for a, b, _ in edges for v in (a, b)}
    graph = {}
    for a, b, w in edges:
        for x, y in ((a, b), (b, a)):
            graph.setdefault(x, {})[y] = graph.setdefault(x, {}).get(y, 0) + w
    m2 = sum(sum(x.values()) for x in graph.values())
    while True:
        k = {v: sum(x.values()) for v, x in graph.items()}
        c, total, moved, again = {v: v for v in graph}, dict(k), False, True
        while again:
            again = False
            for v in sorted(graph):
                near = {}
                for u, w in graph[v].items():
                    if u != v:
                        near[c[u]] = near.get(c[u], 0) + w
                total[c[v]] -= k[v]
                best = max([c[v], *sorted(near)], key=lambda d: near.get(d, 0) - k[v] * total[d] / m2)  # noqa: B023
                if near.get(best, 0) - k[v] * total[best] / m2 > near.get(c[v], 0) - k[v] * total[c[v]] / m2 + 1e-9:
                    c[v], moved, again = best, True, True
                total[c[v]] += k[v]
        if not moved:
            return names
        names = {v: c[x] for v, x in names.items()}
        new = {}
        for v, x in graph.items():
            for u, w in x.items():
                new.setdefault(c[v], {})[c[u]] = new.setdefault(c[v], {}).get(c[u], 0) + w
        graph = new


@pytest.mark.parametrize("bridge", [0.1, 1.0])
def test_two_triangles(spark, bridge):
    got = {r.v: r.c for r in communities(frame(spark, [*TRIANGLES, (3, 11, bridge)])).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 11: 11, 12: 11, 13: 11}


def test_ring_of_cliques_splits_into_its_cliques(spark):
    edges = [(10 * k + i, 10 * k + j, 1.0) for k in range(6) for i, j in combinations(range(5), 2)] + [(10 * k, 10 * ((k + 1) % 6) + 1, 1.0) for k in range(6)]
    got = {r.v: r.c for r in communities(frame(spark, edges)).collect()}
    assert all(c == v // 10 * 10 for v, c in got.items()) and len(got) == 30


def test_random_graphs_against_plain_python(spark):
    rng = random.Random(5)
    for groups, size, inside, outside in ((4, 8, 0.8, 0.05),):
        n = groups * size
        edges = [(a, b, float(rng.randint(1, 3))) for a, b in combinations(range(n), 2) if rng.random() < (inside if a // size == b // size else outside)]
        edges += [(v, (v + 1) % n, 1.0) for v in range(n)]
        df = frame(spark, edges)
        labels = communities(df)
        got = {r.v: r.c for r in labels.collect()}
        q = modularity(df, labels)
        assert abs(q - plain_modularity(edges, got)) < 1e-9 and all(got[c] == c <= v for v, c in got.items())
        assert q > 0.95 * plain_modularity(edges, plain_louvain(edges))


def test_modularity_never_falls(spark):
    rng = random.Random(9)
    edges = [(a, b, 1.0) for a, b in combinations(range(16), 2) if rng.random() < 0.25]
    level = Level(both_ways(frame(spark, edges)), 1.0)
    seen, look = [], level.look

    def watched(labels):
        out = look(labels)
        seen.append((out[1], labels))
        return out

    level.look = watched
    assert level.settle()
    best = modularity(frame(spark, edges), level.labels)
    assert best > seen[0][0] and abs(best - max(q for q, _ in seen)) < 1e-9
    for q, labels in seen[:3]:  # what a level believes is what the definition says
        assert abs(q - plain_modularity(edges, {r.v: r.c for r in labels.collect()})) < 1e-9


@pytest.mark.parametrize("resolution", [1.0, 2.5])
def test_every_round_counts(spark, resolution):
    """Links without structure: moves that are good one by one crowd the same communities. No round is to be made in vain, and few are to be enough."""
    rng = random.Random(4)
    edges = [(b, -s, float(rng.randint(10, 30))) for b in range(1, 7) for s in range(1, 61)]
    level = Level(both_ways(frame(spark, edges)), resolution)
    seen, look = [], level.look

    def watched(labels):
        out = look(labels)
        seen.append(out[1])
        return out

    level.look = watched
    assert level.settle()
    assert all(x < y for x, y in zip(seen, seen[1:], strict=False)) and len(seen) < 40
    if resolution == 1.0:
        assert modularity(frame(spark, edges), level.labels) > 0.8 * plain_modularity(edges, plain_louvain(edges))


def test_moves_that_share_a_community_pay_for_each_other(spark):
    edges = [(0, k, 1.0) for k in range(1, 41)] + [(50 + k, k, 2.0) for k in range(1, 41)]
    level = Level(both_ways(frame(spark, edges)), 1.5)
    moves, q, best = level.look(level.labels)
    moves = moves.filter("d = 0")  # each leaf's hub, while a few of them are enough to fill it
    new = {r.v: r.to for r in level.together(moves, moves.v == 7).collect()}
    alone = {r.v: r.gain for r in moves.collect()}
    got = plain_modularity(edges, {v: new.get(v, v) for v in range(91)}, 1.5)
    assert len(alone) == 40 and 7 in new and set(new.values()) == {0} and q < got < q + sum(alone[v] for v in new)
    assert plain_modularity(edges, {v: 0 if v <= 40 else v for v in range(91)}, 1.5) < got


def test_weights_below_zero(spark):
    edges = [*TRIANGLES, (3, 11, -0.5), (20, 1, 1.0), (20, 11, -1.0)]  # the degree of 20 is zero
    got = {r.v: r.c for r in communities(frame(spark, edges)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 11: 11, 12: 11, 13: 11}


def test_paths_hubs_and_resolution(spark):
    path = [(k, k + 1, 1.0) for k in range(8)]
    got = {r.v: r.c for r in communities(frame(spark, path)).collect()}
    assert 2 <= len(set(got.values())) <= 4 and plain_modularity(path, got) > 0.35
    star = [(0, k, 1.0) for k in range(1, 12)]
    assert {r.c for r in communities(frame(spark, star)).collect()} == {0}
    fine = communities(frame(spark, [*TRIANGLES, (3, 11, 1.0)]), resolution=4.0)
    assert fine.select("c").distinct().count() > 2


def test_vertices_without_links_nulls_loops_and_repeats(spark):
    edges = [*TRIANGLES, (3, 11, 0.1), (1, 99, 5.0), (None, 1, 1.0), (7, 7, 2.0), (1, 2, None), (12, 13, 0.0)]
    vertices = spark.createDataFrame([(v,) for v in (1, 2, 3, 7, 11, 12, 13, 50, 50, None)], "v long")
    got = {r.v: r.c for r in communities(frame(spark, edges), vertices).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 11: 11, 12: 11, 13: 11, 50: 50}
    assert communities(frame(spark, [])).collect() == []
    assert {r.v: r.c for r in communities(frame(spark, []), vertices).collect()} == {v: v for v in (1, 2, 3, 7, 11, 12, 13, 50)}


def test_sizes_and_the_query_hold_every_vertex(spark):
    links = supply_links(spark, "/root/testdata/sf0.001")
    labels = communities(links)
    assert sum(r.size for r in sizes(labels, 1).collect()) == links.select("a").union(links.select("b")).distinct().count()
    assert modularity(links, labels) > 0.85 * modularity(links, spark.createDataFrame(list(plain_louvain([tuple(r) for r in links.collect()]).items()), "v long, c long"))


def test_connected(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(200)] + [(rng.randint(300, 500), rng.randint(300, 500)) for _ in range(120)] + [(900, 900), (901, None)]
    seen = {}

    def find(v):
        while seen.setdefault(v, v) != v:
            v = seen[v]
        return v

    for a, b in links:
        if b is not None:
            a, b = sorted((find(a), find(b)))
            seen[b] = a
    got = {r.v: r.c for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {v: find(v) for v in list(seen)}


def test_components_that_cross_pieces(spark, monkeypatch):
    from docloom.operators import graph

    links = [(k, k + 1, k // 7) for k in range(60)] + [(100 + 2 * k, 101 + 2 * k, k) for k in range(20)] + [(500, 500, 1), (None, 3, 1)]
    want = {v: 0 for v in range(61)} | {100 + k: 100 + k // 2 * 2 for k in range(40)} | {500: 500}
    for chunk in (1, 5, 1000):
        monkeypatch.setattr(graph, "CHUNK", chunk)
        for near in ((), ("part",)):
            got = [tuple(r) for r in graph.connected(spark.createDataFrame(links, "a long, b long, part int").repartition(4), near).select("v", "c").collect()]
            assert dict(got) == want and set(got) == set(want.items())
    # what no piece shares needs no rounds
    monkeypatch.setattr(graph, "_connected", None)
    assert len(graph.connected(spark.createDataFrame(links[60:80], "a long, b long, part int"), ("part",)).collect()) == 40
