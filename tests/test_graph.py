import itertools
import random
from collections import defaultdict, deque

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fundgraph.operators import betweenness as BC
from fundgraph.operators import components as CC
from fundgraph.operators import graph as G
from fundgraph.operators import louvain as LV
from fundgraph.operators import pagerank as PR
from fundgraph.operators import similarity as SIM
from fundgraph.operators.relational import to_undirected
from fundgraph.plans import registry


def graph(spark, edges, nodes=(), weight=False):
    e = spark.createDataFrame(edges, "src string, dst string" + (", weight double" if weight else ""))
    ids = sorted({x for t in edges for x in t[:2]} | set(nodes))
    return spark.createDataFrame([(i,) for i in ids], "id string"), e


def random_edges(seed, n, m):
    rnd = random.Random(seed)
    return sorted({(f"n{rnd.randrange(n):02d}", f"n{rnd.randrange(n):02d}") for _ in range(m)})


def plain_pagerank(ids, edges, it=20, d=0.85):
    out = defaultdict(float)
    for a, _, w in edges:
        out[a] += max(w or 0, 0)
    pr = {i: 1 - d for i in ids}
    for _ in range(it):
        new = {i: 1 - d for i in ids}
        for a, b, w in edges:
            if (w or 0) > 0:
                new[b] += d * pr[a] * w / out[a]
        pr = new
    return pr


def test_pagerank_with_hubs_dangling_and_negative_weights(spark):
    rnd = random.Random(4)
    e = [(a, b, rnd.choice([1.0, 2.5, 0.0, -3.0, None])) for a, b in random_edges(4, 20, 60)]
    e += [("hub", f"n{i:02d}", 1.0) for i in range(20)]
    n, df = graph(spark, e, ["alone"], weight=True)
    want = plain_pagerank([r.id for r in n.collect()], e)
    for hub_rows in (3, 10**6):
        got = {r.id: r.pagerank_score for r in PR.pagerank(n, df, "weight", hub_rows=hub_rows).collect()}
        assert got == pytest.approx(want) and got["alone"] == pytest.approx(0.15)


def bfs_betweenness(ids, edges, directed):
    adj = defaultdict(set)
    for a, b in edges:
        if a != b:
            adj[a].add(b)
            if not directed:
                adj[b].add(a)
    score = dict.fromkeys(ids, 0.0)
    for s in ids:
        dist, sigma, order, pred = {s: 0}, defaultdict(float, {s: 1.0}), [], defaultdict(list)
        todo = deque([s])
        while todo:
            v = todo.popleft()
            order.append(v)
            for w in adj[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    todo.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    pred[w].append(v)
        delta = defaultdict(float)
        for w in reversed(order):
            for v in pred[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                score[w] += delta[w]
    return score if directed else {k: v / 2 for k, v in score.items()}


def test_betweenness_of_a_path(spark):
    n, e = graph(spark, [(c, chr(ord(c) + 1)) for c in "abcd"])
    assert rows(BC.betweenness(n, e), "id", "betweenness_score") == [("a", 0.0), ("b", 3.0), ("c", 4.0), ("d", 3.0), ("e", 0.0)]


@pytest.mark.parametrize("directed", [False, True])
def test_betweenness_equals_per_source_search(spark, directed):
    edges = random_edges(7, 14, 28)
    n, e = graph(spark, edges, ["zz"])
    want = bfs_betweenness([r.id for r in n.collect()], edges, directed)
    got = {r.id: r.betweenness_score for r in BC.betweenness(n, e, directed, chunk=9, hub_rows=2).collect()}
    assert got == pytest.approx(want)


def test_sampling_all_nodes_is_exact(spark):
    edges = random_edges(8, 8, 14)
    n, e = graph(spark, edges)
    exact = {r.id: r.betweenness_score for r in BC.betweenness(n, e).collect()}
    assert {r.id: r.betweenness_score for r in BC.betweenness(n, e, sample=99).collect()} == pytest.approx(exact)


def test_betweenness_walks_sources_with_edges_only_and_an_edge_once_a_batch(spark, monkeypatch):
    edges = random_edges(9, 12, 30)
    n, e = graph(spark, edges, [f"lone{i:02d}" for i in range(40)])
    want = bfs_betweenness([r.id for r in n.collect()], edges, False)
    made, inner = [], BC.cut
    monkeypatch.setattr(BC, "cut", lambda df, name="t": made.append((name, out := inner(df, name), out.count())) or out)
    got = {r.id: r.betweenness_score for r in BC.betweenness(n, e, chunk=4).collect()}
    assert got == pytest.approx(want)
    assert sum(name == "bc_part" for name, *_ in made) <= 3
    assert max(rows for name, _, rows in made if name == "bc_level") <= 12
    made.clear()
    alone = BC.betweenness(n, e.filter("src = dst"), chunk=1)
    assert {r.betweenness_score for r in alone.collect()} == {0.0} and alone.count() == n.count()
    assert not [name for name, *_ in made if name == "bc_level"]


def test_pivots_walk_alike_by_tasks_and_by_joins(spark, monkeypatch):
    edges = random_edges(10, 18, 30)
    n, e = graph(spark, edges, ["lone"])
    joined = {r.id: r.betweenness_score for r in BC.betweenness(n, e, sample=5, chunk=99).collect()}
    monkeypatch.setattr(BC, "held", None)
    assert {r.id: r.betweenness_score for r in BC.betweenness(n, e, sample=5).collect()} == pytest.approx(joined)


def closure(edges):
    reach = defaultdict(set)
    for a, b in edges:
        reach[a].add(b)
    changed = True
    while changed:
        changed = False
        for a in list(reach):
            more = set().union(*[reach[b] for b in list(reach[a]) if b in reach]) - reach[a]
            if more:
                reach[a] |= more
                changed = True
    return reach


def test_components_against_reachability(spark):
    edges = random_edges(11, 40, 26)
    n, e = graph(spark, edges, ["lone"])
    reach = closure(edges + [(b, a) for a, b in edges])
    want = {i: min({i} | reach[i]) for i in [r.id for r in n.collect()]}
    assert {r.id: r.component for r in CC.connected_components(e, n).collect()} == want


def test_strong_components_against_reachability(spark):
    edges = random_edges(12, 24, 40)
    n, e = graph(spark, edges, ["lone"])
    reach = closure(edges)
    want = {i: max({i} | {j for j in reach[i] if i in reach[j]}) for i in [r.id for r in n.collect()]}
    assert {r.id: r.component for r in CC.strongly_connected_components(e, n).collect()} == want
    assert len(set(want.values())) < len(want)


def test_only_edges_between_payers_that_are_paid_get_numbers(spark, monkeypatch):
    seen, real = [], CC.encode
    monkeypatch.setattr(CC, "encode", lambda n, e, *x: seen.append(rows(e, "src", "dst")) or real(n, e, *x))
    n, e = graph(spark, [("f1", "m1"), ("f1", "m2"), ("f2", "m1"), ("s", "s")], ["lone"])
    assert rows(CC.strongly_connected_components(e, n), "id", "component") == [(i, i) for i in ("f1", "f2", "lone", "m1", "m2", "s")]
    assert seen == []
    n, e = graph(spark, [("a", "b"), ("b", "a"), ("f", "a"), ("b", "m"), ("f", "m")])
    assert rows(CC.strongly_connected_components(e, n), "id", "component") == [("a", "b"), ("b", "b"), ("f", "f"), ("m", "m")]
    assert seen == [[("a", "b"), ("b", "a")]]


def test_cycle_with_tail_is_flagged(spark):
    n, e = graph(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("c", "t")])
    flags = CC.circular_flag(CC.strongly_connected_components(e, n))
    assert rows(flags, "id", "in_circular_pattern") == [("a", 1), ("b", 1), ("c", 1), ("t", 0)]


def jaccard(sets, cutoff, k):
    out = set()
    for a in sets:
        near = [(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), b) for b in sets if b != a]
        near = sorted([x for x in near if x[0] >= cutoff], key=lambda x: (-x[0], x[1]))
        out |= {(a, b, round(s, 9)) for s, b in near[:k]}
    return out


@pytest.mark.parametrize("cutoff", [0.5, 0.3])
def test_node_similarity_against_all_pairs(spark, cutoff):
    rnd = random.Random(13)
    sets = {f"f{i:02d}": {f"m{rnd.randrange(9)}" for _ in range(rnd.randrange(1, 6))} | {"hot"} for i in range(40)}
    e = spark.createDataFrame([(a, m) for a, s in sets.items() for m in s], "src string, dst string")
    got = {(r.src, r.dst, round(r.similarity_score, 9)) for r in SIM.node_similarity(e, cutoff, 5, block=6).collect()}
    assert got == jaccard(sets, cutoff, 5)


def test_long_and_short_sets_are_compared_alike(spark, monkeypatch):
    """Sets beyond ``longest`` row by row, others as arrays; a pair that shares a late member only is no candidate."""
    rnd = random.Random(17)
    sets = {f"f{i:02d}": {f"m{rnd.randrange(12):02d}" for _ in range(rnd.randrange(1, 9))} for i in range(30)}
    sets |= {"x": {f"m{i}" for i in range(10, 16)} | {f"x{i}" for i in range(6)}, "y": {f"m{i}" for i in range(10, 12)} | {f"y{i}" for i in range(10)}}
    e = spark.createDataFrame([(a, m) for a, s in sets.items() for m in s], "src string, dst string")
    found = {}
    inner = SIM.cut
    monkeypatch.setattr(SIM, "cut", lambda df, name="t": found.setdefault(name, inner(df, name)))
    for longest in (0, 3, 2000):
        found.clear()
        got = {(r.src, r.dst, round(r.similarity_score, 9)) for r in SIM.node_similarity(e, 0.5, 5, 6, longest).collect()}
        assert got == jaccard(sets, 0.5, 5)
        assert ("x", "y") not in {(r.a, r.b) for r in found["candidates"].collect()}


def test_similarity_cutoff_is_inclusive(spark):
    e = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "a")], "src string, dst string")
    assert rows(SIM.node_similarity(e), "src", "dst", "similarity_score") == [("x", "y", 0.5), ("y", "x", 0.5)]


def plain_modularity(edges, comm):
    m2 = 2 * sum(w for *_, w in edges)
    tot, inside = defaultdict(float), 0.0
    for a, b, w in edges:
        tot[comm[a]] += w
        tot[comm[b]] += w
        inside += 2 * w * (comm[a] == comm[b])
    return inside / m2 - sum(t * t for t in tot.values()) / m2**2


def sequential_louvain(edges):
    """Plain local moves and merges, repeated until nothing improves."""
    comm = {x: x for a, b, _ in edges for x in (a, b)}
    while True:
        level = defaultdict(float)
        for a, b, w in edges:
            level[comm[a], comm[b]] += w
            level[comm[b], comm[a]] += w
        nodes = sorted({a for a, _ in level})
        k = defaultdict(float)
        for (a, _), w in level.items():
            k[a] += w
        m2, c, tot = sum(k.values()), {n: n for n in nodes}, dict(k)
        moved_any, moved = False, True
        while moved:
            moved = False
            for n in nodes:
                link = defaultdict(float, {c[n]: 0.0})
                for (a, b), w in level.items():
                    if a == n and b != n:
                        link[c[b]] += w
                tot[c[n]] -= k[n]
                best = max(sorted(link), key=lambda x: link[x] - k[n] * tot[x] / m2)
                if link[best] - k[n] * tot[best] / m2 > link[c[n]] - k[n] * tot[c[n]] / m2 + 1e-12:
                    c[n], moved, moved_any = best, True, True
                tot[c[n]] += k[n]
        comm = {x: c[y] for x, y in comm.items()}
        if not moved_any:
            return comm


def test_louvain_two_cliques_and_a_bridge(spark):
    e = [(a, b) for g in ("abcd", "wxyz") for a, b in itertools.combinations(g, 2)] + [("d", "w")]
    n, df = graph(spark, e, ["lone"])
    got = {r.id: r.community_id for r in LV.louvain(n, df).collect()}
    assert len({got[c] for c in "abcd"}) == 1 and len({got[c] for c in "wxyz"}) == 1
    assert got["a"] != got["z"] and got["lone"] == "lone"


def test_louvain_moves_alike_with_and_without_broadcast_communities(spark, monkeypatch):
    rnd = random.Random(8)
    e = sorted({(f"n{rnd.randrange(50):02d}", f"n{rnd.randrange(50):02d}", float(rnd.randrange(1, 4))) for _ in range(140)} | {("z", "z", 2.0)})
    n, df = graph(spark, e, ["lone"], weight=True)
    found = []
    for limit in (LV.NEAR_NODES, 0):
        monkeypatch.setattr(LV, "NEAR_NODES", limit)
        found.append(rows(LV.louvain(n, df, "weight"), "id", "community_id"))
    assert found[0] == found[1] and len({c for _, c in found[0]}) < 40


def test_louvain_quality_and_repeatability(spark):
    rnd = random.Random(6)
    ids = [f"n{i:02d}" for i in range(60)]
    pairs = {(a, b): (3.0 if int(a[1:]) // 15 == int(b[1:]) // 15 else 1.0) for a, b in itertools.combinations(ids, 2)
             if rnd.random() < (0.4 if int(a[1:]) // 15 == int(b[1:]) // 15 else 0.05)}
    e = [(a, b, w) for (a, b), w in pairs.items()]
    n, df = graph(spark, e, weight=True)
    out = LV.louvain(n, df, "weight", hub_rows=8)
    comm = {r.id: r.community_id for r in out.collect()}
    q = plain_modularity(e, comm)
    assert q >= 0.98 * plain_modularity(e, sequential_louvain(e))
    assert LV.modularity(df, out, "weight").first().modularity == pytest.approx(q)
    assert comm == {r.id: r.community_id for r in LV.louvain(n, df, "weight").collect()}


def test_build_project_and_export(spark):
    funds = spark.createDataFrame([("1", "7", "p", "s", "DFE", 5, "a", "NY")], "ack_id string, ein string, plan_name string, sponsor_name string, fund_type string, num_participants int, admin_name string, state string")
    mgr = spark.createDataFrame([("7", "A", 1.0, 1), ("7", "B", 2.0, 2), ("8", "C", 3.0, 1)], "ein string, name string, total_fees double, num_clients int")
    fm = spark.createDataFrame([("7", "8", 5.0, 1), ("7", "8", 6.0, 2), ("7", "7", 1.0, 3), ("7", "404", 1.0, 4)], "fund_ein string, manager_ein string, fee_paid double, pos int")
    g = G.build_graph(funds, mgr, fm, edge_order=("pos",))
    assert rows(g.nodes, "id", "name") == [("AssetManager:7", "B"), ("AssetManager:8", "C"), ("PensionFund:7", "p")]
    assert rows(g.edges, "src", "dst", "weight") == [("PensionFund:7", "AssetManager:7", 1.0), ("PensionFund:7", "AssetManager:8", 6.0)]
    total = G.build_graph(funds, mgr, fm, edge_order=("pos",), fees="sum")
    assert max(r.weight for r in total.edges.collect()) == 11.0
    assert rows(G.project(g, [G.FUND, G.MANAGER], {G.ALLOCATED: "REVERSE"}).edges, "src", "dst")[0] == ("AssetManager:7", "PensionFund:7")
    assert G.project(g, [G.FUND, G.MANAGER], {G.ALLOCATED: "UNDIRECTED"}).edges.count() == 4
    assert G.induced(g, [G.MANAGER]).edges.count() == 0
    scored = G.with_property(g.nodes, spark.createDataFrame([("AssetManager:8", 0.4)], "id string, pagerank_score double"))
    assert rows(G.manager_scores(scored).fillna(-1.0, ["pagerank_score"]), "ein", "pagerank_score") == [("7", -1.0), ("8", 0.4)]
    assert G.fund_scores(scored).columns[0] == "ein" and len(G.fund_scores(scored).columns) == 9
    assert rows(to_undirected(g.edges, rel="rel"), "rel") == [("forward",)] * 2 + [("reverse",)] * 2


def test_exact_betweenness_of_funds_has_all_sources(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        spark.read.parquet(f"{source}/{name}.parquet").filter(F.col(key) % 25 == 0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in "customer supplier part nation region labels".split():
        (tmp_path / f"{name}.parquet").symlink_to(f"{source}/{name}.parquet")
    g = registry.shared_graph(spark, str(tmp_path))
    want = bfs_betweenness([r.id for r in g.nodes.collect()], [(r.src, r.dst) for r in g.edges.collect()], False)
    got = {r.id: r.betweenness_score for r in registry.QUERIES["betweenness_funds_exact"](spark, str(tmp_path)).collect()}
    assert got == pytest.approx(want) and len(got) > 16 and any(got.values())


def test_rounds_of_a_small_level_send_no_link(spark, monkeypatch):
    """Links are packed once a level, a source in one row whatever the size of a row."""
    rnd = random.Random(15)
    e = sorted({(f"n{rnd.randrange(30):02d}", f"n{rnd.randrange(30):02d}", float(rnd.randrange(1, 4))) for _ in range(90)})
    n, df = graph(spark, e, weight=True)
    want = rows(LV.louvain(n, df, "weight"), "id", "community_id")
    packs, inner = [], LV._packed
    monkeypatch.setattr(LV, "_packed", lambda links: packs.append(inner(links)) or packs[-1])
    monkeypatch.setattr(LV, "PACK", 3)
    monkeypatch.setattr(LV, "_far_moves", None)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert rows(LV.louvain(n, df, "weight"), "id", "community_id") == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert 1 <= len(packs) <= 5
