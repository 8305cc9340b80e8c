import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paywatch.operators import graph as g
from paywatch.operators import risk
from paywatch.operators.communities import communities, modularity
from paywatch.operators.components import component_sizes, connected_components
from paywatch.operators.pagerank import link_counts, pagerank, pagerank_bipartite, pagerank_power
from paywatch.operators import communities as community_steps, triangles as triangle_steps
from paywatch.operators.triangles import triangles
from paywatch.session import Scratch

SCORED = (
    "transaction_id string, user_id string, account_id string, merchant_id string, amount double, timestamp string, "
    "fraud_probability double, anomaly_score double"
)


@pytest.fixture
def scored(rows):
    return rows(
        SCORED,
        ("1", "u", None, "m", 10.0, "2024-01-01", 0.9, 1.0),
        (" 1 ", "lonely", None, "m", 11.0, "2024-01-02", 0.1, 0.0),
        ("2", " \t", "a", "m", 0.0, "2024-01-01", float("nan"), -4.0),
        (None, "u", None, "n", 3.0, "2024-01-01", None, None),
        (None, "u", None, "n", 3.0, "2024-01-01", None, None),
        ("3", None, None, "m", 1.0, "2024-01-01", 0.5, 0.5),
        ("4", "u", None, " ", 1.0, "2024-01-01", 0.5, 0.5),
    )


def test_edges_first_row_wins_and_missing_ids_stay(scored):
    found = g.graph_edges(scored)
    assert found.count() == 4
    assert found.where("transaction_id = '1'").first()["src"] == "customer:u"
    assert found.where("transaction_id IS NULL").select("edge_key").distinct().count() == 2
    assert found.where("transaction_id = '2'").first()["fraud_probability"] is None


def test_repeat_still_adds_its_nodes(scored):
    found = {r["node_id"]: r for r in g.graph_nodes(scored).collect()}
    assert set(found) == {"customer:u", "customer:lonely", "customer:a", "merchant:m", "merchant:n"}
    assert (found["customer:a"]["node_type"], found["customer:a"]["entity_id"]) == ("customer", "a")


def test_update_stats(scored, rows):
    edges, nodes = g.graph_edges(scored), g.graph_nodes(scored)
    more = rows(SCORED, ("1", "u", None, "m", 1.0, "x", 0.0, 0.0), ("9", "z", None, "m", 1.0, "x", 0.0, 0.0))
    stats = g.graph_update_stats(more, nodes, edges).first().asDict()
    assert stats == {
        "processed_rows": 2, "skipped_rows": 0, "new_nodes": 1, "new_edges": 1, "total_nodes": 6, "total_edges": 5,
    }


def test_projection_counts_zero_amount_as_one(scored):
    weights = {(r["node_a"], r["node_b"]): r["weight"] for r in g.weighted_projection(g.graph_edges(scored)).collect()}
    assert weights[("customer:a", "merchant:m")] == 1.0
    assert weights[("customer:u", "merchant:n")] == 6.0


def dense_pagerank(links, damping=0.85):
    names = sorted({n for link in links for n in link})
    at = {n: i for i, n in enumerate(names)}
    flow = np.zeros((len(names), len(names)))
    for a, b in links:
        flow[at[a], at[b]] += 1
    out = flow.sum(axis=1)
    x = np.full(len(names), 1 / len(names))
    for _ in range(500):
        share = np.divide(flow, out[:, None], out=np.zeros_like(flow), where=out[:, None] > 0)
        x = damping * (x @ share + x[out == 0].sum() / len(names)) + (1 - damping) / len(names)
    return dict(zip(names, x))


def test_pagerank_on_any_graph(rows):
    rng = random.Random(1)
    links = [(f"n{rng.randrange(12)}", f"n{rng.randrange(15)}") for _ in range(40)]
    frame = rows("src string, dst string", *links)
    found = {r["node_id"]: r["pagerank_score"] for r in pagerank_power(link_counts(frame), tolerance=1e-9).collect()}
    expected = dense_pagerank(links)
    assert found.keys() == expected.keys()
    assert all(abs(found[n] - expected[n]) < 1e-6 for n in expected)
    assert abs(sum(found.values()) - 1.0) < 1e-6


def test_pagerank_closed_form_agrees(rows):
    rng = random.Random(2)
    links = [(f"c{rng.randrange(9)}", f"m{rng.randrange(5)}") for _ in range(30)]
    frame = rows("src string, dst string", *links)
    exact = {r["node_id"]: r["pagerank_score"] for r in pagerank_bipartite(link_counts(frame)).collect()}
    expected = dense_pagerank(links)
    assert all(abs(exact[n] - expected[n]) < 1e-9 for n in expected)
    chosen = {r["node_id"]: r["pagerank_score"] for r in pagerank(frame).collect()}
    assert all(abs(chosen[n] - exact[n]) < 1e-12 for n in exact)


def brute_components(links):
    label = {n: n for link in links for n in link}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_components_of_chains_stars_and_random_graphs(rows):
    rng = random.Random(3)
    links = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    links += [("hub", f"h{i}") for i in range(30)]
    links += [(f"r{rng.randrange(60)}", f"r{rng.randrange(60)}") for _ in range(35)]
    frame = rows("src string, dst string", *links)
    found = {r["node_id"]: r["component_id"] for r in connected_components(frame).collect()}
    expected = {n: c for n, c in brute_components(links).items()}
    alone = {a for a, b in links if a == b}
    assert {n: c for n, c in expected.items() if n in found} == found
    assert set(expected) - set(found) <= alone


def test_node_without_edges_is_its_own_component(rows):
    nodes = rows("node_id string", ("a",), ("b",), ("c",))
    found = connected_components(rows("src string, dst string", ("b", "c")), nodes)
    assert {r["node_id"]: r["component_id"] for r in found.collect()} == {"a": "a", "b": "b", "c": "b"}
    sizes = {r["component_id"]: r["component_size"] for r in component_sizes(found).collect()}
    assert sizes == {"a": 1, "b": 2}


def test_triangles_match_brute_force(rows):
    rng = random.Random(4)
    links = [(f"n{rng.randrange(20)}", f"n{rng.randrange(20)}") for _ in range(90)] + [("hub", f"n{i}") for i in range(20)]
    pairs = {frozenset(link) for link in links if link[0] != link[1]}
    expected = {n: 0 for link in links for n in link}
    for corners in itertools.combinations(sorted(expected), 3):
        if all(frozenset(p) in pairs for p in itertools.combinations(corners, 2)):
            for n in corners:
                expected[n] += 1
    found = {r["node_id"]: r["triangle_count"] for r in triangles(rows("src string, dst string", *links)).collect()}
    assert found == expected and sum(found.values()) > 0


def brute_triangles(links):
    near: dict = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    return {n: sum(len(near[n] & near[m]) for m in near[n]) // 2 for n in near}


@pytest.mark.parametrize("chunk", [1, 4, 1024])
def test_triangles_of_hubs_in_chunks(rows, monkeypatch, chunk):
    """Small chunks cut the lists of the hubs into many, of different numbers at the two ends of a pair."""
    monkeypatch.setattr(triangle_steps, "CHUNK", chunk)
    rng = random.Random(6)
    links = {("hub", f"n{i}") for i in range(60)} | {("second", f"n{i}") for i in range(0, 60, 2)} | {("hub", "second")}
    links |= {tuple(sorted((f"n{rng.randrange(60)}", f"n{rng.randrange(60)}"))) for _ in range(300)}
    core = [f"c{i}" for i in range(14)]
    links |= set(itertools.combinations(core, 2)) | {("hub", c) for c in core}
    links = {(a, b) for a, b in links if a != b}
    found = triangles(rows("src string, dst string", *sorted(links)))
    assert {r["node_id"]: r["triangle_count"] for r in found.collect()} == brute_triangles(links)


def test_chunks_are_bounded_and_single_targets_stay_behind(spark, rows, monkeypatch):
    monkeypatch.setattr(triangle_steps, "CHUNK", 8)
    arcs = rows("low long, high long", *[(k, 1000 + j) for k in range(3) for j in range(64)], *[(100 + k, 0) for k in range(500)])
    sized = triangle_steps._sized(arcs, 1000)
    chunks = sized.where("low < 3").groupBy("low", triangle_steps._chunk_of("high", F.col("low_chunks")).alias("chunk")).count()
    assert chunks.count() == 3 * 8 and chunks.agg(F.max("count")).first()[0] <= 3 * 8
    # none of the 500 arcs with a single target may be shipped anywhere
    assert sized.where("low_size > 1 AND high_size IS NOT NULL").isEmpty()


def test_only_targets_that_both_ends_may_share_move(spark, rows):
    """Of the long list of the high end, few targets go to a low end that shares none or one of them."""
    long_list = [("b0", f"t{j:03d}") for j in range(200)]
    links = long_list + [(f"a{i}", "b0") for i in range(40)] + [(f"a{i}", f"u{i}{j}") for i in range(40) for j in range(6)] + [("a0", "t000")]
    links += [(f"t{j:03d}", f"x{k}") for j in range(200) for k in range(220)]  # targets rank above the hub
    edges = rows("src string, dst string", *links)
    pairs = triangle_steps._all_pairs(edges)
    numbered = triangle_steps._numbered(triangle_steps._ranked(pairs))
    assert numbered.schema["number"].dataType.simpleString() == "int"
    numbers = {r["node"]: r["number"] for r in numbered.collect()}
    assert sorted(numbers.values()) == list(range(len(numbers)))
    signed = spark.createDataFrame([(n,) for n in range(6)], "t int").agg(triangle_steps._signature("t").alias("s"))
    kept = signed.select(F.filter(F.sequence(F.lit(0), F.lit(999)), lambda t: triangle_steps._may_hold("s", t)).alias("k")).first()["k"]
    assert set(range(6)) <= set(kept) and len(kept) < 100
    found = {r["node_id"]: r["triangle_count"] for r in triangles(edges).collect()}
    assert {n for n, c in found.items() if c} == {"a0", "b0", "t000"}


def test_nodes_of_loops_and_missing_ends_are_kept(rows):
    links = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "d"), ("e", None), (None, "a"), ("c", "c")]
    found = [(r["node_id"], r["triangle_count"]) for r in triangles(rows("src string, dst string", *links)).collect()]
    assert sorted(found, key=str) == sorted([("a", 1), ("b", 1), ("c", 1), ("d", 0), ("e", 0), (None, 0)], key=str)


def test_bipartite_graph_has_no_triangles(rows):
    frame = rows("src string, dst string", *[(f"c{i}", f"m{j}") for i in range(4) for j in range(3)])
    assert triangles(frame).where("triangle_count > 0").isEmpty()


def test_communities_find_planted_groups(rows):
    links = []
    for group in range(3):
        members = [f"g{group}n{i}" for i in range(6)]
        links += [(a, b, 5.0) for a, b in itertools.combinations(members, 2)]
    links += [("g0n0", "g1n0", 1.0), ("g1n1", "g2n1", 1.0)]
    frame = rows("src string, dst string, amount double", *links)
    found = communities(frame)
    by_node = {r["node_id"]: r["community_id"] for r in found.collect()}
    assert by_node == {n: f"{n[:2]}n0" for n in by_node} and len(by_node) == 18
    singles = found.select("node_id", F.col("node_id").alias("community_id"))
    assert modularity(frame, found).first()[0] > 0.6 > modularity(frame, singles).first()[0]


def test_communities_without_edges(rows):
    found = communities(rows("src string, dst string, amount double", ("a", "b", 1.0)).where("false"), rows("node_id string", ("x",)))
    assert [tuple(r) for r in found.collect()] == [("x", "x")]


def test_edge_risk(rows):
    frame = rows("fraud_probability double, anomaly_score double", (2.0, 1.0), (0.5, -3.0), (None, None), (float("nan"), 1.0))
    found = [round(r[0], 6) for r in frame.select(risk.edge_risk()).collect()]
    assert found == [0.85, 0.35, 0.0, 0.15]


def test_risk_spreads_to_distinct_neighbours(rows):
    base = rows("node_id string, base_risk double", ("a", 1.0), ("b", 0.0), ("c", 0.5), ("d", 0.4))
    edges = rows("src string, dst string", ("a", "b"), ("a", "b"), ("c", "b"))
    found = {r["node_id"]: round(r["propagated_risk_score"], 6) for r in risk.risk_propagation(base, edges).collect()}
    assert found == {"a": 0.7, "b": 0.225, "c": 0.35, "d": 0.4}


def test_attached_signals(rows, scored):
    signals = rows(
        "node_id string, pagerank_score double, community_id string, triangle_count long, component_id string, "
        "component_size long, propagated_risk_score double",
        ("customer:u", 0.2, "x", 1, "x", 3, 0.4),
        ("merchant:m", 0.6, "y", 2, "y", 2, 0.9),
    )
    out = risk.attach_graph_signals(scored, signals)
    assert out.count() == 7
    found = {r["transaction_id"]: r for r in out.where("transaction_id IS NOT NULL").collect()}
    assert (found["1"]["pagerank_score"], found["1"]["community_id"], found["1"]["component_size"]) == (0.2, "x", 3)
    assert (found["1"]["triangle_count"], found["1"]["propagated_risk_score"]) == (2, 0.9)
    assert (found["3"]["pagerank_score"], found["3"]["community_id"]) == (0.0, "y")
    assert (found["4"]["component_id"], found["4"]["propagated_risk_score"]) == ("x", 0.4)


def test_few_nodes_of_a_kind_move_no_rows(scored, rows, monkeypatch):
    """Nodes are counted by kind, so a few merchants are broadcast even when there are many customers."""
    from paywatch.operators import risk, skew

    schema = (
        "node_id string, pagerank_score double, community_id string, triangle_count long, component_id string, "
        "component_size long, propagated_risk_score double"
    )
    nodes = [(f"customer:{c}", 0.2, "x", 1, "x", 3, 0.3) for c in ("u", "a", "b")] + [("merchant:m", 0.1, "y", 2, "x", 3, 0.4)]
    seen = []
    join = skew.join_lookup

    def watched(*args, **options):
        seen.append((args[2], options.get("lookup_rows")))
        return join(*args, **options)

    monkeypatch.setattr(risk, "join_lookup", watched)
    out = risk.attach_graph_signals(scored, rows(schema, *nodes))
    assert seen == [(["src"], 3), (["dst"], 1)] and out.count() == scored.count()


def test_pagerank_counts_nodes_without_edges(rows):
    """A repeated transaction adds its customer, but no edge."""
    from paywatch.operators.graph import graph_edges, graph_nodes

    frame = rows(
        "transaction_id string, user_id string, account_id string, merchant_id string, amount double, timestamp string,"
        " fraud_probability double, anomaly_score double",
        ("1", "u", None, "m", 5.0, "2024-01-01T00:00:00", 0.5, 0.0),
        ("1", "lonely", None, "m", 5.0, "2024-01-02T00:00:00", 0.5, 0.0),
    )
    edges, nodes = graph_edges(frame), graph_nodes(frame)
    for found in (pagerank(edges, nodes), pagerank_power(link_counts(edges), nodes, tolerance=1e-10)):
        ranks = {r["node_id"]: r["pagerank_score"] for r in found.collect()}
        assert ranks == pytest.approx({"customer:u": 1 / 3.85, "merchant:m": 1.85 / 3.85, "customer:lonely": 1 / 3.85}, abs=1e-6)


def test_pagerank_of_many_sources_and_few_targets(rows):
    """Nearly all nodes are sources: the even share settles slowly when it is iterated too."""
    links = [(f"c{i}", f"m{i % 2}") for i in range(200)]
    frame = rows("src string, dst string", *links)
    expected = dense_pagerank(links)
    found = {r["node_id"]: r["pagerank_score"] for r in pagerank_power(link_counts(frame), tolerance=1e-12).collect()}
    assert found == pytest.approx(expected, abs=1e-9)


def test_no_node_gains_after_communities(rows):
    """Two cliques with a bridge, and a star: the best answer is known."""
    links = [(a, b) for group in ("abcd", "wxyz") for a in group for b in group if a < b] + [("d", "w")] + [("s", f"t{i}") for i in range(4)]
    frame = rows("src string, dst string, amount double", *[(a, b, 1.0) for a, b in links])
    groups: dict = {}
    for r in communities(frame).collect():
        groups.setdefault(r["community_id"], set()).add(r["node_id"])
    assert sorted(map(sorted, groups.values())) == [list("abcd"), ["s", "t0", "t1", "t2", "t3"], list("wxyz")]


def ring_with_chords(size, chords, seed=3):
    rng = random.Random(seed)
    links = {(i, (i + 1) % size) for i in range(size)} | {(rng.randrange(size), rng.randrange(size)) for _ in range(chords)}
    return sorted({(f"n{min(a, b):03d}", f"n{max(a, b):03d}", 1.0) for a, b in links if a != b})


def sequential_louvain(links):
    """Plain Louvain: nodes one after the other, levels until nothing gains; the modularity reached."""
    weight: dict = {}
    for a, b, w in links:
        weight.setdefault(a, {})[b] = weight.setdefault(b, {})[a] = w
    total, best = sum(sum(n.values()) for n in weight.values()), -1.0
    while True:
        strength = {a: sum(n.values()) for a, n in weight.items()}
        group, sums = {a: a for a in weight}, dict(strength)
        moved = True
        while moved:
            moved = False
            for a in sorted(weight):
                towards: dict = {group[a]: 0.0}
                for b, w in weight[a].items():
                    if b != a:
                        towards[group[b]] = towards.get(group[b], 0.0) + w
                sums[group[a]] -= strength[a]
                choice = max(towards, key=lambda c: (towards[c] - strength[a] * sums[c] / total, c == group[a]))
                moved |= choice != group[a]
                group[a] = choice
                sums[choice] += strength[a]
        inside = sum(w for a, n in weight.items() for b, w in n.items() if group[a] == group[b])
        quality = inside / total - sum(s * s for s in sums.values()) / total**2
        if quality <= best + 1e-7:
            return best
        best, merged = quality, {}
        for a, n in weight.items():
            for b, w in n.items():
                row = merged.setdefault(group[a], {})
                row[group[b]] = row.get(group[b], 0.0) + w
        weight = merged


def test_rounds_of_moves_that_cannot_clash(spark, rows, monkeypatch):
    """Their share of moves grows again, two versions of the moves are kept, and quality is that of plain Louvain."""
    links = ring_with_chords(100, 50)
    frame = rows("src string, dst string, amount double", *links)
    kept = []
    written = Scratch.write_with

    def watched(self, df, table, *args, **metrics):
        out = written(self, df, table, *args, **metrics)
        if table.startswith("moves"):
            kept.append(len(self._written[table]))
        return out

    settle, shares = community_steps._settle, []

    def recorded(*args):
        out = settle(*args)
        shares.append(out[3])
        return out

    monkeypatch.setattr(Scratch, "write_with", watched)
    monkeypatch.setattr(community_steps, "_settle", recorded)
    monkeypatch.setattr(community_steps, "LEAST_MOVES", 1000)  # every failed round is followed by such a one
    found = communities(frame)
    assert max(kept) <= 2 and max(map(len, shares)) < 60
    assert any(a == 0.0 and b > 0.0 for level in shares for a, b in zip(level, level[1:]))
    assert modularity(frame, found).first()[0] >= 0.99 * sequential_louvain(links)


def test_independent_moves_share_no_community(rows):
    moves = rows(
        "node string, community string, target string, gain double",
        ("a", "A", "B", 3.0), ("b", "B", "C", 2.0), ("c", "C", "D", 1.0), ("d", "E", "F", 1.0), ("e", "F", "E", 1.0), ("f", "G", "H", 0.0),
    )
    found = sorted(map(tuple, community_steps._independent(moves, 1e-9, 6).collect()))
    assert found == [("a", "B"), ("e", "E")]  # c waits: b, which is better for its community, waits for a


def test_single_links_are_followed_before_the_first_round(rows, monkeypatch):
    """Stars, an isolated link, a self loop and a pendant of a triangle: rounds see the other nodes only."""
    links = [("hub", f"l{i}") for i in range(9)] + [("p", "q"), ("s", "s"), ("s", "t"), ("x", "y"), ("y", "z"), ("x", "z"), ("z", "end")]
    frame = rows("src string, dst string, amount double", *[(a, b, 1.0) for a, b in links])
    sizes, settle = [], community_steps._settle

    def recorded(*args):
        out = settle(*args)
        sizes.append((out[2], len(out[3])))
        return out

    monkeypatch.setattr(community_steps, "_settle", recorded)
    groups: dict = {}
    for r in communities(frame).collect():
        groups.setdefault(r["community_id"], set()).add(r["node_id"])
    assert {k: "".join(sorted(v)) for k, v in groups.items()} == {
        "hub": "hub" + "".join(f"l{i}" for i in range(9)), "p": "pq", "s": "st", "end": "endxyz"
    }
    assert sizes[0][0] == 6  # hub, p, s, x, y, z


def test_rounds_move_numbers_not_names(rows, monkeypatch):
    """Arcs carry numbers in the order of the names; former communities may be named by nodes that are gone."""
    links = [(a, b, 1.0) for group in ("bcd", "xyz") for a, b in itertools.combinations(group, 2)] + [("d", "x", 0.1)]
    kinds, settle = [], community_steps._settle

    def recorded(*args):
        kinds.append([t for _, t in args[1].select("node", "neighbour").dtypes])
        return settle(*args)

    monkeypatch.setattr(community_steps, "_settle", recorded)
    frame = rows("src string, dst string, amount double", *links)
    former = rows("node_id string, community_id string", ("b", "a"), ("c", "a"), ("gone", "a"), ("x", "x"))
    for start in (None, former):
        found = sorted(map(tuple, communities(frame, start=start).collect()))
        assert found == [("b", "b"), ("c", "b"), ("d", "b"), ("x", "x"), ("y", "x"), ("z", "x")]
    assert kinds and all(k == ["bigint", "bigint"] for k in kinds)


def test_communities_of_a_graph_that_grew(rows):
    """Starting from the former communities gives as good ones as starting anew."""
    links = ring_with_chords(60, 25)
    schema = "src string, dst string, amount double"
    before, after = rows(schema, *links[: len(links) // 2]), rows(schema, *links)
    grown = communities(after, start=communities(before))
    assert {r[0] for r in grown.select("node_id").collect()} == {n for a, b, _ in links for n in (a, b)}
    assert modularity(after, grown).first()[0] >= 0.97 * modularity(after, communities(after)).first()[0]
    assert grown.groupBy("community_id").agg(F.min("node_id").alias("first")).where("first != community_id").isEmpty()


def test_triangles_free_what_no_step_reads_any_more(spark, rows):
    """Of the tables between steps only those of nodes are left, and no shuffle files of the steps."""
    from pathlib import Path

    from paywatch.operators.triangles import triangles
    from paywatch.session import scratch_root

    def left():
        folders = set(Path(scratch_root(spark)).glob("paywatch/triangles-*")) - old
        return {p.name.split("-")[0] for folder in folders for p in folder.iterdir()}

    def shuffled():
        return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
            spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}

    old = set(Path(scratch_root(spark)).glob("paywatch/triangles-*"))
    edges = rows("src string, dst string", ("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"))
    before = shuffled()
    found = triangles(edges)
    assert not shuffled() - before
    assert left() == {"numbered", "alone", "counts"}
    assert sorted(map(tuple, found.collect())) == [("a", 1), ("b", 1), ("c", 1), ("d", 0)]
