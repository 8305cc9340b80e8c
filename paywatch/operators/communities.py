"""Weighted Louvain communities as rounds of DataFrame jobs.

A round lets a random half of the nodes move to the neighbouring community with the best gain in
modularity, all at once. A round that does not raise modularity is taken back and tried again with a
quarter as many nodes, and in the end with moves that cannot clash: each community takes part in one of
them at most, as the one that is left or the one that is joined. Gains of such moves add up exactly, so
that round always raises modularity, and afterwards the share of nodes that may move grows again. A level
ends only when no node gains anything. Settled communities become the nodes of a smaller graph, and so on
until nothing improves.

A node with a single link is best off with the node it hangs on, whatever the rest of the graph is like
(Lu et al., 2015: vertex following). Such nodes join it before the first round, in one pass, and only the
others take part in the rounds.

A graph that grew starts from the communities it had before; only its new nodes begin alone.

Nodes and communities go by numbers in the order of their names: every round moves, groups and sorts rows of
all links, which take half the room so and are sorted as numbers. Names come back at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paywatch.operators.graph import both_directions, weighted_projection
from paywatch.operators.skew import BROADCAST_ROWS, Heavy, heavy_keys, join_lookup
from paywatch.session import Scratch

SEED = 42

# Fixed value: gain in modularity below which a move, or another level, is not worth it.
THRESHOLD = 1e-7

# Gaining nodes that may move at once, after a round of moves that cannot clash.
LEAST_MOVES = 4


def _arcs(edges: DataFrame) -> DataFrame:
    """Weighted pairs in both directions, and one loop per node with twice the weight of its self loops."""
    return _arcs_of(weighted_projection(edges))


def _arcs_of(pairs: DataFrame) -> DataFrame:
    proper = pairs.where(F.col("node_a") != F.col("node_b"))
    loops = (
        pairs.select(
            F.explode(F.array("node_a", "node_b")).alias("node"),
            F.when(F.col("node_a") == F.col("node_b"), F.col("weight")).otherwise(0.0).alias("weight"),
        )
        .groupBy("node")
        .agg(F.sum("weight").alias("weight"))
        .select("node", F.col("node").alias("neighbour"), "weight")
    )
    return both_directions(proper, "node_a", "node_b", "weight").unionByName(loops)


def _numbered(scratch: Scratch, pairs: DataFrame, start: DataFrame | None) -> tuple[DataFrame, int]:
    """name and node, a number that rises with the name, of all nodes and former communities; and how many these are."""
    names = pairs.select(F.explode(F.array("node_a", "node_b")).alias("name"))
    if start is not None:
        names = names.unionByName(start.select(F.col("community").alias("name")))
    ranked = scratch.write(names.where("name is not null").distinct(), "names").orderBy("name")
    numbers, seen = scratch.write_with(
        ranked.select("name", F.monotonically_increasing_id().alias("node")), "numbers", rows=F.count(F.lit(1))
    )
    return numbers, seen["rows"]


def _by_number(rows: DataFrame, columns: list[str], numbers: DataFrame, named: int) -> DataFrame:
    """The rows with numbers instead of names in the given columns."""
    out = rows
    for column in columns:
        lookup = numbers.select(F.col("name").alias(column), F.col("node").alias("_number"))
        out = join_lookup(out, lookup, [column], count_from=rows, lookup_rows=named)
        out = out.withColumn(column, F.col("_number")).drop("_number")
    return out.select(*rows.columns)


def _clustered(arcs: DataFrame) -> DataFrame:
    """Arcs of a node side by side, so that tasks add most of them up before a shuffle; those of a hub lie in many parts."""
    return arcs.repartitionByRange("node", "neighbour").sortWithinPartitions("node")


def _followers(pairs: DataFrame) -> DataFrame:
    """The pairs with `follower`: the end that has no other link, of two such ends the larger name; else null.

    A pair is the only one of its follower, so the mark comes back by both names and no hub gathers rows.
    """
    hanging = (
        both_directions(pairs, "node_a", "node_b", "weight")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("links"), F.min("neighbour").alias("neighbour"), F.min("weight").alias("weight"))
        .where((F.col("links") == 1) & (F.col("weight") > 0))  # a self loop stands there twice
    )
    marks = hanging.groupBy(F.least("node", "neighbour").alias("node_a"), F.greatest("node", "neighbour").alias("node_b")).agg(
        F.max("node").alias("follower")
    )
    return pairs.join(marks, ["node_a", "node_b"], "left")


def _without_followers(marked: DataFrame) -> DataFrame:
    """The pairs of the other nodes; the link of a follower becomes a self loop of the node it hangs on."""
    leader = F.when(F.col("follower") == F.col("node_a"), F.col("node_b")).otherwise(F.col("node_a"))
    ends = [F.when(F.col("follower").isNull(), F.col(c)).otherwise(leader).alias(c) for c in ("node_a", "node_b")]
    return marked.select(*ends, "weight").groupBy("node_a", "node_b").agg(F.sum("weight").alias("weight"))


def _state(labels: DataFrame, rows: int) -> DataFrame:
    """Labels with the total strength and the number of members of their community."""
    totals = labels.groupBy("community").agg(F.sum("strength").alias("total"), F.count(F.lit(1)).alias("members"))
    return join_lookup(labels, totals, ["community"], total_rows=rows, lookup_rows=rows)


def _moves(
    arcs: DataFrame, state: DataFrame, weight: float, arc_rows: int, node_rows: int, heavy: tuple[Heavy, Heavy] | None
) -> DataFrame:
    """Per node: its community, the weight it has towards it, and the best other community with its gain.

    The loop every node has keeps its own community among the options. `heavy` are the nodes of very many arcs,
    as `neighbour` and as `node`.
    """
    of_neighbour, of_node = heavy or (None, None)
    # the same columns in the same order, so that one broadcast serves both joins
    theirs = state.select(
        F.col("node").alias("neighbour"), "community", F.col("strength").alias("_strength"), "total", "members"
    )
    own = state.select(
        "node",
        F.col("community").alias("own"),
        "strength",
        F.col("total").alias("own_total"),
        F.col("members").alias("own_members"),
    )
    link = F.when(F.col("node") == F.col("neighbour"), 0.0).otherwise(F.col("weight"))
    towards = (
        join_lookup(arcs, theirs, ["neighbour"], total_rows=arc_rows, lookup_rows=node_rows, heavy=of_neighbour)
        .groupBy("node", "community")
        .agg(F.sum(link).alias("towards"), F.max("total").alias("total"), F.max("members").alias("members"))
    )
    options = join_lookup(towards, own, ["node"], total_rows=arc_rows, lookup_rows=node_rows, heavy=of_node)
    # two single nodes would swap for ever: only the one with the larger name may move
    allowed = (F.col("community") != F.col("own")) & ~(
        (F.col("members") == 1) & (F.col("own_members") == 1) & (F.col("community") > F.col("own"))
    )
    score = F.col("towards") - F.col("strength") * F.col("total") / F.lit(weight)
    stay = F.col("inside") - F.col("strength") * (F.col("total") - F.col("strength")) / F.lit(weight)
    return (
        options.groupBy("node")
        .agg(
            F.max("own").alias("community"),
            F.max("strength").alias("strength"),
            F.max("own_total").alias("total"),
            F.max(F.when(F.col("community") == F.col("own"), F.col("towards"))).alias("inside"),
            F.max(F.when(allowed, F.struct(score.alias("score"), F.col("community").alias("target")))).alias("best"),
        )
        .select(
            "node",
            "community",
            "strength",
            "total",
            "inside",
            (F.col("best.score") - stay).alias("gain"),
            F.col("best.target").alias("target"),
        )
    )


def _independent(moves: DataFrame, least: float, node_rows: int) -> DataFrame:
    """node and target of moves of which no two share a community: those best for both the left and the joined one."""
    gaining = moves.where(F.col("gain") > least).select("node", "community", "target", F.struct("gain", "node").alias("rank"))
    best = (
        gaining.select(F.explode(F.array("community", "target")).alias("community"), "rank")
        .groupBy("community")
        .agg(F.max("rank").alias("best"))
    )
    left = join_lookup(gaining, best, ["community"], total_rows=node_rows, lookup_rows=node_rows)
    joined = best.select(F.col("community").alias("target"), F.col("best").alias("best_joined"))
    both = join_lookup(left.where("rank = best"), joined, ["target"], total_rows=node_rows, lookup_rows=node_rows)
    return both.where("rank = best_joined").select("node", F.col("target").alias("_target"))


def _settle(
    scratch: Scratch,
    arcs: DataFrame,
    numbers: DataFrame,
    named: int,
    level: int,
    max_rounds: int,
    start: DataFrame | None = None,
) -> tuple[DataFrame, float, int, list[float]]:
    """Rounds of moves on one level; the best labels found, their modularity, the number of nodes, and the share of
    the nodes that moved in each round (0 for moves that cannot clash). `numbers` are the names of `named` nodes, by
    which the moving half is drawn; `start`: node and community to begin with."""
    is_loop = F.col("node") == F.col("neighbour")
    alone = arcs.groupBy("node").agg(
        F.sum("weight").alias("strength"),
        F.sum(F.when(is_loop, F.col("weight")).otherwise(0.0)).alias("loop"),
        F.count(F.lit(1)).alias("arcs"),
    )
    if start is not None:
        begun = alone.join(start, "node", "left").withColumn("community", F.coalesce("community", "node"))
    else:
        begun = alone.withColumn("community", F.col("node"))
    labels, totals = scratch.write_with(
        join_lookup(begun, numbers, ["node"], total_rows=named, lookup_rows=named),
        f"labels{level}",
        weight=F.sum("strength"),
        loops=F.sum("loop"),
        nodes=F.count(F.lit(1)),
        arcs=F.sum("arcs"),
    )
    weight, loops, node_rows, arc_rows = (totals[name] for name in ("weight", "loops", "nodes", "arcs"))
    names, labels = labels.select("node", "name"), labels.select("node", "strength", "community")
    heavy = None
    if node_rows > BROADCAST_ROWS:
        found = heavy_keys(arcs, ["neighbour"])  # every arc stands there in both directions
        table = None if found.table is None else found.table.withColumnRenamed("neighbour", "node")
        heavy = found, Heavy(table, found.missing, found.slices)

    best, best_quality, found, share, shares = None, float("-inf"), {}, 0.5, []
    least = THRESHOLD * weight / 2  # in links; moving a node changes modularity by twice its gain / weight
    for step in range(max_rounds):
        state = _state(labels, node_rows)
        if node_rows > BROADCAST_ROWS:
            state = scratch.write(state, f"state{level}")
        moves, totals = scratch.write_with(
            _moves(arcs, state, weight, arc_rows, node_rows, heavy),
            f"moves{level}",
            inside=F.sum("inside"),
            # over the nodes of a community this adds up to its total squared
            squares=F.sum(F.col("strength") * F.col("total")),
            movable=F.count_if(F.col("gain") > least),
        )
        quality = (totals["inside"] + loops) / weight - totals["squares"] / weight**2
        if quality > best_quality:
            best, best_quality, found = moves, quality, totals
            share = min(0.5, max(2 * share, LEAST_MOVES / max(1, found["movable"])))
        else:
            scratch.discard(f"moves{level}")
            if share == 0.0:
                break  # even moves that cannot clash are lost in rounding
            share = share / 4 if share * found["movable"] > LEAST_MOVES else 0.0
        if not found["movable"]:
            break
        shares.append(share)
        if share:
            drawn = F.pmod(F.xxhash64("name", F.lit(SEED), F.lit(step)), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
            target = F.when(drawn & (F.col("gain") > least), F.col("target"))
            known = join_lookup(best, names, ["node"], total_rows=node_rows, lookup_rows=node_rows)
            labels = known.select("node", "strength", F.coalesce(target, "community").alias("community"))
        else:
            chosen = join_lookup(best, _independent(best, least, node_rows), ["node"], total_rows=node_rows, lookup_rows=node_rows)
            labels = chosen.select("node", "strength", F.coalesce("_target", "community").alias("community"))
    else:
        raise RuntimeError(f"Communities did not settle in {max_rounds} rounds.")
    settled = scratch.write(best.select("node", "community"), f"settled{level}")
    return settled, best_quality, node_rows, shares


def communities(
    edges: DataFrame,
    nodes: DataFrame | None = None,
    max_levels: int = 40,
    max_rounds: int = 400,
    start: DataFrame | None = None,
) -> DataFrame:
    """Community of every node that has an edge, named by its smallest node id.

    When no node has an edge, each node of `nodes` is its own community. `start` (node_id, community_id) are
    communities of an earlier state of the graph to begin with.
    """
    return weighted_communities(weighted_projection(edges), nodes, max_levels, max_rounds, start)


def weighted_communities(
    pairs: DataFrame,
    nodes: DataFrame | None = None,
    max_levels: int = 40,
    max_rounds: int = 400,
    start: DataFrame | None = None,
) -> DataFrame:
    """`communities` of undirected pairs node_a, node_b, weight, each there once."""
    scratch = Scratch(pairs.sparkSession, "communities")
    pairs = scratch.write(pairs.select("node_a", "node_b", "weight"), "pairs")
    if start is not None:
        start = start.select(F.col("node_id").alias("node"), F.col("community_id").alias("community"))
    numbers, named = _numbered(scratch, pairs, start)
    pairs = scratch.write(_by_number(pairs, ["node_a", "node_b"], numbers, named), "pairs")
    if start is not None:
        start = _by_number(start, ["node", "community"], numbers, named).where("node is not null")
    marked, seen = scratch.write_with(_followers(pairs), "marked", followers=F.count("follower"))
    arcs = scratch.write(_clustered(_arcs_of(_without_followers(marked) if seen["followers"] else pairs)), "arcs")
    if arcs.isEmpty():
        ids = numbers.select(F.col("name").alias("node")) if nodes is None else nodes.select(F.col("node_id").alias("node"))
        return ids.select(F.col("node").alias("node_id"), F.col("node").alias("community_id"))

    assigned, quality = None, float("-inf")
    for level in range(max_levels):
        settled, level_quality, groups, shares = _settle(
            scratch, arcs, numbers, named, level, max_rounds, None if level else start
        )
        if level_quality <= quality + THRESHOLD:
            break
        quality = level_quality
        if assigned is None:
            assigned = settled
        else:
            step = settled.select(F.col("node").alias("community"), F.col("community").alias("_next"))
            assigned = join_lookup(assigned, step, ["community"], lookup_rows=groups).select("node", F.col("_next").alias("community"))
        assigned = scratch.write(assigned, "assigned")
        if not shares and (level or start is None):
            break  # nothing has moved, so the next level would be this one
        near = settled.select("node", F.col("community").alias("_from"))
        far = settled.select(F.col("node").alias("neighbour"), F.col("community").alias("_to"))
        placed = join_lookup(arcs, near, ["node"], lookup_rows=groups)
        merged = join_lookup(placed, far, ["neighbour"], count_from=arcs, lookup_rows=groups)
        arcs = scratch.write(
            merged.groupBy(F.col("_from").alias("node"), F.col("_to").alias("neighbour")).agg(
                F.sum("weight").alias("weight")
            ),
            "arcs",
        )
    else:
        raise RuntimeError(f"Communities did not settle in {max_levels} levels.")
    if seen["followers"]:
        hung = marked.where("follower is not null").select(
            F.col("follower"), F.when(F.col("follower") == F.col("node_a"), F.col("node_b")).otherwise(F.col("node_a")).alias("node")
        )
        hung = join_lookup(hung, assigned, ["node"]).select(F.col("follower").alias("node"), "community")
        assigned = scratch.write(assigned.unionByName(hung), "assigned")
    first = assigned.groupBy("community").agg(F.min("node").alias("node"))
    names = join_lookup(first, numbers, ["node"], total_rows=named, lookup_rows=named)
    by_name = join_lookup(assigned, numbers, ["node"], total_rows=named, lookup_rows=named).withColumnRenamed("name", "node_id")
    return join_lookup(by_name, names.select("community", F.col("name").alias("community_id")), ["community"]).select(
        "node_id", "community_id"
    )


def modularity(edges: DataFrame, assignment: DataFrame) -> DataFrame:
    """One row: weighted modularity of a community assignment."""
    arcs = _arcs(edges)
    near = assignment.select(F.col("node_id").alias("node"), F.col("community_id").alias("_from"))
    far = assignment.select(F.col("node_id").alias("neighbour"), F.col("community_id").alias("_to"))
    placed = join_lookup(join_lookup(arcs, near, ["node"]), far, ["neighbour"], count_from=arcs)
    per_community = placed.groupBy("_from").agg(
        F.sum("weight").alias("total"),
        F.sum(F.when(F.col("_from") == F.col("_to"), F.col("weight")).otherwise(0.0)).alias("inside"),
    )
    whole = F.sum("total")
    return per_community.agg(
        (F.sum("inside") / whole - F.sum(F.col("total") * F.col("total")) / (whole * whole)).alias("modularity")
    )
