"""Connected components by alternating star contraction (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paywatch.operators.graph import both_directions, simple_pairs
from paywatch.operators.skew import BROADCAST_ROWS, join_lookup
from paywatch.session import Scratch


def _link_to_minimum(rows: DataFrame, total_rows: int, keep_own: bool) -> DataFrame:
    """Per node, the smallest of itself and its neighbours; neighbours are linked to that minimum.

    The minimum is pre-aggregated, and handing it back to the rows of a hub is split over many tasks.
    """
    # there are no more minima than rows
    minima = rows.groupBy("node").agg(F.least("node", F.min("neighbour")).alias("root"))
    if keep_own:  # small star: smaller neighbours and the node itself
        links = join_lookup(rows, minima, ["node"], total_rows=total_rows, lookup_rows=total_rows).select(
            F.explode(
                F.array(
                    F.struct(F.col("neighbour").alias("node"), F.col("root").alias("neighbour")),
                    F.struct(F.col("node"), F.col("root").alias("neighbour")),
                )
            ).alias("link")
        ).select("link.*")
    else:  # large star: only larger neighbours
        larger = rows.where(F.col("neighbour") > F.col("node"))
        links = join_lookup(larger, minima, ["node"], total_rows=total_rows, lookup_rows=total_rows).select(
            F.col("neighbour").alias("node"), F.col("root").alias("neighbour")
        )
    return links.where(F.col("node") != F.col("neighbour")).distinct()


def connected_components(edges: DataFrame, nodes: DataFrame | None = None, max_rounds: int = 60) -> DataFrame:
    """Component of every node, named by its smallest node id; a node without edges is its own component.

    Each round leaves a graph with the same components; it ends as stars around the smallest ids.
    The number of rounds grows with the logarithm of the size.
    """
    scratch = Scratch(edges.sparkSession, "components")
    state = {"rows": F.count(F.lit(1)), "print": F.bit_xor(F.xxhash64("node", "neighbour"))}
    first = simple_pairs(edges).select(F.col("node_b").alias("node"), F.col("node_a").alias("neighbour"))
    stars, before = scratch.write_with(first, "stars", **state)
    for _ in range(max_rounds):
        rows = 2 * before["rows"]
        large = scratch.write(_link_to_minimum(both_directions(stars, "node", "neighbour"), rows, keep_own=False), "large")
        stars, after = scratch.write_with(_link_to_minimum(large, rows, keep_own=True), "stars", **state)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"Components did not settle in {max_rounds} rounds.")

    members = stars.select(F.col("node").alias("node_id"), F.col("neighbour").alias("component_id"))
    roots = members.select(F.col("component_id").alias("node_id"), "component_id").distinct()
    found = members.unionByName(roots)
    if nodes is None:
        return found
    return (
        nodes.select("node_id")
        .join(found, "node_id", "left")
        .select("node_id", F.coalesce("component_id", "node_id").alias("component_id"))
    )


def grown_components(previous: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Components of a graph after `edges` were added to one with the components `previous` (node_id, component_id).

    Only the new edges are iterated over, as links between former components; the members of those that were
    joined are renamed in one pass. `nodes` are all nodes, the new ones included.
    """
    scratch = Scratch(edges.sparkSession, "grown")
    pairs = scratch.write(simple_pairs(edges), "pairs")
    touched, seen = scratch.write_with(
        pairs.select(F.explode(F.array("node_a", "node_b")).alias("node_id")).distinct(), "touched", rows=F.count(F.lit(1))
    )
    few = seen["rows"] <= BROADCAST_ROWS
    known = scratch.write(previous.join(F.broadcast(touched) if few else touched, "node_id", "left_semi"), "known")
    ends = pairs
    for side in ("node_a", "node_b"):
        former = known.select(F.col("node_id").alias(side), F.col("component_id").alias(f"{side}_root"))
        ends = join_lookup(ends, former, [side], lookup_rows=seen["rows"], count_from=pairs)
    between = ends.select(F.coalesce("node_a_root", "node_a").alias("src"), F.coalesce("node_b_root", "node_b").alias("dst"))
    renamed = connected_components(between).select("node_id", F.col("component_id").alias("_joined"))
    renamed, seen = scratch.write_with(renamed.withColumnRenamed("node_id", "component_id"), "renamed", rows=F.count(F.lit(1)))
    members = (
        nodes.select("node_id")
        .join(previous, "node_id", "left")
        .select("node_id", F.coalesce("component_id", "node_id").alias("component_id"))
    )
    return join_lookup(members, renamed, ["component_id"], lookup_rows=seen["rows"]).select(
        "node_id", F.coalesce("_joined", "component_id").alias("component_id")
    )


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component_id").agg(F.count(F.lit(1)).alias("component_size"))
