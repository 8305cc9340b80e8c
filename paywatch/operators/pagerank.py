"""PageRank of a directed multigraph; parallel edges add weight, dangling nodes share evenly."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from paywatch.operators.skew import BROADCAST_ROWS, Heavy, heavy_keys, slice_lookup, slice_rows
from paywatch.session import Scratch

DAMPING = 0.85


def link_counts(edges: DataFrame) -> DataFrame:
    """One row per linked pair with its number of parallel edges: all that PageRank needs of the graph."""
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def _shares(pairs: DataFrame, heavy: Heavy) -> DataFrame:
    """src, dst and the share of src's rank that flows to dst; a source with very many targets is sliced."""
    out = pairs.groupBy("src").agg(F.sum("n").alias("_out"))
    return (
        slice_rows(pairs, ["src"], heavy)
        .join(slice_lookup(out, ["src"], heavy), ["src", "_slice"])
        .select("src", "_slice", "dst", (F.col("n") / F.col("_out")).alias("share"))
    )


def _ends(pairs: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Every node once, also those of `nodes` that no pair has, and whether something leaves it."""
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.lit(True).alias("out")),
        F.struct(F.col("dst").alias("id"), F.lit(False).alias("out")),
    )
    linked = (
        pairs.select(F.explode(ends).alias("end"))
        .groupBy(F.col("end.id").alias("node_id"))
        .agg(F.max("end.out").alias("is_source"), (F.max("end.out") & ~F.min("end.out")).alias("is_both"))
    )
    if nodes is None:
        return linked
    alone = nodes.select("node_id", F.lit(False).alias("is_source"), F.lit(False).alias("is_both"))
    return linked.unionByName(alone).groupBy("node_id").agg(F.max("is_source").alias("is_source"), F.max("is_both").alias("is_both"))


def pagerank_bipartite(pairs: DataFrame, nodes: DataFrame | None = None, damping: float = DAMPING) -> DataFrame:
    """Exact PageRank where no node has both incoming and outgoing edges, without iterating.

    Sources and nodes without edges receive only the even share b = 1 / (N + damping * S) of N nodes of which
    S have out-edges; a target adds damping * b for each unit of share that flows to it.
    """
    every = _ends(pairs, nodes)
    even = every.agg((1.0 / (F.count(F.lit(1)) + F.lit(damping) * F.count_if("is_source"))).alias("b")).scalar()
    inflow = _shares(pairs, heavy_keys(pairs, ["src"])).groupBy(F.col("dst").alias("node_id")).agg(F.sum("share").alias("inflow"))
    received = every.join(inflow, "node_id", "left").withColumn("inflow", F.coalesce("inflow", F.lit(0.0)))
    return received.select("node_id", (even * (1.0 + F.lit(damping) * F.col("inflow"))).alias("pagerank_score"))


def pagerank_power(
    pairs: DataFrame,
    nodes: DataFrame | None = None,
    damping: float = DAMPING,
    tolerance: float = 1e-6,
    max_rounds: int | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """Power iteration on any directed graph, until the scores change by less than N * tolerance in total.

    What dangling nodes and jumps hand out evenly is the same for every node, so a round iterates the scores in
    units of that share, each 1 + damping * inflow, and they are scaled to a total of 1 in the end. Only ranks
    that follow links carry an error from round to round: a graph without cycles is done after as many rounds
    as its longest path, and any other one after a number of rounds known beforehand (`_rounds`).

    The links are written once, heavy sources already sliced; a round moves only the scores. `start` (node_id,
    pagerank_score) are scores of an earlier state of the graph to begin with.
    """
    scratch = Scratch(pairs.sparkSession, "pagerank")
    heavy = heavy_keys(pairs, ["src"])
    links = scratch.write(_shares(pairs, heavy), "links")
    every = _ends(pairs, nodes).select("node_id", (~F.col("is_source")).alias("_dangling"))
    base, totals = scratch.write_with(every, "nodes", size=F.count(F.lit(1)))
    size = totals["size"]
    scores, whole = base.select("node_id", F.lit(1.0).alias("score")), float(size)
    if start is not None:
        begun = base.join(start, "node_id", "left").select(
            "node_id", "_dangling", F.coalesce("pagerank_score", F.lit(1.0 / size)).alias("score")
        )
        begun, totals = scratch.write_with(
            begun, "start", total=F.sum("score"), dangling=F.sum(F.when(F.col("_dangling"), F.col("score")))
        )
        even = ((1.0 - damping) * totals["total"] + damping * (totals["dangling"] or 0.0)) / size
        scores, whole = begun.select("node_id", (F.col("score") / F.lit(even)).alias("score")), totals["total"] / even

    for _ in range(max_rounds or _rounds(size, damping, tolerance, whole)):
        sent = scores.select(F.col("node_id").alias("src"), "score")
        if size <= BROADCAST_ROWS:
            flow = links.join(F.broadcast(sent), "src")
        else:
            flow = links.join(slice_lookup(sent, ["src"], heavy), ["src", "_slice"])
        # the nodes themselves join the grouping, so nodes nothing flows to stay without another join
        arrived = flow.select(
            F.col("dst").alias("node_id"),
            (F.col("score") * F.col("share")).alias("_in"),
            F.lit(None).cast("double").alias("score"),
        )
        held = scores.select("node_id", F.lit(0.0).alias("_in"), "score")
        updated = (
            arrived.unionByName(held)
            .groupBy("node_id")
            .agg((F.lit(1.0) + F.lit(damping) * F.sum("_in")).alias("score"), F.max("score").alias("_before"))
            .withColumn("_change", F.abs(F.col("score") - F.col("_before")))
        )
        written, totals = scratch.write_with(updated, "scores", change=F.sum("_change"), whole=F.sum("score"))
        scores, whole = written.select("node_id", "score"), totals["whole"]
        # scaled scores change by at most twice this share of the total of 1
        if 2 * totals["change"] < whole * size * tolerance:
            return scores.select("node_id", (F.col("score") / F.lit(whole)).alias("pagerank_score"))
    raise RuntimeError("PageRank did not converge in the rounds allowed.")


def _rounds(size: int, damping: float, tolerance: float, whole: float) -> int:
    """Rounds after which the scores surely change by less than size * tolerance: a round cuts the change to `damping`.

    The first change is at most size + whole, in units of a share of which the total has size at least.
    """
    wanted = max(size * tolerance, 1e-14) * size / (2 * (size + whole))
    return max(1, math.ceil(math.log(min(1.0, wanted)) / math.log(damping))) + 2


def pagerank(edges: DataFrame, nodes: DataFrame | None = None, damping: float = DAMPING) -> DataFrame:
    """PageRank score of every node, also of those of `nodes` without edges.

    The closed form where no node is both source and target, else the iteration.
    """
    return pagerank_of_pairs(Scratch(edges.sparkSession, "pairs").write(link_counts(edges), "pairs"), nodes, damping)


def pagerank_of_pairs(
    pairs: DataFrame, nodes: DataFrame | None = None, damping: float = DAMPING, start: DataFrame | None = None
) -> DataFrame:
    """`pagerank` of a stored table of linked pairs (src, dst, n)."""
    if _ends(pairs).where("is_both").isEmpty():
        return pagerank_bipartite(pairs, nodes, damping)
    return pagerank_power(pairs, nodes, damping, start=start)
