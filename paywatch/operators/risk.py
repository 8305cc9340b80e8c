"""Risk of edges and nodes, its spread to neighbours, and the signals attached to transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paywatch.functions.values import clip01, known
from paywatch.operators.graph import both_directions, edge_weight, simple_pairs, with_nodes
from paywatch.operators.skew import join_lookup


def edge_risk() -> Column:
    """70 % clipped fraud probability, 30 % clipped a / (1 + |a|) of the anomaly score; unknown counts 0."""
    fraud = clip01(F.coalesce(known(F.col("fraud_probability")), F.lit(0.0)))
    anomaly = F.coalesce(known(F.col("anomaly_score")), F.lit(0.0))
    return clip01(0.7 * fraud + 0.3 * clip01(anomaly / (1.0 + F.abs(anomaly))))


def pair_totals(edges: DataFrame) -> DataFrame:
    """One row per linked pair with all that signals need of its edges: their number n, weight and risk.

    Totals of parts of the edges add up with `sum_pair_totals`.
    """
    return edges.groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("n"), F.sum(edge_weight()).alias("weight"), F.sum(edge_risk()).alias("risk")
    )


def sum_pair_totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy("src", "dst").agg(*[F.sum(c).alias(c) for c in ("n", "weight", "risk")])


def node_exposure(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Mean risk of the edges at a node, whatever their direction; 0 without edges.

    Summed per pair first, so the hub rows that reach the second grouping are few.
    """
    return pair_exposure(pair_totals(edges), nodes)


def pair_exposure(pairs: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """`node_exposure` from pair totals."""
    ends = F.explode(F.array("src", "dst")).alias("node_id")
    exposure = (
        pairs.select(ends, "risk", "n").groupBy("node_id").agg(clip01(F.sum("risk") / F.sum("n")).alias("exposure"))
    )
    if nodes is None:
        return exposure
    return (
        nodes.select("node_id")
        .join(exposure, "node_id", "left")
        .select("node_id", F.coalesce("exposure", F.lit(0.0)).alias("exposure"))
    )


def _saturating(column: str) -> Column:
    value = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
    return value / (1.0 + value)


def base_risk(
    exposure: DataFrame, pagerank: DataFrame, triangle_counts: DataFrame, components: DataFrame, sizes: DataFrame
) -> DataFrame:
    """Own risk of every node, with the signals it is made of."""
    members = join_lookup(components, sizes, ["component_id"])
    return (
        exposure.join(pagerank, "node_id", "left")
        .join(triangle_counts, "node_id", "left")
        .join(members, "node_id", "left")
        .withColumn(
            "base_risk",
            clip01(
                0.55 * F.col("exposure")
                + 0.20 * _saturating("pagerank_score")
                + 0.15 * _saturating("triangle_count")
                + 0.10 * _saturating("component_size")
            ),
        )
    )


def risk_propagation(base: DataFrame, edges: DataFrame) -> DataFrame:
    """70 % own risk, 30 % mean risk of the distinct neighbours; a node without neighbours keeps its own."""
    own = base.select("node_id", "base_risk")
    neighbours = both_directions(simple_pairs(edges))
    seen = join_lookup(
        neighbours,
        own.select(F.col("node_id").alias("neighbour"), F.col("base_risk").alias("_risk")),
        ["neighbour"],
        count_from=both_directions(edges, "src", "dst"),
    )
    around = seen.groupBy(F.col("node").alias("node_id")).agg(
        F.avg(F.coalesce("_risk", F.lit(0.0))).alias("_around")
    )
    spread = clip01(0.7 * F.col("base_risk") + 0.3 * F.col("_around"))
    return own.join(around, "node_id", "left").select(
        "node_id",
        F.when(F.col("_around").isNull(), F.col("base_risk")).otherwise(spread).alias("propagated_risk_score"),
    )


SIGNAL_COLUMNS = (
    "pagerank_score",
    "community_id",
    "triangle_count",
    "component_id",
    "component_size",
    "propagated_risk_score",
)


def graph_signals(base: DataFrame, communities: DataFrame, propagated: DataFrame) -> DataFrame:
    """One row per node with everything a transaction takes over from the graph."""
    return (
        base.join(communities, "node_id", "left").join(propagated, "node_id", "left").select("node_id", *SIGNAL_COLUMNS)
    )


def attach_graph_signals(df: DataFrame, signals: DataFrame) -> DataFrame:
    """Signals of both ends on every row.

    PageRank is the customer's (0 if unknown); community and component are the customer's, else the
    merchant's; triangles, component size and propagated risk are the larger of the two.

    `signals` should be a stored table: its nodes are counted by kind, so that a kind with few nodes is broadcast
    and the wide rows move for the other one only, or not at all.
    """

    def of_kind(kind: str) -> Column:
        return F.col("node_id").startswith(f"{kind}:")

    def side(kind: str, node: str, prefix: str) -> DataFrame:
        return signals.where(of_kind(kind)).select(
            F.col("node_id").alias(node), *[F.col(c).alias(f"{prefix}_{c}") for c in SIGNAL_COLUMNS]
        )

    rows = with_nodes(df)
    size = signals.agg(*[F.count_if(of_kind(kind)).alias(kind) for kind in ("customer", "merchant")]).first()
    with_customer = join_lookup(rows, side("customer", "src", "c"), ["src"], lookup_rows=size["customer"])
    both = join_lookup(with_customer, side("merchant", "dst", "m"), ["dst"], count_from=rows, lookup_rows=size["merchant"])

    def larger(column: str, zero) -> Column:
        return F.coalesce(F.greatest(f"c_{column}", f"m_{column}"), F.lit(zero))

    return both.select(
        *df.columns,
        F.coalesce("c_pagerank_score", F.lit(0.0)).alias("pagerank_score"),
        F.coalesce("c_community_id", "m_community_id").alias("community_id"),
        larger("triangle_count", 0).alias("triangle_count"),
        F.coalesce("c_component_id", "m_component_id").alias("component_id"),
        larger("component_size", 0).alias("component_size"),
        larger("propagated_risk_score", 0.0).alias("propagated_risk_score"),
    )


def top_nodes(signals: DataFrame, top: int = 5) -> DataFrame:
    """The leading nodes by PageRank, triangles and propagated risk, and the largest communities and components."""

    def leaders(frame: DataFrame, ranking: str, name: str, value: str) -> DataFrame:
        # a zero ends the list for no ranking: every node has a value
        return (
            frame.select(
                F.lit(ranking).alias("ranking"),
                F.col(name).alias("name"),
                F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("value"),
            )
            .orderBy(F.desc("value"), "name")
            .limit(top)
        )

    def sizes(column: str) -> DataFrame:
        return signals.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("size"))

    parts = [
        leaders(signals, "pagerank", "node_id", "pagerank_score"),
        leaders(signals, "triangles", "node_id", "triangle_count"),
        leaders(signals, "propagated_risk", "node_id", "propagated_risk_score"),
        leaders(sizes("community_id"), "communities", "community_id", "size"),
        leaders(sizes("component_id"), "components", "component_id", "size"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
