"""The customer -> merchant graph as two tables: nodes, and one edge per transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paywatch.functions.identity import customer_node, merchant_node, strip
from paywatch.functions.values import known
from paywatch.operators.dedup import first_per_id, unseen

EDGE_COLUMNS = (
    "src",
    "dst",
    "edge_key",
    "transaction_id",
    "amount",
    "timestamp",
    "fraud_probability",
    "anomaly_score",
)


def with_nodes(df: DataFrame) -> DataFrame:
    return df.withColumns({"src": customer_node(df.columns), "dst": merchant_node()})


def linked(df: DataFrame) -> DataFrame:
    """Rows that name both a customer and a merchant."""
    return with_nodes(df).where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def graph_edges(df: DataFrame, stored_edges: DataFrame | None = None, batch_rows: int | None = None) -> DataFrame:
    """One edge per transaction id not stored yet, the earliest row winning; a row without id is its own edge."""
    rows = linked(df).select(
        "src",
        "dst",
        strip(F.col("transaction_id")).alias("transaction_id"),
        known(F.col("amount").cast("double")).alias("amount"),
        strip(F.col("timestamp")).alias("timestamp"),
        known(F.col("fraud_probability").cast("double")).alias("fraud_probability"),
        known(F.col("anomaly_score").cast("double")).alias("anomaly_score"),
    )
    first = first_per_id(rows, "transaction_id", ["timestamp", "src", "dst", "amount"])
    if stored_edges is not None:
        stored = stored_edges.where(F.col("transaction_id").isNotNull())
        first = unseen(first, stored, "transaction_id", batch_rows)
    auto_key = F.concat(F.lit("auto-edge-"), F.monotonically_increasing_id().cast("string"))
    return first.withColumn("edge_key", F.coalesce("transaction_id", auto_key)).select(*EDGE_COLUMNS)


def graph_nodes(df: DataFrame, stored_nodes: DataFrame | None = None, batch_rows: int | None = None) -> DataFrame:
    """Distinct nodes not stored yet, also of rows whose transaction is a repeat."""
    rows = linked(df)
    ends = F.array(
        F.struct(F.col("src").alias("node_id"), F.lit("customer").alias("node_type")),
        F.struct(F.col("dst").alias("node_id"), F.lit("merchant").alias("node_type")),
    )
    nodes = (
        rows.select("src", "dst")
        .distinct()
        .select(F.explode(ends).alias("end"))
        .select("end.node_id", "end.node_type")
        .distinct()
        .withColumn("entity_id", F.expr("substring(node_id, length(node_type) + 2)"))
    )
    if stored_nodes is None:
        return nodes
    return unseen(nodes, stored_nodes, "node_id", None if batch_rows is None else 2 * batch_rows)


def graph_update_stats(df: DataFrame, stored_nodes: DataFrame, stored_edges: DataFrame) -> DataFrame:
    """One row: what a batch adds to the stored graph, and the totals after it."""
    src, dst = customer_node(df.columns), merchant_node()
    measures = (
        "processed_rows",
        "skipped_rows",
        "new_nodes",
        "new_edges",
        "total_nodes",
        "total_edges",
    )

    def counted(frame: DataFrame, **counts) -> DataFrame:
        return frame.agg(*[F.coalesce(counts.get(m, F.lit(0)), F.lit(0)).cast("long").alias(m) for m in measures])

    rows = F.count(F.lit(1))
    parts = [
        counted(df, processed_rows=rows, skipped_rows=F.count_if(src.isNull() | dst.isNull())),
        counted(graph_nodes(df, stored_nodes), new_nodes=rows, total_nodes=rows),
        counted(graph_edges(df, stored_edges), new_edges=rows, total_edges=rows),
        counted(stored_nodes, total_nodes=rows),
        counted(stored_edges, total_edges=rows),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.agg(*[F.sum(m).alias(m) for m in measures])


def edge_weight() -> Column:
    """The amount of an edge; 0 or unknown counts 1."""
    return F.coalesce(F.nullif(known(F.col("amount")), F.lit(0.0)), F.lit(1.0))


def weighted_projection(edges: DataFrame, weight: Column | None = None) -> DataFrame:
    """Undirected simple graph: one row per pair, weight = sum of the edges' weights (else of their amounts)."""
    return edges.groupBy(F.least("src", "dst").alias("node_a"), F.greatest("src", "dst").alias("node_b")).agg(
        F.sum(edge_weight() if weight is None else weight).alias("weight")
    )


def both_directions(pairs: DataFrame, a: str = "node_a", b: str = "node_b", *extra: str) -> DataFrame:
    """Each undirected pair as two rows (node, neighbour), read from the pairs once."""
    ends = F.array(
        F.struct(F.col(a).alias("node"), F.col(b).alias("neighbour")),
        F.struct(F.col(b).alias("node"), F.col(a).alias("neighbour")),
    )
    return pairs.select(F.explode(ends).alias("_end"), *extra).select("_end.node", "_end.neighbour", *extra)


def simple_pairs(edges: DataFrame) -> DataFrame:
    """Distinct undirected pairs without self loops."""
    return (
        edges.where(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("node_a"), F.greatest("src", "dst").alias("node_b"))
        .distinct()
    )
