"""Graph signals as versions that grow with the graph.

Every batch leaves the totals of its new edges, pair by pair, beside the versions. A refresh adds those
that the newest version has not seen to its pair totals, which are all that signals need of the edges, and
goes on from that version: components are joined by the new pairs only, communities and, where it iterates,
PageRank begin with the former ones. Edges are read again only where a batch left no totals.

A version holds the signals; its state (pair totals, leaders, the batches it has seen) is written before
them, so a refresh that is cut off leaves no version behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paywatch.operators.communities import weighted_communities
from paywatch.operators.components import component_sizes, connected_components, grown_components
from paywatch.operators.graph import EDGE_COLUMNS, weighted_projection
from paywatch.operators.pagerank import pagerank_of_pairs
from paywatch.operators.risk import base_risk, graph_signals, pair_exposure, pair_totals, risk_propagation, sum_pair_totals, top_nodes
from paywatch.operators.triangles import no_triangles
from paywatch.session import Scratch, delete_path
from paywatch.settings import Settings
from paywatch.sources import audit
from paywatch.sources.runs import Batch, layout, run_path
from paywatch.sources.schema import table_schema
from paywatch.sources.versions import complete_versions, delete_old, newest_version, next_version

EDGE_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in ("amount", "fraud_probability", "anomaly_score") else T.StringType())
        for c in EDGE_COLUMNS
    ]
)
NODE_SCHEMA = table_schema("node_id string, node_type string, entity_id string")
SIGNAL_SCHEMA = table_schema(
    "node_id string, pagerank_score double, community_id string, triangle_count long, component_id string, "
    "component_size long, propagated_risk_score double"
)
PAIR_SCHEMA = table_schema("src string, dst string, n long, weight double, risk double")
BATCH_SCHEMA = table_schema("writer string, write_id long")
LEADER_SCHEMA = table_schema("ranking string, name string, value double")


def compute_signals(nodes: DataFrame, pairs: DataFrame, previous: DataFrame | None = None, added: DataFrame | None = None) -> DataFrame:
    """All graph signals, one row per node, from the stored totals of all pairs.

    `previous` are signals from before the pairs `added` came; without them everything is computed anew.
    """
    scratch = Scratch(pairs.sparkSession, "signals")
    if previous is None or added is None:
        components, scores, start = connected_components(pairs, nodes), None, None
    else:
        components = grown_components(previous.select("node_id", "component_id"), added, nodes)
        scores = previous.select("node_id", "pagerank_score")
        start = previous.where(F.col("community_id").isNotNull()).select("node_id", "community_id")
    components = scratch.write(components, "components")
    base = scratch.write(
        base_risk(
            pair_exposure(pairs, nodes), pagerank_of_pairs(pairs, nodes, start=scores), no_triangles(nodes), components, component_sizes(components)
        ),
        "base",
    )
    grouped = weighted_communities(weighted_projection(pairs, F.col("weight")), nodes, start=start)
    return graph_signals(base, grouped, risk_propagation(base, pairs))


def _state(settings: Settings, version: str, table: str) -> str:
    return f"{settings.signals_path}/_state/{version.rsplit('/', 1)[1]}/{table}"


def latest_signals(spark: SparkSession, settings: Settings = Settings()) -> DataFrame | None:
    """The newest complete version of the signals; a write that is under way or was cut off is not seen."""
    found = newest_version(spark, settings.signals_path)
    return spark.read.schema(SIGNAL_SCHEMA).parquet(found) if found else None


def latest_leaders(spark: SparkSession, settings: Settings = Settings()) -> DataFrame | None:
    """The leading nodes, communities and components of the newest complete version."""
    found = newest_version(spark, settings.signals_path)
    if not found or not audit.path_exists(spark, _state(settings, found, "leaders")):
        return None
    return spark.read.schema(LEADER_SCHEMA).parquet(_state(settings, found, "leaders"))


def _delta_path(settings: Settings, batch: Batch) -> str:
    return run_path(f"{settings.signals_path}/_deltas", batch)


def leave_totals(spark: SparkSession, settings: Settings, batch: Batch) -> None:
    """Write the pair totals of the edges that a batch has stored, for the next refresh."""
    stored = layout(spark, settings.edges_path).loose.get(batch)
    if stored is not None:  # else it was merged, and has left them before
        pair_totals(spark.read.schema(EDGE_SCHEMA).parquet(stored)).write.mode("overwrite").parquet(_delta_path(settings, batch))


def _seen(spark: SparkSession, settings: Settings, version: str) -> set[Batch]:
    path = _state(settings, version, "batches")
    if not audit.path_exists(spark, f"{path}/_SUCCESS"):
        return set()
    return {(r["writer"], r["write_id"]) for r in spark.read.schema(BATCH_SCHEMA).parquet(path).collect()}  # names of batches


def refresh_signals(spark: SparkSession, settings: Settings = Settings(), keep: int = 2, anew: bool = False) -> DataFrame:
    """The signals of the stored graph as a new version beside the old ones, of which `keep` stay.

    Goes on from the newest version, unless `anew` or a batch has left no totals.
    """
    edges = layout(spark, settings.edges_path)
    stored = {*edges.loose, *(b for run in edges.merged for b in run.batches)}
    nodes = audit.read_table(spark, settings.nodes_path, NODE_SCHEMA)
    found = complete_versions(spark, settings.signals_path)
    path = next_version(found, settings.signals_path)

    seen = _seen(spark, settings, found[-1]) if found and not anew else set()
    deltas = {b: _delta_path(settings, b) for b in sorted(stored - seen)}
    grows = bool(seen) and seen <= stored and all(audit.path_exists(spark, f"{p}/_SUCCESS") for p in deltas.values())
    previous = added = None
    if grows:
        previous = spark.read.schema(SIGNAL_SCHEMA).parquet(found[-1])
        held = spark.read.schema(PAIR_SCHEMA).parquet(_state(settings, found[-1], "pairs"))
        added = spark.read.schema(PAIR_SCHEMA).parquet(*deltas.values()) if deltas else held.limit(0)
        totals = sum_pair_totals(held.unionByName(added))
    else:
        totals = pair_totals(audit.read_table(spark, settings.edges_path, EDGE_SCHEMA))
    totals.write.mode("overwrite").parquet(_state(settings, path, "pairs"))
    pairs = spark.read.schema(PAIR_SCHEMA).parquet(_state(settings, path, "pairs"))
    signals = Scratch(spark, "version").write(compute_signals(nodes, pairs, previous, added), "signals")
    top_nodes(signals).coalesce(1).write.mode("overwrite").parquet(_state(settings, path, "leaders"))
    spark.createDataFrame(sorted(stored), BATCH_SCHEMA).coalesce(1).write.mode("overwrite").parquet(_state(settings, path, "batches"))
    signals.write.mode("overwrite").parquet(path)

    for old in delete_old(spark, found, keep):
        delete_path(spark, f"{settings.signals_path}/_state/{old.rsplit('/', 1)[1]}")
    for batch in seen:  # the version before this one has them in its totals
        delete_path(spark, _delta_path(settings, batch))
    return spark.read.schema(SIGNAL_SCHEMA).parquet(path)
