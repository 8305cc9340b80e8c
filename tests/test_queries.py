"""Queries against their SQL on the smallest test tables; `tools/check.py` runs all of them on any size."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from tools.check import TABLES, canonical

SF_DIR = "/root/testdata/sf0.001"
NAMES = [
    "parse_json_payload", "decode_alerts", "validation_split", "normalize_timestamps", "feature_matrix", "window_enrich",
    "historical_enrich", "training_features", "graph_edges", "graph_update_stats", "pagerank", "triangles",
    "connected_components", "risk_propagation", "attach_graph_signals", "alert_rules", "upsert_scored", "alert_metrics",
    "top_alerts", "kpi_delta_7d", "severity_trend", "pipeline_latency",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    ours = canonical(driver.queries()[name](spark, SF_DIR).toPandas())
    theirs = canonical(db.sql(driver.oracle_sql()[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    assert ours.equals(theirs)


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
