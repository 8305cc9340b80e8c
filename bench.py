"""Time the headline queries: python bench.py prints one JSON line.

`end_to_end` builds everything from the raw events to the stored alerts (features, scores, graph signals,
audit tables) and is timed first; the other queries find those tables built. Every result is computed in
full and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paywatch.session import build_session  # noqa: E402

HEADLINE = (
    "validation_split",
    "user_window_agg",
    "window_enrich",
    "historical_enrich",
    "training_features",
    "graph_edges",
    "pagerank",
    "communities",
    "triangles",
    "connected_components",
    "risk_propagation",
    "attach_graph_signals",
    "alert_rules",
    "score_anomaly",
    "score_fraud",
    "top_alerts",
    "kpi_delta_7d",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from paywatch.plans import queries as plans

    names = sys.argv[1:] or HEADLINE
    start = time.perf_counter()
    plans.QUERIES["top_alerts"](spark, sf_dir).count()
    times = {"end_to_end": round(time.perf_counter() - start, 3)}
    plans.stored(spark, sf_dir, "enriched", lambda: plans.views.enriched(spark, sf_dir))
    if "score_fraud" in names:  # scores with a stored model
        start = time.perf_counter()
        plans.fraud_model_path(spark, sf_dir)
        times["train_fraud_model"] = round(time.perf_counter() - start, 3)
    for name in names:
        start = time.perf_counter()
        plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
