"""Compare every query with its SQL on the same tables: python tools/check.py [sf_dir] [query ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paywatch.session import build_session  # noqa: E402
from paywatch.plans.oracles import ORACLES  # noqa: E402
from paywatch.plans.queries import QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        values = frame[name]
        if pd.api.types.is_datetime64_any_dtype(values):
            frame[name] = values.astype("datetime64[us]")
        elif pd.api.types.is_float_dtype(values):
            frame[name] = values.astype(float) + 0.0
    text = frame.map(lambda v: "" if v is None or v != v else repr(v)).sort_values(list(frame.columns))
    return text.reset_index(drop=True)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    failed = 0
    for name in names:
        start = time.time()
        try:
            result = QUERIES[name](spark, sf_dir)
            ours = result.toPandas()
            took = time.time() - start
            if name not in ORACLES:
                print(f"{name:24s} rows only {len(ours):7d} {took:7.2f}s", flush=True)
                continue
            relation = db.sql(ORACLES[name])
            kinds = dict(zip(relation.columns, map(str, relation.types)))
            theirs = relation.df()
            start = time.time()
            a, b = canonical(ours), canonical(theirs)
            same = list(a.columns) == list(b.columns) and a.equals(b)
            print(f"{name:24s} {'ok  ' if same else 'DIFF'} {len(ours):7d} {took:7.2f}s", flush=True)
            spark_kinds = dict(result.dtypes)
            pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                     "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
            for column, kind in spark_kinds.items():
                if kinds.get(column) != pairs.get(kind):
                    print(f"    type of {column}: {kind} / {kinds.get(column)}")
            if not same:
                failed += 1
                if list(a.columns) != list(b.columns) or len(a) != len(b):
                    print("   ", list(a.columns), len(a), list(b.columns), len(b))
                both = a.merge(b, how="outer", indicator=True)
                print(both[both["_merge"] != "both"].head(8).to_string())
        except Exception as error:  # report and go on with the next query
            failed += 1
            print(f"{name:24s} FAIL {str(error)[:500]}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
