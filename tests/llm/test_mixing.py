"""Source mixing, line dedup and the pipeline."""

import math
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paywatch.llm import line_dedup, mixing
from paywatch.llm.oracles import ORACLES
from paywatch.llm.queries import QUERIES
from test_dedup import grouped, slow_print
from tools.check import TABLES, canonical

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
DOCS = "doc_id long, text string, source string, epoch long, tokens long, rows string"


def sources(rows, sizes):
    data = [(1000 * k + i, "w " * (1 + i % 4), name, 1, 1, "r") for k, (name, n) in enumerate(sizes.items()) for i in range(n)]
    return rows(DOCS, *data)


def test_every_document_is_shown_and_none_too_often(rows):
    docs = sources(rows, {"big": 300, "mid": 60, "small": 4, None: 20, "": 7})
    found = mixing.mixture(docs, max_repeats=4.0, block_tokens=100).collect()
    per_doc: dict = {}
    for r in found:
        per_doc.setdefault(r["doc_id"], []).append(r["epoch"])
    assert set(per_doc) == {r[0] for r in docs.collect()}
    assert all(sorted(e) == list(range(1, len(e) + 1)) and len(e) <= 4 for e in per_doc.values())
    assert {r["source"] for r in found} == {"big", "mid", "small", None, ""}
    assert max(len(e) for e in per_doc.values()) == 4  # the smallest source reaches the limit


def test_weights_fill_the_budget(rows):
    docs = sources(rows, {"a": 300, "b": 100, "c": 20})
    found = mixing.mixture(docs, budget=600, max_repeats=3.0, block_tokens=60)
    by = {r["source"]: r for r in found.groupBy("source").agg(F.sum("n_tokens").alias("n"), F.first("weight").alias("w")).collect()}
    assert sum(r["w"] for r in by.values()) == pytest.approx(1, abs=1e-8)
    for r in by.values():
        assert 600 * r["w"] - 5 <= r["n"] <= 600 * r["w"] + 1e-6  # the last document that still fits
    assert by["c"]["n"] <= 3.0 * 50
    blocks = found.groupBy("block").agg(F.sum("n_tokens").alias("n"), F.count_distinct("source").alias("s"), F.max("place").alias("p"), F.count("*").alias("c")).collect()
    assert all(r["p"] == r["c"] for r in blocks) and min(r["s"] for r in blocks) >= 2


def test_temperature_meets_an_entropy(rows):
    docs = sources(rows, {"a": 400, "b": 40, "c": 4})
    found = mixing.mixture(docs, target_entropy=0.8)
    weights = [r["w"] for r in found.groupBy("source").agg(F.first("weight").alias("w")).collect()]
    assert -sum(w * math.log(w) for w in weights) == pytest.approx(0.8, abs=1e-4)


def test_ranges_do_not_change_the_mixture(rows, monkeypatch):
    docs = sources(rows, {"a": 200, "b": 30})
    whole = sorted(map(tuple, mixing.mixture(docs, budget=300).collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    assert sorted(map(tuple, mixing.mixture(docs, budget=300).collect())) == whole


def test_mixing_edges(rows):
    data = [(1, None, "a", 1, 1, "r"), (1, None, "a", 1, 1, "r"), (None, "x y", None, 1, 1, "r"), (None, "x y", None, 1, 1, "r"), (3, " ", "empty", 1, 1, "r"), (4, "long " * 50_000, "a", 1, 1, "r")]
    found = mixing.mixture(rows(DOCS, *data))
    assert {r["source"] for r in found.collect()} == {"a", None}
    assert found.where("doc_id = 1 AND epoch = 1").count() == 2
    assert mixing.mixture(rows(DOCS, *data).where("false")).count() == 0
    with pytest.raises(ValueError, match="budget"):
        mixing.mixture(rows(DOCS, *data), budget=10**9)


def test_boilerplate_lines(rows):
    page = "<p>Home</p><p>text {0}</p><p>Home</p><!-- x --><script>var a;</script>Legal &amp; more"
    data = [(i, f"https://Site.example/{i}", page.format(i), "h", 1, "c") for i in range(10)]
    data += [(100 + i, "http://tiny.example/x", page.format("same"), "h", 1, "c") for i in range(3)]
    data += [(300 + i, "//five.example", "<p>Often</p><p>own</p>" if i < 2 else f"<p>own {i}</p>", "h", 1, "c") for i in range(5)]
    data += [(200, None, None, "h", 1, "c"), (None, "no address", "", "h", 1, "c"), (0, "https://site.example/0", page.format(0), "h", 1, "c")]
    schema = "page_id long, url string, html string, host string, lines int, common string"
    found = {(r["page_id"], r["text"]): r for r in line_dedup.drop_boilerplate(rows(schema, *data)).collect()}
    assert (3, "text 3") in found and found[3, "text 3"]["n_dropped"] == 3 and found[3, "text 3"]["host"] == "site.example"
    assert (101, "Home\ntext same\nHome\nLegal & more") in found  # three pages say nothing about a host
    assert found[300, ""]["n_dropped"] == 2 and (304, "own 4") in found  # two pages of five
    assert found[200, ""]["n_lines"] == 0 and found[None, ""]["host"] == ""
    assert line_dedup.drop_boilerplate(rows(schema, *data).where("false")).count() == 0


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    ours, theirs = canonical(QUERIES[name](spark, SF_DIR).toPandas()), canonical(db.sql(ORACLES[name]).df())
    assert list(ours.columns) == list(theirs.columns) and ours.equals(theirs)


def folded(text):
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def windows(text):
    words = folded(text)
    return [tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))] if words else []


def contains(text, passages):
    words = folded(text)
    return any(tuple(words[i : i + n]) in passages for n in {len(p) for p in passages} for i in range(len(words) - n + 1))


@needs_tables
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality").collect()}
    seen = {r[0] for r in docs.select("doc_id").collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, SF_DIR)
        ids = {r[0] for r in after.select("doc_id").collect()}
        assert ids <= seen, name
        if number == 0:
            lost = [labels[i] for i in seen - ids if i in labels]
            assert lost and sum(lost) <= 0.1 * len(lost)
        if number == 1:
            bodies = {"".join((r[0] or "").encode().translate(None, b" \t\n\x0b\x0c\r").decode()) for r in docs.select("text").collect()}
            assert len(ids) == len(bodies)
        if number == 2:
            assert ids == set(grouped({r[0]: slow_print(r[1] or "") for r in docs.select("doc_id", "text").collect()}, 2).values())
        if number == 3:
            passages = {w for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("text").collect() for w in windows(r[0])}
            assert ids == {r[0] for r in docs.select("doc_id", "text").collect() if not contains(r[1], passages)} < seen
        if number + 1 < len(corpus_pipeline.STAGES):
            assert after.columns == docs.columns
            docs, seen = spark.createDataFrame(after.collect(), docs.schema), ids
        else:
            assert ids == seen


@needs_tables
def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns == ["doc_id", "source", "epoch", "block", "place", "n_tokens", "weight"]
