"""Compression distance: held-out accuracy and odd inputs."""

import os
import random

import numpy as np
import pytest

from paywatch.llm import compression
from paywatch.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
DOCS = "doc_id long, text string, score double, label int, row string"


def speech(rng, rude):
    names = ["".join(rng.choices(["ba", "lo", "mi", "nu", "ter", "ing", "sha"], k=rng.randint(1, 4))) for _ in range(rng.randint(20, 200))]
    for _ in range(len(names) // 15 + 2 if rude else 0):
        names[rng.randrange(len(names))] = rng.choice(["scoundrel", "numbskull", "Blockhead!"])
    return " ".join(names)


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(9)
    return [(k, speech(rng, k % 5 == 0), k % 5 == 0) for k in range(1, 600)]


def trained(rows, data):
    docs = rows(DOCS, *[(k, t, 0.0, 1, "r") for k, t, _ in data])
    labels = rows("doc_id long, toxic int, text string", *[(k, int(rude), "x") for k, _, rude in data])
    return docs, labels, compression.train_detector(docs, labels)


def test_unseen_texts_are_told_apart(rows, spoken):
    _, _, detector = trained(rows, spoken)
    rng = random.Random(77)
    fresh = [(k, speech(rng, k % 2 == 0), 0.0, 1, "r") for k in range(200)]
    found = {r["doc_id"]: r["score"] for r in compression.score_toxicity(rows(DOCS, *fresh), detector).select("row.doc_id", "score").collect()}
    assert np.mean([(found[k] >= 0.5) == (k % 2 == 0) for k in found]) > 0.93


def test_held_out_labels_are_not_learned(rows, spoken):
    docs, labels, detector = trained(rows, spoken)
    fold = compression.held_out("doc_id")
    turned = labels.where(~fold).unionByName(labels.where(fold).selectExpr("doc_id", "1 - toxic AS toxic", "text"))
    again = compression.train_detector(docs, turned)
    assert again.dictionaries == detector.dictionaries and np.array_equal(again.calibration.weights, detector.calibration.weights)


def test_repeated_ids_and_texts_give_one_row(rows, spoken):
    docs, labels, detector = trained(rows, spoken[:200])
    crowd = docs.unionByName(docs.where("doc_id = 7")).unionByName(docs.where("doc_id = 7")).unionByName(docs.selectExpr("doc_id + 10000 AS doc_id", "text", "score", "label", "row"))
    again = compression.train_detector(crowd, labels.unionByName(labels).unionByName(labels.selectExpr("doc_id + 10000 AS doc_id", "toxic", "text")).where(~compression.held_out("doc_id")))
    assert again.dictionaries.toxic and len(again.dictionaries.ordinary) > 0
    few = compression.train_detector(crowd, labels, sample_rows=50)
    assert few.dictionaries.ordinary != detector.dictionaries.ordinary


def test_edges(rows, spoken):
    docs, labels, detector = trained(rows, spoken)
    data = [(None, None, 0.0, 1, "r"), (1, "", 0.0, 1, "r"), (1, " \n", 0.0, 1, "r"), (2, "word " * 100_000, 0.0, 1, "r"), (3, "?!", 0.0, 1, "r"), (3, "?!", 0.0, 1, "r"), (4, "numbskull " * 50_000, 0.0, 1, "r")]
    found = compression.score_toxicity(rows(DOCS, *data), detector)
    got = found.select("row.*", found.score.alias("own")).collect()
    assert len(got) == len(data) and found.select("row.*").columns == docs.columns
    by = {(r["doc_id"], r["text"]): r["own"] for r in got}
    assert all(0 <= s <= 1 for s in by.values()) and by[None, None] == by[1, ""] == by[1, " \n"] < 0.5
    assert by[2, data[3][1]] < 0.5 <= by[4, data[-1][1]]
    assert compression.score_toxicity(docs.where("false"), detector).count() == 0
    for known in (labels.where("false"), labels.selectExpr("doc_id", "cast(null AS int) AS toxic"), labels.selectExpr("doc_id", "0 AS toxic"), labels.selectExpr("cast(null AS long) AS doc_id", "toxic")):
        plain = compression.score_toxicity(rows(DOCS, *data), compression.train_detector(docs, known)).select("score").distinct().collect()
        assert len(plain) == 1 and plain[0][0] < 0.5
    assert compression.train_detector(docs.where("false"), labels).dictionaries.toxic == b""


@needs_tables
def test_query_on_held_out_labels(spark):
    found = {r["doc_id"]: r for r in QUERIES["op12_toxicity"](spark, SF_DIR).collect()}
    labels = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic").collect()]
    unseen = [(found[k]["predicted"], toxic) for k, toxic in labels if found[k]["held_out"]]
    rude = [p for p, toxic in unseen if toxic]
    assert len(found) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert sum(rude) >= 0.5 * len(rude) and sum(p for p, toxic in unseen if not toxic) <= 0.02 * len(unseen)
