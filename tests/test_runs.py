"""Tables that store every id once: merging, replay, and what a lookup reads."""

import random
import re

import pytest
from pyspark.sql import functions as F

from paywatch.sources import audit, runs
from paywatch.sources.schema import table_schema

SCHEMA = table_schema("id string, value long")
ROW = "id string, value long"


def batches(count, seed=4):
    rng = random.Random(seed)
    made = []
    for number in range(count):
        ids = rng.sample(range(60), 12)
        made.append([(f"id{i}", 100 * number + k) for k, i in enumerate(ids)] + [(None, number)])
    return made


def store(rows, path, made, fan_in):
    added = []
    for number, data in enumerate(made):
        added.append(runs.append_unseen(rows(ROW, *data), path, SCHEMA, "id", ("w", number), fan_in))
    return added


def first_wins(made):
    kept: dict = {}
    nameless = []
    for data in made:
        for key, value in data:
            if key is None:
                nameless.append((key, value))
            else:
                kept.setdefault(key, value)
    return sorted([*kept.items(), *nameless], key=str)


def table(spark, path):
    return sorted(map(tuple, runs.read_runs(spark, path, SCHEMA).collect()), key=str)


@pytest.mark.parametrize("fan_in", [2, 1000])
def test_every_id_once_however_runs_are_merged(spark, rows, tmp_path, fan_in):
    path, made = str(tmp_path / "t"), batches(9)
    added = store(rows, path, made, fan_in)
    assert table(spark, path) == first_wins(made) and sum(added) == len(first_wins(made))
    found = runs.layout(spark, path)
    if fan_in == 2:
        assert max(m.level for m in found.merged) >= 2 and len(found.loose) <= 3
    else:
        assert not found.merged and len(found.loose) == 9


def test_replay_before_and_after_a_merge(spark, rows, tmp_path):
    path, made = str(tmp_path / "t"), batches(6)
    store(rows, path, made, 2)
    before = table(spark, path)
    for number in (5, 0, 2):  # the last one is not merged yet
        assert runs.append_unseen(rows(ROW, *made[number]), path, SCHEMA, "id", ("w", number), 2) == (0 if number < 5 else sum(r[1] // 100 == 5 for r in before if r[0]) + 1)
        assert table(spark, path) == before
    other = rows(ROW, ("id1", 1), ("new", 2), (None, 3))
    runs.append_unseen(other, path, SCHEMA, "id", ("other", 0), 2)
    known = {r[0] for r in before}
    assert len(table(spark, path)) == len(before) + 2 + ("id1" not in known)


def test_stored_ids_are_found_before_whole_rows_move(spark, rows, tmp_path, monkeypatch):
    """Few stored ids are broadcast, and none at all are not joined."""
    path, joins = str(tmp_path / "t"), []
    kind = type(rows(ROW, ("a", 1)))
    join = kind.join

    def watched(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if how == "left_anti":
            joins.append("ResolvedHint (strategy=broadcast)" in out._jdf.queryExecution().analyzed().toString())
        return out

    monkeypatch.setattr(kind, "join", watched)
    assert runs.append_unseen(rows(ROW, ("a", 1), ("b", 2), (None, 3)), path, SCHEMA, "id", ("w", 0)) == 3
    assert joins == []
    assert runs.append_unseen(rows(ROW, ("b", 4), ("c", 5), (None, 6)), path, SCHEMA, "id", ("w", 1)) == 2
    assert joins == [True]
    assert table(spark, path) == sorted([("a", 1), ("b", 2), (None, 3), ("c", 5), (None, 6)], key=str)


def test_merge_that_is_cut_off_is_not_seen(spark, rows, tmp_path, monkeypatch):
    path, made = str(tmp_path / "t"), batches(5)
    store(rows, path, made[:3], 1000)
    before = table(spark, path)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(spark, "createDataFrame", stop)  # the last write of a merge
        with pytest.raises(RuntimeError, match="lost"):
            runs.compact(spark, path, SCHEMA, "id", 2)
    assert table(spark, path) == before and not runs.layout(spark, path).merged
    runs.compact(spark, path, SCHEMA, "id", 2)
    assert table(spark, path) == before and len(runs.layout(spark, path).merged) == 1


def test_lookup_reads_only_the_buckets_it_hits(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(20_000).select(F.concat(F.lit("id"), "id").alias("id"), F.col("id").alias("value"))
    for number in range(3):
        part = many.where(F.col("value") % 3 == number)
        runs.append_unseen(part, path, SCHEMA, "id", ("w", number), 2)
    found = runs.layout(spark, path)
    assert len(found.merged) == 1
    ids = spark.read.parquet(f"{found.merged[0].path}/ids")
    assert ids.select("bucket").distinct().count() > 200 and ids.where(runs.bucket_of(F.xxhash64("id")) != F.col("bucket")).isEmpty()
    wanted = rows("id string", ("id0",), ("id1",), ("nowhere",))
    lookup = runs.stored_ids(spark, found, "id", wanted, ("w", 9))
    plan = lookup._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(hash" in plan
    scan = re.search(r"PartitionFilters: \[bucket[^\]]*\]", plan).group()
    buckets = {r[0] for r in wanted.select(runs.bucket_of(F.xxhash64("id"))).collect()}
    assert set(map(int, re.findall(r"\b\d+\b", scan.split("bucket", 1)[1].split("IN", 1)[1]))) == buckets
    assert {r[0] for r in lookup.collect()} == {"id0", "id1"}
    # a batch too large for pushed hashes meets the buckets in a join
    assert runs.stored_ids(spark, found, "id", many.select("id"), ("w", 9)).distinct().count() == 20_000


def test_batch_is_evaluated_once(spark, rows, tmp_path):
    """Every reading of the messages would draw other ids."""
    text = '{"alert_triggered": true, "transaction_id": "%s"}'
    source = spark.range(50).select(F.format_string(text, F.expr("uuid()")).alias("value"))
    path = str(tmp_path / "alerts")
    assert audit.ingest_alert_messages(source, path, 1, "t") == 50
    assert audit.read_table(spark, path, audit.ALERT_SCHEMA).count() == 50


def test_empty_batches_and_tables(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert table(spark, path) == []
    for number in range(4):
        assert runs.append_unseen(rows(ROW), path, SCHEMA, "id", ("w", number), 2) == 0
    assert table(spark, path) == []
    runs.append_unseen(rows(ROW, ("a", 1)), path, SCHEMA, "id", ("w", 4), 2)
    assert table(spark, path) == [("a", 1)]
