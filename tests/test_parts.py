"""How derived tables are cut into files and which columns they keep."""

import os

import pytest
from pyspark.sql import functions as F

from paywatch.plans import queries, views
from paywatch.session import BYTES_PER_TASK, Scratch, read_in_small_parts
from paywatch.sources import audit


def parts_with_rows(df):
    return df.groupBy(F.spark_partition_id()).count().count()


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    spark.range(200_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        rows = spark.read.parquet(str(tmp_path / "t"))
        cores = spark.sparkContext.defaultParallelism
        assert rows.rdd.getNumPartitions() >= cores and parts_with_rows(rows) == 1  # many parts, but one row group
        dealt = views.over_all_cores(rows)
        assert parts_with_rows(dealt) == cores
        assert dealt.agg(F.sum("id")).first() == rows.agg(F.sum("id")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_even_rows_stay_where_they_are(spark):
    rows = spark.range(0, 1000, 1, 8)
    assert views.over_all_cores(rows) is rows
    assert views.over_all_cores(spark.range(0)).count() == 0


def test_files_between_steps_have_few_rows(spark, monkeypatch):
    monkeypatch.setattr("paywatch.session.ROWS_PER_FILE", 1000)
    written = Scratch(spark, "parts").write(spark.range(0, 5000, 1, 1).toDF("id"), "rows")
    assert len(written.inputFiles()) == 5 and written.count() == 5000


@pytest.mark.parametrize("limit, kept", [("128m", BYTES_PER_TASK), ("1m", 1 << 20)])
def test_a_smaller_limit_of_the_session_stays(spark, limit, kept):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    try:
        read_in_small_parts(spark)
        assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == kept
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
def test_tables_between_steps_keep_only_what_is_read(spark):
    sf_dir = "/root/testdata/sf0.001"
    audited = set(audit.SCORED_SCHEMA.names)
    assert set(queries.scored(spark, sf_dir).columns) - audited == {"window_start"}
    assert set(queries.judged(spark, sf_dir).columns) <= audited
