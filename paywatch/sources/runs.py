"""Tables that grow by batches and store every id once, without reading their history for each batch.

A table is a folder of runs. A batch writes its rows as a run of its own (`writer=<w>/write_id=<n>`) and
replaces that run when it is repeated. When many batch runs have gathered, they are merged into one larger
run; merged runs are merged again in levels, so a row is rewritten only a few times however long the table
grows. A merged run has

* `rows`: the rows;
* `ids`: its ids with their 64-bit hashes, cut into buckets by the first bits of the hash, sorted by hash,
  with Parquet Bloom filters on it: a lookup opens only the buckets, and in them only the pages, it needs;
* `batches`: which batches it holds. It is written last, and the run counts only when it is there.

So nothing is ever switched or renamed: a reader takes the complete runs that no complete larger run
contains, and a merge that is cut off leaves nothing visible behind. The ids of the few unmerged batches are
read from their rows. One process at a time writes to a table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from paywatch.operators.skew import BROADCAST_ROWS
from paywatch.session import Scratch, delete_path

#: Buckets of a merged run, by the first eight bits of the hash; ids in a file of one.
BUCKETS = 256
IDS_PER_FILE = 4_000_000
BYTES_PER_FILE = 256 << 20

#: Runs of a level that are merged into one of the next.
FAN_IN = 32

#: Ids of a batch up to which their hashes are pushed down to the scan of the buckets.
SEEK_IDS = 5_000

Batch = tuple[str, int]


@dataclass(frozen=True)
class Merged:
    """A complete merged run."""

    path: str
    level: int
    batches: frozenset[Batch]
    rows: int


@dataclass(frozen=True)
class Layout:
    """The runs of a table that hold its rows: batches not merged yet, and merged runs."""

    loose: dict[Batch, str]
    merged: list[Merged]

    def holds(self, batch: Batch) -> bool:
        return any(batch in run.batches for run in self.merged)


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [s.getPath().getParent().toString() for s in found or []]


def _parts(path: str) -> dict[str, str]:
    return dict(piece.split("=", 1) for piece in path.split("/") if "=" in piece)


def layout(spark: SparkSession, path: str) -> Layout:
    """The runs to read; writes that are under way or were cut off are not seen."""
    merged = []
    for folder in _glob(spark, f"{path}/_merged/level=*/run=*/batches/_SUCCESS"):
        run = folder.rsplit("/", 1)[0]
        listed = spark.read.parquet(folder).collect()  # names of batches
        batches = frozenset((r["writer"], r["write_id"]) for r in listed)
        merged.append(Merged(run, int(_parts(run)["level"]), batches, listed[0]["rows"]))
    live = [m for m in merged if not any(o.level > m.level and m.batches <= o.batches for o in merged)]
    held = {b for m in live for b in m.batches}
    loose = {}
    for run in _glob(spark, f"{path}/writer=*/write_id=*/_SUCCESS"):
        parts = _parts(run)
        batch = parts["writer"], int(parts["write_id"])
        if batch not in held:
            loose[batch] = run
    return Layout(loose, sorted(live, key=lambda m: m.path))


def run_path(path: str, batch: Batch) -> str:
    return f"{path}/writer={batch[0]}/write_id={batch[1]}"


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All stored rows; an empty table while nothing was written."""
    found = layout(spark, path)
    paths = [*found.loose.values(), *(f"{m.path}/rows" for m in found.merged)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def count_rows(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """How many rows are stored: merged runs know it, of the others the Parquet footers are read."""
    found = layout(spark, path)
    loose = spark.read.schema(schema).parquet(*found.loose.values()).count() if found.loose else 0
    return loose + sum(m.rows for m in found.merged)


def hash_of(key: str) -> Column:
    return F.xxhash64(key)


def bucket_of(number: Column) -> Column:
    return (F.shiftright(number, 56) + BUCKETS // 2).cast("int")


def stored_ids(spark: SparkSession, found: Layout, key: str, wanted: DataFrame, own: Batch) -> DataFrame:
    """Those of the ids `wanted` (one column) that a run other than that of the batch `own` holds; they may repeat.

    Only the buckets of merged runs that the ids fall into are read, for few ids only the pages of their hashes.
    """
    name = wanted.columns[0]
    hashed = wanted.select(F.col(name).alias(key), hash_of(name).alias("hash"))
    seen = hashed.agg(
        F.count(F.lit(1)).alias("n"),
        F.collect_set(bucket_of(F.col("hash"))).alias("buckets"),  # BUCKETS at most
    ).first()
    few = seen["n"] <= BROADCAST_ROWS
    parts: list[DataFrame] = []
    kind = wanted.schema[name].dataType
    paths = [p for b, p in found.loose.items() if b != own]
    if paths:
        parts.append(spark.read.schema(T.StructType([T.StructField(key, kind)])).parquet(*paths).where(F.col(key).isNotNull()))
    if found.merged and seen["n"]:
        pushed = F.lit(True)
        if seen["n"] <= SEEK_IDS:
            pushed = F.col("hash").isin([r[0] for r in hashed.select("hash").collect()])
        for run in found.merged:
            ids = spark.read.schema(f"id {kind.simpleString()}, hash long, bucket int").parquet(f"{run.path}/ids")
            parts.append(ids.where(F.col("bucket").isin(seen["buckets"]) & pushed).select(F.col("id").alias(key)))
    if not parts:
        return wanted.select(F.col(name).alias(key)).limit(0)
    held = parts[0]
    for part in parts[1:]:
        held = held.unionByName(part)
    ids = hashed.select(key).distinct()
    return held.join(F.broadcast(ids) if few else ids, key, "left_semi")


def append_unseen(
    first: DataFrame, path: str, schema: T.StructType, key: str, batch: Batch, fan_in: int = FAN_IN
) -> int:
    """Store the rows whose id no other batch stored, and all without id; returns how many.

    `first` has every id once. A batch that was merged already is stored, so nothing is written again.
    """
    spark = first.sparkSession
    found = layout(spark, path)
    if found.holds(batch):
        return 0
    # the batch is looked at three times: for its buckets, for the lookup and for the write
    first = first.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        named = first.where(F.col(key).isNotNull())
        known = stored_ids(spark, found, key, named.select(key), batch).distinct()
        # only ids are moved to find the stored ones, which are few unless batches overlap; then no whole row moves
        known, seen = Scratch(spark, "known").write_with(known, "ids", size=F.count(F.lit(1)))
        fresh = first
        if seen["size"]:
            # rows without an id match nothing; in the join they would all meet in one task
            rest = named.join(F.broadcast(known) if seen["size"] <= BROADCAST_ROWS else known, key, "left_anti")
            fresh = rest.unionByName(first.where(F.col(key).isNull()))
        counted = Observation()
        shaped = fresh.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        shaped.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(run_path(path, batch))
    finally:
        first.unpersist()
    compact(spark, path, schema, key, fan_in)
    return counted.get["rows"]


def _size(spark: SparkSession, paths: list[str]) -> int:
    total = 0
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        total += folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return total


def _merge(spark: SparkSession, path: str, schema: T.StructType, key: str, level: int, sources: list[str], batches: list[Batch]) -> None:
    run = f"{path}/_merged/level={level}/run={uuid.uuid4().hex}"
    rows = spark.read.schema(schema).parquet(*sources)
    files = -(-_size(spark, sources) // BYTES_PER_FILE)
    counted = Observation()
    rows.repartition(max(1, files)).observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(f"{run}/rows")
    stored = spark.read.schema(schema).parquet(f"{run}/rows")
    ids = stored.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), hash_of(key).alias("hash"))
    count = ids.count()
    dealt = ids.repartitionByRange(max(1, -(-count // IDS_PER_FILE)), "hash")
    (
        dealt.withColumn("bucket", bucket_of(F.col("hash")))
        .sortWithinPartitions("bucket", "hash")
        .write.partitionBy("bucket")
        .option("parquet.bloom.filter.enabled#hash", "true")
        .option("parquet.bloom.filter.expected.ndv#hash", str(max(1, min(count, IDS_PER_FILE) * 2 // BUCKETS)))
        .parquet(f"{run}/ids")
    )
    listed = [(writer, write_id, counted.get["rows"]) for writer, write_id in batches]
    spark.createDataFrame(listed, "writer string, write_id long, rows long").coalesce(1).write.parquet(f"{run}/batches")


def compact(spark: SparkSession, path: str, schema: T.StructType, key: str, fan_in: int = FAN_IN) -> None:
    """Merge runs wherever a level has gathered `fan_in` of them, and delete the runs that larger ones replaced.

    Runs replaced by this call stay until the next one, for readers that have just listed them.
    """
    found = layout(spark, path)
    _delete_replaced(spark, path, found)
    newest: dict[str, int] = {}
    for writer, write_id in found.loose:
        newest[writer] = max(newest.get(writer, write_id), write_id)
    # the last batch of a writer may be repeated, and then differ
    settled = sorted(b for b in found.loose if b[1] != newest[b[0]])
    if len(settled) >= fan_in:
        _merge(spark, path, schema, key, 1, [found.loose[b] for b in settled], settled)
        found = layout(spark, path)
    level = 1
    while any(m.level >= level for m in found.merged):
        runs = [m for m in found.merged if m.level == level]
        if len(runs) >= max(2, fan_in):
            _merge(spark, path, schema, key, level + 1, [f"{m.path}/rows" for m in runs], sorted(b for m in runs for b in m.batches))
            found = layout(spark, path)
        level += 1


def _delete_replaced(spark: SparkSession, path: str, found: Layout) -> None:
    for run in _glob(spark, f"{path}/writer=*/write_id=*/_SUCCESS"):
        if run not in found.loose.values():
            delete_path(spark, run)
    live = {m.path for m in found.merged}
    for folder in _glob(spark, f"{path}/_merged/level=*/run=*/batches/_SUCCESS"):
        run = folder.rsplit("/", 1)[0]
        if run not in live:
            delete_path(spark, run)
