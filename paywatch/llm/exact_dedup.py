"""Exact dedup by Grace hashing.

Records are dealt to buckets by a hash of their content; a bucket is worked off with an open-addressing
table that compares complete contents. The spill files are Spark's: what does not fit the table of a
bucket goes, with its content, to a table in the shared folder and is dealt out again with another hash
and more buckets, until nothing is left over. A content that is resident in a table absorbs all its
copies in that bucket, so a content with very many copies takes one slot. The same table runs before
the shuffle and sends each content once per task, however many copies the task has read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paywatch.llm.common import WHITE_SPACE, Rows, map_arrow, parts_for, text_bytes, texts_of
from paywatch.session import Scratch

TABLE_BYTES = 48 << 20
BUCKET_BYTES = 24 << 20
MAX_LEVELS = 60


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte.

    Each entry keeps how many rows it stands for and the best of them: most code points, then smallest
    id (a missing id comes last), and how many rows tie for it.
    """

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.slots = [-1] * 1024
        self.tags: list[int] = []
        self.entries: list[list] = []
        self.size = 0

    def _slot(self, tag: int, body: bytes) -> int:
        mask = len(self.slots) - 1
        at = tag & mask
        while (entry := self.slots[at]) >= 0:
            if self.tags[entry] == tag and self.entries[entry][1] == body:
                break
            at = (at + 1) & mask
        return at

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, tag in enumerate(self.tags):
            at = tag & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry

    def add(self, digest: bytes, body: bytes, size: int, n: int, key: int | None, ties: int) -> bool:
        """False if the content is new and there is no room for it; a first entry always has room."""
        tag = int.from_bytes(digest[:8], "little")
        at = self._slot(tag, body)
        entry = self.slots[at]
        if entry < 0:
            if self.entries and self.size + len(body) > self.limit:
                return False
            self.slots[at] = len(self.entries)
            self.tags.append(tag)
            self.entries.append([digest, body, size, n, key, ties])
            self.size += len(body) + 200
            if 2 * len(self.entries) > len(self.slots):
                self._grow()
            return True
        kept = self.entries[entry]
        kept[2] += size
        rank, best = (-n, key is None, key or 0), (-kept[3], kept[4] is None, kept[4] or 0)
        if rank < best:
            kept[3:] = n, key, ties
        elif rank == best:
            kept[5] += ties
        return True


CONTENT = "digest binary, body binary, size bigint, n bigint, key bigint, ties bigint"
CONTENT_ARROW = pa.schema(
    [("digest", pa.binary()), ("body", pa.binary()), ("size", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("ties", pa.int64())]
)


def normalised(text: bytes) -> bytes:
    return text.translate(None, WHITE_SPACE)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as they are, with `_n` and `_digest` in place of the text."""
    for batch in batches:
        text = batch.column(1)
        found = [sha256(normalised(t)).digest() for t in texts_of(text)]
        n = pc.fill_null(pc.utf8_length(text), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), n, pa.array(found, pa.binary())], names=["key", "n", "digest"])


def _combine(limit: int):
    """Each content once per task, unless the task reads more different contents than the table holds."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = ContentTable(limit), Rows(CONTENT_ARROW)
        for batch in batches:
            lengths = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()
            for key, n, text in zip(batch.column(0).to_pylist(), lengths, texts_of(batch.column(1))):
                body = normalised(text)
                digest = sha256(body).digest()
                if not held.add(digest, body, 1, n, key, 1):
                    for entry in held.entries:
                        yield from out.add(len(entry[1]), *entry)
                    held.clear()
                    held.add(digest, body, 1, n, key, 1)
        for entry in held.entries:
            yield from out.add(len(entry[1]), *entry)
        yield from out.flush()

    return task


def _bucket(limit: int):
    """A bucket: resident contents come out finished (no body), the rest with its body for the next level."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = ContentTable(limit), Rows(CONTENT_ARROW)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if not held.add(*row):
                    yield from out.add(len(row[1]), *row)
        for digest, _, *rest in held.entries:
            yield from out.add(0, digest, None, *rest)
        yield from out.flush()

    return task


def content_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """One row per content: digest, size (rows), and n, key and ties of the row that stays."""
    scratch = Scratch(docs.sparkSession, "exact")
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    left = map_arrow(source, _combine(table_bytes), CONTENT)
    buckets = parts_for(text_bytes(docs, text), bucket_bytes)
    done: DataFrame | None = None
    for level in range(MAX_LEVELS):
        dealt = left.repartition(buckets, F.xxhash64("digest", F.lit(level)))
        spilled = F.sum(F.octet_length("body"))
        # every level is read again by the result, so none is freed
        found, seen = scratch.write_with(map_arrow(dealt, _bucket(table_bytes), CONTENT), f"level{level}", spilled=spilled)
        finished = found.where(F.col("body").isNull()).drop("body")
        done = finished if done is None else done.unionByName(finished)
        if not seen["spilled"]:
            return done
        left = found.where(F.col("body").isNotNull())
        buckets = parts_for(seen["spilled"], bucket_bytes, least=2)
    raise RuntimeError(f"Contents did not fit their tables after {MAX_LEVELS} levels.")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """For every row its group of equal contents: key, keep_id, group_size, kept, text_sha256, ties.

    Contents are equal when equal without ASCII white space; a missing text is empty. Of a group the row
    with the most code points stays, then the smallest id; a missing id comes last and is kept only if
    the group has no other. Rows that repeat an id and a length are equally kept; `ties` counts them, and
    `drop_copies` leaves one. An empty table gives an empty result.
    """
    rows = map_arrow(
        docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")),
        _digests,
        "key bigint, n bigint, digest binary",
    )
    classes = content_classes(docs, key, text, **sizes).select(
        "digest", "size", F.col("n").alias("_n"), F.col("key").alias("keep_id"), "ties"
    )
    # the row side of one hot content is split by adaptive execution, its class is a single row
    return rows.join(classes, "digest").select(
        F.col("key").alias(key),
        "keep_id",
        F.col("size").alias("group_size"),
        (F.col("key").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("_n"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "ties",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """The rows that stay, one for every content, with the columns of `docs`."""
    body = F.encode(F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), "[ \t\n\u000b\f\r]+", ""), "UTF-8")
    own = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.unhex(F.sha2(body, 256)).alias("own_digest"),
        F.coalesce(F.char_length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("own_n"),
        F.col(key).cast("long").alias("own_key"),
    )
    classes = content_classes(docs, key, text, **sizes)
    # the id is part of the join key, so the copies of one content spread over all tasks
    same = (F.col("digest") == F.col("own_digest")) & (F.col("n") == F.col("own_n")) & F.col("key").eqNullSafe(F.col("own_key"))
    kept = own.join(classes, same)
    if classes.where("ties > 1").isEmpty():
        return kept.select("row.*")
    again = kept.where("ties > 1").dropDuplicates(["digest"])
    return kept.where("ties = 1").unionByName(again).select("row.*")
