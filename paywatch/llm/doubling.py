"""Substring dedup by level-wise doubling over words.

Windows that repeat at one length are extended to twice that length, and those that still repeat go on,
until the wanted length is reached or no candidate survives. The first level, a quarter of the length, is
looked at where windows are anchored only (see `anchors`); the runs of windows around anchors that repeat
are extended to half of the length and then to all of it, by hashes that the texts yield in one pass.
Texts move to their runs twice, compressed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywatch.llm.anchors import WordUnits, Sums, covered, identified, repeat_candidates
from paywatch.llm.common import Rows, map_arrow, packed, text_bytes, unpacked
from paywatch.session import Scratch

WINDOW = 20

#: Bytes of a word and the space after it, to size shuffles only.
WORD_BYTES = 6.5


def _levels(window: int):
    """Per open segment the hashes of the half-length windows beside its anchor and of all its windows."""
    quarter, half = window // 4, window // 2
    schema = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("first", pa.int32()), ("left", pa.int64()), ("right", pa.int64()),
                        ("place", pa.int32()), ("hashes", pa.list_(pa.int64()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = WordUnits()
        out = Rows(schema)
        for batch in batches:
            texts = unpacked(batch.column("text"))
            for doc, tag, text, found in zip(batch.column("doc").to_pylist(), batch.column("tag").to_pylist(), texts, batch.column("open").to_pylist()):
                own = units(text)
                sums = Sums(own)
                last = len(own) - half
                for run in found:
                    first, count, place = run["first"], run["count"], run["place"]
                    starts = np.arange(first, first + count)
                    sides = np.clip([first + place - (half - quarter), first + place], 0, last)
                    left, right = sums.runs(sides, sides + half).view(np.int64).tolist()
                    hashes = sums.runs(starts, starts + window).view(np.int64).tolist()
                    yield from out.add(60 + 8 * count, doc, tag, first, left, right, place, hashes)
        yield from out.flush()

    return task


def _digest(window: int, with_text: bool):
    schema = pa.schema([("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                        ("kept", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            rows = zip(batch.column("doc").to_pylist(), unpacked(batch.column("text")), batch.column("runs").to_pylist())
            for doc, text, runs in rows:
                words = text.split()
                if runs:
                    gone = covered(np.array([r["first"] for r in runs]), np.array([r["count"] for r in runs]), window, len(words))
                    kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
                else:
                    kept = words
                body = b" ".join(kept)
                found = (doc, len(words), len(words) - len(kept), sha256(body).hexdigest(), body if with_text else None)
                yield from out.add(100 + len(body) * with_text, *found)
        yield from out.flush()

    return task


def repeated_runs(rows: DataFrame, total_bytes: int, window: int = WINDOW) -> DataFrame:
    """Runs (doc, tag, first, count) of windows whose words also start earlier, of `identified` rows.

    Earlier is in a document with a smaller (id, tag), or in the same one at an earlier word.
    """
    if window % 4 or window < 8:
        raise ValueError("The window must be a multiple of 4, 8 at least.")
    quarter, half = window // 4, window // 2
    scratch = Scratch(rows.sparkSession, "doubling")
    found = scratch.write(repeat_candidates(rows, total_bytes, WordUnits, window, quarter, WORD_BYTES, keep_first=True), "found")
    settled = found.where("kind = 0").select("doc", "tag", "first", "count")
    open_runs = found.where("kind = 1").groupBy("doc", "tag").agg(F.collect_list(F.struct("first", "count", "place")).alias("open"))
    texts = packed(rows, ["doc", "tag"]).join(open_runs, ["doc", "tag"])
    schema = "doc bigint, tag bigint, first int, left bigint, right bigint, place int, hashes array<bigint>"
    runs, seen = scratch.write_with(map_arrow(texts, _levels(window), schema), "runs", rows=F.count(F.lit(1)))

    # half of the length: a side of an anchor goes on if other segments have the same
    id_ = ["doc", "tag", "first"]
    sides = runs.select(*id_, F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("hash")),
                                                F.struct(F.lit(1).alias("side"), F.col("right").alias("hash")))).alias("s")).select(*id_, "s.*")
    again = sides.groupBy("hash").agg(F.count_distinct(*id_).alias("n")).where("n > 1").select("hash")
    alive = sides.join(again, "hash").groupBy(*id_).agg(
        F.max(F.col("side") == 0).alias("left_on"), F.max(F.col("side") == 1).alias("right_on")
    )
    # all of it: a window goes on if the halves it holds beside its anchor do
    windows = (
        runs.join(alive, id_)
        .select("doc", "tag", "first", "place", "left_on", "right_on", F.posexplode("hashes").alias("step", "hash"))
        .withColumn("before", F.col("place") - F.col("step"))  # words of the window before its anchor
        .where((F.col("left_on") | (F.col("before") < half - quarter)) & (F.col("right_on") | (F.col("before") > half)))
        .select("hash", F.struct("doc", "tag", (F.col("first") + F.col("step")).alias("first")).alias("at"))
    )
    first_at = windows.groupBy("hash").agg(F.min("at").alias("head"), F.max("at").alias("last")).where("last > head")
    later = windows.join(first_at, "hash").where("at > head").select("at.doc", "at.tag", "at.first", F.lit(1).alias("count"))
    return settled.unionByName(later)


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Per row: key, n_words, n_removed, kept_sha256 and (`with_text`) the kept words, one space between them.

    A word goes if it lies in a window of `window` words that also starts earlier: in a row with a smaller
    id, or in the same one before. Windows are judged on the input. Words stand between ASCII white
    space and are compared as they are. A missing text has no words; shorter texts lose nothing; a
    missing id comes after all others. Rows that repeat id and text are one document and get the same
    answer, rows that share just the id are ordered by a hash of their text. An empty table gives an
    empty result.
    """
    total = text_bytes(docs, text)
    rows = identified(docs, key, text)
    gone = repeated_runs(rows, total, window).groupBy("doc", "tag").agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    texts = packed(rows, ["doc", "tag"]).join(gone, ["doc", "tag"], "left")
    found = map_arrow(texts.select("doc", "text", "runs"), _digest(window, with_text),
                      "doc bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    return found.select(
        F.when(F.col("doc") < (1 << 63) - 1, F.col("doc")).alias(key), "n_words", "n_removed", "kept_sha256", "kept"
    )
