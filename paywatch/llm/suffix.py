"""Suffix-array dedup over bytes by threshold-bounded interval expansion.

Segments that may share windows (see `anchors`) meet in blocks. A block's segments, one after the other,
are suffix-sorted; from the Burrows-Wheeler transform the common prefixes of neighbouring suffixes are
derived by increasing value: the interval of a string is extended backwards by every symbol found before
it, breadth first, and the right border of each new interval has the length of the string as its common
prefix. The expansion stops at the minimum length: borders not reached by then join suffixes that share
at least that many bytes, and those are the repeated windows.

An anchor with more different segments than a block takes is dealt out by the hash of each of its windows
instead, so no group has to fit one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywatch.llm.anchors import Sums, byte_units, covered, identified, repeat_candidates
from paywatch.llm.common import Rows, map_arrow, parts_for, text_bytes, texts_of
from paywatch.session import Scratch

LENGTH = 400
GRAM = 192
BLOCK_BYTES = 1 << 20
GROUP_SEGMENTS = 2_000
PART_BYTES = 24 << 20


def suffix_order(symbols: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Sorted suffixes of strings laid end to end, each with an end mark of its own (at `ends`, symbol 0).

    Doubling; only suffixes that still tie are sorted again. Strings are not longer than `depth`.
    """
    n = len(symbols)
    packed = np.zeros(n, np.int64)
    alive = np.ones(n, bool)
    for step in range(6):
        shifted = np.zeros(n, np.int64)
        shifted[: n - step] = symbols[step:]
        packed = (packed << 9) | np.where(alive, shifted, 0)
        alive &= shifted > 0  # nothing counts behind an end mark
    # suffixes that reach their end mark within the packed symbols are told apart by its number
    owner = np.searchsorted(ends, np.arange(n))
    tie = np.where(alive, 0, owner + 1)
    order = np.lexsort((tie, packed))
    new = np.ones(n, bool)
    new[1:] = (packed[order][1:] != packed[order][:-1]) | (tie[order][1:] != tie[order][:-1])
    first = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    width = 6
    while width < depth:
        sizes = np.diff(np.append(first, n))
        tied = np.repeat(sizes > 1, sizes)
        if not tied.any():
            break
        places = np.flatnonzero(tied)
        own = order[places]
        # a tied suffix has no end mark within `width`, so the next one lies in the same string
        keys = rank[own] * n + rank[own + width]
        again = np.argsort(keys, kind="stable")
        order[places] = own[again]
        keys = keys[again]
        new = ~tied
        split = np.ones(len(places), bool)
        split[1:] = keys[1:] != keys[:-1]
        new[places] = split
        first = np.flatnonzero(new)
        rank[order] = np.repeat(first, np.diff(np.append(first, n)))
        width *= 2
    return order


def long_borders(symbols: np.ndarray, ends: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Borders i for which suffixes i - 1 and i of the order share at least `length` symbols.

    Breadth-first backward extension: all intervals of strings of one length are extended at once. The
    suffixes of an interval that follow the same symbol c form the interval of c + string, and
    `before` maps each of them there.
    """
    n, strings = len(symbols), len(ends)
    transform = np.where(order > 0, symbols[order - 1], 0)
    # place of the suffix that starts one symbol earlier: symbols in order, then the order they have here
    by_symbol = np.argsort(transform, kind="stable")
    before = np.empty(n, np.int64)
    before[by_symbol] = np.arange(n)
    # suffixes that start with an end mark come first, and nothing extends over one
    assert strings == int((transform == 0).sum())
    open_border = np.ones(n + 1, bool)
    open_border[0] = open_border[n] = False
    open_border[: strings + 1] = False  # end marks share nothing with each other, nor with what follows
    # intervals of single symbols, every end mark one of its own
    symbol_at = symbols[order]
    level_first = np.flatnonzero(np.diff(symbol_at, prepend=0))
    open_border[level_first] = False
    left = np.concatenate((np.arange(strings), level_first))
    right = np.append(left[1:], n)
    for _ in range(1, length):
        if not len(left):
            break
        sizes = right - left
        total = int(sizes.sum())
        offsets = np.repeat(left - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        member = offsets + np.arange(total)
        of = np.repeat(np.arange(len(left)), sizes)
        keep = transform[member] > 0
        to, of = before[member[keep]], of[keep]
        if not len(to):
            break
        # inside an interval the members with one symbol map to neighbouring places
        rank = np.lexsort((to, of))
        to, of = to[rank], of[rank]
        cut = np.ones(len(to), bool)
        cut[1:] = (of[1:] != of[:-1]) | (to[1:] != to[:-1] + 1) | (symbol_at[to[1:]] != symbol_at[to[:-1]])
        start = np.flatnonzero(cut)
        stop = np.append(start[1:], len(to)) - 1
        left, right = to[start], to[stop] + 1
        fresh = open_border[right]
        left, right = left[fresh], right[fresh]
        open_border[right] = False
    return np.flatnonzero(open_border)


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """Per string, where a window of `length` bytes starts that also starts elsewhere in the strings."""
    lengths = np.array([len(s) for s in strings]) + 1
    symbols = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
    ends = np.cumsum(lengths) - 1
    symbols[ends] = 0
    order = suffix_order(symbols, ends, int(lengths.max()))
    borders = long_borders(symbols, ends, order, length)
    starts = np.unique(np.concatenate((order[borders], order[borders - 1])))
    owner = np.searchsorted(ends, starts)
    first = ends - lengths + 1
    cuts = np.searchsorted(owner, np.arange(len(strings) + 1))
    return [starts[a:b] - f for a, b, f in zip(cuts[:-1].tolist(), cuts[1:].tolist(), first.tolist())]


RUN = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("first", pa.int32()), ("count", pa.int32())])
RUN_SQL = "doc bigint, tag bigint, first int, count int"


def _cut(length: int):
    """The bytes of every open segment of a text."""
    schema = pa.schema([("gram", pa.int64()), ("copies", pa.int8()), *RUN, ("bytes", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            rows = zip(texts_of(batch.column("text")), *(batch.column(c).to_pylist() for c in ("doc", "tag", "open")))
            for text, doc, tag, found in rows:
                for r in found:
                    body = text[r["first"] : r["first"] + r["count"] - 1 + length]
                    yield from out.add(len(body), r["gram"], r["copies"], doc, tag, r["first"], r["count"], body)
        yield from out.flush()

    return task


def _runs(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(starts):
        cuts = np.flatnonzero(np.diff(starts, prepend=starts[0] - 2) > 1)
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(starts)]):
            yield int(starts[a]), b - a


def _expand(length: int, block_bytes: int):
    """Blocks of whole groups (rows come by anchor); the repeated starts of their segments as runs."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(RUN)

        def block(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            strings, owners = [], []
            for row in rows:
                strings.append(row[-1])
                owners.append(row)
                if row[1] > 1:  # it stands for several copies
                    strings.append(row[-1])
                    owners.append(None)
            for owner, starts in zip(owners, repeated_starts(strings, length)):
                if owner is not None:
                    _, _, doc, tag, first, _, _ = owner
                    for at, count in _runs(starts):
                        yield from out.add(24, doc, tag, first + at, count)

        held: list[tuple] = []
        size, gram = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != gram and size >= block_bytes:
                    yield from block(held)
                    held, size = [], 0
                gram = row[0]
                held.append(row)
                size += len(row[-1]) * row[1]
        if held:
            yield from block(held)
        yield from out.flush()

    return task


def _window_hashes(length: int):
    """Each window of a segment by two hashes, once per task; copies inside the task are told at once."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("copies", pa.int8()), *list(RUN)[:3]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                sums = Sums(byte_units(row[-1]))
                n = row[5]
                copies, doc, tag = (np.full(n, row[i]) for i in (1, 2, 3))
                found.append((sums.grams(length, 0), sums.grams(length, 1), copies, doc, tag, row[4] + np.arange(n)))
            if found:
                columns = [np.concatenate(c) for c in zip(*found)]
                arrays = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c).cast(f.type) for c, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return task


def repeated_runs(
    rows: DataFrame, total_bytes: int, length: int = LENGTH, gram: int | None = None,
    block_bytes: int = BLOCK_BYTES, group_segments: int = GROUP_SEGMENTS,
) -> DataFrame:
    """Runs (doc, tag, first, count) of windows of `length` bytes that also start elsewhere, of `identified` rows."""
    scratch = Scratch(rows.sparkSession, "suffix")
    gram = gram or max(4, length * GRAM // LENGTH)
    found, seen = scratch.write_with(
        repeat_candidates(rows, total_bytes, lambda: byte_units, length, gram, 1.0, keep_first=False),
        "found",
        open_bytes=F.sum(F.when(F.col("kind") == 1, F.col("count") + length).cast("long")),
    )
    settled = found.where("kind = 0").select("doc", "tag", "first", "count")
    groups = found.where("kind = 1").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group_segments)
    large = scratch.write(groups, "large")  # at most segments / limit rows
    open_runs = (
        found.where("kind = 1")
        .groupBy("doc", "tag")
        .agg(F.collect_list(F.struct("gram", "copies", "first", "count")).alias("open"))
    )
    texts = rows.join(open_runs, ["doc", "tag"])
    schema = f"gram bigint, copies tinyint, {RUN_SQL}, bytes binary"
    cut = map_arrow(texts, _cut(length), schema)
    if large.isEmpty():
        return settled.unionByName(_expanded(cut, seen["open_bytes"], length, block_bytes))
    # all read the same shuffled texts, which is cheaper than to store what is cut from them
    small = cut.join(large.select("gram"), "gram", "left_anti").select(*cut.columns)
    hot = cut.join(large.select("gram"), "gram", "left_semi").select(*cut.columns)
    windows = map_arrow(hot, _window_hashes(length), "a bigint, b bigint, copies tinyint, doc bigint, tag bigint, first int")
    again = windows.groupBy("a", "b").agg(F.sum("copies").alias("n")).where("n > 1").select("a", "b")
    repeated = windows.join(again, ["a", "b"]).select("doc", "tag", "first", F.lit(1).alias("count"))
    return settled.unionByName(_expanded(small, seen["open_bytes"], length, block_bytes)).unionByName(repeated)


def _expanded(cut: DataFrame, total: int | None, length: int, block_bytes: int) -> DataFrame:
    dealt = cut.repartition(parts_for(total, PART_BYTES // 2), "gram").sortWithinPartitions("gram")
    return map_arrow(dealt, _expand(length, block_bytes), RUN_SQL)


def _digest(length: int, with_text: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(texts_of(batch.column("text")), batch.column("runs").to_pylist()):
                kept, spans = text, 0
                if runs:
                    first, count = (np.array([r[c] for r in runs]) for c in ("first", "count"))
                    gone = covered(first, count, length, len(text))
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                out.append((len(text), len(text) - len(kept), spans, sha256(kept).hexdigest(), kept if with_text else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns], names=names)

    return task


def drop_repeated_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = True, **sizes: int
) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256 and (`with_text`) the kept bytes.

    A byte goes if it lies in a string of `length` bytes that also starts anywhere else, in this text or
    another; strings never cross texts and are judged on the input. A missing text is empty; shorter texts
    lose nothing. Repeated rows are texts of their own, so each repeats the other. An empty table gives
    an empty result. The kept bytes need not be valid UTF-8, as a cut may fall inside a character.
    """
    total = text_bytes(docs, text)
    rows = identified(docs, key, text)
    gone = repeated_runs(rows, total, length, **sizes).groupBy("doc", "tag").agg(F.collect_list(F.struct("first", "count")).alias("runs"))
    texts = rows.join(gone, ["doc", "tag"], "left")
    found = map_arrow(texts.select("doc", "text", "runs"), _digest(length, with_text),
                      "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return found.select(
        F.when(F.col("doc") < (1 << 63) - 1, F.col("doc")).alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"
    )
