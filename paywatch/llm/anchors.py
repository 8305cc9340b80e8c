"""Where windows of a fixed length may repeat, found without moving texts.

Every window of W units (bytes or words) has an anchor: of the k-unit grams in it, the leftmost one with
the smallest hash. Equal windows have equal anchors at equal places, so it is enough to compare windows
whose anchors are equal. Neighbouring windows mostly share an anchor; such a run of window starts and the
units it covers, a segment, is the item of exchange: a few numbers instead of a text.

Segments that are equal are settled by their hashes alone: their windows repeat, all of them. Only where
an anchor has several different segments is it open which of their windows agree, and only one copy of
each different segment goes on to be compared.

Copies are merged inside each task before the shuffle. An anchor that brings many different segments in
one task (a frequent passage in ever new surroundings) is salted: its segments are spread over tasks, as
it is known to be open, and a marker tells its other segments so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, functions as F

from paywatch.llm.common import map_arrow, parts_for, texts_of

FLUSH_BYTES = 16 << 20
SLICE = 1 << 20
SALTED_SEGMENTS = 8
SALTS = 64
TASK_ROWS = 400_000

BASES = tuple(np.uint64(b) for b in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in BASES)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of the bases and of their inverses, grown on demand."""

    def __init__(self) -> None:
        self.size = 0

    def get(self, n: int) -> list[np.ndarray]:
        if n > self.size:
            self.size = max(n, 2 * self.size, 1 << 12)
            self.tables = []
            for factor in (*BASES, *INVERSES):
                column = np.full(self.size, factor, np.uint64)
                column[0] = 1
                self.tables.append(np.multiply.accumulate(column))
        return self.tables


POWERS = Powers()


class Sums:
    """Hashes of any run of units from running sums: (sum of unit * base^place) / base^first."""

    def __init__(self, units: np.ndarray) -> None:
        n = len(units)
        tables = POWERS.get(n + 1)
        self.back = tables[2:]
        self.sums = []
        for powers in tables[:2]:
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(units * powers[:n], out=total[1:])
            self.sums.append(total)

    def grams(self, length: int, base: int = 0) -> np.ndarray:
        total = self.sums[base]
        n = len(total) - length
        return mixed((total[length:] - total[:n]) * self.back[base][:n])

    def runs(self, first: np.ndarray, stop: np.ndarray, base: int = 1) -> np.ndarray:
        total = self.sums[base]
        return mixed((total[stop] - total[first]) * self.back[base][first] + (stop - first).astype(np.uint64))


BYTE_UNITS = mixed(np.arange(1, 257, dtype=np.uint64) * BASES[0])


def byte_units(text: bytes) -> np.ndarray:
    return BYTE_UNITS[np.frombuffer(text, np.uint8)]


class WordUnits(dict):
    """Hash of each word; remembers words up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter((self[w] for w in words), np.uint64, len(words))


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in every window of `width`."""
    n = len(values) - width + 1
    if width <= 32:
        return sliding_window_view(values, width).argmin(axis=1) + np.arange(n)
    # a window spans the end of one block and the start of the next; both have running minima
    blocks = -(-len(values) // width)
    table = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    table[: len(values)] = values
    table = table.reshape(blocks, width)
    place = np.arange(blocks * width).reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1)
    fresh = np.ones(table.shape, bool)
    fresh[:, 1:] = table[:, 1:] < ahead[:, :-1]
    ahead_at = np.maximum.accumulate(np.where(fresh, place, 0), axis=1).ravel()
    turned = table[:, ::-1]
    back = np.minimum.accumulate(turned, axis=1)
    fresh = np.ones(table.shape, bool)
    fresh[:, 1:] = turned[:, 1:] <= back[:, :-1]
    back_at = np.minimum.accumulate(np.where(fresh, place[:, ::-1], blocks * width), axis=1)[:, ::-1].ravel()
    start = np.arange(n)
    behind, before = back_at[:n], ahead_at[width - 1 : width - 1 + n]
    flat = table.ravel()
    return np.where((flat[before] < flat[behind]) & (start % width != 0), before, behind)


def segments(units: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """anchor hash, segment hash, first window start, number of starts, anchor's place in the first window."""
    found = []
    for at in range(0, max(len(units) - window + 1, 0), SLICE):
        part = units[at : at + SLICE + window - 1]
        sums = Sums(part)
        grams = sums.grams(gram)
        place = leftmost_minima(grams, window - gram + 1)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        count = np.diff(first, append=len(place))
        found.append((grams[place[first]], sums.runs(first, first + count - 1 + window), first + at, count, place[first] - first))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*found))


# kind 0: settled, these window starts repeat; 1: a segment, one for all its copies; 2: a marker
NAMES = ["kind", "gram", "salt", "segment", "doc", "tag", "first", "count", "place", "copies"]
SCHEMA = "kind tinyint, gram bigint, salt smallint, segment bigint, doc bigint, tag bigint, first int, count int, place int, copies tinyint"
KINDS = (np.int8, np.int64, np.int16, np.int64, np.int64, np.int64, np.int32, np.int32, np.int32, np.int8)

Columns = dict[str, np.ndarray]


def _batch(rows: Columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[n].astype(k, copy=False)) for n, k in zip(NAMES, KINDS)], names=NAMES)


def _take(rows: Columns, at: np.ndarray) -> Columns:
    return {n: c[at] for n, c in rows.items()}


def merge_copies(rows: Columns, keep_first: bool) -> tuple[Columns, Columns, np.ndarray]:
    """Settled starts, one row for each different segment, and how many different segments its anchor has.

    `keep_first`: of equal segments the first (by document, then place) is kept and only the others are
    settled; else all of them are. Markers count as a segment but are not returned.
    """
    order = np.lexsort((rows["first"], rows["tag"], rows["doc"], rows["segment"], rows["kind"], rows["gram"], rows["salt"]))
    rows = _take(rows, order)
    n = len(order)
    if not n:
        return rows, rows, np.zeros(0, np.int64)

    def changes(*names: str) -> np.ndarray:
        new = np.ones(n, bool)
        new[1:] = np.logical_or.reduce([rows[c][1:] != rows[c][:-1] for c in names])
        return new

    new_gram, new_segment = changes("salt", "gram"), changes("salt", "gram", "kind", "segment")
    of_gram, of_segment = np.cumsum(new_gram) - 1, np.cumsum(new_segment) - 1
    different = np.bincount(of_gram, new_segment)[of_gram].astype(np.int64)
    copies = np.bincount(of_segment, rows["copies"])[of_segment]
    real = rows["kind"] == 1
    # rows that repeat an id and a text are the same document
    same = np.zeros(n, bool)
    same[1:] = ~new_segment[1:] & ~changes("doc", "tag", "first")[1:]
    settled = real & (~new_segment & ~same if keep_first else (copies > 1) & (rows["copies"] < 2))
    rows["copies"] = np.minimum(copies, 2)
    head = new_segment & real
    return _take(rows, settled), _take(rows, head), different[head]


def _settled_spans(rows: Columns) -> Columns:
    """Settled runs of a document that follow on each other as one row."""
    if not len(rows["doc"]):
        return rows
    rows = _take(rows, np.lexsort((rows["first"], rows["tag"], rows["doc"])))
    new = np.ones(len(rows["doc"]), bool)
    new[1:] = (
        (rows["doc"][1:] != rows["doc"][:-1])
        | (rows["tag"][1:] != rows["tag"][:-1])
        | (rows["first"][1:] != rows["first"][:-1] + rows["count"][:-1])
    )
    at = np.flatnonzero(new)
    out = _take(rows, at)
    out["count"] = np.add.reduceat(rows["count"], at)
    out["kind"] = np.zeros(len(at), np.int8)
    return out


def _scan(units_of: Callable[[], Callable[[bytes], np.ndarray]], window: int, gram: int, keep_first: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of()
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            gram_, segment, first, count, place, doc, tag = (np.concatenate(c) for c in zip(*held))
            rows = {
                "kind": np.ones(len(first), np.int8), "gram": gram_.view(np.int64), "salt": np.zeros(len(first), np.int16),
                "segment": segment.view(np.int64), "doc": doc, "tag": tag, "first": first, "count": count,
                "place": place, "copies": np.ones(len(first), np.int64),
            }
            settled, heads, different = merge_copies(rows, keep_first)
            spread = different > SALTED_SEGMENTS
            heads["salt"][spread] = 1 + heads["segment"][spread] % SALTS
            marks = _take(heads, np.flatnonzero(spread)[np.unique(heads["gram"][spread], return_index=True)[1]])
            marks["kind"], marks["salt"] = np.full(len(marks["kind"]), 2), np.zeros(len(marks["kind"]), np.int16)
            for part in (_settled_spans(settled), heads, marks):
                if len(part["doc"]):
                    yield _batch(part)

        for batch in batches:
            for doc, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2))):
                found = segments(units(text), window, gram)
                if len(found[0]):
                    held.append((*found, np.full(len(found[0]), doc), np.full(len(found[0]), tag, np.int64)))
                size += len(text)
                if size >= FLUSH_BYTES and held:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return task


def _meet(keep_first: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            kind = batch.column(0).to_numpy()
            if (kind == 0).any():
                yield batch.filter(pa.array(kind == 0))
            part = batch.filter(pa.array(kind != 0))
            if part.num_rows:
                parts.append([c.to_numpy(zero_copy_only=False) for c in part.columns])
        if parts:
            rows = dict(zip(NAMES, (np.concatenate(c) for c in zip(*parts))))
            settled, heads, different = merge_copies(rows, keep_first)
            # a salted anchor has many segments, wherever they are
            for part in (_settled_spans(settled), _take(heads, (different > 1) | (heads["salt"] > 0))):
                if len(part["doc"]):
                    yield _batch(part)

    return task


def identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, tag, text: a missing id comes after all others; the tag, 64 bits, tells texts apart that share an id."""
    body = F.col(text).cast("string")
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64(body).alias("tag"), body.alias("text")
    )


def repeat_candidates(
    rows: DataFrame, total_bytes: int, units_of: Callable, window: int, gram: int, unit_bytes: float, keep_first: bool
) -> DataFrame:
    """Settled starts (kind 0) and open segments (kind 1) of `identified` rows."""
    expected = total_bytes / unit_bytes * 2 / (window - gram + 2)
    found = map_arrow(rows, _scan(units_of, window, gram, keep_first), SCHEMA)
    spread: Column = F.when(F.col("kind") == 0, F.xxhash64("doc", "first")).otherwise(F.xxhash64("gram", "salt"))
    dealt = found.repartition(parts_for(int(expected), TASK_ROWS), spread)
    return map_arrow(dealt, _meet(keep_first), SCHEMA)


def covered(first: np.ndarray, count: np.ndarray, window: int, n: int) -> np.ndarray:
    """Units inside any of the given runs of windows."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, np.minimum(first + count - 1 + window, n), -1)
    return np.cumsum(steps)[:n] > 0
