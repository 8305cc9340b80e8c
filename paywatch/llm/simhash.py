"""Near duplicates by SimHash with a Gray-order hierarchical index.

Fingerprints that differ in at most d bits agree in one of d + 1 disjoint sets of bits, so candidates
meet when they are dealt out by (set, bits of the set). Inside a task each such group is indexed: its
fingerprints are sorted by Gray rank, which puts those with few differences side by side, runs of 16 form
a node that keeps only the bits all its members share, runs of 16 nodes form the next level, up to one
root. A query descends with the differences counted so far and drops a node, and with it the whole group
below, as soon as they exceed d.

A group with too many fingerprints is dealt out again by the same rule: members agree in some bits
already, so the remaining ones are cut into d + 1 sets. Fingerprints are distinct, so a group whose members
may differ in 20 bits only has a million at most and fits a task as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from paywatch.llm.common import map_arrow, parts_for, texts_of
from paywatch.operators.components import connected_components
from paywatch.session import Scratch

SEED = 42
WIDTH = 3
FAN = 16
GROUP_LIMIT = 20_000
FREE_BITS = 20
TASK_ROWS = 100_000
PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """Bits that more than half of the hashes of all word shingles (repeats included) have set."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
        shingles = [joined[a:b] for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), "<u8", len(shingles))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t) for t in texts_of(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["key", "print"])


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """Position of each fingerprint in the Gray sequence."""
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _runs(group: np.ndarray, fan: int) -> np.ndarray:
    """First positions of runs of at most `fan` neighbours that belong to one group."""
    new = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((new, [len(group)])))
    place = np.arange(len(group)) - np.repeat(new, sizes)
    return np.flatnonzero(place % fan == 0)


class GrayIndex:
    """Levels of nodes over fingerprints sorted by (group, Gray rank); the top level has a node per group."""

    def __init__(self, prints: np.ndarray, group: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # pattern, shared mask, first child
        ones, any_bit, owner = prints, prints, group
        while True:
            first = _runs(owner, FAN)
            ones, any_bit = np.bitwise_and.reduceat(ones, first), np.bitwise_or.reduceat(any_bit, first)
            last = np.concatenate((first, [len(owner)]))
            owner = owner[first]
            self.levels.append((ones, ~(ones ^ any_bit), last))
            if len(np.unique(owner)) == len(owner):
                break
        self.prints, self.owner = prints, owner

    def within(self, queries: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query position, member position), each pair of a group once."""
        nodes = np.searchsorted(self.owner, queries[1])
        yield from self._descend(queries[0], nodes, len(self.levels) - 1, distance)

    def _descend(self, query: np.ndarray, node: np.ndarray, level: int, distance: int):
        for at in range(0, len(query), PAIRS_AT_ONCE // FAN):
            q, x = query[at : at + PAIRS_AT_ONCE // FAN], node[at : at + PAIRS_AT_ONCE // FAN]
            pattern, shared, first = self.levels[level]
            near = np.bitwise_count((self.prints[q] ^ pattern[x]) & shared[x]) <= distance
            q, x = q[near], x[near]
            count = first[x + 1] - first[x]
            q = np.repeat(q, count)
            below = np.repeat(first[x] - np.concatenate(([0], np.cumsum(count)[:-1])) if len(x) else x, count) + np.arange(len(q))
            if level:
                if len(q):
                    yield from self._descend(q, below, level - 1, distance)
            else:
                hit = (below > q) & (np.bitwise_count(self.prints[q] ^ self.prints[below]) <= distance)
                if hit.any():
                    yield q[hit], below[hit]


def _hook(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of each pair; `root` points every member to the smallest of its class."""
    while len(a):
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        if len(a):
            root[np.maximum(a, b)] = np.minimum(a, b)
            while not np.array_equal(up := root[root], root):
                root[:] = up


def _links(distance: int):
    """Links of the groups of a task as a forest: a linked fingerprint and the first one of its class."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not columns:
            return
        masks, prints = (np.concatenate(c).view(np.uint64) for c in zip(*columns))
        value = prints & masks
        order = np.lexsort((gray_rank(prints), value, masks))
        masks, value, prints = masks[order], value[order], prints[order]
        new = np.concatenate(([True], (masks[1:] != masks[:-1]) | (value[1:] != value[:-1])))
        group = np.cumsum(new) - 1
        shared = np.bincount(group)[group] > 1
        prints, group = prints[shared], group[shared]
        if not len(prints):
            return
        root = np.arange(len(prints))
        index = GrayIndex(prints, group)
        for a, b in index.within((np.arange(len(prints)), group), distance):
            _hook(root, a, b)
        linked = np.flatnonzero(root != np.arange(len(prints)))
        if len(linked):
            ends = [pa.array(prints[linked].view(np.int64)), pa.array(prints[root[linked]].view(np.int64))]
            yield pa.RecordBatch.from_arrays(ends, names=["src", "dst"])

    return task


def split_mask(free: int, parts: int) -> list[int]:
    """The bits of `free` in `parts` disjoint sets of nearly equal size; fewer when there are fewer bits."""
    bits = [b for b in range(64) if free >> b & 1]
    cut = [bits[len(bits) * i // parts : len(bits) * (i + 1) // parts] for i in range(parts)]
    return [sum(1 << b for b in c) for c in cut if c]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def print_links(prints: DataFrame, distance: int = 2, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links (src, dst) that connect just the distinct values of `print` within `distance` bits of each other."""
    scratch = Scratch(prints.sparkSession, "simhash")
    parts = distance + 1
    sets = F.array(*[F.lit(_signed(m)) for m in split_mask((1 << 64) - 1, parts)])
    rows = prints.select(F.explode(sets).alias("mask"), "print")
    links = None
    while True:
        value = F.col("print").bitwiseAND(F.col("mask")).alias("value")
        sizes = rows.groupBy("mask", value).agg(F.count(F.lit(1)).alias("n"))
        # groups above the limit are fewer than rows / limit
        wide = F.bit_count("mask") < 64 - FREE_BITS
        large, seen = scratch.write_with(
            sizes.where(F.col("n") > 1), "sizes", keep_last=1_000, rows=F.sum("n"), most=F.max(F.when(wide, F.col("n")))
        )
        total, most = seen["rows"] or 0, seen["most"] or 0
        keyed = rows.withColumn("value", F.col("print").bitwiseAND(F.col("mask")))
        heavy = large.where(wide & (F.col("n") > group_limit)).select("mask", "value")
        light = keyed.join(heavy, ["mask", "value"], "left_anti") if most > group_limit else keyed
        dealt = light.select("mask", "print", "value").repartition(parts_for(total, TASK_ROWS), "mask", "value")
        found = scratch.write(map_arrow(dealt.select("mask", "print"), _links(distance), "src bigint, dst bigint"), "links", 1_000)
        links = found if links is None else links.unionByName(found)
        if most <= group_limit:
            return links
        again = keyed.join(heavy, ["mask", "value"], "left_semi")
        masks = [r[0] for r in heavy.select("mask").distinct().collect()]  # at most one per way of cutting 64 bits
        finer = F.create_map(*[
            c
            for m in masks
            for c in (F.lit(m), F.array(*[F.lit(_signed((m % (1 << 64)) | s)) for s in split_mask(~m % (1 << 64), parts)]))
        ])
        rows = scratch.write(again.select(F.explode(finer[F.col("mask")]).alias("mask"), "print"), "rows", 1_000)


def _groups(rows: DataFrame, distance: int, **limits: int) -> DataFrame:
    """key, print and component_id, the smallest key of the component, of rows (key, text); keys may be of any type."""
    scratch = Scratch(rows.sparkSession, "prints")
    kind = rows.schema["key"].dataType.simpleString()
    own = scratch.write(map_arrow(rows, _fingerprints, f"key {kind}, print bigint"), "prints")
    distinct = scratch.write(own.groupBy("print").agg(F.min("key").alias("key")), "distinct")
    links = print_links(distinct, distance, **limits)
    if links.isEmpty():
        named = distinct.select("print", F.col("key").alias("component_id"))
    else:
        found = connected_components(links).select(F.col("node_id").alias("print"), F.col("component_id").alias("root"))
        rooted = distinct.join(found, "print", "left").select("print", "key", F.coalesce("root", "print").alias("root"))
        smallest = rooted.groupBy("root").agg(F.min("key").alias("component_id"))
        named = rooted.join(smallest, "root").select("print", "component_id")
    return own.join(named, "print").select("key", "print", "component_id")


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = 2, **limits: int) -> DataFrame:
    """Fingerprint and component of every row: key, print (signed), component_id.

    Words are cut at ASCII white space after lower-casing A-Z; a text with fewer words than a shingle
    is one shingle, one without words (or a missing one) has fingerprint zero and is linked like any
    other. Components are named by their smallest id; rows without id are linked but never name one,
    unless the component has no other. Repeated rows get the same answer; an empty table an empty one.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return _groups(rows, distance, **limits).select(F.col("key").alias(key), "print", "component_id")


def identity(key: str, text: str) -> Column:
    """Tells rows apart that share an id or have none; sorts by id, those without one last, then by text."""
    number = F.col(key).cast("long")
    digest = F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))
    return F.struct(number.isNull().alias("missing"), F.coalesce(number, F.lit(0)).alias("id"), digest.alias("digest"))


def one_per_group(docs: DataFrame, key: str, text: str, stays: DataFrame) -> DataFrame:
    """The rows of `docs` whose identity is one of `stays` (stays: repeated identities allowed), one row for each."""
    stays, seen = Scratch(docs.sparkSession, "stays").write_with(
        stays.groupBy("stays").agg(F.count(F.lit(1)).alias("times")), "ids", times=F.max("times")
    )
    rows = docs.select(F.struct(*docs.columns).alias("row"), identity(key, text).alias("own"))
    kept = rows.join(stays, F.col("own") == F.col("stays"), "left_semi")
    return (kept.dropDuplicates(["own"]) if (seen["times"] or 0) > 1 else kept).select("row.*")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = 2) -> DataFrame:
    """One row of every component, that with the smallest id, with the columns of `docs`.

    Rows without id come after all others; rows that share an id, or have none, are told apart by their text,
    so every component keeps exactly one row.
    """
    rows = docs.select(identity(key, text).alias("key"), F.col(text).cast("string").alias("text"))
    stays = _groups(rows, distance).where("key = component_id").select(F.col("key").alias("stays"))
    return one_per_group(docs, key, text, stays)
