"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

The vocabulary is counted first. Its words are put into blocked Bloom filters, one for each word length, which
are sent to all tasks. Every word makes its edits - one code point deleted, or replaced by a greater one - as
hashes only, derived from the hash of the word, and probes them. Edits that a filter may contain are spelled
out and joined with the vocabulary, which removes the false ones. A pair is made once: by its longer word, or
by the one with the smaller code point; the other direction is added after the join.

Filters are sent in rounds of bounded bytes. A length whose filter alone exceeds the bound is cut into slices
by hash, so a larger vocabulary takes more rounds and not more memory. Only the words that can reach a length
of the round are read in it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywatch.llm.common import map_arrow, parts_for, share, shared
from paywatch.session import Scratch

LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10

#: Bytes of filters that are sent to the tasks at once, bits of filter for a word, and bits set for it.
ROUND_BYTES = 32 << 20
WORD_BITS = 32
MARKS = 5

#: Longer words share the filters of a length class, so that the number of filters is bounded.
CLASSES = 64

#: Different words a task gathers before it passes their counts on; edits that are probed together.
HELD_WORDS = 200_000
PROBES = 1 << 20
BUILD_ROWS = 4_000_000
VOCABULARY_ROWS = 50_000

LETTERS = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}")
LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}


def misspelt(key: int | None, run: str) -> str:
    """The lower-cased run without one of its code points, for every 31st by crc32 of id and run."""
    h = crc32(f"{'' if key is None else key}:{run}".encode())
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(change: Callable[[int | None, str], str] | None, least: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            words = list(held)
            size = 0
            start = 0
            for at, word in enumerate(words, 1):  # a run may be as long as a text
                size += len(word)
                if size > 4 << 20 or at == len(words):
                    part = words[start:at]
                    yield pa.RecordBatch.from_pydict({"word": pa.array(part, pa.string()), "n": pa.array([held[w] for w in part], pa.int64())})
                    size, start = 0, at
            held.clear()

        size = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for run, n in Counter(LETTERS.findall((text or "").translate(LOWER))).items():
                    word = change(key, run) if change else run
                    if len(word) >= least:
                        size += 0 if word in held else len(word)
                        held[word] += n
                if len(held) > HELD_WORDS or size > 32 << 20:
                    yield from flush()
                    size = 0
        yield from flush()

    return task


def vocabulary(
    docs: DataFrame, key: str = "doc_id", text: str = "text", change: Callable[[int | None, str], str] | None = None
) -> DataFrame:
    """word and n of all words of the texts that occur often enough."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    counted = map_arrow(rows, _count(change, LEAST_LETTERS), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def mixed(values: np.ndarray) -> np.ndarray:
    """64 well spread bits of each number."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _terms(places: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The share of a code point at a place in the hash of a word, which is the sum over its places."""
    return mixed((places.astype(np.uint64) << np.uint64(21)) + codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a word a row."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Length and positions of the words of every length, at most so many at once that their edits are few."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        if len(part):
            length = int(sizes[part[0]])
            step = max(1, PROBES // max(length, 128))
            for at in range(0, len(part), step):
                yield length, part[at : at + step]


def class_of(length: int) -> int:
    return length if length < CLASSES else CLASSES + length % CLASSES


def _marks(hashes: np.ndarray) -> np.ndarray:
    """The bits of a filter block that a word sets, from the low bits of its hash."""
    marks = np.zeros(len(hashes), np.uint64)
    for k in range(MARKS):
        marks |= np.uint64(1) << ((hashes >> np.uint64(6 * k)) & np.uint64(63))
    return marks


class Filter:
    """Slices of a blocked Bloom filter: one block of 64 bits decides about a word.

    The block is chosen by the high bits of the hash: first the slice, then the block in it.
    """

    def __init__(self, slices: int, blocks: int) -> None:
        self.slices, self.blocks = slices, blocks
        self.bits: dict[int, np.ndarray] = {}

    def address(self, hashes: np.ndarray) -> np.ndarray:
        """Block over all slices."""
        return (((hashes >> np.uint64(32)) * np.uint64(self.slices * self.blocks)) >> np.uint64(32)).view(np.int64)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes whose words a slice at hand may hold."""
        address = self.address(hashes)
        found = []
        for number, bits in self.bits.items():
            if self.slices == 1:
                block, at = bits[address], np.arange(len(hashes))
            else:
                at = np.flatnonzero(address // self.blocks == number)
                block = bits[address[at] % self.blocks]
            likely = np.flatnonzero((block >> (hashes[at] & np.uint64(63))) & np.uint64(1))
            at, marks = at[likely], _marks(hashes[at[likely]])
            found.append(at[(block[likely] & marks) == marks])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def _addresses(shapes: dict[int, tuple[int, int]], wanted: list[tuple[int, int]]):
    """Place of every word in the filters of a round: part (index in `wanted`), block and bits."""
    part_of = {part: number for number, part in enumerate(wanted)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, at in _by_length(words):
                codes = _codes([words[i] for i in at.tolist()])
                hashes = _terms(np.arange(length), codes).sum(axis=1, dtype=np.uint64)
                slices, blocks = shapes[class_of(length)]
                address = Filter(slices, blocks).address(hashes)
                part = np.array([part_of.get((class_of(length), n), -1) for n in range(slices)], np.int32)[address // blocks]
                here = part >= 0
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(part[here]),
                    "block": pa.array((address % blocks)[here]),
                    "marks": pa.array(_marks(hashes)[here].view(np.int64)),
                })

    return task


#: Blocks of a filter that one row of the build carries.
SEGMENT = 1 << 13


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        part, block, marks = (c.to_numpy() for c in batch.columns)
        segment = block // SEGMENT
        order = np.lexsort((segment, part))
        cuts = np.flatnonzero((np.diff(part[order]) != 0) | (np.diff(segment[order]) != 0)) + 1
        for own in np.split(order, cuts):
            if len(own):
                bits = held.setdefault((int(part[own[0]]), int(segment[own[0]])), np.zeros(SEGMENT, np.int64))
                np.bitwise_or.at(bits, block[own] % SEGMENT, marks[own])
    keys = list(held)
    yield pa.RecordBatch.from_pydict({
        "part": pa.array([k[0] for k in keys], pa.int32()),
        "segment": pa.array([k[1] for k in keys], pa.int64()),
        "bits": pa.array([held[k].tobytes() for k in keys], pa.binary()),
    })


def build_filters(words: DataFrame, shapes: dict[int, tuple[int, int]], wanted: list[tuple[int, int]]) -> dict[int, Filter]:
    """The filters of a round; `wanted` lists (length class, slice). Their segments are filled by the tasks."""
    placed = map_arrow(words.select("word"), _addresses(shapes, wanted), "part int, block bigint, marks bigint")
    total = sum(shapes[c][1] for c, _ in wanted)
    dealt = placed.repartition(parts_for(total * 64, BUILD_ROWS * WORD_BITS, least=2), "part", F.expr(f"block div {SEGMENT}"))
    filters: dict[int, Filter] = {}
    for row in map_arrow(dealt, _segments, "part int, segment bigint, bits binary").collect():  # the bytes of a round
        which, number = wanted[row["part"]]
        slices, blocks = shapes[which]
        bits = filters.setdefault(which, Filter(slices, blocks)).bits.setdefault(number, np.zeros(blocks, np.uint64))
        at = row["segment"] * SEGMENT
        part = np.frombuffer(row["bits"], np.uint64)[: blocks - at]
        bits[at : at + len(part)] |= part
    return filters


def _deleted(codes: np.ndarray, terms: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and hash of each deletion; of equal neighbours only the first is deleted."""
    shifted = np.zeros_like(terms)
    shifted[:, 1:] = _terms(np.arange(length - 1), codes[:, 1:])
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    after = shifted.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(shifted, axis=1, dtype=np.uint64)
    first = np.ones(codes.shape, bool)
    first[:, 1:] = codes[:, 1:] != codes[:, :-1]
    row, place = np.nonzero(first)
    return row, place, (before + after)[row, place]


def _replaced(codes: np.ndarray, terms: np.ndarray, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """Rows, places, new code point and hashes of the replacements by each code point that is greater than the old one."""
    below = np.searchsorted(letters, codes, "right").ravel()
    order = np.argsort(below, kind="stable")
    row, place = np.divmod(order, codes.shape[1])
    rest = (terms.sum(axis=1, dtype=np.uint64)[:, None] - terms).ravel()[order]
    ends = np.searchsorted(below[order], np.arange(len(letters)), "right")
    for letter, end in zip(letters.tolist(), ends.tolist()):
        if end:
            fresh = _terms(np.arange(codes.shape[1]), np.array([letter]))
            yield row[:end], place[:end], letter, rest[:end] + fresh[place[:end]]


def _probe(filters, letters: list[int]):
    """Edits of every word that a filter may hold: edit, word, n."""
    alphabet = np.array(letters, np.uint32)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_hand: dict[int, Filter] = shared(filters)
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for length, at in _by_length(words):
                shorter, same = at_hand.get(class_of(length - 1)), at_hand.get(class_of(length))
                if not shorter and not same:
                    continue
                own = [words[i] for i in at.tolist()]
                codes = _codes(own)
                terms = _terms(np.arange(length), codes)
                found: list[tuple[int, str]] = []
                if shorter:
                    row, place, hashes = _deleted(codes, terms, length)
                    hit = shorter.may_hold(hashes)
                    found += [(r, own[r][:p] + own[r][p + 1 :]) for r, p in zip(row[hit].tolist(), place[hit].tolist())]
                    if sum(len(own[0]) for _ in found) > 4 << 20:
                        yield _edits(found, own, at, counts)
                        found = []
                if same:
                    for row, place, letter, hashes in _replaced(codes, terms, alphabet):
                        hit = same.may_hold(hashes)
                        found += [(r, own[r][:p] + chr(letter) + own[r][p + 1 :]) for r, p in zip(row[hit].tolist(), place[hit].tolist())]
                        if len(found) * length > 4 << 20:
                            yield _edits(found, own, at, counts)
                            found = []
                if found:
                    yield _edits(found, own, at, counts)

    return task


def _edits(found: list[tuple[int, str]], own: list[str], at: np.ndarray, counts: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "edit": pa.array([e for _, e in found], pa.string()),
        "word": pa.array([own[r] for r, _ in found], pa.string()),
        "n": pa.array([counts[at[r]] for r, _ in found], pa.int64()),
    })


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[str] = set()
    for batch in batches:
        for word in batch.column(0).to_pylist():
            seen.update(word)
    yield pa.RecordBatch.from_pydict({"code": pa.array(sorted(map(ord, seen)), pa.int32())})


def _rounds(shapes: dict[int, tuple[int, int]], round_bytes: int) -> Iterator[list[tuple[int, int]]]:
    """All (length class, slice) in sets of bounded bytes."""
    held, size = [], 0
    for which, (slices, blocks) in sorted(shapes.items()):
        for number in range(slices):
            if held and size + 8 * blocks > round_bytes:
                yield held
                held, size = [], 0
            held.append((which, number))
            size += 8 * blocks
    if held:
        yield held


def near_pairs(words: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """Each pair of near words once: word, n, other, other_n. `words` (word, n) is a stored table of distinct words."""
    spark, scratch = words.sparkSession, Scratch(words.sparkSession, "spelling")
    # as many lengths as a text has letters, at most; classes are few
    length = F.char_length("word")
    which = F.when(length < CLASSES, length).otherwise(CLASSES + length % CLASSES)
    sizes = {r[0]: r[1] for r in words.groupBy(which.alias("class")).agg(F.count(F.lit(1))).collect()}
    letters = sorted(r[0] for r in map_arrow(words.select("word"), _letters, "code int").distinct().collect())
    shapes = {}
    for c, n in sizes.items():
        blocks = max(1, -(-n * WORD_BITS // 64))
        slices = -(-blocks * 8 // round_bytes)
        shapes[c] = slices, -(-blocks // slices)
    pairs = None
    for wanted in _rounds(shapes, round_bytes):
        classes = {c for c, _ in wanted}
        reach = classes | {class_of(n + 1) for n in range(2 * CLASSES) if class_of(n) in classes}
        filters = share(spark, build_filters(words.where(which.isin(*classes)), shapes, wanted))
        edits = map_arrow(words.where(which.isin(*reach)).select("word", "n"), _probe(filters, letters), "edit string, word string, n bigint")
        real = edits.join(words.select(F.col("word").alias("edit"), F.col("n").alias("other_n")), "edit")
        found = scratch.write(real.select("word", "n", F.col("edit").alias("other"), "other_n"), "pairs", keep_last=10_000)
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:
        return spark.createDataFrame([], "word string, n bigint, other string, other_n bigint")
    return pairs


def last_forms(forms: DataFrame) -> DataFrame:
    """word and root of every row (word, form), forms followed to the end by doubling.

    A form is `RATIO` times as frequent as its word, so there are no rings and few rounds.
    """
    scratch = Scratch(forms.sparkSession, "roots")
    roots = scratch.write(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        written, seen = scratch.write_with(stepped, "roots", moved=F.count_if("moved"))
        roots = written.drop("moved")
        if not seen["moved"]:
            return roots


def spelling_variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    change: Callable[[int | None, str], str] | None = None,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """Every word of the texts with its more usual spelling: word, form, root, n, n_near, form_n.

    Words are runs of at least seven ASCII or Latin-1 letters, lower-cased in A-Z only, that occur twice or more.
    `form` is the most frequent of the words that differ by one code point (then the smallest in code-point order)
    if it is at least ten times as frequent; `root` follows forms to the last. `change(key, run)` may respell a run
    (lower-cased, of at least seven letters) of a row before it is counted; the key of a row without id is None.
    Missing and empty texts have no words; repeated rows count as often as they stand there; an empty table, or one
    without such words, gives an empty result. Other columns of `docs` are not looked at.
    """
    scratch = Scratch(docs.sparkSession, "vocabulary")
    words, seen = scratch.write_with(vocabulary(docs, key, text, change), "words", rows=F.count(F.lit(1)))
    # small files, as a word makes hundreds of edits
    words = scratch.write(words.repartition(parts_for(seen["rows"], VOCABULARY_ROWS)), "dealt")
    pairs = near_pairs(words, round_bytes)
    both = pairs.select("word", "n", "other", "other_n").unionByName(
        pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )
    best = both.groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other"))).alias("best")
    )
    usual = -F.col("best.rank") >= RATIO * F.col("n")
    near = scratch.write(
        best.select("word", "n_near", F.when(usual, F.col("best.other")).alias("form"), F.when(usual, -F.col("best.rank")).alias("form_n")), "near"
    )
    roots = last_forms(near.where(F.col("form").isNotNull()))
    return (
        words.join(near.join(roots, "word", "left"), "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
