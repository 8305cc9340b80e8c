"""Periodic runs of words, found with extension queries on a recompressed text.

The words of a text are compressed in rounds. A round first replaces every block of equal symbols, then
splits the symbols into left and right ones and replaces every pair of a left and a right symbol. Equal
stretches are cut alike but for their ends, so the common extension of two places is found by climbing the
rounds while the symbols agree and coming down again where they differ: a few steps a round.

A run with period q agrees with itself q words on over at least max(2 q, 24 - q) places in a row, so one
place of every grid of that width lies inside. Summed over all periods the grids are a harmonic series.
Each grid place is extended both ways, which gives the exact run around it.

Texts are independent of each other. Those of a batch are laid end to end, with a symbol of its own between
them, and worked off together; a long text makes a batch alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywatch.llm.common import Rows, map_arrow, texts_of

LEAST_LENGTH = 24
LEAST_POWER = 3

#: Words that are worked off together, and places of the grids that are extended together.
BATCH_WORDS = 1 << 17
GRID_PLACES = 1 << 20


@dataclass
class Round:
    """Symbols of a round; the phrase each belongs to (a symbol of the next round), where phrases begin, and how many
    equal symbols two phrases that differ may begin with (all of a block, one of a pair)."""

    symbols: np.ndarray
    phrase: np.ndarray
    first: np.ndarray
    pairs: bool

    def mirrored(self) -> Round:
        """The same round read from right to left."""
        last = len(self.first) - 2
        return Round(self.symbols[::-1], last - self.phrase[::-1], len(self.symbols) - self.first[::-1], self.pairs)


def _phrases(starts: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    marks = np.zeros(total, np.int64)
    marks[starts] = 1
    return np.cumsum(marks) - 1, np.append(starts, total)


def _named(keys: np.ndarray, fresh: int) -> np.ndarray:
    """Equal keys get equal new symbols."""
    return np.unique(keys, return_inverse=True)[1] + fresh


def _blocks(symbols: np.ndarray) -> tuple[Round, np.ndarray]:
    starts = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    phrase, first = _phrases(starts, len(symbols))
    sizes, after = np.diff(first), symbols[starts].copy()
    long = sizes > 1
    if long.any():
        after[long] = _named(after[long] * (sizes.max() + 1) + sizes[long], int(symbols.max()) + 1)
    return Round(symbols, phrase, first, False), after


def _sides(symbols: np.ndarray, number: int) -> np.ndarray:
    """Left (True) or right for every symbol by a hash that is another in every round."""
    mixed = symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((number * 0xD1B54A32D192ED03) % (1 << 64))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(41)) & np.uint64(1) == 1


def _pairs(symbols: np.ndarray, number: int) -> tuple[Round, np.ndarray]:
    left = _sides(symbols, number)
    ahead, behind = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
    paired = ahead if np.count_nonzero(ahead) >= np.count_nonzero(behind) else behind
    starts = np.flatnonzero(np.concatenate(([True], ~paired)))
    phrase, first = _phrases(starts, len(symbols))
    after, two = symbols[starts].copy(), np.diff(first) == 2
    if two.any():
        fresh = int(symbols.max()) + 1
        after[two] = _named(after[two] * fresh + symbols[starts[two] + 1], fresh)
    return Round(symbols, phrase, first, True), after


def recompressed(symbols: np.ndarray) -> list[Round]:
    """Rounds until no symbol is left twice; the last one has no phrases."""
    rounds: list[Round] = []
    while True:
        kinds, symbols = np.unique(symbols, return_inverse=True)  # symbols stay small, so products of two fit
        if len(kinds) == len(symbols):
            rounds.append(Round(symbols, symbols[:0], symbols[:0], True))
            return rounds
        done, symbols = _pairs(symbols, len(rounds)) if len(rounds) % 2 else _blocks(symbols)
        rounds.append(done)


def _differ(rounds: list[Round], level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places at or after a and b, in symbols of the round `level`, where the text differs."""
    here = rounds[level]
    if level + 1 == len(rounds) or not len(a):
        return a, b
    a, b = a.copy(), b.copy()
    climbing: list[np.ndarray] = []
    left = np.arange(len(a))
    while len(left):
        x, y = a[left], b[left]
        up_x, up_y = here.phrase[x], here.phrase[y]
        begin = (here.first[up_x] == x) & (here.first[up_y] == y)
        climbing.append(left[begin])
        on = ~begin & (here.symbols[x] == here.symbols[y])
        left, x, y, up_x, up_y = left[on], x[on], y[on], up_x[on], up_y[on]
        step = np.minimum(here.first[up_x + 1] - x, here.first[up_y + 1] - y)
        a[left], b[left] = x + step, y + step
    above = np.concatenate(climbing)
    if len(above):
        up_x, up_y = _differ(rounds, level + 1, here.phrase[a[above]], here.phrase[b[above]])
        x, y = here.first[up_x], here.first[up_y]
        same = np.minimum(here.first[up_x + 1] - x, here.first[up_y + 1] - y)
        if here.pairs:
            same = np.minimum(same, 1)
        same = np.where(here.symbols[x] == here.symbols[y], same, 0)
        a[above], b[above] = x + same, y + same
    return a, b


class Extensions:
    """Longest common extensions of places of a text whose first and last symbols occur once."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.ahead = recompressed(symbols)
        self.back = [r.mirrored() for r in self.ahead]
        self.last = len(symbols) - 1

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols agree from the different places a and b on."""
        return _differ(self.ahead, 0, a, b)[0] - a

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols agree before the different places a and b."""
        a = self.last - (a - 1)
        return _differ(self.back, 0, a, self.last - (b - 1))[0] - a


def _grid(start: int, n: int, least: int, power: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods to try in the words start .. start + n, in portions of bounded size."""
    periods = np.arange(1, n // power + 1)
    widths = np.maximum((power - 1) * periods, least - periods)
    counts = -(-(n - periods) // widths)
    ends = np.cumsum(counts)
    at = 0
    while at < len(periods):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GRID_PLACES, "right")))
        many = counts[at:to]
        step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        yield start + step * np.repeat(widths[at:to], many), np.repeat(periods[at:to], many)
        at = to


def _portions(sizes: list[int], starts: list[int], least: int, power: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held, size = [], 0
    for start, n in zip(starts, sizes):
        if n >= least:
            for places, periods in _grid(start, n, least, power):
                held.append((places, periods))
                size += len(places)
                if size >= GRID_PLACES:
                    yield tuple(np.concatenate(c) for c in zip(*held))
                    held, size = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _smallest(found: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) sorted by start and period; one for each stretch, with its smallest period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    if len(found):
        found = found[np.concatenate(([True], (found[1:, :2] != found[:-1, :2]).any(axis=1)))]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def find_runs(texts: list[np.ndarray], least: int = LEAST_LENGTH, power: int = LEAST_POWER) -> list[np.ndarray]:
    """For every text, given as numbers of its words, its runs as rows (start, end, period) by start, then period."""
    sizes = [len(t) for t in texts]
    if not any(n >= least for n in sizes):
        return [np.zeros((0, 3), np.int64)] * len(texts)
    mark = 1 + max(int(t.max()) for t in texts if len(t))
    parts = [np.array([mark])]
    for number, t in enumerate(texts):
        parts += [t, np.array([mark + 1 + number])]
    symbols = np.concatenate(parts).astype(np.int64)
    starts = (1 + np.cumsum([0] + [n + 1 for n in sizes[:-1]])).tolist()
    reach = Extensions(symbols)
    found = np.zeros((0, 3), np.int64)
    for places, periods in _portions(sizes, starts, least, power):
        same = symbols[places] == symbols[places + periods]
        places, periods = places[same], periods[same]
        after = reach.forward(places, places + periods)
        before = reach.backward(places, places + periods)
        long = before + after + periods >= np.maximum(least, power * periods)
        rows = np.stack((places - before, places + periods + after, periods), axis=1)[long]
        # a longer period of the same stretch is a multiple of its smallest
        found = _smallest(np.concatenate((found, rows)))
    owner = np.searchsorted(np.array(starts), found[:, 0], "right") - 1
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [found[cuts[i] : cuts[i + 1]] - [starts[i], starts[i], 0] for i in range(len(texts))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """True for the words outside all runs and in the first period of a run that no other run repeats."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def planted(key: int | None, words: list[bytes]) -> list[bytes]:
    """The words with, for every tenth id by crc32, a tail that repeats; `words` themselves for the others."""
    if key is None or not words:
        return words
    h = crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


FOUND = pa.schema([
    ("key", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("collapsed", pa.string()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
])
FOUND_DDL = (
    "key bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, "
    "collapsed_sha256 string, collapsed string, runs array<struct<start: bigint, length: bigint, period: bigint>>"
)


def _described(key: int | None, words: list[bytes], found: np.ndarray, full: bool) -> tuple:
    spans = [(start, end - start, period) for start, end, period in found.tolist()]
    best: tuple = (None,) * 4
    if spans:
        # lengths are below 2^32, so different quotients differ in the first 64 bits after the point
        start, length, period = max(spans, key=lambda s: ((s[1] << 64) // s[2], -s[0], -s[2]))
        best = (start, length, period, 1000 * length // period)
        keep = kept_words(len(words), found)
        words = [w for w, stays in zip(words, keep.tolist()) if stays]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in spans).encode()
    body = b" ".join(words)
    more = (body.decode(), [dict(zip(("start", "length", "period"), s)) for s in spans]) if full else (None, None)
    return (key, len(spans), *best, sha256(listed).hexdigest(), sha256(body).hexdigest(), *more)


def _task(least: int, power: int, change, full: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(FOUND)
        held: list[tuple] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            number: dict[bytes, int] = {}
            coded = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for _, words in held]
            for (key, words), found in zip(held, find_runs(coded, least, power)):
                row = _described(key, words, found, full)
                yield from out.add(200 + len(row[-2] or "") + 100 * len(row[-1] or ()), *row)
            held.clear()

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                words = text.split()
                if change:
                    words = change(key, words)
                if held and total + len(words) > BATCH_WORDS:
                    yield from flush()
                    total = 0
                held.append((key, words))
                total += len(words)
        yield from flush()
        yield from out.flush()

    return work


def periodic_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST_LENGTH,
    power: int = LEAST_POWER,
    change=None,
    full: bool = True,
) -> DataFrame:
    """Runs of every row: `key`, n_runs, the run of greatest exponent, digests, and if `full` the collapsed text and all runs.

    Words are cut at ASCII white space. A run is a stretch of words with smallest period q, at least `least` words
    and `power` (two or more) periods long, which no neighbouring word prolongs. `collapsed` keeps of every run its
    first period. `change(key, words)` may give other words before the search. Missing and empty texts have no
    words and no runs, so nulls describe their greatest run; rows without id or with a repeated one are each judged
    alone; an empty table gives an empty result.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    found = map_arrow(rows, _task(least, power, change, full), FOUND_DDL).withColumnRenamed("key", key)
    return found if full else found.drop("collapsed", "runs")
