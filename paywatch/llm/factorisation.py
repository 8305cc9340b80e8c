"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A score is the sum of a bias, the weights of the features and the interactions of all pairs of features,
whose strengths are products of low-rank vectors. The pairs are never listed: with sums over the features
i, half of (sum of v_i x_i) squared minus the sum of (v_i x_i) squared gives their total in linear time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log2, sqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from paywatch.llm.common import map_arrow, share, shared, texts_of

WORD_SLOTS = 1 << 15
BINS = 16
STATS = 13
SLOTS = WORD_SLOTS + BINS * STATS
RANK = 8
BATCH = 128

#: Labelled rows the model is fitted on at most; beyond that a hash of the id chooses them.
SAMPLE_ROWS = 8_000


class WordSlots(dict):
    """Slot of a word; remembers words up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        slot = self[word] = crc32(word) % WORD_SLOTS
        return slot


BYTE_CLASS = np.zeros(256, np.int64)
BYTE_CLASS[ord("a") : ord("z") + 1] = 1
BYTE_CLASS[ord("A") : ord("Z") + 1] = 2
BYTE_CLASS[ord("0") : ord("9") + 1] = 3
BYTE_CLASS[[32, 9, 10, 11, 12, 13]] = 4
BYTE_CLASS[128:] = 5
CLASS_OF = [np.flatnonzero(BYTE_CLASS == c) for c in range(6)]


def _bin(share: float) -> int:
    return min(BINS - 1, int(share * BINS))


def _log_bin(value: float) -> int:
    return min(BINS - 1, int(log2(1 + max(value, 0))))


def statistics(text: bytes, words: list[bytes], n_chars: int | None) -> list[int]:
    """Bin of each structure statistic of a text and of its stated length (the metadata)."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if text else np.zeros(256, np.int64)
    other, lower, upper, digit, space, wide = (int(counts[c].sum()) for c in CLASS_OF)
    size, n = max(len(text), 1), max(len(words), 1)
    lines = text.split(b"\n")
    letters = max(lower + upper, 1)
    long_lines = sum(len(line) > 400 for line in lines)
    ends = sum(word[-1:] not in b".,;:!?)\"'" and not word[-1:].isalnum() and word[-1] < 128 for word in words)
    return [
        _bin(upper / letters),
        _bin(min(1.0, 4 * other / size)),
        _bin(min(1.0, 4 * digit / size)),
        _bin(min(1.0, 2 * space / size)),
        _bin(min(1.0, 2 * wide / size)),
        _bin(len(set(words)) / n),
        _bin(len(set(lines)) / len(lines)),
        _bin(ends / n),
        _bin(sum(not word[:1].isalnum() and word[0] < 128 for word in words) / n),
        _bin(long_lines / len(lines)),
        _log_bin(4 * (len(text) - space) / n / 3),
        _log_bin(len(text)),
        BINS - 1 if n_chars is None else _log_bin(n_chars),
    ]


def features(text: bytes, n_chars: int | None, slots: WordSlots) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: damped word counts of unit length, then one slot of value 1 / 2 per statistic."""
    words = text.split()
    own = np.fromiter((slots[w] for w in words), np.int64, len(words))
    found, times = np.unique(own, return_counts=True)
    value = np.sqrt(times)
    if len(found):
        value = value / sqrt(float(times.sum()))
    bins = np.array(statistics(text, words, n_chars)) + WORD_SLOTS + BINS * np.arange(STATS)
    return np.concatenate((found, bins)), np.concatenate((value, np.full(STATS, 0.5)))


@dataclass
class Machine:
    """bias, weights (slots), factors (slots, rank)"""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, slots: np.ndarray, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of documents laid end to end (`first`: where each begins), and the sums of v_i x_i."""
        terms = self.factors[slots] * values[:, None]
        sums = np.add.reduceat(terms, first)
        squares = np.add.reduceat(terms * terms, first)
        linear = np.add.reduceat(self.weights[slots] * values, first)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], updates: int = 630, step: float = 0.08, decay: float = 1e-5) -> Machine:
    """Logistic loss by AdaGrad over mini-batches in a fixed order; without rows the score is 1/2."""
    rng = np.random.default_rng(7)
    model = Machine(0.0, np.zeros(SLOTS), rng.normal(0, 0.02, (SLOTS, RANK)))
    heat_w, heat_v, heat_b = np.full(SLOTS, 1e-2), np.full((SLOTS, RANK), 1e-2), 1e-2
    for _ in range(-(-updates // -(-len(rows) // BATCH)) if rows else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = [rows[i] for i in order[at : at + BATCH]]
            slots, values = (np.concatenate([p[k] for p in part]) for k in (0, 1))
            sizes = np.array([len(p[0]) for p in part])
            first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            raw, sums = model.raw(slots, values, first)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - np.array([p[2] for p in part])) / len(part)
            each = np.repeat(error, sizes)
            slope_w = each * values
            slope_v = slope_w[:, None] * (np.repeat(sums, sizes, axis=0) - model.factors[slots] * values[:, None])
            touched, place = np.unique(slots, return_inverse=True)
            grad_w = np.bincount(place, slope_w) + decay * model.weights[touched]
            grad_v = np.stack([np.bincount(place, slope_v[:, k]) for k in range(RANK)], axis=1) + decay * model.factors[touched]
            heat_w[touched] += grad_w**2
            heat_v[touched] += grad_v**2
            heat_b += error.sum() ** 2
            model.weights[touched] -= step * grad_w / np.sqrt(heat_w[touched])
            model.factors[touched] -= step * grad_v / np.sqrt(heat_v[touched])
            model.bias -= step * error.sum() / sqrt(heat_b)
    return model


def held_out(key: str) -> Column:
    """Rows whose labels are never learned; a row without id has no label and is not one of them."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    slots = WordSlots()
    for batch in batches:
        found = [features(t, n, slots) for t, n in zip(texts_of(batch.column(0)), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32())),
                batch.column(2),
                batch.column(3),
            ],
            names=["slots", "values", "label", "place"],
        )


def _inputs(docs: DataFrame, text: str, length: str) -> list[Column]:
    n = F.col(length).cast("long") if length in docs.columns else F.lit(None).cast("long")
    return [F.col(text).cast("string").alias("text"), n.alias("n_chars")]


def train_machine(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    length: str = "n_chars",
    sample_rows: int = SAMPLE_ROWS,
) -> Machine:
    """Fit on at most `sample_rows` labelled rows outside the held-out fold; label 1 is good, others are not.

    Rows without label or id are not learned from. The chosen labels, a bounded table, are sent to the
    scan of the documents. An id may have many rows: equal ones are learned from once, and of different ones
    a hash chooses, so that no more than `sample_rows` rows of features reach the driver.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    chosen = (
        known.select(F.col(key).cast("long").alias("_key"), (F.col(label) == 1).cast("int").alias("label"))
        .orderBy(F.xxhash64("_key"), "_key", "label")
        .limit(sample_rows)
    )
    rows = docs.select(F.col(key).cast("long").alias("_key"), *_inputs(docs, text, length)).join(F.broadcast(chosen), "_key")
    place = F.xxhash64("_key", "label", F.coalesce("text", F.lit("")), F.coalesce("n_chars", F.lit(-1)))
    once = rows.select("text", "n_chars", "label", place.alias("place")).dropDuplicates(["place"])
    found = map_arrow(once, _to_features, "slots array<int>, values array<float>, label int, place bigint")
    sample = found.orderBy("place").limit(sample_rows).collect()
    learned = [(np.array(r[0], np.int64), np.array(r[1], np.float64), r[2]) for r in sample]
    learned.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes(), r[1].tobytes()))  # the order of tasks must not matter
    return fit(learned)


def _score(machine):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, model = WordSlots(), shared(machine)
        for batch in batches:
            rows, scores = batch.column(0), []
            found: list = []
            inputs = zip(texts_of(batch.column(1)), batch.column(2).to_pylist())
            for text, n in inputs:
                found.append(features(text, n, slots))
                if len(found) == 64:
                    scores.append(_scores(model, found))
                    found = []
            if found:
                scores.append(_scores(model, found))
            values = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([rows, pa.array(values, pa.float64())], names=["row", "score"])

    return task


def _scores(model: Machine, found: list) -> np.ndarray:
    sizes = [len(f[0]) for f in found]
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    raw, _ = model.raw(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), first)
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def score_quality(
    docs: DataFrame, machine: Machine, text: str = "text", length: str = "n_chars", keep: list[str] | None = None
) -> DataFrame:
    """The columns `keep` (default: all) of every row as struct `row`, and its score from 0 to 1.

    Empty and missing texts are scored by their statistics alone; a missing length has a slot of its own.
    Rows that repeat score alike; an empty table gives an empty result.
    """
    keep = keep or docs.columns
    rows = docs.select(F.struct(*keep).alias("row"), *_inputs(docs, text, length))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, score double"
    if keep != docs.columns or any(not c.isidentifier() for c in keep):
        kinds = rows.schema["row"].dataType.fields
        schema = f"row struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in kinds)}>, score double"
    return map_arrow(rows, _score(share(docs.sparkSession, machine)), schema)


def drop_low_quality(docs: DataFrame, machine: Machine, threshold: float = 0.5, **columns: str) -> DataFrame:
    """The rows whose score reaches the threshold, with the columns of `docs`."""
    return score_quality(docs, machine, **columns).where(F.col("score") >= threshold).select("row.*")
