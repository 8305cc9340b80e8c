"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic text. A window of words that
compresses shorter with the toxic dictionary than with the ordinary one speaks the toxic language. The bytes
saved are compared with several thresholds; how many windows pass each of them, weighted by a logistic
calibration, gives the score of a text.

zstandard spends about three bytes on a match, as much as a short word is worth. Therefore

* words are spelled as their overlapping five-byte pieces before training and compression, so that a known
  word saves about five times as much and a known stem counts as well as a word;
* the toxic dictionary is trained on the words of toxic texts that hold a piece significantly more frequent
  there, and goes on with the ordinary dictionary. Both then know ordinary text equally well, and lengths
  differ only where the toxic part matches;
* dictionaries are used for their content, without entropy tables, so literals cost the same with both.

The calibration sees only lengths of texts that its dictionaries were not trained on: the sample is cut in
two, each half is measured with dictionaries of the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from paywatch.llm.common import map_arrow, share, shared, texts_of
from paywatch.session import Scratch

WINDOW = 12
PIECE = 5
LEVEL = 6
ORDINARY_BYTES = 256 << 10
TOXIC_BYTES = 4 << 10
SEGMENT_BYTES = 48
PATTERN_BYTES = 8

#: Saved bytes of a window that count as one step of evidence each.
THRESHOLDS = (1, 2, 3, 4, 5, 6, 8, 10, 12, 16)
MEASURES = len(THRESHOLDS) + 4

#: Labelled rows that are learned from at most (a hash of the id chooses them), and the spelled text a dictionary
#: is trained on, as a multiple of its size (for the small toxic one 16 times as much): the trainer needs ten times
#: that memory. Each text gives an equal share, in windows or words spread over the whole of it.
SAMPLE_ROWS = 8_000
MATERIAL = 64

#: Standard deviations by which a piece must be more frequent in toxic texts, and how many such pieces are used.
SIGNIFICANT = 5.0
MAX_PIECES = 10_000

HALVES = 2
EDGES = b".,;:!?%&$*#|()\"'"


def words_of(text: bytes) -> list[bytes]:
    """Words at ASCII white space, A-Z lower-cased, without punctuation at their ends."""
    return [w.strip(EDGES) for w in text.lower().split()]


def pieces(word: bytes) -> list[bytes]:
    """The overlapping pieces of a word with its ends marked."""
    marked = b"^" + word + b"$"
    return [marked[i : i + PIECE] for i in range(max(1, len(marked) - PIECE + 1))]


class Spelled(dict):
    """A word as its pieces; remembers words up to a bound."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > 200_000:
            self.clear()
        spelled = self[word] = b" ".join(pieces(word)) + b" "
        return spelled


def windows(words: list[bytes], spelled: Spelled) -> Iterator[bytes]:
    for at in range(0, len(words), WINDOW):
        yield b"".join([spelled[w] for w in words[at : at + WINDOW]])


@dataclass
class Dictionaries:
    """Contents of the two dictionaries."""

    ordinary: bytes
    toxic: bytes

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        """For ordinary and toxic text; without content every window takes its plain length."""
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, dict_size=ORDINARY_BYTES + TOXIC_BYTES, source_size=8 * WINDOW, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        found = []
        for content in (self.ordinary, self.ordinary + self.toxic):
            known = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            found.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=known))
        return found


def measures(words: list[bytes], compressors: list[zstandard.ZstdCompressor], spelled: Spelled) -> list[float]:
    """How much shorter the windows of a text become with the toxic dictionary, as inputs of the calibration."""
    ordinary, toxic = (c.compress for c in compressors)
    saved = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(words, spelled)] or [0])
    over = [int((saved >= t).sum()) for t in THRESHOLDS]
    shares = [(n / len(saved)) ** 0.5 for n in over]
    return [np.log1p(len(saved)), *shares, over[THRESHOLDS.index(8)] ** 0.5, saved.max() / 10, saved.mean() / 3]


@dataclass
class Calibration:
    """Logistic weights of the measures after centring and scaling; without weights the score is the bias alone."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, found: np.ndarray) -> np.ndarray:
        raw = self.weights[0] + (found - self.centre) / self.scale @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def calibrate(found: np.ndarray, label: np.ndarray, penalty: float = 1.0, rounds: int = 60) -> Calibration:
    """Newton steps on the penalised logistic loss; with one class only, its share is the score of all texts."""
    if len(label) == 0 or label.min() == label.max():
        share_of = (label.sum() + 0.5) / (len(label) + 2)
        return Calibration(np.zeros(MEASURES), np.ones(MEASURES), np.concatenate(([np.log(share_of / (1 - share_of))], np.zeros(MEASURES))))
    centre, scale = found.mean(axis=0), found.std(axis=0) + 1e-9
    inputs = np.column_stack((np.ones(len(found)), (found - centre) / scale))
    ridge = np.diag([1e-6] + [penalty] * MEASURES)
    weights = np.zeros(MEASURES + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (p - label) + ridge @ weights
        step = np.linalg.solve(inputs.T @ (inputs * (p * (1 - p))[:, None]) + ridge, slope)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return Calibration(centre, scale, weights)


def held_out(key: str) -> Column:
    """Rows whose labels are never learned; a row without id has no label and is not one of them."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _piece_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and ordinary texts of the task each piece stands, by half."""
    for batch in batches:
        counts: dict[tuple[int, bytes], list[int]] = {}
        for text, label, half in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            for piece in {p for word in set(words_of(text)) for p in pieces(word)}:
                counts.setdefault((half, piece), [0, 0])[label] += 1
        yield pa.RecordBatch.from_pydict({
            "half": pa.array([k[0] for k in counts], pa.int32()),
            "piece": pa.array([k[1] for k in counts], pa.binary()),
            "ordinary": pa.array([c[0] for c in counts.values()], pa.int64()),
            "toxic": pa.array([c[1] for c in counts.values()], pa.int64()),
        })


def significant_pieces(sample: DataFrame) -> list[set[bytes]]:
    """For the dictionaries that leave out each half, and for those of the whole sample, the pieces typical of toxic texts."""
    texts = {(r[0], r[1]): r[2] for r in sample.groupBy("half", "label").agg(F.count(F.lit(1))).collect()}
    counted = map_arrow(sample, _piece_counts, "half int, piece binary, ordinary bigint, toxic bigint")
    by_half = [
        F.sum(F.when(F.col("half") == h, F.col(c)).otherwise(0)).alias(f"{c}{h}") for h in range(HALVES) for c in ("ordinary", "toxic")
    ]
    stored = Scratch(sample.sparkSession, "pieces").write(counted.groupBy("piece").agg(*by_half), "counts")
    found = []
    for model in range(HALVES + 1):
        halves = [h for h in range(HALVES) if h != model]
        n_ordinary, n_toxic = (float(sum(texts.get((h, label), 0) for h in halves)) for label in (0, 1))
        if not n_ordinary or not n_toxic:
            found.append(set())
            continue
        ordinary, toxic = (sum((F.col(f"{c}{h}") for h in halves), F.lit(0)) for c in ("ordinary", "toxic"))
        rate = (ordinary + toxic) / (n_ordinary + n_toxic)
        spread = F.sqrt(rate * (1 - rate) * (1 / n_ordinary + 1 / n_toxic) + 1e-12)
        typical = ((toxic / n_toxic - ordinary / n_ordinary) / spread).alias("typical")
        best = stored.select("piece", typical).where(F.col("typical") >= SIGNIFICANT).orderBy(F.desc("typical"), "piece").limit(MAX_PIECES)
        found.append({bytes(r[0]) for r in best.select("piece").collect()})
    return found


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on the samples; where they are too few for the trainer, they are the content."""
    try:
        return zstandard.train_dictionary(size, samples, k=SEGMENT_BYTES, d=PATTERN_BYTES, threads=0).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def train_dictionaries(texts: list[tuple[bytes, int]], typical: set[bytes]) -> Dictionaries:
    """Both dictionaries from bounded material, of which every text gives an equal share."""
    spelled = Spelled()
    rude = sum(label for _, label in texts)
    ordinary_share = MATERIAL * ORDINARY_BYTES // max(1, len(texts) - rude)
    toxic_share = MATERIAL * 16 * TOXIC_BYTES // max(1, rude)
    ordinary, toxic = [], []
    for text, label in texts:
        words = words_of(text)
        if label:
            own = [spelled[w] for w in words if not typical.isdisjoint(pieces(w))]
            step = -(-sum(map(len, own)) // toxic_share)
            if own:
                toxic.append(b"".join(own[::step]))
        else:
            size = PIECE * max(1, len(text))  # about what the text takes when spelled
            step = -(-size // ordinary_share) * WINDOW
            ordinary.append(b"".join([spelled[w] for at in range(0, len(words), step) for w in words[at : at + WINDOW]]))
    return Dictionaries(_trained(ordinary, ORDINARY_BYTES), _trained(toxic, TOXIC_BYTES))


def _train(typical):
    """The rows of a model, which all come to one task, as its two dictionaries; the sample is bounded."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[bytes, int]]] = {}
        for batch in batches:
            for model, text, label in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), batch.column(2).to_pylist()):
                held.setdefault(model, []).append((text, label))
        chosen = shared(typical)
        for model, texts in held.items():
            texts.sort()  # the order of tasks must not matter
            made = train_dictionaries(texts, chosen[model])
            yield pa.RecordBatch.from_pydict({
                "model": pa.array([model], pa.int32()),
                "ordinary": pa.array([made.ordinary], pa.binary()),
                "toxic": pa.array([made.toxic], pa.binary()),
            })

    return task


MEASURED = "label int, half int, found array<double>"


def _measure(models):
    """The measures of a sampled text with the dictionaries that were not trained on its half."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_hand = {model: made.compressors() for model, made in shared(models).items()}
        spelled = Spelled()
        for batch in batches:
            halves = batch.column(2).to_pylist()
            found = [measures(words_of(t), at_hand[h], spelled) for t, h in zip(texts_of(batch.column(0)), halves)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.float64()))], names=["label", "half", "found"]
            )

    return task


@dataclass
class Detector:
    dictionaries: Dictionaries
    calibration: Calibration


def train_detector(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS
) -> Detector:
    """Learn from at most `sample_rows` labelled ids outside the held-out fold; label 1 is toxic, others are not.

    An id with several rows gives one of them, texts that repeat in the sample are learned once. Rows without label
    or id are not learned from. Without labelled rows, or with one class only, all texts get the same score.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "toxicity")
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    chosen = (
        known.groupBy(F.col(key).cast("long").alias("_key"))
        .agg(F.max((F.col(label) == 1).cast("int")).alias("label"))
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(sample_rows)
    )
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    # a row of each id without sorting or gathering the others: an id may have a third of all rows
    rows = docs.select(F.col(key).cast("long").alias("_key"), body).join(F.broadcast(chosen), "_key")
    one = rows.groupBy("_key", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.char_length("text"))).alias("text"))
    half = F.pmod(F.xxhash64("text"), F.lit(HALVES)).cast("int")  # copies come to the same half
    sample = scratch.write(one.groupBy("text").agg(F.max("label").alias("label")).select("text", "label", half.alias("half")), "sample")
    typical = significant_pieces(sample)
    every = F.array(*[F.lit(m) for m in range(HALVES + 1)])
    learned = sample.select(F.explode(every).alias("model"), "text", "label", "half").where("model != half")
    dealt = learned.select("model", "text", "label").repartition(HALVES + 1, "model")
    trained = map_arrow(dealt, _train(share(spark, typical)), "model int, ordinary binary, toxic binary")
    models = {r["model"]: Dictionaries(bytes(r["ordinary"]), bytes(r["toxic"])) for r in trained.collect()}
    for model in range(HALVES + 1):
        models.setdefault(model, Dictionaries(b"", b""))
    measured = map_arrow(sample, _measure(share(spark, models)), MEASURED).collect()  # a row of numbers for each of the sample
    measured.sort(key=lambda r: (r["label"], r["found"]))
    found = np.array([r["found"] for r in measured], float).reshape(-1, MEASURES)
    return Detector(models[HALVES], calibrate(found, np.array([r["label"] for r in measured], float)))


def _score(detector):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Detector = shared(detector)
        compressors, spelled = model.dictionaries.compressors(), Spelled()
        for batch in batches:
            found = [measures(words_of(t), compressors, spelled) for t in texts_of(batch.column(1))]
            scores = model.calibration.scores(np.array(found, float).reshape(-1, MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    return task


def score_toxicity(docs: DataFrame, detector: Detector, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all) of every row as struct `row`, and its score from 0 to 1.

    Texts are measured whole, window by window. An empty or missing text has one empty window that saves nothing,
    which scores low. Rows that repeat score alike; an empty table gives an empty result.
    """
    keep = keep or docs.columns
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).cast("string").alias("text"))
    kinds = rows.schema["row"].dataType.fields
    schema = f"row struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in kinds)}>, score double"
    return map_arrow(rows, _score(share(docs.sparkSession, detector)), schema)
