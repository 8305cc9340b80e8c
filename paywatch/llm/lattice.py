"""Scores of a subword lattice language model.

A word is an arc of its own, weighted by how often the training texts have it, next to all ways to cut
it into pieces of an existing vocabulary, weighted by that vocabulary's scores. A forward recursion in log
space sums all paths, so a score is the marginal probability of the text and not that of its best cut.
Pieces never cross words, so the lattice of a text is that of its words in a row. Words are also counted by
group of texts (their language): each group has counts and piece weights of its own, and
a text belongs to each group with the group's share of texts, which its marginal probability sums over.

The vocabulary's pieces and their scores are given; what is learned is word counts and, with the scores
as a prior, how often each piece is passed in expectation (forward and backward over all training words).

Words are never listed per document across the cluster. A chunk (a bounded run of texts in a task) numbers
its different words; every such word travels once per chunk to be counted and scored, and its score
travels back to the chunk, where the texts wait as lists of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from paywatch.llm.common import map_arrow, parts_for, share, shared, texts_of
from paywatch.session import Scratch

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_BYTES = 24 << 20
CHUNKS_PER_TASK = 1 << 20
ROUNDS = 2

#: Words that a task looks at together, and the bytes of their rows at which it stops to gather them.
WORDS = 1 << 16
RUN_BYTES = 16 << 20

#: Counts that the vocabulary's own scores are worth when the pieces are weighted.
PRIOR = 1_000.0
#: Groups counted on their own at most, the largest ones; all others are one more.
GROUPS = 7

#: Of the share a group leaves to words it has not seen, what goes to words that other groups have.
BORROWED = 0.1
START = "▁"
PRIME = np.uint64(0x9E3779B97F4A7C15)


class HashIndex:
    """Places of hashes in a sorted list: the first bits tell where to look, then a few steps."""

    BITS = 20

    def __init__(self, hashes: np.ndarray) -> None:
        bounds = np.arange(1 << self.BITS, dtype=np.uint64) << np.uint64(64 - self.BITS)
        self.last = len(hashes) - 1
        self.first = np.searchsorted(hashes, bounds).astype(np.int32)
        self.steps = int(np.diff(np.append(self.first, len(hashes))).max())
        self.hashes = np.append(hashes, hashes[-1])

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each value, and whether it is there at all."""
        at = self.first[(value >> np.uint64(64 - self.BITS)).astype(np.int64)]
        for _ in range(self.steps):
            at = at + (self.hashes[at] < value)
            np.minimum(at, self.last, out=at)
        return at, self.hashes[at] == value


@dataclass
class Pieces:
    """Index of the hashes of all that pieces start with and the piece each is, or -1; log weights of the pieces,
    their kind, and the log weights of the 256 bytes and of a word's end.

    Pieces that begin a word have weights that sum to 1; so have the others, the bytes and the end.
    """

    index: HashIndex
    piece: np.ndarray
    begins: np.ndarray
    weight: np.ndarray
    byte_weight: np.ndarray
    end_weight: float


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """The vocabulary with weights by its scores: minus the score is a rank, and weights fall as 1 / rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    ]
    mass = 1 / (10 + np.array([-s for _, s in names]))
    begins = np.array([n.startswith(START) for n, _ in names])
    known: dict[str, int] = {}
    for place, (name, _) in enumerate(names):
        for stop in range(1, len(name)):
            known.setdefault(name[:stop], -1)
        known[name] = place
    hashes = np.array([int(_hash_all(_codes([n]))[0]) for n in known], np.uint64)
    order = np.argsort(hashes)
    if len(np.unique(hashes)) != len(hashes):
        raise ValueError("Two pieces of the vocabulary have the same hash.")
    byte_mass = np.full(256, mass.min())
    piece = np.fromiter(known.values(), np.int64, len(known))[order]
    return _weighted(HashIndex(hashes[order]), piece, begins, mass, byte_mass, mass[~begins].sum() / 2)


def _weighted(index, piece, begins, mass, byte_mass, end_mass) -> Pieces:
    first, rest = mass[begins].sum(), mass[~begins].sum() + byte_mass.sum() + end_mass
    weight = np.log(mass) - np.log(np.where(begins, first, rest))
    return Pieces(index, piece, begins, weight, np.log(byte_mass / rest), float(np.log(end_mass / rest)))


def _hash_all(codes: np.ndarray) -> np.ndarray:
    value = np.zeros(len(codes), np.uint64)
    for column in codes.T:
        value = (value + column.astype(np.uint64) + np.uint64(1)) * PRIME
        value ^= value >> np.uint64(29)
    return value


def _byte_sums(codes: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Log weight of spelling each code point in bytes."""
    found, place = np.unique(codes, return_inverse=True)
    own = [pieces.byte_weight[list(chr(c).encode("utf-8", "replace"))].sum() for c in found.tolist()]
    return np.array(own)[place].reshape(codes.shape)


Arcs = list[list[tuple[int, np.ndarray, np.ndarray]]]


def _arcs(codes: np.ndarray, pieces: Pieces) -> Arcs:
    """For every position the arcs that end there: (start, words that have it, piece of each or -1).

    A start is followed only in words where some piece goes on as they do. A symbol inside a word that is
    no piece is spelled in bytes.
    """
    n, length = codes.shape
    ending: Arcs = [[] for _ in range(length + 1)]
    for start in range(length):
        words, value = np.arange(n), np.zeros(n, np.uint64)
        for end in range(start + 1, length + 1):
            value = (value + codes[words, end - 1].astype(np.uint64) + np.uint64(1)) * PRIME
            value ^= value >> np.uint64(29)
            at, goes_on = pieces.index.find(value)
            piece = np.where(goes_on, pieces.piece[at], -1)
            is_arc = (piece >= 0) & (pieces.begins[piece] == (start == 0))
            if end == start + 1 and start:
                ending[end].append((start, words, np.where(is_arc, piece, -1)))
            elif is_arc.any():
                ending[end].append((start, words[is_arc], piece[is_arc]))
            words, value = words[goes_on], value[goes_on]
            if not len(words):
                break
    return ending


def _weighted_arcs(codes: np.ndarray, pieces: Pieces, arcs: Arcs) -> list[list[tuple]]:
    """The arcs with their log weights."""
    spelled = _byte_sums(codes, pieces)
    return [
        [(start, words, np.where(piece >= 0, pieces.weight[piece], spelled[words, start]), piece) for start, words, piece in found]
        for found in arcs
    ]


def _forward(n: int, arcs: list) -> np.ndarray:
    forward = np.full((len(arcs), n), -np.inf)
    forward[0] = 0
    for end, found in enumerate(arcs):
        for start, words, weight, _ in found:
            forward[end, words] = np.logaddexp(forward[end, words], forward[start, words] + weight)
    return forward


def marginals(codes: np.ndarray, pieces: Pieces, arcs: Arcs | None = None) -> np.ndarray:
    """Log probability of words of one length: the forward sum over all ways to cut them, and the end."""
    arcs = arcs or _arcs(codes, pieces)
    return _forward(len(codes), _weighted_arcs(codes, pieces, arcs))[-1] + pieces.end_weight


def _of(arcs: Arcs, own: np.ndarray) -> Arcs:
    """The arcs of the marked words, which are numbered anew."""
    number = np.cumsum(own) - 1
    out: Arcs = []
    for found in arcs:
        kept = [(start, own[words], words, piece) for start, words, piece in found]
        out.append([(start, number[words[k]], piece[k]) for start, k, words, piece in kept if k.any()])
    return out


def expected(codes: np.ndarray, pieces: Pieces, arcs: Arcs | None = None) -> tuple[np.ndarray, np.ndarray]:
    """How often words of one length pass each piece and spell each byte, in expectation over all cuts."""
    n, length = codes.shape
    weighted = _weighted_arcs(codes, pieces, arcs or _arcs(codes, pieces))
    forward = _forward(n, weighted)
    backward = np.full((length + 1, n), -np.inf)
    backward[length] = 0
    whole = forward[length]
    passed, shares, symbols = [], [], []
    for end in range(length, 0, -1):
        for start, words, weight, piece in weighted[end]:
            path = weight + backward[end, words]
            backward[start, words] = np.logaddexp(backward[start, words], path)
            passed.append(piece)
            shares.append(np.exp(forward[start, words] + path - whole[words]))
            symbols.append(codes[words, start])
    if not passed:
        return np.zeros(len(pieces.weight)), np.zeros(256)
    piece, share, symbol = np.concatenate(passed), np.concatenate(shares), np.concatenate(symbols)
    known, spelled = piece >= 0, np.zeros(256)
    counts = np.bincount(piece[known], share[known], len(pieces.weight))
    if not known.all():
        found, place = np.unique(symbol[~known], return_inverse=True)
        for code, mass in zip(found.tolist(), np.bincount(place, share[~known])):
            for b in chr(code).encode("utf-8", "replace"):
                spelled[b] += mass
    return counts, spelled


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and code points of the words of each length, with the mark of a word's start."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for run in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        step = max(1, (1 << 18) // (int(lengths[run[0]]) + 1)) if len(run) else 1
        for at in range(0, len(run), step):
            part = run[at : at + step]
            yield part, _codes([START + words[i] for i in part.tolist()])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in runs of at least WORDS rows or RUN_BYTES, so that words of one length are many."""
    run: list[pa.RecordBatch] = []
    for batch in batches:
        run.append(batch)
        if sum(b.num_rows for b in run) >= WORDS or sum(b.nbytes for b in run) >= RUN_BYTES:
            yield pa.concat_batches(run)
            run = []
    if run:
        yield pa.concat_batches(run)


def _counts(groups: int, letter: str = "c") -> list[str]:
    return [f"{letter}{k}" for k in range(groups)]


def _chunks(limit: int, groups: int):
    """Words of every chunk with their training counts, and its texts as packed numbers of words."""

    names = ["chunk", "place", "word", *_counts(groups), "key", "held", "n", "ids"]

    def words(chunk: int, known: dict[bytes, int], trained: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = len(known)
        nulls = [pa.nulls(n, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.binary())]
        column = pa.array(list(known), pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, chunk)), pa.array(np.arange(n)), column, *map(pa.array, trained), *nulls], names=names
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() * CHUNKS_PER_TASK
        known: dict[bytes, int] = {}
        trained, size = np.zeros((groups, 0), np.int64), 0
        for batch in batches:
            out, held = [], batch.column(2).to_pylist()
            for text, key, other, group in zip(texts_of(batch.column(1)), batch.column(0).to_pylist(), held, batch.column(3).to_pylist()):
                found = text.lower().split()
                own = np.fromiter((known.setdefault(w, len(known)) for w in found), np.int64, len(found))
                if trained.shape[1] < len(known):
                    trained = _wider(trained, 2 * len(known))
                if not other and len(own):
                    found, times = np.unique(own, return_counts=True)
                    trained[group, found] += times
                own.sort()
                packed = np.diff(own, prepend=0).astype("<u4").tobytes()
                out.append((chunk, key, other, len(own), pa.compress(packed, "zstd", asbytes=True)))
                size += len(text)
                if size >= limit:
                    yield from texts(out)
                    yield from words(chunk, known, trained[:, : len(known)])
                    known, trained, size, out = {}, np.zeros((groups, 0), np.int64), 0, []
                    chunk += 1
            yield from texts(out)
        if known:
            yield from words(chunk, known, trained[:, : len(known)])

    def texts(out: list) -> Iterator[pa.RecordBatch]:
        if out:
            chunk, key, held, n, ids = zip(*out)
            nulls = [pa.nulls(len(out), t) for t in (pa.int64(), pa.string(), *[pa.int64()] * groups)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chunk, pa.int64()), *nulls, pa.array(key, pa.int64()), pa.array(held, pa.bool_()),
                    pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
                ],
                names=names,
            )

    return task


def _wider(table: np.ndarray, columns: int) -> np.ndarray:
    out = np.zeros((table.shape[0], columns), table.dtype)
    out[:, : table.shape[1]] = table
    return out


def _expect(pieces):
    """Expected counts of a task's words in each group; a group's pieces are numbered in order, then its bytes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared(pieces)
        size = len(models[0].weight)
        total = np.zeros((len(models), size + 256))
        for batch in _gathered(batches):
            trained = [column.to_numpy() > 0 for column in batch.columns[1:]]
            for at, codes in _by_length(batch.column(0).to_pylist()):
                arcs = _arcs(codes, models[0])
                for k, model in enumerate(models):
                    own = trained[k][at]
                    if own.any():
                        counts, spelled = expected(codes[own], model, _of(arcs, own))
                        total[k, :size] += counts
                        total[k, size:] += spelled
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total.ravel()[used])], names=["piece", "passed"])

    return task


def fit_pieces(counts: DataFrame, columns: list[str], types: list[int], pieces: Pieces, rounds: int = ROUNDS) -> list[Pieces]:
    """Weights for each group from how often its different words pass each piece; the given weights are a prior.

    `counts` has the words and their counts by group, `types` the number of different words of each.
    """
    spark = counts.sparkSession
    prior = np.exp(pieces.weight)
    models = [pieces] * len(columns)
    for _ in range(rounds if any(types) else 0):
        found = map_arrow(counts.select("word", *columns), _expect(share(spark, models)), "piece bigint, passed double")
        rows = found.groupBy("piece").agg(F.sum("passed")).collect()  # at most a row per group and piece of the vocabulary
        passed = np.zeros(len(columns) * (len(prior) + 256))
        for piece, sum_ in rows:
            passed[piece] = sum_
        models = [
            _weighted(m.index, m.piece, m.begins, own[:-256] + PRIOR * prior, own[-256:] + PRIOR / 2**16, n + 1.0) if n else m
            for m, own, n in zip(models, passed.reshape(len(columns), -1), types)
        ]
    return models


def _spelled(pieces):
    """Natural log of what the pieces of each group give each word."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared(pieces)
        names = _counts(len(models), "s")
        for batch in _gathered(batches):
            words = batch.column(0).to_pylist()
            found = np.zeros((len(models), len(words)))
            for at, codes in _by_length(words):
                arcs = _arcs(codes, models[0])
                for k, model in enumerate(models):
                    found[k, at] = marginals(codes, model, arcs)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], names=[*batch.schema.names, *names])

    return task


@dataclass
class Totals:
    """By group the words read, texts, and share left to unseen words; tokens and vocabulary of the plain model."""

    words: np.ndarray
    texts: np.ndarray
    unseen: np.ndarray
    tokens: int
    vocabulary: int

    def shares(self, counts: np.ndarray, spelled: np.ndarray, borrowed: float) -> np.ndarray:
        """Log share of each word in each group: its arc as a word, next to its cuts into pieces."""
        with np.errstate(divide="ignore"):
            seen, unseen = np.log1p(-self.unseen)[:, None], np.log(self.unseen)[:, None]
            own = np.log(counts) - np.log(np.maximum(self.words, 1))[:, None] + seen
            if not self.words.any():
                return spelled
            elsewhere = np.log(counts.sum(axis=0)) - np.log(self.words.sum()) + np.log(borrowed) + unseen
            return np.logaddexp(np.logaddexp(own, elsewhere), spelled + np.log1p(-borrowed) + unseen)


def _text_scores(totals: Totals, groups: int, borrowed: float):
    """Rows come by chunk, its words before its texts."""
    all_texts = int(totals.texts.sum())
    ends = (all_texts + 1) / (totals.tokens + 2)
    last, goes_on = np.log(ends), np.log1p(-ends)
    plain = np.log10(totals.tokens + totals.vocabulary + 1)
    end_base = np.log10(all_texts + 1) - plain
    prior = np.log((totals.texts + 1) / (all_texts + groups))
    names = ["key", "held", "n_tokens", "n_known", "base_score", "score"]
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())

    def tables(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros((groups, 0))
        place, *rest = (np.concatenate(c) for c in zip(*parts))
        rest = np.stack(rest)[:, np.argsort(place)]
        counts, spelled = rest[:groups].astype(np.int64), rest[groups:]
        trained = counts.sum(axis=0)
        return trained, np.log10(trained + 1) - plain, totals.shares(counts, spelled, borrowed)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, parts, table, out = None, [], None, []
        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            cuts = np.flatnonzero(np.diff(chunks)) + 1
            for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(chunks)]):
                if chunks[start] != chunk:
                    chunk, parts, table = chunks[start], [], None
                part = batch.slice(start, stop - start)
                is_text = pc.is_valid(part.column("ids"))
                words = part.filter(pc.invert(is_text))
                if words.num_rows:
                    parts.append([words.column(c).to_numpy() for c in ("place", *_counts(groups), *_counts(groups, "s"))])
                texts = part.filter(is_text)
                if texts.num_rows and table is None:
                    table = tables(parts)
                for key, held, n, ids in zip(*(texts.column(c).to_pylist() for c in ("key", "held", "n", "ids"))):
                    trained, base, shares = table
                    own = np.zeros(0, np.int64)
                    if n:
                        own = np.cumsum(np.frombuffer(pa.decompress(ids, 4 * n, "zstd", asbytes=True), "<u4"), dtype=np.int64)
                    score = np.logaddexp.reduce(prior + shares[:, own].sum(axis=1)) + last + n * goes_on
                    known = int((trained[own] > 0).sum()) + (all_texts > 0)
                    out.append((key, held, n + 1, known, float(base[own].sum() + end_base), float(score / np.log(10))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                out = []

    return task


def score_texts(
    docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", group: str | None = "lang",
    vocabulary: str = VOCABULARY, chunk_bytes: int = CHUNK_BYTES, borrowed: float = BORROWED,
) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Tokens are the words between ASCII white space, with A-Z in lower case, and one end. Texts of rows
    with `held_out` are scored only, the others are learned from too; of held-out rows the group is not
    used. A missing text is empty and consists of its end, a missing group is the group of all others.
    Repeated rows are texts of their own. Without training texts every word is spelled in pieces by the
    vocabulary's scores; an empty table gives an empty result.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "lattice")
    label = F.lit(None).cast("string") if group is None or group not in docs.columns else F.col(group).cast("string")
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"), held_out.alias("held"), label.alias("group")
    )
    largest = rows.where(~F.col("held") & F.col("group").isNotNull()).groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    names = [r[0] for r in largest.orderBy(F.desc("n"), "group").limit(GROUPS).collect()]
    groups = len(names) + 1
    number = F.lit(0)
    for k, name in enumerate(names, 1):
        number = F.when(F.col("group") == name, k).otherwise(number)
    columns = _counts(groups)
    schema = f"chunk bigint, place bigint, word string, {', '.join(f'{c} bigint' for c in columns)}, key bigint, held boolean, n bigint, ids binary"
    chunks, seen = scratch.write_with(
        map_arrow(rows.withColumn("group", number), _chunks(chunk_bytes, groups), schema), "chunks", words=F.count("word")
    )
    texts = dict(rows.where(~F.col("held")).groupBy(number.alias("group")).count().collect())
    words = chunks.where(F.col("word").isNotNull())
    trained = sum(F.col(c) for c in columns)
    counts, total = scratch.write_with(
        words.groupBy("word").agg(*[F.sum(c).alias(c) for c in columns]),
        "counts",
        types=F.sum(F.when(trained > 0, 1)),
        **{f"o{c}": F.sum(F.when(F.col(c) == 1, 1)) for c in columns},
        **{c: F.sum(c) for c in columns},
        **{f"t{c}": F.sum(F.when(F.col(c) > 0, 1)) for c in columns},
    )
    by_group = np.array([total[c] or 0 for c in columns], np.int64)
    read, n_texts = int(by_group.sum()), sum(texts.values())
    totals = Totals(
        by_group,
        np.array([texts.get(k, 0) for k in range(groups)], np.int64),
        # the share of words seen once is that of words still unseen (Good and Turing)
        np.array([((total[f"o{c}"] or 0) + 1) / (total[c] + 2) if total[c] else 1.0 for c in columns]),
        read + n_texts,
        (total["types"] or 0) + (n_texts > 0),
    )
    models = fit_pieces(counts.where(trained > 0), columns, [total[f"t{c}"] or 0 for c in columns], load_pieces(vocabulary))
    marks = _counts(groups, "s")
    schema = ", ".join(["word string", *[f"{c} bigint" for c in columns], *[f"{c} double" for c in marks]])
    spelled = map_arrow(counts, _spelled(share(spark, models)), schema)
    parts = parts_for(seen["words"], 400_000)
    placed, spelled = words.select("chunk", "place", "word").repartition(parts, "word"), spelled.repartition(parts, "word")
    answers = placed.join(spelled, "word").drop("word").withColumns(
        {c: F.lit(None).cast(t) for c, t in (("key", "long"), ("held", "boolean"), ("n", "long"), ("ids", "binary"))}
    )
    waiting = chunks.where(F.col("ids").isNotNull()).drop("word").withColumns({c: F.lit(None).cast("double") for c in marks})
    together = answers.unionByName(waiting).repartition(parts, "chunk")
    found = map_arrow(
        together.sortWithinPartitions("chunk", F.col("ids").isNotNull()),
        _text_scores(totals, groups, borrowed),
        "key bigint, held boolean, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    return found.select(
        F.col("key").alias(key), F.col("held").alias("held_out"), "n_tokens", "n_known",
        F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
