"""Benchmark decontamination with Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items. For each pattern length there is a shift table from a
block of words to how far the search may jump, buckets from the last block of a window (shift zero) to
the windows that end with it, and a direct comparison of the words that confirms an occurrence.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paywatch.llm.common import map_arrow, share, shared, texts_of
from paywatch.session import Scratch

WINDOW = 10
BLOCK = 2

#: Bytes of benchmark text whose tables are sent to the tasks at once; a larger benchmark takes more rounds.
ROUND_BYTES = 2 << 20

#: Lower-case A-Z; ASCII characters that no word has become a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Patterns:
    """Shift tables, buckets and items of a set of windows, by window length."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW) -> None:
        owners: dict[int, dict[tuple[bytes, ...], set]] = defaultdict(lambda: defaultdict(set))
        for item, words in items:
            length = min(window, len(words))
            for at in range(len(words) - length + 1 if length else 0):
                owners[length][tuple(words[at : at + length])].add(item)
        self.tables = []
        alike: dict[frozenset, frozenset] = {}  # windows of the same items share one set
        for length, windows in sorted(owners.items()):
            block = min(BLOCK, length)
            shift: dict[tuple[bytes, ...], int] = {}
            buckets: dict[tuple[bytes, ...], list] = defaultdict(list)
            for words, found in windows.items():
                for end in range(block, length + 1):
                    key = words[end - block : end]
                    shift[key] = min(shift.get(key, length), length - end)
                held = frozenset(found)
                buckets[words[length - block :]].append((words, alike.setdefault(held, held)))
            self.tables.append((length, block, shift, dict(buckets)))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, frozenset]]:
        """Every occurrence: first word, length, items that have the window."""
        for length, block, shift, buckets in self.tables:
            far = length - block + 1
            jump, end, total = shift.get, length, len(words)
            while end <= total:
                key = tuple(words[end - block : end])
                step = jump(key, far)
                if step:
                    end += step
                    continue
                start = end - length
                for window, items in buckets[key]:
                    if words[start] == window[0] and tuple(words[start:end]) == window:
                        yield start, length, items
                end += 1


FOUND = "hits binary, items array<string>, n_words bigint, n_hit bigint"
FOUND_ARROW = (pa.binary(), pa.list_(pa.string()), pa.int64(), pa.int64())


def _scan(patterns, text: str, keep: list[str]):
    """Adds the hit words (one byte each) and the items of one set of patterns to those found before.

    Of the rows, which travel as a struct, the columns `keep` go on.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared(patterns)
        for batch in batches:
            rows, found = batch.column(0), []
            before = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            for body, (old, seen) in zip(texts_of(rows.field(text)), before):
                words = words_of(body)
                mark, names = bytearray(old or b""), set(seen or ())
                for start, length, items in table.search(words):
                    mark = mark or bytearray(len(words))
                    mark[start : start + length] = b"\1" * length
                    names |= items
                found.append((bytes(mark) or None, sorted(names, key=lambda name: (name is None, name or "")), len(words), mark.count(1)))
            on = pa.StructArray.from_arrays([rows.field(c) for c in keep], names=keep)
            columns = [pa.array(c, t) for c, t in zip(zip(*found), FOUND_ARROW)] if found else [pa.array([], t) for t in FOUND_ARROW]
            yield pa.RecordBatch.from_arrays([on, *columns], names=["row", "hits", "items", "n_words", "n_hit"])

    return task


def _rounds(
    benchmark: DataFrame, item: str, text: str, round_bytes: int, nameless: bool
) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Benchmark items in sets of bounded bytes; a single item may exceed the bound."""
    held, size = [], 0
    items = benchmark if nameless else benchmark.where(F.col(item).isNotNull())
    rows = items.select(F.col(item).cast("string"), F.col(text).cast("string"))
    for name, body in rows.toLocalIterator():
        words = words_of((body or "").encode())
        if held and size + len(body or "") > round_bytes:
            yield held
            held, size = [], 0
        held.append((name, words))
        size += len(body or "")
    yield held


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    round_bytes: int = ROUND_BYTES,
    keep: list[str] | None = None,
    nameless: bool = False,
) -> DataFrame:
    """The columns `keep` (default: all) of every row of `docs` as struct `row`, with n_words, n_hit and items.

    A window is `window` consecutive words of an item, or all words of a shorter item; an item without
    words has none. An item without id counts only if `nameless`; it then stands in `items` as one null, after the
    ids. `items` are the ids, as sorted strings, of the items with a window
    that occurs in the text, `n_hit` the words inside any occurrence. Missing texts have no words. Rows
    that repeat are judged alike; an empty benchmark hits nothing, an empty table gives an empty result.
    """
    spark, keep = docs.sparkSession, keep or docs.columns
    rounds = _rounds(benchmark, item, item_text, round_bytes, nameless)
    scratch = Scratch(spark, "decontamination")
    part = next(rounds)
    marked = docs.withColumn(text, F.col(text).cast("string")).select(
        F.struct(*docs.columns).alias("row"), F.lit(None).cast("binary").alias("hits"), F.lit(None).cast("array<string>").alias("items")
    )
    while part is not None:
        after = next(rounds, None)
        on = keep if after is None else docs.columns
        kinds = {f.name: f.dataType.simpleString() for f in marked.schema["row"].dataType.fields}
        schema = f"row struct<{', '.join(f'`{c}`: {kinds[c]}' for c in on)}>, {FOUND}"
        table = share(spark, Patterns(part, window))
        marked = map_arrow(marked.select("row", "hits", "items"), _scan(table, text, on), schema)
        if after is not None:
            marked = scratch.write(marked, "round")  # so that a task holds the tables of one round only
        part = after
    return marked.select("row", "n_words", "n_hit", "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows without any hit, also of benchmark items without id, with the columns of `docs`."""
    return benchmark_hits(docs, benchmark, **{"nameless": True, **options}).where("n_hit = 0").select("row.*")
