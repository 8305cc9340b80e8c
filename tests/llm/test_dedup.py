"""Exact, substring, suffix-array and near-duplicate removal against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from paywatch.llm import anchors, common, doubling, exact_dedup, simhash, suffix

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string"


def corpus(seed: int, n: int = 60, vocabulary: int = 12, words: int = 60) -> list[tuple]:
    """Texts with exact copies, shared passages, repeats inside a text, empty and missing ones."""
    rng = random.Random(seed)
    names = ["".join(rng.choices("abçdé", k=rng.randint(1, 6))) for _ in range(vocabulary)]
    passage = " ".join(rng.choices(names, k=30))
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(names, k=rng.randint(0, words)))
        if i % 4 == 0:
            text = f"{text} {passage} {' '.join(rng.choices(names, k=9))}"
        if i % 9 == 0 and rows:
            text = rng.choice(rows)[1] or ""
        if i % 10 == 0:
            text = text.replace(" ", "\n\t", 2)
        if i % 13 == 0:
            text = f"{text} {text}"
        rows.append((i * 7 % 101, text, "s"))
    return [*rows, (200, None, None), (201, "", "s"), (202, " \n", "s"), (203, "x", "s")]


def exact_expected(rows):
    groups: dict[str, list] = {}
    for key, text, *_ in rows:
        groups.setdefault(SPACE.sub("", text or ""), []).append((-len(text or ""), key is None, key or 0, key))
    out = []
    for key, text, *_ in rows:
        body = SPACE.sub("", text or "")
        keep = min(groups[body])[3]
        out.append((key, keep, len(groups[body]), key == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"table_bytes": 400, "bucket_bytes": 2_000}])
def test_exact_groups(rows, sizes):
    """The small table forces several levels of buckets."""
    data = corpus(1)
    found = exact_dedup.exact_groups(rows(DOCS, *data), **sizes).drop("ties").collect()
    assert sorted(map(tuple, found), key=str) == exact_expected(data)


def test_exact_ties_repeats_and_missing_ids(rows):
    data = [(1, "a b", "s"), (1, "a b", "s"), (1, "a  b", "t"), (None, "ab", "s"), (None, "zz", "s"), (None, "zz", "s"), (5, "ab ", "s")]
    frame = rows(DOCS, *data)
    groups = exact_dedup.exact_groups(frame)
    assert {r["group_size"] for r in groups.where("doc_id = 1").collect()} == {5}
    kept = sorted(map(tuple, exact_dedup.drop_copies(frame).collect()), key=str)
    assert kept == [(1, "a  b", "t"), (None, "zz", "s")]


def test_content_table_compares_contents():
    """Two contents with one hash stay apart."""
    held = exact_dedup.ContentTable(1 << 20)
    for key in range(3000):
        held.add(b"same-hash", str(key % 1500).encode(), 1, 1, key, 1)
    assert len(held.entries) == 1500 and all(e[2] == 2 for e in held.entries)


def words_expected(rows, window):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), {}
    for key, text, *_ in order:
        words = WORD.findall(text or "")
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - window + 1):
            own = tuple(words[i : i + window])
            if own in seen:
                gone[i : i + window] = True
            seen.add(own)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[key] = (len(words), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("salted", [0, 8])
def test_substring_dedup(rows, monkeypatch, seed, salted):
    """With no segments allowed unsalted, every anchor that has two is spread."""
    monkeypatch.setattr(anchors, "SALTED_SEGMENTS", salted)
    monkeypatch.setattr(anchors, "FLUSH_BYTES", 3_000)
    data = corpus(seed, vocabulary=3 + 3 * seed)
    found = doubling.drop_repeats(rows(DOCS, *data), window=8).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == words_expected(data, 8)


def test_substring_dedup_moves_compressed_texts(spark, rows, monkeypatch):
    """Where texts go through a shuffle, as in large tables, they are packed, and the answer is the same."""
    sizes, pack = [], doubling.packed

    def watched(*args):
        out = pack(*args)
        sizes.append(out.agg(F.sum(F.octet_length("text"))).first()[0])
        return out

    data = corpus(2, vocabulary=9, words=400)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(doubling, "packed", watched)
        found = doubling.drop_repeats(rows(DOCS, *data), window=8).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {r[0]: tuple(r[1:]) for r in found} == words_expected(data, 8)
    whole = sum(len((text or "").encode()) for _, text, _ in data)
    assert len(sizes) == 2 and max(sizes) < 0.8 * whole
    pressed = common.packed(rows(DOCS, *data), ["doc_id"]).toArrow().combine_chunks()
    texts = common.unpacked(pressed.column("text").chunk(0))
    assert dict(zip(pressed.column("doc_id").to_pylist(), texts)) == {key: (text or "").encode() for key, text, _ in data}


def bytes_expected(rows, length):
    counts: Counter = Counter()
    texts = [(key, (text or "").encode()) for key, text, *_ in rows]
    for _, text in texts:
        counts.update(text[i : i + length] for i in range(len(text) - length + 1))
    out = []
    for key, text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if counts[text[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((key, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("limits", [{}, {"block_bytes": 200}, {"group_segments": 1}])
def test_suffix_dedup(rows, monkeypatch, seed, limits):
    """Small blocks, and all open groups dealt out by window."""
    monkeypatch.setattr(anchors, "FLUSH_BYTES", 3_000)
    data = corpus(seed, vocabulary=4 * seed)
    found = suffix.drop_repeated_bytes(rows(DOCS, *data), length=40, **limits).collect()
    got = sorted([(*r[:5], bytes(r[5])) for r in found], key=str)
    assert got == bytes_expected(data, 40)


def test_suffix_dedup_counts_repeated_rows(rows):
    data = [(1, "abcdefgh" * 20, "s"), (2, "q" * 300, "s"), (3, "unlike " + "z1y2x3w4v5" * 3, "s"), (3, "unlike " + "z1y2x3w4v5" * 3, "s")]
    found = suffix.drop_repeated_bytes(rows(DOCS, *data), length=20).collect()
    assert sorted([(*r[:5], bytes(r[5])) for r in found], key=str) == bytes_expected(data, 20)


@pytest.fixture(scope="module")
def alike(spark):
    """Two texts whose 32-bit hashes are equal."""
    body = F.concat(F.repeat(F.concat(F.sha2(F.col("id").cast("string"), 256), F.lit(" ")), (4 + F.col("id") % 3).cast("int")), F.col("id").cast("string"))
    texts = spark.range(300_000).select(body.alias("text")).groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("same"))
    return sorted(texts.where(F.size("same") > 1).first()["same"], key=len)[:2]


@pytest.mark.parametrize("key", [None, 7])
def test_texts_of_one_id_and_one_short_hash(rows, alike, key):
    """What repeats in one text must not be cut from another with the same id and 32-bit hash."""
    short, long = alike
    unique = " ".join(f"u{i}" for i in range(60))
    data = [(key, short, "s"), (key, long, "s"), (1, long, "s"), (2, unique, "s")]
    found = suffix.drop_repeated_bytes(rows(DOCS, *data), length=40).collect()
    assert sorted([(*r[:5], bytes(r[5])) for r in found], key=str) == bytes_expected(data, 40)
    schema = anchors.identified(rows(DOCS, *data), "doc_id", "text")
    assert schema.select("doc", "tag").distinct().count() == 4


@pytest.mark.parametrize("seed", range(6))
def test_interval_expansion(seed):
    rng = np.random.default_rng(seed)
    length = int(rng.integers(3, 12))
    strings = [bytes(rng.integers(97, 99 + seed % 3, int(rng.integers(length, 80))).astype(np.uint8)) for _ in range(6)]
    strings += strings[:1] * (seed % 3)
    counts = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
    for own, found in zip(strings, suffix.repeated_starts(strings, length)):
        assert found.tolist() == [i for i in range(len(own) - length + 1) if counts[own[i : i + length]] > 1]


def test_leftmost_minima():
    values = np.random.default_rng(3).integers(0, 40, 500).astype(np.uint64)
    for width in (1, 5, 32, 33, 120):
        expected = [i + int(values[i : i + width].argmin()) for i in range(len(values) - width + 1)]
        assert anchors.leftmost_minima(values, width).tolist() == expected


def slow_print(text):
    words = WORD.findall(text.translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints: dict[int, int], distance: int) -> dict[int, int]:
    keys, group = sorted(prints), {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                if (prints[a] ^ prints[b]).bit_count() <= distance and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    return group


def test_simhash_groups(rows):
    data = corpus(4) + [(300 + i, "One two THREE four five six " * 40 + f"w{i}", "s") for i in range(12)]
    found = simhash.simhash_groups(rows(DOCS, *data)).collect()
    prints = {key: slow_print(text or "") for key, text, _ in data}
    assert {r[0]: r[1] % (1 << 64) for r in found} == prints
    assert {r[0]: r[2] for r in found} == grouped(prints, 2)


@pytest.mark.parametrize("distance, limit", [(1, 20_000), (2, 6), (3, 20_000)])
def test_links_of_crowded_prints(spark, distance, limit):
    """Prints close together share many bits; with the small limit their groups are dealt out again."""
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 1 << 62, 4)
    prints = {int(b) ^ int(f) for b in base for f in (1 << rng.integers(0, 64, (25, 2)).astype(np.uint64)).sum(axis=1, dtype=np.uint64)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    links = simhash.print_links(frame, distance, limit).collect()
    mine = {p: p for p in signed}
    for _ in mine:
        for r in links:
            mine[r["src"]] = mine[r["dst"]] = min(mine[r["src"]], mine[r["dst"]])
    classes: dict[int, set] = {}
    for p, m in mine.items():
        classes.setdefault(m, set()).add(p % (1 << 64))
    slow = grouped({p % (1 << 64): p % (1 << 64) for p in signed}, distance)
    expected: dict[int, set] = {}
    for p, m in slow.items():
        expected.setdefault(m, set()).add(p)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))


def test_near_copies_leave_one(rows):
    text = "a quick brown fox jumps over the lazy dog near the river bank " * 30
    frame = rows(DOCS, (7, text, "s"), (3, text + "x", "s"), (9, "something else entirely here", "s"), (None, text, "s"), (9, "something else entirely here", "s"))
    kept = simhash.drop_near_copies(frame)
    assert sorted(r[0] for r in kept.collect()) == [3, 9] and kept.columns == frame.columns


def test_near_copies_without_or_with_shared_ids(rows):
    """Every component keeps one row, whatever its ids."""
    text = "a quick brown fox jumps over the lazy dog near the river bank " * 30
    other, third = "something else entirely here " * 9, "one more text that has its own words " * 9
    kept = simhash.drop_near_copies(rows(DOCS, (None, other, "s"), (None, third, "s"), (None, text, "s"), (7, text + "x", "s")))
    assert sorted(r[1] for r in kept.collect()) == sorted([other, third, text + "x"])
    kept = simhash.drop_near_copies(rows(DOCS, (5, other, "s"), (5, third, "s"), (5, text, "s"), (4, text, "s")))
    assert sorted((r[0], r[1]) for r in kept.collect()) == sorted([(5, other), (5, third), (4, text)])


@pytest.mark.parametrize(
    "operator",
    [
        exact_dedup.exact_groups, exact_dedup.drop_copies, doubling.drop_repeats, suffix.drop_repeated_bytes,
        simhash.simhash_groups, simhash.drop_near_copies,
    ],
)
def test_empty_tables_missing_values_and_clashing_names(spark, rows, operator):
    schema = DOCS + ", key long, n long, digest binary, doc long, tag int, print long, _n long"
    extra = (1, 2, b"x", 3, 4, 5, 6)
    assert operator(rows(schema, (1, "a", "s", *extra)).where("false")).count() == 0
    data = [(1, None, None, *extra), (None, None, None, *[None] * 7), (2, "word " * 30_000, "s", *extra), (3, "", "s", *extra)]
    found = operator(rows(schema, *data)).collect()
    assert {r[0] for r in found} <= {1, 2, 3, None} and len(found) >= 2
