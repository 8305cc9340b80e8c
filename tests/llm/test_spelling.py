"""Spelling variants against brute force."""

import os
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from paywatch.llm import spelling
from paywatch.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
DOCS = "doc_id long, text string, word string, n long, form string"


def brute_force(data, change=True):
    """Words by plain counting; near words meet by what is left of them without one code point."""
    counts = Counter()
    for key, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if change and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near, without = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            without[rest, i].add(w)
            if rest in counts:
                near[w].add(rest)
                near[rest].add(w)
    for words in without.values():
        for a in words:
            near[a] |= words - {a}
    form = {}
    for w in counts:
        if near[w]:
            best = min(near[w], key=lambda x: (-counts[x], x))
            if counts[best] >= 10 * counts[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items())


def variants(docs, **options):
    found = spelling.spelling_variants(docs, **options)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, found.collect()))


def crowd(seed):
    rng = random.Random(seed)
    words = ["separate", "seperate", "separat", "Separates", "ïllumine", "illumine", "définition", "definition", "aaaaaaa", "aaaaaaaa", "short"]
    words += ["".join(rng.choices("abcé", k=rng.randint(6, 9))) for _ in range(150)]
    weight = [10 ** rng.randint(0, 3) for _ in words]
    chain = "lanterns " * 3000 + "lanternz " * 60 + "lanterzz " * 3
    return [(k, " ".join(rng.choices(words, weight, k=200)) + ".") for k in range(40)] + [(97, chain)]


@pytest.mark.parametrize("round_bytes", [32 << 20, 400])
def test_equals_brute_force(rows, round_bytes):
    """The small bound cuts the filters of a length into slices, which take many rounds."""
    data = crowd(3)
    docs = rows(DOCS, *[(k, t, "separate", 1, None) for k, t in data])
    want = brute_force(data)
    assert variants(docs, change=spelling.misspelt, round_bytes=round_bytes) == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] not in (r[0], r[1]) for r in want)


def test_words_without_change(rows):
    data = [(1, "forward " * 20 + "foward! " * 2), (2, "FORWARD forwards forwards, forwardß")]
    found = {r[0]: r for r in variants(rows(DOCS, *[(k, t, "", 0, "") for k, t in data]))}
    assert found == {r[0]: r for r in brute_force(data, change=False)}
    assert found["forwards"][1:] == ("forward", "forward", 2, 1, 21)
    assert "foward" not in found  # six letters


def test_edges(rows):
    long = "ab" * 40_000
    data = [(None, f"{long} {long[:-1]} {long} {long[:-1]}"), (1, None), (2, ""), (3, "1234567 ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷"), (3, "1234567 ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷"), (None, "ĀĀĀĀĀĀĀ letters letters")]
    docs = rows(DOCS, *[(k, t, "x", 1, "y") for k, t in data])
    found = variants(docs)
    assert found == sorted(brute_force(data, change=False))
    assert {(r[0][:8], r[3], r[4]) for r in found} == {("abababab", 2, 1), ("letters", 2, 0), ("÷" * 7, 4, 0)}
    assert variants(docs.where("false")) == []
    assert variants(docs.where("doc_id = 2")) == []


def test_ties_go_to_the_smaller_word(rows):
    text = "tiebrek " * 2 + "tiebreak " * 30 + "tiebrekk " * 30
    found = {r[0]: r for r in variants(rows(DOCS, (1, text, "", 0, "")))}
    assert found["tiebrek"][1:] == ("tiebreak", "tiebreak", 2, 2, 30)


def test_hashes_of_edits_are_hashes_of_words():
    word = "ñabcabba"
    codes = spelling._codes([word])
    terms = spelling._terms(np.arange(len(word)), codes)

    def direct(text):
        return int(spelling._terms(np.arange(len(text)), spelling._codes([text])).sum(dtype=np.uint64))

    _, place, hashes = spelling._deleted(codes, terms, len(word))
    assert [direct(word[:p] + word[p + 1 :]) for p in place] == hashes.tolist()
    assert len(place) == len({word[:i] + word[i + 1 :] for i in range(len(word))})
    letters = np.array(sorted(map(ord, set(word))), np.uint32)
    made = [(p, c, h) for _, places, c, hashes in spelling._replaced(codes, terms, letters) for p, h in zip(places.tolist(), hashes.tolist())]
    assert all(c > ord(word[p]) and direct(word[:p] + chr(c) + word[p + 1 :]) == h for p, c, h in made)
    assert len(made) == sum(int(c) > ord(w) for w in word for c in letters)


@needs_tables
def test_query(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op11_spelling_variants"](spark, SF_DIR).collect())) == brute_force(data)
