"""Periodic runs against brute force."""

import os
import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from paywatch.llm import recompression
from paywatch.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
DOCS = "doc_id long, text string, start long, length long, runs string"


def brute_force(words, least=24, power=3):
    """(start, end, period) of all runs by comparing every word with that one period on."""
    found = {}
    for q in range(1, len(words) // power + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end > at and end + q - at >= max(least, power * q):
                found.setdefault((at, end + q), q)
            at = end + 1
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def described(key, words):
    runs = brute_force(words)
    best = (None,) * 4
    if runs:
        s, e, q = runs[0]
        for run in runs[1:]:
            longer = (run[1] - run[0]) * q - (e - s) * run[2]
            if longer > 0 or (longer == 0 and (run[0], run[2]) < (s, q)):
                s, e, q = run
        best = (s, e - s, q, 1000 * (e - s) // q)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < e for s, e, q in runs)]
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    return (key, len(runs), *best, sha256(listed.encode()).hexdigest(), sha256(b" ".join(kept)).hexdigest())


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(60):
        texts = []
        for _ in range(rng.randint(1, 5)):
            kinds, n = rng.choice([1, 2, 2, 3, 30]), rng.choice([0, 1, 23, 24, 50, 200, 400])
            words = [rng.randrange(kinds) for _ in range(n)]
            if n and rng.random() < 0.6:
                p, start = rng.randint(1, max(1, n // 4)), rng.randrange(n)
                for i in range(start + p, min(n, start + p * rng.randint(2, 9) + rng.randint(0, 5))):
                    words[i] = words[i - p]
            texts.append(words)
        for least, power in ((24, 3), (4, 2), (1, 2)):
            found = recompression.find_runs([np.array(t, np.int64) for t in texts], least, power)
            assert [[tuple(r) for r in f.tolist()] for f in found] == [brute_force(t, least, power) for t in texts]


def test_extensions_equal_comparison():
    rng = random.Random(2)
    body = [rng.randrange(2) for _ in range(150)] * 2 + [0] * 60 + [0, 1] * 50
    symbols = np.array([2, *body, 3])
    reach = recompression.Extensions(symbols)
    a, b = (np.array([rng.randrange(1, len(body)) for _ in range(500)]) for _ in range(2))
    a, b = a[a != b], b[a != b]
    for x, y, ahead, back in zip(a.tolist(), b.tolist(), reach.forward(a, b).tolist(), reach.backward(a, b).tolist()):
        n = 0
        while symbols[x + n] == symbols[y + n]:
            n += 1
        m = 0
        while symbols[x - 1 - m] == symbols[y - 1 - m]:
            m += 1
        assert (ahead, back) == (n, m)


def test_grid_in_portions(monkeypatch):
    words = np.array([i % 5 for i in range(400)] + [i % 7 + 5 for i in range(400)])
    whole = recompression.find_runs([words, words])
    monkeypatch.setattr(recompression, "GRID_PLACES", 50)
    assert [f.tolist() for f in recompression.find_runs([words, words])] == [f.tolist() for f in whole] == [[[0, 400, 5], [400, 800, 7]]] * 2


def test_edges(rows):
    verse = "la la lu " * 9
    data = [(1, None), (2, ""), (3, " \t\n"), (None, verse), (4, verse), (4, verse), (5, "x " * 100_000), (6, "y " * 23), (7, "a b " * 12 + "c " * 24 + "d e f " * 8)]
    found = recompression.periodic_runs(rows(DOCS, *[(k, t, 1, 1, "r") for k, t in data]))
    assert found.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert len(got) == len(data)
    by = {r[0]: r for r in got}
    assert by[1][1:6] == by[2][1:6] == by[3][1:6] == by[6][1:6] == (0, None, None, None, None) and by[1][7] == sha256(b"").hexdigest()
    assert by[4][8] == by[None][8] == "la la lu" and sum(r[0] == 4 for r in got) == 2
    assert by[5][1:6] == (1, 0, 100_000, 1, 100_000_000) and by[5][8] == "x"
    assert by[7][1:6] == (3, 24, 24, 1, 24_000) and by[7][8] == "a b c d e f" and [r["period"] for r in by[7][9]] == [2, 1, 3]
    assert recompression.periodic_runs(rows(DOCS).where("false")).count() == 0


def test_equal_exponents_go_to_the_first(rows):
    text = "a b " * 12 + "c d " * 12
    assert tuple(recompression.periodic_runs(rows(DOCS, (1, text, 1, 1, "")), full=False).first())[1:6] == (2, 0, 24, 2, 12_000)


@needs_tables
def test_query(spark):
    want = []
    for key, text in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        words = (text or "").encode().split()
        h = crc32(str(key).encode())
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
        if len(words) <= 3000:  # comparing all pairs takes the square of a text
            want.append(described(key, words))
    found = {r[0]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()}
    assert len(want) > 150 and sum(r[1] > 0 for r in want) > 10
    assert [found[r[0]] for r in want] == want
