import random
import re

import duckdb
import pytest

from paywatch.llm import wu_manber
from paywatch.llm.oracles import ORACLES
from paywatch.llm.queries import QUERIES
from tools.check import canonical

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def expected(docs, items, window):
    windows: dict[tuple, set] = {}
    for item, text in items:
        words = words_of(text)
        length = min(window, len(words))
        for i in range(len(words) - length + 1 if length and item is not None else 0):
            windows.setdefault(tuple(words[i : i + length]), set()).add(str(item))
    out = {}
    for key, text in docs:
        words, hit, names = words_of(text), set(), set()
        for length in {len(w) for w in windows}:
            for i in range(len(words) - length + 1):
                if found := windows.get(tuple(words[i : i + length])):
                    hit |= set(range(i, i + length))
                    names |= found
        out[key] = (len(words), len(hit), sorted(names))
    return out


@pytest.mark.parametrize("window", [1, 2, 4, 10])
@pytest.mark.parametrize("round_bytes", [30, 1 << 20])
def test_hits(rows, window, round_bytes):
    """The small bound searches the benchmark in several rounds."""
    rng = random.Random(window)
    names = ["Alpha", "béta", "c3", "d", "e-f", "Ünder"]
    text = lambda n: rng.choice([" ", ", "]).join(rng.choices(names, k=n))
    items = [(i, text(rng.randint(0, 14))) for i in range(8)] + [(50, None), (51, ""), (None, "Alpha d"), (2, "zz top"), (52, "...")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(30)] + [(90, None), (91, ""), (92, items[0][1] * 2), (93, "ZZ, top! d")]
    found = wu_manber.benchmark_hits(
        rows("doc_id long, text string", *docs), rows("item_id long, text string", *items), window=window, round_bytes=round_bytes
    ).select("row.doc_id", "n_words", "n_hit", "items").collect()
    assert {r[0]: (r[1], r[2], list(r[3])) for r in found} == expected(docs, items, window)


def test_edges(rows):
    docs = rows("doc_id long, text string, hits string, items long, n_words long", (1, "a b c", "x", 1, 2), (1, "a b c", "x", 1, 2),
                (None, None, None, None, None), (3, "q " * 50_000 + "a b c", "x", 1, 2))
    bench = rows("item_id long, text string", (1, "A b, C"))
    found = wu_manber.benchmark_hits(docs, bench)
    assert [r["n_hit"] for r in found.orderBy("n_words").collect()] == [0, 3, 3, 3]
    kept = wu_manber.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(None,) * 5]
    assert wu_manber.drop_contaminated(docs, bench.where("false")).count() == 4
    assert wu_manber.benchmark_hits(docs.where("false"), bench).count() == 0


@pytest.mark.parametrize("round_bytes", [8, 1 << 20])
def test_items_without_id_contaminate(rows, tmp_path, spark, round_bytes):
    """As in the SQL: their words are hit, and together they count as one item without a name."""
    docs = rows("doc_id long, text string", (1, "x a b c y"), (2, "d e f"), (3, "q r"), (4, "a b c d e f"))
    bench = rows("item_id long, text string", (None, "A b, C"), (7, "d e f"), (None, "e f"))
    found = wu_manber.benchmark_hits(docs, bench, round_bytes=round_bytes, nameless=True).select("row.doc_id", "n_hit", "items").collect()
    assert {r[0]: (r[1], r[2]) for r in found} == {1: (3, [None]), 2: (3, ["7", None]), 3: (0, []), 4: (6, ["7", None])}
    assert [r[0] for r in wu_manber.drop_contaminated(docs, bench, round_bytes=round_bytes).collect()] == [3]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    ours, theirs = (canonical(f) for f in (QUERIES["op4_decontamination"](spark, str(tmp_path)).toPandas(), db.sql(ORACLES["op4_decontamination"]).df()))
    assert ours.equals(theirs)
