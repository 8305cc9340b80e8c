"""Language-model scores, the quality classifier and the main text of pages."""

import math
import os
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from paywatch.llm import factorisation, html_blocks, lattice

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def pieces():
    if not os.path.exists(lattice.VOCABULARY):
        pytest.skip("the vocabulary is not here")
    return lattice.load_pieces()


def spelled_slowly(word, pieces):
    """Sum over all cuts, by recursion on strings."""
    known = {int(h): p for h, p in zip(pieces.index.hashes, pieces.piece) if p >= 0}
    text = lattice.START + word
    whole = [1.0] + [0.0] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = known.get(int(lattice._hash_all(lattice._codes([text[start:end]]))[0]), -1)
            if piece >= 0 and pieces.begins[piece] == (start == 0):
                whole[end] += whole[start] * math.exp(pieces.weight[piece])
            elif start and end == start + 1:
                whole[end] += whole[start] * math.exp(pieces.byte_weight[list(text[start].encode())].sum())
    return math.log(whole[-1]) + pieces.end_weight


def test_all_cuts_of_a_word_count(pieces):
    for word in ("the", "onthere", "x一y", "ciónjaaros", "!!a"):
        found = lattice.marginals(lattice._codes([lattice.START + word]), pieces)
        assert found[0] == pytest.approx(spelled_slowly(word, pieces), rel=1e-12)


def test_weights_are_probabilities(pieces):
    assert np.exp(pieces.weight[pieces.begins]).sum() == pytest.approx(1)
    rest = np.exp(pieces.weight[~pieces.begins]).sum() + np.exp(pieces.byte_weight).sum() + math.exp(pieces.end_weight)
    assert rest == pytest.approx(1)


def test_expected_counts_of_one_cut_add_up(pieces):
    """Every word begins with one piece, in expectation too."""
    counts, _ = lattice.expected(lattice._codes([lattice.START + w for w in ("then", "this", "that")]), pieces)
    assert counts[pieces.begins].sum() == pytest.approx(3)


def base_scores(docs, trained):
    words = [(text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split() for _, text, *_ in docs]
    counts = Counter(w for own, use in zip(words, trained) if use for w in [*own, b"\n"])
    n, v = sum(counts.values()), len(counts)
    return [
        (len(own) + 1, sum(counts[w] > 0 for w in [*own, b"\n"]), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*own, b"\n"]))
        for own in words
    ]


@pytest.mark.parametrize("chunk_bytes", [40, 1 << 20])
def test_scores_of_texts(spark, rows, pieces, chunk_bytes):
    docs = [(i, f"The cat {'sat on the mat ' * (i % 5)}w{i}x", "en" if i % 3 else "de") for i in range(40)]
    docs += [(50, None, None), (51, "", "en"), (52, " \n\t", "fr"), (53, "the " * 5_000, "en"), (54, "a" * 3_000, "en"), (53, "the " * 5_000, "en")]
    frame = rows("doc_id long, text string, lang string", *docs)
    held = F.col("doc_id") % 4 == 1
    found = lattice.score_texts(frame, held, chunk_bytes=chunk_bytes).collect()
    expected = base_scores(docs, [d[0] % 4 != 1 for d in docs])
    want = sorted((d[0], d[0] % 4 == 1, *e[:3], round(e[3], 6)) for d, e in zip(docs, expected))
    assert sorted((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in found) == want
    scores = {r["doc_id"]: r["score"] for r in found}
    assert all(math.isfinite(s) and s < 0 for s in scores.values()) and scores[54] < scores[51] < 0


def test_scores_do_not_depend_on_chunks(rows, pieces):
    docs = [(i, f"some words here w{i % 7} zz{i}", "en") for i in range(30)]
    frame = rows("doc_id long, text string, lang string", *docs)
    runs = [lattice.score_texts(frame, F.col("doc_id") % 5 == 2, chunk_bytes=c).collect() for c in (60, 1 << 20)]
    first, second = ({r["doc_id"]: r["score"] for r in run} for run in runs)
    assert first == pytest.approx(second, rel=1e-9)


def cuts(word, names):
    """All ways to cut a word: lists of pieces by name and of bytes by number."""

    def rest(at):
        if at == len(word):
            yield []
            return
        for end in range(at + 1, len(word) + 1):
            name = word[at:end]
            if name in names and name.startswith(lattice.START) == (at == 0):
                arc = [name]
            elif end == at + 1 and at:
                arc = list(name.encode())
            else:
                continue
            for more in rest(end):
                yield arc + more

    return list(rest(0))


def all_cuts_score(docs, held):
    """Scores by listing every cut of every word, re-weighted in the same rounds."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=lattice.VOCABULARY)
    known = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    first = {model.id_to_piece(i): 1 / (10 - model.get_score(i)) for i in known}

    def weighted(mass, byte_mass, end_mass):
        begin = sum(m for n, m in mass.items() if n.startswith(lattice.START))
        other = sum(mass.values()) - begin + sum(byte_mass) + end_mass
        weight = {n: m / (begin if n.startswith(lattice.START) else other) for n, m in mass.items()}
        return weight | {b: m / other for b, m in enumerate(byte_mass)}, end_mass / other

    inside = sum(m for n, m in first.items() if not n.startswith(lattice.START))
    start = weighted(first, [min(first.values())] * 256, inside / 2)
    texts = [text.lower().split() for _, text, _ in docs]
    langs = [g for g, _ in sorted(Counter(d[2] for d, h in zip(docs, held) if not h).items(), key=lambda p: (-p[1], p[0]))]
    ways = {w: cuts(lattice.START + w, first) for own in texts for w in own}
    by_group = [Counter(w for own, d, h in zip(texts, docs, held) if not h and d[2] == g for w in own) for g in [None, *langs]]
    n_texts = [sum(not h and d[2] == g for d, h in zip(docs, held)) for g in [None, *langs]]
    models = []
    for count in by_group:
        now = start
        for _ in range(lattice.ROUNDS if count else 0):
            passed = Counter()
            for word in count:
                paths = [(math.prod(now[0][a] for a in way), way) for way in ways[word]]
                for p, way in paths:
                    for a in way:
                        passed[a] += p / sum(q for q, _ in paths)
            mass = {n: passed[n] + lattice.PRIOR * start[0][n] for n in first}
            now = weighted(mass, [passed[b] + lattice.PRIOR / 2**16 for b in range(256)], len(count) + 1)
        models.append(now)
    everything = sum(by_group, Counter())
    read, trained = sum(everything.values()), sum(n_texts)
    ends = (trained + 1) / (read + trained + 2)
    out = {}
    for (key, *_), own in zip(docs, texts):
        whole = 0
        for count, n, (weight, end) in zip(by_group, n_texts, models):
            size = sum(count.values())
            unseen = (sum(c == 1 for c in count.values()) + 1) / (size + 2) if size else 1
            p = (n + 1) / (trained + len(by_group))
            for w in own:
                spelled = end * sum(math.prod(weight[a] for a in way) for way in ways[w])
                p *= count[w] / max(size, 1) * (1 - unseen) + unseen * (
                    lattice.BORROWED * everything[w] / read + (1 - lattice.BORROWED) * spelled
                )
            whole += p
        out[key] = math.log10(whole) + math.log10(ends) + len(own) * math.log10(1 - ends)
    return out


@pytest.mark.parametrize("words", [1, 1 << 16])
def test_scores_by_listing_all_cuts(rows, pieces, words, monkeypatch):
    monkeypatch.setattr(lattice, "WORDS", words)
    docs = [
        (1, "the cat sat", "en"), (2, "The mat the hat", "en"), (3, "das ist gut", "de"), (4, "a the", "en"),
        (5, "gut cat zqx", "de"), (6, "ist ünd \u4e16", "de"), (7, "the theß", "fr"), (8, "", "en"), (9, "hat", "en"),
    ]
    held = [d[0] in (5, 6, 9) for d in docs]
    found = lattice.score_texts(rows("doc_id long, text string, lang string", *docs), F.col("doc_id").isin(5, 6, 9)).collect()
    assert {r["doc_id"]: r["score"] for r in found} == pytest.approx(all_cuts_score(docs, held), rel=1e-9)


def test_scores_without_training_texts_or_rows(rows, pieces):
    frame = rows("doc_id long, text string", (1, "never seen"), (None, "words"))
    found = lattice.score_texts(frame, F.lit(True)).collect()
    assert {r["train_tokens"] for r in found} == {0} and all(math.isfinite(r["score"]) for r in found)
    assert lattice.score_texts(frame.where("false"), F.lit(True)).count() == 0


@needs_tables
def test_the_model_learns(spark, pieces):
    """On texts held out, scores per token rise with more training texts."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    per_token = []
    for share in (20, 2):
        part = docs.where((F.col("doc_id") % 10 == 3) | (F.col("doc_id") % share == 0))
        found = lattice.score_texts(part, F.col("doc_id") % 10 == 3).where("held_out").agg(F.sum("score") / F.sum("n_tokens"))
        per_token.append(found.first()[0])
    assert per_token[0] < per_token[1]


def test_sum_of_squares_equals_all_pairs():
    rng = np.random.default_rng(1)
    model = factorisation.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    slots, values = rng.choice(50, 9, replace=False), rng.normal(size=9)
    pairs = sum(model.factors[a] @ model.factors[b] * x * y for (a, x), (b, y) in combinations(zip(slots, values), 2))
    raw, _ = model.raw(slots, values, np.array([0]))
    assert raw[0] == pytest.approx(0.3 + model.weights[slots] @ values + pairs)


@needs_tables
def test_quality_is_learned(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    machine = factorisation.train_machine(docs, labels)
    held = labels.where(factorisation.held_out("doc_id")).select("doc_id", "quality")
    found = factorisation.score_quality(docs, machine, keep=["doc_id"]).select("row.doc_id", "score").join(held, "doc_id")
    right = found.agg(F.avg(((F.col("score") >= 0.5) == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.9


def test_quality_edges(rows):
    schema = "doc_id long, text string, n_chars long, row string, score double, label int"
    data = [(1, None, None, "r", 1.0, 1), (None, "", 5, None, None, None), (2, "word " * 40_000, 9, "r", 1.0, 0), (2, "x", 1, "r", 1.0, 0)]
    docs = rows(schema, *data)
    labels = rows("doc_id long, quality int", (2, 1), (2, None), (None, 1), (1, 0), (1, 0))
    machine = factorisation.train_machine(docs, labels)
    found = factorisation.score_quality(docs, machine)
    assert found.count() == 4 and found.where("score < 0 OR score > 1 OR score IS NULL").isEmpty()
    kept = factorisation.drop_low_quality(docs, machine, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == 4
    assert factorisation.drop_low_quality(docs.where("false"), machine).count() == 0
    blank = factorisation.train_machine(docs.where("false"), labels.where("false"))
    assert {r["score"] for r in factorisation.score_quality(docs, blank).collect()} <= {0.5} or blank.bias == 0.0


def test_rows_of_one_labelled_id_are_bounded(rows, monkeypatch):
    seen = []
    monkeypatch.setattr(factorisation, "fit", lambda learned: seen.append(learned))
    schema = "doc_id long, text string, n_chars long"
    docs = rows(schema, *[(1, "copy", 4)] * 300, *[(1, f"text {i}", 6) for i in range(100)], (7, None, None))
    labels = rows("doc_id long, quality int", (1, 1), (7, 0))
    factorisation.train_machine(docs, labels, sample_rows=40)
    factorisation.train_machine(docs.repartition(7), labels, sample_rows=40)
    factorisation.train_machine(docs, labels)
    assert [len(learned) for learned in seen] == [40, 40, len({r[0] for r in docs.select("text").collect()})]
    assert all((a[0] == b[0]).all() and a[2] == b[2] for a, b in zip(*seen[:2]))


PAGES = [
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href='/x'>Menu</a></nav><article><h1>Head</h1>"
     "<p>One &amp; two<br>three  <b>four</b></p><div class='ad'>Buy!</div><p>End.</p></article><footer>c</footer>", "Head\n\nOne & two three four\n\nEnd."),
    ("<script>var t='</p>';</script><article><p>A<p>B</article>", "A\n\nB"),
    ("<main><p>Text</p><aside><p>Side</p></aside><form><p>Name</p><input></form><section id=comments><p>Reader</p></section></main>", "Text"),
    ("<div class='cookie-notice'><p>We use cookies</p></div><div id=content><p>" + "Long story. " * 30 + "</p><p>More.</p></div>"
     "<div class=sidebar><p>" + "Link text " * 20 + "</p></div>", "Long story. " * 29 + "Long story.\n\nMore."),
    ("<article><header><h1>T</h1></header><p class=notice>Note</p><p>Body</p></article>", "T\n\nBody"),
    ("plain text only", "plain text only"),
    ("<p>cut off <b>here", "cut off here"),
    ("<nav><a href=x>a</a>", ""),
    ("", ""),
    ("<article>" + "<p>x &#233; &lt;tag&gt;</p>" * 3 + "</article>", "\n\n".join(["x é <tag>"] * 3)),
    ("<article></article><p>Outside the mark</p>", "Outside the mark"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html_blocks.main_text(page) == text


LONG, SHORT = "Long story. " * 90 + "End.", "Short last paragraph, " * 5 + "end."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class=content><p>{LONG}</p><div class=ad><p>Buy</p></div><p>{SHORT}</p></div>", f"{LONG}\n\n{SHORT}"),
        ("<article><h2 id='social-impact'>Impact</h2><p id='reply-1'>A</p><h2 id='search'>Search</h2><p>B <span class='related'>and c</span></p></article>",
         "Impact\n\nA\n\nSearch\n\nB and c"),
        ("<article><section id='social-media'><p>A</p></section><section id=comments><p>Reader</p></section></article>", "A"),
        (f"<body><form id=form1><nav><p>Menu</p></nav><div><p>{LONG}</p></div></form></body>", LONG),
        (f"<div><p>{LONG}</p><form><p>Name</p></form></div>", LONG),
        ("<article><p class='notice-period'>A</p><div class='share-prices'><p>B</p></div><div class='ad-container'><p>Buy</p></div></article>", "A\n\nB"),
        ("<article class='no-comments article--sponsored'><p>A</p><div class='card__share'>S</div><div class='related-posts'>R</div></article>", "A"),
        ("<div class='sidebar-page'><article><p>A</p></article><ol class='comment-list-2'><li>c</li></ol></div>", "A"),
        ("<article class='teaser'><p>Elsewhere</p></article><main><article><p>A</p></article><p>B</p></main><article><p>More</p></article>", "A\n\nB"),
    ],
)
def test_text_is_kept_beside_adverts_names_and_forms(page, text):
    assert html_blocks.main_text(page) == text


def links(*names, tag="li"):
    return "".join(f"<{tag}><a href='/{n}'>{n}</a></{tag}>" for n in names)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><ul>{links('a', 'b', 'c', 'd')}</ul><p>One</p><p>Two</p></article>", "One\n\nTwo"),
        (f"<article><p>One</p><ul>{links('a', 'b', 'c')}</ul><p>Two</p></article>", "One\n\nTwo"),
        (f"<article><p>One</p><ul>{links('a', 'b')}</ul></article>", "One\n\na\n\nb"),
        (f"<article><p>One</p><ul>{links('a', 'b')}<li>own <a>c</a></li></ul></article>", "One\n\na\n\nb\n\nown c"),
        (f"<article><p>One</p>{links('a', 'b', 'c', tag='p')}</article>", "One\n\na\n\nb\n\nc"),
        (f"<article><ul>{links('a', 'b', 'c')}</ul></article>", "a\n\nb\n\nc"),
        (f"<div>{links('a', 'b', 'c', tag='p')}<p>{LONG}</p>{links('d', 'e', 'f', tag='p')}</div>", LONG),
    ],
)
def test_windows_of_links_are_no_text(page, text):
    assert html_blocks.main_text(page) == text


def test_pages_of_a_table(rows):
    frame = rows("page_id long, url string, html string, text string, row long", (1, "u", "<article><p>A</article>", "t", 1), (None, None, None, None, None),
                 (1, "u", "<article><p>A</article>", "t", 1), (2, "v", "<p>" + "long " * 50_000, "t", 1))
    found = html_blocks.extract_text(frame)
    assert sorted(len(r["text"]) for r in found.collect()) == [0, 1, 1, 249_999]
    assert found.select("row.*").columns == ["page_id", "url", "text", "row"]
    assert html_blocks.extract_text(frame.where("false")).count() == 0


def test_broken_markup_takes_linear_time():
    for page in ("<a '" * 20_000, "<!--" * 20_000, "<div class=\"" * 20_000, "<script>" * 20_000, "&" * 100_000, "<p>" * 50_000):
        html_blocks.main_text(page)
