"""Main text of HTML pages by the line-block distribution.

Markup is stripped so that every block element gives a line; parts that markup names as menu, header,
footer, sidebar, notice, advert, form or reader comment give a gap of empty lines instead. The weight of
a line is the length of its text outside links. Weights are summed over sliding windows of lines: where
the sum rises from nothing the text surges, where a whole window falls back to nothing, or a gap comes, it dives.
What lies between a surge and its dive is one candidate. On a page with a marked article (`main`, else `article`) lines
outside it are empty, and the mark adds the linked text to the weight of all lines but list items: a list of links
is a menu there too, a linked paragraph is not. All candidates are its text. On a page
without that mark the heaviest candidates are, where candidates with text in one container weigh as one.
A form that holds most of the text of a page is no part beside it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from paywatch.llm.common import map_arrow

WINDOW = 3

#: On a page without a marked article, candidates of at least this share of the heaviest one are kept.
MIN_SHARE = 0.25

# HTML elements.
RAW = "script|style|title|textarea|noscript|template|iframe|svg|math|select|object|button"
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead"
    " tr ul".split()
)
BESIDE = frozenset("nav footer aside form menu dialog head fieldset".split())
SELF_CLOSING = frozenset("p li dt dd".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup caption figcaption summary".split())
#: Elements that hold paragraphs; what stands directly in one belongs together.
CONTAINERS = frozenset("article blockquote body center details div fieldset form main section td".split())
EMPTY = frozenset("br hr img input meta link wbr area base col embed source track".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
#: Words in class or id that name what stands beside a text.
HINTS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar rail menu"
    " nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal"
    " overlay newsletter subscribe subscription signup share sharing social related recommended recommendations teaser widget"
    " login search pagination pager copyright disclaimer comment comments commentlist reply replies respond disqus".split()
)
#: Words that keep a container from being named by a hint that only describes its layout.
BODY_HINTS = frozenset("content article main post entry story text body page wrapper container".split())
COMMENTS = frozenset("comment comments commentlist reply replies respond disqus".split())
#: Words that a hint may stand beside in one name; any other word makes the name one of its own.
QUALIFIERS = BODY_HINTS | frozenset(
    "site top bottom left right inner outer block box bar list item items link links slot area section wrap panel unit"
    " module posts articles stories form icon icons button buttons btn tools primary secondary global mobile desktop"
    " sticky group title heading label message author thread policy settings signup up the js".split()
)

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<more>(?>(?:[^>\"'<]+|\"[^\"<]*\"|'[^'<]*'|[\"'])*))>|<[!?/][^>]*>",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


def _beside(tag: str, more: str, in_article: bool, forms: bool = True) -> bool:
    """Whether an element is named as something other than the main text; forms are only if `forms`.

    Class and id name containers; of paragraphs only the class does, and of headings and inline elements neither.
    The id of a section inside an article is a name of its topic, unless it is a single word.
    """
    if tag in BESIDE and (forms or tag != "form") or tag == "header" and not in_article:
        return True
    if not more or tag in ("html", "body", "main"):
        return False
    if HIDDEN.search(more):
        return True
    hint = comment = body = False
    for name, value in NAMES.findall(more):
        value = value.strip("\"'").lower()
        if name.lower() == "role" and value in ROLES:
            return True
        if name.lower() == "id" and (tag in SELF_CLOSING or tag == "section" and in_article and not value.isalpha()):
            continue
        for words in _words(value):
            names_part = words <= HINTS | QUALIFIERS and words & HINTS
            hint = hint or bool(names_part)
            comment = comment or bool(names_part and words & COMMENTS)
            body = body or bool(words & BODY_HINTS and not words & HINTS)
    if tag in HEADINGS or tag not in BLOCKS and "-" not in tag:
        return False
    return comment or tag != "article" and hint and not body


def _words(value: str) -> Iterator[frozenset[str]]:
    """The words of every whole name in a class or id, without modifiers and numbers.

    Names of layouts, which end as a whole page does, have none.
    """
    for name in value.split():
        for part in name.split("--")[0].split("__"):
            words = [w for w in re.split(r"[^a-z0-9]+", part) if w and not w.isdigit()]
            if words and not (len(words) > 1 and words[-1] in ("page", "main")):
                yield frozenset(words)


def _lines(page: str, forms: bool = True) -> tuple[list[tuple[str, int, int]], list[int]]:
    """Lines as (text, weight, mark), empty lines at every gap, and each line's container.

    The mark is 0 outside a marked article, else 1 for an article and 2 for the main part of the page; there
    linked text weighs too, but for list items.
    """
    lines: list[tuple[str, int, int]] = []
    parents: list[int] = []
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    containers = 0
    parts: list[str] = []
    linked = links = lists = 0
    within = {"article": 0, "main": 0}
    skip, depth, at = "", 0, 0

    def mark() -> int:
        return 2 if within["main"] else min(within["article"], 1)

    def end_line() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            lines.append((text, len(text) if mark() and not lists else max(len(text) - linked, 0), mark()))
            parents.append(stack[-1][1] if stack else 0)
        parts.clear()
        linked = 0

    def gap() -> None:
        end_line()
        if lines and lines[-1][0]:
            lines.extend([("", 0, mark())] * WINDOW)
            parents.extend([-1] * WINDOW)

    for token in TOKEN.finditer(page):
        if token.start() > at and not skip:
            text = page[at : token.start()]
            parts.append(text)
            linked += len(text) if links else 0
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            if token["raw"] and not skip:
                parts.append(" ")
            continue
        ends = bool(token["end"])
        if skip:
            if tag in ("article", "main") and not ends and not _beside(tag, token["more"], False, forms):
                skip = ""  # an unclosed element before the text
            elif tag == skip:
                depth += -1 if ends else 0 if skip in SELF_CLOSING else 1
                if depth == 0 or skip in SELF_CLOSING and not ends:
                    skip = ""
                if ends or skip:
                    continue
            elif skip in SELF_CLOSING and tag in BLOCKS:
                skip = ""
            else:
                continue
        if not ends and tag not in EMPTY and _beside(tag, token["more"], mark() > 0, forms):
            gap()
            skip, depth = tag, 1
            continue
        if tag == "a":
            links = 0 if ends else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCKS:
            end_line()
            links = 0
            if tag in CONTAINERS and not ends:
                containers += 1
                stack.append((tag, containers))
                opened[tag] += 1
            elif ends and opened[tag]:
                closed = ""
                while closed != tag:
                    closed = stack.pop()[0]
                    opened[closed] -= 1
            if tag in within:
                within[tag] = max(within[tag] - 1, 0) if ends else within[tag] + 1
            elif tag in ("ul", "ol"):
                lists = max(lists - 1, 0) if ends else lists + 1
    if not skip:
        parts.append(page[at:])
    end_line()
    return lines, parents


def _joined(found: list[tuple[int, int]], parents: list[int]) -> list[int]:
    """The first candidate of those that each candidate shares a container with."""
    group, first = list(range(len(found))), {}

    def top(k: int) -> int:
        while group[k] != k:
            group[k] = group[group[k]]
            k = group[k]
        return k

    for k, (a, b) in enumerate(found):
        for parent in set(parents[a:b]) - {-1}:
            one, other = sorted((top(k), top(first.setdefault(parent, k))))
            group[other] = one
    return [top(k) for k in range(len(found))]


def main_text(page: str) -> str:
    lines, parents = _lines(page)
    if "<form" in page.lower():
        plain = _lines(page, forms=False)
        if 2 * sum(weight for _, weight, _ in lines) < sum(weight for _, weight, _ in plain[0]):
            lines, parents = plain  # forms hold most of the text
    marked = max((mark for text, _, mark in lines if text), default=0)
    lines = [line if line[2] >= marked else ("", 0, 0) for line in lines]
    weights = [weight for _, weight, _ in lines]
    if marked and not any(weights):
        weights = [len(text) for text, _, _ in lines]  # an article of links alone
    total = list(accumulate(weights, initial=0))
    texts = list(accumulate((bool(text) for text, _, _ in lines), initial=0))
    stops = [min(i + WINDOW, len(lines)) for i in range(len(lines))]
    flat = [texts[j] - texts[i] == WINDOW and total[j] == total[i] for i, j in enumerate(stops)]
    found: list[tuple[int, int]] = []  # surge and dive of each candidate
    surge = -1
    for i, (text, _, _) in enumerate(lines):
        held = bool(text) and not any(flat[max(i - WINDOW + 1, 0) : i + 1])
        if held and surge < 0:
            surge = i
        elif not held and surge >= 0:
            found.append((surge, i))
            surge = -1
    if surge >= 0:
        found.append((surge, len(lines)))
    if not marked and found:
        mass: Counter[int] = Counter()
        group = _joined(found, parents)
        for (a, b), g in zip(found, group):
            mass[g] += total[b] - total[a]
        most = max(mass.values())
        found = [f for f, g in zip(found, group) if mass[g] > 0 and mass[g] >= MIN_SHARE * most]
    return "\n\n".join(text for a, b in found for text, _, _ in lines[a:b] if text)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = pc.fill_null(batch.column(1), "").to_pylist()
        text = pa.array([main_text(p) for p in pages], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), text], names=["row", "text"])


def extract_text(pages: DataFrame, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all but the page) of every row as struct `row`, and its main `text`.

    White space inside a block becomes one space, character references are decoded, blocks are joined by
    an empty line. A missing or empty page, or one without text, gives an empty text; markup that is cut
    off or never closed ends with the page. Repeated rows are treated alike.
    """
    keep = keep or [c for c in pages.columns if c != html_column]
    rows = pages.select(F.struct(*keep).alias("row"), F.col(html_column).cast("string").alias("html"))
    kinds = rows.schema["row"].dataType.fields
    schema = f"row struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in kinds)}>, text string"
    return map_arrow(rows, _extract, schema)
