"""Line dedup by site-relative frequency, with DataFrame functions only.

A line that stands on more than a given share of a host's pages is boilerplate of that host and is
dropped from its pages. The lines of a page are counted once each, so the counts of one host cannot name
more than (lines per page / share) lines; that bounded list is what comes back to the pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paywatch.operators.skew import join_lookup
from paywatch.session import Scratch

MAX_SHARE = 0.3
MIN_PAGES = 5

HOST = "^(?i:[a-z][a-z0-9+.-]*:)?//([^/?#]*)"
HIDDEN = "(?is)<(script|style|head|noscript|template)\\b[^>]*>.*?</(script|style|head|noscript|template)\\s*>|<!--.*?-->"
BREAK = "(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|nav|article|section|header|footer|aside|main|form|blockquote|pre|body|html|dt|dd|dl)\\b[^>]*>"
SPACE = "[ \\t\\x0B\\f\\r]+"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def host_of(url: Column) -> Column:
    """Host of an address in lower case; an address without one is its own empty host."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def text_lines(html: Column) -> Column:
    """The text of a page as trimmed, non-empty lines: every block tag and line feed ends a line."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    text = F.regexp_replace(F.regexp_replace(text, BREAK, "\n"), "<[^>]*>", "")
    for name, value in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(value))
    lines = F.transform(F.split(F.regexp_replace(text, SPACE, " "), "\n"), lambda line: F.trim(line))
    return F.filter(lines, lambda line: line != "")


def _mark(line: Column) -> Column:
    """96 bits that stand for a line within its host."""
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def drop_boilerplate(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    max_share: float = MAX_SHARE,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Every page with its host and remaining lines: key, host, text, n_lines, n_dropped.

    A line is dropped from all pages of a host when more than `max_share` of them have it; hosts of fewer
    than `min_pages` pages keep all lines, as a share says nothing there. Repeats of a line inside a page count
    once. A missing address or one without host counts as one host without name, a missing page has no
    lines. Repeated rows are pages of their own; an empty table gives an empty result.
    """
    scratch = Scratch(pages.sparkSession, "lines")
    lined = scratch.write(
        pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), text_lines(F.col(html)).alias("lines")), "lines"
    )
    totals = lined.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    marks = F.array_distinct(F.transform("lines", _mark))
    seen = lined.select("host", F.explode(marks).alias("mark")).groupBy("host", "mark").agg(F.count(F.lit(1)).alias("having"))
    common = (
        seen.where(F.col("having") >= max_share * min_pages)  # what any line over the share reaches; most lines stand on one page
        .join(totals, "host")
        .where(F.col("having") / F.col("pages") > max_share)
        .groupBy("host")
        .agg(F.collect_list("mark").alias("common"))  # at most lines per page / max_share
    )
    common, counted = scratch.write_with(common, "common", hosts=F.count(F.lit(1)), marks=F.sum(F.size("common")))
    # the bound of a broadcast holds for hosts and marks together
    rows = join_lookup(lined, common, ["host"], lookup_rows=counted["hosts"] + (counted["marks"] or 0))
    kept = F.when(F.col("common").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.array_contains("common", _mark(line)))
    )
    return rows.withColumn("_kept", kept).select(
        F.col("key").alias(key),
        "host",
        F.array_join("_kept", "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("_kept")).cast("long").alias("n_dropped"),
    )
