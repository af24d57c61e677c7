"""Line dedup by site-relative frequency.

The pages of a site that hold a line, divided by the pages of the site, say how much
of a boilerplate the line is. Pages that are near copies of each other (the components
of ``minhash``) count once, so a page that was copied many times, also with small edits,
does not turn into boilerplate. Lines above ``ratio`` that
stand on at least ``min_pages`` pages of the site are dropped from all of its pages.
Lines are compared without the white space around them; lines without a word stay.

Scale: only hashes (site, page, 128-bit line) are shuffled, copies combined map-side,
first by all three and then counted by site and line, so neither a line that stands on
a third of all pages nor a page copied as often gathers in one task. Near copies are
looked for once, over all sites; only hashes of pages are joined to their groups. A site has at most
(lines of a page on average) / ``ratio`` boilerplate lines; they travel as one array per
site, broadcast if they are few and joined by shuffle otherwise, where adaptive
execution splits a hot site. Texts are cleaned where they are read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.llm import minhash
from gridtide.operators.sizes import broadcast_if_small
from gridtide.session import materialize, settled

RATIO = 0.01
MIN_PAGES = 5
# Boilerplate lines that are broadcast at most (some 16 MB), beyond it sites are joined by a shuffle.
SMALL_LINES = 500_000
# Pages with another page's group that are broadcast at most (16 MB).
SMALL_PAGES = 1_000_000

_BLANKS = " \t\x0b\x0c\r"


def _core(line: Column) -> Column:
    """A line without the white space around it. Most lines have none, and trimming given characters looks at all of the line."""
    ends = [end for blank in _BLANKS for end in (line.startswith(blank), line.endswith(blank))]
    return F.when(reduce(or_, ends), F.trim(line, F.lit(_BLANKS))).otherwise(line)


def _key(core: Column) -> Column:
    """128-bit hash of a trimmed line."""
    return F.md5(core.cast("binary"))


def _site(site: Column) -> Column:
    # NULL is a site of its own; the mark keeps it apart from any text.
    return F.coalesce(F.concat(F.lit("="), site.cast("string")), F.lit(""))


def _near_groups(texts: DataFrame) -> DataFrame:
    """(page, group) of the pages, given as (page, text), that are not the first of their group of near copies."""
    def build() -> DataFrame:
        found = minhash.near_duplicates(texts, "page").filter(F.col("component_id") != F.col("page"))
        return found.select("page", F.col("component_id").alias("group")).distinct()

    return broadcast_if_small(settled(texts.sparkSession, build), SMALL_PAGES)


def _as_one(pages: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct ``pages`` with the group, where there is one, in place of the page."""
    return pages.join(groups, "page", "left").withColumn("page", F.coalesce("group", "page")).drop("group").distinct()


def boilerplate_lines(
    docs: DataFrame, site_col: str, text_col: str, ratio: float = RATIO, min_pages: int = MIN_PAGES, near_as_one: bool = True
) -> DataFrame:
    """(site, line_key, pages, site_pages) of the lines above the ratio."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    pages = docs.select(_site(F.col(site_col)).alias("site"), F.xxhash64(text, F.length(text)).alias("page"), text.alias("text"))
    distinct = pages.select("site", "page").distinct()
    lines = pages.select("site", "page", F.explode(F.split("text", "\n")).alias("line"))
    cores = lines.select("site", "page", _core(F.col("line")).alias("core")).filter(F.col("core") != "")
    once = cores.select("site", "page", F.unhex(_key(F.col("core"))).alias("line_key")).distinct()
    if near_as_one:
        groups = _near_groups(pages.select("page", "text"))
        distinct, once = _as_one(distinct, groups), _as_one(once, groups)
    sizes = distinct.groupBy("site").agg(F.count(F.lit(1)).alias("site_pages"))
    counted = once.groupBy("site", "line_key").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)
    return counted.join(sizes, "site").filter(F.col("pages") > ratio * F.col("site_pages")).select(
        "site", F.lower(F.hex("line_key")).alias("line_key"), "pages", "site_pages"
    )


def drop_boilerplate(
    docs: DataFrame,
    site_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    near_as_one: bool = True,
) -> DataFrame:
    """All columns and rows of ``docs`` with ``text_col`` cleaned, and n_lines, n_dropped.

    A NULL text stays NULL and counts as one empty line. A page whose lines all go
    has an empty text. Sites that are NULL form one site. Each row is a page,
    repeated rows too, but near copies in a site count once; with ``near_as_one`` off only
    equal pages do. Columns named n_lines or n_dropped are replaced. An empty table gives
    an empty result.
    """
    found = materialize(boilerplate_lines(docs, site_col, text_col, ratio, min_pages, near_as_one).select("site", "line_key"))
    by_site = found.groupBy("site").agg(F.collect_set("line_key").alias("bad"))
    if found.count() <= SMALL_LINES:
        by_site = F.broadcast(by_site)
    # The row travels as one column, so its names cannot clash with those used here.
    pages = docs.select(F.struct("*").alias("row"), _site(F.col(site_col)).alias("site"))
    pages = pages.join(by_site, "site", "left").withColumn("lines", F.split(F.col(f"row.{text_col}"), "\n"))
    # An empty line's key is not among the bad ones.
    pages = pages.withColumn("left", F.when(F.col("bad").isNull(), F.col("lines")).otherwise(F.filter(
        "lines", lambda x: ~F.array_contains("bad", _key(_core(x)))
    )))
    return pages.select(
        *[
            (F.array_join("left", "\n") if c == text_col else F.col(f"row.`{c}`")).alias(c)
            for c in docs.columns if c not in ("n_lines", "n_dropped")
        ],
        F.coalesce(F.size("lines"), F.lit(1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("left"), F.lit(0)).cast("long").alias("n_dropped"),
    )
