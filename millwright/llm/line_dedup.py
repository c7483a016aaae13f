"""Line dedup by site-relative frequency.

A line that a large share of a site's pages has is boilerplate of that site: the
number of pages that contain it, divided by the pages of the site, is above a
ratio.  Lines are counted by (site, 128-bit digest), once per page, summed on the
map side first, so that neither a line that every page has nor a site that holds
most pages gathers in one task.  The lines of a site above the ratio are fewer
than (lines per page) / ratio; they are one array per site and meet the pages in a
join of the sites, which is a broadcast as long as that table's files are below
Spark's threshold, and else a sort-merge join whose hot sites Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.sources.scratch import materialize

LINE_BREAK = "\n"
RATIO = 0.05
MIN_PAGES = 5
WHOLE_PAGE_SHARE = 0.9


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate(
    docs: DataFrame, text: str = "text", site: str = "source",
    ratio: float = RATIO, min_pages: int = MIN_PAGES,
) -> DataFrame:
    """(site, lines): digests of the lines on more than ``ratio`` of the site's pages.

    A line must be on ``min_pages`` pages at least.  A line that a page repeats
    counts once; blank lines never count.  Null sites are one site; null texts are
    pages without lines.
    """
    pages = docs.groupBy(F.col(site).alias("site")).agg(F.count("*").alias("pages"))
    lines = F.array_distinct(F.filter(F.split(F.col(text), LINE_BREAK, -1), _has_word))
    found = docs.select(F.col(site).alias("line_site"), F.explode(F.transform(lines, _digest)).alias("line")).groupBy(
        "line_site", "line").agg(F.count("*").alias("found")).where(F.col("found") >= min_pages)
    return found.join(pages, F.col("line_site").eqNullSafe(F.col("site"))).where(
        F.col("found") > ratio * F.col("pages")
    ).groupBy("site").agg(F.collect_set("line").alias("lines"))


def line_dedup(
    docs: DataFrame, text: str = "text", site: str = "source", ratio: float = RATIO,
    min_pages: int = MIN_PAGES, whole_page_share: float = WHOLE_PAGE_SHARE,
) -> DataFrame:
    """``docs`` without boilerplate lines, and two counts: n_lines, n_removed (long).

    Lines are what ``\\n`` separates; the others keep their order and text.  A page
    with more than ``whole_page_share`` of its characters in such lines is one of
    many copies of a page, not a page with a banner: it stays as it is, and is the
    business of document dedup.  A null text stays null with 0 lines; an empty one
    is one blank line, and one of any length is cut into its lines by the task that has
    it.  Repeated rows are pages each.  Columns called n_lines or
    n_removed are replaced.
    """
    known = materialize(boilerplate(docs, text, site, ratio, min_pages), "line-boilerplate")
    known = known.select(F.col("site").alias("__line_site"), F.col("lines").alias("__line_known"))
    joined = docs.join(known, F.col(site).eqNullSafe(F.col("__line_site")), "left")
    split = F.split(F.col(text), LINE_BREAK, -1)
    own = F.transform(F.filter(split, _has_word), _digest)
    hit = F.coalesce(F.array_intersect(own, F.col("__line_known")), F.array())
    parts = joined.withColumn("__line_hit", F.when(F.col("__line_known").isNotNull(), hit))
    some = F.size("__line_hit") > 0
    kept = F.filter(split, lambda line: ~(_has_word(line) & F.array_contains(F.col("__line_hit"), _digest(line))))
    parts = parts.withColumn("__line_kept", F.when(some, kept))
    rest = F.aggregate("__line_kept", F.lit(0), lambda n, line: n + F.length(line))
    whole = F.length(F.replace(F.col(text), F.lit(LINE_BREAK), F.lit("")))
    cut = F.coalesce(some & (rest >= (1 - whole_page_share) * whole), F.lit(False))
    parts = parts.withColumn("__line_cut", cut)
    n_lines = F.greatest(F.size(split), F.lit(0)).cast("long")
    n_removed = F.when(F.col("__line_cut"), F.size(split) - F.size("__line_kept")).otherwise(0).cast("long")
    new_text = F.when(F.col("__line_cut"), F.array_join("__line_kept", LINE_BREAK)).otherwise(F.col(text))
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return parts.select(
        *[new_text.alias(c) if c == text else F.col(c) for c in names],
        F.coalesce(n_lines, F.lit(0).cast("long")).alias("n_lines"), n_removed.alias("n_removed"))
