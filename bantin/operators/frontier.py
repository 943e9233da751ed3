"""Which listing pages and links to visit next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bantin.functions.urls import listing_url
from bantin.sources.workspace import materialise

# Journals whose sections end at a listing page with one link, and at a repeated page.
ENDS_AT_SINGLE_LINK = ["baodautu", "saigontimes"]
ENDS_AT_REPEAT = ["vtc", "phapluatdoisong", "laodong"]

# Listing pages are looked at in runs of this many pages, so that one long section is
# shared out over many tasks.
_RUN = 1_000


def page_frontier(sections: DataFrame, start: str = "start", end: str = "end", cap: int | None = None) -> DataFrame:
    """Listing pages of each section from `start` up to, not including, `end`.

    `end` 0 or NULL means open-ended; the caller then gives `cap`, the number of pages to plan.
    """
    open_ended = F.col(end).isNull() | (F.col(end) == 0)
    if cap is None:
        unbounded = F.raise_error(F.lit("an open-ended frontier needs a cap")).cast("long")
    else:
        unbounded = F.col(start).cast("long") + F.lit(cap)
    last = F.when(open_ended, unbounded).otherwise(F.col(end).cast("long"))
    first = F.col(start).cast("long")
    pages = F.when(last > first, F.sequence(first, last - 1))
    kept = [c for c in sections.columns if c not in (start, end)]
    return sections.select(*kept, F.explode(pages).alias("page")).withColumn(
        "listing_url", listing_url("journal", "section_url", "page")
    )


def distinct_links(links: DataFrame) -> DataFrame:
    """Each link of a page once; `links` holds (page_id, pos, href)."""
    return links.groupBy("page_id", "href").agg(F.min("pos").alias("pos"))


def unseen_links(links: DataFrame, seen: DataFrame, url: str = "url") -> DataFrame:
    """Links not seen before, each once, with the least row among its copies.

    Copies are reduced in every task before the shuffle, so a link that stands on a third of
    all pages costs one row per task.
    """
    rest = [c for c in links.columns if c != url]
    if rest:
        once = links.groupBy(url).agg(F.min(F.struct(*rest)).alias("_first")).select(url, "_first.*")
    else:
        once = links.distinct()
    return once.join(seen.select(url).distinct(), url, "left_anti")


def with_previous_page(listings: DataFrame, section: str = "section", page: str = "page", urls: str = "urls") -> DataFrame:
    """Add the page before each page of its section: `prev_page`, `prev_urls`.

    Runs of 1000 pages are ordered on their own; the first page of a run takes the last page
    of the run before it from a table with one row per run.
    """
    run = F.floor(F.col(page) / _RUN)
    rows = listings.withColumn("_run", run)
    inside = W.partitionBy(section, "_run").orderBy(page)
    rows = rows.withColumns({"prev_page": F.lag(page).over(inside), "prev_urls": F.lag(urls).over(inside)})
    ends = rows.groupBy(section, "_run").agg(
        F.max(F.struct(F.col(page).alias("page"), F.col(urls).alias("urls"))).alias("_end")
    )
    before = ends.select(section, "_run", F.lag("_end").over(W.partitionBy(section).orderBy("_run")).alias("_before"))
    joined = rows.join(before, [section, "_run"], "left")
    is_first = F.col("prev_page").isNull()
    return joined.select(
        *listings.columns,
        F.when(is_first, F.col("_before.page")).otherwise(F.col("prev_page")).alias("prev_page"),
        F.when(is_first, F.col("_before.urls")).otherwise(F.col("prev_urls")).alias("prev_urls"),
    )


def stop_at_repeat(
    listings: DataFrame,
    section: str = "section",
    page: str = "page",
    urls: str = "urls",
    journal: str | None = None,
    min_links: int = 1,
    gap_ends: bool = False,
) -> DataFrame:
    """The pages a crawl visits: it ends at a page that is empty or repeats the page before.

    `min_links=2` also ends at a page with a single link. With a `journal` column the site's
    own rule is used instead: some sites watch for repeats, some for single links. With
    `gap_ends` a page that could not be fetched (a missing number) ends the section as well.
    """
    # One aggregate per run of pages holds its first and last page and its earliest stop; then the runs of
    # a section are passed over, each with the last page of the run before it.
    fields = [F.col(page).alias("page"), F.col(urls).alias("urls")]
    if journal is not None:
        fields.append(F.col(journal).alias("journal"))
    pages = listings.select(F.col(section).alias("_section"), F.floor(F.col(page) / _RUN).alias("_run"), F.struct(*fields).alias("_at"))
    inside = W.partitionBy("_section", "_run").orderBy("_at.page")

    def stop(at: str, before: str) -> Column:
        links = F.coalesce(F.size(f"{at}.urls"), F.lit(0))
        repeats = F.coalesce(F.col(f"{at}.urls") == F.col(f"{before}.urls"), F.lit(False))
        if journal is None:
            found = (links < min_links) | repeats
        else:
            found = (
                (links < 1)
                | (F.col(f"{at}.journal").isin(*ENDS_AT_SINGLE_LINK) & (links < 2))
                | (F.col(f"{at}.journal").isin(*ENDS_AT_REPEAT) & repeats)
            )
        if gap_ends:
            found = found | F.coalesce(F.col(f"{at}.page") > F.col(f"{before}.page") + 1, F.lit(False))
        return F.when(found, F.col(f"{at}.page"))

    runs = pages.withColumn("_before", F.lag("_at").over(inside)).groupBy("_section", "_run").agg(
        F.min(stop("_at", "_before")).alias("_stop"), F.min("_at").alias("_first"), F.max("_at").alias("_last")
    )
    in_section = W.partitionBy("_section").orderBy("_run")
    met = runs.withColumn("_ended", F.lag("_last").over(in_section))
    ends = met.groupBy("_section").agg(F.min(F.least("_stop", stop("_first", "_ended"))).alias("_stop"))
    # Stored, so that Spark knows its size: small, it is broadcast; large, a long section's join is split.
    ends = materialise(ends.where(F.col("_stop").isNotNull()))
    return (
        listings.join(ends, F.col(section) == F.col("_section"), "left")
        .where(F.col("_stop").isNull() | (F.col(page) < F.col("_stop")))
        .drop("_section", "_stop")
    )
