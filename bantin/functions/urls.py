"""Links: absolute form, article key and listing page address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bantin.catalogue import IMAGE_HOSTS, LINK_HOSTS, LISTING_SUFFIX, MOBILE_HOSTS
from bantin.functions.columns import as_column, case_of

# Journals whose listing links may already be absolute; the rest always get the host.
_KEEPS_ABSOLUTE = ["vietnamnet"]
# Journals that only take site-relative links from a listing.
RELATIVE_ONLY = ["vtc", "phapluatdoisong"]


def absolute_url(journal, href) -> Column:
    """Put the journal's host before a listing link."""
    link = as_column(href)
    branches = []
    for name, host in LINK_HOSTS.items():
        prefixed = F.concat(F.lit(host), link)
        if name in MOBILE_HOSTS:
            prefixed = F.concat(F.lit(host), F.replace(link, F.lit(MOBILE_HOSTS[name]), F.lit("")))
        elif name in _KEEPS_ABSOLUTE:
            prefixed = F.when(link.contains(host), link).otherwise(prefixed)
        branches.append(([name], prefixed))
    return case_of(journal, branches, otherwise=link)


def absolute_image_url(journal, src) -> Column:
    """Put the journal's image host before an address that names no host."""
    link = as_column(src)
    hosted = case_of(
        journal, [([name], F.concat(F.lit(host), link)) for name, host in IMAGE_HOSTS.items()], otherwise=link
    )
    return F.when(link.contains("http"), link).otherwise(hosted)


def article_key(journal, url) -> Column:
    """journal + `_` + the path segment that names the article, cut at its first dot."""
    link = as_column(url)
    last = F.split_part(link, F.lit("/"), F.lit(-1))
    before_last = F.split_part(link, F.lit("/"), F.lit(-2))
    first_dot = lambda c: F.split_part(c, F.lit("."), F.lit(1))
    segment = case_of(journal, [
        (["saigontimes"], first_dot(before_last)),
        (["nhipcaudautu"], before_last),
    ], otherwise=first_dot(last))
    return F.concat(as_column(journal), F.lit("_"), segment)


def listing_url(journal, section_url, page) -> Column:
    """Address of listing page `page` of a section."""
    section, number = as_column(section_url), as_column(page).cast("string")
    branches = []
    for name, suffix in LISTING_SUFFIX.items():
        head, tail = suffix.split("{n}")
        address = F.concat(section, F.lit(head), number, F.lit(tail))
        if name == "diendandoanhnghiep":
            address = F.when(as_column(page) == 1, F.concat(section, F.lit("/"))).otherwise(address)
        branches.append(([name], address))
    return case_of(journal, branches)


def keep_link(journal, href, section_url=None) -> Column:
    """Whether a listing link is taken: never empty; relative or in-section where the site asks it."""
    link = as_column(href)
    host_of = {name: LINK_HOSTS[name] for name in RELATIVE_ONLY}
    branches = [([name], ~link.contains(host)) for name, host in host_of.items()]
    if section_url is not None:
        branches.append((["laodong"], link.contains(as_column(section_url))))
    return F.coalesce(link != "", F.lit(False)) & case_of(journal, branches, otherwise=F.lit(True))
