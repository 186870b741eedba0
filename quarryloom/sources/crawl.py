"""A crawl over fetched pages: links of pages are followed breadth first, within one site and up to a depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryloom.functions.text import url_authority
from quarryloom.runtime import cut

#: Links of HTML (``href="..."``) and Markdown (``](...)``).
LINK = r"""(?:href\s*=\s*["']?|\]\()([^"'\s)>]+)"""


def page_links(pages: DataFrame) -> DataFrame:
    """``url, link`` of every link of pages (``url, html``), each once: resolved against the page's site, without fragments.

    Mail and script links and those relative to a folder go.
    """
    found = pages.where(F.col("html").isNotNull()).select("url", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("href"))
    site = F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    bare = F.regexp_replace("href", r"#.*$", "")
    link = F.when(bare.rlike(r"^https?://"), bare).when(bare.startswith("//"), F.concat(F.regexp_extract("url", r"^(\w+:)", 1), bare)).when(bare.startswith("/"), F.concat(site, bare))
    return found.select("url", link.alias("link")).where(F.col("link").isNotNull()).distinct()


def crawl(pages: DataFrame, starts: DataFrame, depth: int = 2, pattern: str | None = None) -> DataFrame:
    """``url, depth``: the start URLs (column ``url``) and what is reached from them in at most ``depth`` links.

    Only links to the linking page's own authority that fit ``pattern`` (a regular expression; none = all) are followed;
    each URL comes once, with its least depth. Pages that weren't fetched are reached, but lead nowhere.
    """
    links = page_links(pages)
    inside = url_authority(F.col("link")) == url_authority(F.col("url"))
    edges = cut(links.where(inside if pattern is None else inside & F.col("link").rlike(pattern)))
    seen = cut(starts.where(F.col("url").isNotNull()).select("url").distinct().withColumn("depth", F.lit(0)))
    frontier = seen
    for level in range(1, depth + 1):
        new = edges.join(frontier.select("url"), "url").select(F.col("link").alias("url")).distinct().join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(level))
        frontier = cut(new)
        seen = seen.unionByName(frontier)
    return seen


def site_url(host: Column, path: Column) -> Column:
    return F.concat(F.lit("https://docs."), host, F.lit(".example/"), path)
