"""The order of result pages by their next links, for URLs that do not tell it.

Every page has at most one next page and keeps at most one page before it, so pages form chains, and
cycles where no page is the first. The place in a chain is found by pointer doubling: each round
a page looks at the page it points back to and takes over that one's pointer, so a chain of n pages
takes about log2(n) joins. No two pages ever point to the same one, so no join key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstream.operators.extract import NEXT_LINK
from gleanstream.session import run_dir

_STATE = "url string, back string, far bigint, head string, done boolean"


def next_url(html: Column, url: Column, pattern: str = NEXT_LINK) -> Column:
    """Where a page's next link leads, as a whole URL; NULL without one.

    Of links relative to the page, those by host path (``/a``) and by query (``?a``) are resolved;
    any other is taken below the page's folder.
    """
    tag = F.regexp_extract(html, rf"{pattern}[^>]*>", 0)
    link = F.replace(F.regexp_extract(tag, r"""\bhref=["']([^"']*)["']""", 1), F.lit("&amp;"), F.lit("&"))
    site = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(url, r"^([^?#]*)", 1)
    folder = F.concat(site, F.regexp_extract(F.substr(page, F.length(site) + 1), r"^(.*/)", 1))
    return F.when(link != "", F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), link)
                  .when(link.startswith("//"), F.concat(F.regexp_extract(site, r"^([^/]*)", 1), link))
                  .when(link.startswith("/"), F.concat(site, link))
                  .when(link.startswith("?"), F.concat(page, link))
                  .when(folder == site, F.concat(site, F.lit("/"), link))
                  .otherwise(F.concat(folder, link)))


def _pages(links: DataFrame) -> DataFrame:
    """One row a URL: the page before it, and how many pages link to it."""
    known = links.where("url IS NOT NULL").groupBy("url").agg(F.min("next_url").alias("next_url"))
    before = known.where("next_url <> url").groupBy(F.col("next_url").alias("url")).agg(
        F.min("url").alias("back"), F.count(F.lit(1)).alias("linked_by"))
    return known.select("url").join(before, "url", "left")


def page_order(links: DataFrame) -> DataFrame:
    """Place of every page in its chain: ``url, head, ordinal, linked_by, in_cycle``.

    ``links`` has ``url`` and ``next_url``. ``head`` is the first page of the chain and ``ordinal`` the
    number of pages before. ``linked_by`` above 1 tells of a fork: of several pages with the same
    next one, the least URL goes before it, the others end their chains there. Pages of a cycle that
    nothing leads into have no head and no ordinal. A link to the page itself, and one to a page
    that is not there, is none. A URL seen several times is one page with its least next link; rows
    without a URL are no pages. Other columns are ignored; an empty table gives an empty one.
    """
    spark, root = links.sparkSession, run_dir(links.sparkSession, "page-order")

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    pages = kept(_pages(links.select("url", "next_url")), "pages")
    first = F.col("back").isNull()
    state = pages.select(
        "url", "back", F.when(first, 0).otherwise(1).cast("bigint").alias("far"),
        F.when(first, F.col("url")).alias("head"), first.alias("done"))
    placed, open_pages = state.where("done"), state.where("NOT done")
    number = 0
    while True:
        # a page and its distance to the page it points to, and the same of that page
        target = placed.unionByName(open_pages).select(
            F.col("url").alias("back"), F.col("back").alias("back2"), F.col("far").alias("far2"),
            F.col("head").alias("head2"), F.col("done").alias("done2"))
        moved = open_pages.select("url", "back", "far").join(target, "back").select(
            "url", F.col("back2").alias("back"), (F.col("far") + F.col("far2")).alias("far"),
            F.col("head2").alias("head"), F.col("done2").alias("done"))
        number += 1
        moved.write.partitionBy("done").parquet(f"{root}/round={number}")
        round_rows = spark.read.schema(_STATE).parquet(f"{root}/round={number}")
        new = round_rows.where("done")
        if new.isEmpty():  # chains have a page to place in every round, so what is open goes in circles
            break
        placed, open_pages = placed.unionByName(new), round_rows.where("NOT done")
    return pages.join(placed.select("url", "head", F.col("far").alias("ordinal")), "url", "left").select(
        "url", "head", "ordinal", F.coalesce("linked_by", F.lit(0)).alias("linked_by"),
        F.col("head").isNull().alias("in_cycle"))


def linked_captures(captures: DataFrame, pattern: str = NEXT_LINK) -> DataFrame:
    """Captures with ``ordinal``, their page's place by the next links; NULL in a cycle or without a URL.

    Only URLs and links are shuffled to find it; the pages themselves are joined once.
    """
    links = captures.select("url", next_url(F.col("html"), F.col("url"), pattern).alias("next_url"))
    places = page_order(links).select(F.col("url").alias("_url"), "ordinal")
    # captures without a URL match nothing; a key of their own keeps them out of one task
    key = F.coalesce("url", F.concat(F.lit("\0"), F.xxhash64("html").cast("string")))
    return captures.join(places, key == F.col("_url"), "left").drop("_url")
