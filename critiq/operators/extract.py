"""Extraction from raw pages and the page frontier.

Page fields are narrow (row-local regular expressions); blocks and their fields are
found by nesting depth (``operators/markup.py``), with one shuffle of the pages; the
page grouping of A18/X9 is a hash aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from critiq.functions import html as H
from critiq.operators.markup import Element, ReviewMarkup, attribute, blocks, field_text, reviews, text_of
from critiq.sources.tables import LISTING

WS = r"[ \t\r\n]+"


def _clean(c):
    return F.trim(F.regexp_replace(F.regexp_replace(c, H.TAG_PATTERN, " "), WS, " "))


def page_fields(pages: DataFrame) -> DataFrame:
    """S7 + X4 on generic pages: host, language, title, heading, counts, article text."""
    html = F.col("html")
    article = F.regexp_extract(html, r"(?s)<article>(.*?)</article>", 1)
    text = _clean(article)
    return pages.select(
        "page_id",
        F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1).alias("host"),
        F.regexp_extract(html, r'<html lang="([a-z]+)"', 1).alias("lang"),
        _clean(F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1)).alias("title"),
        _clean(F.regexp_extract(html, r"(?s)<h1>(.*?)</h1>", 1)).alias("h1"),
        F.regexp_count(html, F.lit("<a href=")).cast("bigint").alias("n_links"),
        F.regexp_count(article, F.lit("<p>")).cast("bigint").alias("n_paragraphs"),
        F.regexp_count(html, F.lit('class="ad"')).cast("bigint").alias("n_ads"),
        text.alias("article_text"),
        F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, " "))).cast("bigint").alias("n_words"),
    )


def extract_reviews(pages: DataFrame, page_col: str = "page", markup: ReviewMarkup | None = None, dealt: bool = False) -> DataFrame:
    """One row per review block of each listing page, by nesting depth."""
    found = reviews(pages, [*LISTING, page_col], "umbrella_item", markup, dealt)
    return found.withColumns({c: F.col(c).try_cast("bigint") for c in ("user_id", "review_item")})


def navigation_blocks(pages: DataFrame) -> DataFrame:
    """The list blocks of any page: a row per ``li`` of each ``ul``, with its first link, the text and how many tags it holds."""
    rows = blocks(pages, ["page_id"], Element(("ul",)), Element(("li",)), {"link": Element(("a",))})
    found = rows.groupBy("page_id", "container", "block").agg(
        F.min(F.when((F.col("name") == "a") & (F.col("step") == 1), F.struct("pos", attribute("href").alias("v"))))["v"].alias("href"),
        field_text("link").alias("link_text"), F.count(F.lit(1)).alias("n_tags"))
    place = F.row_number().over(Window.partitionBy("page_id").orderBy("block"))
    return found.select("page_id", place.cast("bigint").alias("block_no"), "href", "link_text", "n_tags")


def paragraphs(pages: DataFrame) -> DataFrame:
    """The paragraphs of each page's articles in order, whether or not their end tags are there."""
    rows = blocks(pages, ["page_id"], Element(("article",)), Element(("p",)), {})
    found = rows.groupBy("page_id", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("t"))
    place = F.row_number().over(Window.partitionBy("page_id").orderBy("block"))
    return found.select("page_id", place.cast("bigint").alias("paragraph_no"),
                        text_of(F.array_join(F.transform("t", lambda x: x["text"]), " ")).alias("text"))


def page_frontier(catalog: DataFrame, page_size: int = 10, max_pages: int = 1999) -> DataFrame:
    """X8 + F8: one row per listing page to fetch; listings without reviews are skipped."""
    n_pages = F.least(F.lit(max_pages).cast("bigint"), F.ceil(F.col("num_reviews") / page_size))
    pages = catalog.filter(F.col("num_reviews") > 0).select(
        "publisher", "version", "item", F.explode(F.sequence(F.lit(1).cast("bigint"), n_pages)).alias("page"))
    return pages.withColumn("url", H.frontier_url(F.col("item"), F.col("page")))


def page_counts(reviews: DataFrame, page_col: str = "page") -> DataFrame:
    """Records per (listing, page)."""
    return reviews.groupBy(*LISTING, page_col).agg(F.count(F.lit(1)).alias("n_records"))


def short_page_stop(counts: DataFrame, page_size: int = 10, page_col: str = "page") -> DataFrame:
    """Keep each listing's pages up to and including its first page with < page_size records."""
    first_short = (counts.filter(F.col("n_records") < page_size)
                   .groupBy(*LISTING).agg(F.min(page_col).alias("_stop")))
    return (counts.join(first_short, LISTING, "left")
            .filter(F.col("_stop").isNull() | (F.col(page_col) <= F.col("_stop")))
            .drop("_stop"))
