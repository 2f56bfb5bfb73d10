"""Landed news search responses as article rows, and the keyword list behind the search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, names, text, urls

ITEMS = "struct<items: array<struct<title: string, originallink: string, link: string, description: string, pubDate: string>>>"


def news_articles(landed: DataFrame, *, body: str, keyword: str) -> DataFrame:
    """One row per item of a JSON response.

    The publisher's link is preferred; the domain is taken from it alone. Titles and descriptions
    lose tags and entities; the hash is over link and cleaned title.
    """
    items = landed.select(F.col(keyword).alias("keyword_matched"), F.explode(F.from_json(body, ITEMS)["items"]).alias("i"))
    original = F.coalesce(F.col("i.originallink"), F.lit(""))
    rows = items.select(
        names.first_filled(original, F.col("i.link"), default="").alias("url"),
        text.clean_html(F.col("i.title")).alias("title_ko"),
        text.clean_html(F.col("i.description")).alias("description"),
        F.coalesce(dates.mail_date(F.col("i.pubDate")).cast("string"), F.lit("")).alias("published_date"),
        urls.host(original).alias("source_domain"),
        "keyword_matched",
    )
    return rows.select(
        "url",
        "title_ko",
        "description",
        "published_date",
        urls.host(F.col("url")).alias("source_name"),
        "source_domain",
        text.content_hash(F.col("url"), F.col("title_ko")).alias("content_hash"),
        "keyword_matched",
    )


def keywords(table: DataFrame, default: Sequence[str], *, term: str = "term", limit: int | None = None) -> DataFrame:
    """Non-blank terms of the table, else the default list; optionally only the first ``limit``."""
    terms = table.select(names.blank_to_null(F.col(term)).alias("term")).filter("term is not null")
    if terms.isEmpty():
        terms = table.sparkSession.createDataFrame([(k,) for k in default], "term string")
    return terms if limit is None else terms.limit(limit)
