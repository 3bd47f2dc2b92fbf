"""Values taken out of landed web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LINK_TEXT = r"<li><a[^>]*>([^<]*)</a>"
TITLE = r"<title>([^<]*)</title>"


def link_texts(pages: DataFrame, html: Column, wanted: str, *keep: str, pattern: str = LINK_TEXT) -> DataFrame:
    """One row per link text that starts with the ``wanted`` pattern."""
    texts = pages.select(*keep, F.explode(F.regexp_extract_all(html, F.lit(pattern), F.lit(1))).alias("link_text"))
    return texts.where(F.col("link_text").rlike(f"^(?:{wanted})"))


def labelled_value(html: Column, pattern: str = TITLE) -> Column:
    """The first value a page shows under a pattern; null when the page has none."""
    return F.when(html.rlike(pattern), F.regexp_extract(html, pattern, 1))
