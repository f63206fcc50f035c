"""Story books (XML) and web pages as texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import _col, html_text, html_title, strip


def story_pages(xml: Column | str) -> Column:
    """``array<struct<page_no,type_id,text>>`` of a book: each page's first state text.

    Every page is cut out and parsed on its own, so a page without text stays in its place.
    """
    pages = F.regexp_extract_all(_col(xml), F.lit(r"(?s)<page\b.*?</page>"), F.lit(0))
    return F.transform(
        pages,
        lambda p, i: F.struct(
            (i + 1).alias("page_no"),
            F.xpath_string(p, F.lit("/page/@type_id")).alias("type_id"),
            strip(F.xpath_string(p, F.lit("(/page/state/text)[1]"))).alias("text"),
        ),
    )


def story_text(pages: Column | str) -> Column:
    """Pages joined by line breaks, paragraph marks to line breaks, empty lines closed up.

    Works on a book's page array, so a shelf of books needs no grouping.
    """
    lines = F.concat(F.array_join(F.transform(_col(pages), lambda p: p["text"]), "\n"), F.lit("\n"))
    plain = F.replace(F.replace(lines, F.lit("<p>"), F.lit("")), F.lit("</p>"), F.lit("\n"))
    return strip(F.regexp_replace(plain, r"\n+", "\n"))


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """(file, xml): one row per book file."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("xml"))


def read_story(spark: SparkSession, path: str) -> DataFrame:
    """(file, page_no, type_id, text), one row per page."""
    return read_books(spark, path).select("file", F.inline(story_pages("xml")))


def read_story_text(spark: SparkSession, path: str) -> DataFrame:
    """(file, text), one row per book."""
    return read_books(spark, path).select("file", story_text(story_pages("xml")).alias("text"))


def page_texts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Stored web pages with title and visible text instead of markup."""
    return pages.select(
        *[c for c in pages.columns if c != html],
        html_title(html).alias("title"),
        html_text(html).alias("text"),
    )
