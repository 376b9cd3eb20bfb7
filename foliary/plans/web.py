"""Web pages to documents: canonical address, Markdown, title, heading order, anchors, hash, identifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.functions.ids import content_sha256, document_id, job_id
from foliary.functions.text import chunk_anchors, chunk_count, heading_verdict, headings, with_title_h1
from foliary.functions.urls import dedup_key
from foliary.sources.html import html_to_markdown


def web_documents(pages: DataFrame, source: str = "web_crawl:pages") -> DataFrame:
    """One document per page of (page_id, url, html): everything but the HTML tree is native, and nothing is shuffled."""
    job = job_id(F.lit(source))
    decoded = pages.select("page_id", "url", dedup_key(F.col("url")).alias("canonical_url"), html_to_markdown("html").alias("markdown"))
    titled = decoded.withColumn("title", F.coalesce(F.get(headings(F.col("markdown")), F.lit(0))["text"], F.col("canonical_url")))
    body = titled.withColumn("body", with_title_h1(F.col("markdown"), F.col("title")))
    anchored = body.withColumn("body", F.concat(chunk_anchors(F.col("body")), F.lit("\n")))
    return anchored.select(
        "page_id",
        "canonical_url",
        "title",
        "body",
        content_sha256(F.col("body")).alias("content_sha256"),
        document_id(job, F.col("canonical_url"), F.col("page_id")).alias("document_id"),
        chunk_count(F.col("body")).alias("chunks"),
        heading_verdict(F.col("body")).alias("heading_verdict"),
    )


def drop_repeated_pages(pages: DataFrame) -> DataFrame:
    """One page per canonical address, that of the smallest id."""
    keep = pages.groupBy(dedup_key(F.col("url")).alias("k")).agg(F.min("page_id").alias("page_id")).select("page_id")
    return pages.join(keep, "page_id", "left_semi")
