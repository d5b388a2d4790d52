"""Fetched pages: scan, status, content type, headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.registry import query
from lingmill.operators import fetch


@query(
    """
SELECT url, CAST(status AS BIGINT) AS status,
  coalesce(status >= 200 AND status < 300, false) AS body_kept,
  coalesce(status, -1) BETWEEN 200 AND 300 AS parsed
FROM x_raw
"""
)
def fetch_status_filter(spark, sf):
    return src.raw_pages(spark, sf).select(
        "url",
        F.col("status").cast("bigint").alias("status"),
        fetch.is_success(F.col("status")).alias("body_kept"),
        fetch.passes_parse_gate(F.col("status")).alias("parsed"),
    )


@query(
    """
SELECT url, CASE WHEN starts_with(lower(content_type), 'text/html') THEN 'html'
                 WHEN starts_with(lower(content_type), 'application/pdf') THEN 'pdf' END AS kind
FROM x_raw
"""
)
def content_type_filter(spark, sf):
    pages = fetch.normalize_headers(src.raw_pages(spark, sf))
    accept = {"text/html": "html", "application/pdf": "pdf"}
    return pages.select("url", fetch.content_kind(F.col("headers"), accept).alias("kind"))


@query(
    """
SELECT url, 'server' AS name, lower(server) AS value FROM x_raw
UNION ALL SELECT url, 'content-type', lower(content_type) FROM x_raw WHERE content_type IS NOT NULL
"""
)
def headers_normalize(spark, sf):
    pages = fetch.normalize_headers(src.raw_pages(spark, sf))
    return pages.select("url", F.explode("headers").alias("name", "value"))


@query(
    """
SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, count(*) AS pages,
  count(CASE WHEN status >= 200 AND status < 300 AND starts_with(lower(content_type), 'text/html') THEN 1 END) AS with_html
FROM x_raw GROUP BY 1
"""
)
def pages_with_html(spark, sf):
    from lingmill.functions import urls

    pages = fetch.fetch_results(src.raw_pages(spark, sf))
    return fetch.pages_with_html(pages.withColumn("host", urls.netloc(F.col("url"))), "host")
