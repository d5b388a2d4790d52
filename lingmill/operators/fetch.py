"""What is kept of fetched pages. Row-local: no shuffle in any of these."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill.functions.bind import bind

ACCEPTED = {"text/html": "html"}


def normalize_headers(pages: DataFrame) -> DataFrame:
    """Header names and values in lower case. Of names equal but for case the last wins."""
    lowered = F.transform(
        F.map_entries("headers"),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), F.lower(e["value"]).alias("value")),
    )

    def last_of_each(all_of_them: Column) -> Column:
        names = F.transform(all_of_them, lambda e: e["key"])
        return bind(
            names,
            lambda ns: F.filter(
                all_of_them, lambda e, i: ~F.array_contains(F.slice(ns, i + 2, F.size(ns)), e["key"])
            ),
        )

    return pages.withColumn("headers", F.map_from_entries(bind(lowered, last_of_each)))


def is_success(status: Column) -> Column:
    """The body of a page is kept for these."""
    return F.coalesce((status >= 200) & (status < 300), F.lit(False))


def passes_parse_gate(status: Column) -> Column:
    """The parser looks at these; a missing status does not pass, 300 does."""
    return F.coalesce(status, F.lit(-1)).between(200, 300)


def content_kind(headers: Column, accept: Mapping[str, str] = ACCEPTED) -> Column:
    """Kind of body by the prefix of the content type; NULL if it is not accepted or not given.

    If several prefixes fit, the one listed last decides.
    """
    content_type = F.try_element_at(headers, F.lit("content-type"))
    kind = F.lit(None).cast("string")
    for prefix, name in accept.items():
        kind = F.when(F.startswith(content_type, F.lit(prefix)), name).otherwise(kind)
    return kind


def fetch_results(pages: DataFrame, accept: Mapping[str, str] = ACCEPTED) -> DataFrame:
    """Fetched pages as they are stored: headers and body only where status and type allow."""
    pages = normalize_headers(pages)
    ok = is_success(F.col("status"))
    is_html = F.coalesce(content_kind(F.col("headers"), accept) == "html", F.lit(False))
    return pages.withColumns(
        {
            "headers": F.when(ok, F.col("headers")),
            "html": F.when(ok & is_html, F.col("html")),
        }
    )


def pages_with_html(pages: DataFrame, *by: str) -> DataFrame:
    """Number of pages and of those with a body, in all or per group."""
    return pages.groupBy(*by).agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("html").isNotNull()).alias("with_html"),
    )


def parseable(pages: DataFrame) -> DataFrame:
    """Pages that the parser takes: right status, non-empty body."""
    return pages.filter(passes_parse_gate(F.col("status")) & (F.length("html") > 0))
