"""WARC response records built as plain string columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CRLF = "\r\n"


def _base32(hex_digest: Column) -> Column:
    """RFC 4648 base-32 form of a SHA-1 digest given in hex: five hex digits make four letters."""
    groups = [
        F.lpad(F.conv(F.substring(hex_digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(
        F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def _record_id(*parts: Column) -> Column:
    """A name-based id: a task that runs twice writes the same record twice, not two records."""
    h = F.md5(F.concat_ws("\n", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def warc_records(pages: DataFrame, warc_date: str) -> DataFrame:
    """(target_uri, record): one response record per page with a body.

    The status line is always `HTTP/1.0 200 OK`. `warc_date` is an ISO time in UTC, like
    `2025-01-31T12:00:00Z`. Headers are written in order of their names.
    """
    headers = F.array_join(
        F.transform(
            F.array_sort(F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>")))),
            lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit(_CRLF)),
        ),
        "",
    )
    block = F.concat(F.lit("HTTP/1.0 200 OK" + _CRLF), headers, F.lit(_CRLF), F.col("html"))
    digest = _base32(F.sha1(F.col("html").cast("binary")))
    lines = [
        F.lit("WARC/1.0"),
        F.lit("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("url"), F.lit(warc_date), digest)),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.lit("WARC-Date: " + warc_date),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return pages.filter(F.col("html").isNotNull()).select(
        F.col("url").alias("target_uri"),
        F.concat(F.concat_ws(_CRLF, *lines), F.lit(_CRLF + _CRLF), block).alias("record"),
    )
