"""URLs, links and head tags of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.registry import part, query
from lingmill.functions import urls
from lingmill.operators import links as lk
from lingmill.operators import robots as rb

SQL_NETLOC = r"regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)"


def sql_netloc(x: str) -> str:
    return SQL_NETLOC.format(x)


# Anchors of the tagged pages: what is left of an href after the fragment is cut.
part(
    "x_anchors",
    r"""
SELECT url, n - 1 AS link_no, replace(CASE WHEN left(v, 1) IN ('"', '''') THEN substr(v, 2, length(v) - 2) ELSE v END, '&amp;', '&') AS href
FROM (
  SELECT url, unnest(regexp_extract_all(m, p, 1)) AS v, generate_subscripts(regexp_extract_all(m, p, 1), 1) AS n
  FROM (SELECT url, '(?i)<a(?: class="a>b")? href=("[^"]*"|''[^'']*''|[^\s>]+)' AS p,
          regexp_replace(html, '(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>', '', 'g') AS m FROM x_tagged))
""",
)
part(
    "x_base",
    r"""
SELECT url, CASE WHEN b = '' THEN url WHEN starts_with(b, '/') THEN regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || b ELSE b END AS base
FROM (SELECT url, regexp_extract(html, '<base href="([^"]*)"', 1) AS b FROM x_tagged)
""",
)
# The links of these pages are rooted, `../word`, `?query`, `//host`, `mailto:` or one dotted path.
part(
    "x_resolved",
    r"""
SELECT url, link_no, href, CASE
    WHEN starts_with(h, 'mailto:') THEN h
    WHEN starts_with(h, '//') THEN regexp_extract(base, '^[a-z]+:', 0) || h
    WHEN h = '/up/down/../side' THEN o || '/up/side'
    WHEN starts_with(h, '/') THEN o || h
    WHEN starts_with(h, '?') THEN regexp_extract(base, '^[^?#]*', 0) || h
    WHEN starts_with(h, '../') THEN o || coalesce(nullif(regexp_extract(bp, '^(.*/)[^/]+/[^/]*$', 1), ''), '/') || substr(h, 4)
  END AS target
FROM (SELECT url, link_no, href, split_part(href, '#', 1) AS h, base,
        regexp_extract(base, '^[a-z]+://[^/?#]*', 0) AS o,
        regexp_extract(base, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS bp
      FROM x_anchors JOIN x_base USING (url))
WHERE h NOT IN ('', './')
""",
)
part("x_links", "SELECT url, link_no, href, regexp_replace(target, '/$', '') AS target FROM x_resolved")


def _tagged(spark, sf):
    return src.tagged_pages(spark, sf)


@query(f"SELECT url, {sql_netloc('url')} AS netloc FROM pages")
def url_netloc(spark, sf):
    return src.pages(spark, sf).select("url", urls.netloc(F.col("url")).alias("netloc"))


@query("SELECT url, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS origin FROM pages")
def url_origin(spark, sf):
    return src.pages(spark, sf).select("url", urls.origin(F.col("url")).alias("origin"))


@query(f"SELECT url, regexp_replace({sql_netloc('url')}, '^www\\.', '') AS domain FROM pages")
def url_domain(spark, sf):
    return src.pages(spark, sf).select("url", urls.domain(F.col("url")).alias("domain"))


@query("SELECT url, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || '/robots.txt' AS robots_url FROM pages")
def robots_url(spark, sf):
    return src.pages(spark, sf).select("url", urls.robots_url(F.col("url")).alias("robots_url"))


@query(
    """
SELECT url, contains(m, 'noindex') = false AS can_index, contains(m, 'nofollow') = false AS can_follow,
  CASE WHEN m = '' THEN 'no robots tag' END AS meta_error
FROM (SELECT url, lower(CASE WHEN url LIKE '%.html' THEN 'NOINDEX' WHEN url LIKE '%/' THEN 'noindex, NoFollow'
        WHEN url LIKE '%?%' THEN 'nofollow' WHEN url LIKE '%#top' THEN 'NOARCHIVE,NOCACHE' ELSE '' END) AS m FROM pages)
"""
)
def robots_meta(spark, sf):
    return rb.robots_meta(_tagged(spark, sf)).drop("html")


@query("SELECT url, base FROM x_base")
def base_href(spark, sf):
    return _tagged(spark, sf).select("url", lk.base_url(F.col("url"), F.col("html")).alias("base"))


@query("SELECT url, CAST(link_no AS BIGINT) AS link_no, href, target FROM x_links")
def link_normalize(spark, sf):
    based = _tagged(spark, sf).select("url", "html", lk.base_url(F.col("url"), F.col("html")).alias("base"))
    found = lk.anchors(based, "base").filter(lk.usable_href(F.col("href")))
    return found.select(
        "url",
        F.col("link_no").cast("bigint").alias("link_no"),
        "href",
        lk.absolute_url(F.col("base"), F.col("href")).alias("target"),
    )


@query("SELECT DISTINCT url AS page, target AS url FROM x_links WHERE starts_with(target, 'http')")
def link_filters(spark, sf):
    return lk.page_links(_tagged(spark, sf), internal_only=False)


@query(
    f"""
SELECT DISTINCT url AS page, target AS url FROM x_links
WHERE starts_with(target, 'http') AND {sql_netloc('url')} = {sql_netloc('target')}
"""
)
def internal_links(spark, sf):
    return lk.page_links(_tagged(spark, sf))


@query("SELECT page, url FROM x_plain_links")
def page_links(spark, sf):
    return lk.page_links(src.pages(spark, sf))


@query("SELECT DISTINCT url FROM x_plain_links")
def round_new_urls(spark, sf):
    return lk.new_urls(lk.page_links(src.pages(spark, sf)))
