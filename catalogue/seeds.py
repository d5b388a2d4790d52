"""Seed lists from a crawl index, and coverage of two indexes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.registry import part, query
from lingmill.functions import tags, urls
from lingmill.operators import coverage as cv
from lingmill.operators import seeds as sd
from lingmill.sources import readers, schemas, writers
from lingmill.sources.shared import run_folder


def _languages(spark):
    return spark.createDataFrame(src.INDEX_LANGUAGES, schemas.LANGUAGE_ROW)


@query("SELECT url, url_host_registered_domain, content_languages FROM x_index")
def seed_index_scan(spark, sf):
    """Written as CSV with header and scanned again."""
    folder = run_folder(spark, "index")
    src.index_rows(spark, sf).drop("row_id").write.option("header", True).csv(folder)
    return readers.crawl_index(spark, folder)


@query("SELECT row_id, url, url_host_registered_domain, content_languages FROM x_index WHERE content_languages IN ('deu', 'spa')")
def seed_index_filter(spark, sf):
    return sd.index_filter(src.index_rows(spark, sf), ["deu", "spa", "deu"])


@query(
    """
SELECT url, content_languages || '_Latn' AS lang_script FROM x_index
WHERE content_languages IN ('eng', 'deu', 'fra') AND row_id % 2 = 1 AND row_id % 3 = 0
"""
)
def seed_index_stored(spark, sf):
    """The index of two crawls with three subsets each, stored, then one subset of one crawl in the table's languages."""
    folder = run_folder(spark, "index")
    crawl = F.concat(F.lit("crawl-"), (F.col("row_id") % 2).cast("string"))
    subset = F.element_at(F.array(*map(F.lit, ("warc", "robotstxt", "crawldiagnostics"))), (F.col("row_id") % 3 + 1).cast("int"))
    rows = src.index_rows(spark, sf).select("url", "url_host_registered_domain", "content_languages", crawl.alias("crawl"), subset.alias("subset"))
    writers.write_index(rows, folder)
    index = readers.stored_index(spark, folder)
    return sd.index_of_languages(index, _languages(spark), subset="warc", crawl="crawl-1").select("url", "lang_script")


@query(
    """
SELECT row_id, url, url_host_registered_domain, content_languages
FROM x_index_copies QUALIFY row_number() OVER (PARTITION BY url ORDER BY row_id) = 1
"""
)
def seed_url_dedup(spark, sf):
    return sd.url_dedup(src.index_copies(spark, sf), "row_id")


@query("SELECT content_languages AS language, count(*) AS n FROM x_index GROUP BY 1")
def urls_per_language(spark, sf):
    return sd.urls_per_language(src.index_rows(spark, sf))


@query(
    """
SELECT content_languages AS language, count(*) AS n
FROM (SELECT content_languages FROM x_index
      QUALIFY row_number() OVER (PARTITION BY url_host_registered_domain ORDER BY row_id) = 1)
GROUP BY 1
"""
)
def domains_per_language(spark, sf):
    return sd.domains_per_language(src.index_rows(spark, sf), "row_id")


@query("SELECT url, content_languages || '_Latn' AS lang_script FROM x_index WHERE content_languages IN ('eng', 'deu', 'fra')")
def language_scripts(spark, sf):
    return sd.with_scripts(src.index_rows(spark, sf), _languages(spark)).select("url", "lang_script")


@query("SELECT content_languages AS language, count(*) AS n FROM x_index WHERE content_languages = 'spa' GROUP BY 1")
def unmapped_languages(spark, sf):
    return sd.unmapped_languages(src.index_rows(spark, sf), _languages(spark))


@query(
    """
SELECT url, content_languages || '_Latn' AS lang_script
FROM (SELECT url, content_languages FROM x_index_copies QUALIFY row_number() OVER (PARTITION BY url ORDER BY row_id) = 1)
WHERE content_languages <> 'spa'
"""
)
def seed_lists(spark, sf):
    """The whole seed job up to its per-language files."""
    return sd.seed_urls(src.index_copies(spark, sf), _languages(spark), "row_id")


# Coverage: pages of a host stand for one index, links on them for the other.
part(
    "x_coverage",
    r"""
SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS language,
  count(*) AS count_google, CAST(sum(len(regexp_extract_all(html, '<a href="'))) AS BIGINT) AS count_commoncrawl
FROM pages GROUP BY 1, 2
""",
)
part(
    "x_means",
    "SELECT language, avg(count_google) AS google, avg(count_commoncrawl) AS cc FROM x_coverage GROUP BY language",
)


def _coverage(spark, sf):
    return (
        src.pages(spark, sf)
        .select(
            urls.netloc(F.col("url")).alias("domain"),
            tags.html_lang(F.col("html")).alias("language"),
            F.size(tags.hrefs(F.col("html"))).alias("n_links"),
        )
        .groupBy("domain", "language")
        .agg(F.count(F.lit(1)).alias("count_google"), F.sum("n_links").alias("count_commoncrawl"))
    )


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("SELECT domain, language, count_google, count_commoncrawl FROM x_coverage")
def coverage_scan(spark, sf):
    """Written as CSV with a nameless index column in front, and scanned again."""
    folder = run_folder(spark, "coverage")
    rows = _coverage(spark, sf).withColumn("Unnamed: 0", F.length("domain"))
    rows.select("Unnamed: 0", "domain", "language", "count_google", "count_commoncrawl").write.option(
        "header", True
    ).csv(folder)
    return readers.coverage_counts(spark, folder)


@query("SELECT language, round(google, 6) AS google, round(cc, 6) AS cc, round(100 * google / cc, 6) AS difference FROM x_means")
def coverage_means(spark, sf):
    return _rounded(cv.coverage_means(_coverage(spark, sf)), "google", "cc", "difference")


@query(
    """
SELECT domain, language, 'Google' AS crawl, count_google AS n FROM x_coverage
UNION ALL SELECT domain, language, 'Commoncrawl', count_commoncrawl FROM x_coverage
"""
)
def coverage_unpivot(spark, sf):
    return cv.coverage_unpivot(_coverage(spark, sf))


@query(
    """
SELECT language, 'Google' AS "index", round(google, 6) AS count FROM x_means
UNION ALL SELECT language, 'Common Crawl', round(cc, 6) FROM x_means
"""
)
def coverage_means_unpivot(spark, sf):
    return _rounded(cv.means_unpivot(cv.coverage_means(_coverage(spark, sf))), "count")


@query(
    """
SELECT language, round(google, 6) AS google, round(cc, 6) AS cc, round(google / cc, 6) AS difference
FROM (SELECT language, google, cc FROM x_means UNION ALL SELECT 'total', sum(google), sum(cc) FROM x_means)
"""
)
def coverage_total(spark, sf):
    return _rounded(cv.coverage_total(cv.coverage_means(_coverage(spark, sf))), "google", "cc", "difference")
