"""How many pages of a domain two indexes have: (domain, language, count_google, count_commoncrawl)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Labels of the two counted columns.
INDEX_NAMES = {"count_google": "Google", "count_commoncrawl": "Commoncrawl"}
MEAN_NAMES = {"google": "Google", "cc": "Common Crawl"}


def coverage_means(counts: DataFrame) -> DataFrame:
    """Mean count per language and index, and the first as a percentage of the second."""
    means = counts.groupBy("language").agg(
        F.avg("count_google").alias("google"), F.avg("count_commoncrawl").alias("cc")
    )
    return means.withColumn("difference", F.try_divide(100 * F.col("google"), F.col("cc")))


def coverage_unpivot(counts: DataFrame) -> DataFrame:
    """(domain, language, crawl, n): one row per index instead of one column."""
    long = counts.unpivot(["domain", "language"], list(INDEX_NAMES), "column", "n")
    label = F.when(F.col("column") == "count_google", INDEX_NAMES["count_google"]).otherwise(
        INDEX_NAMES["count_commoncrawl"]
    )
    return long.select("domain", "language", label.alias("crawl"), "n")


def means_unpivot(means: DataFrame) -> DataFrame:
    """(language, index, count): the means with one row per index."""
    long = means.unpivot(["language"], list(MEAN_NAMES), "column", "count")
    label = F.when(F.col("column") == "google", MEAN_NAMES["google"]).otherwise(MEAN_NAMES["cc"])
    return long.select("language", label.alias("index"), "count")


def coverage_total(means: DataFrame) -> DataFrame:
    """The means and a `total` row with their sums; `difference` is now a plain ratio."""
    rows = means.select("language", "google", "cc")
    total = rows.agg(
        F.lit("total").alias("language"), F.sum("google").alias("google"), F.sum("cc").alias("cc")
    )
    return rows.unionByName(total).withColumn("difference", F.try_divide("google", "cc"))
