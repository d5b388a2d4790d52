"""Fetched pages in buckets of their URL's hash, so that a batch of URLs reads the files it needs and no others."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lingmill.operators.ranking import first_per_key

#: Buckets that a store may have: a batch names those it needs one by one.
MOST_BITS = 16


def url_bucket(url: Column, bits: int) -> Column:
    """The first `bits` bits of the URL's hash."""
    return F.shiftrightunsigned(F.xxhash64(url), 64 - bits).cast("int") if bits else F.lit(0)


@dataclass(frozen=True)
class PageStore:
    """A folder of Parquet, one sub-folder per bucket, rows in order of the URL's hash with small row groups and a Bloom filter
    on the URL: whoever looks for one URL reads one row group of one file.

    `bits` is the logarithm of the number of buckets. It is fixed when the store is made: the whole store
    divided by the buckets should be some row groups.
    """

    spark: SparkSession
    folder: str
    bits: int

    @classmethod
    def create(cls, pages: DataFrame, folder: str, bits: int = 10, row_group: int = 16 << 20) -> PageStore:
        """Write `pages` (url, html, status, other columns). Of repeated URLs the row with the least status and html stays.

        Pages without a URL cannot be looked up and are left out.
        """
        if not 0 <= bits <= MOST_BITS:
            raise ValueError(f"bits must be 0 to {MOST_BITS}")
        named = pages.filter(F.col("url").isNotNull())
        rest = [c for c in named.columns if c not in ("url", "status", "html")]
        order = F.struct("status", "html", *(F.to_json(F.struct(F.col(c))) for c in rest))
        once = first_per_key(named.withColumn("_order", order), "url", "_order").drop("_order")
        placed = once.withColumns({"bucket": url_bucket(F.col("url"), bits), "url_hash": F.xxhash64("url")})
        (
            placed.repartition("bucket")
            .sortWithinPartitions("bucket", "url_hash")
            .write.mode("overwrite")
            .option("parquet.block.size", row_group)
            .option("parquet.bloom.filter.enabled#url", True)
            .partitionBy("bucket")
            .parquet(folder)
        )
        return cls(pages.sparkSession, folder, bits)

    def pages(self) -> DataFrame:
        return self.spark.read.parquet(self.folder).drop("bucket", "url_hash")

    def lookup(self, batch: DataFrame) -> DataFrame:
        """The stored pages of the URLs in `batch`, each once, however often the batch names it.

        The numbers of the buckets that the batch falls into (as many as the store has at most) become a filter on
        the folders, so the files of other buckets are not opened; the hash narrows the row groups.
        """
        wanted = batch.select("url").filter(F.col("url").isNotNull()).distinct()
        wanted = wanted.select("url", url_bucket(F.col("url"), self.bits).alias("bucket"), F.xxhash64("url").alias("url_hash"))
        met = wanted.groupBy("bucket").agg(F.min("url_hash").alias("low"), F.max("url_hash").alias("high")).collect()
        stored = self.spark.read.parquet(self.folder).filter(F.col("bucket").isin([r["bucket"] for r in met]))
        if met:
            stored = stored.filter(F.col("url_hash").between(min(r["low"] for r in met), max(r["high"] for r in met)))
        return stored.join(wanted, ["bucket", "url_hash", "url"], "left_semi").drop("bucket", "url_hash")
