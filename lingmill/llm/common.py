"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """ARRAY of the words of a text; none for NULL."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANKS))


def text_key(text: Column) -> tuple[Column, Column]:
    """Two independent hashes that together stand for a whole text (96 bits); NULL has its own."""
    return F.xxhash64(text, F.lit(1)), F.hash(text, F.lit(2))
