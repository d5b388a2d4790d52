"""From segment lines to the finished corpus and its statistics, at once or round by round.

Round by round the corpus is a log: every round adds the lines that it has first, in buckets of their hash, and their
sums. A new round's lines are compared with the stored lines of the buckets that they fall into, and with no others;
the statistics of the corpus are the sums of the rounds' statistics. The entry in `progress` is a round's last write, so a
round that died counts for nothing and is done again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingmill.operators import dataset as ds
from lingmill.sources import readers, schemas, writers

#: Logarithm of the number of buckets that a corpus has if nothing else is said.
_BITS = 8
_STATS = "language STRING, script STRING, words BIGINT, characters BIGINT, sentences BIGINT"


def build_dataset(
    spark: SparkSession,
    input_folder: str,
    output_folder: str,
    languages: Iterable[str] | str | None = None,
    max_rows: int = 500_000,
) -> DataFrame:
    """Read the text folders of a crawl, write the dataset and `stats.csv`; returns the statistics.

    The statistics read the written dataset, so the dedup shuffle runs once.
    """
    if languages is not None:
        languages = ds.clean_targets(languages)
    segments = readers.segment_files(spark, input_folder, languages)
    return write_corpus(ds.dataset_dedup(segments), output_folder, max_rows)


def build_from_rounds(
    spark: SparkSession,
    segments_folder: str,
    output_folder: str,
    languages: Iterable[str] | str | None = None,
    max_rows: int = 500_000,
) -> DataFrame:
    """The same from the segment folder of crawl rounds; labels that are not listed are not read."""
    segments = readers.round_segments(spark, segments_folder)
    if languages is not None:
        segments = segments.filter(F.col("label").isin(ds.clean_targets(languages)))
    return write_corpus(ds.dataset_dedup(ds.with_label_parts(segments, "label")), output_folder, max_rows)


def write_corpus(corpus: DataFrame, output_folder: str, max_rows: int = 500_000) -> DataFrame:
    spark = corpus.sparkSession
    writers.write_dataset(corpus, f"{output_folder}/dataset", max_rows)
    stats = ds.corpus_stats(readers.dataset(spark, f"{output_folder}/dataset"))
    writers.write_stats(stats, f"{output_folder}/stats.csv")
    return stats


def _finished(spark: SparkSession, folder: str) -> dict[int, int]:
    """{round: bits} of the rounds that are in the corpus."""
    try:
        rows = spark.read.schema("finished INT, bits INT").parquet(f"{folder}/progress").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["finished"]: r["bits"] for r in rows}


def _lines(spark: SparkSession, folder: str, rounds: Iterable[int]) -> DataFrame:
    """Lines of these rounds, with the columns `round` and `bucket` that their folders have."""
    rounds, schema = list(rounds), f"{schemas.DATASET_ROW}, round INT, bucket INT"
    if not rounds:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/lines").filter(F.col("round").isin(rounds))


def merge_round(spark: SparkSession, segments: DataFrame, folder: str, round_no: int, bits: int = _BITS) -> int:
    """Add the lines of a round (text, language, script) that the corpus does not have yet; how many they are.

    A round that is in the corpus already adds nothing. Work and writing follow the round: of the stored lines only
    the buckets of the round's own lines are read. `bits` is fixed by the first round. Copies within the round and lines
    that are stored go in one grouping, so a line is dealt out once to be compared; `segments` is read twice (first
    for its buckets only) and best a stored table.
    """
    done = _finished(spark, folder)
    if round_no in done:
        return 0
    bits = next(iter(done.values()), bits)
    bucket = F.pmod(F.xxhash64("text", "language", "script"), F.lit(1 << bits)).cast("int")
    line = ("text", "language", "script")
    new = segments.select(*line)
    if done:
        touched = [r["bucket"] for r in new.select(bucket.alias("bucket")).distinct().collect()]
        old = _lines(spark, folder, done).filter(F.col("bucket").isin(touched))
        both = new.withColumn("_old", F.lit(False)).unionByName(old.select(*line, F.lit(True).alias("_old")))
        # grouping takes NULL for equal to NULL, as the corpus does
        new = both.groupBy(*line).agg(F.max("_old").alias("_old")).filter(~F.col("_old")).drop("_old")
    else:
        new = ds.dataset_dedup(new)
    path = f"{folder}/lines/round={round_no}"
    new.withColumn("bucket", bucket).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    added = spark.read.schema(f"{schemas.DATASET_ROW}, bucket INT").parquet(path)
    ds.corpus_stats(added).write.mode("overwrite").parquet(f"{folder}/sums/round={round_no}")
    n = added.count()
    spark.createDataFrame([(round_no, bits)], "finished INT, bits INT").write.mode("overwrite").parquet(f"{folder}/progress/round={round_no}")
    return n


def merged_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """(text, language, script): every line of the merged rounds once."""
    return _lines(spark, folder, _finished(spark, folder)).select("text", "language", "script")


def merged_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of the merged rounds, from their sums alone: no line is read."""
    done = list(_finished(spark, folder))
    if not done:
        return spark.createDataFrame([], _STATS)
    sums = spark.read.schema(_STATS).parquet(*(f"{folder}/sums/round={r}" for r in done))
    return sums.groupBy("language", "script").agg(*(F.sum(c).alias(c) for c in ("words", "characters", "sentences")))
