"""From raw documents to token ids: quality rules, near-duplicates, personal data, mixing, pieces.

Every stage takes (spark, docs, sf_dir) and works on all rows of `docs`. All but the last return the columns of
the documents; the last returns the id, the token ids and their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingmill.llm import line_quality, mixing, pieces, pii, queries, simhash
from lingmill.llm.common import table
from lingmill.sources.shared import run_folder



def _with_length(docs: DataFrame) -> DataFrame:
    """`n_chars` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not depleted, without their hosts' frequent lines."""
    return _with_length(line_quality.clean_lines_and_keep(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles link within two bits: the one with the smallest id."""
    return simhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return _with_length(pii.masked(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of the labelled domains ask for."""
    return mixing.mixed(docs, queries.labelled_domains(spark, sf_dir), queries.TARGETS, options=queries.MIXING)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return pieces.encode(docs, pieces.PieceModel.load(queries.PIECES))


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mix),
    ("pieces", encode),
]

#: Fingerprints, regular expressions with checksums, a fitted classifier and a segmentation are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        folder = run_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
