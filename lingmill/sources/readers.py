"""Readers of the files a crawl leaves behind."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingmill.sources import schemas


def raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of fetched pages, gz or plain; broken lines are dropped."""
    return (
        spark.read.schema(schemas.RAW_PAGE)
        .option("mode", "DROPMALFORMED")
        .json(path)
        .select("url", "status", "headers", "html", "error")
    )


def checked_pages(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of fetched pages with `line` and `problem`: nothing is dropped.

    `problem` is NULL for a page that can be parsed, else the first of: broken line, no url, fetch failed, no status,
    status not accepted, no html. `line` is the text of a broken line.
    """
    rows = spark.read.schema(f"{schemas.RAW_PAGE}, line STRING").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "line").json(path)
    problem = (
        F.when(F.col("line").isNotNull(), "broken line")
        .when(F.coalesce("url", F.lit("")) == "", "no url")
        .when(F.col("error").isNotNull(), "fetch failed")
        .when(F.col("status").isNull(), "no status")
        .when(~F.col("status").between(200, 300), "status not accepted")
        .when(F.coalesce("html", F.lit("")) == "", "no html")
    )
    return rows.withColumn("problem", problem)


def problem_counts(checked: DataFrame) -> DataFrame:
    """(problem, n), the pages without one under `none`."""
    return checked.groupBy(F.coalesce("problem", F.lit("none")).alias("problem")).agg(F.count(F.lit(1)).alias("n"))


def parsed_pages(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of parsed pages below `<label>/parsed/`; the label comes from the path.

    Unreadable files are skipped. A `path` without such folders gives an empty label.
    """
    return (
        spark.read.schema(schemas.PARSED_PAGE)
        .option("mode", "DROPMALFORMED")
        .option("ignoreCorruptFiles", True)
        .option("recursiveFileLookup", True)
        .json(path)
        .withColumn("label", F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)/parsed/", 1))
    )


def parsed_pages_by_label(spark: SparkSession, path: str) -> DataFrame:
    """Parsed pages that were written with one folder per label, rows without a label among them."""
    return spark.read.schema(f"{schemas.PARSED_PAGE}, label STRING").json(path)


def url_list(spark: SparkSession, path: str | None = None, seed_url: str | None = None) -> DataFrame:
    """Seed URLs, one per line, gz or plain, blanks dropped; a single `seed_url` wins."""
    if seed_url is not None:
        return spark.createDataFrame([(seed_url.strip(),)], schemas.SEEN)
    return clean_url_list(spark.read.text(path).withColumnRenamed("value", "url"))


def clean_url_list(urls: DataFrame, col: str = "url") -> DataFrame:
    """Trim URLs and drop blank ones."""
    trimmed = F.regexp_replace(F.col(col), r"^\s+|\s+$|[\r\n]", "")
    return urls.withColumn(col, trimmed).filter(F.col(col) != "")


def segment_files(spark: SparkSession, path: str, languages: Iterable[str] | None = None) -> DataFrame:
    """Text lines below `<language>_<script>/textual_outputs/`; the label comes from the folder.

    With `languages` only those folders are listed, so others are never opened.
    """
    if languages is None:
        paths = [f"{path}/*/textual_outputs"]
    else:
        paths = [f"{path}/{label.strip()}/textual_outputs" for label in dict.fromkeys(languages)]
    label = F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)_([^/_]+)/textual_outputs/", 0)
    parts = F.split(F.regexp_extract(label, "/([^/]+)/textual", 1), "_")
    return spark.read.text(paths).select(
        F.col("value").alias("text"),
        parts.getItem(0).alias("language"),
        parts.getItem(1).alias("script"),
        F.col("_metadata.file_name").alias("file"),
    )


def text_by_label(spark: SparkSession, path: str) -> DataFrame:
    """Text lines that were written with one folder per (language, script): text, language, script."""
    found = spark.read.schema("value STRING, language STRING, script STRING").text(path)
    return found.select(F.col("value").alias("text"), "language", "script")


def round_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segment lines that crawl rounds wrote, one folder per (round, language): text, round, label."""
    found = spark.read.schema("value STRING, round INT, language STRING").text(path)
    return found.select(F.col("value").alias("text"), "round", F.col("language").alias("label"))


def dataset(spark: SparkSession, path: str, languages: Iterable[str] | None = None) -> DataFrame:
    """The finished corpus; a language filter prunes whole folders."""
    df = spark.read.schema(schemas.DATASET_ROW).parquet(path)
    if languages is not None:
        wanted = [label.strip() for label in languages]
        pairs = [tuple(label.split("_")) for label in wanted]
        keep = F.lit(False)
        for language, script in pairs:
            keep = keep | ((F.col("language") == language) & (F.col("script") == script))
        df = df.filter(keep)
    return df


def parquet_rows(spark: SparkSession, path: str) -> DataFrame:
    """(n): the number of rows below a path, from the footers of its files; no data page is read.

    Only the newer file source counts in footers. It is switched on in a session of its own, so that all other reads
    are planned as before.
    """
    counting = spark.newSession()
    counting.conf.set("spark.sql.sources.useV1SourceList", "")
    counting.conf.set("spark.sql.parquet.aggregatePushdown", True)
    return counting.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


def crawl_index(spark: SparkSession, path: str) -> DataFrame:
    """CSV extract of a crawl index, with header."""
    return spark.read.schema(schemas.INDEX_ROW).option("header", True).csv(path)


def stored_index(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """An index that `writers.write_index` wrote; `columns` are its further columns, as `name TYPE`."""
    return spark.read.schema(", ".join([schemas.INDEX_ROW, *columns, "crawl STRING", "subset STRING"])).parquet(path)


def language_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Language name, ISO 639-3 code and ISO 15924 script, one row per code and script."""
    if path is not None:
        df = spark.read.schema(schemas.LANGUAGE_ROW).option("header", True).csv(path)
    else:
        df = spark.createDataFrame(LANGUAGES, schemas.LANGUAGE_ROW)
    # a pair listed twice under two names would double every joined row
    return df.groupBy("iso6393", "iso15924").agg(F.min("language").alias("language")).select(
        "iso6393", "language", "iso15924"
    )


def coverage_counts(spark: SparkSession, path: str) -> DataFrame:
    """CSV of page counts per domain; nameless index columns are left out."""
    df = spark.read.option("header", True).csv(path)
    return coverage_scan(df.select([c for c in df.columns if not c.startswith("Unnamed")]))


def coverage_scan(df: DataFrame) -> DataFrame:
    """Coverage rows with fixed types, without index columns, sorted by language."""
    keep = [c for c in df.columns if not c.startswith("Unnamed")]
    return (
        df.select(keep)
        .withColumn("count_google", F.col("count_google").cast("bigint"))
        .withColumn("count_commoncrawl", F.col("count_commoncrawl").cast("bigint"))
        .orderBy("language")
    )


def warc_target_uris(spark: SparkSession, path: str) -> DataFrame:
    """Target URIs of all response records of WARC files (plain or whole-file gz)."""
    records = spark.read.option("lineSep", "WARC/1.0\r\n").text(path)
    head = F.substring_index(F.col("value"), "\r\n\r\n", 1)
    return (
        records.filter(F.rlike(head, F.lit(r"(?im)^WARC-Type:\s*response\s*$")))
        .select(F.regexp_extract(head, r"(?im)^WARC-Target-URI:\s*(\S+)\s*$", 1).alias("target_uri"))
        .filter(F.col("target_uri") != "")
    )


# Languages of the seed lists with the script each is collected in.
LANGUAGES = [
    ("arabic", "ara", "Arab"),
    ("hausa", "hau", "Arab"),
    ("fulani", "ful", "Adlm"),
    ("igbo", "ibo", "Latn"),
    ("somali", "som", "Latn"),
    ("lingala", "lin", "Latn"),
    ("malagasy", "mlg", "Latn"),
    ("berber", "ber", "Tfng"),
    ("kirundi", "run", "Latn"),
    ("kituba", "ktu", "Latn"),
    ("mooré", "mos", "Latn"),
    ("mossi", "mos", "Latn"),
    ("zulu", "zul", "Latn"),
    ("tigrinya", "tir", "Ethi"),
    ("kanuri", "kau", "Latn"),
    ("akan", "aka", "Latn"),
    ("shona", "sna", "Latn"),
    ("gikuyu", "kik", "Latn"),
    ("xhosa", "xho", "Latn"),
    ("afrikaans", "afr", "Latn"),
    ("tumbuka", "tum", "Latn"),
    ("wolof", "wol", "Latn"),
    ("chewa", "nya", "Latn"),
    ("umbundu", "umb", "Latn"),
    ("luhya", "luy", "Latn"),
    ("kalenjin", "kln", "Latn"),
    ("ibibio", "ibb", "Latn"),
    ("tshiluba", "lub", "Latn"),
    ("kongo", "kon", "Latn"),
    ("zarma", "dje", "Latn"),
    ("tswana", "tsn", "Latn"),
    ("luganda", "lug", "Latn"),
    ("sesotho", "sot", "Latn"),
    ("hassaniya", "mey", "Arab"),
    ("tiv", "tiv", "Latn"),
]
