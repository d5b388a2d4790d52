"""Writers. Spark's commit protocol makes each output appear whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _by_label(df: DataFrame, *label: str) -> DataFrame:
    """Bring rows of one output folder together, so that there are few files per folder.

    The hint leaves the sizes to adaptive execution: small labels share a task, and a label
    that holds a third of all rows is split over as many tasks as its bytes call for.
    """
    return df.hint("rebalance", *label)


def write_json_lines(df: DataFrame, path: str, compress: bool = True, mode: str = "overwrite") -> None:
    """Raw or parsed pages as JSON lines; fields that are NULL are left out."""
    df.write.mode(mode).option("compression", "gzip" if compress else "none").json(path)


def write_set_aside(checked: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Pages with a problem, as JSON lines in one folder per problem; pages without one are not written."""
    bad = checked.filter(F.col("problem").isNotNull())
    _by_label(bad, "problem").write.mode(mode).partitionBy("problem").option("compression", "gzip").json(path)


def write_segments(segments: DataFrame, path: str) -> None:
    """Segment text as one folder per (round, language), one line per segment.

    A (round, language) that is there is replaced, so a round written twice has its text once; others stay.
    """
    (
        _by_label(segments.select("round", "language", "text"), "round", "language")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("round", "language")
        .text(path)
    )


def write_url_list(urls: DataFrame, path: str, compress: bool = False, mode: str = "overwrite") -> None:
    """URLs, one per line."""
    urls.select("url").write.mode(mode).option("compression", "gzip" if compress else "none").text(path)


def write_urls_by_label(urls: DataFrame, path: str, label: str = "lang_script", mode: str = "overwrite") -> None:
    """URLs as gz text, one folder per label: seed lists, or crawled URLs per language."""
    (
        _by_label(urls.select(label, "url"), label)
        .write.mode(mode)
        .partitionBy(label)
        .option("compression", "gzip")
        .text(path)
    )


def write_parsed_by_label(parsed: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parsed pages as gz JSON lines, one folder per `label` in one write; NULL has a folder of its own."""
    _by_label(parsed, "label").write.mode(mode).partitionBy("label").option("compression", "gzip").json(path)


def write_text_by_label(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text lines, one folder per (language, script) in one write; NULL has a folder of its own."""
    (
        _by_label(rows.select("text", "language", "script"), "language", "script")
        .write.mode(mode)
        .partitionBy("language", "script")
        .text(path)
    )


def write_dataset(df: DataFrame, path: str, max_rows: int = 500_000, mode: str = "overwrite") -> None:
    """The corpus as zstd Parquet, one folder per (language, script), files of at most `max_rows`."""
    (
        _by_label(df.select("text", "language", "script"), "language", "script")
        .write.mode(mode)
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_rows)
        .partitionBy("language", "script")
        .parquet(path)
    )


def write_index(index: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A crawl index as Parquet, one folder per (crawl, subset, language), rows in order of the domain."""
    keys = ("crawl", "subset", "content_languages")
    (
        _by_label(index, *keys)
        .sortWithinPartitions(*keys, "url_host_registered_domain")
        .write.mode(mode)
        .partitionBy(*keys)
        .parquet(path)
    )


def write_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Corpus statistics as one CSV file with header and a nameless first column that numbers the rows by language and script.

    There is one row per language, so one task writes them in order.
    """
    by = Window.orderBy("language", "script")
    numbered = stats.select((F.row_number().over(by) - 1).alias(""), *stats.columns)
    numbered.coalesce(1).write.mode(mode).option("header", True).option("emptyValue", "").csv(path)


def write_samples(samples: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Sample lines as CSV with header."""
    samples.select("sample", "language").write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_warc(records: DataFrame, path: str, compress: bool = False, mode: str = "overwrite") -> None:
    """WARC records, each followed by two line ends."""
    (
        records.select("record")
        .write.mode(mode)
        .option("lineSep", "\r\n\r\n")
        .option("compression", "gzip" if compress else "none")
        .text(path)
    )
