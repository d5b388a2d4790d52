"""The corpus: exact line dedup and statistics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill.functions import text as tx
from lingmill.operators.language import clean_targets, label_parts


def with_label_parts(segments: DataFrame, label_col: str) -> DataFrame:
    """Replace an `xxx_Yyyy` label by `language` and `script`."""
    language, script = label_parts(F.col(label_col))
    others = [c for c in segments.columns if c not in (label_col, "language", "script")]
    return segments.select(*others, language.alias("language"), script.alias("script"))


def dataset_language_filter(df: DataFrame, labels: Iterable[str] | str) -> DataFrame:
    """Rows whose `language_script` is listed."""
    keep = F.lit(False)
    for label in clean_targets(labels):
        language, script = label.split("_")
        keep = keep | ((F.col("language") == language) & (F.col("script") == script))
    return df.filter(keep)


def dataset_dedup(segments: DataFrame) -> DataFrame:
    """Every text once per (language, script), by its full text.

    Map tasks drop their own copies first, so a line that is a third of the input is sent
    only once per task.
    """
    return segments.select("text", "language", "script").distinct()


def corpus_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Words, characters and sentences per (language, script)."""
    n = tx.sentence_counts(F.col("_line"))
    # a text may hold several lines; nearly all hold one
    lines = df.select("language", "script", F.explode(F.split(text_col, "\n")).alias("_line"))
    return (
        lines.select("language", "script", n.alias("_n"))
        .groupBy("language", "script")
        .agg(
            F.sum("_n.words").alias("words"),
            F.sum("_n.characters").alias("characters"),
            F.sum("_n.sentences").alias("sentences"),
        )
    )


def stats_report(stats: DataFrame) -> DataFrame:
    """One `key: value` text block per row of the statistics."""
    fields = ("language", "script", "words", "characters", "sentences")
    block = F.concat_ws("\n", *[F.concat(F.lit(f"{f}: "), F.col(f).cast("string")) for f in fields])
    return stats.select("language", "script", block.alias("report"))


def report_text(report: DataFrame) -> DataFrame:
    """The whole report in one row: one block per language, so it is small."""
    blocks = F.array_sort(F.collect_list(F.struct("language", "script", "report")))
    return report.agg(F.concat_ws("\n-----\n", F.transform(blocks, lambda b: b["report"])).alias("report"))
