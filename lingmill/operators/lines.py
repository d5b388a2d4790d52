"""Lines of text out of blocks of text. Row-local: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill.functions import text as tx


def _explode_lines(df: DataFrame, text_col: str, lines) -> DataFrame:
    others = [c for c in df.columns if c != text_col]
    return df.select(*others, F.posexplode(lines).alias("line_no", "line"))


def stripped_lines(df: DataFrame, text_col: str = "text") -> DataFrame:
    """All non-empty lines, stripped; `line_no` counts them from 0 within the row."""
    return _explode_lines(df, text_col, tx.stripped_lines(F.col(text_col)))


def clean_lines(df: DataFrame, text_col: str = "text", distinct: bool = True, **rules) -> DataFrame:
    """One row per clean line of a block, each line once per block; other columns are kept.

    Rules and defaults: `min_len=50, max_lower=0.95, max_upper=0.2, bad_suffix='...',
    min_marks=0, alphabet='reference'`.
    """
    return _explode_lines(df, text_col, tx.clean_block(F.col(text_col), distinct=distinct, **rules))


def line_measures(df: DataFrame, text_col: str = "text", alphabet: str = "reference") -> DataFrame:
    """Non-empty lines with the figures that the cleaning rules look at."""
    line = F.col("line")
    return stripped_lines(df, text_col).withColumns(
        {
            "n_chars": F.length(line).cast("bigint"),
            "n_lower": tx.lower_count(line, alphabet).cast("bigint"),
            "n_upper": tx.upper_count(line, alphabet).cast("bigint"),
            "n_marks": tx.mark_count(line).cast("bigint"),
        }
    )


def paragraph_unwrap(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per paragraph with its line wraps undone."""
    others = [c for c in df.columns if c != text_col]
    return df.select(*others, F.posexplode(tx.paragraphs(F.col(text_col))).alias("paragraph_no", "paragraph"))
