"""Quality rules from line frequency across documents.

Lines that many different documents of a host share (menus, notices, footers) are removed; a document
that loses most of its words with them is rejected. All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill.functions.bind import bind
from lingmill.llm.common import BLANKS, text_key, words_of
from lingmill.sources.shared import materialize

_A_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class LineLimits:
    """When a line is too frequent, and when a document is depleted.

    A line goes if at least `min_documents` different texts of its host have it and they are over
    `max_share` of the host's different texts, or if `max_texts` of them have it, however large the host is
    (None: by share alone). A document is rejected by the method if over `max_removed` of its words stand in
    such lines. `min_words` and `max_repeated` are the base rules.
    """

    min_documents: int = 10
    max_share: float = 0.1
    max_texts: int | None = 100
    max_removed: float = 0.5
    min_words: int = 50
    max_repeated: float = 0.5


def normalised_line(line: Column) -> Column:
    """Small letters, one blank between words, none at the ends, every digit a zero."""
    small = F.trim(F.lower(line))
    # few lines have other blanks than single spaces: plain substring tests spare the rest the expression
    odd = reduce(or_, (F.contains(small, F.lit(blank)) for blank in ("  ", "\t", "\x0b", "\f", "\r")))
    one = F.when(odd, F.trim(F.regexp_replace(small, BLANKS, " "))).otherwise(small)
    return F.regexp_replace(one, "[1-9]", "0")


def line_entries(text: Column) -> Column:
    """ARRAY of STRUCT(line hash, words) of the \\n-split lines that have a word."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.rlike(x, F.lit(_A_WORD)))
    return F.transform(
        lines,
        lambda x: bind(
            normalised_line(x),
            lambda y: F.struct(
                F.xxhash64(y).alias("line"),
                (F.length(y) - F.length(F.replace(y, F.lit(" "), F.lit(""))) + 1).alias("words"),
            ),
        ),
    )


def _windows_that_repeat(hashes: Column) -> Column:
    """Places of the windows whose hash occurs twice or more: sorted by hash, they have an equal neighbour."""
    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return bind(
        ranked,
        lambda r: F.array_compact(
            F.transform(
                r,
                lambda x, i: F.when((F.get(r, i - 1)["h"] == x["h"]) | (F.get(r, i + 1)["h"] == x["h"]), x["i"]),
            )
        ),
    )


def _words_under(places: Column) -> Column:
    """Number of words that the 3-word windows at these places cover."""
    second, third = F.transform(places, lambda i: i + 1), F.transform(places, lambda i: i + 2)
    return F.size(F.array_distinct(F.concat(places, second, third)))


def with_measures(rows: DataFrame, text: Column) -> DataFrame:
    """`rows` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; NULL counts as empty.

    3-word windows are compared by a 64-bit hash within one text. Only texts that repeat a window pay
    for finding where. The steps are columns of their own, so each is worked out once, in compiled code.
    """
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.rlike(x, F.lit(_A_WORD)))
    split = rows.select("*", words_of(text).alias("_words"), lines.alias("_lines"))
    # the last two places have no whole window
    windows = F.slice(
        F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))),
        1,
        F.greatest(F.size("_words") - 2, F.lit(0)),
    )
    hashed = split.select(
        *rows.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_windows"),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    places = F.when(repeats, _windows_that_repeat(F.col("_windows"))).otherwise(F.array().cast("array<int>"))
    placed = hashed.select("*", places.alias("_places"))
    counted = placed.withColumn("n_repeat_words", _words_under(F.col("_places")).cast("long"))
    return counted.drop("_windows", "_places")


def frequent_lines(docs: DataFrame, text: str, host: str, limits: LineLimits) -> tuple[DataFrame, DataFrame]:
    """(texts, lines): each different text of a host with its line entries, and the lines above limits.

    Texts are folded by host and content before lines are counted, so copies of one text count once
    and never multiply. Both counts combine before they are shuffled; a line that a third of all
    documents share is one counter per task. `host` is hashed, NULL being a host of its own.
    """
    h1, h2 = text_key(F.col(text))
    texts = materialize(
        docs.select(
            F.xxhash64(host).alias("host"), h1.alias("h1"), h2.alias("h2"), line_entries(F.col(text)).alias("lines")
        )
        .groupBy("host", "h1", "h2")
        .agg(F.first("lines").alias("lines"))
    )
    totals = texts.groupBy("host").agg(F.count("*").alias("texts"))
    counts = (
        texts.select("host", F.explode(F.array_distinct(F.col("lines.line"))).alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= limits.min_documents)
    )
    frequent = F.col("n") > limits.max_share * F.col("texts")
    if limits.max_texts is not None:
        frequent = frequent | (F.col("n") >= limits.max_texts)
    above = counts.join(totals, "host").filter(frequent)
    return texts, above.select("host", "line")


def removed_lines(docs: DataFrame, text: str = "text", host: str = "source", limits: LineLimits = LineLimits()) -> DataFrame:
    """For each different text (host, h1, h2) that loses lines: their hashes and the words lost."""
    texts, above = frequent_lines(docs, text, host, limits)
    return (
        texts.select("host", "h1", "h2", F.explode("lines").alias("entry"))
        .select("host", "h1", "h2", "entry.line", "entry.words")
        .join(above, ["host", "line"])
        .groupBy("host", "h1", "h2")
        .agg(F.collect_set("line").alias("removed"), F.sum("words").alias("removed_words"))
    )


def _judged(rows: DataFrame, limits: LineLimits) -> DataFrame:
    base = (F.col("n_words") < limits.min_words) | (
        F.col("n_repeat_words") > limits.max_repeated * F.col("n_words")
    )
    depleted = F.col("removed_words") > limits.max_removed * F.col("n_words")
    return rows.withColumns({"base_failed": base, "kept": ~base & ~depleted})


def line_quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    host: str = "source",
    limits: LineLimits = LineLimits(),
) -> DataFrame:
    """One row per input row: id, base measures, `removed_words`, `base_failed`, `kept`.

    NULL and empty texts have no words and fail the base. A NULL host is a host of its own. Repeated rows
    stay repeated with equal verdicts and count as one text. An empty table gives an empty
    result. Only the three named columns are read; others, whatever their names, play no part.
    """
    h1, h2 = text_key(F.col(text))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(host).alias("host"),
        h1.alias("h1"),
        h2.alias("h2"),
        F.col(text).alias("text"),
    )
    # written: a caller's filter must not carry the measures into the expressions they are made of
    rows = materialize(with_measures(rows, F.col("text")).drop("text"))
    lost = removed_lines(docs, text, host, limits).select("host", "h1", "h2", "removed_words")
    joined = rows.join(lost, ["host", "h1", "h2"], "left").withColumn(
        "removed_words", F.coalesce("removed_words", F.lit(0))
    )
    judged = _judged(joined, limits)
    return judged.select(F.col("id").alias(id_col), *(c for c in judged.columns if c not in ("id", "host", "h1", "h2")))


def clean_lines_and_keep(
    docs: DataFrame, text: str = "text", host: str = "source", limits: LineLimits = LineLimits()
) -> DataFrame:
    """The kept rows of `docs` with all their columns, frequent lines taken out of `text`.

    Same verdicts as `line_quality`, so NULL, empty and blank texts go. A text without frequent lines is returned as it is.
    Repeated rows stay repeated; an empty table gives an empty result.
    """
    h1, h2 = text_key(F.col(text))
    keyed = docs.select(F.xxhash64(host).alias("host"), h1.alias("h1"), h2.alias("h2"), F.col(text).alias("text"))
    # written before it is filtered: a filter must not carry the measures into the expressions they are made of
    measured = materialize(with_measures(keyed, F.col("text")).drop("text").dropDuplicates(["host", "h1", "h2"]))
    lost = removed_lines(docs, text, host, limits)
    joined = measured.join(lost, ["host", "h1", "h2"], "left").withColumn(
        "removed_words", F.coalesce("removed_words", F.lit(0))
    )
    verdicts = materialize(_judged(joined, limits).filter("kept").select("host", "h1", "h2", "removed"))
    h1, h2 = text_key(F.col("row")[text])
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.xxhash64(F.col("row")[host]).alias("host"), h1.alias("h1"), h2.alias("h2")
    )
    left = F.array_join(
        F.filter(
            F.split(F.col("row")[text], "\n"),
            lambda x: ~(F.rlike(x, F.lit(_A_WORD)) & F.array_contains("removed", F.xxhash64(normalised_line(x)))),
        ),
        "\n",
    )
    body = F.when(F.col("removed").isNull(), F.col("row")[text]).otherwise(left)
    return rows.join(verdicts, ["host", "h1", "h2"]).select(
        *(body.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns)
    )
