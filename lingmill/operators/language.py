"""Language of text lines: a character-trigram model, trained and applied as Spark jobs.

Scores are whole micro-logs, so sums do not depend on the order of rows or on the engine.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill.functions import urls
from lingmill.sources.shared import materialize

#: Languages of one row of a model, one column each.
WIDTH = 8
#: Trigrams that are cut out of one stretch of text.
_STRETCH = 32


def _padded(text: Column) -> Column:
    return F.concat(F.lit(" "), F.lower(text), F.lit(" "))


def trigrams(text: Column) -> Column:
    """ARRAY of the overlapping 3-character pieces of the lower-cased text between two blanks."""
    # look ahead at three characters, go on by one
    return F.regexp_extract_all(_padded(text), F.lit("(?s)(?=(...))."), F.lit(1))


def exploded_trigrams(lines: DataFrame, text_col: str, *others: Column | str) -> DataFrame:
    """(others, trigram): one row for each of the `trigrams` of the lines that are not empty.

    The text is cut by one regular expression into stretches that share two characters, and trigrams are cut out of
    these by place. A place is found by counting characters from the start, so stretches are short; a regular expression
    for each trigram takes several times as long.
    """
    stretch = F.lit(f"(?s)(?=(.{{1,{_STRETCH + 2}}})).{{1,{_STRETCH}}}")
    # outer, as a plain explode is planned with a filter for empty lists in front, which makes each list once more
    cut = lines.filter(F.length(text_col) > 0).select(
        *others, F.explode_outer(F.regexp_extract_all(_padded(F.col(text_col)), stretch, F.lit(1))).alias("_stretch")
    )
    names = [c for c in cut.columns if c != "_stretch"]
    # what is left at the end may be shorter than a trigram
    n = F.length("_stretch") - 2
    placed = cut.filter(n > 0).select(*names, "_stretch", F.explode_outer(F.sequence(F.lit(1), n)).alias("_at"))
    return placed.select(*names, F.substring(F.col("_stretch"), F.col("_at"), F.lit(3)).alias("trigram"))


def trigram_counts(lines: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """(language, trigram, n). Counted within each map task first, so frequent trigrams are cheap."""
    return (
        exploded_trigrams(lines, text_col, F.col(label_col).alias("language"))
        .groupBy("language", "trigram")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _micro_log(count: Column, total: Column) -> Column:
    return F.round(F.ln(count.cast("double") / total.cast("double")) * 1000000).cast("bigint")


def lid_scores(counts: DataFrame) -> DataFrame:
    """(language, trigram, n, score): log-probability with add-one smoothing, in micro-logs."""
    totals = counts.groupBy("language").agg(F.sum("n").alias("total"))
    vocabulary = counts.agg(F.countDistinct("trigram")).scalar()
    return counts.join(totals, "language").select(
        "language",
        "trigram",
        "n",
        _micro_log(F.col("n") + 1, F.col("total") + vocabulary).alias("score"),
    )


@dataclass(frozen=True)
class LanguageModel:
    """Gains over the score of an unseen trigram, `WIDTH` languages in a row: (trigram, block, g0, g1, ...). A block of which
    no language has the trigram has no row, so the table grows with what the languages have, not with their number."""

    languages: tuple[str, ...]
    unseen: tuple[int, ...]
    gains: DataFrame
    n_trigrams: int

    @property
    def fallback(self) -> str:
        """Label of a line of which the model knows no trigram."""
        return self.languages[self._best_unseen] if self.languages else ""

    @property
    def _best_unseen(self) -> int:
        return max(range(len(self.unseen)), key=lambda i: (self.unseen[i], -i))

    @property
    def width(self) -> int:
        return min(WIDTH, len(self.languages))

    def lookup(self) -> DataFrame:
        """The gains. They are a stored table: the planner knows their size and picks the join."""
        return self.gains


def lid_train(lines: DataFrame, text_col: str, label_col: str) -> LanguageModel:
    """Fit a model on labelled lines, for any number of languages; lines without a label teach nothing.

    Runs jobs; the driver holds one number per language.
    """
    counts = materialize(trigram_counts(lines.filter(F.col(label_col).isNotNull()), text_col, label_col))
    spark = lines.sparkSession
    vocabulary = counts.agg(F.countDistinct("trigram")).first()[0]
    totals = counts.groupBy("language").agg(F.sum("n").alias("total"))
    unseen = _micro_log(F.lit(1), F.col("total") + F.lit(vocabulary)).alias("unseen")
    rows = sorted(tuple(r) for r in totals.select("language", "total", unseen).collect())
    ranked = [(i, *row) for i, row in enumerate(rows)]
    known = spark.createDataFrame(ranked, "rank int, language string, total bigint, unseen bigint")
    gain = _micro_log(F.col("n") + 1, F.col("total") + F.lit(vocabulary)) - F.col("unseen")
    place = F.pmod("rank", F.lit(WIDTH))
    wide = (
        counts.join(known, "language")
        .withColumns({"block": F.expr(f"rank div {WIDTH}").cast("int"), "gain": gain, "place": place})
        .groupBy("trigram", "block")
        .agg(*[F.sum(F.when(F.col("place") == j, F.col("gain")).otherwise(0)).alias(f"g{j}") for j in range(min(WIDTH, len(rows)))])
    )
    return LanguageModel(tuple(r[0] for r in rows), tuple(r[2] for r in rows), materialize(wide), int(vocabulary))


def lid_labels(lines: DataFrame, keys: Sequence[str], text_col: str, model: LanguageModel) -> DataFrame:
    """(keys, language) of the lines that share a trigram with the model; `keys` is unique.

    Only keys, not texts, go through the exploded rows. With a broadcast model the sums are made in the map task that
    holds the line: one row per line and block of languages is shuffled. Languages that share no trigram with a line
    need no row: the best of them is the one that is best for unseen trigrams, since gains are never negative.
    """
    n_languages = len(model.languages)
    if not n_languages:
        return lines.select(*keys, F.lit("").alias("language")).limit(0)
    grams = exploded_trigrams(lines, text_col, *keys, F.length(text_col).cast("bigint").alias("_n"))
    one_block = n_languages <= WIDTH
    block = [] if one_block else ["block"]
    gains = model.lookup().drop("block") if one_block else model.lookup()
    sums = grams.join(gains, "trigram").groupBy(*keys, "_n", *block).agg(*[F.sum(f"g{j}").alias(f"g{j}") for j in range(model.width)])
    unseen, labels = F.lit(list(model.unseen)), F.lit(list(model.languages))

    def score(j: int) -> Column:
        if one_block:
            return F.struct((F.col(f"g{j}") + F.col("_n") * F.lit(model.unseen[j])).alias("score"), F.lit(-j).alias("rank"))
        rank = F.col("block") * WIDTH + j
        own = F.struct((F.col(f"g{j}") + F.col("_n") * F.get(unseen, rank)).alias("score"), (-rank).alias("rank"))
        return F.when(rank < n_languages, own)  # the last block may be short

    best = F.array_max(F.array(*[score(j) for j in range(model.width)]))
    if one_block:
        return sums.select(*keys, F.get(labels, -best["rank"]).alias("language"))
    at = model._best_unseen
    other = F.struct((F.first("_n") * F.lit(model.unseen[at])).alias("score"), F.lit(-at).alias("rank"))
    whole = sums.withColumn("_best", best).groupBy(*keys).agg(F.greatest(F.max("_best"), other).alias("_best"))
    return whole.select(*keys, F.get(labels, -F.col("_best.rank")).alias("language"))


def lid_predict(lines: DataFrame, keys: Sequence[str], text_col: str, model: LanguageModel) -> DataFrame:
    """Add `language`: the best label by score, then by name."""
    labels = lid_labels(lines, keys, text_col, model)
    return lines.join(labels, list(keys), "left").withColumn(
        "language", F.coalesce("language", F.lit(model.fallback))
    )


def label_parts(label: Column) -> tuple[Column, Column]:
    """Language and script of an `xxx_Yyyy` label; a `__label__` in front is cut."""
    parts = F.split(F.regexp_replace(label, "^__label__", ""), "_")
    return F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))


def clean_targets(targets: Iterable[str] | str) -> list[str]:
    """Target languages without blanks and repeats; a comma-separated text is split."""
    if isinstance(targets, str):
        targets = targets.split(",")
    return list(dict.fromkeys(t.strip() for t in targets if t.strip()))


def page_language_counts(segments: DataFrame, page_col: str) -> DataFrame:
    return segments.groupBy(page_col, "language").agg(F.count(F.lit(1)).alias("n"))


def page_language_share(segments: DataFrame, page_col: str, targets: Iterable[str] | str) -> DataFrame:
    """(page, total, target): all segments of a page and those in a target language."""
    wanted = F.col("language").isin(clean_targets(targets))
    return segments.groupBy(page_col).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(wanted).alias("target")
    )


def _share_reached(target: Column, total: Column, min_share: float) -> Column:
    return target.cast("bigint") * 10000 >= total.cast("bigint") * round(min_share * 10000)


def segment_language_filter(segments: DataFrame, targets: Iterable[str] | str) -> DataFrame:
    return segments.filter(F.col("language").isin(clean_targets(targets)))


def page_language_filter(
    segments: DataFrame,
    page_col: str,
    targets: Iterable[str] | str,
    min_share: float = 0.8,
    enabled: bool = True,
) -> DataFrame:
    """Segments in a target language, of pages that are mostly in the target languages.

    Page totals come from an aggregate that is combined before the shuffle, not from a window,
    so a page (or source) with very many segments is never held by one task.
    """
    targets = clean_targets(targets)
    wanted = segment_language_filter(segments, targets)
    if not enabled:
        return wanted
    share = page_language_share(segments, page_col, targets)
    good = share.filter(_share_reached(F.col("target"), F.col("total"), min_share)).select(page_col)
    return wanted.join(good, page_col, "left_semi")


def keep_target_segments(
    segments: Column, targets: Iterable[str] | str, min_share: float = 0.8, enabled: bool = True
) -> Column:
    """The same on an array of {text, language} within the row of its page: no shuffle."""
    targets = clean_targets(targets)
    wanted = F.filter(segments, lambda s: s["language"].isin(targets))
    if not enabled:
        return wanted
    enough = _share_reached(F.size(wanted), F.size(segments), min_share)
    return F.when(enough, wanted).otherwise(F.slice(wanted, 1, 0))


def domain_language_counter(segments: DataFrame, url_col: str = "url") -> DataFrame:
    """(host, language, n): in which languages the text of a host is."""
    return (
        segments.select(urls.netloc(F.col(url_col)).alias("host"), "language")
        .groupBy("host", "language")
        .agg(F.count(F.lit(1)).alias("n"))
    )
