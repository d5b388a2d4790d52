"""Language identification by compression.

Every language has a zstandard raw-content dictionary made of text in it. A text is coded once per
language, in blocks, each with that dictionary at hand; the language with the smallest sum of coded
bytes wins. A narrow margin between the best two is a rejection.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _letters(text: str) -> bytes:
    """What tells languages apart: small letters, with one space for all that lies between."""
    return _NOT_LETTERS.sub(" ", text.lower()).encode()


def _coders(dictionaries: tuple[bytes, ...], level: int) -> list[Callable[[bytes], bytes]]:
    coders = []
    for content in dictionaries:
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=level)
        coder = zstandard.ZstdCompressor(level=level, dict_data=raw, write_content_size=False)
        coders.append(coder.compress)
    return coders


def _shortest(blocks: list[bytes], coders: list[Callable[[bytes], bytes]]) -> tuple[int, float]:
    """The language with the fewest coded bytes, and the share of bytes it saves against the second."""
    sizes = sorted((sum(len(coder(block)) for block in blocks), i) for i, coder in enumerate(coders))
    return sizes[0][1], 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0


@dataclass(frozen=True)
class LidOptions:
    """Bounds of the model, and how texts are coded.

    `sample_texts` texts per language (chosen by hash) each give one piece of `piece_chars`
    characters. Texts whose margin at `level` is under `fine_margin` are coded again at the slower
    `fine_level`, and that result counts. A dictionary has up to `dictionary_bytes`, all together `model_bytes`, so the model
    that goes to the executors has a fixed bound whatever the number of languages. Blocks keep a long
    text from being coded by its own earlier parts instead of by the dictionary.
    """

    sample_texts: int = 256
    piece_chars: int = 512
    dictionary_bytes: int = 96 << 10
    model_bytes: int = 16 << 20
    block_bytes: int = 2048
    level: int = 5
    fine_level: int = 12
    fine_margin: float = 0.1
    min_margin: float = 0.02


@dataclass(frozen=True)
class LidModel:
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    options: LidOptions


def lid_dictionaries(
    docs: DataFrame, text: str = "text", lang: str = "lang", options: LidOptions = LidOptions()
) -> LidModel:
    """Learn one dictionary per label from labelled texts.

    Rows with NULL text, NULL label or no letter teach nothing; repeated texts count once. Texts are
    drawn by a hash of the text, one per label and hash bucket, so the draw is the same on every run
    and no label's rows meet in one task. A long text gives a piece from a hashed place. An empty table
    gives a model without languages.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        F.col("lang").isNotNull() & has_letter(F.col("text"))
    )
    hashed = rows.withColumn("h", F.xxhash64("text"))
    drawn = (
        hashed.groupBy("lang", F.pmod("h", F.lit(options.sample_texts)).alias("bucket"))
        .agg(F.min("h").alias("h"))
        .select("lang", "h")
    )
    room = F.greatest(F.length("text") - options.piece_chars, F.lit(0))
    pieces = (
        hashed.join(drawn, ["lang", "h"], "left_semi")
        .select("lang", "h", F.col("text").substr(F.pmod(F.hash("text"), room + 1) + 1, F.lit(options.piece_chars)).alias("piece"))
        .groupBy("lang", "h")
        .agg(F.min("piece").alias("piece"))
        .collect()  # sample_texts pieces of piece_chars characters per language
    )
    by_lang: dict[str, list[tuple[int, str]]] = {}
    for row in pieces:
        by_lang.setdefault(row["lang"], []).append((row["h"], row["piece"]))
    languages = tuple(sorted(by_lang))
    each = min(options.dictionary_bytes, options.model_bytes // max(1, len(languages)))
    dictionaries = tuple(
        b" ".join(_letters(piece) for _, piece in sorted(by_lang[name]))[:each] for name in languages
    )
    return LidModel(languages, dictionaries, options)


def has_letter(text: Column) -> Column:
    """True if the text has a letter of any script; False for NULL."""
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def lid_compress(docs: DataFrame, model: LidModel, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the id, `best` (smallest code), `score`, and `lang`.

    `score` is the share of coded bytes that the best language saves against the second, 0 to 1 (1 if
    only one language is known). `lang` is `best`, or `und` where the score is below
    `min_margin`. A text that is NULL or has no letter, and every text under a model without languages,
    is `und` in both with score 0. Ties go to the first language by name. Whole texts are coded, however
    long. Other columns of `docs` are neither read nor returned; repeated rows stay repeated.
    """
    options, languages, dictionaries = model.options, model.languages, model.dictionaries

    @F.pandas_udf("best string, score double")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        quick, fine = _coders(dictionaries, options.level), _coders(dictionaries, options.fine_level)
        for batch in batches:
            best, score = [], []
            for value in batch:
                data = _letters(value)
                blocks = [data[i : i + options.block_bytes] for i in range(0, max(1, len(data)), options.block_bytes)]
                winner, margin = _shortest(blocks, quick)
                if margin < options.fine_margin:
                    winner, margin = _shortest(blocks, fine)
                best.append(languages[winner])
                score.append(margin)
            yield pd.DataFrame({"best": best, "score": score})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    known = has_letter(F.col("text"))
    if languages:
        # texts without a letter get an empty text here: they cost nothing and the answer is not used
        coded = rows.withColumn("known", known).withColumn("code", code(F.when(F.col("known"), F.col("text")).otherwise("")))
        rows = coded.select("id", *(F.when(F.col("known"), F.col(f"code.{c}")).alias(c) for c in ("best", "score")))
    else:
        rows = rows.select("id", F.lit(None).cast("string").alias("best"), F.lit(None).cast("double").alias("score"))
    return rows.select(
        F.col("id").alias(id_col),
        F.coalesce("best", F.lit(UNKNOWN)).alias("best"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.when(F.col("score") >= options.min_margin, F.col("best")).otherwise(UNKNOWN).alias("lang"),
    )
