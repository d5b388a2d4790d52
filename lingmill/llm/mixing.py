"""Mixing documents to target domain weights, with soft membership.

A classifier learned from a labelled table gives each document a posterior over domains. Every document gets
a nonnegative rate (how often it is to be seen), so that the expected tokens of the domains, the sum over
documents of rate * tokens * posterior, match the targets. The rates minimise

    1/2 |E - T|^2 + pull/2 * sum of w * (rate - 1)^2,    rate >= 0,

with E and T as shares of all tokens and w a document's share of them. Projected gradient steps do it; each
is one aggregate over the table of posteriors, from which only one number per domain comes to the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill.sources.shared import materialize


@dataclass(frozen=True)
class MixingOptions:
    """`train_rows` bounds the labelled rows that the classifier learns from, drawn per domain by hash, as many
    of each. `buckets` is the number of hashed word features. The roots of posteriors are rounded to `levels` steps, so
    small posteriors have fine ones; documents with the same rounded posterior have the same rate and are folded before
    the steps. `whole` names the domains that do not shrink when no total is given (none: all of them); a document that
    belongs to them with a posterior of `sure` or more then has a rate of 1 or more."""

    train_rows: int = 6000
    buckets: int = 1 << 17
    levels: int = 64
    pull: float = 1e-3
    steps: int = 40
    tolerance: float = 1e-4
    epochs: int = 60
    common: float = 0.005
    shrink: float = 1e-4
    whole: tuple[str, ...] = ()
    sure: float = 0.9


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    weights: np.ndarray  # buckets x domains
    bias: np.ndarray


def _features(text: str | None, buckets: int) -> tuple[np.ndarray, int]:
    """Hashed different words of a text (small ASCII letters), and the number of its words."""
    words = (text or "").encode().lower().split()
    return np.unique(np.fromiter(map(zlib.crc32, set(words)), dtype=np.int64) % buckets), len(words)


def learn_domains(
    docs: DataFrame,
    labelled: DataFrame,
    domains: tuple[str, ...],
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "domain",
    options: MixingOptions = MixingOptions(),
) -> DomainModel:
    """Softmax regression on the different words of labelled documents.

    `labelled` has `id_col` and `label`; rows with a NULL or a label outside `domains` teach nothing, and of
    several labels of an id the first by name counts. Per domain the documents with the smallest hashes are
    drawn, one per hash bucket. Without labelled rows all posteriors are equal.
    """
    each = max(1, options.train_rows // len(domains))
    labels = (
        labelled.select(F.col(id_col).alias("id"), F.col(label).alias("domain"))
        .filter(F.col("id").isNotNull() & F.col("domain").isin(*domains))
        .groupBy("id")
        .agg(F.min("domain").alias("domain"))
        .withColumn("h", F.xxhash64("id"))
    )
    drawn = labels.groupBy("domain", F.pmod("h", F.lit(each)).alias("bucket")).agg(F.min("h").alias("h"))
    chosen = labels.join(drawn.select("domain", "h"), ["domain", "h"], "left_semi").select("id", "domain")
    # train_rows ids at most, so the texts are not shuffled for them
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")

    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([_features(t, options.buckets)[0].astype("<i4").tobytes() for t in texts], dtype=object)

    # a repeated id gives one row; train_rows rows of at most `buckets` numbers come to the driver
    found = rows.dropDuplicates(["id"]).select("id", "domain", features("text").alias("f")).collect()
    found.sort(key=lambda r: (r["domain"], r["id"]))
    weights = np.zeros((options.buckets, len(domains)))
    bias = np.zeros(len(domains))
    if found:
        lengths = np.array([len(r["f"]) // 4 for r in found])
        columns = np.frombuffer(b"".join(r["f"] for r in found), "<i4")
        target = np.eye(len(domains))[[domains.index(r["domain"]) for r in found]]
        weights, bias = _softmax_regression(lengths, columns, target, weights, bias, options)
        # the draw has as many of each domain; posteriors go by the shares of all labels
        share = dict(labels.groupBy("domain").count().collect())
        drawn_share = target.mean(axis=0)
        bias = bias + np.log([share[d] if d in share else 1 for d in domains]) - np.log(np.maximum(drawn_share, 1e-9))
    return DomainModel(domains, weights.astype(np.float32), bias)


def _softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def _softmax_regression(lengths, columns, target, weights, bias, options):
    """Full gradient steps with step sizes per weight (Adagrad) and a pull of all weights towards 0.

    Only features that `common` of the documents or more have get a weight: rare ones say little and would be
    learned by heart.
    """
    documents = np.repeat(np.arange(len(lengths)), lengths)
    often = np.bincount(columns, minlength=len(weights)) >= max(2.0, options.common * len(lengths))
    documents, columns = documents[often[columns]], columns[often[columns]]
    used, columns = np.unique(columns, return_inverse=True)
    part, sums, bias_sums = np.zeros((len(used), target.shape[1])), 1e-8, 1e-8
    for _ in range(options.epochs):
        logits = np.stack(
            [np.bincount(documents, part[columns, d], len(lengths)) for d in range(target.shape[1])], axis=1
        )
        error = (_softmax(logits + bias) - target) / len(lengths)
        slope = np.stack(
            [np.bincount(columns, error[documents, d], len(used)) for d in range(target.shape[1])], axis=1
        )
        slope = slope + options.shrink * part
        sums, bias_sums = sums + slope**2, bias_sums + error.sum(0) ** 2
        part -= 0.3 * slope / np.sqrt(sums)
        bias = bias - 0.3 * error.sum(0) / np.sqrt(bias_sums)
    weights[used] = part
    return weights, bias


def with_posteriors(docs: DataFrame, model: DomainModel, text: Column, options: MixingOptions) -> DataFrame:
    """`docs` with `_mix`: STRUCT(tokens, levels), the words of the text and the roots of its posterior in whole steps."""

    @F.pandas_udf("tokens long, levels array<int>")
    def posterior(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens, levels = [], []
            for value in batch:
                columns, n = _features(value, options.buckets)
                logits = model.weights[columns].sum(axis=0, dtype=float) + model.bias
                levels.append(np.rint(np.sqrt(_softmax(logits)) * options.levels).astype(np.int32))
                tokens.append(n)
            yield pd.DataFrame({"tokens": tokens, "levels": levels})

    return docs.withColumn("_mix", posterior(text))


def _posterior(levels: Column, n: int) -> list[Column]:
    squares = [F.get(levels, F.lit(d)) * F.get(levels, F.lit(d)) for d in range(n)]
    whole = sum(squares, F.lit(0))
    return [s / whole for s in squares]


def fit_rates(
    memberships: DataFrame, targets: dict[str, float], total: float | None = None, options: MixingOptions = MixingOptions()
) -> DataFrame:
    """(levels, rate): the rate for each different posterior in `memberships` (levels, tokens).

    `targets` are the weights of the domains, in the order of the posterior; they are scaled to sum to 1. `total` is
    the number of tokens wanted; by default it is the smallest at which no domain of `whole` has to shrink and no document that
    is `sure` to belong to them has a rate below 1 (all rates times one factor keep the shares). Step sizes
    are those of Barzilai and Borwein. The fit ends when the expected shares no longer move by `tolerance`, or after
    `steps` steps. Without tokens every rate is 1.
    """
    n, names = len(targets), [f"e{d}" for d in range(len(targets))]
    weights = np.array(list(targets.values()), dtype=float)
    weights = weights / weights.sum()
    folded = materialize(memberships.groupBy("levels").agg(F.sum("tokens").alias("tokens")))
    all_tokens = folded.agg(F.sum("tokens")).first()[0] or 0
    if not all_tokens:
        return folded.select("levels", F.lit(1.0).alias("rate"))
    p = _posterior(F.col("levels"), n)
    state = folded.select(
        "levels",
        (F.col("tokens") / all_tokens).alias("w"),
        *(c.alias(f"p{d}") for d, c in enumerate(p)),
        F.lit(1.0).alias("before"),
        F.lit(1.0).alias("rate"),
    )

    def totals(rates: DataFrame) -> tuple[np.ndarray, float]:
        sums = [F.sum(F.col("w") * F.col("rate") * F.col(f"p{d}")).alias(c) for d, c in enumerate(names)]
        moved = F.sum(F.col("w") * (F.col("rate") - F.col("before")) ** 2)
        row = rates.agg(*sums, moved.alias("moved")).first()
        return np.array([row[c] for c in names]), row["moved"]

    expected, _ = totals(state)
    whole = [d for d, name in enumerate(targets) if name in (options.whole or targets) and weights[d] > 0]
    if total is None:
        wanted = max(expected[d] / weights[d] for d in whole) * weights
    else:
        wanted = weights * total / all_tokens
    size = 1.0
    for step in range(1, options.steps + 1):
        slope = expected - wanted
        pulled = F.col("rate") * (1 - size * options.pull) + size * options.pull
        moved = pulled - sum((F.col(f"p{d}") * float(size * slope[d]) for d in range(n)), F.lit(0.0))
        state = state.select(
            "levels", "w", *(f"p{d}" for d in range(n)), F.col("rate").alias("before"), F.greatest(F.lit(0.0), moved).alias("rate")
        )
        if step % 6 == 0:
            state = materialize(state)
        last, (expected, distance) = expected, totals(state)
        change = expected - last
        if np.abs(change).max() < options.tolerance * max(1.0, wanted.max()) and step > 2:
            break
        curve = float(change @ change) + options.pull * distance
        size = float(np.clip(distance / curve, 1.0, 1 / options.pull)) if curve > 0 else 1.0
    state = materialize(state)
    if total is None:
        belongs = sum((F.col(f"p{d}") for d in whole), F.lit(0.0)) >= options.sure
        least = state.filter(belongs).agg(F.min("rate")).first()[0]
        if least and least < 1:
            state = state.withColumn("rate", F.col("rate") / least)
    return state.select("levels", "rate")


def _copies(rate: Column, key: Column) -> Column:
    """Whole copies whose mean over keys is the rate: rounded up for the share of keys that its fraction is."""
    chance = F.pmod(F.xxhash64(key), F.lit(1 << 20)) / (1 << 20)
    return F.floor(rate + chance).cast("int")


def mixing_rates(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "domain",
    total: float | None = None,
    options: MixingOptions = MixingOptions(),
) -> DataFrame:
    """One row per input row: id, tokens, posterior (one of each domain, in the order of `targets`), rate, copies.

    NULL and empty texts have no tokens, the posterior of the bias alone, and a rate like others. Repeated rows stay
    repeated and have equal rates. A NULL id is a key like any other. An empty table gives an empty result.
    Columns other than those named are neither read nor returned.
    """
    model = learn_domains(docs, labelled, tuple(targets), id_col, text, label, options)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    rows = materialize(with_posteriors(rows, model, F.col("text"), options).select("id", "_mix.tokens", "_mix.levels"))
    rates = fit_rates(rows, targets, total, options)
    joined = rows.join(rates, "levels")
    return joined.select(
        F.col("id").alias(id_col),
        "tokens",
        F.array(*_posterior(F.col("levels"), len(targets))).alias("posterior"),
        "rate",
        _copies(F.col("rate"), F.col("id")).alias("copies"),
    )


def mixed(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "domain",
    total: float | None = None,
    options: MixingOptions = MixingOptions(),
) -> DataFrame:
    """`docs` with all its columns, each row as often as its rate says.

    NULL and empty texts, repeated rows and NULL ids are treated as in `mixing_rates`; an empty table gives an empty result.
    """
    model = learn_domains(docs, labelled, tuple(targets), id_col, text, label, options)
    rows = docs.select(F.struct("*").alias("row"))
    rows = with_posteriors(rows, model, F.col("row")[text], options)
    rates = fit_rates(rows.select("_mix.levels", "_mix.tokens"), targets, total, options)
    copies = _copies(F.col("rate"), F.col("row")[id_col])
    joined = rows.select("row", F.col("_mix.levels").alias("levels")).join(rates, "levels").withColumn("n", copies)
    repeated = joined.filter("n > 0").withColumn("n", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return repeated.select(*(F.col("row")[c].alias(c) for c in docs.columns))
